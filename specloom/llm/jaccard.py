"""Exact n-gram Jaccard join by PartEnum signatures.

Sets of word shingles are dealt by size into overlapping bands, in which two sets of the wanted
similarity differ in at most k features. The feature domain is cut into n > k parts, so such sets agree
on n - k parts at least, and signatures stand for subsets of parts. With small k these are all subsets of
n - k parts. With larger k they are single parts, and a set needs only the first of them: n parts of which
all but k agree share one among the first k + 1 in any common order, and the order puts parts with many
features first, so that empty and common ones are left out. So all similar pairs share a signature.

Sets that share a signature are compared block by block on a parity sketch, whose distance is never more
than that of the sets: what is too far apart in the sketch is too far apart. Of the rest, first a spanning
tree of the nearest is verified on the whole sets, which joins groups of near copies by few pairs; then,
across the components these links give, every pair that the sketch leaves open.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specloom.llm.batches import text_batches, trimmed
from specloom.llm.components import connected_components
from specloom.llm.joins import broadcast_if_small
from specloom.session import stable

WIDTH = 5
# Similarity as percent.
PERCENT = 80
# Sizes of one band lie within this ratio, of which 100 / PERCENT is the overlap with the next band.
SPREAD = 2.0
# The same for sets of less than 100 features, where wide bands would leave few features to a part.
SMALL_SPREAD = 1.6
# (parts, subset size) for k = 0, 1, ...: up to the last k all subsets of parts are enumerated.
FULL = [(1, 1), (3, 2), (4, 2), (6, 3), (7, 3), (8, 3), *((k + 2, 2) for k in range(6, 13))]
# Bits of the parity sketch, and sets of one signature that are compared in one block.
SKETCH_BITS = 512
BLOCK_SETS = 1024
# Bytes of text hashed at a time; bounds the memory of a task.
BLOCK = 1 << 18

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if _POWERS.size < n:
        base = np.full(max(n, 2 * _POWERS.size), _BASE, dtype=np.uint64)
        base[0] = 1
        _POWERS = np.cumprod(base, dtype=np.uint64)
    return _POWERS


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of each word of a byte array."""
    filled = ~_BLANK[raw]
    first = filled.copy()
    first[1:] &= ~filled[:-1]
    starts = np.flatnonzero(first)
    if not starts.size:
        return np.zeros(0, dtype=np.uint64)
    raw, filled = raw[starts[0] :], filled[starts[0] :]
    starts = starts - starts[0]
    inside = np.arange(raw.size) - np.repeat(starts, np.diff(np.append(starts, raw.size)))
    part = _BYTE[raw] * _powers(int(inside.max()) + 1)[inside]
    part[~filled] = 0
    return mix(np.add.reduceat(part, starts))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the `width`-word shingles; a text of fewer words is one shingle, a
    text without words has none."""
    return next(shingle_sets([text], width))


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sets of many texts; short texts are hashed together, long ones block by block."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if len(raw) > BLOCK:
            yield from _sets_of(held, width)
            held, size = [], 0
            yield from _sets(np.concatenate([word_hashes(np.frombuffer(x, dtype=np.uint8)) for x in _cut(raw)]), [0], width)
            continue
        held.append(raw)
        size += len(raw)
        if size > BLOCK:
            yield from _sets_of(held, width)
            held, size = [], 0
    yield from _sets_of(held, width)


def _cut(raw: bytes) -> Iterator[bytes]:
    """Blocks of a long text that end at a blank; a word longer than a block is not cut."""
    blank = np.append(np.flatnonzero(_BLANK[np.frombuffer(raw, dtype=np.uint8)]) + 1, len(raw))
    at = 0
    while at < len(raw):
        i = int(np.searchsorted(blank, at + BLOCK, side="right")) - 1
        to = int(blank[i]) if i >= 0 and blank[i] > at else int(blank[i + 1])
        yield raw[at:to]
        at = to


def _sets_of(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    if not texts:
        return
    raw = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    filled = ~_BLANK[raw]
    first = filled.copy()
    first[1:] &= ~filled[:-1]
    ends = np.cumsum([len(t) + 1 for t in texts])
    begin = np.searchsorted(np.flatnonzero(first), ends - [len(t) + 1 for t in texts])
    yield from _sets(word_hashes(raw), begin.tolist(), width)


def _sets(words: np.ndarray, begin: list[int], width: int) -> Iterator[np.ndarray]:
    """Set of each run of word hashes; a run begins at each of `begin`."""

    def combined(w: np.ndarray, n: int) -> np.ndarray:
        m = max(0, w.size - n + 1)
        out = np.full(m, n, dtype=np.uint64)
        for j in range(n):
            out = mix(out + _GOLD) + w[j : j + m]
        return mix(out)

    every = combined(words, width)
    for a, b in zip(begin, [*begin[1:], words.size], strict=True):
        if b - a >= width:
            yield np.unique(every[a : b - width + 1])
        else:
            yield combined(words[a:b], b - a) if b > a else np.zeros(0, dtype=np.uint64)


class Bands:
    """Size bands of a similarity: band i holds the sizes low[i] .. high[i], and a pair lies whole in one."""

    def __init__(self, percent: int = PERCENT, spread: float = SPREAD):
        if not 0 < percent <= 100:
            raise ValueError("percent must be in 1 .. 100")
        self.percent = percent
        self.spread = spread
        self.low, self.high = [1], [1]
        self.found: dict[int, list[int]] = {}

    def _grow(self, size: int) -> None:
        while self.low[-1] <= size:
            # The next band starts where partners of the sets in it no longer fit into this one.
            low = self.high[-1] * self.percent // 100 + 1
            low = max(low, self.low[-1] + 1)
            self.low.append(low)
            self.high.append(max(low * 100 // self.percent, int(low * (SMALL_SPREAD if low < 100 else self.spread))))

    def of(self, size: int) -> list[int]:
        if size not in self.found:
            self._grow(size)
            self.found[size] = [i for i, (a, b) in enumerate(zip(self.low, self.high, strict=True)) if a <= size <= b]
        return self.found[size]

    def parts(self, band: int) -> tuple[int, int]:
        """(parts, most that differ) of a band: two sets of it that are similar differ in at most
        (1 - s) / (1 + s) of their sizes together."""
        k = 2 * (100 - self.percent) * self.high[band] // (100 + self.percent)
        return (FULL[k][0] if k < len(FULL) else k + max(2, k // 10)), k

    def differ(self, band: int, size: int) -> int:
        """Most features in which a set of this size differs from a similar one of the band."""
        return (100 - self.percent) * (size + min(self.high[band], size * 100 // self.percent)) // (100 + self.percent)


def signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Signatures of one set, in all its bands."""
    found = []
    for band in bands.of(shingles.size):
        n, k = bands.parts(band)
        own = mix(shingles + mix(np.full(1, band + 1, dtype=np.uint64)))
        part = (own % np.uint64(n)).astype(np.int64)
        sums = np.zeros(n, dtype=np.uint64)
        np.add.at(sums, part, mix(own))
        names = mix(sums + mix(np.arange(n, dtype=np.uint64) + np.uint64(band << 32)))
        if k < len(FULL):
            subsets = np.array(list(combinations(range(n), FULL[k][1])))
            found.append(mix(names[subsets].sum(axis=1, dtype=np.uint64) + np.uint64(band + 1)))
        else:
            order = np.lexsort((names, -np.bincount(part, minlength=n)))
            found.append(names[order[: bands.differ(band, shingles.size) + 1]])
    return np.concatenate(found)


def _class_of(shingles: np.ndarray) -> int:
    """Name of a set: equal sets have equal names."""
    return int(mix(mix(shingles).sum(dtype=np.uint64, keepdims=True) + np.uint64(shingles.size)).astype(np.int64)[0])


def sketch_of(shingles: np.ndarray) -> bytes:
    """Parity of the number of features in each of SKETCH_BITS cells. A feature that only one of two
    sets has changes one bit, so their sketches differ in no more bits than the sets in features."""
    cells = (mix(shingles + _GOLD) % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits(np.bincount(cells, minlength=SKETCH_BITS) & 1).tobytes()


def classes(texts, width: int = WIDTH):
    """Column struct<n, name, sketch> of a text column: size, name and sketch of its shingle set."""

    @F.arrow_udf("struct<n:bigint,name:bigint,sketch:binary>")
    def named(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in trimmed(batches):
            sizes, names, sketches = [], [], []
            for s in shingle_sets(batch.to_pylist(), width):
                sizes.append(s.size)
                names.append(_class_of(s) if s.size else None)
                sketches.append(sketch_of(s) if s.size else None)
            yield pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(sketches, pa.binary())], ["n", "name", "sketch"])

    return named(texts)


def signature_rows(docs: DataFrame, text: str, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """(signature, name) of all shingle sets; equal sets of one task give them once, as far as it remembers."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        done: set[int] = set()
        for batch in trimmed(batches):
            names, found, held = [], [], 0
            if len(done) > 100_000:
                done.clear()
            for s in shingle_sets(batch.column(0).to_pylist(), width):
                if s.size and (name := _class_of(s)) not in done:
                    done.add(name)
                    own = signatures(s, bands)
                    names.append(np.full(own.size, name, dtype=np.int64))
                    found.append(own)
                    held += own.size
                if held > 500_000:
                    yield _rows(found, names)
                    names, found, held = [], [], 0
            if held:
                yield _rows(found, names)

    return docs.select(F.col(text).alias("text")).mapInArrow(sign, "signature bigint, name bigint")


def _rows(found: list[np.ndarray], names: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64)), pa.array(np.concatenate(names))], ["signature", "name"])


def _verified(pairs: DataFrame, known: DataFrame, keyed: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (name, pivot) whose whole sets are similar enough. Each text goes once to the place of
    its pivot, where the texts stream past the pivot's set."""
    places = known.select(F.col("name").alias("member"), "rep")
    own = pairs.select(F.col("pivot").alias("member"), "pivot", F.lit(False).alias("other")).distinct()
    asked = pairs.select(F.col("name").alias("member"), "pivot", F.lit(True).alias("other")).unionByName(own)
    asked = stable(asked.join(broadcast_if_small(places), "member").select("rep", "member", "pivot", "other"))
    sent = keyed.join(broadcast_if_small(asked), "rep").select("pivot", "other", "member", "text")
    # Hashed by pivot; the pivot itself sorts first.
    dealt = sent.repartition("pivot").sortWithinPartitions("pivot", "other")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, whole = None, np.zeros(0, dtype=np.uint64)
        for batch in trimmed(batches):
            a, b = [], []
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for p, other, member, s in zip(*columns, shingle_sets(batch.column(3).to_pylist(), width), strict=True):
                if not other:
                    pivot, whole = p, s
                    continue
                if p != pivot:
                    raise RuntimeError("a pivot's text is missing")
                at = np.minimum(np.searchsorted(whole, s), whole.size - 1)
                shared = int((whole[at] == s).sum())
                if 100 * shared >= percent * (s.size + whole.size - shared):
                    a.append(member)
                    b.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return stable(dealt.mapInArrow(compare, "a bigint, b bigint").distinct())


def _open_pairs(sizes: np.ndarray, sketches: np.ndarray, percent: int) -> np.ndarray:
    """Sketch distances of all pairs of a block, with a large number where the sketches or the sizes
    rule the similarity out."""
    bits = np.zeros((len(sizes), len(sizes)), dtype=np.int64)
    for word in sketches.T:
        bits += np.bitwise_count(word[:, None] ^ word[None, :])
    most = (100 - percent) * (sizes[:, None] + sizes[None, :]) // (100 + percent)
    near = 100 * np.minimum(sizes[:, None], sizes[None, :]) >= percent * np.maximum(sizes[:, None], sizes[None, :])
    return np.where((bits <= most) & near, bits, _FAR)


_FAR = 1 << 40


def _spanning(distance: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a minimum spanning forest; pairs at _FAR are no edges, ties go to the smaller index."""
    n = len(distance)
    best, origin = np.full(n, _FAR), np.full(n, -1)
    waiting = np.ones(n, dtype=bool)
    edges = []
    for _ in range(n):
        i = int(np.where(waiting, best, _FAR + 1).argmin())
        waiting[i] = False
        if origin[i] >= 0:
            edges.append((i, int(origin[i])))
        closer = waiting & (distance[i] < best)
        best[closer], origin[closer] = distance[i][closer], i
    return edges


def _block_pairs(members: DataFrame, percent: int, tree: bool) -> DataFrame:
    """(name, pivot) pairs of sets that share a signature and that sizes and sketches leave open, from
    (signature, rows, name, label, n, sketch): a spanning forest of each block, or all of two labels.

    A signature of more than BLOCK_SETS sets is cut into blocks, and each pair of blocks meets in one
    place, so no task holds more than two blocks whatever the signature.
    """
    cut = F.greatest(F.lit(1), F.ceil(F.col("rows") / BLOCK_SETS)).cast("int")
    placed = members.withColumn("cut", cut).withColumn("own", F.pmod(F.xxhash64("name"), F.col("cut")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    keyed = spread.select("signature", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "name", "label", "n", "sketch")
    dealt = keyed.repartition("signature", "i", "j").sortWithinPartitions("signature", "i", "j", "name")

    def settle(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        names = [r[4] for r in rows]
        distance = _open_pairs(np.array([r[6] for r in rows]), np.frombuffer(b"".join(r[7] for r in rows), dtype=np.uint64).reshape(len(rows), -1), percent)
        np.fill_diagonal(distance, _FAR)
        if tree:
            edges = _spanning(distance)
        else:
            labels, own = np.array([r[5] for r in rows]), np.array([r[3] for r in rows])
            apart = (labels[:, None] != labels[None, :]) & np.triu(np.ones(distance.shape, dtype=bool))
            if rows[0][1] != rows[0][2]:
                apart &= own[:, None] != own[None, :]
            edges = zip(*np.nonzero(apart & (distance < _FAR)), strict=True)
        for a, b in edges:
            if names[a] != names[b]:
                yield min(names[a], names[b]), max(names[a], names[b])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        found: set[tuple[int, int]] = set()
        for batch in trimmed(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:3] != held[0][:3]:
                    found.update(settle(held))
                    held = []
                held.append(row)
            if len(found) > 100_000:
                yield _pair_rows(found)
                found = set()
        if held:
            found.update(settle(held))
        yield _pair_rows(found)

    return dealt.mapInArrow(compare, "name bigint, pivot bigint").distinct()


def _pair_rows(found: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["name", "pivot"])


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, row_key) of every row: the size of its set of `width`-word
    shingles (A-Z lowered, words between ASCII blanks), and the smallest id reachable over pairs whose
    sets have 100 * shared >= percent * joint; row_key is xxhash64 of id and text. Rows without words are
    linked with nothing, equal sets are linked; null ids stay null and give no component its name unless
    there is no other."""
    return linked_rows(docs, doc_id, text, percent, width).drop("label")


def linked_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """The rows of `similar_groups` with `label`, which is the same for linked rows only, whatever their
    ids, and null without words."""
    text_batches()
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.col(text)).alias("rep"))
    base = source.select("doc_id", "rep", classes(F.col("text"), width).alias("set")).select("doc_id", "rep", "set.n", "set.name", "set.sketch")
    base = stable(base)
    known = base.where("n > 0").groupBy("name").agg(F.min("rep").alias("rep"), F.min("n").alias("n"), F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("sketch").alias("sketch"))
    known = stable(known)
    base = base.select("doc_id", "rep", "n", "name")
    keyed = source.select("rep", "text")

    group = Window.partitionBy("signature")
    met = signature_rows(source, "text", percent, width).select("signature", "name", F.min("name").over(group).alias("first"), F.max("name").over(group).alias("last"), F.count(F.lit(1)).over(group).alias("rows"))
    met = stable(met.where("first <> last").select("signature", "name", "rows").distinct())
    members = met.join(broadcast_if_small(stable(known.select("name", "n", "sketch").join(met.select("name").distinct(), "name", "left_semi")), bytes_each=SKETCH_BITS // 8), "name")

    tree = stable(_block_pairs(members.withColumn("label", F.lit(0).cast("bigint")), percent, True))
    links = _verified(tree, known, keyed, percent, width)
    labels = connected_components(links)

    # What is left: pairs that share a signature and are in no common component so far.
    placed = members.join(broadcast_if_small(labels.withColumnRenamed("node", "name")), "name", "left").withColumn("label", F.coalesce("label", "name"))
    mixed = placed.groupBy("signature").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("signature")
    rest = _block_pairs(placed.join(mixed, "signature", "left_semi"), percent, False).join(tree, ["name", "pivot"], "left_anti")
    rest = stable(rest)
    if not rest.isEmpty():
        more = _verified(rest, known, keyed, percent, width)
        if not more.isEmpty():
            labels = connected_components(links.unionByName(more))

    linked = labels.join(known.select(F.col("name").alias("node"), "low"), "node")
    lowest = linked.groupBy("label").agg(F.min("low").alias("component_id"))
    of_linked = linked.join(lowest, "label").select(F.col("node").alias("name"), "component_id", "label")
    of_copies = known.where("copies > 1").select("name", F.col("low").alias("own"))
    named = of_copies.join(of_linked, "name", "full").select("name", F.coalesce("component_id", "own").alias("component_id"), "label")
    out = base.join(broadcast_if_small(stable(named)), "name", "left")
    component = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("rep").alias("row_key"), F.coalesce("label", "name").alias("label"))
