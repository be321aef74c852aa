"""Exact removal of long repeated byte strings, by deep-shallow suffix sorting.

Where a `length`-byte string stands twice, the leftmost smallest `GRAM`-byte hash within it stands at the
same place of both. So each start of such a string belongs to one anchor, the position of that minimum,
and two equal strings have equal anchors. Anchors that occur once drop out; those whose whole context
(the bytes of all the starts they own) is equal are repeated from end to end; the suffixes of the other
contexts are sorted group by group of one anchor hash: a multikey quicksort by eight-byte symbols down to
a shallow depth, blind tries for the groups that share all of it. Equal neighbours up to `length` bytes
are repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.llm.batches import text_batches, trimmed
from specloom.llm.jaccard import mix
from specloom.llm.joins import broadcast_if_small, row_key, without
from specloom.session import stable

LENGTH = 400
# Bytes of an anchor as a share of the length.
GRAM = 0.5
# Depth of the multikey quicksort.
SHALLOW = 64
# Bytes hashed at a time, and starts sorted at a time; they bound the memory of a task.
BLOCK = 1 << 18
SORT_STARTS = 400_000
# Anchors of a task that are combined before they are sent on.
COMBINED = 300_000
# Groups of more different contexts are settled start by start, by hash aggregation.
HOT_CONTEXTS = 20_000

_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Hashes of substrings from prefix sums, modulo 2**64."""

    def __init__(self, raw: np.ndarray, up: np.ndarray, down: np.ndarray):
        self.sums = np.zeros(raw.size + 1, dtype=np.uint64)
        np.cumsum(_VALUES[raw] * up[: raw.size], dtype=np.uint64, out=self.sums[1:])
        self.down = down

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, size: int) -> np.ndarray:
        return mix((self.sums[size:] - self.sums[:-size]) * self.down[: self.sums.size - size])


class Anchors:
    """Anchors of one text: position, first and last start that it owns, hash, hash of its context."""

    def __init__(self, length: int = LENGTH, gram: int | None = None):
        self.length = length
        self.gram = gram or max(1, int(length * GRAM))
        self.window = length - self.gram + 1
        size = max(BLOCK, 4 * length)
        self.size = size
        self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)

    def _lowest(self, keys: np.ndarray) -> np.ndarray:
        """Position of the smallest key in each window, the leftmost of several."""
        w, n = self.window, keys.size
        # The high bits of a key rank it, the low bits hold its position and so break ties.
        bits = np.uint64(int(n).bit_length())
        tagged = (keys >> bits << bits) | np.arange(n, dtype=np.uint64)
        full = np.full(-(-n // w) * w, np.uint64(2**64 - 1), dtype=np.uint64)
        full[:n] = tagged
        rows = full.reshape(-1, w)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        return (np.minimum(back[: n - w + 1], ahead[w - 1 : n]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)

    def of(self, raw: np.ndarray) -> np.ndarray:
        """Rows (position, low, high, hash, context hash) of a text, as one int64 array."""
        found = []
        at = 0
        # Blocks overlap by a window, so every start is seen in one of them.
        while raw.size - at >= self.length:
            part = raw[at : at + self.size]
            hasher = Hasher(part, self.up, self.down)
            grams = hasher.grams(self.gram)
            lowest = self._lowest(grams)
            first = np.flatnonzero(np.append(True, lowest[1:] != lowest[:-1]))
            last = np.append(first[1:], lowest.size) - 1
            place = lowest[first]
            shape = ((place - first) * (2 * self.length) + (last - first)).astype(np.uint64)
            context = mix(hasher.of(first, last + self.length) + shape)
            found.append(np.stack([place + at, first + at, last + at, grams[place].astype(np.int64), context.astype(np.int64)]))
            at += part.size - self.length + 1
        return np.concatenate(found, axis=1) if found else np.zeros((5, 0), dtype=np.int64)


_ANCHOR = "t1 bigint, t2 bigint, rep bigint, place bigint, low bigint, high bigint, gram bigint, context bigint, copies bigint"


def _settled(rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the anchor rows of a batch (columns as in _ANCHOR) one for each context, with the number of its
    copies, and what is settled already: the covered spans of contexts with several, as rows of no copies.
    """
    order = np.lexsort((rows[4], rows[2], rows[7], rows[6]))
    rows = rows[:, order]
    first = np.append(True, (rows[6:8, 1:] != rows[6:8, :-1]).any(axis=0)) if order.size else np.zeros(0, dtype=bool)
    begin = np.flatnonzero(first)
    copies = np.add.reduceat(rows[8], begin) if begin.size else begin
    often = np.repeat(copies > 1, np.diff(np.append(begin, order.size)))
    spans = rows[:, often]
    spans = spans[:, np.lexsort((spans[4], spans[1], spans[0]))]
    # Spans of one text that touch become one; no text has a span that begins below the one before.
    text = np.cumsum(np.append(True, (spans[:2, 1:] != spans[:2, :-1]).any(axis=0))) if spans.shape[1] else np.zeros(0, dtype=np.int64)
    reach = text * (1 << 40) + spans[5] + length
    far = np.maximum.accumulate(reach) if reach.size else reach
    new = np.append(True, (text * (1 << 40) + spans[4])[1:] > far[:-1]) if reach.size else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    merged = spans[:, at]
    if at.size:
        merged[5] = np.maximum.reduceat(far, at) - text[at] * (1 << 40) - length
        merged[6], merged[8] = merged[0] ^ merged[4], 0
    witnesses = rows[:, begin]
    witnesses[8] = copies
    return witnesses, merged


def anchor_rows(keyed: DataFrame, length: int) -> DataFrame:
    """Anchors of all texts of (t1, t2, rep, text), combined within a task: one row for each context,
    however often it occurs there, and rows without copies and context for the spans of those repeated."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        found: list[np.ndarray] = []
        held = 0
        for batch in trimmed(batches):
            names = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            seen: dict[tuple[int, int], list] = {}
            for i, (t1, t2, rep) in enumerate(names):
                seen.setdefault((t1, t2), [i, rep, 0])[2] += 1
            texts = batch.column(3)
            for (t1, t2), (i, rep, copies) in seen.items():
                text = texts[i].as_py()
                if text is None:
                    continue
                rows = anchors.of(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8))
                n = rows.shape[1]
                found.append(np.vstack([np.full((1, n), t1), np.full((1, n), t2), np.full((1, n), rep), rows, np.full((1, n), copies)]))
                held += n
            if held > COMBINED:
                yield from settled(found)
                found, held = [], 0
        yield from settled(found)

    def settled(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if found:
            witnesses, spans = _settled(np.concatenate(found, axis=1), length)
            yield rows_of(witnesses, np.zeros(witnesses.shape[1], dtype=bool))
            yield rows_of(spans, np.ones(spans.shape[1], dtype=bool))

    def rows_of(rows: np.ndarray, bare: np.ndarray) -> pa.RecordBatch:
        names = [c.split()[0] for c in _ANCHOR.split(", ")]
        columns = [pa.array(r, pa.int64(), mask=bare) if n == "context" else pa.array(r, pa.int64()) for n, r in zip(names, rows, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    return keyed.select("t1", "t2", "rep", "text").mapInArrow(scan, _ANCHOR)


class Trie:
    """Blind trie of equally long strings: inner nodes know only the depth and byte at which their
    strings part; a string goes down blindly, meets one leaf, and their common prefix gives its place."""

    def __init__(self) -> None:
        self.root: list | None = None  # [depth, {byte: node}] or a leaf [string, members]

    def add(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = [string, [member]]
            return
        node = self.root
        while type(node[0]) is int:
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        if node[0] == string:
            node[1].append(member)
            return
        shared = common_prefix(node[0], string)
        above, node = None, self.root
        while type(node[0]) is int and node[0] < shared:
            above, node = node, node[1][string[node[0]]]
        if type(node[0]) is int and node[0] == shared:
            node[1][string[shared]] = [string, [member]]
            return
        probe = node
        while type(probe[0]) is int:
            probe = next(iter(probe[1].values()))
        inner = [shared, {probe[0][shared]: node, string[shared]: [string, [member]]}]
        if above is None:
            self.root = inner
        else:
            above[1][string[above[0]]] = inner

    def ordered(self) -> Iterator[list[int]]:
        """Members of equal strings, in the order of the strings."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if type(node[0]) is int:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node[1]


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def repeated(data: bytes, starts: np.ndarray, groups: np.ndarray, length: int, shallow: int = SHALLOW) -> np.ndarray:
    """Which suffixes of `data`, cut at `length` bytes, have an equal one in their group."""
    out = np.zeros(starts.size, dtype=bool)
    shallow = min(shallow, length) // 8 * 8
    words = np.ndarray((max(0, len(data) - 7),), dtype=">u8", buffer=data, strides=(1,))
    order = np.argsort(groups, kind="stable")
    head = np.append(True, np.diff(groups[order]) != 0) if order.size else np.zeros(0, dtype=bool)
    order, head = _several(order, head)
    for depth in range(0, shallow, 8):
        if not order.size:
            break
        key = words[starts[order] + depth].astype(np.uint64)
        run = np.cumsum(head) - 1
        first = key[np.flatnonzero(head)][run]
        odd = np.zeros(int(run[-1]) + 1, dtype=bool)
        odd[run[key != first]] = True
        if odd.any():
            # Groups with more than one symbol here are partitioned by it, all at once.
            at = np.flatnonzero(odd[run])
            by = np.lexsort((key[at], run[at]))
            order[at] = order[at][by]
            key[at] = key[at][by]
            head = head | np.append(False, (run[1:] == run[:-1]) & (key[1:] != key[:-1]))
            order, head = _several(order, head)
    if not order.size:
        return out
    sizes = np.diff(np.append(np.flatnonzero(head), order.size))
    # A trie of two leaves is one comparison, done for all such groups side by side.
    two = np.flatnonzero(head)[sizes == 2]
    a, b = order[two], order[two + 1]
    for depth in [*range(shallow, length - 7, 8), length - 8]:
        if depth < 0 or not a.size:
            break
        same = words[starts[a] + depth] == words[starts[b] + depth]
        a, b = a[same], b[same]
    if length < 8:
        same = np.array([data[x : x + length] == data[y : y + length] for x, y in zip(starts[a], starts[b], strict=True)], dtype=bool)
        a, b = a[same], b[same]
    out[a] = out[b] = True
    for begin, n in zip(np.flatnonzero(head)[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        trie = Trie()
        own = order[begin : begin + n].tolist()
        for i, p in zip(own, starts[order[begin : begin + n]].tolist(), strict=True):
            trie.add(data[p + shallow : p + length], i)
        for members in trie.ordered():
            if len(members) > 1:
                out[members] = True
    return out


def _several(order: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the groups of one."""
    if not order.size:
        return order, head
    begin = np.flatnonzero(head)
    keep = np.repeat(np.diff(np.append(begin, order.size)) > 1, np.diff(np.append(begin, order.size)))
    return order[keep], head[keep]


def _sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """(t1, t2, low, high): runs of repeated starts, of contexts that meet in their anchor's hash."""
    dealt = contexts.repartition("gram").sortWithinPartitions("gram")
    names = ["gram", "t1", "t2", "place", "low", "bytes"]

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        data = b"".join(r[5] for r in rows)
        counts = np.array([len(r[5]) - length + 1 for r in rows])
        offsets = np.cumsum([0, *(len(r[5]) for r in rows)])[:-1]
        total = np.cumsum(counts)
        inside = np.arange(int(total[-1])) - np.repeat(total - counts, counts)
        starts = np.repeat(offsets, counts) + inside
        grams = np.unique(np.array([r[0] for r in rows]), return_inverse=True)[1]
        # Equal strings lie equally far before their anchor.
        ahead = np.repeat(np.array([r[3] - r[4] for r in rows]), counts) - inside
        hit = repeated(data, starts, np.repeat(grams, counts) * (length + 1) + ahead, length)
        owner = np.repeat(np.arange(len(rows)), counts)
        edge = np.flatnonzero(hit)
        new = np.append(True, (np.diff(edge) != 1) | (owner[edge][1:] != owner[edge][:-1])) if edge.size else np.zeros(0, dtype=bool)
        first = edge[new]
        last = edge[np.append(np.flatnonzero(new)[1:], edge.size) - 1] if edge.size else first
        own = owner[first]
        base = np.array([r[4] for r in rows])
        columns = [np.array([r[k] for r in rows], dtype=np.int64)[own] for k in (1, 2)] + [base[own] + inside[first], base[own] + inside[last]]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["t1", "t2", "low", "high"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in trimmed(batches):
            for row in zip(*(batch.column(i).to_pylist() for i in range(len(names))), strict=True):
                if held >= SORT_STARTS and row[0] != rows[-1][0]:
                    yield settle(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[5]) - length + 1
        if rows:
            yield settle(rows)

    return dealt.select(*names).mapInArrow(sort, "t1 bigint, t2 bigint, low bigint, high bigint")


def _counted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same for groups too large to sort in one place: every start for itself, its string by hash."""
    each = contexts.select("gram", "t1", "t2", "low", "bytes", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)).alias("i"))
    string = F.expr(f"substring(bytes, i + 1, {length})")
    named = each.select("t1", "t2", (F.col("low") + F.col("i")).alias("low"), F.xxhash64(string).alias("h1"), F.xxhash64(F.lit(5), string).alias("h2"))
    often = named.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    return named.join(often, ["h1", "h2"]).select("t1", "t2", "low", F.col("low").alias("high"))


def repeated_spans(keyed: DataFrame, length: int = LENGTH, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(t1, t2, spans): for each text of (t1, t2, rep, text) that holds a repeated string, the maximal runs
    of covered bytes as array<struct<begin, end>>, in order, end excluded."""
    by_gram, by_context = Window.partitionBy("gram"), Window.partitionBy("gram", "context")
    anchors = anchor_rows(keyed, length)
    # Copies of a context: texts, and places within one.
    inner = anchors.withColumn("times", F.sum("copies").over(by_context)).withColumn("witness", F.min(F.struct("rep", "low")).over(by_context))
    inner = inner.withColumn("lead", (F.col("witness.rep") == F.col("rep")) & (F.col("witness.low") == F.col("low")))
    both = inner.withColumn("all", F.sum("copies").over(by_gram)).withColumn("lo", F.min("context").over(by_gram)).withColumn("hi", F.max("context").over(by_gram))
    both = both.withColumn("kinds", F.sum(F.col("lead").cast("int")).over(by_gram))
    done = F.col("copies") == 0
    shared = stable(both.where((F.col("all") > 1) | done).select("t1", "t2", "rep", "place", "low", "high", "gram", ((F.col("times") > 1) | done).alias("whole"), (~done & (F.col("lo") != F.col("hi")) & F.col("lead")).alias("sort"), F.when(done, 0).otherwise(F.col("kinds")).alias("kinds")))

    asked = shared.where("sort").groupBy("rep").agg(F.collect_set(F.struct("gram", "place", "low", "high", "kinds")).alias("places"))
    sent = keyed.join(broadcast_if_small(stable(asked), "places"), "rep").select("t1", "t2", F.col("text").cast("binary").alias("raw"), F.explode("places").alias("p"))
    contexts = sent.select("t1", "t2", "p.gram", "p.place", "p.low", "p.kinds", F.expr(f"substring(raw, int(p.low) + 1, int(p.high - p.low) + {length})").alias("bytes"))
    spans = shared.where("whole").select("t1", "t2", "low", "high").unionByName(_sorted_spans(contexts.where(F.col("kinds") <= hot_contexts), length))
    if not shared.where(F.col("kinds") > hot_contexts).isEmpty():
        spans = spans.unionByName(_counted_spans(contexts.where(F.col("kinds") > hot_contexts), length))

    spans = spans.select("t1", "t2", F.col("low").alias("begin"), (F.col("high") + length).alias("end")).distinct()
    text = Window.partitionBy("t1", "t2").orderBy("begin", "end")
    reach = F.max("end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("new", F.when(reach >= F.col("begin"), 0).otherwise(1)).withColumn("run", F.sum("new").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("t1", "t2", "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return runs.groupBy("t1", "t2").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def _kept(text: Column, spans: Column) -> Column:
    @F.arrow_udf("binary")
    def kept(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, spans in texts:
            out = []
            for t, own in zip(text.cast(pa.binary()).to_pylist(), spans.to_pylist(), strict=True):
                parts, at = [], 0
                for s in own or []:
                    parts.append(t[at : s["begin"]])
                    at = s["end"]
                out.append(None if t is None else b"".join([*parts, t[at:]]))
            yield pa.array(out, pa.binary())

    return kept(text, spans)


def dedup_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """All rows and columns, with `spans` (array<struct<begin, end>>: maximal runs of bytes covered by a
    `length`-byte string that starts elsewhere too, in this or another row; end excluded) and `kept`
    (binary: the other bytes). Strings are judged on the UTF-8 bytes of the input and never cross rows;
    every copy goes. Null texts have no spans and stay null; input columns of these names are replaced."""
    if length < 16:
        raise ValueError("length must be at least 16")
    text_batches()
    docs = without(docs, "spans", "kept", "t1", "t2", "rep")
    names = [f"`{c}`" for c in docs.columns]
    texts = docs.select(F.col(f"`{text}`").alias("text"), F.xxhash64(*[F.col(n) for n in names]).alias("rep")).select(*[c.alias(n) for c, n in zip(row_key(F.col("text")), ("t1", "t2"), strict=True)], "rep", "text")
    found = stable(repeated_spans(texts, length, hot_contexts))
    keyed = docs.select("*", *[c.alias(n) for c, n in zip(row_key(F.col(f"`{text}`")), ("t1", "t2"), strict=True)])
    both = keyed.join(broadcast_if_small(found, "spans"), ["t1", "t2"], "left")
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    return both.select(*names, F.coalesce("spans", none).alias("spans"), _kept(F.col(f"`{text}`"), F.col("spans")).alias("kept"))
