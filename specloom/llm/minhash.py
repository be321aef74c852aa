"""MinHash fingerprints of texts, their likeness, and groups of near copies by bands.

A shingle is hashed to 32 bits; x -> a * x + b modulo 2**32 with odd a permutes those, and the smallest
value under each of `PERMUTATIONS` such permutations, cut to its lower 16 bits, makes the fingerprint. The
share of equal places in two fingerprints estimates the Jaccard similarity of the shingle sets.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.llm.batches import text_batches, trimmed
from specloom.llm.components import connected_components, linked_labels
from specloom.llm.jaccard import shingle_sets
from specloom.llm.joins import broadcast_if_small, row_key, shuffled
from specloom.session import stable, written

WIDTH = 5
PERMUTATIONS = 128
SEED = 20
# Rows of the signature in a band. A pair of similarity 0.8 shares none of the 32 bands with a probability
# of (1 - 0.8**4)**32, or 5e-8.
BAND_ROWS = 4
PERCENT = 80
# Shingles that meet all permutations at a time; bounds the memory of a task.
BLOCK = 1 << 13


class MinHash:
    def __init__(self, permutations: int = PERMUTATIONS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 31, permutations, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 1 << 32, permutations, dtype=np.uint32)[:, None]
        self.room = np.empty((permutations, BLOCK), dtype=np.uint32)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Smallest value of each permutation over 64-bit hashes of shingles, as 16 bits."""
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(self.a.shape[0], np.uint32(2**32 - 1))
        for at in range(0, x.size, BLOCK):
            part = x[None, at : at + BLOCK]
            room = self.room[:, : part.size]
            np.multiply(self.a, part, out=room)
            np.add(room, self.b, out=room)
            np.minimum(low, room.min(axis=1), out=low)
        return (low & np.uint32(0xFFFF)).astype(">u2")

    def signatures(self, texts: list[str | None], width: int = WIDTH) -> list[np.ndarray | None]:
        """One signature for each text, None for a text without words."""
        return [self.signature(s) if s.size else None for s in shingle_sets(texts, width)]


def printed(signature: np.ndarray | None) -> str:
    """Fingerprint of a signature: four hex digits for each permutation; empty for a text without words."""
    return "" if signature is None else signature.tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Share of equal places; two texts without words are alike, one of them and another text are not."""
    if a is None or b is None:
        return 1.0 if a is b else 0.0
    return float(np.count_nonzero(a == b)) / a.size


def edited(text: str, following: str) -> str:
    """The text with its last floor(n / 2) code points replaced by the first as many of the following one,
    or by all of it where that is shorter."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _order(doc_id: int | None, h1: int, h2: int) -> tuple:
    return (doc_id is not None, doc_id or 0, h1, h2)


def next_fingerprints(docs: DataFrame, width: int = WIDTH, permutations: int = PERMUTATIONS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of
    documents (doc_id, text): fingerprints of each text and of the text `edited` with the next document's,
    and the likeness of the text's to the edited one's and to the next document's.

    The next document is that of the next higher doc_id, after the last the first; null ids come first,
    equal ids are ordered by a hash of their texts. Null texts count as empty. The only document follows
    itself; no rows give no rows. Texts are shuffled once, to ranges of doc_id whose bounds, one for each
    shuffle partition, were found on ids and hashes alone; the first document of a range is also sent to
    the range before. A task holds two texts at a time. Rows equal in id and text share a range.
    """
    text_batches()
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    h1, h2 = row_key(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", h1.alias("h1"), h2.alias("h2"))
    keys = ["doc_id", "h1", "h2"]
    ranged = rows.select(*keys).repartitionByRange(parts, *keys).groupBy(F.spark_partition_id().alias("part"))
    bounds = sorted({_order(*r.low) for r in ranged.agg(F.min(F.struct(*keys)).alias("low")).collect()})

    @F.arrow_udf("array<int>")
    def ranges(ids: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        out = []
        for key in map(_order, ids.to_pylist(), h1.to_pylist(), h2.to_pylist()):
            k = bisect_right(bounds, key) - 1
            # A range is a number; the same less one, negative, marks what only ends the range.
            out.append([k, -1 - (k - 1) % len(bounds)] if bounds[k] == key else [k])
        return pa.array(out, pa.list_(pa.int32()))

    dealt = rows.withColumn("at", F.explode(ranges(*map(F.col, keys))))
    part = F.when(F.col("at") < 0, -1 - F.col("at")).otherwise(F.col("at"))
    dealt = dealt.select(part.alias("part"), (F.col("at") < 0).alias("after"), "doc_id", "h1", "h2", "text")
    dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "after", *keys)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(permutations)
        last: tuple | None = None
        for batch in trimmed(batches):
            read = [batch.column(c).to_pylist() for c in ("part", "after", "doc_id", "text")]
            known = hasher.signatures(read[3], width)
            rows = [(*r, s) for r, s in zip(zip(*read, strict=True), known, strict=True)]
            follow = [(a, b) for a, b in zip([last, *rows], rows) if a is not None and a[0] == b[0] and not a[1]]
            last = rows[-1] if rows else last
            changed = [edited(a[3], b[3]) for a, b in follow]
            marks = hasher.signatures(changed, width)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[2] for a, _ in follow], pa.int64()),
                    pa.array([len(a[3]) for a, _ in follow], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
                    pa.array([printed(a[4]) for a, _ in follow], pa.string()),
                    pa.array([printed(m) for m in marks], pa.string()),
                    pa.array([likeness(a[4], m) for (a, _), m in zip(follow, marks, strict=True)], pa.float64()),
                    pa.array([likeness(a[4], b[4]) for a, b in follow], pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    kinds = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("part", "after", "doc_id", "text").mapInArrow(pairs, kinds)


def signature_column(text: Column, width: int = WIDTH, permutations: int = PERMUTATIONS) -> Column:
    """binary: the signature of a text column, two bytes for each permutation; null without words."""
    text_batches()

    @F.arrow_udf("binary")
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = MinHash(permutations)
        for batch in trimmed(batches):
            yield pa.array([None if s is None else s.tobytes() for s in hasher.signatures(batch.to_pylist(), width)], pa.binary())

    return signed(text)


def _similar(left: Column, right: Column, percent: int, width: int) -> Column:
    """Whether the shingle sets of two texts have at least this similarity, exactly."""

    @F.arrow_udf("boolean")
    def close(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            out = []
            # Rows come by the right text, which is hashed once for all of a run.
            held, own = None, None
            for x, s in zip(b.to_pylist(), shingle_sets(a.to_pylist(), width), strict=True):
                if x != held or own is None:
                    held, own = x, next(shingle_sets([x], width))
                both = np.intersect1d(s, own, assume_unique=True).size
                out.append(bool(both) and 100 * both >= percent * (s.size + own.size - both))
            yield pa.array(out, pa.bool_())

    return close(left, right)


def near_groups(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, permutations: int = PERMUTATIONS) -> DataFrame:
    """(doc_id, class_id, n_links) of each row of documents (doc_id, text): the smallest doc_id of its
    group of near copies, and with how many different texts a verified link was found.

    Texts that share a band of the signature meet the band's leader, and pairs whose shingle sets have at
    least this similarity are linked. Bands whose texts then still belong to several groups get another
    leader, until a round finds no new link; every row of a band takes part in one comparison a round,
    however many share the band. No pair meets twice in a band, and a band whose pairs have all met is left out. Equal texts are one text. Texts without words are alone; null ids take
    part and come last in a class; no rows give no rows.
    """
    k1, k2 = row_key(F.col("text"))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), k1.alias("k1"), k2.alias("k2"), "text")
    signed = keyed.select("k1", "k2", "doc_id", signature_column(F.col("text"), width, permutations).alias("signature"))
    # Numbers are given to what is already written, so every later reading gives the same ones.
    texts = stable(signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature")))
    texts = texts.withColumn("text_id", F.monotonically_increasing_id())
    size = 2 * BAND_ROWS
    band = F.expr(f"transform(sequence(0, {permutations // BAND_ROWS - 1}), i -> xxhash64(i, substring(signature, i * {size} + 1, {size})))")
    bands = texts.where("signature is not null").select("text_id", F.explode(band).alias("band"))
    often = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    shared = stable(bands.join(often, "band"))

    # `led`: whether the text has led its band in an earlier turn, so has met all its other texts.
    members = shared.withColumn("led", F.lit(False))
    links = labels = None
    turn = 0
    while True:
        now = members.withColumn("label", F.col("text_id"))
        if labels is not None:
            now = members.join(shuffled(labels.withColumnRenamed("node", "text_id")), "text_id", "left").withColumn("label", F.coalesce("label", "text_id"))
            # A band with less than two groups of texts that have not led has no pair left, nor will it have one.
            left = F.when(~F.col("led"), F.col("label"))
            open_ = now.groupBy("band").agg(F.min(left).alias("lo"), F.max(left).alias("hi")).where("lo <> hi").select("band")
            now = written(now.join(shuffled(open_), "band"))
        leader = F.min(F.struct(F.xxhash64(F.lit(turn), F.col("band"), F.col("text_id")).alias("rank"), "text_id", "label", "led"))
        leaders = written(now.groupBy("band").agg(leader.alias("leader")).select("band", *[F.col(f"leader.{c}").alias(f"lead_{c}") for c in ("text_id", "label", "led")]))
        led = now.join(shuffled(leaders), "band")
        met = led.where("label <> lead_label and not led and not lead_led")
        # Each pair once, whichever of the two leads.
        pairs = written(met.select(F.least("text_id", "lead_text_id").alias("a"), F.greatest("text_id", "lead_text_id").alias("b")).distinct())
        found = written(_verified(keyed, texts, pairs, percent, width))
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        labels = connected_components(found) if labels is None else linked_labels(labels, found)
        members = led.select("text_id", "band", (F.col("led") | (F.col("text_id") == F.col("lead_text_id"))).alias("led"))
        turn += 1

    rows = keyed.select("doc_id", "k1", "k2")
    if links is None:
        alone = texts.select("k1", "k2", F.col("doc_id").alias("class_id"))
        return rows.join(alone, ["k1", "k2"]).select("doc_id", "class_id", F.lit(0).cast("bigint").alias("n_links"))
    counts = links.select(F.explode(F.array("a", "b")).alias("text_id")).groupBy("text_id").agg(F.count(F.lit(1)).alias("n_links"))
    known = texts.select("k1", "k2", "text_id", "doc_id").join(shuffled(labels.withColumnRenamed("node", "text_id")), "text_id", "left").join(shuffled(counts), "text_id", "left")
    known = known.withColumn("label", F.coalesce("label", "text_id"))
    lowest = known.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    named = known.join(shuffled(lowest), "label").select("k1", "k2", "class_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
    return rows.join(named, ["k1", "k2"]).select("doc_id", "class_id", "n_links")


def _verified(keyed: DataFrame, texts: DataFrame, pairs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) of text ids whose texts are similar; one row of each text is read."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("text_id")).distinct()
    one = broadcast_if_small(stable(texts.join(wanted, "text_id").select("k1", "k2", "text_id", F.col("doc_id").alias("lowest"))))
    known = keyed.join(one, ["k1", "k2"]).where(F.col("doc_id").eqNullSafe(F.col("lowest"))).dropDuplicates(["text_id"])
    left = known.select(F.col("text_id").alias("a"), F.col("text").alias("left"))
    right = known.select(F.col("text_id").alias("b"), F.col("text").alias("right"))
    met = pairs.join(shuffled(left), "a").join(shuffled(right), "b")
    return met.where(_similar(F.col("left"), F.col("right"), percent, width)).select("a", "b")
