"""Benchmark decontamination by SimHash over item-sized windows.

A window of a document is proposed where one of its five-word shingles lines up with the same shingle
of an item; sampled positions suffice, as a window that is similar enough shares more shingles than the
positions between two samples. The SimHash of each window meets those of the items of its size in
`RADIUS + 1` blocks of bits, of which two fingerprints within the radius share one at least. What is
within the radius is verified by exact weighted-shingle similarity. Windows whose weight lies on few
shingles have unsteady fingerprints: they meet the items by their shingles instead and are verified
likewise. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.llm.joins import broadcast_if_small, row_key
from specloom.session import stable

SHINGLE = 5
SIMILARITY = 0.8
# Two sets of similarity 0.8 differ in 9.7 of 64 bits on average, with a deviation of 2.9.
RADIUS = 20
# A window counts as made of few shingles below this many, each weighed by its share of the window.
FEW = 16
BITS = 64
BLANK = " \t\n\r\x0b\x0c"


def words_of(text: Column) -> Column:
    """Lower-cased words between blanks; none for null."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANK))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def shingle_at(words: Column, i: Column, width: int) -> Column:
    """Hash of `width` words from position i, counted from 0."""
    return F.xxhash64(*[F.get(words, i + j) for j in range(width)])


def _positions(n: Column, width: int, stride: int) -> Column:
    return F.when(n >= width, F.sequence(F.lit(0), n - width, F.lit(stride))).otherwise(F.array().cast("array<int>"))


def _shingles(words: Column, width: int, stride: int = 1) -> Column:
    """array<struct<pos, hash>> of the shingles at every `stride`-th position."""
    return F.transform(_positions(F.size(words), width, stride), lambda i: F.struct(i.alias("pos"), shingle_at(words, i, width).alias("hash")))


def _stride(fewest: int, similarity: float) -> int:
    """Largest distance of sampled positions that no similar window slips through: with similarity s, at
    most (1 - s) / (1 + s) of a window's t shingles are not the item's, and of t consecutive positions
    more than that are sampled."""
    missed = (1 - similarity) / (1 + similarity)
    return max(s for s in range(1, 9) if s == 1 or (fewest - s + 1) / s > missed * fewest + 1e-9)


def simhash(shingles: DataFrame, *keys: str) -> DataFrame:
    """64-bit fingerprint of each group's `hash` values, a repeated value counting as often as it occurs."""
    ones = [F.sum(F.getbit("hash", F.lit(b))).alias(f"b{b}") for b in range(BITS)]
    counted = shingles.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_shingles"), *ones)
    bits = [F.when(2 * F.col(f"b{b}") > F.col("n_shingles"), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint")) for b in range(BITS)]
    whole = bits[0]
    for b in bits[1:]:
        whole = whole.bitwiseOR(b)
    return counted.select(*keys, whole.alias("print"))


def blocks_of(fingerprint: Column, radius: int = RADIUS) -> Column:
    """array<struct<block, value>>: the bits cut into radius + 1 runs."""
    cuts = [BITS * i // (radius + 1) for i in range(radius + 2)]
    runs = zip(cuts, cuts[1:], strict=False)
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND((1 << (b - a)) - 1).alias("value")) for i, (a, b) in enumerate(runs)])


def _item_key(words: Column) -> list[Column]:
    """Key of an item's text, whatever its ids."""
    return [k.alias(name) for k, name in zip(row_key(words), ("t1", "t2"), strict=True)]


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, n_words, start, similarity): for each document and item the most similar
    item-sized window, the earliest of several, where the similarity is at least `similarity`.

    Similarity is weighted Jaccard: shared over joint shingles, each as often as it occurs. An item of
    less than five words is one shingle; a document shorter than an item is one window. Items and
    documents without words have no leak, rows without an id neither; equal rows count once. Different
    texts of one id are compared each for itself, and the best window of all of them is given.
    """
    named = items.where(F.col(item_id).isNotNull())
    owners = named.select(F.col(item_id).alias("item_id"), *_item_key(words_of(F.col(text)))).distinct()
    found = passages(docs.where(F.col(doc_id).isNotNull()), named, doc_id, text, similarity, radius)
    owned = found.join(broadcast_if_small(owners), ["t1", "t2"])
    best = owned.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_words", (-F.col("best.back")).cast("int").alias("start"), F.col("best.similarity").alias("similarity"))


def passages(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(k1, k2, doc_id, t1, t2, n_words, start, similarity): the windows of `leaks` before the best is
    taken, for each document row, keyed by `row_key` of id and text, and each different text of the
    items, keyed by its words; ids may be null."""
    wide = F.col("words")
    source = items.select(words_of(F.col(text)).alias("words")).select(*_item_key(wide), "words", F.size("words").alias("n")).where("n > 0")
    source = stable(source.distinct())
    lengths = source.agg(F.min(F.when(F.col("n") >= SHINGLE, F.col("n"))).alias("least"), F.collect_set(F.when(F.col("n") < SHINGLE, F.col("n"))).alias("short")).first()
    widths = {w: 1 for w in lengths.short}  # at most four
    if lengths.least is not None:
        widths[SHINGLE] = _stride(lengths.least - SHINGLE + 1, similarity)

    def item_shingles(width: int) -> DataFrame:
        own = source.where(F.col("n") == width if width < SHINGLE else F.col("n") >= SHINGLE)
        return own.select("t1", "t2", "n", F.lit(width).alias("width"), F.inline(_shingles(wide, width)))

    base = docs.select(*row_key(F.col(doc_id), F.col(text)), F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("words"))
    if not widths:
        return docs.sparkSession.createDataFrame([], f"k1 bigint, k2 bigint, doc_id {docs.schema[doc_id].dataType.simpleString()}, t1 bigint, t2 bigint, n_words int, start int, similarity double")
    of_items = item_shingles(min(widths))
    for width in sorted(widths)[1:]:
        of_items = of_items.unionByName(item_shingles(width))
    of_items = stable(of_items)
    known = of_items.select("width", "hash", "n", F.col("pos").alias("offset")).distinct()
    known = broadcast_if_small(known)

    proposed = None
    for width, stride in widths.items():
        rows = base.select("k1", "k2", F.size(wide).alias("size"), F.explode(_shingles(wide, width, stride)).alias("s")).select("k1", "k2", "size", "s.pos", "s.hash", F.lit(width).alias("width"))
        met = rows.join(known, ["width", "hash"])
        start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("offset"), F.col("size") - F.col("n")))
        spans = met.select("k1", "k2", "width", "n", start.alias("start")).distinct()
        proposed = spans if proposed is None else proposed.unionByName(spans)
    windows = stable(proposed)
    spans_of = windows.groupBy("k1", "k2").agg(F.collect_list(F.struct("width", "n", "start")).alias("spans"))
    held = base.join(broadcast_if_small(stable(spans_of), "spans"), ["k1", "k2"])
    cut = held.select("k1", "k2", "doc_id", "words", F.explode("spans").alias("w")).select("k1", "k2", "doc_id", "w.*", F.slice("words", F.col("w.start") + 1, F.col("w.n")).alias("words"))

    keys = ["k1", "k2", "n", "start"]
    item = ["t1", "t2"]
    parts = []
    for width in widths:
        own = cut.where(F.col("width") == width)
        # A window that the end of its document cuts below five words is one shingle of what it has.
        parts.append(own.select(*keys, "doc_id", F.inline(_shingles(wide, width))))
    of_windows = parts[0]
    for p in parts[1:]:
        of_windows = of_windows.unionByName(p)
    # Equal rows give equal windows; their shingles count once.
    of_windows = stable(of_windows.select(*keys, "doc_id", "pos", "hash").distinct())

    window_prints = simhash(of_windows, *keys)
    item_prints = simhash(of_items, *item, "n")
    left = window_prints.select(*keys, "print", F.inline(blocks_of(F.col("print"), radius)))
    right = item_prints.select(*item, "n", F.col("print").alias("item_print"), F.inline(blocks_of(F.col("print"), radius)))
    near = left.join(broadcast_if_small(right), ["n", "block", "value"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)

    counted = of_windows.groupBy(*keys, "hash").agg(F.count(F.lit(1)).alias("times"))
    totals = of_windows.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.first("doc_id").alias("doc_id"))
    item_counts = of_items.groupBy(*item, "hash").agg(F.count(F.lit(1)).alias("item_times"))
    item_totals = of_items.groupBy(*item).agg(F.count(F.lit(1)).alias("item_total"))
    # Sum of the times squared over the sum of their squares: the number of shingles if all occur equally often.
    few = counted.groupBy(*keys).agg(F.sum("times").alias("all"), F.sum(F.col("times") * F.col("times")).alias("squares")).where(F.col("all") * F.col("all") < FEW * F.col("squares"))
    sized = of_items.select("n", "hash", *item).distinct()
    known_by = sized.groupBy("n", "hash").agg(F.count(F.lit(1)).alias("items"))
    ranked = counted.join(few.select(*keys, "all"), keys).join(broadcast_if_small(known_by), ["n", "hash"], "left")
    # A similar item holds more of the window than all but its rarest 1 - similarity, so one of these is shared.
    rarer = Window.partitionBy(*keys).orderBy(F.coalesce("items", F.lit(0)), "hash").rowsBetween(Window.unboundedPreceding, -1)
    rare = ranked.withColumn("rarer", F.coalesce(F.sum("times").over(rarer), F.lit(0))).where(F.col("rarer") <= (1 - similarity) * F.col("all") + 1e-9)
    plain = rare.where("items > 0").join(broadcast_if_small(sized), ["n", "hash"])
    pairs = near.select(*keys, *item).unionByName(plain.select(*keys, *item)).distinct()
    shared = pairs.join(counted, keys).join(broadcast_if_small(item_counts), [*item, "hash"]).groupBy(*keys, *item).agg(F.sum(F.least("times", "item_times")).alias("shared"))
    judged = shared.join(totals, keys).join(broadcast_if_small(item_totals), item)
    share = F.col("shared") / (F.col("total") + F.col("item_total") - F.col("shared"))
    return judged.select("k1", "k2", "doc_id", *item, F.col("n").alias("n_words"), "start", share.alias("similarity")).where(F.col("similarity") >= similarity)
