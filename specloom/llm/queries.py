"""The dealt operators over their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.llm import bpe, htmltext
from specloom.llm.ann import search_each
from specloom.llm.decontam import leaks
from specloom.llm.jaccard import similar_groups
from specloom.llm.langid import identify, learn
from specloom.llm.linededup import dedup_lines
from specloom.llm.minhash import near_groups, next_fingerprints
from specloom.llm.periodicruns import periodic_runs
from specloom.llm.prefixtrie import number_turns, prefix_trie
from specloom.llm.registry import ORACLES, QUERIES, query, table
from specloom.llm.sharding import feistel_shards
from specloom.llm.suffixdedup import dedup_spans
from specloom.llm.tokencount import count_tokens
from specloom.session import stable

__all__ = ["ORACLES", "QUERIES"]

TOKENIZER = "byte_bpe_50k.json"


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    at = feistel_shards(rows, 40)
    return at.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


@query("op2_langid")
def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    samples = learn(docs.where(~held_out).select("lang", "text"))
    found = docs.select("doc_id", held_out.alias("held_out"), identify(samples, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    both = table(spark, sf_dir, "documents").select("doc_id", bpe.encode_decode(spark, path, F.col("text")).alias("both")).select("doc_id", "both.*")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), digest(F.array_join("ids", ",")).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


@query("op7_tokens")
def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = count_tokens(spark, public_tokenizers.path(TOKENIZER), F.col("text"))
    counted = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), n.alias("n_tokens"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query("op1_html")
def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = table(spark, sf_dir, "pages").select("page_id", "url", htmltext.block_column(F.col("html")).alias("blocks"))
    text = cut.select("page_id", "url", htmltext.main_text(F.col("blocks")).alias("text"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op9_ann")
def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search_each(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query(
    "op5_lines",
    r"""
    WITH docs AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
    lines AS (
      SELECT doc_id, source, i AS pos, trim(ls[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
      FROM (SELECT doc_id, source, ls, unnest(range(1, len(ls) + 1)) AS i FROM docs)),
    known AS (SELECT line, min(doc_id) AS first_doc FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 5),
    marked AS (
      SELECT l.doc_id, l.pos, l.line <> '' AS filled,
        k.line IS NOT NULL AND NOT (l.doc_id = k.first_doc AND l.pos = min(l.pos) OVER (PARTITION BY l.doc_id, l.line)) AS gone
      FROM lines l LEFT JOIN known k ON l.line = k.line),
    kept AS (
      SELECT d.doc_id, count(*) FILTER (m.filled) AS n_lines, count(*) FILTER (m.gone) AS n_removed,
        coalesce(string_agg(d.ls[m.pos], chr(10) ORDER BY m.pos) FILTER (NOT m.gone), '') AS kept
      FROM docs d JOIN marked m ON d.doc_id = m.doc_id GROUP BY d.doc_id)
    SELECT doc_id, n_lines::INT AS n_lines, n_removed::INT AS n_removed, length(kept)::INT AS kept_chars, sha256(kept) AS kept_sha256 FROM kept
    """,
)
def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    text = F.coalesce("kept_text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_removed", F.char_length(text).alias("kept_chars"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


@query(
    "op10_decontam",
    r"""
    WITH d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
    i AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
    ish AS (SELECT item_id, n, p, list_slice(w, p, p + 4) AS s FROM (SELECT item_id, w, len(w) AS n, unnest(range(1, len(w) - 3)) AS p FROM i)),
    dsh AS (SELECT doc_id, n, p, list_slice(w, p, p + 4) AS s FROM (SELECT doc_id, w, len(w) AS n, unnest(range(1, len(w) - 3)) AS p FROM d)),
    spans AS (
      SELECT DISTINCT dsh.doc_id, ish.item_id, ish.n, greatest(0, least(dsh.p - ish.p, dsh.n - ish.n)) AS start
      FROM dsh JOIN ish ON dsh.s = ish.s),
    win AS (
      SELECT spans.doc_id, spans.item_id, spans.n, spans.start, dsh.s, count(*) AS c
      FROM spans JOIN dsh ON spans.doc_id = dsh.doc_id AND dsh.p > spans.start AND dsh.p <= spans.start + spans.n - 4
      GROUP BY ALL),
    tot AS (SELECT doc_id, item_id, n, start, sum(c) AS t FROM win GROUP BY ALL),
    ic AS (SELECT item_id, s, count(*) AS c FROM ish GROUP BY ALL),
    it AS (SELECT item_id, sum(c) AS t FROM ic GROUP BY ALL),
    shared AS (
      SELECT win.doc_id, win.item_id, win.n, win.start, sum(least(win.c, ic.c)) AS x
      FROM win JOIN ic ON win.item_id = ic.item_id AND win.s = ic.s GROUP BY ALL),
    found AS (
      SELECT s.doc_id, s.item_id, s.n, s.start, s.x / (tot.t + it.t - s.x) AS sim
      FROM shared s JOIN tot ON s.doc_id = tot.doc_id AND s.item_id = tot.item_id AND s.n = tot.n AND s.start = tot.start JOIN it ON s.item_id = it.item_id)
    SELECT doc_id, item_id, n::INT AS n_words, min(start) FILTER (sim = best)::INT AS start, best AS similarity
    FROM (SELECT *, max(sim) OVER (PARTITION BY doc_id, item_id) AS best FROM found) WHERE best >= 0.8 GROUP BY doc_id, item_id, n, best
    """,
)
def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, t).select(i, "text") for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    return leaks(docs, items)


@query("op8_jaccard")
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op3_suffix")
def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lost = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["begin"])
    kept = F.coalesce("kept", F.lit("").cast("binary"))
    out = done.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), lost.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"))
    return out


@query("op12_periodic")
def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The documents that the contract names repeat their words from the a-th on with period p.
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", F.when(F.col("h") % 10 == 0, words).alias("words"), F.expr("h div 10").alias("g")).withColumn("n", F.size("words"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.expr("int(g % n)"))).withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    again = F.expr("array_join(transform(sequence(0, n - 1), i -> words[if(i < a, i, a + (i - a) % p)]), ' ')")
    runs = cut.select("doc_id", periodic_runs(F.when(F.col("n") > 0, again).otherwise(F.col("text"))).alias("found")).select("doc_id", "found.*")
    # Runs come by start, then period, so of equally long ones the first is the one asked for.
    longest = F.aggregate("runs", F.expr("cast(null as struct<start:bigint,length:bigint,period:bigint>)"), lambda a, r: F.when(a.isNull() | (r["length"] > a["length"]), r).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n", "")
    lines = F.concat(lines, F.when(F.size("runs") > 0, "\n").otherwise(""))
    out = runs.withColumn("best", longest)
    return out.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query(
    "op11_trie",
    """
    WITH t AS (
      SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
    c AS (
      SELECT conv_id, xor(4294967295::BIGINT, list_reduce(
        list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
        lambda a, x: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda b, y: xor(b >> 1, (b & 1) * 3988292384::BIGINT), xor(a, x)),
        4294967295::BIGINT)) % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
    rebuilt AS (
      SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.pos < c.h
      UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
    seq AS (
      SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.own, r.pos) FILTER (r.pos IS NOT NULL), []) AS turns
      FROM c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
    steps AS (
      SELECT conv_id, len(turns) AS size, d, turns[1:d] AS prefix, coalesce(strlen(turns[d].text), 0) AS bytes
      FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM seq)),
    node AS (
      SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS own, max(size) = d AS leaf,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends, count(*) FILTER (size = d) AS n_ends
      FROM steps GROUP BY d, prefix),
    below AS (SELECT DISTINCT a.d, a.prefix, b.d AS bd, b.prefix AS bp FROM steps a JOIN steps b ON a.conv_id = b.conv_id AND a.d <= b.d)
    SELECT any_value(node.conv_id) AS conv_id, node.d AS depth, any_value(above.conv_id) AS parent_conv_id, any_value(node.n_convs) AS n_convs,
      count(*) FILTER (sub.d = node.d + 1) AS n_children, count(*) FILTER (sub.leaf) AS n_leaves, sum(sub.own)::BIGINT AS saved_tokens,
      any_value(node.n_ends) AS n_ends, any_value(node.ends) AS ends_sha256
    FROM node JOIN below ON below.d = node.d AND below.prefix = node.prefix JOIN node sub ON sub.d = below.bd AND sub.prefix = below.bp
    LEFT JOIN node above ON above.d = node.d - 1 AND above.prefix = node.prefix[1:node.d - 1]
    GROUP BY node.d, node.prefix
    """,
)
def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt_conversations(table(spark, sf_dir, "conversations")))


def rebuilt_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations, as `prefix_trie` takes them: turns and members. Conversation c begins
    with the first h turns of c - c % 5 (the remainder of a negative c is not positive, as in SQL) and goes
    on with its own after the first h."""
    turns = stable(number_turns(rows))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    found = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), h.alias("h")).join(base, "base", "left")
    members = stable(found.select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).cast("bigint").alias("head"), "n"))
    # A base lends at most eight turns, to five conversations or to nine around zero.
    lent = turns.where("conv_id % 5 = 0 and pos < 8").withColumn("to", F.explode(F.expr("sequence(-4L, 4L)")))
    lent = lent.withColumn("to", F.expr("try_add(conv_id, to)")).where("to - to % 5 = conv_id")
    few = members.select("conv_id", "h", "head")
    heads = lent.withColumnRenamed("conv_id", "base").join(few.withColumnRenamed("conv_id", "to"), "to").where("pos < head").select(F.col("to").alias("conv_id"), "pos", "t1", "t2", "size")
    own = turns.join(few, "conv_id").where("pos >= h").select("conv_id", (F.col("head") + F.col("pos") - F.col("h")).alias("pos"), "t1", "t2", "size")
    total = F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("bigint"))
    return heads.unionByName(own), members.select("conv_id", total.alias("turns_in_all"))


@query("op13_minhash")
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("minhash_groups")
def minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
