"""Corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
`documents`; the last returns token ids. `run` writes every stage as Parquet into the shared folder and
reads it again for the next, so a lost executor costs at most the stage that runs.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.llm import bpe
from specloom.llm.decontam import passages
from specloom.llm.jaccard import linked_rows
from specloom.llm.joins import broadcast_if_small, row_key
from specloom.llm.langid import UNKNOWN, identify, learn
from specloom.llm.linededup import dedup_lines
from specloom.llm.queries import ORACLES as LLM_ORACLES
from specloom.llm.queries import QUERIES as LLM_QUERIES
from specloom.llm.queries import TOKENIZER
from specloom.llm.registry import table
from specloom.session import shared_dir, stable

__all__ = ["LLM_ORACLES", "LLM_QUERIES", "ORACLE_SQL", "STAGES", "run"]

# The language model of the first stage and the tokenizer of the last cannot be said in SQL.
ORACLE_SQL = None


def whole_row(docs: DataFrame) -> Column:
    """The input row as one struct, so that no column of it meets a working name."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found: those without text or without a letter go. The model is
    learned from the labelled documents; a missing label is filled in."""
    samples = learn(docs.select("lang", "text"))
    found = docs.select(whole_row(docs), identify(samples, F.col("text")).alias("found")).where(F.col("found.lang") != UNKNOWN)
    own = lambda c: F.col("row")[c]
    return found.select(*[(F.coalesce(own(c), "found.lang") if c == "lang" else own(c)).alias(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many sites stay at their first place only; a document that loses all its lines goes."""
    done = dedup_lines(docs).where((F.col("n_lines") == 0) | (F.col("n_removed") < F.col("n_lines")))
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return done.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, of several with that id or of a
    group without ids the one with the smallest key, of rows equal in id and text the one whose other
    columns come first. Documents without words stay."""
    groups = stable(linked_rows(docs.select("doc_id", "text")))
    lowest = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = groups.where(lowest)
    tied = first.groupBy("label").agg(F.min("row_key").alias("stays"), F.max("row_key").alias("last")).where("stays <> last").select("label", "stays")
    ties = first.join(broadcast_if_small(stable(tied)), "label").where("row_key <> stays")
    # A row goes by its hash and its id, so two rows of one hash and different ids are not mixed up.
    key = ["row_key", "id", "no_id"]
    named = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("doc_id").isNull().alias("no_id")]
    lost = groups.where(~lowest).select("row_key", *named).unionByName(ties.select("row_key", *named)).distinct()
    again = first.where("doc_id is not null or label is not null").groupBy("row_key", *named).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    keyed = docs.select(whole_row(docs), F.xxhash64("doc_id", "text").alias("row_key"), *named)
    kept = keyed.join(broadcast_if_small(stable(lost)), key, "left_anti")
    if not again.isEmpty():
        again = broadcast_if_small(stable(again))
        one = kept.join(again, key, "left_semi").groupBy(*key).agg(F.min("row").alias("row"))
        kept = kept.join(again, key, "left_anti").select("row").unionByName(one.select("row"))
    return kept.select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go, whether document and passage have an id or not."""
    found = passages(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))
    keyed = docs.select(whole_row(docs), *row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(broadcast_if_small(stable(found.select("k1", "k2").distinct())), ["k1", "k2"], "left_anti").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    path = public_tokenizers.path(TOKENIZER)
    text = F.coalesce("text", F.lit("")).alias("text")
    both = docs.select("doc_id", "lang", "source", text, bpe.encode_decode(spark, path, F.col("text")).alias("_both"))
    ids = F.col("_both.ids")
    return both.select("doc_id", "lang", "source", F.size(ids).alias("n_tokens"), ids.alias("ids"), (F.col("_both.decoded") == F.col("text")).alias("round_trip"))


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("jaccard_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("bpe_tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    top = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{top}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


LLM_QUERIES["pipeline"] = run
