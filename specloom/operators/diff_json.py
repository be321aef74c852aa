"""Comparing nested outputs: JSON documents of any shape, node by node.

A document is walked level by level as VARIANT, all documents at once, and every node becomes a row with
its path, kind, length and value. Both sides of a comparison are walked together and meet in one aggregate
on document and path.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.session import stable

ROOT = "$"
KINDS = ("object", "array", "string", "int", "float", "boolean", "null", "invalid")

_CHILD = "array<struct<step:string,node:variant>>"


def _kind(node: Column) -> Column:
    shape = F.schema_of_variant(node)
    return (
        F.when(F.startswith(shape, F.lit("OBJECT")), "object")
        .when(F.startswith(shape, F.lit("ARRAY")), "array")
        .when(shape == "STRING", "string")
        .when(shape == "BIGINT", "int")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "VOID", "null")
        .otherwise("float")
    )


def _step(key: Column) -> Column:
    """How a key continues a path; keys that are no plain names are quoted as in JSON."""
    plain = F.rlike(key, F.lit(r"^[A-Za-z_][A-Za-z0-9_]*$"))
    quoted = F.regexp_extract(F.to_json(F.struct(key.alias("k"))), r'^\{"k":([\s\S]*)\}$', 1)
    return F.concat(F.lit("."), F.when(plain, key).otherwise(quoted))


def json_nodes(docs: DataFrame, keys: Sequence[str], json: str) -> DataFrame:
    """(keys, path, parent, kind, length, value): one row for each node of each document.

    `length` counts the members of an object or array, `value` is the text of anything else; whole numbers
    are `int` up to 64 bits, other numbers `float`, and a float's value is that of a double. A text that is
    no JSON (also one that repeats a key) is one node of kind `invalid` with the text as value; a null text
    has no nodes. Containers are opened one level a round, in place; nothing is gathered.
    """
    node = F.try_parse_json(F.col(json))
    bad = F.col(json).isNotNull() & node.isNull()
    level = docs.where(F.col(json).isNotNull()).select(*keys, F.lit(ROOT).alias("path"), F.lit(None).cast("string").alias("parent"), node.alias("node"), F.when(bad, F.col(json)).alias("raw"))
    levels = []
    while True:
        level = level.withColumn("kind", F.when(F.col("raw").isNotNull(), "invalid").otherwise(_kind(F.col("node"))))
        is_object, is_array = F.col("kind") == "object", F.col("kind") == "array"
        members = F.when(is_object, F.transform(F.map_entries(F.when(is_object, F.col("node")).cast("map<string,variant>")), lambda e: F.struct(_step(e["key"]).alias("step"), e["value"].alias("node"))))
        items = F.transform(F.when(is_array, F.col("node")).cast("array<variant>"), lambda v, i: F.struct(F.concat(F.lit("["), i.cast("string"), F.lit("]")).alias("step"), v.alias("node")))
        text = F.when(F.col("kind") == "float", F.col("node").cast("double").cast("string")).when(F.col("kind") == "string", F.col("node").cast("string")).when(~F.col("kind").isin("object", "array", "invalid"), F.to_json("node"))
        below = F.coalesce(members, items).cast(_CHILD)
        level = stable(level.select(*keys, "path", "parent", "kind", F.size(below).alias("length"), F.coalesce(text, "raw").alias("value"), below.alias("below")))
        levels.append(level.select(*keys, "path", "parent", "kind", F.when(F.col("length") >= 0, F.col("length")).alias("length"), "value"))
        inner = level.where("length > 0")
        if inner.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        each = inner.select(*keys, F.col("path").alias("parent"), F.inline("below"))
        level = each.select(*keys, F.concat("parent", "step").alias("path"), "parent", "node", F.lit(None).cast("string").alias("raw"))


def diff_json(old: DataFrame, new: DataFrame, keys: Sequence[str], json: str = "json") -> DataFrame:
    """(keys, path, status, old_value, new_value) of each difference between the documents of a key.

    `type`: the kinds differ (the values are the kinds) and nothing below is compared; `length`: arrays of
    different lengths (the values are the lengths), compared as far as both go; `only_old`, `only_new`: a
    key of an object, or at the root a document, that one side lacks (the value is the kind); `value`:
    different values of one kind. Keys are unique on each side and may be null. Documents with equal texts
    are left out before anything is parsed.
    """
    doc = F.struct(*keys).alias("doc")
    a, b = (df.where(F.col(json).isNotNull()).select(doc, F.lit(side).alias("side"), F.col(json).alias("text")) for df, side in ((old, "a"), (new, "b")))
    pairs = a.unionByName(b).groupBy("doc").agg(F.max(F.when(F.col("side") == "a", F.col("text"))).alias("a"), F.max(F.when(F.col("side") == "b", F.col("text"))).alias("b"))
    changed = pairs.where(~F.col("a").eqNullSafe(F.col("b"))).select("doc", F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("text")) for s in "ab"])))
    nodes = json_nodes(changed, ["doc", "side"], "text")
    of = lambda s: F.max(F.when(F.col("side") == s, F.struct("kind", "length", "value"))).alias(s)
    met = stable(nodes.groupBy("doc", "path").agg(of("a"), of("b"), F.max("parent").alias("parent")))

    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    status = (
        F.when(F.col("a").isNull(), "only_new")
        .when(F.col("b").isNull(), "only_old")
        .when(F.col("a.kind") != F.col("b.kind"), "type")
        .when((F.col("a.kind") == "array") & (F.col("a.length") != F.col("b.length")), "length")
        .when(~F.col("a.value").eqNullSafe(F.col("b.value")), "value")
    )
    shown = [
        F.when(F.col("status").isin("only_old", "only_new", "type"), F.col(f"{s}.kind")).when(F.col("status") == "length", F.col(f"{s}.length").cast("string")).otherwise(F.col(f"{s}.value")).alias(n)
        for s, n in (("a", "old_value"), ("b", "new_value"))
    ]
    differing = met.withColumn("status", status).where("status is not null")
    # What one side lacks counts if both have an object there, or if the whole document is missing.
    objects = met.where(both & (F.col("a.kind") == "object") & (F.col("b.kind") == "object")).select("doc", F.col("path").alias("parent"))
    one_sided = differing.where(~both)
    in_object = one_sided.join(objects, ["doc", "parent"], "left_semi")
    whole = one_sided.where("parent is null")
    out = reduce(DataFrame.unionByName, [x.select("doc", "path", "status", "a", "b") for x in (differing.where(both), in_object, whole)])
    return out.select("doc.*", "path", "status", *shown)
