"""Tables of HTML pages.

Regular expressions over the page text, no tree. Tables are matched by their opening and closing tags;
one nested in a cell of another is a table of its own, and its text stays in that cell.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG_RE = r"(?i)</?table\b[^>]*>"
ROW_RE = r"(?is)<tr\b[^>]*>(.*?)(?:</tr\s*>|(?=<tr\b)|$)"
CELL_RE = r"(?is)<td\b[^>]*>.*?(?=</td\s*>|<t[dh]\b|$)"
OPENING_RE = r"(?is)^<td\b([^>]*)>"
COLSPAN_RE = r"(?i)\bcolspan\s*=\s*[\"']?\s*(\d+)"
MARKUP_RE = r"(?s)<[^>]*>"
REFERENCE_RE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _named() -> Column:
    """The named character references of HTML 4, with "apos", as a map literal."""
    pairs = {**{n: chr(c) for n, c in name2codepoint.items()}, "apos": "'"}
    return F.create_map(*[F.lit(x) for pair in sorted(pairs.items()) for x in pair])


def _character(reference: Column) -> Column:
    """Text of a reference without & and ;. A code that is no character, and an unknown name, stay as written."""
    hexadecimal = F.regexp_extract(reference, r"^#[xX](.+)$", 1)
    decimal = F.regexp_extract(reference, r"^#([0-9]+)$", 1).try_cast("bigint")
    code = F.when(decimal.isNotNull(), F.hex(decimal)).when(hexadecimal != "", hexadecimal)
    code = F.lpad(F.upper(code), 8, "0")
    good = (code > "00000000") & (code <= "0010FFFF") & ~code.between("0000D800", "0000DFFF")
    coded = F.when(good, F.decode(F.unhex(code), "UTF-32"))
    return F.coalesce(coded, F.try_element_at(_named(), reference), F.concat(F.lit("&"), reference, F.lit(";")))


def decoded(text: Column) -> Column:
    """Character references replaced, each once."""
    between = F.split(text, REFERENCE_RE, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE_RE), F.lit(1)), _character)
    joined = F.array_join(F.flatten(F.zip_with(between, found, lambda t, c: F.array(t, F.coalesce(c, F.lit(""))))), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def plain_text(markup: Column) -> Column:
    """Markup without tags, character references replaced, trimmed."""
    return F.regexp_replace(decoded(F.regexp_replace(markup, MARKUP_RE, "")), r"(?U)^\s+|\s+$", "")


def _cells(row: Column) -> Column:
    span = lambda c: F.coalesce(F.regexp_extract(F.regexp_extract(c, OPENING_RE, 1), COLSPAN_RE, 1).try_cast("int"), F.lit(1))
    return F.transform(F.regexp_extract_all(row, F.lit(CELL_RE), F.lit(0)), lambda c: F.struct(plain_text(c).alias("text"), span(c).alias("colspan")))


def table_bodies(tags: Column, pieces: Column, depths: Column) -> Column:
    """Inner markup of each table, in the order of the opening tags; of nested tables only the text.

    `pieces` are the texts around the tags, `depths` the number of open tables after each tag.
    """
    n = F.size(tags)

    def body(k: Column) -> Column:
        own = F.get(depths, k)
        later = F.filter(F.sequence(k, n - 1), lambda m: F.get(depths, m) < own)
        end = F.coalesce(F.get(later, F.lit(0)), n)
        part = lambda j: F.when(F.get(depths, j - 1) == own, F.get(pieces, j)).otherwise(F.regexp_replace(F.get(pieces, j), MARKUP_RE, ""))
        return F.array_join(F.transform(F.sequence(k + 1, end), part), "")

    opening = F.filter(F.sequence(F.lit(0), n - 1), lambda k: ~F.startswith(F.get(tags, k), F.lit("</")))
    return F.transform(opening, body)


def table_rows(pages: DataFrame) -> DataFrame:
    """One row per table row: page_id, table_idx, row_idx, cells array<struct<text, colspan>>."""
    held = pages.filter(F.contains(F.lower("html"), F.lit("<table")))
    steps = F.transform("tags", lambda t: F.when(F.startswith(t, F.lit("</")), -1).otherwise(1))
    depths = F.transform("steps", lambda _, i: F.reduce(F.slice("steps", F.lit(1), i + 1), F.lit(0), lambda a, b: a + b))
    cut = held.select("page_id", F.regexp_extract_all("html", F.lit(TAG_RE), F.lit(0)).alias("tags"), F.split("html", TAG_RE, -1).alias("pieces"))
    deep = cut.withColumn("steps", steps).withColumn("depths", depths)
    tables = deep.select("page_id", F.posexplode(table_bodies(F.col("tags"), F.col("pieces"), F.col("depths"))).alias("table_idx", "_table"))
    rows = tables.select("page_id", "table_idx", F.posexplode(F.regexp_extract_all("_table", F.lit(ROW_RE), F.lit(1))).alias("row_idx", "_row"))
    return rows.select("page_id", "table_idx", "row_idx", _cells(F.col("_row")).alias("cells"))


def table_cells(pages: DataFrame) -> DataFrame:
    """One row per cell."""
    cells = table_rows(pages).select("page_id", "table_idx", "row_idx", F.posexplode("cells").alias("cell_idx", "_cell"))
    return cells.select("page_id", "table_idx", "row_idx", "cell_idx", "_cell.*")
