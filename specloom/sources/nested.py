"""Tables inside tables: rows and cells under every table and row that encloses them.

Tags are cut out with their places, numbered by how many tables are open, and ordered passes within a page
find for each tag the table and row it stands in. A nested table knows the row of the table around it, so
rows and cells reach all that enclose them by following these links, one level a round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.operators import scan
from specloom.operators.joins import shuffled
from specloom.session import stable
from specloom.sources.html import COLSPAN_RE, plain_text

TOKEN_RE = r"(?is)</?(?:table|tr|td|th)\b[^>]*>"

_PAGE = ["page_id"]


def _tokens(pages: DataFrame, rows: int) -> DataFrame:
    """(page_id, i, tag, closing, raw, start, stop): the tags of a page in order, with the places of the
    tag's first character and of the one after its last, from 0."""
    cut = pages.select("page_id", F.regexp_extract_all("html", F.lit(TOKEN_RE), F.lit(0)).alias("tags"), F.split("html", TOKEN_RE, -1).alias("pieces"))
    each = cut.select("page_id", "pieces", F.posexplode("tags").alias("i", "raw"))
    each = scan.dealt(each.select("page_id", "i", "raw", F.char_length(F.get("pieces", F.col("i"))).alias("before")), _PAGE, rows)
    placed = scan.run(each, _PAGE, ["i"], {"stop": scan.running_sum(F.col("before") + F.char_length("raw"))}, hot=False)
    name = F.lower(F.regexp_extract("raw", r"^</?([A-Za-z]+)", 1))
    return placed.select("page_id", "i", name.alias("tag"), F.startswith("raw", F.lit("</")).alias("closing"), "raw", (F.col("stop") - F.char_length("raw")).alias("start"), "stop")


def _placed(pages: DataFrame, rows: int) -> DataFrame:
    """The tags with `level` (tables open around their content), `tbl` (number of the innermost of them),
    `row` (the open row of that table, null outside) and, for rows and cells, `end`. Each table appears
    once more, as `probe`, in the place it takes in the table around it."""
    tokens = _tokens(pages, rows)
    table = F.col("tag") == "table"
    step = F.when(table & ~F.col("closing"), 1).when(table, -1).otherwise(0)
    summed = scan.run(tokens, _PAGE, ["i"], {"_open": scan.running_sum(step)}, hot=False)
    lowest = scan.run(summed, _PAGE, ["i"], {"_low": scan.running_min(F.col("_open"))}, hot=False)
    # A closing tag too many closes nothing: the count starts anew where it would fall below zero.
    depth = F.col("_open") - F.least(F.col("_low"), F.lit(0))
    level = depth + F.when(table & F.col("closing"), 1).otherwise(0)
    leveled = lowest.withColumn("level", level).drop("_open", "_low").withColumn("probe", F.lit(False))
    probes = leveled.where(table & ~F.col("closing")).withColumns({"level": F.col("level") - 1, "probe": F.lit(True)})
    every = scan.dealt(leveled.unionByName(probes).where("level > 0"), _PAGE, rows)

    opened = F.when(table & ~F.col("closing") & ~F.col("probe"), F.col("i"))
    own = scan.run(every, ["page_id", "level"], ["i", "probe"], {"tbl": scan.last_known(opened)}, hot=False)
    keys, order = ["page_id", "level", "tbl"], ["i", "probe"]
    mine = ~F.col("probe")
    row_mark = F.when(mine & ((F.col("tag") == "tr") | (table & F.col("closing"))), F.col("start"))
    cell_mark = F.when(mine & (F.col("tag").isin("tr", "td", "th") | (table & F.col("closing"))), F.col("start"))
    near = scan.run(own, keys, order, {"_row": scan.next_known(row_mark), "_cell": scan.next_known(cell_mark)}, hot=False)
    ended = scan.run(near, keys, order, {"_row_end": scan.following(F.col("_row")), "_cell_end": scan.following(F.col("_cell"))}, hot=False)
    # A row is open from its tag on, until another row, its end or the end of its table.
    state = F.when(row_mark.isNotNull(), F.struct(F.when((F.col("tag") == "tr") & ~F.col("closing"), F.col("i")).alias("row")))
    known = scan.run(ended, keys, order, {"_state": scan.last_known(state)}, hot=False)
    end = F.when(F.col("tag") == "tr", F.col("_row_end")).otherwise(F.col("_cell_end"))
    return known.select("page_id", "i", "tag", "closing", "probe", "raw", "stop", "level", "tbl", F.col("_state.row").alias("row"), end.alias("end"))


def _chain(start: DataFrame, around: DataFrame) -> DataFrame:
    """The frame for the table `tbl` of each row, and again for every table around it, with the row of that
    table (`row`) in which the inner one stands and how many tables up it is (`up`)."""
    level, levels = start.withColumn("up", F.lit(0)), []
    while True:
        level = stable(level)
        levels.append(level)
        above = level.drop("row").join(shuffled(around), ["page_id", "tbl"]).withColumns({"tbl": F.col("outer"), "row": F.col("outer_row"), "up": F.col("up") + 1}).drop("outer", "outer_row")
        if above.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        level = above.select(*level.columns)


def nested_cells(pages: DataFrame) -> DataFrame:
    """One row for each cell of each row of each table: page_id, table_idx, row_idx, cell_idx, text, colspan.

    pages: page_id, html. A table has the rows of the tables inside it too, and a row the cells inside it
    at any depth, both in the order of the page; the text of a cell holds that of what is inside it.
    Tables, rows and cells that are not closed end where the next of their kind begins or their table
    ends. Cells outside rows and rows outside tables are left out, as are heading cells.
    """
    held = pages.where(F.contains(F.lower("html"), F.lit("<table"))).select("page_id", "html")
    rows = held.agg(F.sum(F.regexp_count("html", F.lit(TOKEN_RE))).alias("n")).first()["n"] or 0
    placed = stable(_placed(held, rows))
    own = placed.where("not probe and not closing")
    tables = own.where("tag = 'table'").select("page_id", F.col("i").alias("tbl"))
    numbered = scan.run(tables, _PAGE, ["tbl"], {"table_idx": scan.position()}, hot=False)
    around = placed.where("probe").select("page_id", F.col("i").alias("tbl"), F.col("tbl").alias("outer"), F.col("row").alias("outer_row"))

    lines = own.where("tag = 'tr'").select("page_id", F.col("i").alias("tr"), "tbl", "row")
    under = _chain(lines, around).select("page_id", "tbl", "tr")
    under = scan.run(under, ["page_id", "tbl"], ["tr"], {"row_idx": scan.position()}, hot=False).join(shuffled(numbered), ["page_id", "tbl"])

    cells = own.where("tag = 'td'")
    inside = _chain(cells.select("page_id", F.col("i").alias("td"), "tbl", "row"), around).where("row is not null").select("page_id", F.col("row").alias("tr"), "td")
    inside = scan.run(inside, ["page_id", "tr"], ["td"], {"cell_idx": scan.position()}, hot=False)

    span = F.coalesce(F.regexp_extract("raw", COLSPAN_RE, 1).try_cast("int"), F.lit(1))
    length = F.coalesce("end", F.char_length("html")) - F.col("stop")
    texts = cells.join(shuffled(held), "page_id").select("page_id", F.col("i").alias("td"), plain_text(F.substring("html", F.col("stop") + 1, length)).alias("text"), span.alias("colspan"))
    found = under.join(shuffled(inside), ["page_id", "tr"]).join(shuffled(texts), ["page_id", "td"])
    return found.select("page_id", "table_idx", "row_idx", "cell_idx", "text", "colspan")
