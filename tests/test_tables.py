"""Reconstruction against its definition, tried out over all rows and ranges of random pages, and by hand."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from specloom.operators import tables as T
from specloom.operators.mapping import Rule
from specloom.plans.job import device_outcome

FRAGMENT = "doc_id string, page int, frag_id int, text string, minx double, miny double, maxx double, maxy double"
CONFIG = (
    "sheet_id string, doc_id string, page int, x double, y double, w double, h double, sections string, "
    "multiline_row_header boolean, multiline_section_header boolean"
)


# ---- by definition ------------------------------------------------------------------


def mid(f):
    return (f["miny"] + f["maxy"]) / 2


def expected_row(cell, heads, top, bottom, borders):
    """The only row whose height range holds the cell; of several the first row between borders."""
    held = held_by(cell, heads, top, bottom)
    if len(held) == 1:
        return held[0]
    inside = [i for i in range(len(heads)) if borders(i) and borders(i + 1) and borders(i) <= cell["miny"] and cell["maxy"] <= borders(i + 1)]
    return inside[0] if inside and inside[0] in held else None


def held_by(cell, heads, top, bottom):
    """All rows whose range, from the middle above to the middle below, contains the cell."""
    edges = [top, top, *[mid(h) for h in heads[1:]], bottom]
    return [i for i in range(len(heads)) if edges[i] <= cell["miny"] and cell["maxy"] <= (edges[i + 2] if i + 1 < len(heads) else bottom)]


def borders_of(heads, cells, top, bottom):
    """Border i lies above row i. Between two rows that no cell disputes it is half way; else it mirrors
    the nearest such border on either side across the middles in between."""
    n = len(heads)
    disputed = set().union(*(held_by(c, heads, top, bottom) for c in cells if len(held_by(c, heads, top, bottom)) > 1), set())
    known = {i: (mid(heads[i - 1]) + mid(heads[i])) / 2 for i in range(1, n) if not disputed & {i - 1, i}}

    def mirrored(j, i):
        low, high = min(i, j), max(i, j)
        turn = lambda t: (-1) ** (abs(i - t) - (t < i))
        return (-1) ** (high - low) * known[j] + 2 * sum(turn(t) * mid(heads[t]) for t in range(low, high))

    def border(i):
        if i in known:
            return known[i]
        sides = [mirrored(pick(js), i) for pick, js in ((max, [j for j in known if j < i]), (min, [j for j in known if j > i])) if js]
        if len(sides) == 2 and abs(sides[0] - sides[1]) >= 3:
            return None
        return sum(sides) / len(sides) if sides else None

    return border


def compositions(n, k):
    """All ways to cut n columns into k runs, as borders 0 .. n."""
    return ((0, *cut, n) for cut in itertools.combinations(range(1, n), k - 1))


def slots(centre, header):
    """Half steps of the header that a centre may stand on: 2 i at column i, 2 i + 1 between i and i + 1."""
    on = [2 * i for i, h in enumerate(header) if abs(centre - h) <= 5]
    between = [2 * i + 1 for i, (a, b) in enumerate(itertools.pairwise(header)) if a + 5 <= centre <= b - 5]
    return set(on + between)


def expected_ranges(centres, header):
    """The cut of the columns in which every cell stands in the middle of its run; one that stands on two
    half steps takes the lower of those its run can reach."""
    n = len(header)
    if len(centres) in (1, n):
        return [(0, n)] if len(centres) == 1 and n > 1 else [(i, i + 1) for i in range(n)]
    for cut in compositions(n, len(centres)):
        runs = list(itertools.pairwise(cut))
        if all(a + b - 1 == min((m for m in slots(c, header) if m >= 2 * a), default=None) for (a, b), c in zip(runs, centres, strict=True)):
            return runs
    return None


# ---- random pages ---------------------------------------------------------------------


def random_page(rnd, doc):
    rows, y = [], 20.0
    for i in range(rnd.randint(3, 9)):
        y += rnd.choice([9, 10, 14, 30])
        rows.append({"frag_id": i, "text": f"r{i}", "minx": 10.0 + rnd.choice([0, 3]), "miny": y, "maxx": 30.0, "maxy": y + 6})
    cells = []
    for k in range(rnd.randint(10, 40)):
        r = rnd.choice(rows)
        top = r["miny"] + rnd.choice([-12, -5, -1, 0, 0, 0, 2, 4, 8])
        cells.append({"frag_id": 100 + k, "text": f"c{k}", "minx": 60.0 + 30 * rnd.randint(0, 3), "miny": top, "maxy": top + rnd.choice([0, 3, 6, 6, 14]), "maxx": 0.0})
        cells[-1]["maxx"] = cells[-1]["minx"] + 20
    inside = [c for c in cells if 0 <= c["miny"] and c["maxy"] <= 400]
    return doc, rows, inside


def frames(spark, pages):
    data = [(doc, 1, f["frag_id"], f["text"], f["minx"], f["miny"], f["maxx"], f["maxy"]) for doc, rows, cells in pages for f in rows + cells]
    config = [(doc, doc, 1, 0.9, 0.9, 400.0, 400.0, "none", False, False) for doc, _, _ in pages]
    return spark.createDataFrame(data, FRAGMENT), spark.createDataFrame(config, CONFIG)


@pytest.mark.parametrize("hot", [False, True])
def test_rows_by_definition(spark, hot):
    rnd = random.Random(11)
    pages = [random_page(rnd, f"d{i}") for i in range(5 if hot else 60)]
    fragments, config = frames(spark, pages)
    if hot:
        spark.conf.set("specloom.hotRows", "40")
    try:
        frame = T.lined_frame(fragments, config, T.settings_of(config), hot=hot)
        got = {(r["sheet_id"], r["frag_id"]): r["row_id"] for r in T.settle_rows(frame, hot=hot).filter("kind = 'cell'").collect()}
    finally:
        spark.conf.unset("specloom.hotRows")
    open_cells = settled = 0
    for doc, rows, cells in pages:
        heads = sorted(rows, key=mid)
        border = borders_of(heads, cells, 0.0, 400.0)
        for c in cells:
            want = expected_row(c, heads, 0.0, 400.0, border)
            assert got[(doc, c["frag_id"])] == want, (doc, c)
            open_cells += want is None
            settled += want is not None
    assert open_cells and settled


def test_spans_by_search(spark):
    rnd = random.Random(7)
    cases = []
    for i in range(300):
        n = rnd.randint(2, 6)
        header = [50.0 + 30 * k for k in range(n)]
        half = sorted(rnd.sample(range(0, 2 * n - 1), rnd.randint(1, min(n, 2 * n - 1))))
        centres = sorted({(header[m // 2] if m % 2 == 0 else header[m // 2] + 15) + rnd.choice([0, 0, 0, 4, 5, -5, 9]) for m in half})
        cases.append((i, header, centres))
    data = [(f"s{i}", 1, k, c, header) for i, header, centres in cases for k, c in enumerate(centres)]
    df = spark.createDataFrame(data, "sheet_id string, row_id int, cluster_id int, centre double, header array<double>")
    got = {}
    for r in T.resolve_colspans(df).collect():
        got.setdefault(r["sheet_id"], []).append((r["centre"], r["col_from"], r["col_to"]))
    resolved = 0
    for i, header, centres in cases:
        want = expected_ranges(centres, header)
        have = [(a, b) for _, a, b in sorted(got.get(f"s{i}", []))]
        assert have == (want or []), (header, centres)
        resolved += want is not None
    assert 20 < resolved < 300


@pytest.mark.parametrize("seed", range(3))
def test_lagged_sections(spark, seed):
    rnd = random.Random(seed)
    data, want = [], {}
    for s in range(40):
        rows = sorted(rnd.sample(range(0, 200), rnd.randint(1, 12)))
        labels = sorted(rnd.sample(range(0, 200), rnd.randint(0, 6)))
        data += [(f"s{s}", "row", i, f"r{i}", float(y)) for i, y in enumerate(rows)]
        data += [(f"s{s}", "section", i, f"t{i}", float(y)) for i, y in enumerate(labels)]
        # a label begins at the first row beside or below it that no earlier label has begun at
        begins, free = [], 0
        for y in labels:
            begins.append(next((i for i in range(free, len(rows)) if rows[i] >= y - 2), len(rows)))
            free = begins[-1] + 1
        for i in range(len(rows)):
            past = [f"t{k}" for k, at in enumerate(begins) if at <= i]
            want[(f"s{s}", i)] = past[-1] if past else None
    frame = spark.createDataFrame(data, "sheet_id string, kind string, line_no int, text string, midy double")
    got = {(r["sheet_id"], r["line_no"]): r["label"] for r in T.sections_by_column(frame, hot=False).filter("kind = 'row'").collect()}
    assert got == want


# ---- hand-made page ----------------------------------------------------------------------


def page(doc, sections):
    """Three columns; rows Model, Power, Weight, Note; a merged cell, a wrapped cell, a footer."""
    out = []

    def put(text, x0, y0, x1, y1):
        out.append((doc, 1, len(out), text, float(x0), float(y0), float(x1), float(y1)))

    head = 20 if sections == "first-col" else 10
    ys = {"Model": 20, "Power": 60, "Weight": 100, "Note": 140}
    for name, y in ys.items():
        put(name, head, y, head + 20, y + 8)
    if sections == "empty-line":
        put("Electric", head, 40, head + 30, 48)
    if sections == "first-col":
        put("Electric", 2, 60, 12, 68)
    if sections == "table-center":
        put("Electric", 90, 40, 112, 48)
    for k, model in enumerate(["A/1", "B", "C"]):
        put(model, 60 + 40 * k, 20, 80 + 40 * k, 28)
    put("5 W", 80, 60, 100, 68)  # over the first two columns
    put("7 W", 140, 60, 160, 68)
    put("9", 100, 99.5, 120, 104.5)  # one value for all, wrapped
    put("kg", 101, 103.5, 119, 110)
    put("x", 60, 140, 80, 148)
    put("y", 160, 140, 180, 148)  # right of the last column
    put("page 1", 10, 300, 40, 308)
    return out


@pytest.mark.parametrize("sections", ["none", "empty-line", "first-col", "table-center"])
def test_hand_made_page(spark, sections):
    fragments = spark.createDataFrame(page("d", sections), FRAGMENT)
    config = spark.createDataFrame([("s", "d", 1, 0.7, 10.2, 202.9, 200.0, sections, False, False)], CONFIG)
    joiners = spark.createDataFrame([("s", "Weight", "_")], "sheet_id string, row_text string, seq string")
    cells = T.spec_cells(T.sheet_cells(fragments, config, joiners=joiners))
    got = {(r["row_idx"], r["section"], r["property"], r["col_idx"]): r["value"] for r in cells.collect()}
    section = None if sections == "none" else "Electric"
    want = {(0, None, "Model", k): m for k, m in enumerate(["A/1", "B", "C"])}
    want |= {(1, section, "Power", 0): "5 W", (1, section, "Power", 1): "5 W", (1, section, "Power", 2): "7 W"}
    want |= {(2, section, "Weight", k): "9_kg" for k in range(3)}
    assert got == want


def test_fixed_spans_rescue_a_row(spark):
    fragments = spark.createDataFrame(page("d", "none"), FRAGMENT)
    config = spark.createDataFrame([("s", "d", 1, 0.0, 10.0, 202.0, 200.0, "none", False, False)], CONFIG)
    rows = [("s", 0, "Note", [2, 1]), ("s", 1, "Not", [1, 2]), ("s", 2, "Nothing", [3]), ("s", 3, "e", [3])]
    fixed = spark.createDataFrame(rows, "sheet_id string, fix_id int, row_text string, spans array<int>")
    for hot in (False, True):
        cells = T.sheet_cells(fragments, config, fixed=fixed, hot=hot).filter("property = 'Note'")
        # two fixes name the row: the last counts, and the row stays one
        assert sorted((r["value"], r["col_from"], r["col_to"]) for r in cells.collect()) == [("x", 0, 1), ("y", 1, 3)]
    lost = T.unresolved_fixes(fixed, T.find_rows(fragments, config, T.settings_of(config), fixed, hot=False))
    assert sorted((r["row_text"], r["reason"]) for r in lost.collect()) == [("Nothing", "unknown name"), ("e", "ambiguous name")]


def test_added_cell_enters_the_table(spark):
    fragments = spark.createDataFrame(page("d", "none"), FRAGMENT)
    config = spark.createDataFrame([("s", "d", 1, 0.0, 10.0, 202.0, 200.0, "none", False, False)], CONFIG)
    added = spark.createDataFrame([("s", 0, "Note", "A/", "made"), ("s", 1, "Nope", "B", "lost")], "sheet_id string, fix_id int, row_text string, col_text string, text string")
    inside = T.area_filter(fragments, config)
    cells, lost = T.add_cell(inside, added)
    assert [(r["text"], r["minx"], r["miny"], r["maxx"], r["maxy"]) for r in cells.collect()] == [("made", 60.0, 140.0, 80.0, 148.0)]
    assert [r["row_text"] for r in lost.collect()] == ["Nope"]


def test_the_job_returns_what_it_left_out(spark):
    fragments = spark.createDataFrame(page("d", "none"), FRAGMENT)
    config = spark.createDataFrame([(s, "d", 1, 0.0, 10.0, 202.0, 200.0, "none", False, False) for s in "st"], CONFIG)
    added = spark.createDataFrame([("s", 0, "Model", "A/", "made"), ("s", 1, "Nope", "B", "lost"), ("t", 0, "Nope", "B", "not due")], "sheet_id string, fix_id int, row_text string, col_text string, text string")
    fixed = spark.createDataFrame([("s", 2, "Nothing", [3]), ("t", 0, "Nothing", [3])], "sheet_id string, fix_id int, row_text string, spans array<int>")
    stale = config.select("sheet_id").where("sheet_id = 's'")
    rules = {"main": [Rule(["model"], row=("includes", "Model"))]}
    done = device_outcome(fragments, config, rules, stale=stale, fixed=fixed, added=added)
    assert [(r["sheet_id"], r["fix_id"], r["row_text"], r["text"]) for r in done.unplaced.collect()] == [("s", 1, "Nope", "lost")]
    assert [(r["sheet_id"], r["fix_id"], r["reason"]) for r in done.unresolved.collect()] == [("s", 2, "unknown name")]
    assert [(r["sheet_id"], r["reason"]) for r in done.uneven.collect()] == [("s", "cells do not fit the columns")]
    assert {r["sheet_id"] for r in done.records.select("sheet_id").collect()} == {"s"}
    none = device_outcome(fragments, config, rules)
    assert none.unplaced is None and none.unresolved is None


def test_wrapped_headers_merge(spark):
    lines = [("s", 0, "Max", 10.0, 0.0, 20.0, 8.0), ("s", 1, "power", 10.0, 9.0, 20.0, 17.0), ("s", 2, "Weight", 10.0, 30.0, 20.0, 38.0), ("s", 3, "Size", 10.0, 50.0, 22.0, 58.0)]
    df = spark.createDataFrame(lines, "sheet_id string, frag_id int, text string, minx double, miny double, maxx double, maxy double")
    got = sorted((r["miny"], r["text"], r["maxy"]) for r in T.merge_multiline(df).collect())
    assert got == [(0.0, "Max power", 17.0), (30.0, "Weight", 38.0), (50.0, "Size", 58.0)]


def test_only_the_hot_page_takes_the_chunked_path(spark):
    pages = [page("small", "none"), page("large", "empty-line") + [("large", 1, 100 + i, f"n{i}", 0.5 * i, 320.0, 0.5 * i + 1, 330.0) for i in range(60)]]
    fragments = spark.createDataFrame([f for p in pages for f in p], FRAGMENT)
    config = spark.createDataFrame([(d, d, 1, 0.7, 10.2, 202.9, 200.0, m, False, False) for d, m in (("small", "none"), ("large", "empty-line"))], CONFIG)
    plain = sorted(map(str, T.sheet_cells(fragments, config, hot=False).collect()))
    spark.conf.set("specloom.hotRows", "40")
    try:
        parts = T.split_hot(fragments, config)
        assert [(sorted({r["doc_id"] for r in f.collect()}), [r["sheet_id"] for r in c.collect()], hot) for f, c, hot in parts] == [(["small"], ["small"], False), (["large"], ["large"], True)]
        assert sorted(map(str, T.sheet_cells(fragments, config).collect())) == plain
    finally:
        spark.conf.unset("specloom.hotRows")
