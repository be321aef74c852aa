"""Mapping rules, coercion, nesting, sinks."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from specloom.functions import records as R
from specloom.functions import text as X
from specloom.operators import incremental as inc
from specloom.operators import mapping, reshape
from specloom.operators.mapping import Rule
from specloom.session import written
from specloom.sources import html, sheets
from specloom.operators.html import columnize
from specloom.operators import table_json

ROWS = "ruleset string, sheet_id string, row_idx int, section string, property string, vals array<string>"


def rows(spark, *lines, sheet="s"):
    return spark.createDataFrame([("main", sheet, i, s, p, list(v)) for i, (s, p, v) in enumerate(lines)], ROWS)


def mapped(spark, df, rules, **options):
    out = mapping.map_sheets(df, {"main": rules}, **options).orderBy("sheet_id", "col_idx")
    return [json.loads(r) for r in out.toJSON().collect()]


SHEET = [
    ("", "Model", ["A/1", ".B", "C"]),
    ("PV", "Input Voltage", ["370 (125~500)", "380", "none"]),
    ("PV", "Rated Voltage", ["360", "361", "362"]),
    ("PV", "Current", ["13+13", "9.5", "-"]),
    ("Battery", "Current", ["5 A", "6 A", "7 A"]),
    ("Case", "Weight", ["20 kg", "21.5 kg", "22 kg"]),
]
TRIPLE = Rule(["pv_input.v_nom", "pv_input.v_crit.min", "pv_input.v_crit.max"], section=("includes", "pv"), row=("exact", "Input Voltage"), fn="integers")


def test_priority_and_arity(spark):
    rules = [
        Rule(["model"], row=("includes", "MODEL")),
        TRIPLE,
        Rule(["pv_input.v_nom"], row=("regex", "^Rated")),
        Rule(["pv_input.i_nom"], section=("exact", "PV"), row=("exact", "Current"), fn="numbers"),
        Rule(["battery_input.i_invert"], row=("exact", "Current"), fn="numbers"),  # two rows: skipped
        Rule(["general_data.weigth"], row=("exact", "Weight"), col=("regex", "^([0-9.]+) kg$"), fn="regex_groups"),
        Rule(["brand"], const="X"),
        Rule(["brand"], const="Y"),
    ]
    a, b, c = mapped(spark, rows(spark, *SHEET), rules)
    assert a["pv_input"]["v_nom"] == 370 and a["pv_input"]["v_crit"] == {"min": 125, "max": 500}
    assert b["pv_input"]["v_nom"] == 361 and "v_crit" not in b["pv_input"]
    assert c["pv_input"]["v_nom"] == 362
    assert (a["pv_input"]["i_nom"], b["pv_input"]["i_nom"], c["pv_input"]["i_nom"]) == ([13.0, 13.0], [9.5], [])
    assert all("battery_input" not in r for r in (a, b, c))
    assert [r["general_data"]["weigth"] for r in (a, b, c)] == [20.0, 21.5, 22.0]
    assert {r["brand"] for r in (a, b, c)} == {"Y"}


def test_single_and_ordered_paths_agree(spark):
    rules = [
        Rule(["pv_input.v_nom"], row=("exact", "Input Voltage"), fn="integers"),
        Rule(["pv_input.v_nom"], row=("exact", "Rated Voltage")),
        Rule(["pv_input.n_mppt"], const="1"),
        Rule(["pv_input.n_mppt"], row=("exact", "Rated Voltage")),
        Rule(["tags"], row=("exact", "Weight"), fn="integers"),
    ]
    by_plan, by_join = (mapping.single_matches(rows(spark, *SHEET), {"main": rules}, literal_rules=n) for n in (200, 0))
    assert sorted(map(str, by_plan.collect())) == sorted(map(str, by_join.collect()))
    entries = mapping.cell_entries(by_plan)
    targets = sorted({t for r in rules for t in r.targets})
    a, b = mapping.fill_single(entries, targets), mapping.fill_ordered(entries, targets)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_unfilled_model_is_kept(spark):
    out = mapped(spark, rows(spark, *SHEET), [Rule(["brand"], row=("exact", "Nothing"))])
    assert [r["col_idx"] for r in out] == [0, 1, 2]


def test_bad_values(spark):
    rules = [Rule(["model"], row=("exact", "Model")), Rule(["general_data.weigth"], row=("exact", "Weight"))]
    both = rows(spark, *SHEET).unionByName(rows(spark, ("", "Model", ["Z"]), ("", "Weight", ["3.5"]), sheet="t"))
    filled = mapping.fill(mapping.cell_entries(mapping.single_matches(both, {"main": rules})), {"main": rules})
    assert sorted(r["raw"] for r in mapping.quarantine(filled).collect()) == ["20 kg", "21.5 kg", "22 kg"]
    assert [r["sheet_id"] for r in mapping.typed_leaves(filled, strict=True).collect()] == ["t"]
    assert mapping.typed_leaves(filled).count() == 4


@pytest.mark.parametrize(
    "rule",
    [
        Rule(["pv_input"], const="1"),
        Rule(["nope"], row=("exact", "a")),
        Rule(["model"], row=("exact", "")),
        Rule(["model"], row=("like", "a")),
        Rule(["model", "brand"], const="x"),
        Rule(["model"], row=("exact", "a"), fn="regex_groups"),
        Rule(["model"], row=("exact", "a"), fn="upper"),
    ],
)
def test_rules_are_checked_before_the_job(rule):
    with pytest.raises(ValueError):
        mapping.check_rule(rule)


def test_first_writer_wins(spark):
    df = spark.createDataFrame([("s", 0, "A/1"), ("s", 1, "A_1"), ("s", 2, None), ("s", 3, ".B.")], "sheet_id string, col_idx int, model string")
    old = spark.createDataFrame([("s", "B")], "sheet_id string, file_name string")
    assert sorted((r["col_idx"], r["file_name"]) for r in mapping.first_writer(df, old).collect()) == [(0, "A_1"), (2, "col:2")]


def test_groups_and_numbers(spark):
    df = spark.createDataFrame([("13.5+٣ a",), ("x7",), ("none",)], "v string")
    out = df.select(X.integers(F.col("v")), X.numbers(F.col("v")), X.groups(F.col("v"), "([a-z])(z)?([0-9])", 3)).collect()
    assert [list(r[0]) for r in out] == [["13", "5", "٣"], ["7"], []]
    assert [list(r[1]) for r in out] == [["13.5", "٣"], ["7"], []]
    assert [r[2] for r in out] == [None, ["x", None, "7"], None]


def test_wide_long_round_trip(spark):
    cells = spark.createDataFrame(
        [("s", 0, "", "M", 0, "a"), ("s", 0, "", "M", 1, "b"), ("s", 1, "P", "w", 0, "1"), ("s", 2, "P", "h", 1, "2"), ("s", 3, "Q", "h", 0, "3")],
        "sheet_id string, row_idx int, section string, property string, col_idx int, value string",
    )
    wide = reshape.blank_sections(reshape.long_to_wide(cells, 2))
    assert [r["section"] for r in wide.orderBy("row_idx").collect()] == ["", "P", None, "Q"]
    back = reshape.wide_to_long(reshape.fill_sections(wide), 2).select(cells.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, cells.collect()))


def test_sheet_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('section,property,col:0\n,Model,"x, y"\nP,Power,5\n,Peak,6\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("section,property,col:0,col:1\n,Model,µ,n\n", encoding="utf-8")
    got = sheets.read_sheets(spark, str(tmp_path))
    lines = sorted((r["sheet_id"][-5:], r["row_idx"], r["section"], r["property"], r["col:0"], r["col:1"]) for r in got.collect())
    assert lines == [
        ("a.csv", 0, None, "Model", "x, y", None),
        ("a.csv", 1, "P", "Power", "5", None),
        ("a.csv", 2, None, "Peak", "6", None),
        ("b.csv", 0, None, "Model", "µ", "n"),
    ]
    filled = reshape.sheet_rows(got, 2).filter("sheet_id like '%a.csv'").orderBy("row_idx").collect()
    assert [(r["section"], r["vals"]) for r in filled] == [("", ["x, y"]), ("P", ["5"]), ("P", ["6"])]


def test_split_sheet_file_keeps_its_order(spark, tmp_path):
    body = "".join(f"s{i // 50},p{i},{i}\n" for i in range(4000))
    (tmp_path / "big.csv").write_text("section,property,col:0\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = sheets.read_sheets(spark, str(tmp_path), 1)
        assert got.count() == 4000
        assert got.filter("property <> concat('p', row_idx)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_price_and_table_files(spark, tmp_path):
    (tmp_path / "p.csv").write_text("400,1000,2000,200.5,x\n")
    assert [tuple(r) for r in sheets.read_prices(spark, str(tmp_path / "p.csv")).collect()] == [(400.0, 1000, 2000, 200.5, "x")]
    (tmp_path / "t.json").write_text(json.dumps([{"data": [[{"text": "W"}, {"text": "5 W"}, {"text": "n/a"}]]}, {"data": [[{"text": "W"}, {"text": "6 W"}, {"text": "7 W"}]]}], indent=1))
    raw = sheets.read_table_json(spark, str(tmp_path)).withColumn("specset", F.lit("m"))
    spec = table_json.spec_table(spark, {"m": {"a": {"row_h": "W", "cell": "([0-9]+)"}, "b": {"c": {"row_h": "Z"}}}})
    assert {r["prefix"]: r["vals"] for r in table_json.match_tables(raw, spec).collect()} == {".a": ["6", "7"], ".b.c": []}


def test_device_files_are_appended(spark, tmp_path):
    df = spark.createDataFrame([("s", 0, "A")], "sheet_id string, col_idx int, model string")
    sheets.write_records(df, str(tmp_path / "o"), ["sheet_id"])
    sheets.write_records(df.withColumn("sheet_id", F.lit("t")), str(tmp_path / "o"), ["sheet_id"])
    assert spark.read.json(str(tmp_path / "o")).count() == 2


HTML = """<html><table class="x"><TR><th>h</th><td>Spec</td><td>A</td><td> B&nbsp;</td></TR>
<tr><td colspan="3"><b>Power</b></td></tr><tr><td>Max</td><td>5 &lt; 6</td><td>7</td></tr>
<tr><td>Both</td><td colspan='2'>8</td></tr></table>
<p>no</p><table><tr><td>All</td><td>9</td></tr><tr><td>Bad</td><td>1</td><td>2</td><td>3</td></tr>
<tr><td>Max</td><td>10</td><td>11</td></tr></table></html>"""


def test_html_columns(spark):
    pages = spark.createDataFrame([(1, HTML), (2, "<p>none</p>")], "page_id long, html string")
    cols = columnize(html.table_rows(pages)).collect()
    got = {(r["model"], r["section"], r["property"]): r["value"] for r in cols}
    assert got == {
        ("A", "Power", "Max"): "10",
        ("B", "Power", "Max"): "11",
        ("A", "Power", "Both"): "8",
        ("B", "Power", "Both"): "8",
        ("A", "Power", "All"): "9",
        ("B", "Power", "All"): "9",
    }


def test_sizes(spark):
    df = spark.createDataFrame([("1x2m",), ("100cmx50",), ("1755x1038",), ("1.5mx80cm",), ("bad",)], "t string")
    got = [tuple(r["s"]) for r in df.select(X.size_mm(F.col("t")).alias("s")).collect()]
    assert got == [(1000, 2000), (1000, 500), (1755, 1038), (1500, 800), (None, None)]


def test_age_limits_and_ties(spark):
    items = spark.createDataFrame([("s", "g", f) for f in "abc"], "stem string, grp string, filename string")
    art = spark.createDataFrame([("s", "g", "download", "a", "2024-01-01"), ("s", "g", "download", "b", "2023-12-31")], "stem string, grp string, stage string, filename string, t string")
    art = art.withColumn("mtime", F.to_timestamp("t"))
    now = F.expr("TIMESTAMP '2024-03-25 00:00:00'")  # 84 days after 2024-01-01
    assert sorted(r["filename"] for r in inc.stale_by_age(items, art, now).collect()) == ["b", "c"]
    assert inc.stale_by_age(items, art, now, force=True).count() == 3
    manifests = spark.createDataFrame([("s", "2020-01-01")], "stem string, t string").select("stem", F.to_timestamp("t").alias("manifest_time"))
    both = art.withColumn("grp", F.lit("tie")).unionByName(art.withColumns({"grp": F.lit("tie"), "stage": F.lit("map"), "mtime": F.to_timestamp(F.lit("2024-01-01"))}))
    states = {r["grp"]: r["state"] for r in inc.stage_state(both, manifests, "download", "map").collect()}
    assert states == {"tie": "run"}


def test_records_keep_field_names():
    names = R.DEVICE["general_data"].dataType.names
    assert names == ["size", "weigth", "noice"]
    assert R.DEVICE["battery_input"].dataType["i_invert"].metadata["units"] == "A"


def test_a_sheet_is_as_wide_as_its_widest_row(spark):
    wide = [("a", 0, "", "Model", "M", None), ("a", 1, "S", "Power", "5 W", "7 W"), ("b", 0, None, "Model", None, None), ("b", 1, "", "Power", "3 W", None)]
    df = spark.createDataFrame(wide, "sheet_id string, row_idx int, section string, property string, `col:0` string, `col:1` string")
    for hot in (False, True):
        got = {(r["sheet_id"], r["row_idx"]): (r["section"], r["vals"]) for r in reshape.sheet_rows(df, 2, hot=hot).collect()}
        assert got == {("a", 0): ("", ["M", None]), ("a", 1): ("S", ["5 W", "7 W"]), ("b", 0): ("", [None]), ("b", 1): ("", ["3 W"])}


def test_only_numbers_become_numbers(spark):
    texts = ["20", "20d", "20f", " 7 ", "1.5", "1e3", "NaN", "-2", "0x1", ".5", "5.", "", "1_0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    types = R.leaf_types(R.DEVICE)
    got = df.select(R.coerce_one(F.col("t"), types["general_data.weigth"]).alias("d"), R.coerce_one(F.col("t"), types["pv_input.v_nom"]).alias("i")).collect()
    assert [r["d"] for r in got] == [20.0, None, None, 7.0, 1.5, 1000.0, None, -2.0, None, 0.5, 5.0, None, None]
    assert [r["i"] for r in got] == [20, None, None, 7, None, None, None, -2, None, None, None, None, None]


def test_template_is_filled_in_one_pass(spark):
    df = spark.createDataFrame([("{a}-{b}", {"a": "{b}", "b": "Z"}), ("x{c}{a}", {"a": "1"}), ("{", {}), ("", {"a": "1"})], "t string, p map<string,string>")
    got = df.select(X.fill_template(F.col("t"), F.col("p")), X.unknown_names(F.col("t"), F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("{b}-Z", []), ("x1", ["c"]), ("{", []), ("", [])]


def test_blank_values_add_nothing(spark):
    cells = [("s", 0, "x", "p", 1.0, 1, ""), ("s", 0, "x", "p", 2.0, 2, "v"), ("s", 0, "x", "p", 3.0, 3, "w"), ("s", 0, "x", "q", 1.0, 1, "")]
    df = spark.createDataFrame(cells, "sheet_id string, col_idx int, section string, property string, midy double, frag_id int, value string")
    for hot in (False, True):
        assert {r["property"]: r["value"] for r in reshape.concat_attributes(df, hot=hot).collect()} == {"p": "v w", "q": ""}


def test_the_last_of_a_repeated_property_counts(spark):
    df = spark.createDataFrame([("s", 0, 0, "x", "p", "old"), ("s", 0, 3, "x", "p", "new"), ("s", 0, 1, None, "q", "z")], "sheet_id string, col_idx int, row_idx int, section string, property string, value string")
    assert [r["props"] for r in sheets.column_json(df).collect()] == [{"x": {"p": "new"}, "": {"q": "z"}}]


def test_small_sheets_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sheets, "TASK_FILES", 5)
    wide = spark.range(120).selectExpr("id div 3 as sheet_id", "int(id % 3) as row_idx", "'S' as section", "concat('p', id) as property", "string(id) as `col:0`")
    sheets.write_sheets(wide.groupBy("sheet_id", "row_idx", "section", "property").agg(F.max("col:0").alias("col:0")), str(tmp_path / "w"), ["sheet_id"])
    files = list((tmp_path / "w").rglob("*.csv"))
    assert len(files) == 40
    by_task: dict[str, int] = {}
    for f in files:
        by_task[f.name[:10]] = by_task.get(f.name[:10], 0) + 1
    assert len(by_task) >= 6 and max(by_task.values()) <= 15
    for hot in (None, False, True):
        got = sheets.read_sheets(spark, str(tmp_path / "w"), 1, hot=hot)
        assert got.count() == 120
        assert got.filter("int(`col:0`) <> 3 * int(regexp_extract(sheet_id, 'sheet_id=([0-9]+)/', 1)) + row_idx").count() == 0


def test_sheets_are_read_some_folders_at_a_time(spark, tmp_path, monkeypatch):
    """The driver listed all files at once, and the job was committed file by file."""
    monkeypatch.setattr(sheets, "TASK_FILES", 5)
    keys = [None, *range(39)]
    wide = spark.createDataFrame([(k, i, "S" if i else None, f"p{i}", f"{k},\n{i}") for k in keys for i in range(3)], "sheet_id long, row_idx int, section string, property string, `col:0` string")
    sheets.write_sheets(wide, str(tmp_path / "w"), ["sheet_id"])
    files = list((tmp_path / "w").rglob("*.csv"))
    by_task: dict[str, set] = {}
    for f in files:
        by_task.setdefault(f.name[:10], set()).add(f.parent.parent)
    assert len(files) == 40 and all(len(x) == 1 for x in by_task.values())
    assert not list((tmp_path / "w").rglob(".part*.crc"))
    made = []
    monkeypatch.setattr(sheets, "written", lambda df: made.append(len(df.inputFiles())) or written(df))
    monkeypatch.setattr(sheets, "READ_FOLDERS", 2)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    got = sheets.read_sheets(spark, str(tmp_path / "w"))
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert len(made) > 2 and sum(made) == 40
    key = F.regexp_extract("sheet_id", "sheet_id=([^/]+)/", 1).try_cast("long").alias("key")
    assert sorted(map(str, got.select(key, "row_idx", "section", "property", "col:0").collect())) == sorted(map(str, wide.withColumnRenamed("sheet_id", "key").collect()))
    (tmp_path / "w" / "other").mkdir()
    (tmp_path / "w" / "other" / "x.csv").write_text("section,property,col:0\n,Model,x\n", encoding="utf-8")
    assert sheets.read_sheets(spark, str(tmp_path / "w"), 1).count() == 121


def test_fields_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('section,property,col:0\nS,"A\nB",1\nsection,property,x\n')
    got = sheets.read_sheets(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [(r["section"], r["property"], r["col:0"]) for r in got] == [("S", "A\nB", "1"), ("section", "property", "x")]


def test_html_references_and_nested_tables(spark):
    page = (
        "<table><tr><td>a&#8211;b</td><td>&deg;&plusmn;&nbsp;&#x41;&#39;&apos;&amp;lt;&unknown;&#0;</td></tr>"
        "<tr><td>x<TABLE id=2><tr><td>in</td></tr></TABLE>y</td></tr><tr><td colspan='2'>after</td></tr></table><table><tr><td>last"
    )
    got = html.table_cells(spark.createDataFrame([(1, page)], "page_id int, html string")).orderBy("table_idx", "row_idx", "cell_idx").collect()
    assert [(r["table_idx"], r["row_idx"], r["text"], r["colspan"]) for r in got] == [
        (0, 0, "a\u2013b", 1), (0, 0, "\u00b0\u00b1\u00a0A''&lt;&unknown;&#0;", 1), (0, 1, "xiny", 1), (0, 2, "after", 2), (1, 0, "in", 1), (2, 0, "last", 1),
    ]
