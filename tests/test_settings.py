from __future__ import annotations

from specloom.operators.settings import settings_tables


def test_options_become_tables(spark):
    good = {"source": "d", "area": "[1, 2.5, 3, 4]", "sections": "first-col", "multiline_row_header": "True", "fix": '{"cols": [{"row": "A", "spans": [1, 2]}, {"row": "B", "spans": [3]}], "joiner": [{"row": "C", "seq": ""}], "add_cell": [{"row_text": "r", "col_text": "c", "text": "t"}]}'}
    bad = {
        "no source": {"area": "[1,2,3,4]"},
        "no area": {"source": "d", "area": None},
        "area is not four numbers": {"source": "d", "area": "[1,2,3]"},
        "page is no number from 1": {"source": "d", "area": "[1,2,3,4]", "page": "0"},
        "unknown kind of sections": {"source": "d", "area": "[1,2,3,4]", "sections": "middle"},
        "fix cannot be read": {"source": "d", "area": "[1,2,3,4]", "fix": "[oops"},
    }
    rows = [("g", 0, good), *[("g", i + 1, o) for i, o in enumerate(bad.values())], ("h", 0, {})]
    t = settings_tables(spark.createDataFrame(rows, "grp string, seq int, opts map<string,string>"), ["grp", "seq"])
    assert [tuple(r) for r in t.config.collect()] == [("g/0", "g", 0, "d", 1, 1.0, 2.5, 3.0, 4.0, "first-col", True, False)]
    assert [tuple(r) for r in t.fixed.collect()] == [("g/0", 0, "A", [1, 2]), ("g/0", 1, "B", [3])]
    assert [tuple(r) for r in t.joiners.collect()] == [("g/0", 0, "C", "")] and [tuple(r) for r in t.added.collect()] == [("g/0", 0, "r", "c", "t")]
    assert {(r["grp"], r["seq"]): r["reason"] for r in t.rejects.collect()} == {**{("g", i + 1): k for i, k in enumerate(bad)}, ("h", 0): "no source"}
