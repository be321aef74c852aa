from __future__ import annotations

import random

import pytest
from oracle import assert_oracle

from specloom.llm import linededup
from specloom.llm.joins import without
from specloom.llm.linededup import BLANK, boilerplate, dedup_lines, line_rows
from specloom.llm.queries import QUERIES


def plain(rows, min_sites):
    """(kept text, lines, removed) of each row by its place."""
    sites, first = {}, {}
    for doc, text, site in rows:
        for line in (text or "").split("\n"):
            line = line.strip(BLANK)
            if line:
                if site is not None:
                    sites.setdefault(line, set()).add(site)
                if doc is not None:
                    first[line] = min(doc, first.get(line, doc))
    known = {x for x, s in sites.items() if len(s) >= min_sites}
    out = []
    for doc, text, _ in rows:
        kept, seen, n, gone = [], set(), 0, 0
        for raw in (text or "").split("\n"):
            line = raw.strip(BLANK)
            n += line != ""
            here = doc == first.get(line) and line not in seen
            seen.add(line)
            if line in known and not here:
                gone += 1
            else:
                kept.append(raw)
        out.append((doc, text if not gone else "\n".join(kept), n, gone))
    return out


def rows_of(seed, n=300):
    rng = random.Random(seed)
    words = [f"line {i}" for i in range(40)] + ["", "  ", "\t"]
    return [(rng.choice([i, i, None]), "\n".join(rng.choice([" ", ""]) + rng.choice(words) + rng.choice(["", "\r"]) for _ in range(rng.randrange(6))), rng.choice([None, *"abcdefg"])) for i in range(n)]


@pytest.mark.parametrize("min_sites", [2, 5, 7])
def test_against_plain(spark, min_sites):
    rows = rows_of(min_sites) + [(5000, None, "a"), (5001, "", "b"), (4000, "x\n" * 20_000 + "line 3", "a"), (4000, "x\n" * 20_000 + "line 3", "a")] + [(6000 + i, "x", s) for i, s in enumerate("bcdefgh")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    got = sorted(str(tuple(r)) for r in dedup_lines(df, min_sites=min_sites).select("doc_id", "kept_text", "n_lines", "n_removed").collect())
    assert got == sorted(str(x) for x in plain(rows, min_sites))


def test_large_spread_uses_the_sketch(spark):
    lines = spark.range(30_000).selectExpr("id % 3 AS doc", "concat('l', id % 3) AS l", "concat('s', CASE WHEN id % 3 = 0 THEN id ELSE id % (997 + id % 3) END) AS site").selectExpr("doc", "xxhash64(l) AS h1", "xxhash64(7, l) AS h2", "site")
    want = {r.h1 for r in lines.groupBy("h1").agg({"site": "approx_count_distinct"}).collect() if r[1] > 5000}
    assert {r.h1 for r in boilerplate(lines, 3000).collect()} == want and len(want) == 1


def test_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "s", 5, "b", 2)], "doc_id bigint, text string, source string, n_lines int, KEPT_TEXT string, k1 int")
    got = dedup_lines(df).collect()
    assert got[0].asDict() == {"doc_id": 1, "text": "a", "source": "s", "kept_text": "a", "n_lines": 1, "n_removed": 0}
    assert dedup_lines(df.where("false")).count() == 0
    assert line_rows(without(df, "k1"), "doc_id", "text", "source").count() == 1
    with pytest.raises(ValueError):
        boilerplate(df, 1)
    assert linededup.MIN_SITES == 5


def test_query(spark):
    assert_oracle(spark, "op5_lines", QUERIES)


def test_any_column_name_passes(spark):
    names = ["lines", "removed", "row", "at", "pos", "doc", "first_doc", "h1", "h2", "site", "sketch", "sites", "n", "r"]
    df = spark.createDataFrame([(i, "same line\nown %d" % i, "s%d" % i, *[f"{n}{i}" for n in names]) for i in range(6)], ["doc_id", "text", "source", *names])
    got = dedup_lines(df).collect()
    assert len(got) == 6 and sorted(r.n_removed for r in got) == [0, 1, 1, 1, 1, 1]
    assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in names)
