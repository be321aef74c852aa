"""Fragments in a box, by pattern, in order."""

from __future__ import annotations

import random
import re

import pytest

from specloom.operators.find import SORTS, find

FRAGMENT = "doc_id string, page int, frag_id int, text string, minx double, miny double, maxx double, maxy double"
REQUEST = "doc_id string, page int, find_id int, q_minx double, q_miny double, q_maxx double, q_maxy double"


def loop(requests, fragments, pattern, ret, how, sort):
    rx, out = re.compile(pattern), []
    for d, p, q, *box in requests:
        hits = []
        for fd, fp, f, text, *b in sorted(fragments, key=lambda r: r[2]):
            if (fd, fp) != (d, p) or text is None or not rx.search(text):
                continue
            if box[0] is not None:
                inside = box[0] <= b[0] and b[2] <= box[2] and box[1] <= b[1] and b[3] <= box[3]
                touch = max(box[0], b[0]) < min(box[2], b[2]) and max(box[1], b[1]) < min(box[3], b[3])
                if not (inside if how == "contains" else touch):
                    continue
            m = rx.search(text)
            none = lambda g: g or None
            x = {"text": text, "match": none(m.group(1)) if rx.groups == 1 else m.group(0), "groups": [none(g) for g in m.groups()], "textline": (text, *b)}[ret]
            hits.append((f, b, x))
        if sort:
            side, sign = {"minx": 0, "miny": 1}[SORTS[sort][0]], SORTS[sort][1]
            hits.sort(key=lambda h: h[1][side] * sign)
        out += [(d, p, q, n, f, x) for n, (f, _, x) in enumerate(hits)]
    return sorted(map(str, out))


def made(rnd, n):
    out = []
    for i in range(n):
        x, y = rnd.choice([rnd.uniform(0, 100), 10.0 * rnd.randrange(10)]), rnd.choice([rnd.uniform(0, 300), 30.0])
        out.append((rnd.choice("ab"), rnd.randint(1, 2), i, rnd.choice(["10 V", "20 kg", "x", None, "ab-12", ""]), x, y, x + rnd.choice([0.0, 5.0, 60.0]), y + rnd.choice([0.0, 8.0, 120.0])))
    return out


@pytest.mark.parametrize(
    ("pattern", "ret", "how", "sort"),
    [(".*", "text", "contains", None), ("([0-9]+)( kg)?", "groups", "intersects", "left"), ("^([a-z]+)", "match", "contains", "up"), (r"\d+ (?:V|kg)", "match", "intersects", "right"), ("-", "textline", "contains", "down"), ("V", "groups", "contains", None)],
)
def test_against_a_loop(spark, pattern, ret, how, sort):
    rnd = random.Random(len(pattern))
    fragments = made(rnd, 400)
    requests = []
    for q in range(60):
        x, y = rnd.uniform(-20, 110), rnd.uniform(-20, 320)
        box = rnd.choice([(None,) * 4, (x, y, x + rnd.choice([1.0, 30.0, 200.0]), y + rnd.choice([1.0, 50.0, 500.0])), (x, y, x - 1, y)])
        requests.append((rnd.choice("abc"), rnd.randint(1, 2), q, *box))
    got = find(spark.createDataFrame(requests, REQUEST), spark.createDataFrame(fragments, FRAGMENT), pattern=pattern, ret=ret, how=how, sort=sort).collect()
    value = {"groups": lambda r: r.groups, "textline": lambda r: (r.value, r.minx, r.miny, r.maxx, r.maxy)}.get(ret, lambda r: r.value)
    mine = sorted(str((r.doc_id, r.page, r.find_id, r.match_no, r.frag_id, value(r))) for r in got)
    assert mine == loop(requests, fragments, pattern, ret, how, sort)


def test_hot_page_and_empty(spark):
    rnd = random.Random(2)
    fragments, requests = made(rnd, 300), [("a", 1, 0, None, None, None, None), ("a", 1, 1, 0.0, 0.0, 90.0, 200.0)]
    a, b = spark.createDataFrame(requests, REQUEST), spark.createDataFrame(fragments, FRAGMENT)
    plain = sorted(map(str, find(a, b, sort="up", hot=False).collect()))
    spark.conf.set("specloom.hotRows", "40")
    try:
        assert sorted(map(str, find(a, b, sort="up").collect())) == plain
    finally:
        spark.conf.unset("specloom.hotRows")
    assert find(a, b.where("false")).collect() == [] and find(a.where("false"), b).collect() == []
    for bad in ({"ret": "all"}, {"sort": "north"}, {"how": "near"}):
        with pytest.raises(ValueError):
            find(a, b, **bad)
