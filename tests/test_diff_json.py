"""Differences of nested documents."""

from __future__ import annotations

import json
import random

from specloom.operators.diff_json import diff_json, json_nodes


def kind(v):
    return {dict: "object", list: "array", str: "string", bool: "boolean", int: "int", float: "float", type(None): "null"}[type(v)]


def show(v):
    return v if isinstance(v, str) else json.dumps(v)


def loop(a, b, path="$"):
    if type(a) is not type(b):
        return [(path, "type", kind(a), kind(b))]
    out = []
    if isinstance(a, list):
        if len(a) != len(b):
            out.append((path, "length", str(len(a)), str(len(b))))
        for i, (x, y) in enumerate(zip(a, b)):
            out += loop(x, y, f"{path}[{i}]")
    elif isinstance(a, dict):
        for k in sorted({*a, *b}):
            step = f"{path}.{k if k.isidentifier() and k.isascii() else json.dumps(k, ensure_ascii=False)}"
            if k not in b:
                out.append((step, "only_old", kind(a[k]), None))
            elif k not in a:
                out.append((step, "only_new", None, kind(b[k])))
            else:
                out += loop(a[k], b[k], step)
    elif a != b:
        out.append((path, "value", show(a), show(b)))
    return out


def made(rnd, depth):
    pick = rnd.random()
    if depth and pick < 0.35:
        return {rnd.choice(["a", "b", "c d", "é", "x.y", 'q"r', "", "0"]): made(rnd, depth - 1) for _ in range(rnd.randint(0, 4))}
    if depth and pick < 0.6:
        return [made(rnd, depth - 1) for _ in range(rnd.randint(0, 4))]
    return rnd.choice([1, 2, -7, 1.5, 2.0, "1", "text", "", True, False, None, "é"])


def edited(rnd, v):
    if rnd.random() < 0.12:
        return made(rnd, 2)
    if isinstance(v, dict):
        out = {k: edited(rnd, x) for k, x in v.items() if rnd.random() > 0.1}
        return out | ({"new": made(rnd, 1)} if rnd.random() < 0.2 else {})
    if isinstance(v, list):
        return [edited(rnd, x) for x in v][: rnd.randint(0, 9)]
    return v


def result(spark, old, new):
    frames = [spark.createDataFrame(rows, "k1 long, side string, json string") for rows in (old, new)]
    return sorted((tuple(r) for r in diff_json(*frames, ["k1", "side"]).collect()), key=str)


def test_against_a_recursive_walk(spark):
    rnd = random.Random(3)
    old = {i: made(rnd, 4) for i in range(120)}
    new = {i: edited(rnd, v) for i, v in old.items() if i % 9}
    new |= {900 + i: made(rnd, 2) for i in range(3)}
    want = []
    for i in {**old, **new}:
        if i not in new:
            want.append((i, "s", "$", "only_old", kind(old[i]), None))
        elif i not in old:
            want.append((i, "s", "$", "only_new", None, kind(new[i])))
        else:
            want += [(i, "s", *d) for d in loop(old[i], new[i])]
    got = result(spark, *([(i, "s", json.dumps(v)) for i, v in side.items()] for side in (old, new)))
    assert got == sorted(want, key=str) and len({r[3] for r in got}) == 5


def test_odd_documents(spark):
    deep = "[" * 30 + "1" + "]" * 30
    old = [(1, None, "{bad"), (2, "x", None), (3, "x", "{bad"), (None, "n", "1"), (5, "x", '{"a":1}'), (6, "x", deep), (7, "x", "1.0"), (8, "x", "[]")]
    new = [(1, None, "{bad"), (2, "x", "[]"), (3, "x", "{worse"), (None, "n", "2"), (5, "x", '{"a":1} '), (6, "x", deep.replace("1", "2")), (7, "x", "1e0"), (8, "x", "{}")]
    assert result(spark, old, new) == sorted(
        [
            (2, "x", "$", "only_new", None, "array"),
            (3, "x", "$", "value", "{bad", "{worse"),
            (None, "n", "$", "value", "1", "2"),
            (6, "x", "$" + "[0]" * 30, "value", "1", "2"),
            (8, "x", "$", "type", "array", "object"),
        ],
        key=str,
    )
    assert result(spark, [], []) == []


def test_nodes_of_one_document(spark):
    df = spark.createDataFrame([(1, '{"a":[1,{"b c":null}],"z":"t"}')], "id int, doc string")
    got = sorted((r.path, r.parent, r.kind, r.length, r.value) for r in json_nodes(df, ["id"], "doc").collect())
    assert got == [
        ("$", None, "object", 2, None),
        ("$.a", "$", "array", 2, None),
        ("$.a[0]", "$.a", "int", None, "1"),
        ("$.a[1]", "$.a", "object", 1, None),
        ('$.a[1]."b c"', "$.a[1]", "null", None, "null"),
        ("$.z", "$", "string", None, "t"),
    ]
