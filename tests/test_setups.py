"""Panels wired to devices."""

from __future__ import annotations

import random

from specloom.operators.setups import best_setups, in_range

INF, NAN = float("inf"), float("nan")


def test_points_in_ranges_of_all_sizes(spark):
    rnd = random.Random(1)
    points = [(i, rnd.choice([rnd.uniform(-1e3, 1e3), float(rnd.randint(-9, 9)), 1e12, 1e-9, None, NAN, INF])) for i in range(400)]
    ranges = []
    for j in range(300):
        a = rnd.choice([rnd.uniform(-1e3, 1e3), float(rnd.randint(-9, 9)), 0.0])
        ranges.append((j, *rnd.choice([(a, a), (a, a + rnd.uniform(0, 2)), (a, a + 10 ** rnd.randint(-6, 13)), (a, a - 1), (None, a), (a, None), (NAN, a), (-INF, INF)])))
    p, r = spark.createDataFrame(points, "i int, x double"), spark.createDataFrame(ranges, "j int, lo double, hi double")
    got = sorted((q.i, q.j) for q in in_range(p, r, "x", "lo", "hi").collect())
    bad = lambda v: v is None or v != v or abs(v) == INF
    assert got == sorted((i, j) for i, x in points if not bad(x) for j, lo, hi in ranges if not bad(lo) and not bad(hi) and lo <= x <= hi)
    assert in_range(p, r.where("false"), "x", "lo", "hi").collect() == []


def test_setups_against_a_loop(spark):
    rnd = random.Random(2)
    panels = [(i, rnd.choice([0, 1, 6, 7, 12, 24]), rnd.choice([30.0, 41.5]), rnd.choice([8.0, 10.0, None])) for i in range(60)]
    devices = [(j, *rnd.choice([(100.0, 300.0), (200.0, 450.0), (None, 400.0), (90.0, 95.0)]), rnd.choice([9.0, 20.0, 40.0, None])) for j in range(30)]
    got = best_setups(spark.createDataFrame(panels, "panel_id int, pieces long, volts double, amps double"), spark.createDataFrame(devices, "device_id int, v_min double, v_max double, i_max double"))
    want = []
    for i, n, v, a in panels:
        fits = []
        for j, lo, hi, most in devices:
            if lo is None or most is None or a is None:
                continue
            ways = [(s, n // s) for s in range(1, n + 1) if n % s == 0 and lo <= s * v <= hi and n // s * a <= most]
            if ways:
                s, p = max(ways)
                fits.append((p, hi, most, lo, s, j))
        best = min(fits, default=None)
        want.append((i, len(fits), *((best[5], best[4], best[0]) if best else (None,) * 3)))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert any(w[1] for w in want)
