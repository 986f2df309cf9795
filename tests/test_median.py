"""Exact weighted median by selection against numpy."""

import random

import numpy as np

from wxgrid.operators import regional


def test_weighted_median(spark):
    rng = random.Random(3)
    rows = []
    for g in range(40):
        n = rng.randint(1, 30)
        kind = g % 4
        for _ in range(n):
            v = {0: rng.gauss(0, 30), 1: float(rng.randint(-2, 2)), 2: 20 + rng.random() * 1e-4, 3: rng.choice([-0.0, 0.0, -1e300, 1e300, 5e-324])}[kind]
            rows.append((f"r{g}" if g else None, None if g % 5 == 0 else g % 3, v, rng.choice([1, 1, 1, 2, 3])))
    rows += [("hot", 1, rng.gauss(15, 0.01), 1) for _ in range(20_000)]   # a skewed group within few bins
    df = spark.createDataFrame(rows, "code string, slot int, v double, w long").repartition(7)
    got = {(r["code"], r["slot"]): r["val"] for r in regional.weighted_median(df, ["code", "slot"]).collect()}
    want = {}
    for code, slot, v, w in rows:
        want.setdefault((code, slot), []).extend([v] * w)
    assert set(got) == set(want)
    for k, vs in want.items():
        assert got[k] == np.median(vs), k


def test_no_group_is_gathered(spark):
    df = spark.createDataFrame([("a", 1.0, 1)], "code string, v double, w long")
    plan = regional.weighted_median(df, ["code"])._jdf.queryExecution().executedPlan().toString().lower()
    assert "median" not in plan and "percentile" not in plan and "collect_list" not in plan
