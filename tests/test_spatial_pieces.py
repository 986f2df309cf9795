"""Large polygons are indexed in pieces and the index is never broadcast."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_spatial import RING, _py_within
from wxgrid.operators import spatial


def _shapes():
    rng = random.Random(3)
    saw = [(k / 50, 2.0 + (k % 2) * 0.3) for k in range(0, 301)] + [(6.0, -1.0), (0.0, -1.0)]
    hole = [(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0), (1.0, 0.0)]
    tangle = [(rng.uniform(0, 6), rng.uniform(-1, 2)) for _ in range(70)]
    return [("S", "s", [saw, hole]), ("S", "s", [saw, hole]), ("T", "t", [tangle]), ("P", "p", [[(0.5, 0.5)]]), ("N", "n", None), ("M", "m", [None, saw])]


@pytest.mark.parametrize("piece", [16, 40])
def test_pieces_of_polygons(spark, monkeypatch, piece):
    monkeypatch.setattr(spatial, "PIECE_EDGES", piece)
    rng = random.Random(4)
    pts = [(i, rng.uniform(-0.5, 6.5), rng.uniform(-1.5, 2.5)) for i in range(400)] + [(900, 1.0, 0.5), (901, 0.02, 2.3), (902, None, 0.5)]
    polys = spark.createDataFrame(_shapes(), f"code string, name string, rings {RING}").coalesce(2)
    points = spark.createDataFrame(pts, "pid long, level double, hit double")  # names of the index's own columns
    out = spatial.points_in_polygons(points, polys, "code", "name", x_col="level", y_col="hit", tile=0.1)
    got = sorted((r["pid"], r["code"] or "") for r in out.collect())
    assert got == sorted((i, c) for i, x, y in pts for c in ([c for c, _, r in _shapes() if r and None not in r and x is not None and _py_within(x, y, r)] or [""]))
    rows = spatial._prepared(polys, "code", "name").select("pid", "code", F.size("edges").alias("n")).collect()
    assert max(r["n"] for r in rows) <= piece and sum(r["n"] for r in rows if r["code"] == "S") == 2 * (303 + 5)
    assert len({r["pid"] for r in rows}) == 3


def test_index_is_not_broadcast(spark):
    polys = spark.createDataFrame(_shapes()[:1], f"code string, name string, rings {RING}")
    points = spark.range(5).select(F.col("id").alias("pid"), F.col("id").cast("double").alias("lon"), F.lit(0.5).alias("lat"))
    out = spatial.points_in_polygons(points, polys, "code", "name")
    assert len(out.collect()) == 5  # Spark chooses as it runs
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
