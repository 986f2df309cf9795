"""Point in polygon (FIXTURES 1.4), reprojection, grid coordinates."""

import pytest
from pyspark.sql import functions as F

from wxgrid.functions.geometry import rectifying_latitude, tm_to_lonlat
from wxgrid.operators import spatial

RING = "array<array<struct<x:double,y:double>>>"


def _polys(spark):
    sq = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]]
    other = [[(3.0, 0.0), (6.0, 0.0), (6.0, 2.0), (3.0, 2.0)]]
    return spark.createDataFrame([("SQ", "square", sq), ("OV", "overlap", other)],
                                 f"code string, name string, rings {RING}")


POINTS = {1: (0.5, 0.5), 2: (0.5, 3.0), 3: (3.5, 1.0), 4: (2.0, 2.0), 5: (5.0, 5.0), 6: (-1.0, 1.0),
          7: (0.0, 2.0), 8: (4.0, 4.0), 9: (1.0, 2.0)}


@pytest.mark.parametrize("tile", [0.05, 1.0, 10.0])
def test_square_with_hole(spark, tile):
    pts = spark.createDataFrame([(k, x, y) for k, (x, y) in POINTS.items()], "grid_idx long, lon double, lat double")
    out = spatial.points_in_polygons(pts, _polys(spark), "code", "name", tile=tile)
    got = sorted((r["grid_idx"], r["code"]) for r in out.collect())
    # 1-3 inside the square; 3 also inside the overlapping rectangle (fan-out);
    # hole, outside and boundary points keep one row with NULL.
    assert got == [(1, "SQ"), (2, "SQ"), (3, "OV"), (3, "SQ"), (4, None), (5, None), (6, None),
                   (7, None), (8, None), (9, None)]


def test_tile_join_is_not_nested_loop(spark):
    pts = spark.createDataFrame([(1, 0.5, 0.5)], "grid_idx long, lon double, lat double")
    out = spatial.points_in_polygons(pts, _polys(spark), "code", "name")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_reprojection_origin(spark):
    df = spark.createDataFrame([(1000000.0, 2000000.0)], "e double, n double")
    lon, lat = tm_to_lonlat(F.col("e"), F.col("n"))
    r = df.select(lon.alias("lon"), lat.alias("lat")).first()
    assert abs(r["lon"] - 127.5) < 1e-9 and abs(r["lat"] - 38.0) < 1e-9
    assert abs(rectifying_latitude(38.0) - 0.6607823512) < 1e-9


def test_reprojected_ring(spark):
    polys = spark.createDataFrame([("A", "a", [[(900000.0, 1900000.0), (1100000.0, 1900000.0),
                                                 (1100000.0, 2100000.0), (900000.0, 2100000.0)]])],
                                  f"code string, name string, rings {RING}")
    ll = spatial.reproject_rings(polys)
    pts = spark.createDataFrame([(1, 127.5, 38.0), (2, 140.0, 38.0)], "grid_idx long, lon double, lat double")
    out = sorted((r["grid_idx"], r["code"]) for r in spatial.points_in_polygons(pts, ll, "code", "name").collect())
    assert out == [(1, "A"), (2, None)]


def test_mesh_and_rows(spark):
    axes = spark.createDataFrame([([30.0, 31.0, 32.0], [120.0, 121.0])], "lat array<double>, lon array<double>")
    mesh = sorted(tuple(r) for r in spatial.grid_from_axes(axes).collect())
    assert mesh == [(0, 30.0, 120.0), (1, 30.0, 121.0), (2, 31.0, 120.0), (3, 31.0, 121.0),
                    (4, 32.0, 120.0), (5, 32.0, 121.0)]
    rows = spark.createDataFrame([(0, [1.0, 2.0], [5.0, 6.0]), (1, [3.0, 4.0], [7.0, 8.0])],
                                 "y int, lat array<double>, lon array<double>")
    flat = sorted(tuple(r) for r in spatial.grid_from_rows(rows).collect())
    assert flat == [(0, 1.0, 5.0), (1, 2.0, 6.0), (2, 3.0, 7.0), (3, 4.0, 8.0)]


def test_unified_mapping_and_profile(spark):
    h = spark.createDataFrame([(1, 1.0, 2.0, "H1", "h1"), (2, 1.0, 2.0, None, None), (3, 1.0, 2.0, "H3", "h3")],
                              "grid_idx long, lat double, lon double, HJD_CD string, HJD_NM string")
    b = spark.createDataFrame([(1, "E1", "e1"), (3, None, None), (4, "E4", "e4")],
                              "grid_idx long, EMD_CD string, EMD_NM string")
    u = spatial.unified_mapping(h, b)
    assert sorted(r["grid_idx"] for r in u.collect()) == [1, 2, 3, 4]
    assert [r["lat"] for r in u.collect() if r["grid_idx"] == 4] == [None]
    p = spatial.mapping_profile(u).first().asDict()
    assert p == {"cells": 4, "mapped_hjd": 2, "mapped_bjd": 2, "mapped_both": 1, "hjd_only": 1,
                 "bjd_only": 1, "unmapped": 1}


def _py_within(px, py, rings):
    cross, on = 0, False
    for ring in rings:
        n = len(ring)
        for i in range(n):
            (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
            if (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) == 0 and min(x1, x2) <= px <= max(x1, x2) \
                    and min(y1, y2) <= py <= max(y1, y2):
                on = True
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                cross += 1
    return cross % 2 == 1 and not on


def test_random_polygons_against_brute_force(spark):
    import math
    import random
    rng = random.Random(5)
    polys = []
    for k in range(6):
        cx, cy = rng.uniform(0, 3), rng.uniform(0, 3)
        m = rng.randint(5, 40)
        outer = [(round(cx + rng.uniform(0.3, 1.0) * math.cos(2 * math.pi * i / m), 3),
                  round(cy + rng.uniform(0.3, 1.0) * math.sin(2 * math.pi * i / m), 3)) for i in range(m)]
        hole = [(round(cx + 0.1 * math.cos(2 * math.pi * i / 4), 3), round(cy + 0.1 * math.sin(2 * math.pi * i / 4), 3))
                for i in range(4)]
        polys.append((f"P{k}", f"p{k}", [outer, hole]))
    pts = [(i, round(rng.uniform(-1, 4), 2), round(rng.uniform(-1, 4), 2)) for i in range(1500)]
    pts += [(2000 + i, x, y) for i, (x, y) in enumerate(p for _, _, rings in polys for p in rings[0][:3])]
    pdf = spark.createDataFrame(polys, f"code string, name string, rings {RING}")
    sdf = spark.createDataFrame(pts, "grid_idx long, lon double, lat double")
    got = sorted((r["grid_idx"], r["code"] or "") for r in
                 spatial.points_in_polygons(sdf, pdf, "code", "name", tile=0.1).collect())
    exp = []
    for pid, x, y in pts:
        hits = [c for c, _, rings in polys if _py_within(x, y, rings)]
        exp += [(pid, c) for c in hits] or [(pid, "")]
    assert got == sorted(exp)


def test_reproject_respects_epsg_column(spark):
    rows = [("P", "p", [[(1000000.0, 2000000.0), (1000001.0, 2000000.0), (1000000.0, 2000001.0)]], 5179),
            ("G", "g", [[(127.0, 37.0), (127.1, 37.0), (127.0, 37.1)]], 4326)]
    df = spark.createDataFrame(rows, f"code string, name string, rings {RING}, epsg int")
    out = {r["code"]: r["rings"][0][0] for r in spatial.reproject_rings(df).collect()}
    assert abs(out["P"]["x"] - 127.5) < 1e-9 and abs(out["P"]["y"] - 38.0) < 1e-9
    assert (out["G"]["x"], out["G"]["y"]) == (127.0, 37.0)


def test_equal_points_keep_their_rows(spark):
    rows = [(1, 50.0, 50.0), (1, 50.0, 50.0), (2, 60.0, 60.0), (3, None, 1.0)]
    pts = spark.createDataFrame(rows, "grid_idx long, lon double, lat double")
    out = spatial.points_in_polygons(pts, _polys(spark), "code", "name").collect()
    assert sorted(r["grid_idx"] for r in out) == [1, 1, 2, 3]
    assert all(r["code"] is None for r in out)


def test_index_is_lazy_and_levels_agree(spark, monkeypatch):
    """A large polygon with a dense saw edge and a hole, an overlapping copy,
    and rings that touch cell borders: the same as one ray cast over all edges,
    whatever the cell size."""
    import random
    rng = random.Random(9)
    saw = [(k / 50, 2.0 + (k % 2) * 0.3) for k in range(0, 301)] + [(6.0, -1.0), (0.0, -1.0)]
    hole = [(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0)]
    polys = [("S", "s", [saw, hole]), ("S2", "s", [saw]), ("B", "b", [[(0.0, 0.0), (1.6, 0.0), (1.6, 1.6), (0.0, 1.6)]]), ("E", "e", []), ("N", "n", None)]
    pts = [(i, rng.uniform(-0.5, 6.5), rng.uniform(-1.5, 2.5)) for i in range(1200)]
    pts += [(5000 + i, x, y) for i, (x, y) in enumerate([(1.0, 0.5), (1.0, 1.0), (0.0, 0.0), (1.6, 0.8), (0.8, 0.8), (3.0, 1.5), (float("nan"), 0.5), (None, 0.5), (0.8, 0.0)])]
    pdf = spark.createDataFrame(polys, f"code string, name string, rings {RING}")
    sdf = spark.createDataFrame(pts, "pid long, x double, y double")
    want = sorted((i, c) for i, x, y in pts for c in ([c for c, _, r in polys if r and x is not None and _py_within(x, y, r)] or [""]))
    for tile in (0.0125, 0.4):
        out = spatial.points_in_polygons(sdf, pdf, "code", "name", x_col="x", y_col="y", tile=tile)
        assert sorted((r["pid"], r["code"] or "") for r in out.collect()) == want
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    spatial.points_in_polygons(sdf, pdf, "code", "name", x_col="x", y_col="y")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(before)   # planning starts no job


def test_columns_found_by_candidate_name(spark, tmp_path):
    import pytest

    from wxgrid.catalogue import find_name
    from wxgrid.sources.readers import read_polygons
    assert find_name(["b", "Adm_Cd", "ADM_CD"], ["adm_nm", "ADM_CD"]) == "ADM_CD"
    assert find_name(["b", "Adm_Cd"], ["adm_nm", "adm_cd"]) == "Adm_Cd" and find_name(["b"], ["a"]) is None
    spark.createDataFrame([("1", [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]])], f"Adm_Cd string, rings {RING}").write.parquet(str(tmp_path / "layer"))
    with pytest.warns(UserWarning, match="no column for NM"):
        df = read_polygons(spark, str(tmp_path / "layer"), ["adm_cd"], ["adm_nm"], "CD", "NM")
    assert [tuple(r) for r in df.select("CD", "NM").collect()] == [("1", None)]
