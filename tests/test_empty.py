"""Operators and jobs on empty inputs return empty results, not errors."""

import os
import tempfile

from wxgrid.operators import coverage, regional, spatial
from wxgrid.plans import jobs


def test_empty_inputs(spark):
    obs = spark.createDataFrame([], "grid_idx long, date string, var string, hour int, value double, ord long")
    m = spark.createDataFrame([(1, "R")], "grid_idx long, HJD_CD string")
    for method in ("mean", "sum", "median"):
        assert regional.region_day(obs, m, ["ta", "sd_3hr"], method).count() == 0
    assert regional.pivot_hours(obs, "ta").count() == 0
    keys = coverage.clean_keys(spark.createDataFrame([], "year int, STN string, TM string"))
    assert coverage.per_station(keys).count() == 0 and coverage.year_metrics(keys).count() == 0
    assert coverage.station_churn(keys).count() == 0
    pts = spark.createDataFrame([], "grid_idx long, lon double, lat double")
    polys = spark.createDataFrame([("A", "a", [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]])],
                                  "code string, name string, rings array<array<struct<x:double,y:double>>>")
    assert spatial.points_in_polygons(pts, polys, "code", "name").count() == 0


def test_ingest_job_with_nothing_landed(spark):
    d = tempfile.mkdtemp(prefix="wxgrid-empty-")
    os.makedirs(os.path.join(d, "landing"))
    status = jobs.ingest_job(spark, os.path.join(d, "landing"), os.path.join(d, "obs"), os.path.join(d, "q"),
                             ["ta"], 6)
    assert status.count() == 0
