"""Plan shape of the heavy operators (static plans, AQE off)."""

import re

import pytest

from wxgrid.operators import regional
from wxgrid.sources import adapters as A

from .conftest import SF0001


@pytest.fixture()
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("dedupe,shuffles", [(True, 4), (False, 3)])
def test_region_day_plan(static, dedupe, shuffles):
    df = regional.region_day(A.obs(static, SF0001), A.mapping_hjd(static, SF0001),
                             ("ta", "rn_60m", "sd_3hr"), "mean", dedupe=dedupe)
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "NestedLoop" not in plan and "EvalPython" not in plan
    # one shuffle builds the small mapping, then (optional) first-wins,
    # the narrow slot aggregate and the pivot
    assert plan.count("Exchange hashpartitioning") == shuffles
    aggs = [ln for ln in plan.split("\n") if "HashAggregate(" in ln]
    assert aggs and all(re.search(r"\*\(\d+\) HashAggregate", ln) for ln in aggs)


def test_observation_filters_reach_scan(static, tmp_path):
    from pyspark.sql import functions as F

    from wxgrid.sources.readers import read_observations
    rows = [(1, "20240101", "ta", 0, 1.0, 1), (1, "20240102", "rn_60m", 0, 2.0, 2)]
    df = static.createDataFrame(rows, "grid_idx long, date string, var string, hour int, value double, ord long")
    root = str(tmp_path / "obs")
    (df.withColumn("year", F.substring("date", 1, 4)).withColumn("month", F.substring("date", 5, 2))
       .write.partitionBy("var", "year", "month", "date").parquet(root))
    o = read_observations(static, root, ["ta"], "20240101", "20240101")
    plan = _plan(regional.region_day(o, static.createDataFrame([(1, "R")], "grid_idx long, HJD_CD string"),
                                     ["ta"], dedupe=False))
    assert "PartitionFilters: [isnotnull(var" in plan and "PushedFilters: [IsNotNull(value)" in plan
    assert "ReadSchema: struct<grid_idx:bigint,hour:int,value:double>" in plan


def test_day_gate_prunes_cache_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    from wxgrid.operators import gates
    from wxgrid.sources.readers import read_observations
    rows = [(1, f"2024010{d}", "ta", 0, 1.0, d) for d in range(1, 6)]
    df = spark.createDataFrame(rows, "grid_idx long, date string, var string, hour int, value double, ord long")
    root = str(tmp_path / "obs")
    (df.withColumn("year", F.substring("date", 1, 4)).withColumn("month", F.substring("date", 5, 2))
       .write.partitionBy("var", "year", "month", "date").parquet(root))
    days = spark.createDataFrame([("20240102", 1), ("20240104", 0)], "date string, ok int")
    q = regional.region_day(gates.gate(read_observations(spark, root, ["ta"]), days.where("ok = 1").select("date")),
                            spark.createDataFrame([(1, "R")], "grid_idx long, HJD_CD string"), ["ta"], dedupe=False)
    assert [r["date"] for r in q.collect()] == ["20240102"]
    assert "dynamicpruning" in _plan(q).lower()
