"""Sinks and readers: file order, bucketed tables, input order of readings,
and every query of plans.stored against DuckDB on the smallest tables."""

import csv
import glob
import os
import random
import statistics

import duckdb
import pytest
from pyspark.sql import functions as F

from scripts.check_oracle import TABLES, digest
from wxgrid.operators import regional
from wxgrid.plans import stored, stored_oracle
from wxgrid.session import configure
from wxgrid.sinks import writers as W

from .conftest import SF0001


def _wide(spark, n_days, n_codes):
    days = spark.range(n_days).select(F.date_format(F.date_add(F.lit("2023-12-01").cast("date"), F.col("id").cast("int")), "yyyyMMdd").alias("date"))
    codes = spark.range(n_codes).select(F.format_string("R%03d", "id").alias("HJD_CD"))
    return days.crossJoin(codes).select("date", F.rand(1).alias("t0001"), "HJD_CD").orderBy(F.rand(2))


def _rows(pattern):
    out = []
    for f in sorted(glob.glob(pattern)):
        with open(f, newline="") as h:
            out.append([(r["date"], r["HJD_CD"]) for r in csv.DictReader(h)])
    return out


def test_csv_files_are_sorted_in_name_order_and_bounded(spark, tmp_path):
    wide = _wide(spark, 62, 50)
    W.write_monthly_csv(wide, str(tmp_path / "m"), rows_per_file=300)
    W.write_yearly_csv(wide, str(tmp_path / "y"), rows_per_file=300)
    for pattern, n in (("m/year=2023/month=12/*.csv", 31 * 50), ("m/year=2024/month=01/*.csv", 31 * 50), ("y/year=2024/*.csv", 31 * 50)):
        files = _rows(str(tmp_path / pattern))
        rows = [r for f in files for r in f]
        assert len(rows) == n and rows == sorted(rows), pattern
        assert len(files) > 1 and max(map(len, files)) <= 300, pattern


def test_one_file_per_interim_day(spark, tmp_path):
    W.write_region_days(_wide(spark, 10, 20).repartition(7), str(tmp_path), "hjd")
    for day in glob.glob(str(tmp_path / "region_type=hjd" / "date=*")):
        assert len(glob.glob(os.path.join(day, "*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path)).count() == 200


def test_one_file_per_station_year(spark, tmp_path):
    t = spark.range(600).select((F.col("id") % 3).alias("station"), (F.lit(2020) + F.col("id") % 2).alias("year"), "id").repartition(9)
    W.write_station_tables(t, str(tmp_path), ["year", "station"])
    folders = glob.glob(str(tmp_path / "year=*" / "station=*"))
    assert len(folders) == 6 and all(len(glob.glob(f + "/*.csv")) == 1 for f in folders)


def _cells(spark, seed=5):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(40), "20240105", "ta", rnd.randrange(24), rnd.choice([None, float(rnd.randrange(9))]), i) for i in range(900)]
    obs = spark.createDataFrame(rows, "grid_idx long, date string, var string, hour int, value double, ord long")
    cells = spark.createDataFrame([(i, f"R{i % 4}") for i in range(40)], "grid_idx long, HJD_CD string")
    return rows, obs, cells


@pytest.fixture()
def static(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_shuffle_no_reading(static, tmp_path):
    spark = static
    _, obs, cells = _cells(spark)
    want = {r["HJD_CD"]: r for r in regional.region_day(obs, cells, ["ta"]).collect()}
    b_obs = W.write_bucketed(obs, "t_readings", str(tmp_path / "o"), 4, partition_by=["var"])
    b_cells = W.write_bucketed(cells, "t_cells", str(tmp_path / "c"), 4)
    try:
        assert len(glob.glob(str(tmp_path / "o" / "var=ta" / "*.parquet"))) == 4
        day = regional.region_day(b_obs, b_cells, ["ta"])
        exchanges = [ln for ln in day._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in ln]
        assert len(exchanges) == 2 and not any("grid_idx" in ln for ln in exchanges)
        got = {r["HJD_CD"]: r for r in day.collect()}
        assert got.keys() == want.keys()
        for k in want:
            for c in day.columns[1:-1]:
                assert got[k][c] == pytest.approx(want[k][c]), c
    finally:
        spark.sql("DROP TABLE t_readings")
        spark.sql("DROP TABLE t_cells")


@pytest.mark.parametrize("parts", [1, 16])
def test_first_reading_by_place_in_the_files(spark, tmp_path, parts):
    rows, obs, _ = _cells(spark)
    path = str(tmp_path / "p")
    obs.repartitionByRange(5, "ord").sortWithinPartitions("ord").drop("ord").write.parquet(path)
    first = {}
    for cell, _, _, hour, value, _ in rows:
        if value is not None:
            first.setdefault((cell, hour), value)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1g" if parts == 1 else "1k")
    try:
        wide = regional.pivot_hours(spark.read.parquet(path), "ta").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {(r["grid_idx"], h): r[f"t{h:02d}{(h + 1) % 24:02d}"] for r in wide for h in range(24)}
    assert {k: v for k, v in got.items() if v is not None} == first


def test_readings_without_any_order(spark):
    df = spark.createDataFrame([(1, "d", 0, 5.0), (1, "d", 0, 3.0)], "grid_idx long, date string, hour int, ta double")
    for n in (1, 4):
        assert regional.pivot_hourly_to_columns(df.repartition(n), "ta", order_col=None).first()["t0001"] == 3.0


def test_median_of_columns_keeps_empty_groups(spark):
    rnd = random.Random(3)
    rows = [(i, "d", None if i % 7 == 0 else rnd.choice([1.0, 2.0, 2.0, 8.5, -3.0]), None if i % 5 == 4 else float("nan") if i % 11 == 0 else rnd.random())
            for i in range(300)]
    wide = spark.createDataFrame(rows, "grid_idx long, date string, a double, b double")
    m = spark.createDataFrame([(i, f"R{i % 5}") for i in range(300)], "grid_idx long, HJD_CD string")
    got = {r["HJD_CD"]: r for r in regional.aggregate_to_region(wide, m, ["a", "b"], "median").collect()}
    assert set(got) == {f"R{i}" for i in range(5)}
    for k in range(5):
        for c, at in (("a", 2), ("b", 3)):
            vals = [r[at] for r in rows if r[0] % 5 == k and r[at] is not None and r[at] == r[at]]
            assert got[f"R{k}"][c] == (statistics.median(vals) if vals else None)


def test_settings_chosen_in_the_session_stay(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "12345")
    configure(own)
    assert own.conf.get("spark.sql.autoBroadcastJoinThreshold") == "12345"
    assert own.conf.get("spark.sql.parquet.compression.codec") == "zstd"


@pytest.mark.parametrize("name", sorted(stored.registry()))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = stored.registry()[name](spark, SF0001)
    cur = con.execute(stored_oracle.oracle()[name])
    dcols, drows = [d[0] for d in cur.description], cur.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols) and len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)
