"""Registered queries that go through the sinks and readers.

Each writes what the driver's tables give below the shared scratch folder, in
the layout of the library's sinks, and returns what the reader makes of it, so
a lost executor costs the tasks it ran and nothing is kept on one machine.  The
folders lie below ``spark.checkpoint.dir`` and go when the cluster empties it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalogue import ordered_slot_columns
from ..functions.slots import time_key
from ..operators import coverage, gates, ingest, regional, spatial, stations
from ..session import scratch_path
from ..sinks import writers as W
from ..sources import adapters as A
from ..sources import readers as R
from . import jobs
from . import registry as Q

#: Buckets of the tables that meet by cell.
BUCKETS = 32


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _one_per_slot(spark: SparkSession, sf: str) -> DataFrame:
    """The first reading of every (cell, date, variable, hour), as a cache holds
    them: the readings of one response in one task."""
    o = A.obs(spark, sf).where("value IS NOT NULL")
    first = o.groupBy("grid_idx", "date", "var", "hour").agg(F.min_by("value", "ord").alias("value"), F.min("ord").alias("ord"))
    return first.repartition("var", "date", "hour")


def observation_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Every reading, from the cache partitioned by variable and day (K1, S2)."""
    root = _folder(spark, "obs")
    W.write_observations(A.obs(spark, sf), root)
    return Q.rounded(R.read_observations(spark, root, Q.ALL_VARS).select("grid_idx", "date", "var", "hour", "value", "ord"))


def mapping_file(spark: SparkSession, sf: str) -> DataFrame:
    """The unified mapping, written, found complete and read again (K2, S3)."""
    path = _folder(spark, "mapping")
    W.write_mapping(spatial.unified_mapping(*Q._map_sides(spark, sf)), path)
    if not jobs._built(spark, path):
        raise RuntimeError(f"mapping at {path} is not complete")
    return Q.rounded(R.read_mapping(spark, path))


def regional_files(spark: SparkSession, sf: str) -> DataFrame:
    """The regional job on a cache and a mapping file: rows of its daily table
    and of its monthly and yearly CSVs (K3, K4, K5, H1, J10)."""
    root = _folder(spark, "regional")
    W.write_observations(_one_per_slot(spark, sf), f"{root}/obs")
    W.write_mapping(A.mapping_hjd(spark, sf), f"{root}/mapping")
    # a session of its own, as the job changes settings; this one's partitions
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    jobs.regional_job(own, f"{root}/obs", f"{root}/mapping", f"{root}/out", Q.ALL_VARS)
    slots = ordered_slot_columns(Q.ALL_VARS)

    def rows(kind: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col("date").cast("string").alias("date"), *[F.col(c).cast("double").alias(c) for c in slots],
                         F.col("HJD_CD").cast("string").alias("HJD_CD"))
    csv = spark.read.option("header", True)
    parts = [rows("day", spark.read.parquet(f"{root}/out/interim/region_type=hjd")),
             rows("month", csv.csv(f"{root}/out/monthly_hjd")), rows("year", csv.csv(f"{root}/out/yearly_hjd"))]
    return Q.rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def region_day_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Region-day means with readings and mapping bucketed by cell: neither
    first-wins nor the region join shuffles a reading (J1, A6)."""
    names = {k: f"{k}_{uuid.uuid4().hex}" for k in ("readings", "cells")}
    obs = W.write_bucketed(A.obs(spark, sf), names["readings"], _folder(spark, "readings"), BUCKETS)
    cells = W.write_bucketed(A.mapping_hjd(spark, sf), names["cells"], _folder(spark, "cells"), BUCKETS)
    out = Q.rounded(regional.region_day(obs, cells, Q.ALL_VARS, "mean"))
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")   # the catalog's entry; the files stay for the query
    return out


def merge_medians(spark: SparkSession, sf: str) -> DataFrame:
    """Medians in the unfused order: pivot, median per variable, outer merge (A3, J2)."""
    o, m = A.obs(spark, sf), A.mapping_hjd(spark, sf)
    frames = {s.name: regional.aggregate_to_region(regional.pivot_hours(o, s.name), m, s.slot_names(), "median")
              for s in Q.specs(Q.ALL_VARS)}
    return Q.rounded(regional.merge_variables(frames, ["date", "HJD_CD"]))


def pivot_in_file_order(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly pivot of readings that carry no order of their own: the first of a
    slot is the first row of the Parquet file (E1, A6)."""
    path = _folder(spark, "ordered")
    # one range of the input's order per file, files named in that order
    A.obs(spark, sf).repartitionByRange("ord").sortWithinPartitions("ord").drop("ord").write.parquet(path)
    return Q.rounded(regional.pivot_hours(spark.read.parquet(path), "ta"))


def station_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed station days as one CSV per station-year, read back by their
    headers (K6, S8)."""
    d = A.daily(spark, sf)
    years = d.select(F.format_string("weather_data_stn%d_%d0101_%d1231.txt", "STN", "file_year", "file_year").alias("path"),
                     F.col("file_year").alias("year"), F.col("STN").alias("station")).distinct()
    t = stations.parse_daily(Q._station_lines(spark, sf)).join(years, "path")
    root = _folder(spark, "stations")
    W.write_station_tables(t.drop("path", "line_no"), root, ["year", "station"])
    back = R.read_station_tables(spark, root)
    return Q.rounded(back.select("year", *[F.col(c).cast("int" if c in ("TM", "STN") else "double").alias(c) for c in stations.DAILY_COLUMNS]))


def station_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every station-year that was written, and in all (A15)."""
    root = _folder(spark, "station-rows")
    d = A.daily(spark, sf).select("TM", "STN", "RN_DAY", F.col("file_year").alias("year"), F.col("STN").alias("station"))
    W.write_station_tables(d, root, ["year", "station"])
    rows = spark.read.option("header", True).csv(root)
    return rows.rollup("year", "station").agg(F.count(F.lit(1)).alias("n_rows"))


def station_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """The station dimension from its CSV, codes with their leading zeros (S7)."""
    path = _folder(spark, "station-info")
    A.stations(spark, sf).write.option("header", True).csv(path)
    return R.read_station_info(spark, path)


def polygon_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Two boundary layers whose columns are named differently, united (S4,
    P12, H2, F-14)."""
    polys = Q._test_polygons(spark, sf)
    root = _folder(spark, "layers")
    large = F.col("code").isin("SAW", "HOL")
    polys.where(large).select(F.col("code").alias("ADM_CD"), F.col("name").alias("adm_nm"), "rings").write.parquet(f"{root}/a")
    polys.where(~large).select(F.col("code").alias("Adm_Cd"), F.col("name").alias("HJD_NM"), "rings").write.parquet(f"{root}/b")
    both = R.read_polygons(spark, [f"{root}/a", f"{root}/b"], jobs.HJD_CODE_CANDIDATES, jobs.HJD_NAME_CANDIDATES, "code", "name")
    return both.select("code", "name", F.size("rings").alias("n_rings"),
                       F.aggregate("rings", F.lit(0), lambda n, ring: n + F.size(ring)).alias("n_vertices"))


def grid_files(spark: SparkSession, sf: str) -> DataFrame:
    """Grid coordinates from a file of rows (2-D) and a file of axes (1-D) (S5, E3, E4)."""
    root = _folder(spark, "grid")
    Q._grid_rows(spark, sf).write.parquet(f"{root}/rows")
    Q._grid_axes(spark, sf).write.parquet(f"{root}/axes")
    rows = spatial.grid_from_rows(R.read_grid_rows(spark, f"{root}/rows")).withColumn("gid", F.lit(None).cast("long"))
    axes = spatial.grid_from_axes(R.read_grid_axes(spark, f"{root}/axes"), keys=("gid",))
    cols = ["gid", "grid_idx", "lat", "lon"]
    return Q.rounded(rows.select(*cols).unionByName(axes.select(*cols)))


def quarantine_log(spark: SparkSession, sf: str) -> DataFrame:
    """The quarantine as its folder holds it, by variable and year (K7)."""
    rows = Q._staging(spark, sf)
    root = _folder(spark, "quarantine")
    W.write_quarantine(ingest.quarantine(rows, ingest.staged_status(rows, Q.ALL_VARS)).drop("logged_at"), root)
    back = spark.read.schema("tm string, hour int, level string, reason string, preview string, head string, tail string, total_chars long, "
                             "total_lines long, date string, var string, year string").parquet(root)
    return back.drop("year")


def report_text(spark: SparkSession, sf: str) -> DataFrame:
    """The markdown section of duplicate keys of every year (K9, T2, T3)."""
    dup = Q._dates_as_text(coverage.top_rows(coverage.duplicate_keys(Q._keys(spark, sf)), coverage.CAP_DETAIL, ["STN", "TM"]))
    return W.markdown_by_key(dup, "year", ["STN", "TM"], coverage.CAP_DETAIL, "Duplicate (STN, TM)")


def request_times(spark: SparkSession, sf: str) -> DataFrame:
    """Readings by the time key of their request (F-7)."""
    o = A.obs(spark, sf)
    return o.groupBy("var", time_key(F.col("date"), F.col("hour")).alias("tm")).agg(F.count("value").alias("n_values"))


def calendar_days(spark: SparkSession, sf: str) -> DataFrame:
    """Every day from the first month of the orders to the last, with their
    number (F-8, F-6, J9)."""
    d = Q._orders_days(spark, sf)
    first, last = d.agg(F.min("date"), F.max("date")).first()
    if first is None:
        return d.groupBy("date").agg(F.count(F.lit(1)).alias("n_orders"))
    days = gates.calendar(spark, int(first[:4]), int(first[4:6]), int(last[:4]), int(last[4:6]))
    return days.join(d, "date", "left").groupBy("date").agg(F.count("o_orderkey").alias("n_orders"))


def registry() -> dict:
    return {f.__name__: f for f in (
        observation_cache, mapping_file, regional_files, region_day_bucketed, merge_medians, pivot_in_file_order, station_tables,
        station_rows, station_dimension, polygon_layers, grid_files, quarantine_log, report_text, request_times, calendar_days)}
