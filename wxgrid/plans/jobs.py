"""Batch jobs: the reference's run scripts as Spark jobs over all dates.

* ``ingest_job``     raw responses -> observation cache + quarantine (Stage A)
* ``mapping_job``    grid coordinates + region polygons -> mapping table
* ``regional_job``   observation cache -> region-day tables and CSVs (Stage B)
* ``station_job``    raw station files -> yearly station tables with codes
* ``coverage_job``   yearly station tables -> coverage tables and reports

Each job is one Spark plan per output, keyed by date / year rather than a
Python loop over days; reruns skip what already exists unless forced.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..catalogue import EMD_CD, EMD_NM, HJD_CD, HJD_NM, VARIABLES, ordered_slot_columns
from ..operators import coverage, gates, ingest, regional, spatial, stations
from ..sinks import writers as W
from ..session import configure, scratch_path
from ..sources import readers as R

# ---------------------------------------------------------------------------
# Column names tried, in order, for the region code and name
# of each boundary layer (administrative HJD, legal BJD).
# ---------------------------------------------------------------------------
HJD_CODE_CANDIDATES = ["adm_cd", "ADSTRD_CD", "HJD_CD", "ADM_CD", "ADMD_CD"]
HJD_NAME_CANDIDATES = ["adm_nm", "ADSTRD_NM", "HJD_NM", "ADM_NM", "ADMD_NM"]
BJD_CODE_CANDIDATES = ["EMD_CD", "emd_cd", "ADM_CD", "BJDONG_CD"]
BJD_NAME_CANDIDATES = ["EMD_NM", "emd_nm", "ADM_NM", "BJDONG_NM"]

#: Days parsed into staging at a time.
DAYS_PER_SET = 31


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the cluster's file system (listing only:
    the binary-file reader resolves the path and reads no content)."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def _built(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed: a folder left by a job that
    broke off has no success marker and counts as absent."""
    return _exists(spark, path.rstrip("/") + "/_SUCCESS")


def _cached_days(spark: SparkSession, manifest: str) -> DataFrame:
    """(date, var, value_hours) of the cached days.  The manifest is a log: of
    several runs that completed a day the last one wrote the cache."""
    return (spark.read.parquet(manifest).where("complete").groupBy("date", "var")
            .agg(F.max_by("value_hours", "logged_at").alias("value_hours")))


def ingest_job(spark: SparkSession, landing: str, obs_root: str, quarantine_root: str,
               variables, n_expected: int | None, force: bool = False,
               manifest: str | None = None, days_per_set: int = DAYS_PER_SET) -> DataFrame:
    """Parse every landed response once, publish complete days, log the rest.

    The landed responses are a table made from the listing (one per (var,
    time), the newest file winning; (var, date) pairs complete in the manifest
    left out unless ``force``).  Days are taken in sets of ``days_per_set``, so
    a run of any length holds a bounded amount of staged data: only files
    named for a set's days are opened, a semi join with the listing keeps the
    chosen ones, and they are parsed once into staging on the shared folder.
    Status, observations and quarantine are read from there.  A (var, date) is
    published by its row in the manifest (default ``<obs_root>_manifest``),
    appended after its observations are committed; a run that breaks off
    before that repeats the set.  The driver holds the days of the run, never
    paths.  Returns the per-day status (date, var, complete, missing_hours,
    value_hours) of this run.
    """
    configure(spark)
    variables = list(variables)
    manifest = manifest or obs_root.rstrip("/") + "_manifest"
    work = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    started = spark.range(1).select(F.current_timestamp()).first()[0]   # one value for all rows of the run
    listing = R.list_responses(spark, landing).where(F.col("var").isin(*variables))
    listing = gates.season_filter(listing.withColumn("date", F.substring("tm", 1, 8)))
    newest = listing.groupBy("var", "tm", "date").agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
    if not force and _built(spark, manifest):
        done = spark.read.parquet(manifest).where("complete").select("var", "date")
        newest = gates.todo(newest, done, ["var", "date"])
    newest.write.parquet(os.path.join(work, "landed"))
    landed = spark.read.parquet(os.path.join(work, "landed"))
    days = [r["date"] for r in landed.select("date").distinct().orderBy("date").collect()]   # bounded by the calendar
    for i in range(0, len(days), days_per_set):
        _ingest_days(spark, landing, landed, days[i:i + days_per_set], os.path.join(work, f"set-{i}"),
                     obs_root, quarantine_root, manifest, variables, n_expected, started)
    if not days:
        status = spark.createDataFrame([], "date string, var string, complete boolean, missing_hours string, "
                                           "value_hours array<int>")
    else:
        status = spark.read.parquet(manifest).where(F.col("logged_at") == F.lit(started)).drop("logged_at")
    W.remove(spark, work)
    return status


def _ingest_days(spark: SparkSession, landing: str, landed: DataFrame, days, work: str, obs_root: str,
                 quarantine_root: str, manifest: str, variables, n_expected, started) -> None:
    """One set of days: parse into staging, then publish."""
    # at most days x hours x variables rows
    chosen = F.broadcast(landed.where(F.col("date").isin(*days)).select("path"))
    resp = R.read_responses(spark, landing, days).join(chosen, "path", "left_semi")
    W.write_staged(ingest.staged(ingest.validate(resp, n_expected)), work)
    rows = R.read_staged(spark, work)
    status = ingest.staged_status(rows, variables)
    complete = F.broadcast(status.where("complete").select("date", "var"))   # at most days x variables rows
    good = rows.where(F.col("grid_idx").isNotNull()).join(complete, ["date", "var"], "left_semi")
    W.write_observations(good.select("grid_idx", "date", "var", "hour", "value", "ord"), obs_root)
    W.write_quarantine(ingest.quarantine(rows, status), quarantine_root)
    status.withColumn("logged_at", F.lit(started)).write.mode("append").parquet(manifest)
    W.remove(spark, work)


def mapping_job(spark: SparkSession, grid_rows_path: str, hjd_polygons, bjd_polygons, out_path: str,
                reproject: bool = True, tile: float = spatial.DEFAULT_TILE_DEG,
                force: bool = False, grid_kind: str = "rows") -> DataFrame:
    """Grid cells -> region mapping, written as parquet; an existing mapping
    is reused unless ``force``.  With both layers the table is the unified
    (HJD + BJD) mapping; with one of them ``None`` it is that system's table
    alone.  ``grid_kind`` is "rows" (2-D coordinates, one record per grid
    row) or "axes" (1-D latitude and longitude axes, meshed).  Returns the
    coverage profile."""
    configure(spark)
    if not force and _built(spark, out_path):
        return spatial.mapping_profile(R.read_mapping(spark, out_path))
    if hjd_polygons is None and bjd_polygons is None:
        raise ValueError("no region layer given")
    if grid_kind == "rows":
        points = spatial.grid_from_rows(R.read_grid_rows(spark, grid_rows_path))
    elif grid_kind == "axes":
        points = spatial.grid_from_axes(R.read_grid_axes(spark, grid_rows_path))
    else:
        raise ValueError(f"grid_kind must be 'rows' or 'axes', not {grid_kind!r}")

    def system(paths, codes, names, code_out, name_out):
        polys = R.read_polygons(spark, paths, codes, names, code_out, name_out)
        if reproject:
            polys = spatial.reproject_rings(polys)
        return spatial.build_mapping(points, polys, code_out, name_out, code_out, name_out, tile=tile)

    h = system(hjd_polygons, HJD_CODE_CANDIDATES, HJD_NAME_CANDIDATES, HJD_CD, HJD_NM) \
        if hjd_polygons is not None else None
    b = system(bjd_polygons, BJD_CODE_CANDIDATES, BJD_NAME_CANDIDATES, EMD_CD, EMD_NM) \
        if bjd_polygons is not None else None
    mapping = spatial.unified_mapping(h, b) if h is not None and b is not None else (h if h is not None else b)
    W.write_mapping(mapping, out_path)
    return spatial.mapping_profile(R.read_mapping(spark, out_path))


def regional_job(spark: SparkSession, obs_root: str, mapping_path: str, out_root: str,
                 variables=("ta", "rn_60m"), start: str | None = None, end: str | None = None,
                 region_type: str = "hjd", method: str = "mean", strict_gate: bool = False,
                 manifest: str | None = None) -> DataFrame:
    """Stage B for a date range in one plan.

    The requested days are those from ``start`` to ``end``; where one of them
    is not given, those of the months that occur in the cache.  Days are kept
    only when every (applicable, or with ``strict_gate`` every
    requested) variable is cached -- a semi join against a small day table.
    Writes the interim table and monthly and yearly CSVs; returns the days
    that were skipped with the missing variables.
    """
    configure(spark)
    obs = R.read_observations(spark, obs_root, variables, start, end)
    manifest = manifest or obs_root.rstrip("/") + "_manifest"
    has_manifest = _built(spark, manifest)
    if has_manifest:
        # Cached (date, var) pairs from the ingest manifest: no file footers.
        status = _cached_days(spark, manifest).where(F.col("var").isin(*list(variables)))
        if start:
            status = status.where(F.col("date") >= start)
        if end:
            status = status.where(F.col("date") <= end)
        present = status.select("date", "var").distinct()
    else:
        present = obs.select("date", "var").distinct()
    if start and end:
        days = gates.calendar(spark, int(start[:4]), int(start[4:6]), int(end[:4]), int(end[4:6]))
    else:
        days = gates.month_calendar(present.select("date"))
    if start:
        days = days.where(F.col("date") >= start)
    if end:
        days = days.where(F.col("date") <= end)
    expected = gates.expected_pairs(days, variables, strict=strict_gate)
    complete = gates.complete_days(expected, present)
    mapping = R.read_mapping(spark, mapping_path)
    keep = {"hjd": [HJD_CD], "bjd": [EMD_CD], "both": [HJD_CD, EMD_CD]}[region_type]
    if region_type != "both" and {HJD_CD, EMD_CD} <= set(mapping.columns):
        # A unified mapping repeats a cell of one system once per region of the
        # other; each region of the system asked for counts once.
        name = {"hjd": HJD_NM, "bjd": EMD_NM}[region_type]
        mapping = mapping.select("grid_idx", *keep, *[c for c in [name] if c in mapping.columns]).distinct()
    presence = None
    if method == "sum":
        # Hours with any reading on the grid: from the ingest manifest (no
        # scan), else a partial aggregate over the cache.
        if has_manifest:
            presence = status.select("date", "var", F.explode("value_hours").alias("hour")).distinct()
        else:
            presence = regional.hour_presence(obs, variables)
    # The cache holds one reading per (cell, var, hour): no first-wins shuffle.
    wide = regional.region_day(gates.gate(obs, complete), mapping.select("grid_idx", *keep), variables, method,
                               dedupe=False, presence=presence)
    W.write_region_days(wide, os.path.join(out_root, "interim"), region_type)
    # Month and year files are rebuilt only for the periods this run touched,
    # each from the whole interim table of that period (so earlier days of a
    # month stay in its file); other periods' files are left as they are.
    # Each region type has its own folder, hence its own code columns; days
    # written for other variables are united with null-filled slots.
    interim = (spark.read.option("mergeSchema", True)
               .parquet(os.path.join(out_root, "interim", f"region_type={region_type}"))
               .withColumn("date", F.col("date").cast("string")))
    slots = [c for c in interim.columns if c not in ("date", *keep)]
    known = [c for c in ordered_slot_columns(VARIABLES) if c in slots]
    interim = interim.select("date", *known, *[c for c in slots if c not in known], *keep)
    touched = complete.select(F.substring("date", 1, 6).alias("_ym")).distinct()   # months of the run
    months = interim.join(F.broadcast(touched), F.substring(interim["date"], 1, 6) == touched["_ym"],
                          "left_semi")
    years = interim.join(F.broadcast(touched.select(F.substring("_ym", 1, 4).alias("_y")).distinct()),
                         F.substring(interim["date"], 1, 4) == F.col("_y"), "left_semi")
    W.write_monthly_csv(months, os.path.join(out_root, f"monthly_{region_type}"))
    W.write_yearly_csv(years, os.path.join(out_root, f"yearly_{region_type}"))
    missing = gates.missing_pairs(expected, present)
    return missing.groupBy("date").agg(F.array_sort(F.collect_list("var")).alias("missing_vars"))


def station_job(spark: SparkSession, raw_glob: str, station_info_path: str | None, out_root: str,
                leading_only: bool = False, force: bool = False) -> DataFrame:
    """Raw yearly station files -> typed tables with LAW_ID, one CSV folder
    per (year, station of the file) like the reference's one file per
    station-year.  Station-years already written are skipped unless
    ``force``; a rerun overwrites only its own station-years.

    Returns a per station-year summary of what was written: rows, rows whose
    TM or STN did not parse, rows without a LAW_ID.
    """
    configure(spark)
    lines = R.read_station_lines(spark, raw_glob)
    # Only files named like a station-year (the reference's file pattern).
    lines = lines.where(F.col("year_file").isNotNull() & F.col("stn_file").isNotNull())
    if not force and _exists(spark, out_root):
        done = (spark.read.option("header", True).csv(out_root)
                .select(F.col("year").cast("int").alias("year_file"), F.col("station").cast("int").alias("stn_file"))
                .distinct())
        lines = gates.todo(lines, done, ["year_file", "stn_file"])
    table = stations.parse_daily(lines, leading_only=leading_only)
    files = lines.select("path", "year_file", "stn_file").distinct()
    table = table.join(F.broadcast(files), "path")   # one row per station-year file
    info = R.read_station_info(spark, station_info_path).withColumn("ord", F.monotonically_increasing_id())
    table = stations.law_id_lookup(table.withColumn("ord", F.col("line_no")), info).drop("ord")
    out = (table.drop("path", "line_no").withColumnRenamed("year_file", "year")
                .withColumnRenamed("stn_file", "station"))
    W.write_station_tables(out, out_root, ["year", "station"])
    todo_keys = files.select(F.col("year_file").alias("year"), F.col("stn_file").alias("station")).distinct()
    written = (spark.read.option("header", True).csv(out_root)
               .join(F.broadcast(todo_keys), ["year", "station"], "left_semi"))
    return written.groupBy("year", "station").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("TM").isNull() | F.col("STN").isNull()).alias("bad_rows"),
        F.count_if(F.col("LAW_ID").isNull()).alias("law_id_missing"))


def coverage_job(spark: SparkSession, tables_glob: str, station_info_path: str | None,
                 out_dir: str) -> dict:
    """All yearly files in one job: five tables and the list of unusable files
    (path, year, error) written as parquet, plus the markdown reports (rows
    capped as in the reference's reports)."""
    configure(spark)
    if not _exists(spark, tables_glob):
        return {}          # nothing to analyse (the reference returns an empty list)
    raw = R.read_station_tables(spark, tables_glob)
    failed = R.failed_tables(spark, tables_glob)
    if not {"STN", "TM"} <= set(raw.columns):   # no file is usable
        failed.write.mode("overwrite").parquet(os.path.join(out_dir, "failed_files"))
        return {"failed_files": spark.read.parquet(os.path.join(out_dir, "failed_files"))}
    keys = coverage.clean_keys(raw)
    info = R.read_station_info(spark, station_info_path)
    has_info = station_info_path is not None
    tables = {
        "year_metrics": coverage.year_metrics(keys, info if has_info else None),
        "per_station": coverage.per_station(keys, info if has_info else None),
        "duplicates": coverage.duplicate_keys(keys),
        "out_of_range": coverage.out_of_range(keys),
        "churn": coverage.station_churn(keys, info if has_info else None),
        "failed_files": failed,
    }
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(os.path.join(out_dir, name))
    t = {name: spark.read.parquet(os.path.join(out_dir, name)) for name in tables}
    # Per-year report sections, rendered and written by Spark.
    sections = [
        W.markdown_by_key(coverage.per_station_report(t["per_station"]), "year",
                          ["days_missing", "STN"], coverage.CAP_PER_STATION, "Per-station coverage", coverage.DISPLAY),
        W.markdown_by_key(t["duplicates"], "year", ["STN", "TM"], coverage.CAP_DETAIL, "Duplicate (STN, TM)"),
        W.markdown_by_key(t["out_of_range"], "year", ["STN", "TM"], coverage.CAP_DETAIL, "Out-of-range dates"),
        W.markdown_by_key(t["churn"], "year", ["change", "STN"], coverage.CAP_CHURN, "Station changes"),
    ]
    merged = sections[0]
    for sec in sections[1:]:
        merged = merged.unionByName(sec)
    per_year = merged.groupBy("year").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n").alias("text"))
    W.write_reports(per_year, os.path.join(out_dir, "reports"))
    # The summary is a section under one key: rendered and written by Spark,
    # so it lands on the same shared storage as the tables.
    summary = W.markdown_by_key(t["year_metrics"].withColumn("report", F.lit("all")), "report", ["year"],
                                coverage.CAP_SUMMARY, "Coverage summary")
    summary.select("text").coalesce(1).write.mode("overwrite").text(os.path.join(out_dir, "report_summary"))
    return t
