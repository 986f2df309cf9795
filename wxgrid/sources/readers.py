"""Readers for the pipeline's inputs.  Every reader returns a lazy
DataFrame; paths are directories or globs on the cluster's shared storage.

* ``read_responses``   raw grid responses ``{var}_{YYYYMMDDHHmm}.txt``
* ``read_observations`` the long observation cache (partitioned parquet)
* ``read_mapping``      grid -> region mapping
* ``read_polygons``     region boundaries as polygon rows (one or more layers)
* ``read_grid_rows`` / ``read_grid_axes``  grid coordinates
* ``read_station_lines`` raw yearly station files as (path, line_no, line)
* ``read_station_info`` station dimension CSV (codes kept as text)
* ``read_station_tables`` yearly station CSVs with the year from the name
"""

from __future__ import annotations

import csv
import warnings
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..catalogue import find_name
from ..functions.dates import year_from_filename

# ---------------------------------------------------------------------------
# File name formats.  Raw grid responses are
# "{var}_{YYYYMMDDHHmm}.txt"; raw yearly station files are
# "weather_data_stn{stn}_{Y}0101_{Y}1231.txt".
# ---------------------------------------------------------------------------
RESPONSE_NAME = r"([^/]+)_([0-9]{12})\.txt$"
STATION_NAME = r"weather_data_stn([0-9]+)_([0-9]{4})0101_[0-9]{8}\.txt$"


def _path() -> F.Column:
    return F.col("_metadata.file_path")


def read_responses(spark: SparkSession, path, days=None) -> DataFrame:
    """(path, var, tm, text): one row per response file, whole text.

    ``path`` is a folder, a glob or a list of files; with ``days`` (YYYYMMDD)
    only files named for one of them are opened.  One file is one row
    (``wholetext``), so a 4.2M-value response is one task's input and
    thousands of responses are read in parallel.
    """
    reader = spark.read
    if days is not None:
        reader = reader.option("pathGlobFilter", "*_{" + ",".join(days) + "}[0-9][0-9][0-9][0-9].txt")
    df = reader.text(path if isinstance(path, str) else list(path), wholetext=True)
    p = _path()
    return df.select(p.alias("path"),
                     F.regexp_extract(p, RESPONSE_NAME, 1).alias("var"),
                     F.regexp_extract(p, RESPONSE_NAME, 2).alias("tm"),
                     F.col("value").alias("text"))


def list_responses(spark: SparkSession, path: str) -> DataFrame:
    """(path, var, tm, modificationTime) of the response files; the binary
    file source reads no content when only its metadata is selected."""
    p = _path()
    df = spark.read.format("binaryFile").load(path)
    return df.select(p.alias("path"), F.col("_metadata.file_modification_time").alias("modificationTime"),
                     F.regexp_extract(p, RESPONSE_NAME, 1).alias("var"),
                     F.regexp_extract(p, RESPONSE_NAME, 2).alias("tm"))


OBSERVATION_SCHEMA = StructType([
    StructField("grid_idx", LongType()), StructField("hour", IntegerType()),
    StructField("value", DoubleType()), StructField("ord", LongType()),
    # partition columns, typed as text so date keeps its YYYYMMDD form and
    # joins on it stay plain partition-column joins (dynamic pruning)
    StructField("var", StringType()), StructField("year", StringType()),
    StructField("month", StringType()), StructField("date", StringType()),
])


STAGED_SCHEMA = StructType([
    StructField("tm", StringType()), StructField("reason", StringType()), StructField("preview", StringType()),
    StructField("head", StringType()), StructField("tail", StringType()), StructField("total_chars", LongType()),
    StructField("total_lines", LongType()), StructField("grid_idx", LongType()), StructField("value", DoubleType()),
    StructField("ord", LongType()), StructField("hour", IntegerType()),
    StructField("var", StringType()), StructField("date", StringType()),
])


def read_staged(spark: SparkSession, root: str) -> DataFrame:
    """Parsed responses of one set of days (``writers.write_staged``)."""
    return spark.read.schema(STAGED_SCHEMA).parquet(root)


def read_observations(spark: SparkSession, root: str, variables=None,
                      start: str | None = None, end: str | None = None) -> DataFrame:
    """Long observations from ``root/var=*/year=*/month=*/date=*``.

    Filters on the partition columns prune directories before any file is
    opened; ``date`` is a YYYYMMDD string.
    """
    df = spark.read.schema(OBSERVATION_SCHEMA).option("basePath", root).parquet(root)
    if variables:
        df = df.where(F.col("var").isin(*list(variables)))
    if start:
        df = df.where(F.col("date") >= start)
    if end:
        df = df.where(F.col("date") <= end)
    return df


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_polygons(spark: SparkSession, paths, code_candidates, name_candidates,
                  code_out: str, name_out: str) -> DataFrame:
    """Union of polygon layers (parquet: code/name columns + ``rings``).

    The code and name columns are found by candidate names (first present
    wins, exact spelling before other case); a layer without one gets a NULL
    column and a warning.
    """
    if isinstance(paths, str):
        paths = [paths]
    layers = []
    for p in paths:
        df = spark.read.parquet(p)
        code, name = find_name(df.columns, code_candidates), find_name(df.columns, name_candidates)
        for what, column, tried in ((code_out, code, code_candidates), (name_out, name, name_candidates)):
            if column is None:
                warnings.warn(f"{p}: no column for {what} (tried {', '.join(tried)}); it is NULL", stacklevel=2)
        layers.append(df.select(
            (F.col(code) if code else F.lit(None)).cast("string").alias(code_out),
            (F.col(name) if name else F.lit(None)).cast("string").alias(name_out),
            "rings", *([c for c in ("epsg",) if c in df.columns])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)


def read_grid_rows(spark: SparkSession, path: str) -> DataFrame:
    """2-D coordinates stored one grid row per record: (y, lat[], lon[])."""
    return spark.read.parquet(path)


def read_grid_axes(spark: SparkSession, path: str) -> DataFrame:
    """1-D axes stored as one record (lat[], lon[])."""
    return spark.read.parquet(path)


def read_station_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, stn_file, year_file, line_no, line) for raw station files.

    A station-year file is a few hundred lines; it is read whole and split
    into numbered lines so the help block can be told apart from data.
    """
    df = spark.read.text(path, wholetext=True)
    p = _path()
    lines = df.select(p.alias("path"), F.posexplode(F.split(F.col("value"), "\n")).alias("line_no", "line"))
    return lines.select("path",
                        F.regexp_extract("path", STATION_NAME, 1).try_cast("int").alias("stn_file"),
                        F.regexp_extract("path", STATION_NAME, 2).try_cast("int").alias("year_file"),
                        F.col("line_no").cast("long").alias("line_no"),
                        F.regexp_replace("line", "\r$", "").alias("line"))


STATION_INFO_SCHEMA = StructType([
    StructField("STN_ID", IntegerType()), StructField("LAW_ID", StringType()), StructField("LAW_NM", StringType()),
])


def read_station_info(spark: SparkSession, path: str | None) -> DataFrame:
    """Station dimension with codes as text (leading zeros kept).  A missing
    path gives an empty table with the same columns."""
    if not path:
        return spark.createDataFrame([], STATION_INFO_SCHEMA)
    df = spark.read.option("header", True).csv(path)
    cols = {c: F.col(c) if c in df.columns else F.lit(None) for c in ("STN_ID", "LAW_ID", "LAW_NM")}
    return df.select(F.trim(cols["STN_ID"].cast("string")).try_cast("int").alias("STN_ID"),
                     cols["LAW_ID"].cast("string").alias("LAW_ID"),
                     cols["LAW_NM"].cast("string").alias("LAW_NM"))


def list_files(spark: SparkSession, path) -> DataFrame:
    """(path) of the text files at ``path``, empty ones too, from the listing that
    the file index keeps on the driver (scans leave empty files out)."""
    return spark.createDataFrame([(f,) for f in spark.read.text(path).inputFiles()], "path string")


def _table_lines(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(path, year, line) of CSV files, and (path, year, header) with the first
    line of each.  Lines of a split come in order into one task, so the
    smallest running id of the split at offset 0 is the first line."""
    df = spark.read.text(path)
    by_name = year_from_filename(_path())
    year = F.coalesce(F.col("year").cast("string").try_cast("int"), by_name) if "year" in df.columns else by_name
    rows = df.select(_path().alias("path"), year.alias("year"), F.regexp_replace("value", "^\\x{FEFF}|\r$", "").alias("line"),
                     F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    first = rows.where("_block = 0").groupBy("path", "year").agg(F.min_by("line", "_id").alias("header"))
    return rows.select("path", "year", "line"), first


def _headers(first: DataFrame) -> list[str]:
    """Distinct header lines of the files: as many as there are layouts."""
    return sorted(r.header for r in first.where(F.col("year").isNotNull()).select("header").distinct().collect() if r.header)


def read_station_tables(spark: SparkSession, path) -> DataFrame:
    """Yearly station CSVs (all columns as text) plus ``year``.

    Every file is read by its own header: columns are placed by name, in the
    order of their first appearance among the layouts, and are NULL where a
    file lacks them, so files whose columns differ in order or number can be
    read together.  One small job collects the distinct headers.  A quoted
    field may hold commas, but no line break.

    ``year`` comes from a ``year=`` partition folder when the tables were
    written by ``plans.jobs.station_job``, else from the file name (first
    four-digit part, as the reference names its CSVs).  Files without a year
    or without a line give no row; ``failed_tables`` lists them.
    """
    lines, first = _table_lines(spark, path)
    layouts = {h: next(csv.reader([h])) for h in _headers(first)}
    columns = list(dict.fromkeys(c for names in layouts.values() for c in names if c != "year"))
    per_file = lines.where(F.col("year").isNotNull() & (F.col("line") != "")).join(first.drop("year"), "path")
    per_file = per_file.where(F.col("line") != F.col("header"))
    n = max([len(names) for names in layouts.values()], default=1)
    # each line parsed once, by the generator; then each column from its place in the line's layout
    fields = F.from_csv("line", ", ".join(f"_c{i} string" for i in range(n)))
    rows = per_file.select("path", "year", "header", F.inline(F.array(fields)))
    out = []
    for c in columns:
        places: dict[int, list[str]] = {}
        for h, names in layouts.items():
            if c in names:
                places.setdefault(names.index(c), []).append(h)
        value = F.lit(None).cast("string")
        for i, headers in places.items():
            value = F.when(F.col("header").isin(headers), F.col(f"_c{i}")).otherwise(value)
        out.append(value.alias(c))
    return rows.select(*out, "year")


def failed_tables(spark: SparkSession, path, needed=("STN", "TM")) -> DataFrame:
    """(path, year, error) of the files that ``read_station_tables`` cannot use:
    no year in the name, an empty file, a header without one of ``needed``.
    One bad file neither stops a run nor vanishes."""
    _, first = _table_lines(spark, path)
    # the listing and the scan write local paths with one or three slashes
    same = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    heads = first.select(same(F.col("path")).alias("_key"), "header")
    files = list_files(spark, path).withColumn("_key", same(F.col("path"))).join(heads, "_key", "left").withColumn(
        "year", F.coalesce(F.regexp_extract("path", "/year=([0-9]+)/", 1).try_cast("int"), year_from_filename(F.col("path"))))
    usable = {h: set(next(csv.reader([h]))) for h in _headers(first)}
    error = F.when(F.col("header").isNull() | (F.col("header") == ""), F.lit("empty file")).when(F.col("year").isNull(), F.lit("no year in the file name"))
    for c in needed:
        bad = [h for h, names in usable.items() if c not in names]
        if bad:
            error = error.when(F.col("header").isin(bad), F.lit(f"no column {c}"))
    return files.select("path", "year", error.alias("error")).where("error is not null")


def failed_stations(files: DataFrame, daily: DataFrame) -> DataFrame:
    """(path, error) of the raw station files (``path``) without a single row
    in ``daily`` whose date and station could be read."""
    good = daily.where(F.col("TM").isNotNull() & F.col("STN").isNotNull()).select("path").distinct()
    some = daily.select("path").distinct().withColumn("_some", F.lit(True))
    return (files.select("path").distinct().join(good, "path", "left_anti").join(some, "path", "left")
            .select("path", F.when(F.col("_some"), F.lit("no line with a date and a station")).otherwise(F.lit("no data line")).alias("error")))
