"""Coverage analysis of yearly station tables, all years in one job.

Input: a station daily table with ``year`` (the file's year), ``STN`` and
``TM`` (YYYYMMDD as int or text), any other columns.  Every output is keyed
by ``year``, so many yearly files are analysed in one set of shuffles
instead of one process per file.

Quirks kept on purpose (they are the specified behaviour):

* days present counts distinct valid dates *including* dates outside the
  file's year, so ``days_missing`` can be 0 or negative;
* the station dimension is joined before the metrics, so a duplicated
  ``STN_ID`` duplicates that station's row and is counted twice;
* duplicates are distinct (STN, TM) keys occurring more than once (rows
  with a NULL key are not reported); out-of-range rows are not de-duplicated
  and may have a NULL STN.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import days_in_year, parse_yyyymmdd, parse_yyyymmdd_int
from ..functions.values import safe_int
from ..session import scratch_path

# ---------------------------------------------------------------------------
# A missing-date sample lists the first 10 dates; report
# tables keep at most 1000 summary rows, 200 churn rows, 2000 per-station
# rows and 100 duplicate / out-of-range rows.
# ---------------------------------------------------------------------------
SAMPLE_N = 10
CAP_SUMMARY, CAP_CHURN, CAP_PER_STATION, CAP_DETAIL = 1000, 200, 2000, 100


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def clean_keys(df: DataFrame, year_col: str = "year") -> DataFrame:
    """Add ``stn`` (int or NULL) and ``tm`` (date or NULL) parsed leniently.

    Text columns (CSV) take the lenient numeric parse; integer columns are
    already numbers and take a plain range check, which stays in generated
    code (no per-row lambda).
    """
    if year_col != "year":
        df = df.withColumnRenamed(year_col, "year")
    types = dict(df.dtypes)
    stn, tm = F.col("STN"), F.col("TM")
    if types.get("STN") in _INTEGRAL:
        stn_v = F.when(stn.between(-2147483648, 2147483647), stn.cast("int"))
    else:
        stn_v = safe_int(stn)
    if types.get("TM") in _INTEGRAL:
        tm_v = parse_yyyymmdd_int(tm)
    else:
        tm_v = parse_yyyymmdd(safe_int(tm))
    return df.withColumn("stn", stn_v).withColumn("tm", tm_v)


def _present(keys: DataFrame) -> DataFrame:
    """Distinct valid (year, stn, tm) -- map-side de-duplicated."""
    return keys.where(F.col("stn").isNotNull() & F.col("tm").isNotNull()).select("year", "stn", "tm").distinct()


WORDS = 6   # 64-bit words of a year's day bitmap


def station_days(keys: DataFrame) -> DataFrame:
    """One row per (year, stn), from one scan of the table: day bitmaps.

    Readings become bits of (year, stn, year of the date): ``WORDS`` words of
    64 days each, or-ed together map-side, so a station's year shuffles as one
    row per task however many readings it has.  Columns: ``has`` (a row with
    both keys valid), ``days_present`` (distinct valid dates, of any year),
    ``w0 .. w5`` (days of the file's year), ``out_rows`` (rows dated outside
    it; also for a NULL station).
    """
    day = F.dayofyear("tm") - 1
    known = F.col("stn").isNotNull() & F.col("tm").isNotNull()
    bits = [F.bit_or(F.when(known & (F.floor(day / 64) == k), F.call_function("shiftleft", F.lit(1).cast("long"), (day % 64).cast("int")))).alias(f"w{k}")
            for k in range(WORDS)]
    parts = keys.groupBy("year", "stn", F.year("tm").alias("ty")).agg(*bits, F.count("tm").alias("n"))
    own = F.col("ty") == F.col("year")
    count = sum((F.bit_count(F.coalesce(F.col(f"w{k}"), F.lit(0).cast("long"))) for k in range(WORDS)), F.lit(0))
    return parts.groupBy("year", "stn").agg(
        F.max(F.col("stn").isNotNull() & F.col("ty").isNotNull()).alias("has"),
        F.sum(count).cast("long").alias("days_present"),
        *[F.coalesce(F.max(F.when(own, F.col(f"w{k}"))), F.lit(0).cast("long")).alias(f"w{k}") for k in range(WORDS)],
        F.coalesce(F.sum(F.when(~own, F.col("n"))), F.lit(0)).cast("long").alias("out_rows"))


def _gaps() -> Column:
    """The missing days of a ``station_days`` row: its year's days without a
    bit, in order."""
    words = F.array(*[F.col(f"w{k}") for k in range(WORDS)])
    days = F.sequence(F.lit(0), days_in_year(F.col("year")).cast("int") - 1)
    unset = lambda i: F.getbit(F.element_at(words, (i / 64).cast("int") + 1), (i % 64).cast("int")) == 0
    return F.transform(F.filter(days, unset), lambda i: F.date_add(F.make_date(F.col("year"), F.lit(1), F.lit(1)), i))


def missing_dates(keys: DataFrame) -> DataFrame:
    """(year, stn, tm) of calendar days of the file's year with no row, read
    off the bitmaps."""
    return station_days(keys).where("has").select("year", "stn", F.explode(_gaps()).alias("tm"))


def per_station(keys: DataFrame, station_info: DataFrame | None = None) -> DataFrame:
    """year, STN, days_present, days_expected, days_missing, missing_sample
    [, LAW_ID, LAW_NM].

    ``missing_sample``: the first 10 missing dates ``YYYY-MM-DD`` joined by
    ", ", plus " ..." when more are missing; "" when none are.
    """
    days = station_days(keys).where("has").withColumn("gaps", _gaps())
    shown = F.transform(F.slice("gaps", 1, SAMPLE_N), lambda d: F.date_format(d, "yyyy-MM-dd"))
    expected = days_in_year(F.col("year")).cast("long")
    out = days.select(F.col("year"), F.col("stn").alias("STN"), "days_present", expected.alias("days_expected"),
                      (expected - F.col("days_present")).alias("days_missing"),
                      F.concat(F.array_join(shown, ", "), F.when(F.size("gaps") > SAMPLE_N, F.lit(" ...")).otherwise(F.lit(""))).alias("missing_sample"))
    if station_info is not None:
        out = out.join(station_info.withColumnRenamed("STN_ID", "STN"), "STN", "left")
    return out


def duplicate_keys(keys: DataFrame) -> DataFrame:
    """Distinct (year, STN, TM) keys with more than one row; NULL keys dropped."""
    k = keys.where(F.col("stn").isNotNull() & F.col("tm").isNotNull())
    return (k.groupBy("year", "stn", "tm").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1).select("year", F.col("stn").alias("STN"), F.col("tm").alias("TM")))


def out_of_range(keys: DataFrame) -> DataFrame:
    """Rows whose valid TM lies outside Jan 1 .. Dec 31 of the file's year."""
    y = F.col("year")
    outside = (F.col("tm") < F.make_date(y, F.lit(1), F.lit(1))) | (F.col("tm") > F.make_date(y, F.lit(12), F.lit(31)))
    return keys.where(F.col("tm").isNotNull() & outside).select(
        "year", F.col("stn").alias("STN"), F.col("tm").alias("TM"))


def year_metrics(keys: DataFrame, station_info: DataFrame | None = None) -> DataFrame:
    """One row per file year: station_count, full_coverage_station_count,
    any_missing_station_count, duplicate_records, out_of_range_records.

    Two scans: the day bitmaps give all but the duplicates.  A station that
    the dimension lists several times counts as often."""
    days = station_days(keys)
    times = F.lit(1)
    if station_info is not None:
        listed = station_info.groupBy(F.col("STN_ID").alias("stn")).agg(F.count(F.lit(1)).alias("times"))
        days = days.join(listed, "stn", "left")
        times = F.coalesce("times", F.lit(1))
    missing = days_in_year(F.col("year")) - F.col("days_present")
    per_year = days.groupBy("year").agg(
        F.count_if("has").alias("station_count"),   # one row per station
        F.sum(F.when(F.col("has") & (missing == 0), times).otherwise(0)).alias("full_coverage_station_count"),
        F.sum(F.when(F.col("has") & (missing > 0), times).otherwise(0)).alias("any_missing_station_count"),
        F.sum("out_rows").alias("out_of_range_records"))
    dup = duplicate_keys(keys).groupBy("year").agg(F.count(F.lit(1)).alias("duplicate_records"))
    out = per_year.join(dup, "year", "left")
    return out.select("year", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in (
        "station_count", "full_coverage_station_count", "any_missing_station_count", "duplicate_records", "out_of_range_records")])


def station_churn(keys: DataFrame, station_info: DataFrame | None = None) -> DataFrame:
    """Stations added / removed against the previous *available* year.

    A year is available when it has a file row at all, valid or not.  With
    ``prev(y)`` / ``next(y)`` the neighbouring available years, a station present in ``y`` is *added* unless its own previous year
    is ``prev(y)``, and a station present in ``p`` is *removed* in
    ``next(p)`` unless its own next year is ``next(p)``.  So one window per
    station (its years, a few dozen rows) plus a table of the distinct years
    replaces set differences between whole years.  The first year lists
    every station as added.
    """
    st = _present(keys).select("year", "stn").distinct()
    # Distinct years: one row per yearly file; the global order is tiny.
    w_all = Window.orderBy("year")
    years = (keys.where(F.col("year").isNotNull()).select("year").distinct()
               .withColumn("prev_y", F.lag("year").over(w_all))
               .withColumn("next_y", F.lead("year").over(w_all)))
    w_stn = Window.partitionBy("stn").orderBy("year")
    own = (st.withColumn("own_prev", F.lag("year").over(w_stn))
             .withColumn("own_next", F.lead("year").over(w_stn))
             .join(F.broadcast(years), "year"))
    added = own.where(F.col("own_prev").isNull() | F.col("prev_y").isNull()
                      | (F.col("own_prev") != F.col("prev_y"))) \
               .select("year", "stn", F.lit("added").alias("change"))
    removed = own.where(F.col("next_y").isNotNull()
                        & (F.col("own_next").isNull() | (F.col("own_next") != F.col("next_y")))) \
                 .select(F.col("next_y").alias("year"), "stn", F.lit("removed").alias("change"))
    out = added.unionByName(removed).withColumnRenamed("stn", "STN")
    if station_info is not None:
        out = out.join(station_info.withColumnRenamed("STN_ID", "STN"), "STN", "left")
    return out


def top_rows(df: DataFrame, n: int, order: list[Column | str], by: str = "year") -> DataFrame:
    """Every row with its ``rank`` in its ``by`` group and whether a report of
    ``n`` rows shows it; only the renderer filters.

    Ranks come without one task per group: ``by`` and ``order`` are range
    partitioned, and a row's rank is its place in its partition plus the rows
    of its group in the partitions before."""
    spark = df.sparkSession
    keys = [F.col(by), *[F.col(c) if isinstance(c, str) else c for c in order]]
    placed = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys) \
        .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    path = scratch_path(spark, f"ranked-{uuid.uuid4().hex}")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy(by, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")) \
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    rank = F.col("_at") - F.col("_first") + F.col("_before") + 1
    out = placed.join(runs, [by, "_part"]).withColumn("rank", rank)
    return out.select(*df.columns, "rank", (F.col("rank") <= n).alias("shown"))


#: Labels of the rendered per-station table.
DISPLAY = {"STN": "Station", "LAW_ID": "Law code", "LAW_NM": "Law name", "days_present": "Days present", "days_expected": "Days expected",
           "days_missing": "Days missing", "missing_sample": "Missing dates"}


def per_station_report(per_station_df: DataFrame, cap: int | None = None) -> DataFrame:
    """Per-station table as reported: fixed column order, missing station
    columns filled with "", every row with its ``rank`` by (days_missing, STN)
    within its year and whether the report shows it (2000 a year by default)."""
    cols = set(per_station_df.columns)
    filled = per_station_df.select(
        "year", "STN",
        *[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in cols else F.lit("")).alias(c)
          for c in ("LAW_ID", "LAW_NM")],
        "days_present", "days_expected", "days_missing", "missing_sample")
    return top_rows(filled, CAP_PER_STATION if cap is None else cap, ["days_missing", "STN", "LAW_ID", "LAW_NM"])
