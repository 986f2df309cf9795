"""Calendars and day gates: which (date, variable) pairs exist, are
missing, are complete, or are still to do.  All are small tables keyed by
(date, var) joined to the fact table with semi / anti joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalogue import SNOW_OFF_MONTHS, SNOW_START_YEAR, SNOW_VAR, specs
from ..functions.dates import to_yyyymmdd

# Fixed value: the skip report lists the first 30 skipped days, then a count.
SKIP_SHOWN = 30


def applicable(var: Column, date: Column) -> Column:
    """Snow is produced from 2020 on and not in June-September."""
    year = F.substring(date, 1, 4).cast("int")
    month = F.substring(date, 5, 2).cast("int")
    return ~((var == F.lit(SNOW_VAR)) & ((year < F.lit(SNOW_START_YEAR)) | month.isin(*SNOW_OFF_MONTHS)))


def season_filter(df: DataFrame, var_col: str = "var", date_col: str = "date") -> DataFrame:
    return df.where(applicable(F.col(var_col), F.col(date_col)))


def calendar(spark, start_year: int, start_month: int, end_year: int, end_month: int) -> DataFrame:
    """Days from the first day of the start month to the last day of the end
    month (the start month applies to the first year, the end month to the
    last), as ``date`` strings YYYYMMDD."""
    d = spark.range(1).select(F.explode(F.sequence(
        F.make_date(F.lit(start_year), F.lit(start_month), F.lit(1)),
        F.last_day(F.make_date(F.lit(end_year), F.lit(end_month), F.lit(1))))).alias("d"))
    return d.select(to_yyyymmdd(F.col("d")).alias("date"))


def calendar_months_each_year(spark, start_year: int, end_year: int, start_month: int, end_month: int) -> DataFrame:
    """Variant: the months start..end in every year of the range."""
    cal = calendar(spark, start_year, 1, end_year, 12)
    m = F.substring("date", 5, 2).cast("int")
    return cal.where((m >= start_month) & (m <= end_month))


def month_calendar(dates: DataFrame, date_col: str = "date") -> DataFrame:
    """Every day of every month that occurs in ``dates`` (YYYYMMDD strings)."""
    first = F.to_date(F.concat(F.substring(date_col, 1, 6), F.lit("01")), "yyyyMMdd")
    months = dates.select(first.alias("m")).distinct()
    days = months.select(F.explode(F.sequence("m", F.last_day("m"))).alias("d"))
    return days.select(to_yyyymmdd(F.col("d")).alias("date"))


def expected_pairs(days: DataFrame, variables, strict: bool = False) -> DataFrame:
    """(date, var) for every day and requested variable.  ``strict=False``
    (default) leaves out snow where it is not produced; ``strict=True``
    expects every requested variable every day (the reference's gate)."""
    pairs = days.select("date", F.explode(F.array(*[F.lit(v) for v in variables])).alias("var"))
    return pairs if strict else season_filter(pairs)


def missing_pairs(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected (date, var) without cached data: a left anti join."""
    return expected.join(present.select("date", "var").distinct(), ["date", "var"], "left_anti")


def complete_days(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Days whose every expected variable is present."""
    days = expected.select("date").distinct()
    gaps = missing_pairs(expected, present).select("date").distinct()
    return days.join(gaps, "date", "left_anti")


def gate(obs: DataFrame, complete: DataFrame) -> DataFrame:
    """Keep only observations of complete days (left semi join).  The day
    table has one row per calendar day, so it is broadcast; on a partitioned
    cache the join also prunes the scan to complete days."""
    return obs.join(F.broadcast(complete), "date", "left_semi")


def todo(requested: DataFrame, done: DataFrame, keys) -> DataFrame:
    """Skip-if-done: requested keys without an existing output."""
    return requested.join(done.select(*keys).distinct(), list(keys), "left_anti")


def expected_hours(var: Column, variables) -> Column:
    """Array of the slot hours of each variable (0..23 or 0, 3, ..., 21)."""
    expr = None
    for s in specs(variables):
        arr = F.sequence(F.lit(0), F.lit(24 - s.step), F.lit(s.step))
        expr = F.when(var == s.name, arr) if expr is None else expr.when(var == s.name, arr)
    return expr


def hour_status(rows: DataFrame, variables) -> DataFrame:
    """(date, var, hours_present, missing_hours, complete) from rows with an
    ``hour``; the hour set per (date, var) holds at most 24 values."""
    g = rows.groupBy("date", "var").agg(F.collect_set("hour").alias("_h"))
    exp = expected_hours(F.col("var"), variables)
    miss = F.array_sort(F.array_except(exp, F.col("_h")))
    return g.select("date", "var",
                    F.size(F.array_intersect(F.col("_h"), exp)).cast("long").alias("hours_present"),
                    F.array_join(F.transform(miss, lambda h: h.cast("string")), ",").alias("missing_hours"),
                    (F.size(miss) == 0).alias("complete"))


def skip_summary(missing: DataFrame, first: int = SKIP_SHOWN) -> DataFrame:
    """Days skipped for missing variables: every day with its missing
    variables, its rank in date order, whether a report of ``first`` days shows
    it, and the total number of skipped days.  Input (date, var)."""
    per_day = missing.groupBy("date").agg(
        F.array_join(F.array_sort(F.collect_list("var")), ",").alias("missing_vars"))
    # One row per skipped day: bounded by the calendar, so the global
    # ordering below handles at most a few thousand rows.
    w = Window.orderBy("date")
    return per_day.withColumn("total_skipped", F.count(F.lit(1)).over(Window.partitionBy())) \
                  .withColumn("rank", F.row_number().over(w)).withColumn("shown", F.col("rank") <= first)


def months_each_year(dates: DataFrame, start_month: int, end_month: int, date_col: str = "date") -> DataFrame:
    """Every day of months ``start_month``..``end_month`` in each year that
    occurs in ``dates`` (the same months in every year)."""
    years = dates.select(F.substring(date_col, 1, 4).cast("int").alias("y")).distinct()
    days = years.select(F.explode(F.sequence(
        F.make_date("y", F.lit(start_month), F.lit(1)),
        F.last_day(F.make_date("y", F.lit(end_month), F.lit(1))))).alias("d"))
    return days.select(to_yyyymmdd(F.col("d")).alias("date"))
