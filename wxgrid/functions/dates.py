"""Date helpers: strict YYYYMMDD parsing, calendars, file-name years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_yyyymmdd(c: Column) -> Column:
    """Strict 8-digit ``YYYYMMDD`` -> date; anything else (including
    ``20230230`` or a 6-digit ``202011``) -> NULL."""
    def body(s):
        return F.when(s.rlike("^[0-9]{8}$"), F.try_to_date(s, "yyyyMMdd"))
    return F.element_at(F.transform(F.array(c.cast("string")), body), 1)


def parse_yyyymmdd_int(c: Column) -> Column:
    """``parse_yyyymmdd`` for an integer column: an 8-digit non-negative
    value is exactly one in 10000000..99999999; no text handling needed."""
    return F.when(c.between(10000000, 99999999), F.try_to_date(c.cast("string"), "yyyyMMdd"))


def to_yyyymmdd(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd")


def year_of(date_str: Column) -> Column:
    return F.substring(date_str, 1, 4).cast("int")


def month_of(date_str: Column) -> Column:
    return F.substring(date_str, 5, 2).cast("int")


def days_in_year(year: Column) -> Column:
    return F.datediff(F.make_date(year + F.lit(1), F.lit(1), F.lit(1)), F.make_date(year, F.lit(1), F.lit(1)))


def day_range(start_year: int, start_month: int, end_year: int, end_month: int) -> Column:
    """Every day from the first day of (start_year, start_month) to the last
    day of (end_year, end_month): the start month applies only to the first
    year and the end month only to the last."""
    return F.explode(F.sequence(F.make_date(F.lit(start_year), F.lit(start_month), F.lit(1)),
                                F.last_day(F.make_date(F.lit(end_year), F.lit(end_month), F.lit(1)))))


def hours_of_day(step: int = 1) -> Column:
    """0..23 (hourly) or 0, 3, ..., 21 (3-hourly) as an array."""
    return F.sequence(F.lit(0), F.lit(23), F.lit(step)) if step == 1 else F.sequence(F.lit(0), F.lit(21), F.lit(step))


def year_from_filename(path: Column) -> Column:
    """First underscore-separated part of the base name (``.csv`` removed)
    that is exactly four digits, as int; NULL when there is none."""
    # One regular expression, no lambda: this expression can be pushed down
    # to file pruning on the file path, where plain expressions are safest.
    base = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.csv", "")
    year = F.regexp_extract(base, r"(?:^|_)([0-9]{4})(?=_|$)", 1)
    return F.nullif(year, F.lit("")).try_cast("int")
