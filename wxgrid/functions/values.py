"""Value cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..catalogue import SENTINEL_HIGH, SENTINEL_LOW


def clean_sentinel(v: Column) -> Column:
    """Missing-value codes to NULL: below -900, above 2000, NaN and +-inf.

    -900 and 2000 themselves are kept.  NaN compares greater than any number
    in Spark, so ``v > 2000`` already covers it; the explicit ``isnan`` keeps
    the intent readable.
    """
    v = v.cast("double")
    bad = (v < F.lit(SENTINEL_LOW)) | (v > F.lit(SENTINEL_HIGH)) | F.isnan(v)
    return F.when(~bad, v)


def _let(value: Column, body) -> Column:
    """Bind ``value`` once (see ``functions.text.let``)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def safe_int(c: Column) -> Column:
    """``to_numeric(errors='coerce').astype('Int64')``: text -> int or NULL.

    Integer text takes the direct cast; anything else is parsed as a double
    and kept when it is whole and in range.  Non-numeric text, fractions and
    out-of-range values become NULL instead of failing (ANSI mode is on).
    The input is evaluated once, so composed parsers stay small.
    """
    def body(s):
        def from_double(d):
            whole = d.isNotNull() & (d == F.floor(d)) & (F.abs(d) < F.lit(2147483648.0))
            return F.when(whole, d.cast("long").cast("int"))
        return F.coalesce(s.try_cast("int"), _let(s.try_cast("double"), from_double))
    return _let(F.trim(c.cast("string")), body)


def safe_double(c: Column) -> Column:
    """Text or number -> double, NULL when not numeric."""
    return F.trim(c.cast("string")).try_cast("double")
