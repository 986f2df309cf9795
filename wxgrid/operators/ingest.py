"""Raw grid responses -> validated long observations + quarantine.

Input: one row per response ``(var, tm, text)`` with ``tm`` =
``YYYYMMDDHHmm`` (``sources.readers.read_responses`` derives both from the
file name ``{var}_{tm}.txt``).  Every step is a Column expression; the only
generator is ``posexplode`` of the validated value array, so each response
is one task's work and many responses run in parallel.

A (date, var) is written only when every expected hour (24, or 8 for the
3-hourly variable) has an accepted response; otherwise the whole day of
that variable goes to the quarantine with the list of missing/bad hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalogue import VARIABLES, specs
from ..functions import text as T
from ..functions.values import clean_sentinel
from .gates import expected_hours

QUARANTINE_COLUMNS = ["tm", "var", "date", "hour", "level", "reason", "preview",
                      "head", "tail", "total_chars", "total_lines", "logged_at"]


def _n_col(n_expected) -> Column | None:
    if n_expected is None:
        return None
    return n_expected if isinstance(n_expected, Column) else F.lit(int(n_expected))


def validate(resp: DataFrame, n_expected=None) -> DataFrame:
    """Per response: ``date``, ``hour``, ``vals`` (NULL when rejected),
    ``reason`` and, for rejected responses only, the snippet columns.

    ``T.parse_response`` tokenises the text once; ``inline`` turns its
    struct into columns through a generator, which Catalyst does not fold
    back into later expressions, so nothing is parsed twice.  The raw text
    is dropped from the result.
    """
    n = _n_col(n_expected)
    keep = [c for c in resp.columns if c != "text"]
    parsed = resp.select(*keep, "text", F.inline(F.array(T.parse_response(F.col("text"), n))))
    # A reading belongs to a full hour of its variable's grid (every hour, or
    # every third one); a response for any other time is rejected.
    at = F.substring("tm", 9, 2).cast("int")
    step = F.lit(1)
    for s in specs(VARIABLES):
        step = F.when(F.col("var") == s.name, s.step).otherwise(step)
    on_time = F.coalesce((F.substring("tm", 11, 2) == "00") & at.between(0, 23) & (at % step == 0), F.lit(False))
    parsed = (parsed.withColumn("reason", F.coalesce("reason", F.when(~on_time, F.lit("off_schedule_time"))))
                    .withColumn("vals", F.when(F.col("reason").isNull(), F.col("vals"))))
    rejected = F.col("reason").isNotNull()
    body = F.coalesce(F.col("text"), F.lit(""))
    lines = T.split_lines(body)
    return parsed.select(
        *keep, F.substring("tm", 1, 8).alias("date"), F.substring("tm", 9, 2).cast("int").alias("hour"),
        "vals", "reason",
        F.when(rejected, T.preview(body)).alias("preview"),
        F.when(rejected, T.snippet_head(lines)).alias("head"),
        F.when(rejected, T.snippet_tail(lines)).alias("tail"),
        F.when(rejected, F.length(body)).cast("long").alias("total_chars"),
        F.when(rejected, F.size(lines)).cast("long").alias("total_lines"))


def to_long(valid: DataFrame, extra=()) -> DataFrame:
    """Accepted responses exploded to (grid_idx, date, var, hour, value, ord).

    ``ord`` orders readings as the reference concatenates them (hour, then
    cell), so a duplicate reading resolves to the first one.  ``extra``
    names response columns to carry along.
    """
    ok = valid.where(F.col("vals").isNotNull())
    ex = ok.select(*extra, "var", "date", "hour", F.posexplode("vals").alias("grid_idx", "raw"))
    return ex.select(
        *extra, F.col("grid_idx").cast("long").alias("grid_idx"), "date", "var", "hour",
        clean_sentinel(F.col("raw")).alias("value"),
        (F.col("hour").cast("long") * F.lit(1 << 32) + F.col("grid_idx")).alias("ord"))


def _hour_bits(which: Column) -> Column:
    """The hours of the rows that ``which`` selects, as bits of an int.  Accepted
    responses are at a full hour from 0 to 23; unlike a set of hours, a number
    is aggregated in place however many days there are."""
    return F.coalesce(F.bit_or(F.when(which, F.call_function("shiftleft", F.lit(1), F.col("hour")))), F.lit(0))


def _hours_of(bits: Column) -> Column:
    """The hours of a bitmap, sorted."""
    return F.filter(F.sequence(F.lit(0), F.lit(23)), lambda h: F.call_function("shiftright", bits, h) % 2 == 1)


def _status(hours: DataFrame, variables) -> DataFrame:
    """(date, var, complete, missing_hours, value_hours) from bitmaps of the
    accepted (``ok``) and the reporting hours (``real``) of every (date, var)."""
    miss = F.array_sort(F.array_except(expected_hours(F.col("var"), variables), _hours_of(F.col("ok"))))
    return hours.select("date", "var",
                        (F.size(miss) == 0).alias("complete"),
                        F.array_join(F.transform(miss, lambda h: h.cast("string")), ",").alias("missing_hours"),
                        _hours_of(F.col("real")).alias("value_hours"))


def day_status(valid: DataFrame, variables) -> DataFrame:
    """(date, var, complete, missing_hours, value_hours): hour-completeness
    per day.

    ``missing_hours`` lists expected hours without an accepted response
    (sorted, comma-joined); a day is complete when the list is empty.
    ``value_hours`` are the accepted hours with at least one real reading.
    """
    # An hour "has values" when any cell holds a reading that survives the
    # sentinel rule; regional sums leave slots without any NULL.
    has_value = F.exists(F.col("vals"), lambda x: clean_sentinel(x).isNotNull())
    ok = F.col("vals").isNotNull()
    return _status(valid.groupBy("date", "var").agg(
        _hour_bits(ok).alias("ok"), _hour_bits(ok & has_value).alias("real")), variables)


def staged(valid: DataFrame) -> DataFrame:
    """All of ``valid`` as long rows: one per reading of an accepted response,
    one (without a cell) per rejected response with its reason and snippets."""
    rest = [c for c in ("tm", "reason", "preview", "head", "tail", "total_chars", "total_lines") if c in valid.columns]
    ex = valid.select("var", "date", "hour", *rest, F.posexplode_outer("vals").alias("grid_idx", "raw"))
    return ex.select("var", "date", "hour", *rest, F.col("grid_idx").cast("long").alias("grid_idx"),
                     clean_sentinel(F.col("raw")).alias("value"),
                     (F.col("hour").cast("long") * F.lit(1 << 32) + F.col("grid_idx")).alias("ord"))


def staged_status(rows: DataFrame, variables) -> DataFrame:
    """``day_status`` of staged rows: partial aggregates over three narrow
    columns, nothing is parsed again."""
    ok = F.col("reason").isNull()
    return _status(rows.groupBy("date", "var").agg(
        _hour_bits(ok).alias("ok"), _hour_bits(ok & F.col("value").isNotNull()).alias("real")), variables)


def rejected(valid: DataFrame) -> DataFrame:
    """Quarantine rows of the rejected responses."""
    return valid.where(F.col("reason").isNotNull()).select(
        "tm", "var", "date", "hour", F.lit("ERROR").alias("level"), "reason",
        "preview", "head", "tail", "total_chars", "total_lines",
        F.current_timestamp().alias("logged_at"))


def quarantine(valid: DataFrame, status: DataFrame) -> DataFrame:
    """Rejected responses, plus one row per incomplete (date, var)."""
    bad = rejected(valid)
    gaps = status.where(~F.col("complete")).select(
        F.concat("date", F.lit("----")).alias("tm"), "var", "date", F.lit(None).cast("int").alias("hour"),
        F.lit("ERROR").alias("level"),
        F.concat(F.lit("missing_hours="), F.col("missing_hours")).alias("reason"),
        F.lit(None).cast("string").alias("preview"), F.lit(None).cast("string").alias("head"),
        F.lit(None).cast("string").alias("tail"), F.lit(None).cast("long").alias("total_chars"),
        F.lit(None).cast("long").alias("total_lines"), F.current_timestamp().alias("logged_at"))
    return bad.unionByName(gaps)


def ingest(resp: DataFrame, variables, n_expected=None) -> tuple[DataFrame, DataFrame]:
    """Stage A as one plan: (observations of complete days, quarantine).

    The completeness gate is a ``left_semi`` join on (date, var) against a
    per-day status table of at most (days x variables) rows -- bounded by
    the calendar, so it is broadcast.  ``valid`` feeds three outputs; a job
    writes ``staged`` rows first (``plans.jobs.ingest_job``), so each response
    is parsed once.
    """
    valid = validate(resp.where(F.col("var").isin(*list(variables))), n_expected)
    status = day_status(valid, variables)
    complete = status.where("complete").select("date", "var")
    obs = to_long(valid).join(F.broadcast(complete), ["date", "var"], "left_semi")
    return obs, quarantine(valid, status)
