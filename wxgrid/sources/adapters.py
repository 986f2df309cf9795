"""Adapters: the driver's test tables re-read as this library's inputs.

The driver ships TPC-H-like tables, not weather data.  Each adapter is a
fixed, documented projection so the same rows can be rebuilt in DuckDB SQL
for the oracle (see ``wxgrid.plans.oracle``).  Nulls are injected by the same
formula on both sides.

* OBS   events          -> long observations (grid_idx, date, var, hour, value, ord)
* MAP   customer        -> grid -> region mapping (HJD_CD, EMD_CD)
* DAILY orders x customer -> station daily rows (STN, TM, file_year, ord, RN_DAY)
* STN   nation          -> station dimension (STN_ID, LAW_ID, LAW_NM)
* POINTS embeddings     -> points (pid, x, y)
* RESP  lineitem        -> raw grid responses, one text per order
* LANDED RESP           -> responses of days, with every kind of fault
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    h = F.hour("ts")
    return e.select(
        F.col("user_id").alias("grid_idx"),
        F.date_format("ts", "yyyyMMdd").alias("date"),
        F.when(et.isin("click", "view"), "ta")
         .when(et.isin("purchase", "signup"), "rn_60m").otherwise("sd_3hr").alias("var"),
        F.when(et == "error", h - h % 3).otherwise(h).alias("hour"),
        F.col("event_id").alias("ord"),
        F.when((F.col("event_id") % 13 == 0) | (F.col("event_id") % 17 == 0), F.lit(None))
         .otherwise(F.col("value")).cast("double").alias("value"),
    )


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("grid_idx"),
        F.when(F.col("c_acctbal") < 0, F.lit(None))
         .otherwise(F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("HJD_CD"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit(None))
         .otherwise(F.col("c_mktsegment")).alias("EMD_CD"),
    )


def mapping_hjd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping(spark, sf_dir).select("grid_idx", "HJD_CD")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    y = F.year("o_orderdate")
    # a fifth of the station-years belongs to a second station: years with a
    # station missing, and stations without an entry in the dimension
    second = (F.col("c_nationkey") + y) % 5 == 0
    return j.select(
        F.when(second, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")).alias("STN"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("TM"),
        (y + F.when(F.col("o_orderkey") % 97 == 0, 1).otherwise(0)).alias("file_year"),
        F.col("o_orderkey").alias("ord"),
        F.col("o_totalprice").alias("RN_DAY"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("STN_ID"),
        F.lpad(F.col("n_regionkey").cast("string"), 10, "0").alias("LAW_ID"),
        F.col("n_name").alias("LAW_NM"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("pid"),
        F.col("embedding")[0].cast("double").alias("x"),
        F.col("embedding")[1].cast("double").alias("y"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw response per order: a comment line, an ``n 1`` header line,
    then the quantities ordered by (linenumber, quantity) joined by ", ".

    Built with a per-order ``collect_list`` -- an order has at most a few
    lines, so the group is bounded by construction.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    g = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("items"))
    body = F.array_join(F.transform("items", lambda s: s["l_quantity"].cast("string")), ", ")
    return g.select(
        F.col("l_orderkey").alias("resp_id"),
        F.col("n").alias("expected_n"),
        F.concat(F.lit("# c\n"), F.col("n").cast("string"), F.lit(" 1\n"), body).alias("text"),
    )


#: Responses per day of LANDED: the 24 hours and two that no day has.
PER_DAY = 26


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(var, tm, text, expected_n): ``PER_DAY`` orders are a day of one
    variable.  Two days of three hold faulty responses: an error page, a blank
    one, one without numbers, too few values, a value too many, a header that
    is not finite, a time between the hours.  Orders without lines leave gaps."""
    r = responses(spark, sf_dir)
    k, text = F.col("resp_id"), F.col("text")
    day, hour = F.floor(k / PER_DAY), k % PER_DAY
    fault = F.when(day % 3 != 0, k % 29).otherwise(F.lit(-1))
    body = (F.when(fault == 0, F.concat(F.lit("<html>"), text)).when(fault == 1, F.lit(" \n")).when(fault == 2, F.lit("# c\n"))
             .when(fault == 4, F.concat(text, F.lit(", 7"))).when(fault == 5, F.concat(F.lit("nan "), F.substring_index(text, "\n", -1), F.lit(", 8"))).otherwise(text))
    return r.select(
        F.when(day % 2 == 0, F.lit("ta")).otherwise(F.lit("rn_60m")).alias("var"),
        F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")), "yyyyMMdd"), F.lpad(hour.cast("string"), 2, "0"),
                 F.when(fault == 6, F.lit("30")).otherwise(F.lit("00"))).alias("tm"),
        body.alias("text"), (F.col("expected_n") + F.when(fault == 3, 3).otherwise(0)).alias("expected_n"))
