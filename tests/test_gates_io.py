"""Calendars, day gates, summaries, readers and report rendering."""

import os
import tempfile

from pyspark.sql import functions as F

from wxgrid.functions.dates import year_from_filename
from wxgrid.operators import gates
from wxgrid.sinks import writers
from wxgrid.sources import readers


def test_calendar_ranges(spark):
    days = [r["date"] for r in gates.calendar(spark, 2023, 11, 2024, 2).collect()]
    assert days[0] == "20231101" and days[-1] == "20240229" and len(days) == 30 + 31 + 31 + 29
    spring = gates.calendar_months_each_year(spark, 2023, 2024, 3, 4).collect()
    assert len(spring) == 2 * (31 + 30)


def test_gates(spark):
    obs = spark.createDataFrame([("20240101", "ta"), ("20240101", "rn_60m"), ("20240102", "ta"),
                                 ("20240701", "ta"), ("20240701", "rn_60m")], "date string, var string")
    days = spark.createDataFrame([("20240101",), ("20240102",), ("20240701",)], "date string")
    want = ["ta", "rn_60m", "sd_3hr"]
    # default: snow is not expected in July; strict: every requested variable
    loose = sorted(tuple(r) for r in gates.missing_pairs(gates.expected_pairs(days, want), obs).collect())
    assert loose == [("20240101", "sd_3hr"), ("20240102", "rn_60m"), ("20240102", "sd_3hr")]
    strict = gates.complete_days(gates.expected_pairs(days, want, strict=True), obs).collect()
    assert strict == []
    ok = sorted(r["date"] for r in gates.complete_days(gates.expected_pairs(days, want), obs).collect())
    assert ok == ["20240701"]
    todo = gates.todo(days, obs.where("var = 'ta'"), ["date"]).collect()
    assert todo == []


def test_skip_summary_and_failure_summary(spark):
    miss = spark.createDataFrame([(f"202401{d:02d}", v) for d in range(1, 32) for v in ("ta", "sd_3hr")],
                                 "date string, var string")
    s = gates.skip_summary(miss, first=30).orderBy("date").collect()
    assert len(s) == 31 and s[0]["missing_vars"] == "sd_3hr,ta" and s[0]["total_skipped"] == 31
    assert [r["rank"] for r in s] == list(range(1, 32)) and [r["shown"] for r in s] == [True] * 30 + [False]
    status = spark.createDataFrame([("d1", "ta", True), ("d1", "sd_3hr", False), ("d2", "ta", True)],
                                   "date string, var string, complete boolean")
    f = {r["date"]: (r["ok"], r["failed"]) for r in writers.failure_summary(status).collect()}
    assert f == {"d1": ("ta", "sd_3hr"), "d2": ("ta", "")}


def test_year_from_filename(spark):
    df = spark.createDataFrame([("/a/weather_data_stn0_1970.csv",), ("/a/weather_data_stn108_2024_v2.csv",),
                                ("/a/weather_data_stn1.csv",), ("/a/x_19700101_19701231.txt",)], "p string")
    got = [r[0] for r in df.select(year_from_filename(F.col("p"))).collect()]
    assert got == [1970, 2024, None, None]


def test_readers(spark):
    d = tempfile.mkdtemp(prefix="wxgrid-readers-")
    with open(os.path.join(d, "ta_202401010000.txt"), "w") as f:
        f.write("1 2 3")
    with open(os.path.join(d, "rn_60m_202401010100.txt"), "w") as f:
        f.write("4 5 6")
    r = sorted((x["var"], x["tm"], x["text"]) for x in readers.read_responses(spark, d).collect())
    assert r == [("rn_60m", "202401010100", "4 5 6"), ("ta", "202401010000", "1 2 3")]
    lst = sorted((x["var"], x["tm"]) for x in readers.list_responses(spark, d).collect())
    assert lst == [("rn_60m", "202401010100"), ("ta", "202401010000")]
    empty = readers.read_station_info(spark, None)
    assert empty.columns == ["STN_ID", "LAW_ID", "LAW_NM"] and empty.count() == 0
    info = os.path.join(d, "info.csv")
    with open(info, "w") as f:
        f.write("STN_ID,LAW_ID\n108,0011000000\nx,1\n")
    rows = sorted((r["STN_ID"], r["LAW_ID"], r["LAW_NM"]) for r in readers.read_station_info(spark, info).collect()
                  if r["STN_ID"] is not None)
    assert rows == [(108, "0011000000", None)]


def test_markdown_by_key(spark):
    df = spark.createDataFrame([(2024, i, f"s{i}") for i in range(5)] + [(2023, 1, None)],
                               "year int, STN int, note string")
    out = {r["year"]: r["text"] for r in writers.markdown_by_key(df, "year", ["STN"], 3, "T").collect()}
    assert out[2024].splitlines()[2:] == ["| STN | note |", "| --- | --- |", "| 0 | s0 |", "| 1 | s1 |", "| 2 | s2 |", "", "3 of 5 rows"]
    assert out[2023].splitlines()[-1] == "| 1 |  |"


def test_small_date_and_slot_functions(spark):
    import datetime as dt

    from wxgrid.catalogue import spec
    from wxgrid.functions.dates import day_range, hours_of_day, month_of, year_of
    from wxgrid.functions.slots import slot_label, slot_label_for, time_key
    from wxgrid.operators.stations import line_numbers
    row = spark.range(1).select(
        time_key(F.lit("20240105"), F.lit(7)).alias("tk"),
        hours_of_day(1).alias("h1"), hours_of_day(3).alias("h3"),
        year_of(F.lit("20240105")).alias("y"), month_of(F.lit("20240105")).alias("m"),
        slot_label(F.lit("ta"), F.lit(23), ["ta"]).alias("s23"),
        slot_label_for(spec("sd_3hr"), F.lit(21)).alias("s21"),
        slot_label_for(spec("sd_3hr"), F.lit(1)).alias("off")).first()
    assert row["tk"] == "202401050700" and row["h1"] == list(range(24)) and row["h3"] == list(range(0, 24, 3))
    assert (row["y"], row["m"]) == (2024, 1)
    assert (row["s23"], row["s21"], row["off"]) == ("t2300", "s2124", None)
    days = spark.range(1).select(day_range(2023, 12, 2024, 2).alias("d")).collect()
    assert days[0]["d"] == dt.date(2023, 12, 1) and days[-1]["d"] == dt.date(2024, 2, 29) and len(days) == 91
    df = spark.createDataFrame([("a", 5), ("a", 2), ("b", 9)], "path string, ord long")
    got = sorted(tuple(r) for r in line_numbers(df).collect())
    assert got == [("a", 2, 0), ("a", 5, 1), ("b", 9, 0)]
