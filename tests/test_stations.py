"""Station text parsing, code lookup and coverage analysis (FIXTURES 1.5-1.7)."""

import datetime as dt

from pyspark.sql import functions as F

from wxgrid.operators import coverage, stations


def _lines(spark, path, texts):
    return spark.createDataFrame([(path, i, t) for i, t in enumerate(texts)], "path string, line_no long, line string")


def _row(tm, stn, rn):
    f = ["-9"] * 56
    f[0], f[1], f[38] = str(tm), str(stn), str(rn)
    return "  ".join(f)


def test_parse_skips_help_and_end_marker(spark):
    texts = ["# help", "#   TM STN", "", _row(20240101, 108, 1.5), "# mid note", "\t" + _row(20240102, 108, 0.0),
             "  #7777END,,,", _row(20240103, 108, 2.5)]
    lines = _lines(spark, "weather_data_stn108_20240101_20241231.txt", texts)
    default = stations.parse_daily(lines).orderBy("line_no").collect()
    assert [(r["TM"], r["STN"], r["RN_DAY"]) for r in default] == [
        (20240101, 108, 1.5), (20240102, 108, 0.0), (20240103, 108, 2.5)]
    assert default[0]["WS_AVG"] == -9.0 and default[0]["TE_50"] == -9.0
    parity = stations.parse_daily(lines, leading_only=True).orderBy("line_no").collect()
    # parity mode keeps the middle '#' line as a junk row (NULL keys)
    assert [(r["TM"], r["STN"]) for r in parity] == [(20240101, 108), (None, None), (20240102, 108), (20240103, 108)]


def test_law_id_last_duplicate_wins(spark):
    daily = spark.createDataFrame([(108, 1), (109, 2), (None, 3), (999, 4)], "STN int, ord long")
    info = spark.createDataFrame([(108, "111", 1), (109, "222", 2), (108, "333", 3), (None, "444", 4)],
                                 "STN_ID int, LAW_ID string, ord long")
    got = {r["ord"]: r["LAW_ID"] for r in stations.law_id_lookup(daily, info).collect()}
    assert got == {1: "333", 2: "222", 3: None, 4: None}


def _keys(spark, rows):
    df = spark.createDataFrame(rows, "year int, STN string, TM string")
    return coverage.clean_keys(df)


def test_coverage_cases(spark):
    days_2024 = [(2024, "1", (dt.date(2024, 1, 1) + dt.timedelta(d)).strftime("%Y%m%d")) for d in range(366)]
    rows = days_2024 + [
        (2023, "1", "20230101"), (2023, "1", "20230101"),       # duplicate key
        (2023, "1", "20230230"),                                # invalid date -> ignored
        (2023, "x", "20230102"),                                # non-numeric STN -> dropped
        (2023, "2", "20240101"),                                # out of range, still counted present
        (2021, "1", "20210101"),                                # gap year 2022
    ]
    k = _keys(spark, rows)
    ps = {(r["year"], r["STN"]): r for r in coverage.per_station(k).collect()}
    assert ps[(2024, 1)]["days_expected"] == 366 and ps[(2024, 1)]["days_missing"] == 0
    assert ps[(2024, 1)]["missing_sample"] == ""
    assert ps[(2023, 1)]["days_present"] == 1 and ps[(2023, 1)]["days_missing"] == 364
    assert ps[(2023, 1)]["missing_sample"].startswith("2023-01-02, 2023-01-03")
    assert ps[(2023, 1)]["missing_sample"].endswith(" ...")
    assert len(ps[(2023, 1)]["missing_sample"].split(", ")) == 10
    dups = [tuple(r) for r in coverage.duplicate_keys(k).collect()]
    assert dups == [(2023, 1, dt.date(2023, 1, 1))]
    oor = [tuple(r) for r in coverage.out_of_range(k).collect()]
    assert oor == [(2023, 2, dt.date(2024, 1, 1))]
    ym = {r["year"]: r.asDict() for r in coverage.year_metrics(k).collect()}
    assert ym[2023] == {"year": 2023, "station_count": 2, "full_coverage_station_count": 0,
                        "any_missing_station_count": 2, "duplicate_records": 1, "out_of_range_records": 1}
    assert ym[2024]["full_coverage_station_count"] == 1
    churn = sorted(tuple(r) for r in coverage.station_churn(k).select("year", "STN", "change").collect())
    # previous *available* year: 2023 is compared with 2021, not 2022
    assert churn == [(2021, 1, "added"), (2023, 2, "added"), (2024, 2, "removed")]


def test_churn_counts_a_year_without_valid_rows(spark):
    d = dt.date
    k = spark.createDataFrame([(2000, 7, d(2000, 1, 1)), (2001, None, None), (2002, 7, d(2002, 1, 1))],
                              "year int, stn int, tm date")
    churn = sorted(tuple(r) for r in coverage.station_churn(k).select("year", "STN", "change").collect())
    assert churn == [(2000, 7, "added"), (2001, 7, "removed"), (2002, 7, "added")]


def test_top_rows_per_year(spark):
    df = spark.createDataFrame([(y, s) for y in (1, 2) for s in range(5)], "year int, STN int")
    got = sorted(tuple(r) for r in coverage.top_rows(df, 2, [F.col("STN").desc()]).collect())
    assert got == [(y, s, 5 - s, s >= 3) for y in (1, 2) for s in range(5)]


def test_bitmaps_read_days_and_gaps(spark):
    d = dt.date
    rows = [(2020, 1, d(2020, 1, 1) + dt.timedelta(k)) for k in range(366) if k not in (0, 63, 64, 127, 365)] * 2
    rows += [(2021, 1, d(2021, 12, 31)), (2021, 1, d(2022, 1, 1)), (2021, 2, None), (2021, None, d(2021, 5, 5)), (2021, None, d(2019, 5, 5)), (2023, None, None)]
    k = spark.createDataFrame(rows, "year int, stn int, tm date").repartition(4)
    got = {(r["year"], r["STN"]): r for r in coverage.per_station(k).collect()}
    assert set(got) == {(2020, 1), (2021, 1)}
    r = got[2020, 1]
    assert (r["days_present"], r["days_missing"]) == (361, 5)
    assert r["missing_sample"] == "2020-01-01, 2020-03-04, 2020-03-05, 2020-05-07, 2020-12-31"
    r = got[2021, 1]
    assert (r["days_present"], r["days_missing"]) == (2, 363) and r["missing_sample"].endswith("2021-01-10 ...")
    assert coverage.missing_dates(k).groupBy("year").count().orderBy("year").collect() == [(2020, 5), (2021, 364)]
    info = spark.createDataFrame([(1, "a"), (1, "b")], "STN_ID int, LAW_ID string")
    m = {r["year"]: tuple(r)[1:] for r in coverage.year_metrics(k, info).collect()}
    assert m == {2020: (1, 0, 2, 361, 0), 2021: (1, 0, 2, 0, 2), 2023: (0, 0, 0, 0, 0)}


def test_coverage_scans_the_table_at_most_twice(spark, tmp_path):
    spark.createDataFrame([(2020, 1, dt.date(2020, 1, 1))], "year int, stn int, tm date").write.parquet(str(tmp_path / "t"))
    k = spark.read.parquet(str(tmp_path / "t"))
    for df, most in ((coverage.per_station(k), 1), (coverage.missing_dates(k), 1), (coverage.year_metrics(k), 2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") <= most


def test_clean_keys_integer_columns(spark):
    df = spark.createDataFrame([(2023, 108, 20230105), (2023, 108, 20230230), (2023, 108, 2023010),
                                (2023, 108, -20230101), (2023, None, None), (2023, 3000000000, 20230101)],
                               "year int, STN long, TM long")
    got = [(r["stn"], r["tm"]) for r in coverage.clean_keys(df).collect()]
    assert got == [(108, dt.date(2023, 1, 5)), (108, None), (108, None), (108, None), (None, None),
                   (None, dt.date(2023, 1, 1))]
