"""The station report's cap is the one that was asked for."""

from wxgrid.operators import coverage
from wxgrid.sinks import writers


def test_cap_zero_is_no_rows(spark):
    rows = spark.createDataFrame([(2020, 1, 366, 366, 0, ""), (2020, 2, 365, 366, 1, "2020-01-01")],
                                 "year int, STN int, days_present long, days_expected long, days_missing long, missing_sample string")
    def shown(cap):
        got = coverage.per_station_report(rows, cap).orderBy("rank").collect()
        assert [(r["STN"], r["rank"]) for r in got] == [(1, 1), (2, 2)]   # no row is dropped
        return [r["shown"] for r in got]

    assert shown(0) == [False, False] and shown(1) == [True, False] and shown(None) == [True, True]


def test_renderer_counts_what_it_leaves_out(spark):
    rows = spark.createDataFrame([(2020, k) for k in range(5)], "year int, STN int")
    (text,) = [r["text"] for r in writers.markdown_by_key(rows, "year", ["STN"], 2, "T", {"STN": "Station"}).collect()]
    assert "| Station |" in text and "| 1 |" in text and "| 2 |" not in text and "2 of 5 rows" in text
