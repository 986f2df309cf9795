"""The quarantine's folders, and its rows from responses parsed once."""

import glob

from wxgrid.operators import ingest
from wxgrid.plans import registry
from wxgrid.sinks import writers as W


def _log(spark, days):
    rows = [(f"2024{m:02d}{d:02d}0000", v, f"2024{m:02d}{d:02d}", None, "ERROR", "empty") for m in range(1, 13) for d in range(1, days + 1) for v in ("ta", "rn_60m")]
    rows += [("202501010000", "ta", "20250101", 0, "ERROR", "empty"), (None, "ta", None, None, "ERROR", "empty")]
    return spark.createDataFrame(rows, "tm string, var string, date string, hour int, level string, reason string")


def test_folders_by_variable_and_year_not_by_day(spark, tmp_path):
    log, root = _log(spark, 20).repartition(8), str(tmp_path / "q")
    W.write_quarantine(log, root)
    assert len(glob.glob(f"{root}/*/*")) == 4          # ta 2024, 2025 and without a date; rn_60m 2024
    assert len(glob.glob(f"{root}/**/*.parquet", recursive=True)) <= 8
    W.write_quarantine(log, root)                      # appends
    back = spark.read.schema("tm string, var string, date string, hour int, level string, reason string, year string").parquet(root)
    assert sorted(map(str, back.select(*log.columns).collect())) == sorted(map(str, log.unionAll(log).collect()))


def test_quarantine_reads_the_staged_rows(spark):
    used = registry.ingest_quarantine(spark, "/root/testdata/sf0.001").inputFiles()
    assert used and not [f for f in used if "lineitem" in f]


def test_hours_of_a_day_are_aggregated_without_sets(spark):
    rows = [("ta", f"20240101{h:02d}00", "1 2" if h != 7 else "-999 -999") for h in range(23)] + [("ta", "202401012300", "1"), ("ta", None, "1 2"), ("ta", "202401019900", "1 2")]
    valid = ingest.validate(spark.createDataFrame(rows, "var string, tm string, text string"), 2)
    for status in (ingest.day_status(valid, ["ta"]), ingest.staged_status(ingest.staged(valid), ["ta"])):
        got = {r["date"]: r for r in status.collect()}
        assert got["20240101"]["missing_hours"] == "23" and not got["20240101"]["complete"]
        assert got["20240101"]["value_hours"] == [h for h in range(23) if h != 7]
        assert got[None]["value_hours"] == [] and got[None]["missing_hours"].startswith("0,1,2")
        assert "ObjectHashAggregate" not in status._jdf.queryExecution().executedPlan().toString()
