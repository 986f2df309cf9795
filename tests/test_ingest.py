"""Ingest: whole-day rejection and quarantine."""

from wxgrid.operators import ingest


def _resp(spark, rows):
    return spark.createDataFrame(rows, "var string, tm string, text string")


def test_complete_day_written_incomplete_day_quarantined(spark):
    good = "3 2\n1 2 3\n4 -999 6"
    rows = [("sd_3hr", f"20240101{h:02d}00", good) for h in range(0, 24, 3)]
    rows += [("sd_3hr", f"20240102{h:02d}00", good) for h in range(0, 21, 3)]   # 21h missing
    rows += [("sd_3hr", "20240103" + f"{h:02d}00", good if h else "<html>busy</html>") for h in range(0, 24, 3)]
    obs, quar = ingest.ingest(_resp(spark, rows), ["sd_3hr"], n_expected=6)
    o = obs.collect()
    assert {r["date"] for r in o} == {"20240101"}
    assert len(o) == 8 * 6
    assert sorted(r["value"] for r in o if r["hour"] == 0 and r["value"] is not None) == [1, 2, 3, 4, 6]
    q = {(r["date"], r["reason"]) for r in quar.collect()}
    assert ("20240102", "missing_hours=21") in q
    assert ("20240103", "error_response") in q and ("20240103", "missing_hours=0") in q


def test_first_reading_wins_in_order(spark):
    rows = [("ta", "202401010000", "1 2"), ("ta", "202401010100", "3 4")]
    valid = ingest.validate(_resp(spark, rows), 2)
    long = ingest.to_long(valid).orderBy("ord").collect()
    assert [(r["hour"], r["grid_idx"], r["value"]) for r in long] == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)]
