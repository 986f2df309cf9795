"""End-to-end jobs on small files in a scratch folder."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from wxgrid.plans import jobs
from wxgrid.streaming.landing import start_ingest_stream

N = 6  # a 3 x 2 grid


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture(scope="module")
def scratch():
    return tempfile.mkdtemp(prefix="wxgrid-jobs-")


@pytest.fixture(scope="module")
def landing(scratch):
    d = os.path.join(scratch, "landing")
    for h in range(24):
        _write(f"{d}/ta_20240101{h:02d}00.txt", f"# ta\n3 2\n{h} 1 2\n3 4 -999\n")
        if h != 5:   # 2024-01-02 misses hour 5
            _write(f"{d}/ta_20240102{h:02d}00.txt", f"{h} 1 2 3 4 5\n")
    _write(f"{d}/rn_60m_202401010000.txt", "<html>busy</html>")
    return d


def test_ingest_and_regional(spark, scratch, landing):
    obs_root = os.path.join(scratch, "obs")
    status = jobs.ingest_job(spark, landing, obs_root, os.path.join(scratch, "quarantine"), ["ta"], N)
    st = {(r["date"], r["complete"]) for r in status.collect()}
    assert st == {("20240101", True), ("20240102", False)}
    obs = spark.read.parquet(obs_root)
    assert obs.count() == 24 * N
    assert obs.where(F.col("value").isNull()).count() == 24
    q = spark.read.parquet(os.path.join(scratch, "quarantine"))
    assert q.where(F.col("reason") == "missing_hours=5").count() == 1
    # rerun skips cached days
    jobs.ingest_job(spark, landing, obs_root, os.path.join(scratch, "quarantine2"), ["ta"], N)
    assert spark.read.parquet(obs_root).count() == 24 * N

    mapping = os.path.join(scratch, "mapping")
    spark.createDataFrame([(0, "A"), (1, "A"), (2, "B"), (5, None)], "grid_idx long, HJD_CD string") \
        .write.parquet(mapping)
    out = os.path.join(scratch, "out")
    skipped = jobs.regional_job(spark, obs_root, mapping, out, ["ta"], region_type="hjd")
    assert skipped.count() > 0   # other January days have no data
    interim = spark.read.parquet(os.path.join(out, "interim")).collect()
    got = {r["HJD_CD"]: (r["t0001"], r["t0506"]) for r in interim}
    assert got == {"A": (0.5, 3.0), "B": (2.0, 2.0)}
    assert glob.glob(os.path.join(out, "yearly_hjd", "year=2024", "*.csv"))
    # sum: every hour of 20240101 has readings, so empty slots are 0.0 only
    # where the region has no cell value; all hours present -> no NULL slots
    out_sum = os.path.join(scratch, "out_sum")
    jobs.regional_job(spark, obs_root, mapping, out_sum, ["ta"], region_type="hjd", method="sum")
    row = {r["HJD_CD"]: r for r in spark.read.parquet(os.path.join(out_sum, "interim")).collect()}
    assert row["A"]["t0001"] == 1.0 and row["B"]["t0506"] == 2.0


def test_station_and_coverage(spark, scratch):
    raw = os.path.join(scratch, "stations_raw")
    for y in (2023, 2024):
        rows = [f"{y}0101 108 " + " ".join(["-9"] * 54), f"{y}0102 108 " + " ".join(["-9"] * 54)]
        _write(f"{raw}/weather_data_stn108_{y}0101_{y}1231.txt", "# help\n#\n" + "\n".join(rows) + "\n#7777END\n")
    _write(f"{raw}/notes.txt", "20230101 999 1 2 3\n")     # not a station-year file: ignored
    info = os.path.join(scratch, "station_info.csv")
    _write(info, "STN_ID,LAW_ID,LAW_NM\n108,0011000000,Seoul\n")
    tables = os.path.join(scratch, "stations")
    summary = jobs.station_job(spark, raw + "/*.txt", info, tables)
    assert sorted(tuple(r) for r in summary.collect()) == [(2023, 108, 2, 0, 0), (2024, 108, 2, 0, 0)]
    t = spark.read.option("header", True).csv(tables)
    assert t.count() == 4 and {r["LAW_ID"] for r in t.collect()} == {"0011000000"}
    # coverage over the written yearly tables, named as the reference names them
    csv_dir = os.path.join(scratch, "station_csv")
    for y in (2023, 2024):
        parts = sorted(glob.glob(os.path.join(tables, f"year={y}", "station=108", "*.csv")))
        texts = [open(p).read().splitlines() for p in parts]
        header = next(t[0] for t in texts if t)
        rows = [ln for t in texts for ln in t[1:]]
        _write(os.path.join(csv_dir, f"weather_data_stn108_{y}.csv"), "\n".join([header, *rows]) + "\n")
    out = jobs.coverage_job(spark, csv_dir + "/weather_data_stn*_*.csv", info, os.path.join(scratch, "coverage"))
    ym = {r["year"]: r["station_count"] for r in out["year_metrics"].collect()}
    assert ym == {2023: 1, 2024: 1}
    ps = out["per_station"].where("year = 2024").first()
    assert ps["days_present"] == 2 and ps["days_missing"] == 364 and ps["LAW_NM"] == "Seoul"
    # the same analysis straight on the station job's partitioned output
    out2 = jobs.coverage_job(spark, tables, info, os.path.join(scratch, "coverage2"))
    assert sorted(tuple(r) for r in out2["year_metrics"].collect()) == \
        sorted(tuple(r) for r in out["year_metrics"].collect())
    # a second station for 2024 arrives later: added, 108's rows stay
    _write(f"{raw}/weather_data_stn109_20240101_20241231.txt", f"20240101 109 " + " ".join(["-9"] * 54) + "\n")
    again = jobs.station_job(spark, raw + "/*.txt", info, tables)
    assert sorted(tuple(r) for r in again.collect()) == [(2024, 109, 1, 0, 1)]
    t = spark.read.option("header", True).csv(tables)
    assert t.count() == 5


def test_streaming_ingest(spark, scratch, landing):
    root = os.path.join(scratch, "stream")
    # a second copy of one hour in a sub-folder of the same batch
    _write(f"{landing}/copy/ta_2024010103" + "00.txt", "3 2\n9 9 9\n9 9 9\n")
    try:
        q = start_ingest_stream(spark, landing, root, ["ta"], N, trigger_once=True, recursive=True)
        q.awaitTermination(300)
    finally:
        os.remove(f"{landing}/copy/ta_202401010300.txt")
    obs = spark.read.parquet(os.path.join(root, "observations"))
    assert {r["date"] for r in obs.select(F.col("date").cast("string").alias("date")).distinct().collect()} == {"20240101"}
    assert obs.count() == 24 * N     # the duplicate hour is not counted twice
    man = spark.read.parquet(os.path.join(root, "observations_manifest")).collect()
    assert [(r["date"], r["var"], r["complete"], len(r["value_hours"])) for r in man] == [("20240101", "ta", True, 24)]
    # the html page for rn_60m is not a requested variable; 20240102 misses
    # hour 5 and is not promoted, so the stream's quarantine stays empty
    q = os.path.join(root, "quarantine")
    assert not glob.glob(os.path.join(q, "**", "*.parquet"), recursive=True)


def test_mapping_job(spark, scratch):
    rows = [(y, [37.0 + y * 0.1] * 10, [127.0 + x * 0.1 for x in range(10)]) for y in range(10)]
    grid = os.path.join(scratch, "grid_rows")
    spark.createDataFrame(rows, "y int, lat array<double>, lon array<double>").write.parquet(grid)
    ring = "array<array<struct<x:double,y:double>>>"

    def square(x0, y0, x1, y1):
        return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]]
    hjd = os.path.join(scratch, "hjd")
    spark.createDataFrame([("1101", "west", square(126.95, 36.95, 127.45, 37.95)),
                           ("1102", "east", square(127.45, 36.95, 128.05, 37.45))],
                          f"adm_cd string, adm_nm string, rings {ring}").write.parquet(hjd)
    bjd_a, bjd_b = os.path.join(scratch, "bjd_a"), os.path.join(scratch, "bjd_b")
    spark.createDataFrame([("A", "a", square(126.95, 36.95, 127.95, 37.35))],
                          f"EMD_CD string, EMD_NM string, rings {ring}").write.parquet(bjd_a)
    spark.createDataFrame([("B", "b", square(126.95, 37.35, 127.25, 37.95))],
                          f"EMD_CD string, EMD_NM string, rings {ring}").write.parquet(bjd_b)
    out = os.path.join(scratch, "mapping_unified")
    prof = jobs.mapping_job(spark, grid, hjd, [bjd_a, bjd_b], out, reproject=False, tile=0.2).first().asDict()
    m = spark.read.parquet(out)
    assert m.count() == 100 and set(m.columns) == {"grid_idx", "lat", "lon", "HJD_CD", "HJD_NM", "EMD_CD", "EMD_NM"}
    # hjd: west 5 x 10 cells + east 6 x 5 cells; bjd: a 10 x 4, b 3 x 6
    assert prof["mapped_hjd"] == 50 + 25 and prof["mapped_bjd"] == 40 + 18
    cell = m.where("grid_idx = 11").first()      # lat 37.1, lon 127.1
    assert (cell["HJD_CD"], cell["EMD_CD"]) == ("1101", "A")
    # a second call reuses the written mapping
    assert jobs.mapping_job(spark, grid, hjd, [bjd_a, bjd_b], out, reproject=False).first()["cells"] == 100


def test_full_pipeline(spark, scratch):
    """mapping job -> ingest job -> regional job over both region systems."""
    root = os.path.join(scratch, "pipeline")
    rows = [(y, [37.0 + y * 0.1] * 10, [127.0 + x * 0.1 for x in range(10)]) for y in range(10)]
    spark.createDataFrame(rows, "y int, lat array<double>, lon array<double>").write.parquet(f"{root}/grid")
    ring = "array<array<struct<x:double,y:double>>>"
    sq = [[(126.95, 36.95), (127.45, 36.95), (127.45, 37.45), (126.95, 37.45)]]
    spark.createDataFrame([("H1", "h1", sq)], f"adm_cd string, adm_nm string, rings {ring}").write.parquet(f"{root}/hjd")
    spark.createDataFrame([("E1", "e1", sq)], f"EMD_CD string, EMD_NM string, rings {ring}").write.parquet(f"{root}/bjd")
    jobs.mapping_job(spark, f"{root}/grid", f"{root}/hjd", f"{root}/bjd", f"{root}/mapping", reproject=False)
    for h in range(24):   # cell k holds k + hour; -999 in cell 0 at hour 0
        vals = ["-999" if (h == 0 and k == 0) else str(k + h) for k in range(100)]
        _write(f"{root}/landing/ta_20240301{h:02d}00.txt", "10 10\n" + " ".join(vals) + "\n")
    jobs.ingest_job(spark, f"{root}/landing", f"{root}/obs", f"{root}/quarantine", ["ta"], 100)
    jobs.regional_job(spark, f"{root}/obs", f"{root}/mapping", f"{root}/out", ["ta"], region_type="both")
    out = spark.read.parquet(f"{root}/out/interim").collect()
    assert len(out) == 1 and (out[0]["HJD_CD"], out[0]["EMD_CD"]) == ("H1", "E1")
    # mapped cells: rows 0..4 x columns 0..4 -> k = 10*y + x; hour 0 skips the sentinel in cell 0
    cells = [10 * y + x for y in range(5) for x in range(5)]
    assert abs(out[0]["t0001"] - sum(k for k in cells if k != 0) / 24) < 1e-9
    assert abs(out[0]["t0102"] - sum(k + 1 for k in cells) / 25) < 1e-9


def test_mapping_job_one_system(spark, scratch):
    rows = [(y, [37.0 + y * 0.1] * 4, [127.0 + x * 0.1 for x in range(4)]) for y in range(4)]
    spark.createDataFrame(rows, "y int, lat array<double>, lon array<double>").write.parquet(f"{scratch}/g1")
    ring = "array<array<struct<x:double,y:double>>>"
    sq = [[(126.95, 36.95), (127.15, 36.95), (127.15, 37.15), (126.95, 37.15)]]
    spark.createDataFrame([("E1", "e1", sq)], f"EMD_CD string, EMD_NM string, rings {ring}").write.parquet(f"{scratch}/b1")
    prof = jobs.mapping_job(spark, f"{scratch}/g1", None, f"{scratch}/b1", f"{scratch}/m1", reproject=False).first()
    m = spark.read.parquet(f"{scratch}/m1")
    assert m.columns == ["grid_idx", "lat", "lon", "EMD_CD", "EMD_NM"]
    assert (prof["cells"], prof["mapped_bjd"], prof["mapped_hjd"]) == (16, 4, 0)


def test_stream_batch_replay_is_idempotent(spark, scratch):
    from wxgrid.streaming.landing import _process_batch
    root = os.path.join(scratch, "replay")
    rows = [(f"/x/ta_20240105{h:02d}00.txt", "ta", f"20240105{h:02d}00", f"{h} 1 2 3 4 5") for h in range(24)]
    rows.append(("/x/ta_202401060000.txt", "ta", "202401060000", "<html>busy</html>"))
    batch = spark.createDataFrame(rows, "path string, var string, tm string, text string")
    for _ in range(2):   # the same batch id twice, as after a restart
        _process_batch(batch, 7, ["ta"], N, f"{root}/staging", f"{root}/obs", f"{root}/quarantine")
    q = spark.read.parquet(f"{root}/quarantine")
    assert [(r["batch"], r["reason"]) for r in q.collect()] == [(7, "error_response")]
    assert spark.read.parquet(f"{root}/obs").count() == 24 * N


def test_incremental_month(spark, scratch):
    root = os.path.join(scratch, "incr")
    spark.createDataFrame([(0, "A"), (1, "A"), (2, "B")], "grid_idx long, HJD_CD string").write.parquet(f"{root}/map")

    def land(day):
        for h in range(24):
            _write(f"{root}/landing/ta_{day}{h:02d}00.txt", f"{h} 1 2 3 4 5\n")

    def month_dates():
        files = glob.glob(f"{root}/out/monthly_hjd/year=2024/month=01/*.csv")
        rows = [ln.split(",")[0] for f in files for ln in open(f).read().splitlines()[1:]]
        return sorted(set(rows))
    land("20240101")
    jobs.ingest_job(spark, f"{root}/landing", f"{root}/obs", f"{root}/q", ["ta"], N)
    jobs.regional_job(spark, f"{root}/obs", f"{root}/map", f"{root}/out", ["ta"])
    assert month_dates() == ["20240101"]
    land("20240103")
    status = jobs.ingest_job(spark, f"{root}/landing", f"{root}/obs", f"{root}/q", ["ta"], N)
    assert [r["date"] for r in status.collect()] == ["20240103"]     # 20240101 skipped via the manifest
    jobs.regional_job(spark, f"{root}/obs", f"{root}/map", f"{root}/out", ["ta"])
    assert month_dates() == ["20240101", "20240103"]


def test_day_completed_in_a_later_run(spark, scratch):
    root = os.path.join(scratch, "late")
    for h in range(20):
        _write(f"{root}/landing/ta_20240201{h:02d}00.txt", f"{h} 1 2 3 4 5\n")
    s1 = jobs.ingest_job(spark, f"{root}/landing", f"{root}/obs", f"{root}/q", ["ta"], N).collect()
    assert [(r["date"], r["complete"], r["missing_hours"]) for r in s1] == [("20240201", False, "20,21,22,23")]
    assert not glob.glob(f"{root}/obs/**/*.parquet", recursive=True)
    for h in range(20, 24):
        _write(f"{root}/landing/ta_20240201{h:02d}00.txt", f"{h} 1 2 3 4 5\n")
    s2 = jobs.ingest_job(spark, f"{root}/landing", f"{root}/obs", f"{root}/q", ["ta"], N).collect()
    assert [(r["date"], r["complete"]) for r in s2] == [("20240201", True)]
    assert spark.read.parquet(f"{root}/obs").count() == 24 * N


def test_mapping_job_from_axes(spark, scratch):
    axes = os.path.join(scratch, "axes")
    spark.createDataFrame([([37.0, 37.1, 37.2], [127.0, 127.1])], "lat array<double>, lon array<double>").write.parquet(axes)
    ring = "array<array<struct<x:double,y:double>>>"
    sq = [[(126.95, 36.95), (127.05, 36.95), (127.05, 37.25), (126.95, 37.25)]]
    spark.createDataFrame([("H1", "h1", sq)], f"adm_cd string, adm_nm string, rings {ring}").write.parquet(f"{axes}_h")
    prof = jobs.mapping_job(spark, axes, f"{axes}_h", None, f"{axes}_m", reproject=False, grid_kind="axes").first()
    m = {r["grid_idx"]: r["HJD_CD"] for r in spark.read.parquet(f"{axes}_m").collect()}
    assert prof["cells"] == 6 and m == {0: "H1", 1: None, 2: "H1", 3: None, 4: "H1", 5: None}


def test_tables_of_several_runs(spark, scratch):
    """Region types side by side, variables added later, the requested
    calendar, one system of a unified mapping, a half-hour response."""
    root = os.path.join(scratch, "several")
    spark.createDataFrame([(0, "A", "a", "X", "x"), (0, "A", "a", "Y", "y"), (1, "A", "a", "X", "x")],
                          "grid_idx long, HJD_CD string, HJD_NM string, EMD_CD string, EMD_NM string").write.parquet(f"{root}/map")

    def land(var, day):
        for h in range(24):
            _write(f"{root}/landing/{var}_{day}{h:02d}00.txt", "1 4 1 1 1 1\n")
    land("ta", "20240101")
    land("ta", "20240102")
    land("rn_60m", "20240102")
    _write(f"{root}/landing/ta_202401010030.txt", "100 100 100 100 100 100\n")
    jobs.ingest_job(spark, f"{root}/landing", f"{root}/obs", f"{root}/q", ["ta", "rn_60m"], N)
    assert spark.read.parquet(f"{root}/q").where("reason = 'off_schedule_time'").count() == 1

    def run(variables, start, end, kind):
        return jobs.regional_job(spark, f"{root}/obs", f"{root}/map", f"{root}/out", variables, start, end, kind)
    run(["ta"], "20240101", "20240101", "bjd")
    run(["ta"], "20240101", "20240101", "hjd")
    skipped = run(["ta", "rn_60m"], "20231201", "20240229", "hjd")
    assert skipped.count() == 31 + 31 + 29 - 1
    t = spark.read.option("header", True).csv(f"{root}/out/monthly_hjd").select("date", "t0001", "p0001", "HJD_CD")
    assert sorted(tuple(r) for r in t.collect()) == [("20240101", "2.5", None, "A"), ("20240102", "2.5", "2.5", "A")]
    b = spark.read.option("header", True).csv(f"{root}/out/monthly_bjd")
    assert "EMD_CD" in b.columns and "HJD_CD" not in b.columns

    jobs.ingest_job(spark, f"{root}/landing", f"{root}/obs", f"{root}/q", ["ta"], N, force=True)
    assert jobs._cached_days(spark, f"{root}/obs_manifest").count() == 3


def test_mapping_of_a_broken_off_run_is_rebuilt(spark, scratch):
    half = os.path.join(scratch, "half-mapping")
    os.makedirs(os.path.join(half, "_temporary"))
    assert jobs._exists(spark, half) and not jobs._built(spark, half)
