"""Null rules of the regional table (FIXTURES 2) and a randomised check of
the fused plan against the reference's order restated in pandas."""

import numpy as np
import pandas as pd
import pytest

from wxgrid.catalogue import ordered_slot_columns, specs
from wxgrid.operators import regional

OBS_SCHEMA = "grid_idx long, date string, var string, hour int, value double, ord long"


def _obs(spark, rows):
    return spark.createDataFrame(rows, OBS_SCHEMA)


def _map(spark, rows, cols=("grid_idx", "HJD_CD")):
    schema = ", ".join(f"{c} {'long' if c == 'grid_idx' else 'string'}" for c in cols)
    return spark.createDataFrame(rows, schema)


def _one(df, **keys):
    rows = [r for r in df.collect() if all(r[k] == v for k, v in keys.items())]
    assert len(rows) == 1, rows
    return rows[0]


@pytest.fixture(scope="module")
def case(spark):
    d = "20240105"
    obs = [
        # cell 1 (R0): t0001 null then 5 then 7 -> 5; t0102 = 2
        (1, d, "ta", 0, None, 1), (1, d, "ta", 0, 5.0, 2), (1, d, "ta", 0, 7.0, 3), (1, d, "ta", 1, 2.0, 4),
        # cell 2 (R0): t0001 null, t0102 = 4 -> region mean t0102 = 3, t0001 = 5
        (2, d, "ta", 0, None, 5), (2, d, "ta", 1, 4.0, 6),
        # cell 3 (R1): all null -> contributes nothing
        (3, d, "ta", 0, None, 7),
        # cell 4 (R1 and R9): hour 23 -> t2300; rain only
        (4, d, "ta", 23, 1.5, 8), (4, d, "rn_60m", 5, 0.5, 9),
        # cell 5 (R2): only rain
        (5, d, "rn_60m", 0, 2.0, 10),
        # cell 6 (R3): snow at hour 21 -> s2124; hour 1 is off the grid
        (6, d, "sd_3hr", 21, 3.0, 11), (6, d, "sd_3hr", 1, 9.0, 12),
        # cell 7 (R4): snow only off-grid -> row exists, all snow slots empty
        (7, d, "sd_3hr", 4, 1.0, 13),
        # cell 99: unmapped
        (99, d, "ta", 0, 100.0, 14),
    ]
    mapping = [(1, "R0"), (2, "R0"), (3, "R1"), (4, "R1"), (4, "R9"), (5, "R2"), (6, "R3"), (7, "R4"),
               (99, None)]
    return _obs(spark, obs), _map(spark, mapping)


VARS = ("ta", "rn_60m", "sd_3hr")


def test_mean_rules(case):
    obs, m = case
    out = regional.region_day(obs, m, VARS, "mean")
    assert out.columns == ["date", *ordered_slot_columns(VARS), "HJD_CD"]
    r0 = _one(out, HJD_CD="R0")
    assert r0["t0001"] == 5.0 and r0["t0102"] == 3.0 and r0["t0203"] is None
    r1 = _one(out, HJD_CD="R1")
    assert r1["t2300"] == 1.5 and r1["p0506"] == 0.5
    assert _one(out, HJD_CD="R9")["t2300"] == 1.5
    r3 = _one(out, HJD_CD="R3")
    assert r3["s2124"] == 3.0 and r3["s0003"] is None
    assert {r["HJD_CD"] for r in out.collect()} == {"R0", "R1", "R2", "R3", "R4", "R9"}


def test_sum_rules(case):
    obs, m = case
    out = regional.region_day(obs, m, VARS, "sum", grid_presence=False)
    r0 = _one(out, HJD_CD="R0")
    assert r0["t0001"] == 5.0 and r0["t0102"] == 6.0
    assert r0["t0203"] == 0.0            # region has ta readings, slot empty -> 0
    assert r0["p0001"] is None           # no rain reading in R0 -> empty
    r2 = _one(out, HJD_CD="R2")
    assert r2["t0001"] is None and r2["p0001"] == 2.0 and r2["p0102"] == 0.0
    r4 = _one(out, HJD_CD="R4")        # only an off-grid snow reading
    assert r4["s0003"] == 0.0 and r4["t0001"] is None


def test_median(case):
    obs, m = case
    out = regional.region_day(obs, m, VARS, "median")
    assert _one(out, HJD_CD="R0")["t0102"] == 3.0


def test_repeated_mapping_row_counts_twice(spark):
    d = "20240105"
    obs = _obs(spark, [(1, d, "ta", 0, 1.0, 1), (2, d, "ta", 0, 4.0, 2)])
    m = _map(spark, [(1, "R"), (1, "R"), (2, "R")])
    assert _one(regional.region_day(obs, m, ["ta"], "mean"), HJD_CD="R")["t0001"] == 2.0
    assert _one(regional.region_day(obs, m, ["ta"], "median"), HJD_CD="R")["t0001"] == 1.0
    assert _one(regional.region_day(obs, m, ["ta"], "sum"), HJD_CD="R")["t0001"] == 6.0


def test_region_pair_needs_both_codes(spark):
    d = "20240105"
    obs = _obs(spark, [(1, d, "ta", 0, 1.0, 1), (2, d, "ta", 0, 3.0, 2)])
    m = _map(spark, [(1, "H", "E"), (2, "H", None)], ("grid_idx", "HJD_CD", "EMD_CD"))
    out = regional.region_day(obs, m, ["ta"], "mean")
    assert [(r["HJD_CD"], r["EMD_CD"], r["t0001"]) for r in out.collect()] == [("H", "E", 1.0)]


def test_unknown_method(case):
    with pytest.raises(ValueError):
        regional.region_day(*case, VARS, "max")


def test_season_filter_drops_summer_snow(spark):
    obs = _obs(spark, [(1, "20240715", "sd_3hr", 0, 1.0, 1), (1, "20240115", "sd_3hr", 0, 2.0, 2),
                       (1, "20190115", "sd_3hr", 0, 3.0, 3)])
    out = regional.region_day(obs, _map(spark, [(1, "R")]), ["sd_3hr"], "mean")
    assert [(r["date"], r["s0003"]) for r in out.collect()] == [("20240115", 2.0)]


# -- randomised: fused plan vs the reference's order in pandas -------------

def _reference_pandas(obs: pd.DataFrame, mapping: pd.DataFrame, method: str) -> pd.DataFrame:
    """The reference's daily flow: each day on its own, then concatenated."""
    days = [_reference_day(obs[obs["date"] == d], mapping, method) for d in sorted(obs["date"].unique())]
    return pd.concat([d for d in days if d is not None], ignore_index=True)


def _reference_day(obs: pd.DataFrame, mapping: pd.DataFrame, method: str):
    frames = []
    for s in specs(VARS):
        o = obs[obs["var"] == s.name].sort_values("ord").copy()
        if o.empty:
            continue
        o["col"] = [s.slot_name(h) if h in s.slot_hours() else f"x{h}" for h in o["hour"]]
        piv = o.pivot_table(index=["grid_idx", "date"], columns="col", values="value", aggfunc="first").reset_index()
        cols = [c for c in s.slot_names() if c in piv.columns]
        piv = piv[["grid_idx", "date", *cols]]
        j = piv.merge(mapping, on="grid_idx", how="left")
        j = j[j["HJD_CD"].notna()]
        g = j.groupby(["date", "HJD_CD"])[cols]
        agg = {"mean": g.mean, "sum": g.sum, "median": g.median}[method]().reset_index()
        frames.append(agg)
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.merge(f, on=["date", "HJD_CD"], how="outer")
    return out


@pytest.mark.parametrize("method", ["mean", "sum", "median"])
@pytest.mark.parametrize("seed,n", [(1, 3000), (2, 3000), (3, 300)])
def test_random_against_pandas(spark, method, seed, n):
    rng = np.random.default_rng(seed)
    obs = pd.DataFrame({
        "grid_idx": rng.integers(0, 60, n).astype("int64"),
        "date": rng.choice(["20240101", "20240102"], n),
        "var": rng.choice(list(VARS), n),
        "hour": rng.integers(0, 24, n).astype("int32"),
        "value": np.where(rng.random(n) < 0.2, np.nan, np.round(rng.normal(5, 3, n), 3)),
        "ord": rng.permutation(n).astype("int64"),
    })
    mapping = pd.DataFrame({"grid_idx": np.arange(60, dtype="int64"),
                            "HJD_CD": [None if i % 7 == 0 else f"R{i % 5}" for i in range(60)]})
    mapping = pd.concat([mapping, pd.DataFrame({"grid_idx": [3, 4], "HJD_CD": ["R9", "R1"]})])
    sobs = spark.createDataFrame(obs.astype(object).where(obs.notna(), None), OBS_SCHEMA)
    smap = spark.createDataFrame(mapping.astype(object).where(mapping.notna(), None), "grid_idx long, HJD_CD string")
    presence = regional.hour_presence(sobs, VARS) if method == "sum" else None
    got = regional.region_day(sobs, smap, VARS, method, season_filter=False, presence=presence).toPandas()
    exp = _reference_pandas(obs, mapping, method)
    got = got.sort_values(["date", "HJD_CD"]).reset_index(drop=True)
    exp = exp.sort_values(["date", "HJD_CD"]).reset_index(drop=True)
    assert len(got) == len(exp)
    for c in got.columns:
        if c not in exp.columns:      # slot absent on every day: all NULL here
            assert got[c].isna().all(), c
            continue
        if c in ("date", "HJD_CD"):
            assert list(got[c]) == list(exp[c])
        else:
            np.testing.assert_allclose(got[c].astype(float), exp[c].astype(float), rtol=1e-9, equal_nan=True)


def test_sum_slot_empty_on_whole_grid(spark):
    d = "20240105"
    # t0001 has a reading only in an unmapped cell, t0102 nowhere at all
    obs = _obs(spark, [(1, d, "ta", 0, None, 1), (1, d, "ta", 2, 4.0, 2), (99, d, "ta", 0, 7.0, 3)])
    m = _map(spark, [(1, "R"), (99, None)])
    plain = _one(regional.region_day(obs, m, ["ta"], "sum", grid_presence=False), HJD_CD="R")
    assert _one(regional.region_day(obs, m, ["ta"], "sum"), HJD_CD="R")["t0102"] is None
    pres = _one(regional.region_day(obs, m, ["ta"], "sum", presence=regional.hour_presence(obs, ["ta"])),
                HJD_CD="R")
    assert (plain["t0001"], plain["t0102"], plain["t0203"]) == (0.0, 0.0, 4.0)
    assert (pres["t0001"], pres["t0102"], pres["t0203"]) == (0.0, None, 4.0)


def test_pivot_hourly_to_columns_reference_signature(spark):
    # the reference's smoke shape: cells x 24 hours, one date, value column "ta"
    rows = [(g, "2024-01-01", h, float(10 + g + h)) for g in range(3) for h in range(24)]
    df = spark.createDataFrame(rows, "grid_idx long, date string, hour int, ta double")
    wide = regional.pivot_hourly_to_columns(df, "ta", "t", order_col=None)
    assert wide.columns == ["grid_idx", "date"] + [f"t{h:02d}{(h + 1) % 24:02d}" for h in range(24)]
    r = wide.where("grid_idx = 2").first()
    assert r["t0001"] == 12.0 and r["t2300"] == 35.0
    snow = regional.pivot_hourly_to_columns(df.withColumnRenamed("ta", "sd"), "sd", "s", is_3hourly=True,
                                            order_col=None)
    assert snow.columns[2:] == [f"s{h:02d}{h + 3:02d}" for h in range(0, 24, 3)]
    assert snow.where("grid_idx = 0").first()["s2124"] == 31.0
