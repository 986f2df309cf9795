"""Driver contract: entry() runs, every query has an oracle, and a sample of
queries matches DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "date" and df.columns[-1] == "HJD_CD"
    assert df.count() > 0


def test_every_query_has_oracle():
    from wxgrid.plans import oracle, registry, stored, stored_oracle
    assert set(registry.registry()) == set(oracle.oracle())
    assert set(stored.registry()) == set(stored_oracle.oracle())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["region_day_mean", "region_day_sum", "parse_tokens", "points_in_polygons",
                                  "station_completeness", "year_metrics", "station_churn", "missing_var_days"])
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)
