"""DuckDB SQL for the queries of ``plans.stored``: what was written must come
back, so each is the SQL of the rows themselves."""

from __future__ import annotations

from ..operators.stations import DAILY_COLUMNS  # the fixed column names
from . import oracle as O

SQL_CACHE = f"""WITH {O.OBS}
SELECT grid_idx, date, var, hour, round(value, {O.R}) AS value, ord FROM obs"""


def _regional_files_sql() -> str:
    """Rows of complete days (every variable that is in season has a reading),
    once for each of the three outputs."""
    days = f"""days AS ({O._month_days('obs')}),
expected AS (SELECT date, var FROM days, {O._vars_values()} WHERE {O._season_sql()}),
gaps AS (SELECT DISTINCT date FROM (SELECT date, var FROM expected EXCEPT SELECT date, var FROM obs WHERE value IS NOT NULL))"""
    return f"""WITH {O.OBS},
{days}
SELECT kind, r.* FROM ({O.region_day_sql("mean")}) r, (VALUES ('day'), ('month'), ('year')) k(kind)
WHERE r.date NOT IN (SELECT date FROM gaps)"""


def _station_tables_sql() -> str:
    fields = ", ".join(O._FIELDS.get(c, "CAST(-9.0 AS DOUBLE)") + f" AS {c}" for c in DAILY_COLUMNS)
    return f"WITH {O.DAILY}\nSELECT file_year AS year, {fields} FROM daily"


SQL_STATION_ROWS = f"""WITH {O.DAILY}
SELECT file_year AS year, STN AS station, count(*) AS n_rows FROM daily GROUP BY ROLLUP (file_year, STN)"""

SQL_STATION_DIM = f"""WITH {O.STN}
SELECT STN_ID, LAW_ID, LAW_NM FROM stn"""

SQL_LAYERS = f"""WITH {O.POLY_EDGES}
SELECT code, name, CAST(count(DISTINCT ring) AS INTEGER) AS n_rings, CAST(count(*) AS INTEGER) AS n_vertices FROM verts GROUP BY code, name"""

SQL_GRIDS = f"""SELECT CAST(NULL AS BIGINT) AS gid, grid_idx, lat, lon FROM ({O.SQL_ROWS})
UNION ALL SELECT gid, grid_idx, lat, lon FROM ({O.SQL_MESH})"""

SQL_REPORT = f"""WITH {O.DAILY}, {O.KEYS}, {O.DUPS},
r AS (SELECT year, STN, TM, row_number() OVER (PARTITION BY year ORDER BY STN, TM) AS rank, count(*) OVER (PARTITION BY year) AS n FROM dup)
SELECT year, '## Duplicate (STN, TM)' || chr(10) || chr(10) || '| STN | TM |' || chr(10) || '| --- | --- |' || chr(10)
  || string_agg('| ' || STN || ' | ' || strftime(TM, '%Y-%m-%d') || ' |', chr(10) ORDER BY rank) FILTER (WHERE rank <= 100) || chr(10)
  || CASE WHEN any_value(n) > 100 THEN chr(10) || '100 of ' || any_value(n) || ' rows' || chr(10) ELSE '' END AS text
FROM r GROUP BY year"""

SQL_TIMES = f"""WITH {O.OBS}
SELECT var, date || lpad(CAST(hour AS VARCHAR), 2, '0') || '00' AS tm, count(value) AS n_values FROM obs GROUP BY ALL"""

SQL_CALENDAR = f"""WITH {O.ORDERS_DAYS},
ends AS (SELECT date_trunc('month', min(strptime(date, '%Y%m%d'))) AS a, last_day(max(strptime(date, '%Y%m%d'))) AS b FROM od),
days AS (SELECT strftime(unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY)), '%Y%m%d') AS date FROM ends)
SELECT date, count(o_orderkey) AS n_orders FROM days LEFT JOIN od USING (date) GROUP BY date"""


def oracle() -> dict:
    return {
        "observation_cache": SQL_CACHE,
        "mapping_file": O.SQL_UNIFIED,
        "regional_files": _regional_files_sql(),
        "region_day_bucketed": O.region_day_sql("mean"),
        "merge_medians": O.region_day_sql("median"),
        "pivot_in_file_order": O.cell_pivot_sql("ta"),
        "station_tables": _station_tables_sql(),
        "station_rows": SQL_STATION_ROWS,
        "station_dimension": SQL_STATION_DIM,
        "polygon_layers": SQL_LAYERS,
        "grid_files": SQL_GRIDS,
        "quarantine_log": O.SQL_INGEST_QUARANTINE,
        "report_text": SQL_REPORT,
        "request_times": SQL_TIMES,
        "calendar_days": SQL_CALENDAR,
    }
