"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans: the regional queries follow the
reference's order (pivot each cell, aggregate each variable, outer-merge)
rather than the fused plan.  Driver tables are pre-registered as views.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from ..operators.stations import DAILY_COLUMNS  # the fixed column names

ALL_VARS = ("ta", "rn_60m", "sd_3hr")
R = 6  # rounding digits, same as plans.registry.ROUND



@dataclass(frozen=True)
class Slots:
    """One variable's wide columns, spelled out apart from the library's catalogue."""

    name: str
    prefix: str
    hours: tuple
    length: int

    def label(self, hour: int) -> str:
        end = hour + self.length
        return self.prefix + f"{hour:02d}" + ("00" if self.length == 1 and end == 24 else f"{end:02d}")

    def slot_names(self) -> list[str]:
        return [self.label(h) for h in self.hours]


SLOTS = {
    "ta": Slots("ta", "t", tuple(range(24)), 1),
    "rn_60m": Slots("rn_60m", "p", tuple(range(24)), 1),
    "sd_3hr": Slots("sd_3hr", "s", (0, 3, 6, 9, 12, 15, 18, 21), 3),
}


def specs(variables) -> list[Slots]:
    return [SLOTS[v] for v in variables]


# -- adapter CTEs -----------------------------------------------------------

OBS = """obs AS (
  SELECT user_id AS grid_idx, strftime(ts, '%Y%m%d') AS date,
         CASE WHEN event_type IN ('click','view') THEN 'ta'
              WHEN event_type IN ('purchase','signup') THEN 'rn_60m' ELSE 'sd_3hr' END AS var,
         CAST(CASE WHEN event_type = 'error' THEN hour(ts) - hour(ts) % 3 ELSE hour(ts) END AS INTEGER) AS hour,
         event_id AS ord,
         CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL ELSE value END AS value
  FROM events)"""

MAP = """map AS (
  SELECT c_custkey AS grid_idx,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS HJD_CD,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS EMD_CD
  FROM customer)"""

DAILY = """daily AS (
  SELECT CASE WHEN (c_nationkey + year(o_orderdate)) % 5 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS STN, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS TM,
         CAST(year(o_orderdate) + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS INTEGER) AS file_year,
         o_orderkey AS ord, o_totalprice AS RN_DAY
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

STN = """stn AS (
  SELECT n_nationkey AS STN_ID, lpad(CAST(n_regionkey AS VARCHAR), 10, '0') AS LAW_ID, n_name AS LAW_NM
  FROM nation)"""


def _slot_sql(s: Slots) -> str:
    return "CASE hour " + " ".join(f"WHEN {h} THEN '{s.label(h)}'" for h in s.hours) + " END"


def _season_sql() -> str:
    return ("NOT (var = 'sd_3hr' AND (CAST(substr(date, 1, 4) AS INTEGER) < 2020 "
            "OR CAST(substr(date, 5, 2) AS INTEGER) IN (6, 7, 8, 9)))")


def _cell_pivot_cte(s, name: str, season: bool = True) -> str:
    """Per-cell pivot of one variable, first non-null per slot."""
    cols = ",\n    ".join(
        f"arg_min(value, ord) FILTER (WHERE slot = '{n}') AS {n}" for n in s.slot_names())
    season_sql = f" AND {_season_sql()}" if season else ""
    return f"""{name} AS (
  SELECT grid_idx, date,
    {cols}
  FROM (SELECT *, {_slot_sql(s)} AS slot FROM obs
        WHERE var = '{s.name}' AND value IS NOT NULL{season_sql})
  GROUP BY grid_idx, date)"""


def _agg_expr(method: str, col: str) -> str:
    if method == "mean":
        return f"avg({col}) AS {col}"
    if method == "sum":
        return f"coalesce(sum({col}), 0.0) AS {col}"
    return f"median({col}) AS {col}"


def _region_ctes(method: str, ids, variables, map_name: str) -> tuple[list[str], str, list[str]]:
    """CTEs piv_<var>, agg_<var>; the outer-merge FROM clause; slot order."""
    ss = specs(variables)
    ctes = []
    id_ok = " AND ".join(f"m.{c} IS NOT NULL" for c in ids)
    mid = ", ".join("m." + c for c in ids)
    for s in ss:
        ctes.append(_cell_pivot_cte(s, f"piv_{s.name}"))
        if method == "sum":
            # The per-day pivot drops a slot column that is empty for every
            # cell; after concatenation such a slot is NULL, not 0.
            pres = ", ".join(f"count({n}) > 0 AS {n}_p" for n in s.slot_names())
            ctes.append(f"pres_{s.name} AS (SELECT date, {pres} FROM piv_{s.name} GROUP BY date)")
            aggs = ",\n    ".join(f"CASE WHEN bool_or(pr.{n}_p) THEN coalesce(sum(p.{n}), 0.0) END AS {n}"
                                     for n in s.slot_names())
            join_pres = f" JOIN pres_{s.name} pr ON p.date = pr.date"
        else:
            aggs = ",\n    ".join(_agg_expr(method, n) for n in s.slot_names())
            join_pres = ""
        ctes.append(f"""agg_{s.name} AS (
  SELECT p.date, {mid},
    {aggs}
  FROM piv_{s.name} p JOIN {map_name} m ON p.grid_idx = m.grid_idx{join_pres}
  WHERE {id_ok}
  GROUP BY p.date, {mid})""")
    frm = f"agg_{ss[0].name}"
    for s in ss[1:]:
        frm += f" FULL OUTER JOIN agg_{s.name} USING (date, {', '.join(ids)})"
    slots = []
    for p in ("t", "p", "s"):
        slots += sorted(n for s in ss for n in s.slot_names() if n.startswith(p))
    return ctes, frm, slots


def region_day_sql(method: str, ids=("HJD_CD",), variables=ALL_VARS) -> str:
    ctes, frm, slots = _region_ctes(method, ids, variables, "map")
    cols = ["date"] + [f"round({n}, {R}) AS {n}" for n in slots] + list(ids)
    return "WITH " + ",\n".join([OBS, MAP] + ctes) + f"\nSELECT {', '.join(cols)}\nFROM {frm}"


def cell_pivot_sql(var: str) -> str:
    s = specs([var])[0]
    cols = ", ".join(f"round({n}, {R}) AS {n}" for n in s.slot_names())
    return "WITH " + OBS + ",\n" + _cell_pivot_cte(s, "piv", season=False) + \
        f"\nSELECT grid_idx, date, {cols} FROM piv"


def region_names_sql() -> str:
    named = """named AS (
  SELECT c_custkey AS grid_idx,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS HJD_CD,
         CASE WHEN c_custkey % 50 = 0 THEN lower(n_name) ELSE n_name END AS HJD_NM
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""
    ctes, frm, slots = _region_ctes("mean", ("HJD_CD",), ("ta",), "named")
    cols = ", ".join(f"round(d.{c}, {R}) AS {c}" for c in slots)
    names = "names AS (SELECT DISTINCT HJD_CD, HJD_NM FROM named)"
    return ("WITH " + ",\n".join([OBS, named] + ctes + [names]) +
            f"\nSELECT d.HJD_CD, d.date, {cols}, n.HJD_NM"
            f"\nFROM {frm} d LEFT JOIN names n ON d.HJD_CD = n.HJD_CD")



# -- gates -------------------------------------------------------------------

ORDERS_DAYS = """od AS (
  SELECT o_orderkey, o_orderstatus,
         strftime(o_orderdate + INTERVAL 27 YEAR, '%Y%m%d') AS date,
         CASE o_orderkey % 3 WHEN 0 THEN 'ta' WHEN 1 THEN 'rn_60m' ELSE 'sd_3hr' END AS var
  FROM orders)"""


def _month_days(src: str) -> str:
    return f"""SELECT DISTINCT strftime(d, '%Y%m%d') AS date FROM (
      SELECT unnest(generate_series(m, last_day(m), INTERVAL 1 DAY)) AS d FROM (
        SELECT DISTINCT strptime(substr(date, 1, 6) || '01', '%Y%m%d')::DATE AS m FROM {src}))"""


def _vars_values() -> str:
    return "(VALUES ('ta'), ('rn_60m'), ('sd_3hr')) v(var)"


SQL_SEASON = f"""WITH {ORDERS_DAYS}
SELECT o_orderkey, date, var FROM od WHERE {_season_sql()}"""

SQL_SENTINEL = f"""SELECT l_orderkey, l_linenumber,
  round(CASE WHEN x < -900 OR x > 2000 OR isnan(x) THEN NULL ELSE x END, {R}) AS value
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice / 20.0 - 1000.0 AS x FROM lineitem)"""

SQL_HOURS = f"""WITH {OBS},
hs AS (SELECT date, var, list(DISTINCT hour) AS hrs FROM obs GROUP BY date, var),
ex AS (SELECT date, var, hrs,
         CASE WHEN var = 'sd_3hr' THEN range(0, 24, 3) ELSE range(0, 24) END AS exp FROM hs)
SELECT date, var,
  CAST(len(list_filter(exp, lambda h: list_contains(hrs, h))) AS BIGINT) AS hours_present,
  array_to_string(list_filter(exp, lambda h: NOT list_contains(hrs, h)), ',') AS missing_hours,
  len(list_filter(exp, lambda h: NOT list_contains(hrs, h))) = 0 AS complete
FROM ex"""

SQL_MISSING_VAR_DAYS = f"""WITH {OBS},
days AS ({_month_days('obs')}),
exp AS (SELECT date, var FROM days, {_vars_values()} WHERE {_season_sql()})
SELECT date, var FROM exp EXCEPT SELECT DISTINCT date, var FROM obs"""

SQL_COMPLETE_DAYS = f"""WITH {OBS},
days AS ({_month_days('obs')}),
exp AS (SELECT date, var FROM days, {_vars_values()}),
bad AS (SELECT DISTINCT date FROM (SELECT date, var FROM exp EXCEPT SELECT date, var FROM obs))
SELECT date, var, count(*) AS n_obs FROM obs
WHERE date NOT IN (SELECT date FROM bad)
GROUP BY date, var"""

SQL_TODO = f"""WITH {ORDERS_DAYS}
SELECT date FROM ({_month_days('od')})
WHERE date NOT IN (SELECT date FROM od WHERE o_orderstatus = 'F')"""

# -- raw responses -----------------------------------------------------------

_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


SQL_ERRORS = f"""WITH t AS (
  SELECT 'pages' AS src, page_id AS id, html AS text FROM pages
  UNION ALL SELECT 'documents', doc_id, text FROM documents),
h AS (SELECT src, id, text, {_strip_sql('text')} AS s FROM t)
SELECT src, id,
  CASE WHEN text IS NULL OR length(s) = 0 THEN TRUE
       ELSE (contains(lower(substr(s, 1, 400)), '<html') OR contains(lower(substr(s, 1, 400)), '<!doctype html')
             OR contains(lower(substr(s, 1, 400)), 'forbidden') OR contains(lower(substr(s, 1, 400)), 'unauthorized')
             OR (contains(lower(substr(s, 1, 400)), 'error') AND NOT contains(lower(substr(s, 1, 400)), '#')))
  END AS is_error
FROM h"""

SQL_PARSE_TOKENS = f"""SELECT l_orderkey AS resp_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) - 1 AS BIGINT) AS grid_idx,
  round(CASE WHEN l_quantity < -900 OR l_quantity > 2000 THEN NULL ELSE l_quantity END, {R}) AS value
FROM lineitem"""

_LB = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"

SQL_PREVIEW = f"""WITH p AS (
  SELECT page_id, html,
    CASE WHEN length(html) = 0 THEN []::VARCHAR[]
         WHEN regexp_matches(html, '(?:{_LB})$') THEN list_slice(string_split_regex(html, '{_LB}'), 1, -2)
         ELSE string_split_regex(html, '{_LB}') END AS lines
  FROM pages)
SELECT page_id, CAST(length(html) AS BIGINT) AS total_chars, CAST(len(lines) AS BIGINT) AS total_lines,
  substr(replace(html, chr(10), ' '), 1, 500) AS preview,
  array_to_string(list_slice(lines, 1, 30), chr(10)) AS head,
  CASE WHEN len(lines) > 30 THEN array_to_string(list_slice(lines, len(lines) - 29, len(lines)), chr(10)) ELSE '' END AS tail
FROM p"""

#: Responses of LANDED with the reason that each fault must get.
LANDED = """li AS (
  SELECT l_orderkey AS k, l_quantity AS q, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem
  WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity)),
ord AS (SELECT k, any_value(n) AS n, string_agg(CAST(q AS VARCHAR), ', ' ORDER BY i) AS vals FROM li GROUP BY k),
f AS (SELECT *, k // 26 AS day, k % 26 AS h, CASE WHEN (k // 26) % 3 <> 0 THEN k % 29 ELSE -1 END AS fault FROM ord),
land AS (SELECT *, CASE WHEN day % 2 = 0 THEN 'ta' ELSE 'rn_60m' END AS var, strftime(DATE '2024-01-01' + CAST(day AS INTEGER), '%Y%m%d') AS date,
  '# c' || chr(10) || n || ' 1' || chr(10) || vals AS plain,
  CASE WHEN fault IN (0, 1) THEN 'error_response' WHEN fault = 2 THEN 'empty' WHEN fault = 3 THEN 'too_few_values' WHEN fault = 4 THEN 'count_mismatch'
       WHEN fault = 5 THEN 'non_finite_header' WHEN fault = 6 OR h > 23 THEN 'off_schedule_time' END AS reason FROM f),
st AS (SELECT date, var, list(DISTINCT h) FILTER (WHERE reason IS NULL) AS ok FROM land GROUP BY date, var),
mi AS (SELECT date, var, coalesce(list_sort(ok), []) AS ok, list_filter(range(0, 24), lambda x: NOT list_contains(coalesce(ok, []), x)) AS miss FROM st)"""

SQL_INGEST_PUBLISHED = f"""WITH {LANDED}
SELECT li.i AS grid_idx, l.date, l.var, CAST(l.h AS INTEGER) AS hour, round(CAST(li.q AS DOUBLE), {R}) AS value
FROM land l JOIN mi ON mi.date = l.date AND mi.var = l.var AND len(miss) = 0 JOIN li ON li.k = l.k WHERE l.reason IS NULL"""

SQL_INGEST_STATUS = f"""WITH {LANDED}
SELECT date, var, len(miss) = 0 AS complete, array_to_string(miss, ',') AS missing_hours, array_to_string(ok, ',') AS value_hours FROM mi"""

SQL_INGEST_QUARANTINE = f"""WITH {LANDED},
t AS (SELECT *, CASE fault WHEN 0 THEN '<html>' || plain WHEN 1 THEN ' ' || chr(10) WHEN 2 THEN '# c' || chr(10) WHEN 4 THEN plain || ', 7'
                 WHEN 5 THEN 'nan ' || vals || ', 8' ELSE plain END AS text FROM land WHERE reason IS NOT NULL)
SELECT date || lpad(CAST(h AS VARCHAR), 2, '0') || CASE WHEN fault = 6 THEN '30' ELSE '00' END AS tm, var, date, CAST(h AS INTEGER) AS hour, 'ERROR' AS level, reason,
  substr(replace(text, chr(10), ' '), 1, 500) AS preview, rtrim(text, chr(10)) AS head, '' AS tail, length(text) AS total_chars,
  len(string_split(rtrim(text, chr(10)), chr(10))) AS total_lines
FROM t
UNION ALL
SELECT date || '----', var, date, NULL, 'ERROR', 'missing_hours=' || array_to_string(miss, ','), NULL, NULL, NULL, NULL, NULL FROM mi WHERE len(miss) > 0"""

# -- mapping / geometry ------------------------------------------------------

MAP_SIDES = """hjd AS (
  SELECT CASE WHEN c_custkey % 3 = 0 THEN -c_custkey - 1 ELSE c_custkey END AS grid_idx, 33.0::DOUBLE + (c_custkey % 100) * 0.05::DOUBLE AS lat,
         124.0::DOUBLE + (c_custkey % 77) * 0.05::DOUBLE AS lon,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS HJD_CD,
         c_name AS HJD_NM
  FROM customer),
bjd AS (
  SELECT CASE WHEN c_custkey % 4 = 0 THEN c_custkey + 1000000000 ELSE c_custkey END AS grid_idx, c_mktsegment AS EMD_CD, lower(c_mktsegment) AS EMD_NM
  FROM customer),
uni AS (
  SELECT coalesce(h.grid_idx, b.grid_idx) AS grid_idx, h.lat, h.lon, h.HJD_CD, h.HJD_NM, b.EMD_CD, b.EMD_NM
  FROM hjd h FULL OUTER JOIN bjd b ON h.grid_idx = b.grid_idx)"""

SQL_UNIFIED = f"""WITH {MAP_SIDES}
SELECT grid_idx, round(lat, {R}) AS lat, round(lon, {R}) AS lon, HJD_CD, HJD_NM, EMD_CD, EMD_NM FROM uni"""

SQL_PROFILE = f"""WITH {MAP_SIDES}
SELECT count(*) AS cells,
  count(*) FILTER (WHERE HJD_CD IS NOT NULL) AS mapped_hjd,
  count(*) FILTER (WHERE EMD_CD IS NOT NULL) AS mapped_bjd,
  count(*) FILTER (WHERE HJD_CD IS NOT NULL AND EMD_CD IS NOT NULL) AS mapped_both,
  count(*) FILTER (WHERE HJD_CD IS NOT NULL AND EMD_CD IS NULL) AS hjd_only,
  count(*) FILTER (WHERE HJD_CD IS NULL AND EMD_CD IS NOT NULL) AS bjd_only,
  count(*) FILTER (WHERE HJD_CD IS NULL AND EMD_CD IS NULL) AS unmapped
FROM uni"""

SQL_DENSITY = f"""WITH {MAP}
SELECT HJD_CD, count(*) AS cells FROM map WHERE HJD_CD IS NOT NULL GROUP BY HJD_CD"""

SQL_REGION_COUNT = f"""WITH {MAP}
SELECT count(DISTINCT HJD_CD) AS n_HJD_CD, count(DISTINCT EMD_CD) AS n_EMD_CD FROM map"""

SQL_MESH = f"""SELECT s_suppkey AS gid, CAST(i * 2 + j AS BIGINT) AS grid_idx,
  round(33.0::DOUBLE + s_suppkey * 0.001::DOUBLE + i * 0.25::DOUBLE, {R}) AS lat,
  round(124.0::DOUBLE + s_nationkey * 0.1::DOUBLE + j * 0.5::DOUBLE, {R}) AS lon
FROM supplier, range(0, 3) a(i), range(0, 2) b(j)"""

SQL_ROWS = f"""SELECT CAST((s_suppkey - 1) * 4 + x AS BIGINT) AS grid_idx,
  round(33.0::DOUBLE + s_suppkey * 0.001::DOUBLE + x * 0.0001::DOUBLE, {R}) AS lat,
  round(124.0::DOUBLE + x * 0.1::DOUBLE + s_nationkey * 0.01::DOUBLE, {R}) AS lon
FROM supplier, range(0, 4) r(x)"""

POLY_EDGES = """verts AS (
  SELECT 'T0' AS code, 'triangle' AS name, 0 AS ring, v.* FROM (VALUES
    (0, -0.2, -0.2), (1, 0.1, -0.1), (2, 0.0, 0.2)) v(k, x, y)
  UNION ALL SELECT 'SQ', 'square', 0, v.* FROM (VALUES
    (0, -0.3, -0.3), (1, 0.0, -0.3), (2, 0.0, 0.0), (3, -0.3, 0.0)) v(k, x, y)
  UNION ALL SELECT 'SQ', 'square', 1, v.* FROM (VALUES
    (0, -0.2, -0.2), (1, -0.1, -0.2), (2, -0.1, -0.1), (3, -0.2, -0.1)) v(k, x, y)
  UNION ALL SELECT r_name, lower(r_name), 0, 0, r_regionkey * 0.1 - 0.25 - 0.1, -0.1 FROM region
  UNION ALL SELECT r_name, lower(r_name), 0, 1, r_regionkey * 0.1 - 0.25 + 0.1, -0.1 FROM region
  UNION ALL SELECT r_name, lower(r_name), 0, 2, r_regionkey * 0.1 - 0.25, 0.15 FROM region
  UNION ALL SELECT c, m, 0, i, -0.4::DOUBLE + 0.8::DOUBLE * i / n, CASE WHEN i % 2 = 0 THEN 0.11 ELSE 0.19 END
    FROM (SELECT max(s_suppkey) * 5 AS n, unnest(range(0, max(s_suppkey) * 5 + 1)) AS i FROM supplier), (VALUES ('SAW', 'saw'), ('HOL', 'holed saw')) x(c, m)
  UNION ALL SELECT c, m, 0, 1000000000 + k, px, -0.35 FROM (VALUES ('SAW', 'saw'), ('HOL', 'holed saw')) x(c, m), (VALUES (0, 0.4), (1, -0.4)) v(k, px)
  UNION ALL SELECT 'HOL', 'holed saw', 1, v.* FROM (VALUES
    (0, -0.38, -0.01), (1, 0.38, -0.01), (2, 0.38, 0.0123), (3, -0.38, 0.0123)) v(k, x, y)),
edges AS (
  SELECT code, name, x AS x1, y AS y1,
    coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2,
    coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
  FROM verts WINDOW w AS (PARTITION BY code, name, ring ORDER BY k
                          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""

SQL_PIP = f"""WITH pts AS (SELECT vec_id AS pid, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
{POLY_EDGES},
tests AS (
  SELECT p.pid, e.code, e.name,
    sum(CASE WHEN ((e.y1 > p.y) <> (e.y2 > p.y)) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
             THEN 1 ELSE 0 END) AS crossings,
    bool_or((e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1) = 0
            AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
            AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)) AS on_edge
  FROM pts p CROSS JOIN edges e GROUP BY p.pid, e.code, e.name),
hits AS (SELECT pid, code, name FROM tests WHERE crossings % 2 = 1 AND NOT on_edge)
SELECT p.pid, round(p.x, {R}) AS x, round(p.y, {R}) AS y, h.code, h.name
FROM pts p LEFT JOIN hits h ON p.pid = h.pid"""


# ---------------------------------------------------------------------------
# Inverse transverse Mercator to the fourth order of the third
# flattening n, as published: (numerator, denominator) of n, n^2, n^3, n^4.
# ---------------------------------------------------------------------------
RECTIFYING_TO_CONFORMAL = [
    [(1, 2), (-2, 3), (37, 96), (-1, 360)],
    [(0, 1), (1, 48), (1, 15), (-437, 1440)],
    [(0, 1), (0, 1), (17, 480), (-37, 840)],
    [(0, 1), (0, 1), (0, 1), (4397, 161280)],
]
CONFORMAL_TO_GEODETIC = [
    [(2, 1), (-2, 3), (-2, 1), (116, 45)],
    [(0, 1), (7, 3), (-8, 5), (-227, 45)],
    [(0, 1), (0, 1), (56, 15), (-136, 35)],
    [(0, 1), (0, 1), (0, 1), (4279, 630)],
]


def _reproject_sql() -> str:
    """EPSG:5179 to degrees, written from the published series; the arc from
    the equator to latitude 38 is integrated numerically instead of expanded."""
    a, f = 6378137.0, 1 / 298.257222101
    n, e2, lat0 = f / (2 - f), f * (2 - f), math.radians(38.0)
    radius = a / (1 + n) * (1 + n * n / 4 + n ** 4 / 64)
    steps = 2000   # Simpson's rule, exact to rounding at this step
    curve = [a * (1 - e2) / (1 - e2 * math.sin(lat0 * i / steps) ** 2) ** 1.5 for i in range(steps + 1)]
    arc = (curve[0] + curve[-1] + 4 * sum(curve[1:-1:2]) + 2 * sum(curve[2:-1:2])) * lat0 / steps / 3

    def total(head: str, rows, term: str, sign: str) -> str:
        sums = [sum(p / q * n ** k for k, (p, q) in enumerate(row, 1)) for row in rows]
        return head + "".join(f" {sign} ({c!r}::DOUBLE) * {term.format(m=2 * j)}" for j, c in enumerate(sums, 1))

    xi = total("xi", RECTIFYING_TO_CONFORMAL, "sin({m} * xi) * cosh({m} * eta)", "-")
    eta = total("eta", RECTIFYING_TO_CONFORMAL, "cos({m} * xi) * sinh({m} * eta)", "-")
    lat = total("chi", CONFORMAL_TO_GEODETIC, "sin({m} * chi)", "+")
    return f"""WITH p AS (SELECT vec_id AS pid, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
a AS (SELECT pid, (y * 1e6 / 0.9996::DOUBLE + {arc!r}::DOUBLE) / {radius!r}::DOUBLE AS xi, x * 1e6 / {0.9996 * radius!r}::DOUBLE AS eta FROM p),
b AS (SELECT pid, {xi} AS xip, {eta} AS etap FROM a),
c AS (SELECT pid, xip, etap, asin(sin(xip) / cosh(etap)) AS chi FROM b)
SELECT pid, round(127.5::DOUBLE + degrees(atan2(sinh(etap), cos(xip))), {R}) AS lon, round(degrees({lat}), {R}) AS lat FROM c"""


# -- stations ----------------------------------------------------------------

_STN_FILE = "printf('weather_data_stn%d_%d0101_%d1231.txt', STN, file_year, file_year) AS path"
_FIELDS = {"TM": "TM", "STN": "STN", "TA_AVG": "CAST((ord % 40) - 10 AS DOUBLE)", "RN_DAY": f"round(RN_DAY, {R})"}

SQL_STATION_PARSE = f"""WITH {DAILY}
SELECT {_STN_FILE}, {", ".join(_FIELDS.get(c, "CAST(-9.0 AS DOUBLE)") + f" AS {c}" for c in DAILY_COLUMNS)} FROM daily"""

# a note gives a row of NULL fields
SQL_STATION_PARSE_PARITY = SQL_STATION_PARSE + f"""
UNION ALL
SELECT {_STN_FILE}, {", ".join(f"NULL AS {c}" for c in DAILY_COLUMNS)} FROM daily WHERE ord % 50 = 0"""


def _station_widths_sql() -> str:
    """Every field by name: four from the data, the others -9; a price has two digits in its line."""
    value = {"TM": "TM", "STN": "STN", "TA_AVG": "CASE WHEN k % 2 = 1 THEN CAST((ord % 40) - 10 AS DOUBLE) END",
             "RN_DAY": "CASE WHEN k % 3 = 1 THEN round(RN_DAY, 2) END"}
    names = [value.get(c, "CAST(-9.0 AS DOUBLE)") + f" AS {c}" for c in DAILY_COLUMNS]
    return f"""WITH {DAILY},
numbered AS (SELECT *, row_number() OVER (PARTITION BY STN, file_year ORDER BY ord) AS k FROM daily)
SELECT printf('weather_data_stn%d_%d0101_%d1231.txt', STN, file_year, file_year) AS path, {", ".join(names)}
FROM numbered"""


SQL_LAW_ID = f"""WITH {DAILY},
dim AS (
  SELECT n_nationkey AS STN_ID, lpad(CAST(n_regionkey AS VARCHAR), 10, '0') AS LAW_ID, n_nationkey * 2 AS ord
  FROM nation
  UNION ALL
  SELECT n_nationkey, lpad(CAST(n_regionkey + 5 AS VARCHAR), 10, '0'), n_nationkey * 2 + 1
  FROM nation WHERE n_nationkey % 4 = 1),
last AS (SELECT STN_ID, arg_max(LAW_ID, ord) AS LAW_ID FROM dim GROUP BY STN_ID)
SELECT d.STN, d.TM, d.file_year, d.ord, l.LAW_ID FROM daily d LEFT JOIN last l ON d.STN = l.STN_ID"""

KEYS = """k AS (
  SELECT file_year AS year, CASE WHEN ord % 89 <> 0 THEN STN END AS stn, ord,
         CASE WHEN ord % 83 <> 0 AND ord % 79 <> 0 THEN try_strptime(CAST(TM AS VARCHAR), '%Y%m%d')::DATE END AS tm
  FROM daily)"""

PER_STATION = """pres AS (SELECT DISTINCT year, stn, tm FROM k WHERE stn IS NOT NULL AND tm IS NOT NULL),
cnt AS (SELECT year, stn, count(*) AS days_present FROM pres GROUP BY year, stn),
cal AS (SELECT c.year, c.stn, unnest(generate_series(make_date(c.year, 1, 1), make_date(c.year, 12, 31), INTERVAL 1 DAY))::DATE AS tm
        FROM cnt c),
miss AS (SELECT year, stn, tm FROM cal EXCEPT SELECT year, stn, tm FROM pres),
ms AS (SELECT year, stn, count(*) AS n, list(strftime(tm, '%Y-%m-%d') ORDER BY tm) AS l FROM miss GROUP BY year, stn),
ps AS (
  SELECT c.year, c.stn AS STN, c.days_present,
    CAST(datediff('day', make_date(c.year, 1, 1), make_date(c.year + 1, 1, 1)) AS BIGINT) AS days_expected,
    CAST(datediff('day', make_date(c.year, 1, 1), make_date(c.year + 1, 1, 1)) - c.days_present AS BIGINT) AS days_missing,
    CASE WHEN ms.n IS NULL THEN ''
         ELSE array_to_string(list_slice(ms.l, 1, 10), ', ') || CASE WHEN ms.n > 10 THEN ' ...' ELSE '' END END AS missing_sample
  FROM cnt c LEFT JOIN ms ON c.year = ms.year AND c.stn = ms.stn),
psi AS (SELECT ps.*, stn.LAW_ID, stn.LAW_NM FROM ps LEFT JOIN stn ON ps.STN = stn.STN_ID)"""

SQL_COMPLETENESS = f"""WITH {DAILY}, {STN}, {KEYS}, {PER_STATION}
SELECT * FROM psi"""

DUPS = """dup AS (SELECT year, stn AS STN, tm AS TM FROM k WHERE stn IS NOT NULL AND tm IS NOT NULL
                GROUP BY year, stn, tm HAVING count(*) > 1)"""

SQL_DUPS = f"""WITH {DAILY}, {KEYS}, {DUPS}
SELECT year, STN, strftime(TM, '%Y-%m-%d') AS TM FROM dup"""

SQL_OOR = f"""WITH {DAILY}, {KEYS}
SELECT year, stn AS STN, strftime(tm, '%Y-%m-%d') AS TM FROM k
WHERE tm IS NOT NULL AND (tm < make_date(year, 1, 1) OR tm > make_date(year, 12, 31))"""

SQL_YEAR_METRICS = f"""WITH {DAILY}, {STN}, {KEYS}, {PER_STATION}, {DUPS},
yrs AS (SELECT DISTINCT year FROM k),
st AS (SELECT year, count(DISTINCT STN) AS station_count,
              count(*) FILTER (WHERE days_missing = 0) AS full_coverage_station_count,
              count(*) FILTER (WHERE days_missing > 0) AS any_missing_station_count FROM psi GROUP BY year),
dc AS (SELECT year, count(*) AS duplicate_records FROM dup GROUP BY year),
oc AS (SELECT year, count(*) AS out_of_range_records FROM k
       WHERE tm IS NOT NULL AND (tm < make_date(year, 1, 1) OR tm > make_date(year, 12, 31)) GROUP BY year)
SELECT y.year, coalesce(station_count, 0) AS station_count,
  coalesce(full_coverage_station_count, 0) AS full_coverage_station_count,
  coalesce(any_missing_station_count, 0) AS any_missing_station_count,
  coalesce(duplicate_records, 0) AS duplicate_records, coalesce(out_of_range_records, 0) AS out_of_range_records
FROM yrs y LEFT JOIN st USING (year) LEFT JOIN dc USING (year) LEFT JOIN oc USING (year)"""

SQL_CHURN = f"""WITH {DAILY}, {STN}, {KEYS},
s AS (SELECT DISTINCT year, stn FROM k WHERE stn IS NOT NULL AND tm IS NOT NULL),
y AS (SELECT year, lag(year) OVER (ORDER BY year) AS prev FROM (SELECT DISTINCT year FROM k WHERE year IS NOT NULL)),
ch AS (
  SELECT y.year, s.stn, 'added' AS change FROM y JOIN s ON s.year = y.year
  WHERE NOT EXISTS (SELECT 1 FROM s p WHERE p.year = y.prev AND p.stn = s.stn)
  UNION ALL
  SELECT y.year, p.stn, 'removed' FROM y JOIN s p ON p.year = y.prev
  WHERE NOT EXISTS (SELECT 1 FROM s c WHERE c.year = y.year AND c.stn = p.stn))
SELECT ch.stn AS STN, ch.year, ch.change, stn.LAW_ID, stn.LAW_NM FROM ch LEFT JOIN stn ON ch.stn = stn.STN_ID"""

SQL_TOP = f"""WITH {DAILY}, {KEYS}, {DUPS}
SELECT year, STN, strftime(TM, '%Y-%m-%d') AS TM, rank, rank <= 100 AS shown
FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY STN, TM) AS rank FROM dup)"""


# -- summaries and report tables ----------------------------------------------

SQL_FAILURES = f"""WITH {OBS},
hs AS (SELECT date, var, list(DISTINCT hour) AS hrs FROM obs GROUP BY date, var),
st AS (SELECT date, var,
         len(list_filter(CASE WHEN var = 'sd_3hr' THEN range(0, 24, 3) ELSE range(0, 24) END,
                         lambda h: NOT list_contains(hrs, h))) = 0 AS complete FROM hs)
SELECT date,
  coalesce(array_to_string(list_sort(list(var) FILTER (WHERE complete)), ','), '') AS ok,
  coalesce(array_to_string(list_sort(list(var) FILTER (WHERE NOT complete)), ','), '') AS failed
FROM st GROUP BY date"""

SQL_SKIPS = f"""WITH {ORDERS_DAYS},
days AS ({_month_days('od')}),
exp AS (SELECT date, var FROM days, {_vars_values()}),
miss AS (SELECT date, var FROM exp EXCEPT SELECT date, var FROM od),
per AS (SELECT date, array_to_string(list_sort(list(var)), ',') AS missing_vars FROM miss GROUP BY date)
SELECT date, missing_vars, count(*) OVER () AS total_skipped, row_number() OVER (ORDER BY date) AS rank,
  row_number() OVER (ORDER BY date) <= 30 AS shown FROM per"""

SQL_PER_STATION_REPORT = f"""WITH {DAILY}, {STN}, {KEYS}, {PER_STATION}
SELECT year, STN, coalesce(LAW_ID, '') AS LAW_ID, coalesce(LAW_NM, '') AS LAW_NM,
  days_present, days_expected, days_missing, missing_sample, rank, rank <= 2000 AS shown
FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY days_missing, STN) AS rank FROM psi)"""

SQL_FILE_YEARS = f"""WITH {DAILY}
SELECT DISTINCT printf('weather_data_stn%d_%d.csv', STN, file_year) AS name, file_year AS year FROM daily"""

SQL_FORMATTED_DATES = """WITH {obs}, {map}, {ctes}
SELECT strftime(strptime(date, '%Y%m%d'), '%Y-%m-%d') AS date, HJD_CD, {cols} FROM agg_ta"""


def _formatted_dates_sql() -> str:
    ctes, _, slots = _region_ctes("mean", ("HJD_CD",), ("ta",), "map")
    cols = ", ".join(f"round({c}, {R}) AS {c}" for c in slots)
    return SQL_FORMATTED_DATES.format(obs=OBS, map=MAP, ctes=",\n".join(ctes), cols=cols)


SQL_SPRING = f"""WITH {ORDERS_DAYS},
yrs AS (SELECT DISTINCT CAST(substr(date, 1, 4) AS INTEGER) AS y FROM od)
SELECT strftime(d, '%Y%m%d') AS date FROM (
  SELECT unnest(generate_series(make_date(y, 3, 1), last_day(make_date(y, 5, 1)), INTERVAL 1 DAY)) AS d FROM yrs)"""


def oracle() -> dict:
    return {
        "region_day_mean": region_day_sql("mean"),
        "region_day_sum": region_day_sql("sum"),
        "region_day_median": region_day_sql("median"),
        "region_pair_mean": region_day_sql("mean", ("HJD_CD", "EMD_CD")),
        "cell_hour_pivot": cell_pivot_sql("ta"),
        "cell_3hour_pivot": cell_pivot_sql("sd_3hr"),
        "merge_variables": region_day_sql("mean"),
        "region_names": region_names_sql(),
        "season_filter": SQL_SEASON,
        "sentinel_clean": SQL_SENTINEL,
        "hour_completeness": SQL_HOURS,
        "missing_var_days": SQL_MISSING_VAR_DAYS,
        "complete_days": SQL_COMPLETE_DAYS,
        "todo_days": SQL_TODO,
        "error_responses": SQL_ERRORS,
        "parse_tokens": SQL_PARSE_TOKENS,
        "ingest_published": SQL_INGEST_PUBLISHED,
        "ingest_status": SQL_INGEST_STATUS,
        "ingest_quarantine": SQL_INGEST_QUARANTINE,
        "response_preview": SQL_PREVIEW,
        "mapping_profile": SQL_PROFILE,
        "region_density": SQL_DENSITY,
        "region_count": SQL_REGION_COUNT,
        "unified_mapping": SQL_UNIFIED,
        "grid_mesh": SQL_MESH,
        "grid_rows": SQL_ROWS,
        "points_in_polygons": SQL_PIP,
        "reproject": _reproject_sql(),
        "station_parse": SQL_STATION_PARSE,
        "station_parse_parity": SQL_STATION_PARSE_PARITY,
        "station_parse_widths": _station_widths_sql(),
        "station_law_id": SQL_LAW_ID,
        "station_completeness": SQL_COMPLETENESS,
        "duplicate_keys": SQL_DUPS,
        "out_of_range": SQL_OOR,
        "year_metrics": SQL_YEAR_METRICS,
        "station_churn": SQL_CHURN,
        "report_top_rows": SQL_TOP,
        "failure_summary": SQL_FAILURES,
        "skip_summary": SQL_SKIPS,
        "per_station_report": SQL_PER_STATION_REPORT,
        "file_years": SQL_FILE_YEARS,
        "formatted_dates": _formatted_dates_sql(),
        "spring_calendar": SQL_SPRING,
    }
