"""Registered queries: each runs one operator family over the driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame.  Double
outputs are rounded to 6 decimals here (not in the operators) so that the
DuckDB oracle, which sums in a different order, hashes the same values.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..catalogue import specs
from ..functions import geometry
from ..functions import text as T
from ..functions.values import clean_sentinel
from ..functions.dates import year_from_filename
from ..operators import coverage, gates, ingest, regional, spatial, stations
from ..session import scratch_path
from ..sinks import writers
from ..sources import adapters as A

ALL_VARS = ("ta", "rn_60m", "sd_3hr")
ROUND = 6


def rounded(df: DataFrame, digits: int = ROUND) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# -- regional (flagship family) ---------------------------------------------

def region_day_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(regional.region_day(A.obs(spark, sf), A.mapping_hjd(spark, sf), ALL_VARS, "mean"))


def region_day_sum(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(regional.region_day(A.obs(spark, sf), A.mapping_hjd(spark, sf), ALL_VARS, "sum"))


def region_day_median(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(regional.region_day(A.obs(spark, sf), A.mapping_hjd(spark, sf), ALL_VARS, "median"))


def region_pair_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(regional.region_day(A.obs(spark, sf), A.mapping(spark, sf), ALL_VARS, "mean"))


def cell_hour_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(regional.pivot_hours(A.obs(spark, sf), "ta"))


def cell_3hour_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(regional.pivot_hours(A.obs(spark, sf), "sd_3hr"))


def merge_variables(spark: SparkSession, sf: str) -> DataFrame:
    """Unfused reference order: pivot per cell, aggregate per variable, outer merge."""
    o = A.obs(spark, sf)
    m = A.mapping_hjd(spark, sf)
    frames = {}
    for s in specs(ALL_VARS):
        wide = regional.pivot_hours(o, s.name)
        frames[s.name] = regional.aggregate_to_region(wide, m, s.slot_names(), "mean")
    return rounded(regional.merge_variables(frames, ["date", "HJD_CD"]))


def _named_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """HJD mapping with names; every 50th cell spells its name in lower case,
    so some codes carry two names (the lookup fans out)."""
    c = A.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = A.table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(
        F.col("c_custkey").alias("grid_idx"),
        F.when(F.col("c_acctbal") < 0, F.lit(None))
         .otherwise(F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("HJD_CD"),
        F.when(F.col("c_custkey") % 50 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("HJD_NM"),
    )


def region_names(spark: SparkSession, sf: str) -> DataFrame:
    named = _named_mapping(spark, sf)
    day = regional.region_day(A.obs(spark, sf), named.select("grid_idx", "HJD_CD"), ["ta"], "mean")
    out = regional.add_region_name(day, named, "HJD_CD", "HJD_NM")
    return rounded(out)


# -- gates -------------------------------------------------------------------

def _orders_days(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates shifted 27 years (2019-2025), so both snow rules apply."""
    o = A.table(spark, sf, "orders")
    v = F.col("o_orderkey") % 3
    return o.select("o_orderkey", "o_orderstatus",
                    F.date_format(F.add_months(F.col("o_orderdate"), 27 * 12), "yyyyMMdd").alias("date"),
                    F.when(v == 0, "ta").when(v == 1, "rn_60m").otherwise("sd_3hr").alias("var"))


def season_filter(spark: SparkSession, sf: str) -> DataFrame:
    return gates.season_filter(_orders_days(spark, sf)).select("o_orderkey", "date", "var")


def sentinel_clean(spark: SparkSession, sf: str) -> DataFrame:
    li = A.table(spark, sf, "lineitem")
    raw = F.col("l_extendedprice") / F.lit(20.0) - F.lit(1000.0)
    return rounded(li.select("l_orderkey", "l_linenumber", clean_sentinel(raw).alias("value")))


def hour_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return gates.hour_status(A.obs(spark, sf), ALL_VARS)


def missing_var_days(spark: SparkSession, sf: str) -> DataFrame:
    o = A.obs(spark, sf)
    exp = gates.expected_pairs(gates.month_calendar(o.select("date")), ALL_VARS)
    return gates.missing_pairs(exp, o)


def complete_days(spark: SparkSession, sf: str) -> DataFrame:
    """Reference gate (strict): a day runs only if every requested variable
    has data; rows of the kept days, counted per day and variable."""
    o = A.obs(spark, sf)
    exp = gates.expected_pairs(gates.month_calendar(o.select("date")), ALL_VARS, strict=True)
    kept = gates.gate(o, gates.complete_days(exp, o))
    return kept.groupBy("date", "var").agg(F.count(F.lit(1)).alias("n_obs"))


def todo_days(spark: SparkSession, sf: str) -> DataFrame:
    d = _orders_days(spark, sf)
    requested = gates.month_calendar(d.select("date"))
    done = d.where(F.col("o_orderstatus") == "F").select("date")
    return gates.todo(requested, done, ["date"])


# -- raw responses -----------------------------------------------------------

def error_responses(spark: SparkSession, sf: str) -> DataFrame:
    pages = A.table(spark, sf, "pages").select(F.lit("pages").alias("src"), F.col("page_id").alias("id"),
                                               F.col("html").alias("text"))
    docs = A.table(spark, sf, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"),
                                                  "text")
    both = pages.unionByName(docs)
    return both.select("src", "id", T.is_error_response(F.col("text")).alias("is_error"))


def parse_tokens(spark: SparkSession, sf: str) -> DataFrame:
    r = A.responses(spark, sf).select("resp_id", "expected_n", "text",
                                      F.lit("ta").alias("var"), F.lit("202401010000").alias("tm"))
    valid = ingest.validate(r, F.col("expected_n"))
    return rounded(ingest.to_long(valid, extra=("resp_id",)).select("resp_id", "grid_idx", "value"))


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.staged(ingest.validate(A.landed(spark, sf), F.col("expected_n")))


def _staging(spark: SparkSession, sf: str) -> DataFrame:
    """The staged rows, written below the shared folder and read again, so that
    every response is parsed once for all that is made of them."""
    root, rows = scratch_path(spark, f"staging-{uuid.uuid4().hex}"), _staged(spark, sf)
    rows.write.parquet(root)
    return spark.read.schema(rows.schema).parquet(root)


def ingest_published(spark: SparkSession, sf: str) -> DataFrame:
    """Readings of complete days, as the ingest publishes them from staging."""
    rows = _staging(spark, sf)
    complete = ingest.staged_status(rows, ALL_VARS).where("complete").select("date", "var")
    good = rows.where(F.col("grid_idx").isNotNull()).join(complete, ["date", "var"], "left_semi")
    return rounded(good.select("grid_idx", "date", "var", "hour", "value"))


def ingest_status(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest rows of an ingest: completeness and hours of every day."""
    s = ingest.staged_status(_staged(spark, sf), ALL_VARS)
    return s.select("date", "var", "complete", "missing_hours", F.concat_ws(",", F.transform("value_hours", lambda h: h.cast("string"))).alias("value_hours"))


def ingest_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected responses of every kind, and the days they leave incomplete."""
    rows = _staging(spark, sf)
    return ingest.quarantine(rows, ingest.staged_status(rows, ALL_VARS)).drop("logged_at")


def response_preview(spark: SparkSession, sf: str) -> DataFrame:
    p = A.table(spark, sf, "pages")
    lines = T.split_lines(F.col("html"))
    return p.select("page_id",
                    F.length("html").cast("long").alias("total_chars"),
                    F.size(lines).cast("long").alias("total_lines"),
                    T.preview(F.col("html")).alias("preview"),
                    T.snippet_head(lines).alias("head"),
                    T.snippet_tail(lines).alias("tail"))


# -- mapping / geometry ------------------------------------------------------

def _map_sides(spark: SparkSession, sf: str):
    c = A.table(spark, sf, "customer")
    lat = (F.lit(33.0) + (F.col("c_custkey") % 100) * F.lit(0.05)).alias("lat")
    lon = (F.lit(124.0) + (F.col("c_custkey") % 77) * F.lit(0.05)).alias("lon")
    # every customer is a cell on both sides; a third (quarter) of them has a
    # cell id of its own on one side, so that some cells are in one system only
    k = F.col("c_custkey")
    hjd = c.select(
        F.when(k % 3 == 0, -k - 1).otherwise(k).alias("grid_idx"), lat, lon,
        F.when(F.col("c_acctbal") < 0, F.lit(None))
         .otherwise(F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("HJD_CD"),
        F.col("c_name").alias("HJD_NM"))
    bjd = c.select(
        F.when(k % 4 == 0, k + 1_000_000_000).otherwise(k).alias("grid_idx"), lat, lon,
        F.col("c_mktsegment").alias("EMD_CD"), F.lower("c_mktsegment").alias("EMD_NM"))
    return hjd, bjd


def unified_mapping(spark: SparkSession, sf: str) -> DataFrame:
    hjd, bjd = _map_sides(spark, sf)
    return rounded(spatial.unified_mapping(hjd, bjd))


def mapping_profile(spark: SparkSession, sf: str) -> DataFrame:
    hjd, bjd = _map_sides(spark, sf)
    return spatial.mapping_profile(spatial.unified_mapping(hjd, bjd))


def region_density(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.region_density(A.mapping(spark, sf), "HJD_CD")


def region_count(spark: SparkSession, sf: str) -> DataFrame:
    return regional.count_regions(A.mapping(spark, sf))


def _grid_axes(spark: SparkSession, sf: str) -> DataFrame:
    """One small grid per supplier: 3 latitudes x 2 longitudes from its key
    and nation (many axis records, so the work grows with the table)."""
    sup = A.table(spark, sf, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    return sup.select(k.alias("gid"),
                      F.transform(F.sequence(F.lit(0), F.lit(2)),
                                  lambda i: F.lit(33.0) + k * F.lit(0.001) + i * F.lit(0.25)).alias("lat"),
                      F.transform(F.sequence(F.lit(0), F.lit(1)),
                                  lambda j: F.lit(124.0) + n * F.lit(0.1) + j * F.lit(0.5)).alias("lon"))


def grid_mesh(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(spatial.grid_from_axes(_grid_axes(spark, sf), keys=("gid",)))


def _grid_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Grid rows from suppliers: row ``y = s_suppkey - 1`` with 4 cells."""
    sup = A.table(spark, sf, "supplier")
    xs = F.sequence(F.lit(0), F.lit(3))
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    return sup.select((k - 1).alias("y"),
                      F.transform(xs, lambda j: F.lit(33.0) + k * F.lit(0.001) + j * F.lit(0.0001)).alias("lat"),
                      F.transform(xs, lambda j: F.lit(124.0) + j * F.lit(0.1) + n * F.lit(0.01)).alias("lon"))


def grid_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(spatial.grid_from_rows(_grid_rows(spark, sf)))


def _test_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """A triangle, a square with a hole, one triangle per region row, and two
    large overlapping polygons of 5 teeth per supplier, one with a hole."""
    def ring(pts):
        return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in pts])
    base = spark.range(1).select(
        F.lit("T0").alias("code"), F.lit("triangle").alias("name"),
        F.array(ring([(-0.2, -0.2), (0.1, -0.1), (0.0, 0.2)])).alias("rings"))
    sq = spark.range(1).select(
        F.lit("SQ").alias("code"), F.lit("square").alias("name"),
        F.array(ring([(-0.3, -0.3), (0.0, -0.3), (0.0, 0.0), (-0.3, 0.0)]),
                ring([(-0.2, -0.2), (-0.1, -0.2), (-0.1, -0.1), (-0.2, -0.1)])).alias("rings"))
    reg = A.table(spark, sf, "region")
    cx = F.col("r_regionkey") * F.lit(0.1) - F.lit(0.25)

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))
    tri = reg.select(F.col("r_name").alias("code"), F.lower("r_name").alias("name"),
                     F.array(F.array(pt(cx - F.lit(0.1), F.lit(-0.1)), pt(cx + F.lit(0.1), F.lit(-0.1)),
                                     pt(cx, F.lit(0.15)))).alias("rings"))
    # two large polygons that overlap all others: a saw of many teeth
    # above, and the same with the band below its middle as a hole
    sup = A.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))
    n = sup.agg(F.max("k").alias("n"))   # one row
    teeth = n.withColumn("p", F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") * 5), lambda i: pt(
        F.lit(-0.4) + F.lit(0.8) * i / (F.col("n") * 5), F.when(i % 2 == 0, F.lit(0.11)).otherwise(F.lit(0.19)))))
    closing = F.array(pt(F.lit(0.4), F.lit(-0.35)), pt(F.lit(-0.4), F.lit(-0.35)))
    hole = F.array(pt(F.lit(-0.38), F.lit(-0.01)), pt(F.lit(0.38), F.lit(-0.01)), pt(F.lit(0.38), F.lit(0.0123)), pt(F.lit(-0.38), F.lit(0.0123)))
    saw = teeth.select(F.lit("SAW").alias("code"), F.lit("saw").alias("name"), F.array(F.concat("p", closing)).alias("rings"))
    holed = teeth.select(F.lit("HOL").alias("code"), F.lit("holed saw").alias("name"), F.array(F.concat("p", closing), hole).alias("rings"))
    return spatial.union_layers([base, sq, tri, saw, holed])


def points_in_polygons(spark: SparkSession, sf: str) -> DataFrame:
    pts = A.points(spark, sf)
    polys = _test_polygons(spark, sf)
    out = spatial.points_in_polygons(pts, polys, "code", "name", x_col="x", y_col="y")
    return rounded(out)


def reproject(spark: SparkSession, sf: str) -> DataFrame:
    p = A.points(spark, sf)
    lon, lat = geometry.tm_to_lonlat(F.lit(1000000.0) + p.x * F.lit(1e6), F.lit(2000000.0) + p.y * F.lit(1e6))
    return rounded(p.select("pid", lon.alias("lon"), lat.alias("lat")))


# -- stations ----------------------------------------------------------------

def _station_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Station daily files rebuilt as lines: a help block, 56-field data
    lines, an occasional '#' note in the middle and the end marker."""
    d = A.daily(spark, sf)
    path = F.format_string("weather_data_stn%d_%d0101_%d1231.txt", F.col("STN"), F.col("file_year"), F.col("file_year"))
    fields = []
    for name in stations.DAILY_COLUMNS:
        if name == "TM":
            fields.append(F.col("TM").cast("string"))
        elif name == "STN":
            fields.append(F.col("STN").cast("string"))
        elif name == "RN_DAY":
            fields.append(F.col("RN_DAY").cast("string"))
        elif name == "TA_AVG":
            fields.append(((F.col("ord") % 40) - 10).cast("string"))
        else:
            fields.append(F.lit("-9"))
    data = d.select(path.alias("path"), (F.col("ord") * 2).alias("line_no"), F.concat_ws("   ", *fields).alias("line"))
    notes = d.where(F.col("ord") % 50 == 0).select(path.alias("path"), (F.col("ord") * 2 + 1).alias("line_no"),
                                                    F.lit("# note").alias("line"))
    files = d.select(path.alias("path")).distinct()
    head = files.select("path", F.posexplode(F.array(F.lit("# daily table"), F.lit("#  TM STN ..."), F.lit(""))).alias("i", "line")) \
                .select("path", (F.col("i") - 3).cast("long").alias("line_no"), "line")
    end = files.select("path", F.lit(1 << 40).cast("long").alias("line_no"), F.lit("#7777END,,,").alias("line"))
    return data.unionByName(notes).unionByName(head).unionByName(end)


def station_parse(spark: SparkSession, sf: str) -> DataFrame:
    t = stations.parse_daily(_station_lines(spark, sf))
    return rounded(t.drop("line_no"))


def station_parse_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Reference parity mode: only the leading help block is skipped, so the
    '# note' lines in the middle come out as rows of NULL fields."""
    t = stations.parse_daily(_station_lines(spark, sf), leading_only=True)
    return rounded(t.drop("line_no"))


def _station_width_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The same 56 fields as fixed-width lines: fields of nine characters and a
    blank; every second line of a file leaves TA_AVG blank, every third but the
    first RN_DAY."""
    d = A.daily(spark, sf)
    path = F.format_string("weather_data_stn%d_%d0101_%d1231.txt", F.col("STN"), F.col("file_year"), F.col("file_year"))
    d = d.withColumn("k", F.row_number().over(Window.partitionBy("STN", "file_year").orderBy("ord")))
    value = {"TM": F.col("TM").cast("string"), "STN": F.col("STN").cast("string"),
             "TA_AVG": F.when(F.col("k") % 2 == 1, ((F.col("ord") % 40) - 10).cast("string")),
             "RN_DAY": F.when(F.col("k") % 3 == 1, F.format_string("%.2f", "RN_DAY"))}
    fields = [F.lpad(F.coalesce(value.get(c, F.lit("-9")), F.lit("")), 9, " ") for c in stations.DAILY_COLUMNS]
    data = d.select(path.alias("path"), F.col("ord").alias("line_no"), F.concat_ws(" ", *fields).alias("line"))
    head = data.select("path").distinct().select("path", F.lit(-1).cast("long").alias("line_no"), F.lit("#  TM STN ...").alias("line"))
    return data.unionByName(head)


def station_parse_widths(spark: SparkSession, sf: str) -> DataFrame:
    """All 56 fields by the column edges inferred from each file's lines."""
    return rounded(stations.parse_daily_widths(_station_width_lines(spark, sf)).drop("line_no"))


def _station_dim_dups(spark: SparkSession, sf: str) -> DataFrame:
    n = A.table(spark, sf, "nation")
    first = n.select(F.col("n_nationkey").alias("STN_ID"),
                     F.lpad(F.col("n_regionkey").cast("string"), 10, "0").alias("LAW_ID"),
                     (F.col("n_nationkey") * 2).cast("long").alias("ord"))
    again = n.where(F.col("n_nationkey") % 4 == 1).select(
        F.col("n_nationkey").alias("STN_ID"),
        F.lpad((F.col("n_regionkey") + 5).cast("string"), 10, "0").alias("LAW_ID"),
        (F.col("n_nationkey") * 2 + 1).cast("long").alias("ord"))
    return first.unionByName(again)


def station_law_id(spark: SparkSession, sf: str) -> DataFrame:
    d = A.daily(spark, sf).drop("RN_DAY")
    return stations.law_id_lookup(d, _station_dim_dups(spark, sf))


def _keys(spark: SparkSession, sf: str) -> DataFrame:
    """Station days with some stations unknown and some dates invalid."""
    d = A.daily(spark, sf)
    bad = d.withColumn("STN", F.when(F.col("ord") % 89 == 0, F.lit(None)).otherwise(F.col("STN"))) \
           .withColumn("TM", F.when(F.col("ord") % 83 == 0, F.lit(None)).when(F.col("ord") % 79 == 0, F.lit(19950230)).otherwise(F.col("TM")))
    return coverage.clean_keys(bad, "file_year")


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if t == "date" else F.col(c)
                       for c, t in df.dtypes])


def station_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.per_station(_keys(spark, sf), A.stations(spark, sf))


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(coverage.duplicate_keys(_keys(spark, sf)))


def out_of_range(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(coverage.out_of_range(_keys(spark, sf)))


def year_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.year_metrics(_keys(spark, sf), A.stations(spark, sf))


def station_churn(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.station_churn(_keys(spark, sf), A.stations(spark, sf))


def report_top_rows(spark: SparkSession, sf: str) -> DataFrame:
    dup = coverage.duplicate_keys(_keys(spark, sf))
    return _dates_as_text(coverage.top_rows(dup, coverage.CAP_DETAIL, ["STN", "TM"]))


# -- summaries and report tables ----------------------------------------------

def failure_summary(spark: SparkSession, sf: str) -> DataFrame:
    return writers.failure_summary(gates.hour_status(A.obs(spark, sf), ALL_VARS))


def skip_summary(spark: SparkSession, sf: str) -> DataFrame:
    d = _orders_days(spark, sf)
    exp = gates.expected_pairs(gates.month_calendar(d.select("date")), ALL_VARS, strict=True)
    return gates.skip_summary(gates.missing_pairs(exp, d.select("date", "var")))


def per_station_report(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.per_station_report(coverage.per_station(_keys(spark, sf), A.stations(spark, sf)))


def file_years(spark: SparkSession, sf: str) -> DataFrame:
    d = A.daily(spark, sf)
    names = d.select(F.format_string("weather_data_stn%d_%d.csv", "STN", "file_year").alias("name")).distinct()
    return names.select("name", year_from_filename(F.col("name")).alias("year"))


def formatted_dates(spark: SparkSession, sf: str) -> DataFrame:
    day = regional.region_day(A.obs(spark, sf), A.mapping_hjd(spark, sf), ["ta"], "mean")
    return rounded(regional.format_date(day, "date"))


def spring_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return gates.months_each_year(_orders_days(spark, sf).select("date"), 3, 5)


def registry() -> dict:
    return {
        "region_day_mean": region_day_mean,
        "region_day_sum": region_day_sum,
        "region_day_median": region_day_median,
        "region_pair_mean": region_pair_mean,
        "cell_hour_pivot": cell_hour_pivot,
        "cell_3hour_pivot": cell_3hour_pivot,
        "merge_variables": merge_variables,
        "region_names": region_names,
        "season_filter": season_filter,
        "sentinel_clean": sentinel_clean,
        "hour_completeness": hour_completeness,
        "missing_var_days": missing_var_days,
        "complete_days": complete_days,
        "todo_days": todo_days,
        "error_responses": error_responses,
        "parse_tokens": parse_tokens,
        "ingest_published": ingest_published,
        "ingest_status": ingest_status,
        "ingest_quarantine": ingest_quarantine,
        "response_preview": response_preview,
        "mapping_profile": mapping_profile,
        "region_density": region_density,
        "region_count": region_count,
        "unified_mapping": unified_mapping,
        "grid_mesh": grid_mesh,
        "grid_rows": grid_rows,
        "points_in_polygons": points_in_polygons,
        "reproject": reproject,
        "station_parse": station_parse,
        "station_parse_parity": station_parse_parity,
        "station_parse_widths": station_parse_widths,
        "station_law_id": station_law_id,
        "station_completeness": station_completeness,
        "duplicate_keys": duplicate_keys,
        "out_of_range": out_of_range,
        "year_metrics": year_metrics,
        "station_churn": station_churn,
        "report_top_rows": report_top_rows,
        "failure_summary": failure_summary,
        "skip_summary": skip_summary,
        "per_station_report": per_station_report,
        "file_years": file_years,
        "formatted_dates": formatted_dates,
        "spring_calendar": spring_calendar,
    }
