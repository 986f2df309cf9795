"""Grid observations -> one wide row per region and day.

Input contract (the long fact table)::

    grid_idx long, date string YYYYMMDD, var string, hour int,
    value double (nullable), ord long (input order, makes "first" exact)

Plan shape (fused operator, ``region_day``):

1. prune + filter the long table (``value IS NOT NULL``, requested vars,
   snow season) -- pushed into the parquet scan;
2. inner join to the mapping, filtered to rows with every region code and
   collapsed to a multiplicity ``w`` per (cell, codes); the mapping is a
   grid-bounded dimension, which Spark broadcasts if its measured size allows,
   so 90% of cells (unmapped) are dropped before any shuffle;
3. first non-null reading per (date, codes, cell, var, slot):
   ``min_by(value, ord)`` -- shuffle keyed by the cell, so no region is hot;
4. a narrow aggregate per (date, codes, var, slot) -- two buffers, whole-
   stage code-generated, partial before the shuffle (a hot region
   contributes one partial row per slot and task);
5. a pivot of that small result to one column per slot.

The result equals pivoting each cell first and aggregating after (the
reference's order), including its null rules:

* a cell with no non-null reading of a variable adds nothing;
* ``mean``/``median`` skip nulls; an all-null slot is NULL;
* ``sum`` of an all-null slot is 0.0 when the region-day has any reading of
  that variable, else NULL (the outer merge leaves it empty);
* a cell mapped to two regions counts in both; a mapping row repeated
  counts as many times as it is repeated.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..catalogue import (SNOW_OFF_MONTHS, SNOW_START_YEAR, SNOW_VAR, VARIABLES, VarSpec,
                         ordered_slot_columns, region_id_columns, specs)
from ..functions.slots import slot_index, slot_label_for

METHODS = ("mean", "sum", "median")


def season_ok(var: Column, date: Column) -> Column:
    """Snow exists from 2020 on and not in June-September."""
    year = F.substring(date, 1, 4).cast("int")
    month = F.substring(date, 5, 2).cast("int")
    off = (var == F.lit(SNOW_VAR)) & ((year < F.lit(SNOW_START_YEAR)) | month.isin(*SNOW_OFF_MONTHS))
    return ~off


def mapped_cells(mapping: DataFrame, id_cols=None) -> DataFrame:
    """Mapping rows with every code present, as (grid_idx, codes..., w).

    ``w`` is how often the (cell, codes) pair occurs, so a repeated mapping
    row still counts twice without shuffling duplicate fact rows.
    """
    id_cols = id_cols or region_id_columns(mapping.columns)
    m = mapping.select("grid_idx", *id_cols).dropna(subset=["grid_idx", *id_cols])
    return m.groupBy("grid_idx", *id_cols).agg(F.count(F.lit(1)).alias("w"))


def input_order(df: DataFrame, order_col: str | None, value_col: str) -> Column:
    """A column that puts readings in the order they were given, whatever the
    partitioning: ``order_col`` where the table has it, else file name and row
    number within the file of a Parquet scan.  A table with neither has no
    order; its smallest reading then comes first."""
    if order_col and order_col in df.columns:
        return F.col(order_col)
    row = F.struct("_metadata.file_path", "_metadata.row_index")
    try:
        df.select(row)
    except AnalysisException:
        return F.col(value_col)
    return row


def cell_first_values(obs: DataFrame, mapping: DataFrame, variables,
                      id_cols=None, season_filter: bool = True,
                      dedupe: bool = True) -> tuple[DataFrame, list[str]]:
    """Steps 1-3: one value per (date, codes, cell, var, slot).

    ``slot`` is the integer slot index (``functions.slots.slot_index``).
    Off-grid hours keep ``slot = NULL``: they carry no value into any column
    but still mark the cell as reporting that variable that day.
    """
    id_cols = id_cols or region_id_columns(mapping.columns)
    variables = list(variables)
    # NaN counts as missing (pandas skips it), like NULL.
    o = obs.select("grid_idx", "date", "var", "hour", "value", input_order(obs, "ord", "value").alias("ord")).where(
        F.col("value").isNotNull() & ~F.isnan("value") & F.col("var").isin(*variables))
    if season_filter:
        o = o.where(season_ok(F.col("var"), F.col("date")))
    o = o.withColumn("slot", slot_index(F.col("var"), F.col("hour"), variables))
    m = mapped_cells(mapping, id_cols)
    joined = o.join(m, "grid_idx", "inner")
    if not dedupe:
        return joined.select("date", *id_cols, "grid_idx", "var", "slot",
                             F.col("value").alias("v"), "w"), id_cols
    cells = joined.groupBy("date", *id_cols, "grid_idx", "var", "slot").agg(
        F.min_by("value", "ord").alias("v"), F.max("w").alias("w"))
    return cells, id_cols


def hour_presence(obs: DataFrame, variables) -> DataFrame:
    """(date, var, hour) with a non-NULL reading anywhere on the grid.

    The reference pivots each day separately and drops a slot column that
    is empty for every cell; after the days are concatenated that slot is
    NULL.  This table lets ``region_day(..., method="sum")`` do the same.
    It is a partial aggregate over the readings (at most 56 rows per day).
    """
    o = obs.where(F.col("value").isNotNull() & ~F.isnan("value") & F.col("var").isin(*list(variables)))
    return o.select("date", "var", "hour").distinct()


def _slot_presence_wide(presence: DataFrame, variables) -> DataFrame:
    """(date, _p0 .. _pK): 1 where the slot has a reading somewhere that day."""
    p = presence.select("date", slot_index(F.col("var"), F.col("hour"), variables).alias("slot")) \
                .where(F.col("slot").isNotNull())
    n = sum(s.slots_per_day for s in specs(variables))
    return p.groupBy("date").agg(*[F.max(F.when(F.col("slot") == k, F.lit(1))).alias(f"_p{k}") for k in range(n)])


def _pivot_slots(per_slot: DataFrame, id_cols, variables, method: str,
                 presence: DataFrame | None = None) -> DataFrame:
    """(date, codes, var, slot, val) -> one row per (date, codes), one column
    per slot.  Input is already aggregated (at most 57 rows per region-day
    and variable), so the wide conditional aggregate here is cheap."""
    slot, var, val = F.col("slot"), F.col("var"), F.col("val")
    aggs, k = [], 0
    for s in specs(variables):
        aggs.append(F.max(F.when(var == F.lit(s.name), F.lit(1))).alias(f"_has_{s.name}"))
        for name in s.slot_names():
            aggs.append(F.max(F.when(slot == F.lit(k), val)).alias(name))
            k += 1
    wide = per_slot.groupBy("date", *id_cols).agg(*aggs)
    if method != "sum":
        return wide
    # sum of an all-NULL slot is 0.0 where the region-day has the variable --
    # unless the slot is empty on the whole grid that day (presence table).
    if presence is not None:
        # One row per day: broadcast by construction.
        wide = wide.join(F.broadcast(_slot_presence_wide(presence, variables)), "date", "left")
    cols, k = [], 0
    for s in specs(variables):
        has = F.col(f"_has_{s.name}") == F.lit(1)
        for n in s.slot_names():
            ok = has if presence is None else has & (F.col(f"_p{k}") == F.lit(1))
            cols.append(F.when(ok, F.coalesce(F.col(n), F.lit(0.0))).alias(n))
            k += 1
    return wide.select("date", *id_cols, *cols)


def region_day(obs: DataFrame, mapping: DataFrame, variables=("ta", "rn_60m"),
               method: str = "mean", id_cols=None, season_filter: bool = True,
               dedupe: bool = True, presence: DataFrame | None = None,
               grid_presence: bool = True) -> DataFrame:
    """Fused operator: pivot + map + aggregate + merge for all days at once.

    Output columns: ``date``, sorted t*, sorted p*, sorted s*, then the
    region code column(s).  Every slot of every requested variable is a
    column (fixed schema); unordered until a sink sorts.

    ``dedupe=False`` skips step 3 (the only shuffle of fact rows) and is
    exact when the input holds at most one reading per (cell, date, var,
    hour) -- true for the observation cache written by ``ingest``, which
    keeps one response per (var, time).  Then every shuffle left carries
    map-side partial aggregates.

    ``sum`` leaves a slot NULL on days when no cell of the grid has a reading
    for it, as the reference's per-day pivot does.  Which slots those are comes
    from ``presence`` (the ingest manifest), else from the readings
    (``hour_presence``); with ``grid_presence=False`` such a slot is 0.0.
    """
    if method not in METHODS:
        raise ValueError(f"Unknown method: {method}")
    variables = list(variables)
    if method == "sum" and presence is None and grid_presence:
        presence = hour_presence(obs, variables)
    cells, id_cols = cell_first_values(obs, mapping, variables, id_cols, season_filter, dedupe)
    keys = ["date", *id_cols, "var", "slot"]
    # Narrow aggregate per (date, codes, var, slot): two buffers, fully
    # code-generated, partial before the shuffle.  Off-grid readings form a
    # slot-NULL group that only marks the variable as present.
    if method == "median":
        per_slot = weighted_median(cells, keys)
    else:
        per_slot = cells.groupBy(*keys).agg(F.sum(F.col("v") * F.col("w")).alias("s"),
                                            F.sum("w").alias("n"))
        val = F.col("s") / F.col("n") if method == "mean" else F.col("s")
        per_slot = per_slot.select(*keys, val.alias("val"))
    wide = _pivot_slots(per_slot, id_cols, variables, method, presence)
    return wide.select("date", *ordered_slot_columns(variables), *id_cols)


#: Bins of the median's first pass per unit of log(1 + |value|).
MEDIAN_BINS = 4096


def weighted_median(rows: DataFrame, keys) -> DataFrame:
    """(keys, val): exact interpolated median of ``v``, each counted ``w``
    times, by selection in two passes.

    First the rows become counts per distinct value (partial aggregates), and
    those counts per bin of a fixed, order-preserving scale; a running total of
    a group's bins finds the one or two that hold its middle ranks.  Then only
    these bins' values are ordered.  No group is gathered or sorted as a whole,
    and a crowded group is spread over its bins.  Keys may be NULL.
    """
    mag = F.floor(F.log1p(F.abs("v")) * F.lit(float(MEDIAN_BINS)))   # monotone in |v|
    values = rows.groupBy(*keys, "v").agg(F.sum("w").alias("w")).withColumn("bin", F.when(F.col("v") < 0, -mag).otherwise(mag))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = values.groupBy(*keys, "bin").agg(F.sum("w").alias("n")) \
        .withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(group))
    bins = bins.withColumn("lo", F.floor((F.col("all") - 1) / 2)).withColumn("hi", F.floor(F.col("all") / 2)) \
        .where((F.col("upto") > F.col("lo")) & (F.col("upto") - F.col("n") <= F.col("hi")))
    names = [*keys, "bin"]
    middle = bins.select(*[F.col(k).alias(f"_{k}") for k in names], (F.col("upto") - F.col("n")).alias("before"), "lo", "hi")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in names])
    kept = values.join(middle, on)
    rank = F.col("before") + F.sum("w").over(Window.partitionBy(*names).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    kept = kept.withColumn("upto", rank)
    return kept.groupBy(*keys).agg(((F.min(F.when(F.col("upto") > F.col("lo"), F.col("v"))) +
                                     F.min(F.when(F.col("upto") > F.col("hi"), F.col("v")))) / 2).alias("val"))


# ---------------------------------------------------------------------------
# Stand-alone building blocks (same semantics, usable on their own)
# ---------------------------------------------------------------------------

def _pivot(df: DataFrame, spec: VarSpec, value_col: str, grid_col: str, order_col: str | None) -> DataFrame:
    """One row per (cell, date), one column per slot of ``spec``: the first
    non-null reading per slot (NaN counts as missing).  One shuffle: every
    slot is a conditional ``min_by`` in a single aggregate."""
    v = F.col(value_col)
    o = df.where(v.isNotNull() & ~F.isnan(v))
    o = o.select(grid_col, "date", v.alias("_v"), input_order(df, order_col, value_col).alias("_ord"),
                 slot_label_for(spec, F.col("hour")).alias("_slot"))
    aggs = [F.min_by("_v", F.when(F.col("_slot") == F.lit(n), F.col("_ord"))).alias(n)
            for n in spec.slot_names()]
    return o.groupBy(grid_col, "date").agg(*aggs)


def pivot_hours(obs: DataFrame, var: str, grid_col: str = "grid_idx") -> DataFrame:
    """One row per (cell, date) with one column per slot of ``var``.

    First non-null reading per slot in input order (``ord``); a (cell, date)
    without any non-null reading has no row; hours off the slot grid are
    dropped (a cell with only off-grid readings keeps an all-NULL row).
    """
    spec = specs([var])[0]
    return _pivot(obs.where(F.col("var") == F.lit(var)), spec, "value", grid_col, "ord")


def pivot_hourly_to_columns(df: DataFrame, var_col: str = "value", col_prefix: str = "t",
                            grid_col: str = "grid_idx", is_3hourly: bool = False,
                            order_col: str | None = "ord") -> DataFrame:
    """The per-cell pivot with an explicit prefix and cadence, for a long
    table of one variable: (grid, date, hour, <var_col>) -> (grid, date,
    {prefix}0001 ... or {prefix}0003 ...)."""
    spec = VarSpec(f"_{col_prefix}", col_prefix, 8 if is_3hourly else 24)
    return _pivot(df, spec, var_col, grid_col, order_col)


def aggregate_to_region(wide: DataFrame, mapping: DataFrame, value_cols,
                        method: str = "mean", grid_col: str = "grid_idx") -> DataFrame:
    """Wide per-cell table -> wide per-region table (join, drop unmapped, agg).

    With ``sum``, NULLs count as 0, so an all-NULL slot of an existing group
    sums to 0.0.
    """
    if method not in METHODS:
        raise ValueError(f"Unknown method: {method}")
    id_cols = region_id_columns(mapping.columns)
    m = mapping.select(grid_col, *id_cols).dropna(subset=id_cols)
    j = wide.join(m, grid_col, "inner")
    keys = (["date"] if "date" in wide.columns else []) + id_cols
    if method == "mean":
        aggs = [F.avg(c).alias(c) for c in value_cols]
    elif method == "sum":
        aggs = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in value_cols]
    else:
        return _median_of_columns(j, keys, list(value_cols))
    return j.groupBy(*keys).agg(*aggs)


def _median_of_columns(df: DataFrame, keys, value_cols) -> DataFrame:
    """Median of every column per group, by selection: the columns become rows
    and their medians columns again.  A group without a reading keeps its row."""
    each = F.posexplode(F.array(*[F.col(c).cast("double") for c in value_cols])).alias("_slot", "v")
    long = df.select(*keys, each).where(F.col("v").isNotNull() & ~F.isnan("v")).withColumn("w", F.lit(1))
    groups = df.select(*keys, F.lit(None).cast("int").alias("_slot"), F.lit(None).cast("double").alias("val")).distinct()
    medians = groups.unionByName(weighted_median(long, [*keys, "_slot"]))
    return medians.groupBy(*keys).agg(*[F.max(F.when(F.col("_slot") == i, F.col("val"))).alias(c) for i, c in enumerate(value_cols)])


def merge_variables(frames: dict, keys) -> DataFrame | None:
    """Full outer merge of per-variable region tables on ``keys``.

    A column name that two variables share is told apart by the variable's
    name, so no reading is lost.  Columns come out as date, the slots in the
    catalogue's order, other columns by name, region codes.
    """
    if not frames:
        return None
    keys = [keys] if isinstance(keys, str) else list(keys)
    uses = Counter(c for df in frames.values() for c in df.columns if c not in keys)
    told = [df.select(*keys, *[F.col(c).alias(f"{c}_{var}" if uses[c] > 1 else c) for c in df.columns if c not in keys])
            for var, df in frames.items()]
    merged = reduce(lambda a, b: a.join(b, keys, "full_outer"), told)
    return merged.select(*sorted(merged.columns, key=lambda c: _place(c, keys)))


def _place(column: str, keys: list[str]) -> tuple:
    """Rank of an output column: (block, rank in the catalogue, name)."""
    if column in keys:
        return (0 if column == "date" else 3, keys.index(column), column)
    slots = ordered_slot_columns(VARIABLES)
    return (1, slots.index(column), column) if column in slots else (2, 0, column)


def add_region_name(df: DataFrame, mapping: DataFrame, id_col: str, nm_col: str) -> DataFrame:
    """Left join distinct (code, name); two names for one code fan out."""
    names = mapping.select(id_col, nm_col).distinct()
    return df.join(names, id_col, "left")


def format_date(df: DataFrame, date_col: str = "date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """``YYYYMMDD`` (or any parseable date) column rendered with ``fmt``."""
    d = F.coalesce(F.try_to_date(F.col(date_col).cast("string"), "yyyyMMdd"),
                   F.try_to_date(F.col(date_col).cast("string")))
    return df.withColumn(date_col, F.date_format(d, fmt))


def count_regions(mapping: DataFrame) -> DataFrame:
    """Distinct region count per code column present."""
    ids = region_id_columns(mapping.columns)
    return mapping.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in ids])
