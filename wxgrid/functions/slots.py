"""Slot labelling (hour -> wide column name) as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..catalogue import VarSpec, specs


def slot_label_for(spec: VarSpec, hour: Column) -> Column:
    """Slot name of one variable's reading, NULL when the hour is off the grid.

    Hourly: ``{p}{h:02d}{(h+1)%24:02d}`` for h in 0..23; 3-hourly:
    ``{p}{h:02d}{h+3:02d}`` for h in 0, 3, ..., 21.  Any other hour has no
    slot, so it never reaches a wide column (it still marks the cell as
    having data that day, see ``operators.regional``).
    """
    if spec.three_hourly:
        on_grid = hour.isin(*spec.slot_hours())
        end = hour + F.lit(3)
    else:
        on_grid = hour.between(0, 23)
        end = (hour + F.lit(1)) % F.lit(24)
    return F.when(on_grid, F.format_string("%s%02d%02d", F.lit(spec.prefix), hour, end))


def slot_label(var: Column, hour: Column, variables) -> Column:
    """Slot name for a long row whose variable is in ``variables``."""
    expr = None
    for s in specs(variables):
        branch = slot_label_for(s, hour)
        expr = F.when(var == F.lit(s.name), branch) if expr is None else expr.when(var == F.lit(s.name), branch)
    return expr if expr is not None else F.lit(None).cast("string")


def slot_index(var: Column, hour: Column, variables) -> Column:
    """Integer slot id: position of the slot in ``specs(variables)`` order.

    Same on-grid rule as ``slot_label``; integers keep the dedupe shuffle key
    narrow and make the per-slot conditional aggregates int comparisons.
    """
    expr = None
    base = 0
    for s in specs(variables):
        if s.three_hourly:
            on_grid = hour.isin(*s.slot_hours())
        else:
            on_grid = hour.between(0, 23)
        branch = F.when(on_grid, F.lit(base) + (hour / F.lit(s.step)).cast("int"))
        cond = var == F.lit(s.name)
        expr = F.when(cond, branch) if expr is None else expr.when(cond, branch)
        base += s.slots_per_day
    return expr if expr is not None else F.lit(None).cast("int")


def time_key(date: Column, hour: Column) -> Column:
    """Request time key ``{YYYYMMDD}{hh}00``."""
    return F.format_string("%s%02d00", date, hour)
