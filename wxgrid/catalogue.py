"""Variable catalogue and slot naming.

Everything here is plan-time Python: it decides column names and literal
lists that go into Spark expressions, never touches data.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical output.
#   variable -> (column prefix, slots per day)
#   ta      temperature (deg C)        prefix t, 24 hourly slots
#   rn_60m  60-minute precipitation    prefix p, 24 hourly slots
#   sd_3hr  3-hour new snowfall (cm)   prefix s, 8 three-hourly slots
#   snow is produced from 2020 on, and not in months 6, 7, 8, 9
#   sentinels: a reading below -900 or above 2000 is missing
#   region code columns: HJD_CD (administrative), EMD_CD (legal)
#   region name columns: HJD_NM, EMD_NM
# ---------------------------------------------------------------------------
VARIABLES = {
    "ta": ("t", 24),
    "rn_60m": ("p", 24),
    "sd_3hr": ("s", 8),
}
SNOW_VAR = "sd_3hr"
SNOW_START_YEAR = 2020
SNOW_OFF_MONTHS = (6, 7, 8, 9)
SENTINEL_LOW = -900.0
SENTINEL_HIGH = 2000.0
HJD_CD, HJD_NM = "HJD_CD", "HJD_NM"
EMD_CD, EMD_NM = "EMD_CD", "EMD_NM"
DEFAULT_VARS = ("ta", "rn_60m")


@dataclass(frozen=True)
class VarSpec:
    name: str
    prefix: str
    slots_per_day: int

    @property
    def step(self) -> int:
        """Hours between slots: 1 for hourly, 3 for 3-hourly."""
        return 24 // self.slots_per_day

    @property
    def three_hourly(self) -> bool:
        return self.slots_per_day == 8

    def slot_hours(self) -> list[int]:
        return list(range(0, 24, self.step))

    def slot_name(self, hour: int) -> str:
        # Hourly slots wrap at midnight (hour 23 -> "2300"); 3-hourly slots
        # end at hour + 3 (hour 21 -> "2124").
        end = hour + 3 if self.three_hourly else (hour + 1) % 24
        return f"{self.prefix}{hour:02d}{end:02d}"

    def slot_names(self) -> list[str]:
        return [self.slot_name(h) for h in self.slot_hours()]


def spec(var: str) -> VarSpec:
    """Catalogue entry; an unknown variable gets its first letter and 24 slots."""
    prefix, n = VARIABLES.get(var, (var[:1], 24))
    return VarSpec(var, prefix, n)


def specs(variables) -> list[VarSpec]:
    out = [spec(v) for v in variables]
    seen: dict[str, str] = {}
    for s in out:
        for name in s.slot_names():
            if name in seen and seen[name] != s.name:
                raise ValueError(f"slot {name} of {s.name} clashes with {seen[name]}")
            seen[name] = s.name
    return out


def ordered_slot_columns(variables) -> list[str]:
    """Output order: sorted t*, sorted p*, sorted s*, then any others."""
    names = [n for s in specs(variables) for n in s.slot_names()]
    ordered = []
    for p in ("t", "p", "s"):
        ordered += sorted(n for n in names if n.startswith(p))
    ordered += [n for n in names if n not in ordered]
    return ordered


def find_name(columns, candidates) -> str | None:
    """The first candidate among ``columns``: as it is written, else without
    regard to case; ``None`` if there is none."""
    exact = [c for c in candidates if c in columns]
    lower = {c.lower(): c for c in reversed(list(columns))}
    loose = [lower[c.lower()] for c in candidates if c.lower() in lower]
    return next(iter([*exact, *loose]), None)


def region_id_columns(columns) -> list[str]:
    """Region key columns of a mapping: both systems, or whichever exists."""
    found = [c for c in (HJD_CD, EMD_CD) if c in columns]
    if not found:
        raise ValueError("mapping has no region code column (HJD_CD or EMD_CD)")
    return found
