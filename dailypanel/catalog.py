"""The column catalogue: which variables exist, how they are aggregated and how gaps are filled.

Operators never search column names for substrings; they ask the catalogue.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from dailypanel.fixed import MEAN_STATS, TOD_STATS


#: Ways to fill the gaps of a column.
FILLS = ("zero", "mean", "median", "mode", "linear")


@dataclass(frozen=True)
class PanelColumn:
    """One panel column; ``fill`` is one of FILLS or none."""

    variable: str
    stat: str
    grain: str
    fill: str = "none"

    @property
    def name(self) -> str:
        stem = self.variable.replace(".", "_")
        return f"{stem}_{self.stat}_{self.grain}" if self.stat else f"{stem}_{self.grain}"


@dataclass(frozen=True)
class Catalog:
    """Roles of the variables in a readings table.

    averaged  mean, spread, extremes, first and last per day
    summed    daily total
    peaked    summed variables that also get a daily maximum
    signed    variables for which a negative value is legal
    usage     summed variables whose missing days mean "not used", filled with 0
    static    variables whose readings say nothing about being awake
    fills     (column name, fill) of single columns, instead of the usual fill of their statistic
    """

    averaged: tuple[str, ...]
    summed: tuple[str, ...]
    peaked: tuple[str, ...] = ()
    signed: tuple[str, ...] = ()
    usage: tuple[str, ...] = ()
    static: tuple[str, ...] = ()
    target: str = "mood"
    valence: str = "valence"
    arousal: str = "arousal"
    order: tuple[str, ...] = field(default=())
    fills: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        known = {c.name for c in (*self.daily_columns(), *self.tod_columns())}
        for name, fill in self.fills:
            if name not in known or fill not in FILLS:
                raise ValueError(f"{name} cannot be filled by {fill}: columns {sorted(known)}, fills {FILLS}")

    @classmethod
    def discover(cls, readings: DataFrame, **roles) -> Catalog:
        """Treat every variable that is not averaged as summed; reads the distinct variable names."""
        averaged = tuple(roles.pop("averaged"))
        names = sorted(r[0] for r in readings.select("variable").distinct().collect() if r[0] is not None)
        return cls(averaged=averaged, summed=tuple(n for n in names if n not in averaged), **roles)

    def _ranked(self, columns: Iterable[PanelColumn]) -> list[PanelColumn]:
        place = {name: i for i, name in enumerate(self.order or self.averaged + self.summed)}
        stats = {s: i for i, s in enumerate(("sum",) + MEAN_STATS + ("",))}
        return sorted(
            columns,
            key=lambda c: (place.get(c.variable, len(place)), c.variable, stats[c.stat]),
        )

    def _fill(self, variable: str, stat: str, grain: str = "daily") -> str:
        wanted = dict(self.fills).get(PanelColumn(variable, stat, grain).name)
        if wanted:
            return wanted
        if variable in self.usage:
            return "zero"
        return "mode" if stat in ("min", "max") else "linear"

    def daily_columns(self) -> list[PanelColumn]:
        """Daily aggregates and rest times in display order."""
        cols = [PanelColumn(v, s, "daily", self._fill(v, s)) for v in self.averaged for s in MEAN_STATS]
        cols += [PanelColumn(v, "sum", "daily", self._fill(v, "sum")) for v in self.summed]
        cols += [PanelColumn(v, "max", "daily", self._fill(v, "max")) for v in self.peaked]
        return self._ranked(cols) + [
            PanelColumn("wake_time", "", "daily", self._fill("wake_time", "")),
            PanelColumn("bed_time", "", "daily", self._fill("bed_time", "")),
        ]

    def tod_columns(self) -> list[PanelColumn]:
        """Time-of-day aggregates in display order."""
        cols = [PanelColumn(v, s, "tod", self._fill(v, s, "tod")) for v in self.averaged for s in TOD_STATS]
        cols += [PanelColumn(v, "max", "tod", self._fill(v, "max", "tod")) for v in self.peaked]
        return self._ranked(cols)

    def names(self, grain: str, fill: str | None = None) -> list[str]:
        cols = self.daily_columns() if grain == "daily" else self.tod_columns()
        return [c.name for c in cols if fill is None or c.fill == fill]

    def column(self, variable: str, stat: str, grain: str = "daily") -> str:
        return PanelColumn(variable, stat, grain).name

    def level_columns(self, grain: str) -> list[str]:
        """The one level per variable whose day-to-day change is a feature."""
        cols = [self.column(v, "mean", grain) for v in self.averaged]
        if grain == "daily":
            cols += ["wake_time_daily", "bed_time_daily"]
            cols += [self.column(v, "sum") for v in self.summed if v not in self.usage]
        return cols

    def smoothed_columns(self, grain: str) -> list[str]:
        """Columns that get an exponentially weighted mean (levels, spreads and changes)."""
        levels = self.level_columns(grain)
        cols = levels + [f"change_{c}" for c in levels]
        if grain == "daily":
            cols += [self.column(v, s) for v in self.averaged for s in ("std", "std_slide")]
            cols += ["sleep_daily"]
        return cols
