"""Long readings to dense daily and time-of-day panels.

Raw rows are shuffled once, after map-side combining, on (entity, date, variable): a hot entity spreads
over its days. Everything after that works on the daily statistics, hashed by entity. The dense calendar
is filled from the gap to the next present day, so no grid join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailypanel.catalog import Catalog
from dailypanel.fixed import SLIDE_DAYS, TODS
from dailypanel.functions import expressions as E
from dailypanel.functions.wide import literal, over, with_exprs
from dailypanel.operators.lookup import attach_by_entity

#: Dense days of a task: bounds the memory of its sorts.
TASK_DAYS = 5_000
#: The daily grain's rows are few and narrow. A task first writes the code of some twenty windows, about a second however few its days are, so
#: beyond this many tasks they hold more days, up to so many.
MANY_TASKS, DAILY_TASK_DAYS = 64, 25_000


def reading_stats(readings: DataFrame, catalog: Catalog, grains=("daily",)) -> DataFrame:
    """One row per entity, date, variable and, at the time-of-day grain, band, with all statistics.

    With both grains the raw rows are read and combined once, as two grouping sets; ``tod`` is null at the
    daily grain.
    """
    value, hour = F.col("value"), F.col("hour")
    averaged = F.col("variable").isin(list(catalog.averaged))
    order = F.when(averaged & value.isNotNull(), E.in_day_order(F.col("ts"), F.col("seq")))
    extremes = [F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")]
    whole_day = [
        F.count("value").alias("n"),
        F.var_pop("value").alias("var"),
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("sum"),
        F.min_by("value", order).alias("first"),
        F.max_by("value", order).alias("last"),
        F.max(E.late_hour(hour)).alias("late"),
        F.max(E.early_hour(hour)).alias("early"),
        F.min(E.wake_hour(hour)).alias("wake"),
    ]
    day = ["entity", "date", "variable"]
    if tuple(grains) == ("daily",):
        return readings.groupBy(*day).agg(*extremes, *whole_day)
    if tuple(grains) == ("tod",):
        return readings.groupBy(*day, "tod").agg(*extremes)
    sets = [[F.col(c) for c in day], [F.col(c) for c in (*day, "tod")]]
    return readings.groupingSets(sets, *day, "tod").agg(*extremes, *whole_day)


def _pick(variable: str, stat: str, extra: str = "") -> str:
    return f"max(CASE WHEN variable = {literal(variable)} {extra} THEN `{stat}` END)"


def panel_tasks(readings: DataFrame, most: int | None = None) -> int:
    """So many tasks that each gets about TASK_DAYS dense days, however long the entities' spans are: one pass, one row per entity shuffled.
    From MANY_TASKS tasks on, each gets up to ``most`` days before there are more tasks.

    A panel's rows are many times wider than the statistics it is made from, so a size in bytes of the latter says little about a task."""
    span = readings.groupBy("entity").agg(F.datediff(F.max("date"), F.min("date")).alias("days"))
    days = span.agg(F.sum(F.col("days").cast("long") + 1)).first()[0]
    by_days, least = (days or 0) // TASK_DAYS, (days or 0) // (most or TASK_DAYS)
    return 2 + max(min(by_days, MANY_TASKS), least)


def _by_day(stats: DataFrame, picks: dict[str, str], tasks: int | None = None) -> DataFrame:
    """One row per entity and day, hashed by entity: the partitioning all later windows use."""
    return (
        stats.repartition(*([tasks] if tasks else []), "entity")
        .groupBy("entity", "date")
        .agg(*[F.expr(f"{e} AS `{name}`") for name, e in picks.items()])
    )


def _fill_days(by_day: DataFrame, columns: list[str]) -> DataFrame:
    """Add the missing calendar days between the first and last day of each entity, with null columns."""
    ahead = with_exprs(by_day, {"_next": f"lead(date) {over(order='date')}"})
    days = "explode(sequence(date, coalesce(date_sub(_next, 1), date)))"
    filled = [f"CASE WHEN _day = date THEN `{c}` END AS `{c}`" for c in columns]
    return with_exprs(ahead, {"_day": days}).selectExpr("entity", "_day AS date", *filled)


def _daily_picks(catalog: Catalog, extra: str = "") -> dict[str, str]:
    """Statistics of a day, and the moments that later steps combine, from the rows that ``extra`` also allows."""
    awake = "".join(f" AND variable <> {literal(v)}" for v in catalog.static) + f" {extra}"
    picks = {}
    for v in catalog.averaged:
        for stat in ("mean", "max", "min", "first", "last", "n", "var"):
            picks[catalog.column(v, stat)] = _pick(v, stat, extra)
    for v in catalog.summed:
        picks[catalog.column(v, "sum")] = _pick(v, "sum", extra)
    for v in catalog.peaked:
        picks[catalog.column(v, "max")] = _pick(v, "max", extra)
    picks["wake_time_daily"] = f"CAST(min(CASE WHEN true{awake} THEN wake END) AS DOUBLE)"
    picks["_late"] = f"max(CASE WHEN true{awake} THEN late END)"
    picks["_early"] = f"max(CASE WHEN true{awake} THEN early END)"
    return picks


def _tod_picks(catalog: Catalog) -> dict[str, str]:
    cells = [(c.variable, c.stat, c.name) for c in catalog.tod_columns()]
    return {f"_{t}_{name}": _pick(v, stat, f"AND tod = {t}") for t in TODS for v, stat, name in cells}


def _cells(catalog: Catalog) -> str:
    """The time-of-day columns of a day as an array of one struct for each time of day, as SQL text."""
    rows = ", ".join(
        "named_struct('tod', " + ", ".join([str(t)] + [f"'{c.name}', `_{t}_{c.name}`" for c in catalog.tod_columns()]) + ")"
        for t in TODS
    )
    return f"array({rows})"


def _sample_std(n: str, squares: str) -> str:
    return f"CASE WHEN {n} > 1 THEN sqrt(({squares}) / ({n} - 1)) END"


def with_sliding_std(panel: DataFrame, catalog: Catalog, days: int = SLIDE_DAYS) -> DataFrame:
    """Sample deviation of the raw readings of the last ``days`` calendar days, from daily moments.

    The days' means are compared with the common mean, which stays exact for values far from zero.
    """
    moments, centres, spreads = {}, {}, {}
    for v in catalog.averaged:
        n, mean, var = (f"`{catalog.column(v, s)}`" for s in ("n", "mean", "var"))
        for i in range(days):
            back = over(order="date")
            moments[f"_{v}_n{i}"] = f"coalesce(lag({n}, {i}) {back}, 0)"
            moments[f"_{v}_m{i}"] = f"coalesce(lag({mean}, {i}) {back}, 0D)"
            moments[f"_{v}_s{i}"] = f"coalesce(lag({var} * {n}, {i}) {back}, 0D)"
        total = " + ".join(f"`_{v}_n{i}`" for i in range(days))
        weighted = " + ".join(f"`_{v}_n{i}` * `_{v}_m{i}`" for i in range(days))
        centres[f"_{v}_n"] = total
        centres[f"_{v}_m"] = f"({weighted}) / nullif(CAST({total} AS DOUBLE), 0D)"
        squares = " + ".join(
            f"`_{v}_s{i}` + `_{v}_n{i}` * (`_{v}_m{i}` - `_{v}_m`) * (`_{v}_m{i}` - `_{v}_m`)" for i in range(days)
        )
        spreads[catalog.column(v, "std_slide")] = _sample_std(f"`_{v}_n`", squares)
    return with_exprs(with_exprs(with_exprs(panel, moments), centres), spreads)


def daily_panel(readings: DataFrame, catalog: Catalog) -> DataFrame:
    """One row per entity and calendar day between its first and last reading."""
    return daily_from_stats(reading_stats(readings, catalog), catalog, panel_tasks(readings, DAILY_TASK_DAYS))


def daily_from_stats(stats: DataFrame, catalog: Catalog, tasks: int | None = None) -> DataFrame:
    return daily_from_days(_by_day(stats, _daily_picks(catalog), tasks), catalog)


def present_days(readings: DataFrame, catalog: Catalog) -> DataFrame:
    """One row per entity and day with readings, with all that ``daily_from_days`` needs of the day."""
    return _by_day(reading_stats(readings, catalog), _daily_picks(catalog))


def daily_from_days(days: DataFrame, catalog: Catalog) -> DataFrame:
    """The daily panel from present days."""
    return _daily_columns(_fill_days(days, list(_daily_picks(catalog))), catalog)


def _daily_columns(days: DataFrame, catalog: Catalog, *more: str) -> DataFrame:
    """The daily panel's columns, and ``more``, from dense days with picked statistics."""
    base = with_sliding_std(days, catalog)
    derived = {}
    for v in catalog.averaged:
        n, var = (f"`{catalog.column(v, s)}`" for s in ("n", "var"))
        derived[catalog.column(v, "std")] = _sample_std(n, f"{var} * {n}")
    # Hours before 5 of the next calendar day end the evening of this one.
    derived["bed_time_daily"] = f"CAST(coalesce(lead(_early) {over(order='date')}, _late) AS DOUBLE)"
    return with_exprs(base, derived).select("entity", "date", *catalog.names("daily"), *more)


def tod_panel(readings: DataFrame, catalog: Catalog) -> DataFrame:
    """Three rows per entity and calendar day, one for each time of day."""
    return tod_from_stats(reading_stats(readings, catalog, ("tod",)), catalog, panel_tasks(readings))


def tod_from_stats(stats: DataFrame, catalog: Catalog, tasks: int | None = None) -> DataFrame:
    picks = _tod_picks(catalog)
    return _fill_days(_by_day(stats, picks, tasks), list(picks)).selectExpr("entity", "date", f"inline({_cells(catalog)})")


def fused_panel(readings: DataFrame, catalog: Catalog) -> DataFrame:
    """The daily panel with its day's time-of-day rows as ``cells``, an array of one struct for each time of day.

    Both grains come from one pass over the readings and share a row, so nothing has to be joined: daily windows run on this, and
    ``unfold_cells`` then makes the rows of the finer grain in place, still hashed by entity."""
    stats = reading_stats(readings, catalog, ("daily", "tod"))
    picks = {**_daily_picks(catalog, "AND tod IS NULL"), **_tod_picks(catalog)}
    days = _fill_days(_by_day(stats, picks, panel_tasks(readings)), list(picks))
    cells = with_exprs(days, {"cells": _cells(catalog)}).drop(*_tod_picks(catalog))
    return _daily_columns(cells, catalog, "cells")


def unfold_cells(fused: DataFrame) -> DataFrame:
    """One row for each time of day, the day's columns repeated on each."""
    return fused.selectExpr("*", "inline(cells)").drop("cells")


def both_pivot(readings: DataFrame, catalog: Catalog) -> DataFrame:
    """The time-of-day panel with the day's columns repeated on each of its three rows."""
    return unfold_cells(fused_panel(readings, catalog))


def daily_part(both: DataFrame, columns: list[str]) -> DataFrame:
    """One row per entity and day of a panel with three equal daily parts."""
    return both.filter("tod = 0").select("entity", "date", *columns)


def dense_calendar(readings: DataFrame) -> DataFrame:
    """Every date from the first to the last reading of each entity."""
    span = readings.groupBy("entity").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return span.select("entity", F.explode(F.sequence("lo", "hi")).alias("date"))


def dense_tod_grid(readings: DataFrame) -> DataFrame:
    """The calendar with one row per time of day."""
    tods = F.array(*[F.lit(t) for t in TODS])
    return dense_calendar(readings).select("entity", "date", F.explode(tods).alias("tod"))


def trim_observed_span(panel: DataFrame, column: str) -> DataFrame:
    """Keep each entity from the first to the last date with ``column``; none present drops the entity."""
    whole = Window.partitionBy("entity")
    seen = F.when(F.col(column).isNotNull(), F.col("date"))
    return (
        panel.withColumns({"_lo": F.min(seen).over(whole), "_hi": F.max(seen).over(whole)})
        .filter(F.col("date").between(F.col("_lo"), F.col("_hi")))
        .drop("_lo", "_hi")
    )


def trim_override(panel: DataFrame, windows: list[tuple[int, str, str]]) -> DataFrame:
    """Cut single entities to given (entity, start, end) windows; the list comes from the caller.

    A row of a listed entity stays if any of the entity's windows holds its date.
    """
    listed = {entity for entity, _, _ in windows}
    if not listed:
        return panel
    inside = F.lit(False)
    for entity, start, end in windows:
        held = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        inside = inside | ((F.col("entity") == entity) & held)
    return panel.filter(inside | F.col("entity").isNull() | ~F.col("entity").isin(sorted(listed)))


def trim_windows(panel: DataFrame, windows: DataFrame) -> DataFrame:
    """``trim_override`` with a table (entity, start, end) of any size; entities without a window stay whole.

    An entity's windows come together as one list, which is short: it is bounded by the calendar once equal ones are one.
    """
    ends = F.struct(F.col("start").cast("date").alias("start"), F.col("end").cast("date").alias("end"))
    one = windows.groupBy("entity").agg(F.collect_set(ends).alias("_windows"))
    joined = attach_by_entity(panel, one)
    held = F.exists("_windows", lambda w: F.col("date").between(w["start"], w["end"]))
    return joined.filter(F.col("_windows").isNull() | held).select(*panel.columns)
