"""Features on an imputed panel: all windows of one entity, so no shuffle beyond the panel's own."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.catalog import Catalog
from dailypanel.fixed import CLASS_WIDTH, EVENING_HOURS, MONTHS, QUADRANTS, SPAN, TODS, WEEKDAYS
from dailypanel.functions import expressions as E
from dailypanel.functions.wide import SO_FAR, order_of, over, with_exprs

def add_quadrant(panel: DataFrame, catalog: Catalog, grain: str = "daily") -> DataFrame:
    """Quadrant of mean valence and arousal as 0/1 columns, the lowest code left out."""
    code = E.quadrant(
        F.col(catalog.column(catalog.valence, "mean", grain)),
        F.col(catalog.column(catalog.arousal, "mean", grain)),
    )
    coded = panel.withColumn("_quadrant", code)
    return with_exprs(coded, E.dummies("_quadrant", f"quadrant_{grain}", QUADRANTS)).drop("_quadrant")


def add_sleep(panel: DataFrame) -> DataFrame:
    """Hours slept before each day, and repaired bed hours.

    The first day gets the mean of the other days. A night of no positive length comes from interpolating
    clock hours across midnight: it gets the mean too, and the bed hour before it becomes wake minus mean.
    There is no wrap from the first row to the last one.
    """
    days = over(order="date")
    timed = with_exprs(panel, {"_before": f"lag(bed_time_daily) {days}"})
    evening = " AND ".join(str(h) for h in EVENING_HOURS)
    night = f"""CASE WHEN _before BETWEEN {evening} THEN 24 - _before + wake_time_daily
      ELSE wake_time_daily - _before END"""
    timed = with_exprs(timed, {"_night": night})
    timed = with_exprs(
        timed,
        {
            "_usual": f"avg(_night) {over()}",
            "_next": f"lead(_night) {days}",
            "_next_wake": f"lead(wake_time_daily) {days}",
        },
    )
    repaired = {
        "bed_time_daily": "CASE WHEN _next <= 0 THEN _next_wake - _usual ELSE bed_time_daily END",
        "sleep_daily": "CASE WHEN _night > 0 THEN _night ELSE _usual END",
    }
    return with_exprs(timed, repaired).drop("_before", "_night", "_usual", "_next", "_next_wake")


def add_changes(panel: DataFrame, columns: list[str], grain: str = "daily") -> DataFrame:
    """Difference to the previous row; 0 on the first row."""
    rows = over(order=order_of(grain))
    return with_exprs(panel, {f"change_{c}": f"coalesce(`{c}` - lag(`{c}`) {rows}, 0D)" for c in columns})


def add_ewma(panel: DataFrame, columns: list[str], span: int = SPAN, grain: str = "daily") -> DataFrame:
    """Exponentially weighted mean with adjusted weights, a = 2/(span+1).

    Every row counts with decay^age, however old it is. Sums run inside blocks of rows. A block with values carries on its total and that of
    the last such block before it, however far back; all before that weighs less than 1e-100 of it, which no double shows. So the cost per
    row depends neither on the span nor on the length of the panel. A missing value has no weight but time passes: the mean stays what it
    was before, and a row before the first value has none.
    """
    if span <= 1:
        last = over(order=order_of(grain), frame=SO_FAR)
        return with_exprs(panel, {f"ewma{span}_{c}": f"last_value(CAST(`{c}` AS DOUBLE), true) {last}" for c in columns})
    decay = 1 - 2 / (span + 1)
    # powers inside a block stay far from the ends of the double range
    block = max(2, math.ceil(-math.log(1e100) / math.log(decay)))
    framed = with_exprs(panel, {"_row": f"row_number() {over(order=order_of(grain))} - 1"})
    framed = with_exprs(framed, {"_block": f"_row DIV {block}", "_at": f"_row % {block}"})
    framed = with_exprs(framed, {"_rise": f"pow({decay}D, -_at)", "_age": f"pow({decay}D, _at)"})
    inside = over("entity, _block", "_row", SO_FAR)
    earlier = over(order="_row", frame="ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    sums, ends, carried, means = {}, {}, {}, []
    for i, c in enumerate(columns):
        sums[f"_sum{i}"] = f"sum(`{c}` * _rise) {inside}"
        sums[f"_mass{i}"] = f"sum(CASE WHEN `{c}` IS NOT NULL THEN _rise END) {inside}"
        filled = f"_at = {block - 1} AND _mass{i} IS NOT NULL"
        total = f"named_struct('block', _block, 'sum', _sum{i} * _age, 'mass', _mass{i} * _age)"
        ends[f"_end{i}"] = f"last_value(CASE WHEN {filled} THEN {total} END, true) {earlier}"
        faded = f"pow({decay}D, {block} * (_block - _end{i}.block))"
        both = ", ".join(f"'{x}', _{x}{i} * _age + coalesce({faded} * _end{i}.{x}, 0D)" for x in ("sum", "mass"))
        carried[f"_past{i}"] = f"last_value(CASE WHEN {filled} THEN named_struct('block', _block, {both}) END, true) {earlier}"
        faded = f"pow({decay}D, {block} * (_block - _past{i}.block - 1) + _at + 1)"
        now, mass = (f"_{x}{i} * _age + coalesce({faded} * _past{i}.{x}, 0D)" for x in ("sum", "mass"))
        means.append(f"CASE WHEN _mass{i} IS NULL THEN _past{i}.sum / _past{i}.mass ELSE ({now}) / ({mass}) END AS `ewma{span}_{c}`")
    framed = with_exprs(with_exprs(with_exprs(framed, sums), ends), carried)
    return framed.selectExpr(*[f"`{c}`" for c in panel.columns], *means)


def add_class_target(
    panel: DataFrame, catalog: Catalog, width: float = CLASS_WIDTH, span: int = SPAN
) -> DataFrame:
    """Next change of the target: 1 above, -1 below, 0 within ``width`` smoothed daily deviations."""
    change = f"change_{catalog.column(catalog.target, 'mean')}"
    edge = f"ewma{span}_{catalog.column(catalog.target, 'std')}"
    ahead = with_exprs(panel, {"_change": f"lead(`{change}`) {over(order='date')}"})
    return with_exprs(ahead, {"categorical_target": class_of("_change", f"`{edge}`", width)}).drop("_change")


def class_of(change: str, edge: str, width: float = CLASS_WIDTH) -> str:
    """Class of a change, as SQL text; a change on the edge is 0, a missing side has no class."""
    return f"""CASE WHEN {change} > {width}D * {edge} THEN 1D WHEN {change} < -{width}D * {edge} THEN -1D
      WHEN {change} IS NOT NULL AND {edge} IS NOT NULL THEN 0D END"""


def add_calendar(panel: DataFrame) -> DataFrame:
    """Month and weekday, Monday being 0."""
    return with_exprs(panel, {"month": "month(date)", "weekday": "weekday(date)"})


def encode_calendar(panel: DataFrame, months=MONTHS, weekdays=WEEKDAYS) -> DataFrame:
    """0/1 columns for month, weekday and, if present, time of day; the number of the latter is kept."""
    flags = {**E.dummies("month", "month", months), **E.dummies("weekday", "weekday", weekdays)}
    if "tod" in panel.columns:
        flags = {"tod_number": "tod", **flags, **E.dummies("tod", "tod", TODS)}
    return with_exprs(panel, flags).drop("month", "weekday", "tod")


def wrap_bed(panel: DataFrame) -> DataFrame:
    return panel.withColumn("bed_time_daily", E.wrapped_bed(F.col("bed_time_daily")))


def add_next_day(panel: DataFrame, column: str, grain: str = "daily", drop: bool = True) -> DataFrame:
    """Target and date of the next day; rows without one are dropped.

    On the three rows a day of the time-of-day panel the next day is three rows ahead.
    """
    step = 1 if grain == "daily" else len(TODS)
    rows = over(order=order_of(grain))
    added = with_exprs(
        panel, {"target": f"lead(`{column}`, {step}) {rows}", "next_date": f"lead(date, {step}) {rows}"}
    )
    return added.na.drop(subset=["target", "next_date"]) if drop else added


def family_sum(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Row-wise sum of a column family, missing counting as 0; the members are dropped."""
    parts = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    return df.withColumn(name, reduce(Column.__add__, parts)).drop(*columns)


def class_remap(column: Column, mapping: dict) -> Column:
    """Recode by a mapping; anything not listed becomes null."""
    coded = [F.when(column == old, new) for old, new in mapping.items()]
    return F.coalesce(*coded)
