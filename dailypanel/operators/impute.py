"""Filling gaps per entity.

Every fill is a window over one entity's panel rows, so the entity partitioning of the panel is reused and
nothing is shuffled. A panel has at most one (daily) or three (time of day) rows per calendar day, which
bounds each window by the calendar, not by the number of readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailypanel.catalog import Catalog
from dailypanel.fixed import TODS
from dailypanel.functions.wide import SO_FAR, over, with_exprs
from dailypanel.operators.quantiles import exact_quantiles


def fill_zero(panel: DataFrame, columns: list[str]) -> DataFrame:
    return panel.na.fill(0.0, columns) if columns else panel


def fill_mean(panel: DataFrame, columns: list[str]) -> DataFrame:
    return with_exprs(panel, {c: f"coalesce(`{c}`, avg(`{c}`) {over()})" for c in columns})


def fill_entity_median(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Median of the entity, the middle of two for an even number of values."""
    return with_exprs(panel, {c: f"coalesce(`{c}`, median(CAST(`{c}` AS DOUBLE)) {over()})" for c in columns})


def fill_mode(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent value of the entity, the smallest one on ties."""
    return with_exprs(panel, {c: f"coalesce(`{c}`, mode(`{c}`, true) {over()})" for c in columns})


def fill_linear(panel: DataFrame, columns: list[str], grain: str = "daily") -> DataFrame:
    """Straight line between known neighbours, flat at the edges; an entity without values stays null.

    The neighbour after a row is found by a running window in descending order: a frame that looks ahead
    would visit every following row again.
    """
    day = "CAST(unix_date(date) AS DOUBLE)"
    framed = with_exprs(panel, {"_pos": day if grain == "daily" else f"{day} * {len(TODS)} + tod"})

    def known(c: str, order: str) -> str:
        point = f"CASE WHEN `{c}` IS NOT NULL THEN struct(_pos AS p, `{c}` AS v) END"
        return f"last({point}, true) {over(order=order, frame=SO_FAR)}"

    framed = with_exprs(framed, {f"_b_{c}": known(c, "_pos") for c in columns})
    framed = with_exprs(framed, {f"_a_{c}": known(c, "_pos DESC") for c in columns})
    filled = {c: _on_line(f"`{c}`", f"`_b_{c}`", f"`_a_{c}`") for c in columns}
    return framed.selectExpr(*[f"{filled[c]} AS `{c}`" if c in filled else f"`{c}`" for c in panel.columns])


def _on_line(x: str, before: str, after: str) -> str:
    """Value on the line between two (p, v) neighbours, or the one neighbour there is."""
    line = f"{before}.v + ({after}.v - {before}.v) * (_pos - {before}.p) / ({after}.p - {before}.p)"
    return f"coalesce({x}, CASE WHEN {before} IS NULL THEN {after}.v WHEN {after} IS NULL THEN {before}.v ELSE {line} END)"


def impute_all(panel: DataFrame, catalog: Catalog, grain: str = "daily") -> DataFrame:
    """Zero, mean, median, mode and linear fills, each for the columns the catalogue names."""
    panel = fill_zero(panel, catalog.names(grain, "zero"))
    for fill, build in (("mean", fill_mean), ("median", fill_entity_median)):
        names = catalog.names(grain, fill)
        panel = build(panel, names) if names else panel
    panel = fill_mode(panel, catalog.names(grain, "mode"))
    return fill_linear(panel, catalog.names(grain, "linear"), grain)


def fill_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact column medians; one number per column comes to the driver."""
    medians = {
        r["variable"]: r["value"] for r in exact_quantiles(df, columns, [0.5]).collect()
    }
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)).cast("double")) for c in columns}
    )


def null_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of missing values of every column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "variable", "n_missing")
