"""From clean readings to the ready panel: two shuffles for the daily grain.

    readings -> statistics per (entity, date, variable)     shuffle 1, after map-side combining
             -> days hashed by entity                       shuffle 2, daily rows only
             -> dense calendar -> trim -> impute -> features -> next-day target
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from dailypanel.catalog import Catalog
from dailypanel.operators import features as X
from dailypanel.operators.impute import impute_all
from dailypanel.operators.panel import (
    daily_panel,
    fused_panel,
    tod_panel,
    trim_observed_span,
    trim_override,
    unfold_cells,
)


def trim(panel: DataFrame, catalog: Catalog, overrides=(), grain: str = "daily") -> DataFrame:
    """Cut a panel to the span in which the target variable was observed, and further by the overrides."""
    observed = catalog.column(catalog.target, "mean", grain)
    return trim_override(trim_observed_span(panel, observed), list(overrides))


def trimmed_panel(readings: DataFrame, catalog: Catalog, overrides=(), grain: str = "daily") -> DataFrame:
    panel = daily_panel(readings, catalog) if grain == "daily" else tod_panel(readings, catalog)
    return trim(panel, catalog, overrides, grain)


def daily_features(trimmed: DataFrame, catalog: Catalog, span: int = X.SPAN) -> DataFrame:
    """Imputed daily panel with quadrant, sleep, changes, smoothed columns and the class target.

    Sleep comes first because it repairs bed hours that changes and smoothing use.
    """
    panel = impute_all(trimmed, catalog)
    panel = X.add_sleep(X.add_quadrant(panel, catalog))
    panel = X.add_changes(panel, catalog.level_columns("daily"))
    panel = X.add_ewma(panel, catalog.smoothed_columns("daily"), span)
    return X.add_class_target(panel, catalog, span=span)


def tod_features(trimmed: DataFrame, catalog: Catalog, span: int = X.SPAN) -> DataFrame:
    panel = X.add_quadrant(impute_all(trimmed, catalog, "tod"), catalog, "tod")
    panel = X.add_changes(panel, catalog.level_columns("tod"), "tod")
    return X.add_ewma(panel, catalog.smoothed_columns("tod"), span, "tod")


def ready_panel(
    readings: DataFrame, catalog: Catalog, overrides=(), span: int = X.SPAN, trimmed: bool = True
) -> DataFrame:
    """The daily chain: one row per entity and day that has a next day."""
    panel = daily_panel(readings, catalog)
    if trimmed:
        panel = trim(panel, catalog, overrides)
    panel = daily_features(panel, catalog, span)
    panel = X.wrap_bed(X.encode_calendar(X.add_calendar(panel)))
    return X.add_next_day(panel, catalog.column(catalog.target, "mean"))


def both_panel(
    readings: DataFrame, catalog: Catalog, overrides=(), span: int = X.SPAN, trimmed: bool = True
) -> DataFrame:
    """Three rows per day with time-of-day features, the day's features repeated on each.

    A day carries its time-of-day rows until its own windows are done, so the grains are never joined. Both have a value on the same days, so one
    trim does for both. The next-day target is taken on the daily side: on dense calendars that is three rows ahead here.
    """
    fused = fused_panel(readings, catalog)
    if trimmed:
        fused = trim(fused, catalog, overrides)
    daily = X.add_next_day(daily_features(fused, catalog, span), catalog.column(catalog.target, "mean"), drop=False)
    panel = tod_features(unfold_cells(daily), catalog, span)
    panel = X.wrap_bed(X.encode_calendar(X.add_calendar(panel)))
    return panel.na.drop(subset=["target", "next_date"])
