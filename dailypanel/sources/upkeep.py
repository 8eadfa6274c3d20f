"""A stored daily panel that follows its readings: only touched dates are read again, and only months they reach are written again.

Three things lie in the store. ``days`` has one row per entity and day with readings, in a folder per date; a row is stamped with the state
of the date's input files, and counts only while that is still their state. ``panel`` is the dense panel by month. ``manifest`` lists the dates and stamps
that the panel was made from; it goes before the panel is touched and comes back last, so an update that was cut off is made up for
by making the panel anew from the days.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailypanel.catalog import Catalog
from dailypanel.fixed import SLIDE_DAYS
from dailypanel.functions.wide import over, with_exprs
from dailypanel.operators.lookup import settle
from dailypanel.operators.panel import daily_from_days, present_days
from dailypanel.sources.files import completed_at, exists, remove
from dailypanel.sources.results import read_panel, write_panel

#: Days after a touched one whose sliding deviation it is in, and days before it whose evening it ends.
AFTER, BEFORE = SLIDE_DAYS - 1, 1


class Update(NamedTuple):
    """What an update read and wrote again."""

    dates: list[dt.date]
    months: list[dt.date]


def input_stamps(spark: SparkSession, path: str) -> DataFrame:
    """(date, stamp) of readings in date folders: names, sizes and times of the date's files. No column of the files is read."""
    file = [F.col(f"_metadata.{c}") for c in ("file_name", "file_size", "file_modification_time")]
    files = spark.read.parquet(path).select("date", F.xxhash64(*file).alias("file")).distinct()
    return files.groupBy("date").agg(F.concat_ws("-", F.count("file"), F.hex(F.bit_xor("file"))).alias("stamp"))


def _by_date(stamps: DataFrame) -> dict[dt.date, str]:
    """To the driver: one entry per calendar date."""
    return {r["date"]: r["stamp"] for r in stamps.collect()}


def _runs(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """First and last days of the runs of consecutive days."""
    runs: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if runs and day - runs[-1][1] <= dt.timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


def _within(runs: list[tuple[dt.date, dt.date]], early: int = 0, late: int = 0) -> Column:
    return _any([F.col("date").between(F.lit(lo - dt.timedelta(days=early)), F.lit(hi + dt.timedelta(days=late))) for lo, hi in runs])


def _month_runs(months: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    ends = [((m + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)) for m in months]
    return _runs([m + dt.timedelta(days=k) for m, end in zip(months, ends) for k in range((end - m).days + 1)])


def reached_months(present: DataFrame, touched: DataFrame) -> list[dt.date]:
    """First days of the months whose panel rows may differ. ``touched`` are the (entity, date) with readings before or after the change.

    A day reaches from the day with readings before it to the one after it, because it may have opened or closed the calendar between them, and
    as far as the windows go."""
    marked = present.select("entity", "date", F.lit(False).alias("_new")).union(touched.select("entity", "date", F.lit(True)))
    rows = marked.groupBy("entity", "date").agg(F.max("_new").alias("_new"))
    order = over(order="date")
    reach = with_exprs(rows, {"_lo": f"coalesce(lag(date) {order}, date)", "_hi": f"coalesce(lead(date) {order}, date)"}).filter("_new")
    ends = f"trunc(date_sub(_lo, {BEFORE}), 'MM'), trunc(date_add(_hi, {AFTER}), 'MM'), interval 1 month"
    return sorted(r["month"] for r in reach.selectExpr(f"explode(sequence({ends})) AS month").distinct().collect())


def panel_of_months(days: DataFrame, catalog: Catalog, months: list[dt.date]) -> DataFrame:
    """The rows of ``daily_from_days`` in the given months.

    Whole days are read near these months only. Of the others, the two columns that tell the calendar are, and of them stay those between which a month
    lies."""
    runs = _month_runs(months)
    near = _within(runs, AFTER, BEFORE)
    order = over(order="date")
    present = with_exprs(days.select("entity", "date"), {"_lo": f"coalesce(lag(date) {order}, date)", "_hi": f"coalesce(lead(date) {order}, date)"})
    spans = _any([(F.col("_hi") >= F.lit(lo)) & (F.col("_lo") <= F.lit(hi)) for lo, hi in runs])
    ends = present.filter(spans & ~near).select("entity", "date")
    rows = days.filter(near).unionByName(ends, allowMissingColumns=True)
    return daily_from_days(rows.repartition("entity"), catalog).filter(_within(runs))


def update_panel(
    spark: SparkSession, readings_path: str, store: str, catalog: Catalog, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> Update:
    """Bring the daily panel in ``store`` up to the readings in date folders at ``readings_path``; equal to building it anew.

    ``prepare`` is applied to the readings of touched dates; it must treat each date by itself, and use a new store if it changes. Dates may be new, have
    more or fewer rows, or be gone, all but one. A changed catalog touches every date.
    """
    plan = hashlib.md5(repr(catalog).encode()).hexdigest()[:8]
    now = {date: f"{stamp}-{plan}" for date, stamp in _by_date(input_stamps(spark, readings_path)).items()}
    days_path, panel_path, manifest_path = (f"{store}/{name}" for name in ("days", "panel", "manifest"))
    readings = spark.read.parquet(readings_path)
    stamps = spark.createDataFrame(sorted(now.items()), "date date, stamp string")

    def days_of(dates: list[dt.date]) -> DataFrame:
        some = readings.filter(_within(_runs(dates)) & F.col("date").isin(dates))
        return present_days(prepare(some) if prepare else some, catalog).join(F.broadcast(stamps), "date")

    schema = days_of([]).schema

    def stored_days(stamped: DataFrame | None) -> DataFrame:
        stored = spark.read.schema(schema).parquet(days_path)
        return stored.join(F.broadcast(stamped), ["date", "stamp"]) if stamped else stored

    old = None
    if completed_at(spark, manifest_path) is not None:
        old = _by_date(spark.read.parquet(manifest_path))
    touched = sorted(d for d in {*now, *(old or {})} if old is None or now.get(d) != old.get(d))
    if not touched and old is not None:
        return Update([], [])
    # a write of single folders leaves no mark of its end; the stamps tell which rows count
    there = exists(spark, days_path)
    made = {(r["date"], r["stamp"]) for r in stored_days(None).select("date", "stamp").distinct().collect()} if there else set()
    again = sorted(d for d, stamp in now.items() if (d, stamp) not in made and d in set(touched))
    before = None
    if old is not None:
        was = spark.createDataFrame(sorted(old.items()), "date date, stamp string")
        before = settle(stored_days(was).filter(F.col("date").isin(touched)).select("entity", "date"))
    remove(spark, manifest_path)
    if again or not there:
        days_of(again).hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(days_path)
    days = stored_days(stamps)
    if old is None:
        write_panel(daily_from_days(days.repartition("entity"), catalog), panel_path)
        months = sorted({d.replace(day=1) for d in now})
    else:
        after = days.filter(F.col("date").isin(touched)).select("entity", "date")
        months = reached_months(days, before.union(after))
        if months:
            write_panel(panel_of_months(days, catalog, months), panel_path, whole=False)
            for month in set(months) - _written(days, months):
                remove(spark, f"{panel_path}/panel_month={month}")
    stamps.coalesce(1).write.mode("overwrite").parquet(manifest_path)
    return Update(again, months)


def _written(days: DataFrame, months: list[dt.date]) -> set[dt.date]:
    """Those of the months that lie in some entity's calendar."""
    spans = days.groupBy("entity").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    held = spans.selectExpr("explode(sequence(trunc(lo, 'MM'), trunc(hi, 'MM'), interval 1 month)) AS month").distinct()
    return {r["month"] for r in held.filter(F.col("month").isin(months)).collect()}


def upkept_panel(
    spark: SparkSession, readings_path: str, store: str, catalog: Catalog, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The stored daily panel, brought up to date first."""
    update_panel(spark, readings_path, store, catalog, prepare)
    return read_panel(spark, f"{store}/panel")
