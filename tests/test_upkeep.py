"""A panel that follows its readings is the one built anew, and does no more than it must."""

import datetime as dt

import pytest

from dailypanel.catalog import Catalog
from dailypanel.operators.panel import daily_panel
from dailypanel.sources import readings as S
from dailypanel.sources import upkeep as K
from dailypanel.sources.files import remove

CATALOG = Catalog(averaged=("mood",), summed=("screen",), static=())
SIGNED = ("mood",)


def rows(*days, entity=1, value=1.0):
    at = [dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h) for d in days for h in (2, 9, 22)]
    return [(entity, t, i, ("mood", "screen")[i % 2], value + 0.37 * t.day + i) for i, t in enumerate(at)]


def table(spark, data):
    return S.with_time_columns(spark.createDataFrame(data, "entity long, ts timestamp_ntz, seq long, variable string, value double"))


def prepare(some):
    return S.drop_negative(some, SIGNED)


def check(spark, source, store):
    done = K.update_panel(spark, source, store, CATALOG, prepare)
    got = spark.read.parquet(f"{store}/panel").drop("panel_month")
    want = daily_panel(prepare(spark.read.parquet(source)), CATALOG).select(*got.columns)
    key = ["entity", "date"]
    a, b = (df.orderBy(*key).toPandas() for df in (got, want))
    assert len(a) == len(b)
    assert a[key].equals(b[key])
    for c in got.columns[2:]:
        assert a[c].tolist() == pytest.approx(b[c].tolist(), rel=1e-12, nan_ok=True), c
    assert K.update_panel(spark, source, store, CATALOG, prepare) == ([], [])
    return done


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_panel_follows_its_readings(spark, tmp_path):
    source, store = str(tmp_path / "readings"), str(tmp_path / "store")
    S.write_readings(table(spark, rows(0, 1, 4, 70, 71, entity=1) + rows(*range(0, 100, 3), entity=2) + rows(150, entity=3)), source)
    check(spark, source, store)
    # a new last day of one entity touches the end only
    S.append_readings(table(spark, rows(102, entity=2)), source)
    done = check(spark, source, store)
    assert done.dates == [day(102)] and done.months == [dt.date(2024, 4, 1)]
    # late rows inside a gap of months reach all of the gap, and those of a new entity their own month
    S.append_readings(table(spark, rows(40, entity=1) + rows(40, entity=None)), source)
    done = check(spark, source, store)
    assert done.dates == [day(40)] and done.months == [dt.date(2024, m, 1) for m in (1, 2, 3)]
    # two far changes at once, one of them of an entity that comes back after a long time
    S.append_readings(table(spark, rows(0, entity=4) + rows(200, entity=3, value=5.0)), source)
    done = check(spark, source, store)
    assert done.dates == [day(0), day(200)] and dt.date(2024, 2, 1) not in done.months


def test_dates_that_go_and_updates_that_break_off(spark, tmp_path):
    source, store = str(tmp_path / "readings"), str(tmp_path / "store")
    S.write_readings(table(spark, rows(0, 1, 2, entity=1) + rows(95, 96, entity=1) + rows(31, entity=2)), source)
    check(spark, source, store)
    # the last days go, and with them the months since; a date whose rows are all refused is as good as gone
    for d in (95, 96):
        remove(spark, f"{source}/date={day(d)}")
    remove(spark, f"{source}/date={day(31)}")
    bad = [(2, dt.datetime.combine(day(31), dt.time(9)), 0, "screen", -1.0)]
    S.append_readings(table(spark, bad), source)
    done = check_once(spark, source, store)
    assert dt.date(2024, 4, 1) in done.months
    # a panel that was cut off while it was written is made anew from the days
    S.append_readings(table(spark, rows(5, entity=7)), source)
    remove(spark, f"{store}/manifest")
    done = check_once(spark, source, store)
    assert day(5) in done.dates and day(0) not in done.dates


def check_once(spark, source, store):
    done = K.update_panel(spark, source, store, CATALOG, prepare)
    got = spark.read.parquet(f"{store}/panel").drop("panel_month")
    want = daily_panel(prepare(spark.read.parquet(source)), CATALOG).select(*got.columns)
    assert got.count() == want.count() and got.select("entity", "date").exceptAll(want.select("entity", "date")).count() == 0
    return done


def test_untouched_days_are_not_read(spark, tmp_path):
    source = str(tmp_path / "readings")
    S.write_readings(table(spark, rows(*range(60))), source)
    plan = K.input_stamps(spark, source)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    days = spark.read.parquet(source)
    assert K._runs([day(3), day(1), day(2), day(9)]) == [(day(1), day(3)), (day(9), day(9))]
    near = days.filter(K._within([(day(10), day(12))], 2, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in near and "2024-01-09" in near
