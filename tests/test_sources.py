"""Readers and writers in a scratch folder."""

import datetime as dt
import os

from pyspark.sql import functions as F

from dailypanel.catalog import Catalog
from dailypanel.plans import ready as R
from dailypanel.queries import bindings as B
from dailypanel.sources import readings as S
from dailypanel.sources import results as O

CSV = """,id,time,variable,value
1,user.01,2014-02-26 13:00:00.000,mood,6.0
2,user.01,2014-02-26 15:00:00.000,mood,NA
3,user.12,2014-02-27 03:30:00.000,circumplex.valence,-1.0
4,broken,2014-02-27 18:00:00.000,screen,2.5
"""
MORE = CSV + "5,user.12,2014-02-27 18:00:00.000,screen,2.5\n"


def csv(tmp_path):
    path = tmp_path / "readings.csv"
    path.write_text(CSV)
    return str(path)


def test_csv(spark, tmp_path):
    rows = S.read_readings_csv(spark, csv(tmp_path)).orderBy("seq").collect()
    # the row without a readable id is left to the audit
    assert [r["entity"] for r in rows] == [1, 1, 12]
    assert [r["value"] for r in rows] == [6.0, None, -1.0]
    assert [r["tod"] for r in rows] == [1, 1, 0]
    assert rows[2]["date"] == dt.date(2014, 2, 27) and rows[2]["hour"] == 3


def test_converted_once(spark, tmp_path):
    source, target = csv(tmp_path), str(tmp_path / "stored")
    first = S.stored_readings(spark, source, target).count()
    (tmp_path / "readings.csv").write_text("")
    os.utime(source, (1, 1))  # an older file changes nothing
    again = S.stored_readings(spark, source, target)
    assert first == again.count() == 3
    plan = again.filter(F.col("date") == "2014-02-26")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_panel_round_trip(spark, small, tmp_path):
    panel = R.ready_panel(B.clean(spark, small), B.CATALOG)
    path = str(tmp_path / "panel")
    stored = O.stored_panel(spark, path, lambda: panel)
    assert stored.exceptAll(panel.select(*stored.columns)).count() == 0 and stored.count() == panel.count()
    assert O.stored_panel(spark, path, lambda: 1 / 0).count() == panel.count()
    flat = panel.select("entity", "date", "target")
    O.write_csv(flat, str(tmp_path / "csv"))
    assert O.read_csv(spark, str(tmp_path / "csv"), "entity bigint, date date, target double").count() == flat.count()


def test_metrics_and_predictions(spark, tmp_path):
    metrics = spark.createDataFrame([("ridge", "test", 0.5)], "model string, split string, r2 double")
    O.write_metrics(metrics, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).first()["r2"] == 0.5
    for _ in range(2):
        O.append_results(metrics, str(tmp_path / "results"))
    assert spark.read.parquet(str(tmp_path / "results")).count() == 2
    predictions = spark.createDataFrame([(1, 5.0, 4.0, 1), (1, 6.0, 5.0, 2)], "entity bigint, actual double, predicted double, row int")
    O.write_predictions(predictions, str(tmp_path / "predictions"))
    assert set(spark.read.parquet(str(tmp_path / "predictions")).columns) == {"entity", "actual", "predicted"}
    dated = O.sequence_dates(predictions, "row").orderBy("row").collect()
    assert [r["date"] for r in dated] == [dt.date(2023, 1, 1), dt.date(2023, 1, 2)]


def test_discovered_catalog(spark, tmp_path):
    (tmp_path / "readings.csv").write_text(MORE)
    found = Catalog.discover(
        S.read_readings_csv(spark, str(tmp_path / "readings.csv")), averaged=("mood", "circumplex.valence"), valence="circumplex.valence"
    )
    assert found.summed == ("screen",)
    assert "circumplex_valence_mean_daily" in found.names("daily")
