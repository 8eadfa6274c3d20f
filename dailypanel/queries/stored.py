"""What is written and read again is what was there: panels, tables, results."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dailypanel.operators import evaluate as V
from dailypanel.operators import panel as P
from dailypanel.queries import bindings as B
from dailypanel.queries import evaluations as E
from dailypanel.queries import sql as S
from dailypanel.queries.registry import ORACLES, D, query, tidy
from dailypanel.session import ensure_checkpoint_dir
from dailypanel.sources import readings as I
from dailypanel.sources import results as O
from dailypanel.sources import upkeep as K

PANEL = f"{S.upto('daily')} SELECT entity, {D}, {S.rounded(S.DAILY_COLUMNS)} FROM panel"


def place(spark, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query("stored_panel", PANEL)
def stored_panel(spark, sf):
    """A panel that is built and written at first and only read from then on."""
    path = place(spark, "panel")
    O.stored_panel(spark, path, lambda: P.daily_panel(B.clean(spark, sf), B.CATALOG))
    return tidy(O.stored_panel(spark, path, lambda: P.daily_panel(B.clean(spark, sf).limit(0), B.CATALOG)))


@query("upkept_panel", PANEL)
def upkept_panel(spark, sf):
    """A panel kept up to date: built without its last day and without a third of the readings of another, which are appended later."""
    source, store, readings = place(spark, "readings"), place(spark, "store"), B.readings(spark, sf)
    first, last = readings.agg(F.min("date"), F.max("date")).first()
    late = F.coalesce((F.col("date") == F.lit(last)) | (F.date_diff("date", F.lit(first)) == 9) & (F.col("entity") % 3 == 0), F.lit(False))
    I.write_readings(readings.filter(~late), source)
    K.update_panel(spark, source, store, B.CATALOG, lambda some: I.drop_negative(some, B.CATALOG.signed))
    I.append_readings(readings.filter(late), source)
    panel = K.upkept_panel(spark, source, store, B.CATALOG, lambda some: I.drop_negative(some, B.CATALOG.signed))
    return tidy(panel.select("entity", "date", *B.CATALOG.names("daily")))


@query("csv_panel", PANEL)
def csv_panel(spark, sf):
    path, panel = place(spark, "csv"), P.daily_panel(B.clean(spark, sf), B.CATALOG)
    O.write_csv(panel, path)
    return tidy(O.read_csv(spark, path, panel.schema))


@query("csv_readings", ORACLES["load_readings"])
def csv_readings(spark, sf):
    """Readings from a CSV with text ids, by way of the parquet copy that later runs read."""
    source, copy = place(spark, "readings"), place(spark, "copy")
    B.raw_readings(spark, sf).select("seq", "id", "time", "variable", "value").write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(source, header=True)
    return tidy(I.stored_readings(spark, source, copy).select("entity", "ts", "seq", "variable", "value", "date", "hour", "tod"))


@query("ordered_panel", f"{S.upto('daily')} SELECT entity, {D}, row_number() OVER (ORDER BY date, entity) AS place FROM panel")
def ordered_panel(spark, sf):
    """Files in order and sorted inside: a row's place follows from its file's number and its place in the file."""
    path = place(spark, "ordered")
    O.write_ordered(P.daily_panel(B.clean(spark, sf), B.CATALOG).select("entity", "date"), path, ["date", "entity"])
    name, at = F.input_file_name(), F.monotonically_increasing_id()
    rows = spark.read.parquet(path).select("entity", "date", F.regexp_extract(name, r"part-(\d+)", 1).cast("int").alias("file"), at.alias("at"))
    inside = F.expr("row_number() OVER (PARTITION BY file ORDER BY at)")
    before = rows.groupBy("file").agg(F.count("*").alias("n")).selectExpr("file", "sum(n) OVER (ORDER BY file) - n AS before")
    return tidy(rows.withColumn("inside", inside).join(before, "file").selectExpr("entity", "date", "CAST(before + inside AS BIGINT) AS place"))


@query("stored_metrics", ORACLES["regression_metrics"])
def stored_metrics(spark, sf):
    path, metrics = place(spark, "metrics"), V.regression_metrics(E.predictions(spark, sf), ["model", "split"])
    O.write_metrics(metrics, path)
    return tidy(spark.read.schema(metrics.schema).json(path))


@query("appended_results", ORACLES["experiment_results"])
def appended_results(spark, sf):
    """Results of two runs in one table."""
    path, results = place(spark, "results"), E.experiments(spark, sf)
    for part in ("dataset < 2", "dataset >= 2"):
        O.append_results(results.filter(part), path)
    return spark.read.parquet(path)


@query("stored_predictions", f"{E.WITH_PREDICTIONS}, {E.ONE_MODEL} SELECT entity, {D}, {S.rounded(['actual', 'predicted'])} FROM p")
def stored_predictions(spark, sf):
    path = place(spark, "predictions")
    O.write_predictions(E.persistence(spark, sf), path)
    return tidy(spark.read.parquet(path))
