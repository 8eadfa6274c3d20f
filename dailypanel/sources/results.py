"""Panels, predictions and metrics on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailypanel.fixed import BASE_DATE
from dailypanel.functions.wide import over, with_exprs
from dailypanel.sources.files import completed_at

def write_panel(panel: DataFrame, path: str, whole: bool = True) -> None:
    """Partitioned by month; rows of an entity lie together inside a file. Unless ``whole``, months without rows in ``panel`` stay as they are."""
    dated = panel.withColumn("panel_month", F.date_trunc("month", "date").cast("date"))
    dated.hint("rebalance", "panel_month").sortWithinPartitions("panel_month", "entity", "date").write.mode("overwrite").option(
        "partitionOverwriteMode", "static" if whole else "dynamic"
    ).partitionBy("panel_month").parquet(path)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("panel_month")


def stored_panel(spark: SparkSession, path: str, build) -> DataFrame:
    """Read a stored panel; build and write it if it is not there or not complete."""
    if completed_at(spark, path) is None:
        write_panel(build(), path)
    return read_panel(spark, path)


def write_ordered(df: DataFrame, path: str, order: list[str]) -> None:
    """Parquet whose files follow each other in ``order`` and are sorted inside: ranges are dealt out, so no task sorts everything."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def append_results(results: DataFrame, path: str) -> None:
    """Add rows to a results table."""
    results.write.mode("append").parquet(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Columns entity, actual, predicted and, if known, date."""
    columns = [c for c in ("entity", "date", "actual", "predicted") if c in predictions.columns]
    predictions.select(*columns).write.mode("overwrite").parquet(path)


def sequence_dates(predictions: DataFrame, order: str) -> DataFrame:
    """Dates for predictions that have none: consecutive days per entity in the given row order."""
    place = f"row_number() {over(order=order)} - 1"
    return with_exprs(predictions, {"date": f"date_add(DATE '{BASE_DATE}', {place})"})
