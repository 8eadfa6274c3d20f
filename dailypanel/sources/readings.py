"""Long readings: reading, cleaning up types, derived time columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailypanel.functions.expressions import tod_band
from dailypanel.sources.files import changed_at, completed_at

CSV_SCHEMA = "seq BIGINT, id STRING, time TIMESTAMP_NTZ, variable STRING, value DOUBLE"


def read_readings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Long CSV whose first column is a row index; the index is kept as ``seq``, the order of rows."""
    raw = spark.read.schema(CSV_SCHEMA).csv(path, header=True, nullValue="NA")
    return readings_from_text_id(raw)


def readings_from_text_id(raw: DataFrame) -> DataFrame:
    """Entity is the integer after the first dot of ``id``. Rows without a readable id or time are left to ``unreadable_audit``."""
    return with_time_columns(
        raw.filter(~_unreadable()).select(
            F.expr("try_cast(split_part(id, '.', 2) AS BIGINT)").alias("entity"),
            F.col("time").alias("ts"),
            "seq",
            "variable",
            F.expr("nullif(value, double('NaN'))").alias("value"),
        )
    )


def unreadable_audit(raw: DataFrame) -> DataFrame:
    """The raw rows that ``readings_from_text_id`` leaves out."""
    return raw.filter(_unreadable())


def _unreadable():
    return F.expr("try_cast(split_part(id, '.', 2) AS BIGINT)").isNull() | F.col("time").isNull()


def with_time_columns(readings: DataFrame) -> DataFrame:
    """Add date, hour and the time-of-day band."""
    hour = F.hour("ts")
    return readings.withColumns(
        {"date": F.to_date("ts"), "hour": hour, "tod": tod_band(hour)}
    )


def stored_readings(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    """Read the parquet copy of a CSV; write it, partitioned by date, if it is not complete or the CSV is newer."""
    written = completed_at(spark, parquet_path)
    if written is None or written < changed_at(spark, csv_path):
        write_readings(read_readings_csv(spark, csv_path), parquet_path)
    return spark.read.parquet(parquet_path)


def write_readings(readings: DataFrame, path: str) -> None:
    """One folder per date, so that date filters prune; rows of a date spread over several tasks."""
    readings.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(path)


def append_readings(readings: DataFrame, path: str) -> None:
    """Add rows to the date folders of ``write_readings``."""
    readings.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(path)


def drop_negative(readings: DataFrame, signed: tuple[str, ...]) -> DataFrame:
    """Drop negative values of unsigned variables; missing values stay."""
    return readings.filter(~F.coalesce(_illegal(signed), F.lit(False)))


def negative_audit(readings: DataFrame, signed: tuple[str, ...]) -> DataFrame:
    """The readings that ``drop_negative`` removes."""
    return readings.filter(_illegal(signed))


def _illegal(signed: tuple[str, ...]):
    return (F.col("value") < 0) & ~F.col("variable").isin(list(signed))
