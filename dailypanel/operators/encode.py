"""Encodings of text columns by a table of their distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailypanel.operators.lookup import attach, settle


def sorted_codes(values: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct values numbered from 0 in sorted order, ranked in range partitions.

    The sorted partitions are written once before they are counted, so that counting and numbering see the
    same boundaries even when an executor is lost. Only one row per partition is summed up across them.
    """
    ranged = values.select(column).distinct().repartitionByRange(column)
    placed = settle(ranged.withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    return placed.join(F.broadcast(offsets), "_part").select(
        column, (F.col("_offset") + place - 1).alias(code)
    )


def label_encode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace text columns by their number in sorted order; a missing value counts as the text ``nan``."""
    for c in columns:
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit("nan")))
        coded = attach(df, sorted_codes(df, c, "_code"), [c], "left")
        df = coded.withColumn(c, F.col("_code")).select(*df.columns)
    return df


def class_index(df: DataFrame, column: str, name: str = "class_index") -> DataFrame:
    """Number of the class among the sorted distinct labels; a missing label has none."""
    return attach(df, sorted_codes(df.filter(F.col(column).isNotNull()), column, name), [column], "left")


def frequency_encoding(df: DataFrame, column: str, drop_original: bool = True) -> DataFrame:
    """Share of all rows that have the row's value; missing stays missing but counts in the total."""
    counted = settle(df.groupBy(column).agg(F.count("*").alias("_n")))
    total = counted.agg(F.sum("_n")).first()[0]
    shares = counted.filter(F.col(column).isNotNull()).select(
        column, (F.col("_n") / F.lit(float(total or 1))).alias(f"{column}_freq")
    )
    encoded = attach(df, shares, [column], "left")
    return encoded.drop(column) if drop_original else encoded.select(*df.columns, f"{column}_freq")
