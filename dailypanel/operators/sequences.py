"""Fixed-length windows of panel rows for sequence models, as array columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def padded_sequences(
    df: DataFrame, features: list[str], target: str, length: int, by=("entity",), order=("date",)
) -> DataFrame:
    """For every start row up to ``length`` rows, zero padded, with a 1/0 mask and the next row's target.

    The last row of a group starts nothing, because it has no next row. Each window holds at most
    ``length`` + 1 rows.
    """
    ahead = _ahead(df, features, target, length, by, order)
    return _as_arrays(ahead.filter(F.size("_rows") > 1), features, length, by, order)


def full_sequences(
    df: DataFrame, features: list[str], target: str, length: int, by=("entity",), order=("date",)
) -> DataFrame:
    """Only the windows with ``length`` rows and a next row of the same entity."""
    ahead = _ahead(df, features, target, length, by, order)
    return _as_arrays(ahead.filter(F.size("_rows") == length + 1), features, length, by, order)


def _ahead(df, features, target, length, by, order) -> DataFrame:
    rows = Window.partitionBy(*by).orderBy(*order).rowsBetween(0, length)
    cell = F.struct(
        F.array(*[F.col(c).cast("float") for c in features]).alias("x"), F.col(target).alias("y")
    )
    return df.select(*by, *order, F.collect_list(cell).over(rows).alias("_rows"))


def _as_arrays(ahead, features, length, by, order) -> DataFrame:
    known = F.size("_rows") - 1
    zeros = F.array(*[F.lit(0.0).cast("float") for _ in features])
    steps = F.transform(F.slice("_rows", F.lit(1), known), lambda r: r["x"])
    return ahead.select(
        *by,
        *order,
        F.concat(steps, F.array_repeat(zeros, F.lit(length) - known)).alias("sequence"),
        F.concat(
            F.array_repeat(F.lit(1.0).cast("float"), known),
            F.array_repeat(F.lit(0.0).cast("float"), F.lit(length) - known),
        ).alias("mask"),
        F.element_at("_rows", -1)["y"].alias("target"),
    )


def as_steps(sequences: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """One row per sample and step, for reading and checking."""
    pairs = F.arrays_zip("sequence", "mask")
    return sequences.select(*keys, "target", F.posexplode(pairs).alias("step", "_p")).select(
        *keys,
        "step",
        *[F.col("_p.sequence")[i].alias(c) for i, c in enumerate(features)],
        F.col("_p.mask").alias("mask"),
        "target",
    )
