"""Train, validation and test splits that add one column ``split``.

Chronological splits are windows over one entity's panel rows. Random splits hash a key: no sort, no list of
keys, the same answer on every run. Their shares are met approximately, or exactly if ``share_edges`` first selects the edges by rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailypanel.functions.expressions import hash_fraction
from dailypanel.operators.lookup import settle


def _numbered(df: DataFrame, order: list[str]) -> DataFrame:
    whole = Window.partitionBy("entity")
    return df.withColumns(
        {"_n": F.count("*").over(whole), "_k": F.row_number().over(whole.orderBy(*order))}
    )


def chrono_split(df: DataFrame, train: float = 0.7, val: float = 0.15, order=("date",)) -> DataFrame:
    """First rows of each entity train, the next validate, the rest test.

    Every part gets at least one row: if none is left for test, validation shrinks, else training. Entities
    with fewer than three rows are dropped.
    """
    n = F.col("_n")
    first = F.greatest(F.lit(1), F.floor(n * F.lit(float(train))))
    second = F.greatest(F.lit(1), F.floor(n * F.lit(float(val))))
    sized = _numbered(df, list(order)).filter(n >= 3).withColumns({"_train": first, "_val": second})
    full = F.col("_train") + F.col("_val") >= n
    shrunk = F.when(full & (F.col("_val") > 1), F.col("_val") - 1).otherwise(F.col("_val"))
    kept = F.when(full & (F.col("_val") <= 1) & (F.col("_train") > 1), F.col("_train") - 1).otherwise(
        F.col("_train")
    )
    part = F.when(F.col("_k") <= kept, "train").when(F.col("_k") <= kept + shrunk, "val").otherwise("test")
    return sized.withColumn("split", part).drop("_n", "_k", "_train", "_val")


def chrono_split_min_test(df: DataFrame, train: float = 0.8, length: int = 5, order=("date",)) -> DataFrame:
    """Chronological cut with at least ``length`` + 1 test rows; entities too short for that are dropped."""
    n = F.col("_n")
    cut = F.least(F.floor(n * F.lit(float(train))), n - (length + 1))
    part = F.when(F.col("_k") <= F.col("_cut"), "train").otherwise("test")
    return (
        _numbered(df, list(order))
        .withColumn("_cut", cut)
        .filter("_cut > 0")
        .withColumn("split", part)
        .drop("_n", "_k", "_cut")
    )


def _by_fraction(at: Column, test: float, val: float) -> Column:
    return F.when(at < F.lit(float(test)), "test").when(at < F.lit(float(test) + float(val)), "val").otherwise("train")


def group_hash_split(df: DataFrame, test: float = 0.2, val: float = 0.1) -> DataFrame:
    """Random split by entity and day, so that all rows of one day stay together."""
    day = F.concat_ws("_", F.col("entity").cast("string"), F.col("date").cast("string"))
    return df.withColumn("split", _by_fraction(hash_fraction(day), test, val))


def entity_holdout(df: DataFrame, test: float = 0.15, val: float = 0.15) -> DataFrame:
    """Whole entities in one part."""
    return df.withColumn("split", _by_fraction(hash_fraction(F.col("entity").cast("string")), test, val))


def split_date_ranges(df: DataFrame) -> DataFrame:
    """First and last date of every entity in train and in test."""
    ends = [
        end(F.when(F.col("split") == part, F.col("date"))).alias(f"{part}_{name}")
        for part in ("train", "test")
        for name, end in (("start", F.min), ("end", F.max))
    ]
    return df.groupBy("entity").agg(*ends)


#: Values of a hash, and those that one pass tells apart.
HASHES, DIGIT = 1 << 32, 1 << 11


def day_key() -> Column:
    """The text by which whole days are dealt."""
    return F.concat_ws("_", F.col("entity").cast("string"), F.col("date").cast("string"))


def entity_key() -> Column:
    return F.col("entity").cast("string")


def share_edges(df: DataFrame, key: Column, shares: list[float]) -> list[float]:
    """For each share the fraction below which the hashes of exactly floor(share x keys) distinct ``key`` texts lie.

    Ranks are found digit by digit: a pass counts the keys of each of 2048 ranges, and the next one looks into the range that holds the rank. So no keys
    are sorted or collected, and later data are split by the edges alone. Keys whose 32-bit hashes are equal stay together. A missing key is none.
    """
    keys = settle(df.select((hash_fraction(key) * HASHES).cast("long").alias("h"), key.alias("k")).filter("k IS NOT NULL").distinct().select("h"))
    total = keys.count()
    edges = []
    for share in shares:
        rank, low, width = int(total * share + 1e-9), 0, HASHES
        if rank >= total:
            edges.append(1.0)
            continue
        while width > 1:
            step = max(1, width // DIGIT)
            inside = keys.filter((F.col("h") >= low) & (F.col("h") < low + width))
            counts = {r["at"]: r["n"] for r in inside.groupBy(F.floor((F.col("h") - low) / step).cast("long").alias("at")).agg(F.count("*").alias("n")).collect()}
            at = 0
            while rank >= counts.get(at, 0):
                rank -= counts.get(at, 0)
                at += 1
            low, width = low + at * step, step
        edges.append(low / HASHES)
    return edges


def exact_split(df: DataFrame, key: Column, test: float = 0.15, val: float = 0.15) -> DataFrame:
    """Random split by ``key`` (``entity_key()`` or ``day_key()``) whose test and validation shares are exact to one key."""
    first, second = share_edges(df, key, [test, test + val])
    return df.withColumn("split", _by_edges(hash_fraction(key), first, second))


def _by_edges(at: Column, first: float, second: float) -> Column:
    return F.when(at < F.lit(first), "test").when(at < F.lit(second), "val").otherwise("train")
