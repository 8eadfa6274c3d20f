"""Joining a per-key table (parameters, codes, bounds) to data of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.session import ensure_checkpoint_dir


def settle(table: DataFrame) -> DataFrame:
    """Compute a table once and cut its lineage, for tables that several passes read."""
    ensure_checkpoint_dir(table.sparkSession)
    return table.checkpoint()


#: A settled table that many passes read keeps its tasks up to this number; beyond it, so many partitions are read by one task.
PASS_TASKS, PASS_PARTS = 64, 4


def for_passes(table: DataFrame) -> DataFrame:
    """A settled table in fewer tasks, for fits that pass over it dozens of times: with small partitions a pass costs what its tasks cost to start.

    Partitions are read one after the other, nothing is shuffled; up to PASS_TASKS partitions stay as they are."""
    parts = table.rdd.getNumPartitions()
    return table.coalesce(max(PASS_TASKS, parts // PASS_PARTS)) if parts > PASS_TASKS else table


def attach(data: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join ``table`` (one row per key) to ``data``; a missing key is a key like any other.

    The plan stays lazy and the strategy is Spark's: by the table's size in bytes it is broadcast or both sides are shuffled, and
    adaptive execution splits the partitions of a hot key. Callers with many equal rows count them first.
    """
    taken = {*data.columns, *table.columns}
    names = [next(n for n in (f"_key{i}" + "_" * k for k in range(len(taken) + 1)) if n not in taken) for i, _ in enumerate(keys)]
    other = table.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[c for c in table.columns if c not in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return data.join(other, same, how).drop(*names)


def attach_by_entity(data: DataFrame, table: DataFrame, key: str = "entity", nulls: bool = True) -> DataFrame:
    """``data`` with the columns of ``table`` (one row per ``key``), null where it has no row.

    Keys are compared by plain equality, so data and tables that are already hashed by ``key`` meet without another shuffle. The row of the
    missing key, if the table has one, is sent to all executors by itself; ``nulls=False`` leaves that out where no key can be missing.
    """
    names = [c for c in table.columns if c != key]
    taken = {*data.columns, *names}
    here, found, alone = (next(n for n in (base + "_" * k for k in range(len(taken) + 1)) if n not in taken) for base in ("_here", "_found", "_alone"))
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    joined = data.join(table.select(F.col(f"`{key}`").alias(here), row.alias(found)), F.col(f"`{key}`") == F.col(here), "left")
    values = F.col(found)
    if nulls and data.schema[key].nullable:
        missing = table.filter(F.col(f"`{key}`").isNull()).select(row.alias(alone)).limit(1)
        joined = joined.join(F.broadcast(missing), F.col(f"`{key}`").isNull(), "left")
        values = F.when(F.col(f"`{key}`").isNull(), F.col(alone)).otherwise(values)
    return joined.select(*[F.col(f"`{c}`") for c in data.columns], *[values[c].alias(c) for c in names])
