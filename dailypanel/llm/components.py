"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailypanel.llm.common import scratch_table


def settle(table: DataFrame) -> DataFrame:
    """Write ``table`` as files, whose size the planner knows. A checkpoint keeps the planner's estimate instead, for a join the product of its sides: a
    number that has twice as many digits after every step, until the driver is full. Not packed, or more rows than meant would be broadcast."""
    return scratch_table(table, "none")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b): label is the smallest node of its component.

    In each round every node points to its smallest neighbour, pointers are followed to their ends by doubling them, and edges are drawn anew between
    the ends. So a star, and a chain of rising ids of any length, goes in one round, the chain of n ids with log2(n) doublings. Nothing is collected
    but whether anything is left. The tables are written to the checkpoint folder, so a lost executor costs one step at most."""
    left = settle(edges.filter("a <> b").select("a", "b").distinct())
    whole = None
    while True:
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = settle(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to")).select(F.col("a").alias("node"), "to"))
        while True:
            far = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
            far = settle(to.join(far, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")))
            to = far.select("node", "to")
            if far.filter("moved").isEmpty():
                break
        if whole is None:
            whole = to.select("node", F.col("to").alias("label"))
        else:
            moved = to.select(F.col("node").alias("label"), "to")
            whole = settle(whole.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")))
        at = to.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        bt = to.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        left = settle(left.join(at, "a").join(bt, "b").filter("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct())
        if left.isEmpty():
            return whole
