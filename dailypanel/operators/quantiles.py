"""Exact quantiles without gathering a group in one task.

Equal values are counted first, in one pass over the input. Where a group has more distinct values than one task should rank, a mergeable
sketch of them gives the ends of ranges that hold about equally many, whatever their spread, and a counting pass finds the range of every
wanted rank. A range is at most 1/680 of its group, so one round is enough up to about 130 million distinct values in a group, and two
up to 9e10. The sketch only steers the work: the result is exact whatever falls into a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailypanel.operators.lookup import attach, settle

#: Distinct values that one task ranks.
SLICE = 200_000
#: A round makes STEP * STEP ranges. The sketch's ranks are off by a quarter of a range at most.
STEP = 32
RANGES = STEP * STEP


def _splits(rows: DataFrame, cells: list[str]) -> DataFrame:
    """Per cell the inner ends of its ranges, ascending, and every STEP-th of them. ``rows`` has a row per distinct value of a cell."""
    shares = F.array(*[F.lit(k / RANGES) for k in range(1, RANGES)])
    ends = rows.groupBy(*cells).agg(F.percentile_approx("value", shares, 4 * RANGES).alias("_ends"))
    return ends.withColumn("_heads", F.transform(F.sequence(F.lit(STEP), F.lit(RANGES - 1), F.lit(STEP)), lambda k: F.get("_ends", k - 1)))


def _range() -> Column:
    """Number of ends that ``value`` has reached: the heads tell the run of STEP ends to look at."""
    value = F.col("value")
    runs = F.size(F.filter("_heads", lambda end: end <= value))
    return runs * STEP + F.size(F.filter(F.slice("_ends", runs * STEP + 1, STEP), lambda end: end <= value))


def _holding(counts: DataFrame, wanted: DataFrame, keys: list[str], by: str) -> DataFrame:
    """For each wanted rank the ``by`` cell that holds it; ``base`` is the number of smaller rows there."""
    order = Window.partitionBy(*keys).orderBy(by)
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranged = counts.withColumn("_upto", upto).withColumn("_below", F.col("_upto") - F.col("n"))
    hit = (F.col("rank") >= F.col("base") + F.col("_below")) & (F.col("rank") < F.col("base") + F.col("_upto"))
    return attach(wanted, ranged, keys).filter(hit).withColumn("base", F.col("base") + F.col("_below")).drop(
        "n", "_upto", "_below"
    )


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], by: list[str] | None = None, limit: int = SLICE
) -> DataFrame:
    """Linearly interpolated quantiles as rows (by..., variable, probability, value).

    Missing values are ignored; a missing group is a group. No task ranks more than ``limit`` distinct values.
    """
    by = by or []
    keys = [*by, "variable"]
    numbers = [F.col(c).cast("double").alias(c) for c in columns]
    long = df.select(*by, *numbers).unpivot(by, columns, "variable", "value").filter("value IS NOT NULL")
    rows = settle(long.groupBy(*keys, "value").agg(F.count("*").alias("n")))

    place = F.col("probability") * (F.col("n") - 1)
    shares = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    asked = rows.groupBy(*keys).agg(F.sum("n").alias("n")).withColumn("probability", shares).withColumn("_place", place)
    wanted = (
        asked.withColumn("rank", F.explode(F.array(F.floor("_place"), F.ceil("_place"))))
        .select(*keys, "rank", F.lit(0).cast("bigint").alias("base"), F.lit(0).cast("bigint").alias("cell"))
        .distinct()
    )
    rows = rows.withColumn("cell", F.lit(0).cast("bigint"))
    cells = [*keys, "cell"]
    while True:
        many = rows.groupBy(*cells).agg(F.count("*").alias("_many"))
        if (many.agg(F.max("_many")).first()[0] or 0) <= limit:
            break
        wide = attach(rows, many.filter(F.col("_many") > limit), cells)
        binned = attach(rows, _splits(wide, cells), cells, "left").select(*rows.columns, F.when(F.col("_ends").isNull(), 0).otherwise(_range()).alias("bin"))
        counts = binned.groupBy(*cells, "bin").agg(F.sum("n").alias("n"))
        wanted = settle(_holding(counts, wanted, cells, "bin"))
        # the number of smaller rows tells the cells of a group apart
        held = wanted.select(*cells, "bin", F.col("base").alias("_next")).distinct()
        rows = settle(attach(binned, held, [*cells, "bin"]).drop("cell", "bin").withColumnRenamed("_next", "cell"))
        wanted = wanted.drop("cell", "bin").withColumn("cell", F.col("base"))

    found = _holding(rows.select(*cells, "value", "n"), wanted, cells, "value").select(*keys, "rank", "value")
    ranks = F.array_distinct(F.array(F.floor("_place"), F.ceil("_place")))
    ends_of = (
        attach(asked.select(*keys, "probability", "_place", F.explode(ranks).alias("rank")), found, [*keys, "rank"])
        .groupBy(*keys, "probability", "_place")
        .agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    )
    share = F.col("_place") - F.floor("_place")
    return ends_of.select(
        *keys, "probability", (F.col("_low") + (F.col("_high") - F.col("_low")) * share).alias("value")
    )
