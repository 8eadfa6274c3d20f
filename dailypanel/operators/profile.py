"""Counts, missingness, histograms, skewness and other column profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailypanel.fixed import SPEC_ABSENT, SPEC_COMPACT, SPEC_FEET, SPEC_OPEN, SPEC_RANGE, SPEC_UNKNOWN
from dailypanel.functions import expressions as E
from dailypanel.operators.lookup import attach, settle
from dailypanel.operators.quantiles import exact_quantiles


def numeric_columns(df: DataFrame, exclude=(), without: str = "") -> list[str]:
    """Numeric columns by the schema, leaving out some names and names that contain a text."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [
        c
        for c, kind in df.dtypes
        if (kind in numeric or kind.startswith("decimal")) and c not in exclude and not (without and without in c)
    ]


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def rest_hour_histogram(panel: DataFrame) -> DataFrame:
    """How often each whole hour occurs as bed and as wake time."""
    hours = panel.select(
        F.floor("bed_time_daily").alias("bed"), F.floor("wake_time_daily").alias("wake")
    ).unpivot([], ["bed", "wake"], "kind", "hour")
    return count_by(hours.filter("hour IS NOT NULL"), ["kind", "hour"])


def entity_day_mean(panel: DataFrame, columns: list[str]) -> DataFrame:
    return panel.groupBy("entity", "date").agg(*[F.avg(c).alias(c) for c in columns])


def missing_profile(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Missing, distinct and zero counts of every column, per entity and for all entities together.

    Equal values are counted first, so the distinct counts need no second pass over the rows and the total
    over all entities starts from counted values.
    """
    long = panel.select("entity", *[F.col(c).cast("double") for c in columns]).unpivot(
        ["entity"], columns, "variable", "value"
    )
    counted = long.groupBy("entity", "variable", "value").agg(F.count("*").alias("n"))
    per_entity = _missing(counted.withColumn("entity", F.col("entity").cast("string")))
    together = counted.groupBy("variable", "value").agg(F.sum("n").alias("n"))
    return per_entity.unionByName(_missing(together.withColumn("entity", F.lit("all"))))


def _missing(counted: DataFrame) -> DataFrame:
    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    value, total = F.col("value"), F.sum("n")
    return counted.groupBy("entity", "variable").agg(
        rows(value.isNull()).alias("n_missing"),
        (rows(value.isNull()) / total).alias("missing_share"),
        F.count("value").alias("n_unique"),
        rows(value == 0).alias("n_zero"),
        (rows(value == 0) / total).alias("zero_share"),
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every value of every text column with its number of rows."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "variable", "value"
    )
    return count_by(long, ["variable", "value"])


def categorical_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing and distinct values with their shares and the most frequent value (smallest on ties).

    The values themselves stay a table, ``value_counts``: a list per column would have no bound.
    """
    counted = value_counts(df, columns)
    missing = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    total, present = F.sum("n"), F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("value")))
    return counted.groupBy("variable").agg(
        F.count("value").alias("n_unique"),
        missing.alias("n_missing"),
        (F.count("value") / total).alias("unique_share"),
        (missing / total).alias("missing_share"),
        F.min(present)["value"].alias("most_frequent"),
    )


def histogram(df: DataFrame, columns: list[str], bins: int, by: list[str] | None = None) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins are listed with 0.

    A constant column gets a range of width 1 around its value. A missing group is a group.
    """
    by = by or []
    keys = by + ["variable"]
    long = (
        df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(by, columns, "variable", "value")
        .filter("value IS NOT NULL")
    )
    long = settle(long.groupBy(*keys, "value").agg(F.count("*").alias("n")))  # equal rows are one from here on
    ends = long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.withColumns(
        {"lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")), "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))}
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    place = F.floor((F.col("value") - F.col("lo")) / F.col("width"))
    placed = attach(long, ends, keys).withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
    counts = placed.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
    every = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return attach(every, counts, keys + ["bin"], "left").select(
        *keys,
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def skewness_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bias-corrected skewness of every column."""
    row = df.agg(*[E.sample_skew(F.col(c).cast("double")).alias(c) for c in columns])
    return row.unpivot([], columns, "variable", "skewness")


def skewed_columns(df: DataFrame, columns: list[str], threshold: float = 0.5) -> list[str]:
    """Columns without gaps and without values that have no log1p (-1 and below) whose population skewness is above the threshold;
    one row comes to the driver."""
    row = df.agg(
        *[
            F.when((F.count_if(F.col(c).isNull()) == 0) & (F.min(F.col(c).cast("double")) > -1), E.skew(F.col(c).cast("double"))).alias(c)
            for c in columns
        ]
    ).first()
    return [c for c in columns if row[c] is not None and row[c] > threshold]


def log_transform(df: DataFrame, columns: list[str], threshold: float = 0.5, exclude=()) -> DataFrame:
    """log1p of the right-skewed columns; a column with gaps or with values of -1 and below stays as it is."""
    skewed = skewed_columns(df, [c for c in columns if c not in exclude], threshold)
    return df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in skewed})


def duplicate_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs of columns that group the rows identically, whatever their values; missing is a value of its own.

    Two columns do so when each alone and both together have the same number of distinct values. The single
    counts (one number per column, on the driver) leave few candidate pairs for the second pass.
    """
    as_value = {c: F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("-")) for c in columns}
    keyed = df.select(*[v.alias(c) for c, v in as_value.items()])
    single = keyed.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    pairs = [(a, b) for a, b in combinations(columns, 2) if single[a] == single[b]]
    names = [f"p{i}" for i in range(len(pairs))]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column string, duplicate_of string")
    joint = keyed.agg(*[F.count_distinct(a, b).alias(n) for n, (a, b) in zip(names, pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(b).alias("column"), F.lit(a).alias("duplicate_of"), (F.col(n) == single[a]).alias("same"))
            for n, (a, b) in zip(names, pairs)
        ]
    )
    return joint.select(F.inline(rows)).filter("same").drop("same")


def top_category_box(df: DataFrame, category: str, measure: str, top: int) -> DataFrame:
    """Box statistics of a measure for the ``top`` most frequent categories."""
    counted = count_by(df.filter(F.col(category).isNotNull()), [category])
    best = counted.orderBy(F.desc("n"), category).limit(top)
    kept = df.select(category, measure).join(F.broadcast(best.select(category)), category, "left_semi")
    shares = {0.0: "low", 0.25: "q25", 0.5: "q50", 0.75: "q75", 1.0: "high"}
    box = exact_quantiles(kept, [measure], list(shares), [category]).groupBy(category).agg(
        *[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name) for p, name in shares.items()]
    )
    return best.join(box, category)


def value_range(df: DataFrame, column: str) -> tuple[float, float]:
    row = df.agg(F.min(column), F.max(column)).first()
    return row[0], row[1]


def add_value_bands(df: DataFrame, column: str, name: str = "band", ends: tuple | None = None) -> DataFrame:
    """Low, Medium or High by the range of the column; two numbers come to the driver."""
    low, high = ends or value_range(df, column)
    return df.withColumn(name, E.three_bands(F.col(column), F.lit(low), F.lit(high)))


def spec_columns(text: Column) -> dict[str, Column]:
    """Parts of a measurement text: ``a to b unit``, ``a+ unit``, ``f' i"`` or a bare unit.

    Lengths in feet and inches become inches; a missing text or "None or Unspecified" is a length of 0.
    """
    unknown = text.contains(SPEC_UNKNOWN)
    compact = text.contains(SPEC_COMPACT)
    absent = text.isNull() | (text == SPEC_ABSENT)
    is_range, is_open = text.rlike(SPEC_RANGE), text.contains("+")
    is_length = text.rlike(SPEC_FEET)

    def number(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group).try_cast("double")

    inches = number(SPEC_FEET, 1) * 12 + number(SPEC_FEET, 2)
    low = F.when(absent, 0.0).when(unknown, None).when(is_range, number(SPEC_RANGE, 1))
    low = low.when(is_open, number(SPEC_OPEN, 1)).when(is_length, inches)
    high = F.when(absent, 0.0).when(unknown, None).when(is_range, number(SPEC_RANGE, 2)).when(is_length, inches)
    unit = (
        F.when(absent | is_length, "Inches")
        .when(compact, SPEC_COMPACT)
        .when(unknown, SPEC_UNKNOWN)
        .when(is_range, F.regexp_extract(text, SPEC_RANGE, 3))
        .when(is_open, F.regexp_extract(text, SPEC_OPEN, 2))
        .otherwise(text)
    )
    return {"unit": unit, "low": low, "high": high}


def spec_report(df: DataFrame, column: str) -> DataFrame:
    """Rows, unparsed rows and value range per unit of a measurement text column."""
    parts = spec_columns(F.col(column))
    unparsed = F.count_if(F.col("low").isNull())
    return (
        df.select(*[c.alias(n) for n, c in parts.items()])
        .groupBy("unit")
        .agg(
            F.count("*").alias("n"),
            unparsed.alias("n_unparsed"),
            (unparsed / F.count("*")).alias("unparsed_share"),
            F.min("low").alias("low"),
            F.max(F.coalesce("high", "low")).alias("high"),
        )
    )


def describe(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Count, mean, sample deviation, ends and exact quartiles of a column for each group; a missing group is a group."""
    values = settle(df.select(*by, column))
    moments = values.groupBy(*by).agg(
        F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("min"), F.max(column).alias("max")
    )
    named = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    picked = [F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name) for p, name in named.items()]
    wide = exact_quantiles(values, [column], list(named), by).groupBy(*by).agg(*picked)
    return attach(moments, wide, by, "left") if by else moments.join(wide)
