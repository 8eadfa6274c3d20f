"""Scaling with parameters fitted on the training rows only.

Parameters are a table (entity, feature, center, scale), not objects. Where rows already sit together by
entity, ``scale_by_entity`` computes and applies them in one window pass; ``fit`` and ``apply`` keep them
apart for storing, inverting and scoring later data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailypanel.operators.lookup import attach_by_entity


# A spread below this share of the center is a constant column: smoothing keeps one constant only to rounding.
CONSTANT_SHARE = 1e-12


def _center_scale(column: Column, kind: str, over=lambda c: c) -> tuple[Column, Column]:
    """Center and spread; a constant column divides by 1."""
    if kind == "standard":
        center, spread = over(F.avg(column)), over(F.stddev_pop(column))
    elif kind == "minmax":
        center, spread = over(F.min(column)), over(F.max(column)) - over(F.min(column))
    else:
        raise ValueError(f"unknown kind of scaling: {kind}")
    return center, F.when(spread <= F.abs(center) * CONSTANT_SHARE, 1.0).otherwise(spread)


def _train(name: str) -> Column:
    return F.when(F.col("split") == "train", F.col(name).cast("double"))


def _scaled(value: Column, center: Column, scale: Column) -> Column:
    """Unchanged where there are no parameters (an entity not seen in training)."""
    return F.coalesce((value - center) / scale, value)


def scale_by_entity(df: DataFrame, columns: list[str], kind: str = "standard") -> DataFrame:
    whole = Window.partitionBy("entity")
    framed = df
    for part in (0, 1):
        framed = framed.withColumns(
            {f"_{part}_{c}": _center_scale(_train(c), kind, lambda e: e.over(whole))[part] for c in columns}
        )
    scaled = {
        c: _scaled(F.col(c).cast("double"), F.col(f"_0_{c}"), F.col(f"_1_{c}")) for c in columns
    }
    return framed.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def scale_globally(df: DataFrame, columns: list[str], kind: str = "standard") -> DataFrame:
    """One set of parameters for all rows: two numbers per column come to the driver."""
    pairs = {c: _center_scale(_train(c), kind) for c in columns}
    row = df.agg(
        *[p.alias(f"_{i}_{c}") for c, pair in pairs.items() for i, p in enumerate(pair)]
    ).first()
    return df.withColumns(
        {
            c: _scaled(
                F.col(c).cast("double"),
                F.lit(row[f"_0_{c}"]).cast("double"),
                F.lit(row[f"_1_{c}"]).cast("double"),
            )
            for c in columns
        }
    )


def fit(df: DataFrame, columns: list[str], kind: str = "standard") -> DataFrame:
    """Parameter table with one row per entity and feature."""
    params = []
    for c in columns:
        center, scale = _center_scale(_train(c), kind)
        params.append(F.struct(F.lit(c).alias("feature"), center.alias("center"), scale.alias("scale")))
    by_entity = df.groupBy("entity").agg(F.array(*params).alias("_params"))
    return by_entity.select("entity", F.inline("_params")).filter("center IS NOT NULL")


def _with_params(df: DataFrame, params: DataFrame, features: list[str], nulls: bool) -> DataFrame:
    wide = params.groupBy("entity").agg(
        *[
            F.max(F.when(F.col("feature") == f, F.col(part))).alias(f"_{part}_{f}")
            for f in features
            for part in ("center", "scale")
        ]
    )
    return attach_by_entity(df, wide, nulls=nulls)


def apply(
    df: DataFrame, params: DataFrame, columns: list[str], features: list[str] | None = None, nulls: bool = True
) -> DataFrame:
    """Scale ``columns`` with the parameters of ``features`` (by default their own); without ``nulls`` no entity may be missing."""
    features = features or columns
    joined = _with_params(df, params, sorted(set(features)), nulls)
    scaled = {
        c: _scaled(F.col(c).cast("double"), F.col(f"_center_{f}"), F.col(f"_scale_{f}"))
        for c, f in zip(columns, features)
    }
    return joined.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def invert(
    df: DataFrame, params: DataFrame, columns: list[str], features: list[str] | None = None, nulls: bool = True
) -> DataFrame:
    """Undo ``apply`` with each entity's own parameters."""
    features = features or columns
    joined = _with_params(df, params, sorted(set(features)), nulls)
    restored = {
        c: F.coalesce(F.col(c) * F.col(f"_scale_{f}") + F.col(f"_center_{f}"), F.col(c))
        for c, f in zip(columns, features)
    }
    return joined.select(*[restored[c].alias(c) if c in restored else F.col(c) for c in df.columns])
