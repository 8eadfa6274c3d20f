"""Native column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dailypanel.fixed import (
    BED_FROM_HOUR,
    BED_WRAP_BELOW,
    DAY_SHIFT_HOURS,
    QUADRANT_MISSING,
    QUADRANTS,
    TOD_EDGES,
    WAKE_HOURS,
)


def tod_band(hour: Column) -> Column:
    """0 before 10 h, 1 until 17 h, 2 after; the lower edge belongs to the later band."""
    low, high = TOD_EDGES
    return F.when(hour < low, 0).when(hour < high, 1).when(hour >= high, 2)


def shifted_day(ts: Column) -> Column:
    """The day that starts at 5 h."""
    return F.to_date(ts - F.expr(f"INTERVAL {DAY_SHIFT_HOURS} HOURS"))


def late_hour(hour: Column) -> Column:
    """An evening hour that can be a bed time."""
    return F.when(hour >= BED_FROM_HOUR, hour)


def early_hour(hour: Column) -> Column:
    """An hour after midnight that still belongs to the previous shifted day."""
    return F.when(hour < DAY_SHIFT_HOURS, hour)


def wake_hour(hour: Column) -> Column:
    return F.when((hour >= WAKE_HOURS[0]) & (hour < WAKE_HOURS[1]), hour)


def wrapped_bed(bed: Column) -> Column:
    """Bed hours after midnight continue the evening: 1 h becomes 25 h."""
    return F.when(bed < BED_WRAP_BELOW, bed + 24).otherwise(bed)


def in_day_order(ts: Column, seq: Column) -> Column:
    """Total order of readings inside one day as one fixed-width decimal.

    A decimal buffer keeps min_by/max_by in hash aggregation; a struct would force a sort of the raw rows.
    """
    micros = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("decimal(5,0)") + F.extract(F.lit("SECOND"), ts)
    whole = (micros * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(11,0)")
    return whole * F.lit("10000000000000000000").cast("decimal(20,0)") + seq.cast("decimal(20,0)")


def quadrant(valence: Column, arousal: Column) -> Column:
    """Quadrant of the valence/arousal plane; both zero is -10, a missing side is -1."""
    v, a = valence, arousal
    return (
        F.when(v.isNull() | a.isNull(), QUADRANT_MISSING)
        .when((v == 0) & (a == 0), QUADRANTS[0])
        .when((v >= 0) & (a > 0), QUADRANTS[1])
        .when((v < 0) & (a >= 0), QUADRANTS[2])
        .when((v <= 0) & (a < 0), QUADRANTS[3])
        .otherwise(QUADRANTS[4])
    )


def dummies(value: str, prefix: str, categories: tuple) -> dict[str, str]:
    """0/1 columns, as SQL text, for every listed category but the lowest."""
    return {f"{prefix}_{c}": f"coalesce(CAST({value} = {c} AS INT), 0)" for c in sorted(categories)[1:]}


def three_bands(value: Column, low: Column, high: Column) -> Column:
    """Low, Medium or High by edges (min+max)/3 and 2(min+max)/3.

    Intervals are right-closed, so the minimum itself, and everything outside the range, has no band.
    """
    first, second = (low + high) / 3, (low + high) * 2 / 3
    return (
        F.when((value > low) & (value <= first), "Low")
        .when((value > first) & (value <= second), "Medium")
        .when((value > second) & (value <= high), "High")
    )


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both sides are present; null for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.covar_pop(xs, ys) / F.nullif(F.sqrt(F.var_pop(xs)) * F.sqrt(F.var_pop(ys)), F.lit(0.0))


def skew(x: Column) -> Column:
    """Population skewness; null for a constant column."""
    return F.when(F.var_pop(x) > 0, F.skewness(x))


def sample_skew(x: Column) -> Column:
    """Bias-corrected skewness, needs three values."""
    n = F.count(x).cast("double")
    return F.when(n > 2, skew(x) * F.sqrt(n * (n - 1)) / (n - 2))


def hash_fraction(text: Column) -> Column:
    """Stable number in [0, 1) from the first 8 hex digits of the md5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
