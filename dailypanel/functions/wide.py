"""Many columns at once as SQL text.

A wide panel has hundreds of derived columns. One ``selectExpr`` hands them to Spark in a single call, where
building each as a Column object costs several calls between Python and the JVM per operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def with_exprs(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """Replace or add columns, computed from the columns before the call."""
    names = df.columns
    kept = [f"{exprs[c]} AS `{c}`" if c in exprs else f"`{c}`" for c in names]
    return df.selectExpr(*kept, *[f"{e} AS `{c}`" for c, e in exprs.items() if c not in names])


def literal(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def over(by: str = "entity", order: str | None = None, frame: str | None = None) -> str:
    """Text of a window."""
    parts = [f"PARTITION BY {by}"]
    if order:
        parts.append(f"ORDER BY {order}")
    if frame:
        parts.append(frame)
    return f"OVER ({' '.join(parts)})"


SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def order_of(grain: str) -> str:
    """Row order inside an entity."""
    return "date" if grain == "daily" else "date, tod"
