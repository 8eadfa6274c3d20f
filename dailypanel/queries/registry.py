"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Both engines add the same small number before rounding: exact decimal ties, on which they differ,
# are moved off the edge, and a negative zero cannot appear.
NUDGE = 3.1e-8


D = "CAST(date AS VARCHAR) AS date"
N = "CAST(next_date AS VARCHAR) AS next_date"
T = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns and print dates as text, so that results can be compared by value."""

    def plain(name: str, kind: str) -> str:
        if kind in ("double", "float"):
            return f"round(CAST(`{name}` AS DOUBLE) + {NUDGE}D, {digits}) AS `{name}`"
        if kind == "date":
            return f"CAST(`{name}` AS STRING) AS `{name}`"
        if kind == "timestamp_ntz":
            return f"date_format(`{name}`, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS `{name}`"
        return f"`{name}`"

    return df.selectExpr(*[plain(c, kind) for c, kind in df.dtypes])


def r(sql: str, digits: int = 6) -> str:
    """The rounding of ``tidy`` in SQL."""
    return f"round(CAST({sql} AS DOUBLE) + 3.1e-8, {digits})"
