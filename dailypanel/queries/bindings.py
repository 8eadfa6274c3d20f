"""The provided tables seen as readings (FIXTURES.md, section C)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailypanel.catalog import Catalog
from dailypanel.sources.readings import drop_negative, readings_from_text_id

# What each event type stands for.
VARIABLES = {"purchase": "mood", "view": "valence", "click": "arousal", "error": "screen", "signup": "activity"}
OVERRIDES = [(1, "2024-01-05", "2024-01-20"), (12, "2024-01-03", "2024-01-25")]

CATALOG = Catalog(
    averaged=("mood", "valence", "arousal"),
    summed=("screen", "activity"),
    peaked=("activity",),
    signed=("valence", "arousal"),
    static=("activity",),
    order=("mood", "screen", "activity", "valence", "arousal"),
)


SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table, read with its known schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of the readings CSV; every 37th value is missing."""
    kind = F.col("event_type")
    variable = F.coalesce(*[F.when(kind == k, v) for k, v in VARIABLES.items()])
    offset = F.when(kind.isin("view", "click"), 5000).when(kind == "error", 500).otherwise(0)
    cents = F.round(F.col("value") * 100) - offset
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user."), F.col("user_id").cast("string")).alias("id"),
        F.col("ts").alias("time"),
        F.col("event_id").alias("seq"),
        variable.alias("variable"),
        F.when(F.col("event_id") % 37 != 0, cents / 100).alias("value"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_text_id(raw_readings(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_negative(readings(spark, sf_dir), CATALOG.signed)
