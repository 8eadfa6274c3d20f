"""Splits, scaling and sequences on the ready panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailypanel.operators import scale as C
from dailypanel.operators import sequences as Q
from dailypanel.operators import split as L
from dailypanel.operators.lookup import settle
from dailypanel.operators.profile import describe
from dailypanel.plans.datasets import sequence_dataset
from dailypanel.queries import sql as S
from dailypanel.queries.panels import ready
from dailypanel.queries.registry import D, query, r, tidy

SCALED = ["mood_mean_daily", "screen_sum_daily", "sleep_daily", "ewma7_mood_mean_daily"]
SEQUENCE = ["mood_mean_daily", "sleep_daily"]
LENGTH = 5


def cut(train="0.7", val="0.15", source="ready", name="cut") -> str:
    """SQL of the chronological split, written with explicit part sizes."""
    return f"""
{name}_n AS (SELECT *, count(*) OVER (PARTITION BY entity) AS n,
  row_number() OVER (PARTITION BY entity ORDER BY date) AS k FROM {source}),
{name}_s AS (SELECT *, greatest(1, floor(n * CAST({train} AS DOUBLE))) AS a,
  greatest(1, floor(n * CAST({val} AS DOUBLE))) AS b FROM {name}_n WHERE n >= 3),
{name} AS (SELECT * EXCLUDE (n, k, a, b), CASE
    WHEN k <= a - (CASE WHEN a + b >= n AND b <= 1 AND a > 1 THEN 1 ELSE 0 END) THEN 'train'
    WHEN k <= a + b - (CASE WHEN a + b >= n THEN 1 ELSE 0 END) THEN 'val' ELSE 'test' END AS split
  FROM {name}_s)"""


def fraction(text: str) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def hashed(text: str, test: str, val: str) -> str:
    return f"""CASE WHEN {fraction(text)} < CAST({test} AS DOUBLE) THEN 'test'
      WHEN {fraction(text)} < CAST({test} AS DOUBLE) + CAST({val} AS DOUBLE) THEN 'val' ELSE 'train' END"""


DAY_TEXT = "CAST(entity AS VARCHAR) || '_' || CAST(date AS VARCHAR)"


def split_ready(spark, sf):
    return L.chrono_split(ready(spark, sf))


@query("chrono_split", f"{S.upto('ready', cut())} SELECT entity, {D}, split FROM cut")
def chrono_split(spark, sf):
    return tidy(split_ready(spark, sf).select("entity", "date", "split"))


@query(
    "chrono_split_min_test",
    f"""{S.upto('ready')}, k AS (SELECT entity, date, count(*) OVER (PARTITION BY entity) AS n,
      row_number() OVER (PARTITION BY entity ORDER BY date) AS k FROM ready),
    c AS (SELECT *, CASE WHEN n - floor(n * CAST(0.8 AS DOUBLE)) < 6 THEN n - 6 ELSE floor(n * CAST(0.8 AS DOUBLE)) END AS c FROM k)
    SELECT entity, {D}, CASE WHEN k <= c THEN 'train' ELSE 'test' END AS split FROM c WHERE c > 0""",
)
def chrono_split_min_test(spark, sf):
    return tidy(L.chrono_split_min_test(ready(spark, sf)).select("entity", "date", "split"))


@query(
    "group_hash_split",
    f"{S.upto('ready')} SELECT entity, {D}, {hashed(DAY_TEXT, '0.2', '0.1')} AS split FROM ready",
)
def group_hash_split(spark, sf):
    return tidy(L.group_hash_split(ready(spark, sf)).select("entity", "date", "split"))


@query(
    "entity_holdout",
    f"""{S.upto('ready')} SELECT entity, {hashed('CAST(entity AS VARCHAR)', '0.15', '0.15')} AS split,
    count(*) AS n FROM ready GROUP BY ALL""",
)
def entity_holdout(spark, sf):
    return L.entity_holdout(ready(spark, sf)).groupBy("entity", "split").agg(F.count("*").alias("n"))


def _exact(name: str, key, text: str):
    ranked = f"""k AS (SELECT DISTINCT {text} AS k FROM ready),
    o AS (SELECT k, row_number() OVER (ORDER BY {fraction('k')}) - 1 AS i, count(*) OVER () AS n FROM k),
    s AS (SELECT k, CASE WHEN i < floor(n * 0.15::DOUBLE + 1e-9) THEN 'test' WHEN i < floor(n * 0.3::DOUBLE + 1e-9) THEN 'val' ELSE 'train' END AS split FROM o)"""

    @query(name, f"{S.upto('ready', ranked)} SELECT entity, {D}, split FROM ready JOIN s ON s.k = {text}")
    def run(spark, sf):
        return tidy(L.exact_split(settle(ready(spark, sf).select("entity", "date")), key()))

    return run


_exact("entity_exact_holdout", L.entity_key, "CAST(entity AS VARCHAR)")
_exact("day_exact_split", L.day_key, DAY_TEXT)


@query(
    "split_date_ranges",
    f"""{S.upto('ready', cut())} SELECT entity,
    CAST(min(date) FILTER (WHERE split = 'train') AS VARCHAR) AS train_start,
    CAST(max(date) FILTER (WHERE split = 'train') AS VARCHAR) AS train_end,
    CAST(min(date) FILTER (WHERE split = 'test') AS VARCHAR) AS test_start,
    CAST(max(date) FILTER (WHERE split = 'test') AS VARCHAR) AS test_end FROM cut GROUP BY entity""",
)
def split_date_ranges(spark, sf):
    return tidy(L.split_date_ranges(split_ready(spark, sf)))


@query(
    "split_describe",
    f"""{S.upto('ready', cut())} SELECT split, count(target) AS n, {r('avg(target)')} AS mean,
    {r('stddev_samp(target)')} AS std, {r('min(target)')} AS min, {r('quantile_cont(target, 0.25)')} AS q25,
    {r('quantile_cont(target, 0.5)')} AS q50, {r('quantile_cont(target, 0.75)')} AS q75,
    {r('max(target)')} AS max FROM cut GROUP BY split""",
)
def split_describe(spark, sf):
    return tidy(describe(split_ready(spark, sf), "target", ["split"]))


@query(
    "split_class_counts",
    f"""{S.upto('ready', cut())} SELECT split, categorical_target, count(*) AS n FROM cut
    WHERE categorical_target IS NOT NULL GROUP BY ALL""",
)
def split_class_counts(spark, sf):
    parts = split_ready(spark, sf).filter("categorical_target IS NOT NULL")
    return parts.groupBy("split", "categorical_target").agg(F.count("*").alias("n"))


def scaled_sql(columns, kind: str, by: str = "PARTITION BY entity", show=r) -> str:
    parts = []
    for c in columns:
        x = f"CASE WHEN split = 'train' THEN {c} END"
        if kind == "standard":
            center, spread = f"avg({x}) OVER ({by})", f"stddev_pop({x}) OVER ({by})"
        else:
            center, spread = f"min({x}) OVER ({by})", f"(max({x}) OVER ({by}) - min({x}) OVER ({by}))"
        parts.append(
            show(f"({c} - {center}) / CASE WHEN {spread} <= abs({center}) * 1e-12 THEN 1 ELSE {spread} END") + f" AS {c}"
        )
    return ", ".join(parts)


def _scale_query(name: str, columns, kind: str, by_entity: bool, source: str, split):
    by = "PARTITION BY entity" if by_entity else ""
    statement = f"{S.upto('ready', source)} SELECT entity, {D}, split, {scaled_sql(columns, kind, by)} FROM cut"

    @query(name, statement)
    def run(spark, sf):
        parts = split(spark, sf).select("entity", "date", "split", *columns)
        scaled = (C.scale_by_entity if by_entity else C.scale_globally)(parts, columns, kind)
        return tidy(scaled)

    return run


_scale_query("scale_standard", SCALED, "standard", True, cut(), split_ready)
_scale_query("scale_standard_global", SCALED, "standard", False, cut(), split_ready)
_scale_query("scale_minmax", SCALED, "minmax", True, cut(), split_ready)
_scale_query("scale_target", SCALED + ["target"], "standard", True, cut(), split_ready)


@query(
    "inverse_scale",
    f"""{S.upto('ready', cut())},
    p AS (SELECT entity, avg(target) AS m, CASE WHEN stddev_pop(target) <= abs(avg(target)) * 1e-12 THEN 1 ELSE stddev_pop(target) END AS s
          FROM cut WHERE split = 'train' GROUP BY entity)
    SELECT entity, {D}, {r('(target - m) / s')} AS scaled_actual, {r('(mood_mean_daily - m) / s')} AS scaled_predicted,
      {r('target')} AS actual, {r('mood_mean_daily')} AS predicted FROM cut JOIN p USING (entity)""",
)
def inverse_scale(spark, sf):
    """Today's level as prediction, scaled with the target's parameters and scaled back."""
    parts = split_ready(spark, sf).select(
        "entity", "date", "split", "target", F.col("target").alias("actual"), F.col("mood_mean_daily").alias("predicted")
    )
    params = C.fit(parts, ["target"])
    both, as_target = ["actual", "predicted"], ["target", "target"]
    scaled = C.apply(parts, params, both, as_target, nulls=False).withColumns(
        {"scaled_actual": F.col("actual"), "scaled_predicted": F.col("predicted")}
    )
    return tidy(C.invert(scaled, params, both, as_target, nulls=False).drop("split", "target"))


def padded_sql(source: str, by: str, full: bool = False) -> str:
    """Brute force: every start row joined to its following rows."""
    keys = by.split(", ")
    same = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    picks = ", ".join(f"coalesce(CAST(b.{c} AS FLOAT), 0) AS {c}" for c in SEQUENCE)
    enough = f"WHERE a.i + {LENGTH} < a.n" if full else "WHERE a.i + 1 < a.n"
    shown_keys = ", ".join(k for k in keys)
    return f"""
num AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY {by}) AS n
  FROM {source}),
starts AS (SELECT a.*, least({LENGTH}, a.n - 1 - a.i) AS known, unnest(range({LENGTH})) AS step FROM num a {enough}),
steps AS (SELECT {', '.join('a.' + k for k in keys)}, a.date, CAST(a.step AS INTEGER) AS step, {picks},
  CAST(a.step < a.known AS FLOAT) AS mask, t.target AS target
  FROM starts a LEFT JOIN num b ON {same} AND b.i = a.i + a.step AND a.step < a.known
  JOIN num t ON {same.replace('b.', 't.')} AND t.i = a.i + a.known)
SELECT {shown_keys}, {D}, step, {S.rounded(SEQUENCE, 4)}, {r('mask', 4)} AS mask, {r('target', 4)} AS target FROM steps"""


@query("padded_sequences", f"{S.upto('ready')}, {padded_sql('ready', 'entity')}")
def padded_sequences(spark, sf):
    samples = Q.padded_sequences(ready(spark, sf), SEQUENCE, "target", LENGTH)
    return tidy(Q.as_steps(samples, SEQUENCE, ["entity", "date"]), 4)


@query("full_sequences", f"{S.upto('ready')}, {padded_sql('ready', 'entity', full=True)}")
def full_sequences(spark, sf):
    samples = Q.full_sequences(ready(spark, sf), SEQUENCE, "target", LENGTH)
    return tidy(Q.as_steps(samples, SEQUENCE, ["entity", "date"]), 4)


@query(
    "sequence_dataset",
    f"""{S.upto('ready', cut())},
    sc AS (SELECT entity, date, split, target, {scaled_sql(SEQUENCE, 'standard', show=str)} FROM cut),
    {padded_sql('sc', 'entity, split')}""",
)
def sequence_dataset_query(spark, sf):
    columns = ["entity", "date", "target", *SEQUENCE]
    samples = sequence_dataset(ready(spark, sf).select(*columns), SEQUENCE, "target", LENGTH)
    return tidy(Q.as_steps(samples, SEQUENCE, ["entity", "split", "date"]), 4)
