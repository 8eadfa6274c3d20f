"""Evaluation tables on two forecasters: today's level (persistence) and its smoothed level."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailypanel.operators import evaluate as V
from dailypanel.operators import features as X
from dailypanel.operators import impute as I
from dailypanel.operators.split import chrono_split
from dailypanel.plans.ready import trimmed_panel
from dailypanel.queries import bindings as B
from dailypanel.queries import sql as S
from dailypanel.queries.panels import ready
from dailypanel.queries.profiles import band_sql
from dailypanel.queries.registry import D, query, r, tidy
from dailypanel.queries.splits import cut, split_ready
from dailypanel.sources.results import sequence_dates

MODELS = {"persistence": "mood_mean_daily", "smoothed": "ewma7_mood_mean_daily"}
CLASSES = [-1.0, 0.0, 1.0]


def predictions(spark, sf):
    """Rows (model, split, entity, date, actual, predicted)."""
    both = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("predicted")) for m, c in MODELS.items()])
    parts = split_ready(spark, sf)
    return parts.select("split", "entity", "date", F.col("target").alias("actual"), F.inline(both))


PREDICTIONS = "predictions AS (" + " UNION ALL ".join(
    f"SELECT split, entity, date, target AS actual, '{m}' AS model, {c} AS predicted FROM cut" for m, c in MODELS.items()
) + ")"
WITH_PREDICTIONS = S.upto("ready", cut(), PREDICTIONS)
ONE_MODEL = "p AS (SELECT * FROM predictions WHERE model = 'persistence')"


def persistence(spark, sf):
    return split_ready(spark, sf).select(
        "split", "entity", "date", F.col("target").alias("actual"), F.col("mood_mean_daily").alias("predicted")
    )


def metric_sql(actual="actual", predicted="predicted", show=r) -> dict[str, str]:
    error = f"({actual} - {predicted})"
    spread = f"sum(pow({actual} - mean_actual, 2))"
    return {
        "r2": show(f"CASE WHEN count(*) > 1 AND {spread} > 1e-12 THEN 1 - sum({error} * {error}) / {spread} END"),
        "mae": show(f"avg(abs{error})"),
        "mse": show(f"avg({error} * {error})"),
        "rmse": show(f"sqrt(avg({error} * {error}))"),
    }


def named(parts: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in parts.items())


def centred(by: str, source: str = "predictions", actual: str = "actual") -> str:
    return f"(SELECT *, avg({actual}) OVER (PARTITION BY {by}) AS mean_actual FROM {source})"


@query(
    "regression_metrics",
    f"{WITH_PREDICTIONS} SELECT model, split, count(*) AS n, {named(metric_sql())} FROM {centred('model, split')} GROUP BY ALL",
)
def regression_metrics(spark, sf):
    return tidy(V.regression_metrics(predictions(spark, sf), ["model", "split"]))


@query(
    "missing_pairs",
    f"""{S.upto('ready', cut())} SELECT split, count(*) FILTER (WHERE entity % 4 = 0) AS n_missing FROM cut GROUP BY split""",
)
def missing_pairs(spark, sf):
    """Every fourth entity has no prediction."""
    rows = persistence(spark, sf).withColumn("predicted", F.when(F.col("entity") % 4 != 0, F.col("predicted")))
    return V.missing_pairs(rows, ["split"])


@query(
    "log_scale_metrics",
    f"""{S.upto('ready', cut(), PREDICTIONS)},
    l AS (SELECT model, split, ln(1 + actual) AS actual, ln(1 + predicted) AS predicted FROM predictions),
    e AS (SELECT *, exp(actual) - 1 AS a, exp(predicted) - 1 AS p FROM {centred('model, split', 'l')})
    SELECT model, split, count(*) AS n, {metric_sql()['r2']} AS r2, {r('avg(abs(a - p))')} AS mae,
    {r('sqrt(avg((a - p) * (a - p)))')} AS rmse FROM e GROUP BY ALL""",
)
def log_scale_metrics(spark, sf):
    logged = predictions(spark, sf).withColumns({c: F.log1p(c) for c in ("actual", "predicted")})
    return tidy(V.log_scale_metrics(logged, ["model", "split"]))


@query(
    "entity_error_report",
    f"""{WITH_PREDICTIONS}, {ONE_MODEL} SELECT entity, count(*) AS n, {named(metric_sql())},
    {r('max(abs(actual - predicted))')} AS max_error, {r('min(abs(actual - predicted))')} AS min_error,
    {r('avg(abs(actual - predicted))')} AS mean_error FROM {centred('entity', 'p')} GROUP BY entity""",
)
def entity_error_report(spark, sf):
    return tidy(V.entity_error_report(persistence(spark, sf)))


@query(
    "prediction_band",
    f"""{WITH_PREDICTIONS}, {ONE_MODEL}, b AS (SELECT *, abs(predicted - actual) AS abs_error,
      CASE WHEN count(*) OVER w > 2 THEN 1.96 * stddev_samp(abs(predicted - actual)) OVER w END AS half
      FROM p WINDOW w AS (PARTITION BY entity))
    SELECT entity, {D}, {r('actual')} AS actual, {r('predicted')} AS predicted, {r('predicted - actual')} AS error,
    {r('abs_error')} AS abs_error, {r('predicted - half')} AS lower, {r('predicted + half')} AS upper FROM b""",
)
def prediction_band(spark, sf):
    return tidy(V.prediction_band(persistence(spark, sf)).drop("split"))


_STATS = ", ".join(
    f"{r(f'{f}({side})')} AS {side}_{n}"
    for side in ("actual", "predicted")
    for n, f in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max"))
)


@query("prediction_stats", f"{WITH_PREDICTIONS} SELECT model, split, {_STATS} FROM predictions GROUP BY ALL")
def prediction_stats(spark, sf):
    return tidy(V.prediction_stats(predictions(spark, sf), ["model", "split"]))


@query(
    "sequence_dates",
    f"""{WITH_PREDICTIONS}, {ONE_MODEL} SELECT entity, {r('actual')} AS actual, {r('predicted')} AS predicted,
    CAST(CAST(DATE '2023-01-01' + CAST(row_number() OVER (PARTITION BY entity ORDER BY date) - 1 AS INTEGER) AS DATE) AS VARCHAR) AS date
    FROM p""",
)
def sequence_dates_query(spark, sf):
    undated = persistence(spark, sf).withColumnRenamed("date", "row_order").drop("split")
    return tidy(sequence_dates(undated, "row_order").drop("row_order"))


def class_predictions(spark, sf):
    """Tomorrow's class predicted by the class of today's change."""
    guess = X.class_of("change_mood_mean_daily", "ewma7_mood_std_daily")
    parts = split_ready(spark, sf).filter("categorical_target IS NOT NULL")
    return parts.selectExpr("split", "entity", "date", "categorical_target AS actual", f"{guess} AS predicted")


CLASS_PREDICTIONS = """
cp AS (SELECT split, entity, date, categorical_target AS actual,
  CASE WHEN change_mood_mean_daily > 0.5 * ewma7_mood_std_daily THEN 1
       WHEN change_mood_mean_daily < -0.5 * ewma7_mood_std_daily THEN -1 ELSE 0 END AS predicted
  FROM cut WHERE categorical_target IS NOT NULL),
k AS (SELECT unnest([-1, 0, 1]) AS k)"""
WITH_CLASSES = S.upto("ready", cut(), CLASS_PREDICTIONS)


@query(
    "confusion_matrix",
    f"""{WITH_CLASSES} SELECT CAST(a.k AS DOUBLE) AS actual, CAST(b.k AS DOUBLE) AS predicted,
    (SELECT count(*) FROM cp WHERE cp.actual = a.k AND cp.predicted = b.k) AS n FROM k a, k b""",
)
def confusion_matrix(spark, sf):
    return V.confusion_matrix(class_predictions(spark, sf), CLASSES)


def _class_sql(by: str) -> str:
    """Scores per class by counting predictions directly."""
    key, same = (f"{by}, ", f"AND cp.{by} = g.{by}") if by else ("", "")
    groups = f"(SELECT DISTINCT {by} FROM cp) g," if by else ""
    head = f"g.{by}, " if by else ""

    def counted(condition: str) -> str:
        return f"(SELECT count(*) FROM cp WHERE {condition} {same})"

    return f"""
pc0 AS (SELECT {head}k.k, {counted('cp.actual = k.k')} AS support, {counted('cp.predicted = k.k')} AS chosen,
  {counted('cp.actual = k.k AND cp.predicted = k.k')} AS hits FROM {groups} k),
pc1 AS (SELECT *, CASE WHEN chosen > 0 THEN hits / CAST(chosen AS DOUBLE) ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN hits / CAST(support AS DOUBLE) ELSE 0 END AS recall FROM pc0),
pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pc1)"""


_W = {s: f"sum({s} * support) / sum(support)" for s in V.SCORES}


@query(
    "classification_metrics",
    f"""{S.upto('ready', cut(), CLASS_PREDICTIONS, _class_sql('split'))}
    SELECT split, CAST(sum(support) AS BIGINT) AS n, {r('sum(hits) / sum(support)')} AS accuracy,
    {', '.join(f'{r(e)} AS {s}' for s, e in _W.items())} FROM pc GROUP BY split""",
)
def classification_metrics(spark, sf):
    matrix = V.confusion_matrix(class_predictions(spark, sf), CLASSES, ["split"])
    return tidy(V.classification_metrics(matrix, ["split"]))


@query(
    "classification_report",
    f"""{S.upto('ready', cut(), CLASS_PREDICTIONS, _class_sql(''))}
    SELECT CAST(CAST(k AS DOUBLE) AS VARCHAR) AS class, {S.rounded(V.SCORES)}, support FROM pc UNION ALL
    SELECT 'macro avg', {', '.join(r(f'avg({s})') for s in V.SCORES)}, CAST(sum(support) AS BIGINT) FROM pc UNION ALL
    SELECT 'weighted avg', {', '.join(r(e) for e in _W.values())}, CAST(sum(support) AS BIGINT) FROM pc""",
)
def classification_report(spark, sf):
    return tidy(V.classification_report(V.confusion_matrix(class_predictions(spark, sf), CLASSES)))


_CODE = "CASE {} WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE -1 END"


@query(
    "banded_confusion",
    f"""{WITH_PREDICTIONS}, {ONE_MODEL}, e AS (SELECT min(actual) AS lo, max(actual) AS hi FROM p),
    c AS (SELECT {_CODE.format(band_sql('actual', 'lo', 'hi'))} AS a, {_CODE.format(band_sql('predicted', 'lo', 'hi'))} AS b FROM p, e),
    k AS (SELECT unnest([-1, 0, 1, 2]) AS k)
    SELECT CAST(x.k AS INTEGER) AS actual, CAST(y.k AS INTEGER) AS predicted,
    (SELECT count(*) FROM c WHERE c.a = x.k AND c.b = y.k) AS n FROM k x, k y""",
)
def banded_confusion(spark, sf):
    return V.banded_confusion(persistence(spark, sf))


@query(
    "residual_bands",
    f"""{WITH_PREDICTIONS}, {ONE_MODEL}, e AS (SELECT min(actual) AS lo, max(actual) AS hi FROM p),
    b AS (SELECT actual - predicted AS x, {band_sql('actual', 'lo', 'hi')} AS band FROM p, e)
    SELECT band, count(*) AS n, {r('avg(x)')} AS mean_residual, {r('median(x)')} AS median_residual FROM b
    WHERE band IS NOT NULL GROUP BY band UNION ALL SELECT 'all', count(*), {r('avg(x)')}, {r('median(x)')} FROM b""",
)
def residual_bands(spark, sf):
    return tidy(V.residual_bands(persistence(spark, sf)))


# Experiments: forecast = weight * today + (1 - weight) * smoothed level, over spans and weights.
SPANS, WEIGHTS = (3, 7, 14), (0.0, 0.5, 1.0)
TRIALS = [(span, weight) for span in SPANS for weight in WEIGHTS]


def _forecasts(spark, sf):
    level = "mood_mean_daily"
    panel = trimmed_panel(B.clean(spark, sf), B.CATALOG, B.OVERRIDES).select("entity", "date", level)
    panel = I.fill_linear(panel, [level])
    for span in SPANS:
        panel = X.add_ewma(panel, [level], span)
    return chrono_split(X.add_next_day(panel, level))


def trials(spark, sf, by: list[str], part: str):
    """Scores of every (span, weight) on one part of the split, all in one pass over the rows."""
    error = {
        (s, w): F.col("target") - (F.col("mood_mean_daily") * w + F.col(f"ewma{s}_mood_mean_daily") * (1 - w))
        for s, w in TRIALS
    }
    spread = F.when(F.count("*") > 1, F.nullif(F.var_pop("target"), F.lit(0.0)))
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias("span"),
                F.lit(w).alias("weight"),
                F.count("*").alias("n"),
                F.avg(e * e).alias("mse"),
                F.avg(F.abs(e)).alias("mae"),
                (1 - F.avg(e * e) / spread).alias("r2"),
            )
            for (s, w), e in error.items()
        ]
    )
    scored = _forecasts(spark, sf).filter(F.col("split") == part).withColumn("dataset", F.col("entity") % 5)
    grouped = scored.groupBy(*by) if by else scored.groupBy()
    return grouped.agg(rows.alias("_rows")).select(*by, F.inline("_rows"))


def _trial_sql(part: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    spans = ",".join(
        S.ewma_cte("level", ["mood_mean_daily"], "date", f"sm{span}", span) for span in SPANS
    )
    joined = " ".join(f"JOIN sm{s} USING (entity, date)" for s in SPANS)
    smooth = ", ".join(f"sm{s}.ewma{s}_mood_mean_daily" for s in SPANS)
    cells = " UNION ALL ".join(
        f"""SELECT *, {s} AS span, CAST({w} AS DOUBLE) AS weight,
        target - ({w} * mood_mean_daily + (1 - {w}) * ewma{s}_mood_mean_daily) AS e FROM parts"""
        for s, w in TRIALS
    )
    over = f"PARTITION BY {key}span, weight"
    return f"""{S.upto('imputed')}, level AS (SELECT entity, date, mood_mean_daily FROM imputed), {spans},
    f AS (SELECT level.*, {smooth}, lead(level.mood_mean_daily) OVER (PARTITION BY entity ORDER BY date) AS target
      FROM level {joined}),
    g AS (SELECT * FROM f WHERE target IS NOT NULL), {cut(source='g', name='h')},
    parts AS (SELECT *, entity % 5 AS dataset FROM h WHERE split = '{part}'),
    cells AS (SELECT *, avg(target) OVER ({over}) AS m FROM ({cells})),
    trials AS (SELECT {key}span, weight, count(*) AS n, avg(e * e) AS mse, avg(abs(e)) AS mae,
      CASE WHEN count(*) > 1 THEN 1 - sum(e * e) / nullif(sum(pow(target - m, 2)), 0) END AS r2 FROM cells GROUP BY ALL)"""


_TRIAL_COLUMNS = f"span, weight, n, {r('mse')} AS mse, {r('mae')} AS mae, {r('r2')} AS r2"


@query("param_grid", f"{_trial_sql('val')} SELECT {_TRIAL_COLUMNS} FROM trials")
def param_grid(spark, sf):
    return tidy(trials(spark, sf, [], "val"))


@query(
    "best_trial",
    f"""{_trial_sql("val")}, numbered AS (SELECT span, weight, row_number() OVER (ORDER BY span, weight) - 1 AS trial FROM trials)
    SELECT trial, {_TRIAL_COLUMNS.replace('span,', 'span::BIGINT AS span,')} FROM trials JOIN numbered USING (span, weight) ORDER BY r2 DESC, trial LIMIT 1""",
)
def best_trial(spark, sf):
    """The best of a numbered grid, with its scores."""
    grid = V.parameter_grid(spark, {"span": list(SPANS), "weight": list(WEIGHTS)})
    return tidy(V.best_trial(F.broadcast(grid).join(trials(spark, sf, [], "val"), ["span", "weight"]), "r2"))


@query(
    "param_impact",
    f"""{_trial_sql('val')} SELECT 'span' AS parameter, CAST(span AS VARCHAR) AS setting, {r('avg(mse)')} AS mean_loss
    FROM trials GROUP BY span UNION ALL
    SELECT 'weight', CAST(weight AS VARCHAR), {r('avg(mse)')} FROM trials GROUP BY weight""",
)
def param_impact(spark, sf):
    return tidy(V.param_impact(trials(spark, sf, [], "val"), ["span", "weight"], "mse"))


def experiments(spark, sf):
    """Test scores per dataset (a fifth of the entities), approach (span) and model (weight)."""
    return tidy(trials(spark, sf, ["dataset"], "test"))


_EXPERIMENTS = f"{_trial_sql('test', 'dataset')}, x AS (SELECT dataset, {_TRIAL_COLUMNS} FROM trials)"


@query("experiment_results", f"{_EXPERIMENTS} SELECT * FROM x")
def experiment_results(spark, sf):
    return experiments(spark, sf)


@query(
    "melt_scores",
    f"{_EXPERIMENTS} "
    + " UNION ALL ".join(f"SELECT dataset, span, weight, '{s}' AS metric, {s} AS score FROM x" for s in ("r2", "mae", "mse")),
)
def melt_scores(spark, sf):
    return V.melt(experiments(spark, sf), ["dataset", "span", "weight"], ["r2", "mae", "mse"])


@query(
    "best_per_group",
    f"{_EXPERIMENTS} SELECT x.* FROM x JOIN (SELECT dataset, max(r2) AS r2 FROM x GROUP BY dataset) USING (dataset, r2)",
)
def best_per_group(spark, sf):
    return V.best_per_group(experiments(spark, sf), ["dataset"], "r2")


@query(
    "best_per_approach",
    f"""{_EXPERIMENTS} SELECT * EXCLUDE (k) FROM (SELECT *,
    row_number() OVER (PARTITION BY dataset, span ORDER BY r2 DESC, weight) AS k FROM x) WHERE k = 1""",
)
def best_per_approach(spark, sf):
    return V.best_row(experiments(spark, sf), ["dataset", "span"], "r2", "weight")


_SUMMARY = ", ".join(
    f"{r(f'{f}({s})')} AS {s}_{n}"
    for s in ("r2", "mae")
    for n, f in (("mean", "avg"), ("max", "max"), ("min", "min"), ("std", "stddev_samp"))
)


@query("experiment_summary", f"{_EXPERIMENTS} SELECT dataset, span, {_SUMMARY} FROM x GROUP BY ALL")
def experiment_summary(spark, sf):
    return tidy(V.score_summary(experiments(spark, sf), ["dataset", "span"], ["r2", "mae"]))
