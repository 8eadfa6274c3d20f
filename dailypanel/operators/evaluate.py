"""Model evaluation as table jobs on predictions (entity, date, actual, predicted, ...)."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailypanel.fixed import BAND_CODES, CONFIDENCE
from dailypanel.functions.wide import over, with_exprs
from dailypanel.operators.lookup import attach, settle
from dailypanel.operators.profile import add_value_bands, value_range
from dailypanel.operators.quantiles import exact_quantiles

def regression_aggregates(actual: str = "actual", predicted: str = "predicted") -> dict[str, Column]:
    """R2, MAE, MSE and RMSE of complete pairs; R2 is null for fewer than two pairs or a constant actual."""
    error = F.col(actual) - F.col(predicted)
    mse = F.avg(error * error)
    paired = F.when(error.isNotNull(), F.col(actual))
    spread = F.when(F.count(error) > 1, F.nullif(F.var_pop(paired), F.lit(0.0)))
    return {"r2": 1 - mse / spread, "mae": F.avg(F.abs(error)), "mse": mse, "rmse": F.sqrt(mse)}


def pairs() -> Column:
    """Rows that have both an actual and a predicted value."""
    return F.count(F.col("actual") - F.col("predicted"))


def missing_pairs(predictions: DataFrame, by: list[str]) -> DataFrame:
    """Rows that no metric can use, because one side is missing."""
    return predictions.groupBy(*by).agg((F.count("*") - pairs()).alias("n_missing"))


def regression_metrics(predictions: DataFrame, by: list[str]) -> DataFrame:
    """``n`` is the number of complete pairs; ``missing_pairs`` counts the others."""
    return predictions.groupBy(*by).agg(
        pairs().alias("n"), *[m.alias(name) for name, m in regression_aggregates().items()]
    )


def log_scale_metrics(predictions: DataFrame, by: list[str]) -> DataFrame:
    """Metrics of a log1p model: errors on the original scale, R2 on the log scale."""
    back = predictions.withColumns({"_a": F.expm1("actual"), "_p": F.expm1("predicted")})
    original = regression_aggregates("_a", "_p")
    return back.groupBy(*by).agg(
        pairs().alias("n"),
        regression_aggregates()["r2"].alias("r2"),
        original["mae"].alias("mae"),
        original["rmse"].alias("rmse"),
    )


def add_errors(predictions: DataFrame) -> DataFrame:
    error = F.col("predicted") - F.col("actual")
    return predictions.withColumns({"error": error, "abs_error": F.abs(error)})


def entity_error_report(predictions: DataFrame) -> DataFrame:
    """Metrics and error range of every entity."""
    return add_errors(predictions).groupBy("entity").agg(
        pairs().alias("n"),
        *[m.alias(name) for name, m in regression_aggregates().items()],
        F.max("abs_error").alias("max_error"),
        F.min("abs_error").alias("min_error"),
        F.avg("abs_error").alias("mean_error"),
    )


def prediction_band(predictions: DataFrame) -> DataFrame:
    """95 % band around each prediction from the entity's spread of absolute errors; needs three rows."""
    spread = f"CASE WHEN count(*) {over()} > 2 THEN {CONFIDENCE}D * stddev_samp(abs_error) {over()} END"
    banded = with_exprs(add_errors(predictions), {"_half": spread})
    return with_exprs(banded, {"lower": "predicted - _half", "upper": "predicted + _half"}).drop("_half")


def prediction_stats(predictions: DataFrame, by: list[str]) -> DataFrame:
    """Mean, population deviation, minimum and maximum of predictions and of actual values."""
    stats = [
        f(side).alias(f"{side}_{name}")
        for side in ("actual", "predicted")
        for name, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))
    ]
    return predictions.groupBy(*by).agg(*stats)


def confusion_matrix(predictions: DataFrame, classes: list, by: list[str] | None = None) -> DataFrame:
    """Rows (by..., actual, predicted, n) for every pair of the given classes, including empty cells.

    Every cell is a conditional count of one pass. Unlisted and missing classes are pooled in the class null; its cells are
    listed where they have rows, so that every row counts somewhere.
    """
    by = by or []

    def known(side: str) -> Column:
        return F.coalesce(F.col(side).isin(list(classes)), F.lit(False))

    def is_class(side: str, c) -> Column:
        return ~known(side) if c is None else F.coalesce(F.col(side) == c, F.lit(False))

    kind = dict(predictions.dtypes)
    cells = [
        F.struct(
            _listed(a, kind["actual"], classes).alias("actual"),
            _listed(p, kind["predicted"], classes).alias("predicted"),
            F.count_if(is_class("actual", a) & is_class("predicted", p)).alias("n"),
        )
        for a, p in product([*classes, None], repeat=2)
    ]
    grouped = predictions.groupBy(*by) if by else predictions.groupBy()
    listed = F.col("actual").isNotNull() & F.col("predicted").isNotNull()
    return grouped.agg(F.array(*cells).alias("_cells")).select(*by, F.inline("_cells")).filter(listed | (F.col("n") > 0))


def _listed(c, kind: str, classes: list) -> Column:
    """A class as a literal; null takes the type of the listed ones."""
    if c is not None:
        return F.lit(c)
    return F.when(F.lit(False), F.lit(classes[0])) if classes else F.lit(None).cast(kind)


def _per_class(confusion: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall, F1 and support of every class; an undefined ratio is 0."""
    long = confusion.select(
        *by,
        "n",
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("class"), F.lit("actual").alias("_side"), F.lit(0).alias("_hit")),
                F.struct(
                    F.col("predicted").alias("class"),
                    F.lit("predicted").alias("_side"),
                    F.coalesce(F.col("actual") == F.col("predicted"), F.lit(False)).cast("int").alias("_hit"),
                ),
            )
        ),
    )
    support = F.sum(F.when(F.col("_side") == "actual", F.col("n")).otherwise(0))
    chosen = F.sum(F.when(F.col("_side") == "predicted", F.col("n")).otherwise(0))
    hits = F.sum(F.col("n") * F.col("_hit"))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    counted = long.groupBy(*by, "class").agg(
        support.alias("support"), chosen.alias("_chosen"), hits.alias("_hits")
    )
    precision, recall = ratio(F.col("_hits"), F.col("_chosen")), ratio(F.col("_hits"), F.col("support"))
    rated = counted.withColumns({"precision": precision, "recall": recall})
    harmonic = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rated.withColumn("f1", harmonic)


SCORES = ("precision", "recall", "f1")


def _weighted(name: str) -> Column:
    return F.sum(F.col(name) * F.col("support")) / F.nullif(F.sum("support"), F.lit(0).cast("bigint"))


def classification_metrics(confusion: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 from a confusion matrix."""
    by = by or []
    rated = _per_class(confusion, by)
    grouped = rated.groupBy(*by) if by else rated.groupBy()
    accuracy = F.sum("_hits") / F.nullif(F.sum("support"), F.lit(0).cast("bigint"))
    return grouped.agg(
        F.sum("support").alias("n"), accuracy.alias("accuracy"), *[_weighted(s).alias(s) for s in SCORES]
    )


def classification_report(confusion: DataFrame) -> DataFrame:
    """One row per class and one each for the plain and the weighted average.

    The rates are written once (a row per class), so the predictions behind them are read once.
    """
    rated = settle(_per_class(confusion, []))
    classes = rated.select(F.coalesce(F.col("class").cast("string"), F.lit("other")).alias("class"), *SCORES, "support")
    macro = rated.agg(*[F.avg(s).alias(s) for s in SCORES], F.sum("support").alias("support"))
    weighted = rated.agg(*[_weighted(s).alias(s) for s in SCORES], F.sum("support").alias("support"))
    return classes.unionByName(macro.withColumn("class", F.lit("macro avg"))).unionByName(
        weighted.withColumn("class", F.lit("weighted avg"))
    )


def banded_confusion(predictions: DataFrame) -> DataFrame:
    """Confusion of value bands, both banded by the range of the actual values; no band is code -1."""
    ends = value_range(predictions, "actual")

    def code(name: str) -> Column:
        return F.coalesce(*[F.when(F.col(name) == band, k) for band, k in BAND_CODES.items()], F.lit(-1))

    banded = add_value_bands(predictions, "actual", "_a", ends)
    banded = add_value_bands(banded, "predicted", "_p", ends)
    coded = banded.select(code("_a").alias("actual"), code("_p").alias("predicted"))
    return confusion_matrix(coded, [-1, 0, 1, 2])


def residual_bands(predictions: DataFrame) -> DataFrame:
    """Mean and median residual over all rows and per band of the actual value."""
    predictions = settle(predictions.select("actual", "predicted"))
    residuals = add_value_bands(predictions, "actual").select(
        (F.col("actual") - F.col("predicted")).alias("residual"),
        F.explode(F.array_compact(F.array(F.lit("all"), F.col("band")))).alias("band"),
    )
    means = residuals.groupBy("band").agg(F.count("*").alias("n"), F.avg("residual").alias("mean_residual"))
    medians = exact_quantiles(residuals, ["residual"], [0.5], ["band"])
    return means.join(medians.select("band", F.col("value").alias("median_residual")), "band")


def melt(results: DataFrame, keys: list[str], scores: list[str]) -> DataFrame:
    return results.unpivot(keys, scores, "metric", "score")


def best_per_group(results: DataFrame, by: list[str], score: str) -> DataFrame:
    """Rows with the highest score of their group; ties are kept, and a missing group is a group. The results are written once.

    A group whose scores are all missing has no best row."""
    results = settle(results)
    best = results.groupBy(*by).agg(F.max(score).alias("_best"))
    best = attach(results, best, by) if by else results.join(best, F.col(score) == F.col("_best"))
    return best.filter(F.col(score) == F.col("_best")).select(*results.columns)


def best_row(results: DataFrame, by: list[str], score: str, tie: str) -> DataFrame:
    """One row per group: the highest score, the lowest ``tie`` among equals; a missing score is the worst."""
    key = F.struct(F.col(score).isNull(), -F.col(score), F.col(tie))
    rest = [c for c in results.columns if c not in by]
    return results.groupBy(*by).agg(F.min_by(F.struct(*rest), key).alias("_row")).select(*by, "_row.*")


def score_summary(results: DataFrame, by: list[str], scores: list[str]) -> DataFrame:
    stats = (("mean", F.avg), ("max", F.max), ("min", F.min), ("std", F.stddev_samp))
    return results.groupBy(*by).agg(*[f(s).alias(f"{s}_{name}") for s in scores for name, f in stats])


def param_impact(trials: DataFrame, params: list[str], loss: str) -> DataFrame:
    """Mean loss for every value of every parameter."""
    long = trials.select(*[F.col(p).cast("string").alias(p) for p in params], loss).unpivot(
        [loss], params, "parameter", "setting"
    )
    return long.groupBy("parameter", "setting").agg(F.avg(loss).alias("mean_loss"))


def grouped_importance(importances: DataFrame, sources: list[str], top: int = 10) -> DataFrame:
    """Importance added up by source column, the best ``top`` and the rest as "Other".

    ``importances`` has one row per model feature. Encoded features start with their source's name.
    """
    source = F.coalesce(
        *[F.when(F.col("feature").startswith(f"{s}_"), s) for s in sources], F.col("feature")
    )
    summed = settle(importances.groupBy(source.alias("source")).agg(F.sum("importance").alias("importance")))
    best = summed.orderBy(F.desc("importance"), "source").limit(top)
    kept = best.select("source", F.lit(True).alias("_kept"))
    label = F.when(F.col("_kept"), F.col("source")).otherwise("Other")
    return (
        summed.join(kept, "source", "left")
        .groupBy(label.alias("source"))
        .agg(F.sum("importance").alias("importance"))
    )


def parameter_grid(spark: SparkSession, grid: dict[str, list]) -> DataFrame:
    """One row per combination of settings, numbered from 0 in the order of the lists; the lists come from the caller."""
    rows = [(k, *combination) for k, combination in enumerate(product(*grid.values()))]
    return spark.createDataFrame(rows, ["trial", *grid])


def best_trial(trials: DataFrame, score: str, largest: bool = True) -> DataFrame:
    """The trial with the best score, the first of equals; a missing score is the worst."""
    order = F.col(score).desc_nulls_last() if largest else F.col(score).asc_nulls_last()
    return trials.orderBy(order, "trial").limit(1)


def concat(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames with different columns; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
