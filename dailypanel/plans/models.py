"""Models on MLlib: the same estimators by name, penalties given as in the usual per-row objectives.

Rows go in as (entity, date, split, features..., label). Training rows stay distributed; only coefficients,
trees and metrics reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Transformer
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailypanel.fixed import CLASSIFICATION_GRIDS, REGRESSION_GRIDS
from dailypanel.functions.expressions import hash_fraction
from dailypanel.operators.correlate import top_correlated
from dailypanel.operators.evaluate import classification_metrics, confusion_matrix, regression_metrics
from dailypanel.operators.lookup import attach
from dailypanel.plans.boosting import TASK_ROWS, SoftmaxBoosting
from dailypanel.plans.kernel import KernelSVC
from dailypanel.plans.linear import METRICS, linear_learning_curve, search_linear

SEED = 42


def assembled(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Feature vector and label; rows with a missing feature or label cannot be used and are left out."""
    keep = [c for c in ("entity", "date", "split", "fold") if c in df.columns]
    complete = df.na.drop(subset=[*features, label]).withColumn("label", F.col(label).cast("double"))
    return VectorAssembler(inputCols=features, outputCol="features").transform(complete).select(
        *keep, "features", "label"
    )


def class_labels(df: DataFrame, column: str = "categorical_target") -> DataFrame:
    """Classes -1, 0, 1 as labels 0, 1, 2."""
    return df.withColumn("class_label", F.col(column) + 1)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): balanced weights, rows / (classes * rows of the class). One row per class; missing labels have none."""
    counted = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(0))
    return counted.withColumn("weight", F.sum("n").over(every) / (F.count("*").over(every) * F.col("n")))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Rows with the balanced weight of their class, for an estimator's ``weightCol``."""
    return attach(df, class_weights(df, label).select(label, F.col("weight").alias(name)), [label], "left")


def _label_spread(train: DataFrame) -> tuple[float, int]:
    row = train.agg(F.stddev_samp("label"), F.count("label")).first()
    return float(row[0] or 1.0), int(row[1])


def linear_regression() -> R.LinearRegression:
    return R.LinearRegression(regParam=0.0, standardization=False)


def _ridge_strength(alpha: float, spread: float, n: int) -> tuple[float, float]:
    return alpha * spread / n, 0.0


def _net_strength(alpha: float, l1_ratio: float, spread: float) -> tuple[float, float]:
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    strength = l1 + l2 * spread
    return strength, l1 / strength if strength else 0.0


def ridge(train: DataFrame, alpha: float) -> R.LinearRegression:
    """Squared error sum + alpha * squared norm. Spark divides by n and by the label's spread."""
    return _penalised(*_ridge_strength(alpha, *_label_spread(train)))


def elastic_net(train: DataFrame, alpha: float, l1_ratio: float) -> R.LinearRegression:
    """Half mean squared error + alpha * (ratio * l1 + (1 - ratio)/2 * l2); ratio 1 is the lasso."""
    return _penalised(*_net_strength(alpha, l1_ratio, _label_spread(train)[0]))


def _penalised(strength: float, ratio: float) -> R.LinearRegression:
    return R.LinearRegression(
        regParam=strength, elasticNetParam=ratio, standardization=False, solver="l-bfgs", maxIter=200, tol=1e-7
    )


#: How each regression model of an experiment is made from its training rows; only penalised ones look at them.
REGRESSORS = {
    "linear": lambda train: linear_regression(),
    "ridge": lambda train: ridge(train, 1.0),
    "lasso": lambda train: elastic_net(train, 1.0, 1.0),
    "elastic_net": lambda train: elastic_net(train, 1.0, 0.5),
    "tree": lambda train: R.DecisionTreeRegressor(maxDepth=5, seed=SEED),
    "forest": lambda train: R.RandomForestRegressor(numTrees=100, maxDepth=5, seed=SEED),
    "boosted": lambda train: R.GBTRegressor(maxIter=20, maxDepth=3, stepSize=0.1, seed=SEED),
}


def regressor(name: str, train: DataFrame) -> R.Regressor:
    return REGRESSORS[name](train)


def regressors(train: DataFrame) -> dict[str, R.Regressor]:
    """All regression models of an experiment."""
    return {name: regressor(name, train) for name in REGRESSORS}


def classifiers() -> dict:
    """The classification models; the linear machine is binary in Spark, so one against the rest."""
    return {
        "logistic": C.LogisticRegression(family="multinomial", maxIter=100),
        "tree": C.DecisionTreeClassifier(maxDepth=5, seed=SEED),
        "forest": C.RandomForestClassifier(numTrees=100, maxDepth=5, seed=SEED),
        "boosted": SoftmaxBoosting(),
        "kernel_svc": KernelSVC(rounds=20, seed=SEED),
        "linear_svc": C.OneVsRest(classifier=C.LinearSVC(maxIter=50, regParam=0.01), parallelism=3),
    }


def predicted(model: Transformer, rows: DataFrame) -> DataFrame:
    """Predictions in the shape the evaluation operators read."""
    keep = [c for c in ("entity", "date", "split") if c in rows.columns]
    return model.transform(rows).select(
        *keep, F.col("label").alias("actual"), F.col("prediction").alias("predicted")
    )


def fit_predict(estimator, rows: DataFrame) -> DataFrame:
    """Fit on the training part and predict all parts."""
    return predicted(estimator.fit(rows.filter("split = 'train'")), rows)


def coefficients(model, features: list[str], spark) -> DataFrame:
    """One row per model feature; a short list that comes from the fitted model."""
    values = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    rows = [(f, float(v)) for f, v in zip(features, values.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


def with_folds(df: DataFrame, folds: int = 3) -> DataFrame:
    """Fold number by entity and day, so that all rows of a day share a fold."""
    day = F.concat_ws("_", F.lit("fold"), F.col("entity").cast("string"), F.col("date").cast("string"))
    return df.withColumn("fold", F.floor(hash_fraction(day) * folds).cast("int"))


def _is_regression(metric: str) -> bool:
    return metric in ("rmse", "mse", "r2", "mae")


def _search(rows: DataFrame, estimator, combinations: list[dict], metric: str, folds: int, parallelism: int):
    """Cross-validate parameter combinations over the column ``fold``."""
    evaluator = RegressionEvaluator if _is_regression(metric) else MulticlassClassificationEvaluator
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=combinations,
        evaluator=evaluator(metricName=metric),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(rows)


def grid_search(
    rows: DataFrame, estimator, grid: dict[str, list], metric: str, folds: int = 3, parallelism: int = 4
) -> DataFrame:
    """Mean cross-validated metric of every parameter combination.

    ``rows`` needs the column ``fold``. Metrics of classifiers are those of the multiclass evaluator. Depths of a regression tree share a fit.
    """
    combinations = combined(estimator, grid)
    if isinstance(estimator, R.DecisionTreeRegressor) and estimator.maxDepth.name in grid and _is_regression(metric):
        means = _tree_search(rows, estimator, combinations, metric, folds, parallelism)
    else:
        means = _search(rows, estimator, combinations, metric, folds, parallelism).avgMetrics
    settings = [
        (i, ", ".join(f"{p.name}={v}" for p, v in sorted(c.items(), key=lambda kv: kv[0].name)), metric, float(m))
        for i, (c, m) in enumerate(zip(combinations, means))
    ]
    return rows.sparkSession.createDataFrame(settings, "trial int, setting string, metric string, score double")


def _tree_search(rows: DataFrame, tree: R.DecisionTreeRegressor, combinations: list[dict], metric: str, folds: int, parallelism: int) -> list[float]:
    """Mean metric over the folds of every combination of a tree's parameters: one fit for all depths, one pass for all trees of a fold.

    A node is split by its own rows alone, so a tree of a smaller ``maxDepth`` is the deepest one cut off at that level.
    """
    depth = tree.maxDepth
    at = lambda c: tuple(sorted(((p.name, v) for p, v in c.items() if p != depth)))
    deepest = {}
    for c in combinations:
        if at(c) not in deepest or c[depth] > deepest[at(c)][depth]:
            deepest[at(c)] = c
    groups = list(deepest)
    known = rows.persist(StorageLevel.MEMORY_AND_DISK)
    scores = []
    try:
        for fold in range(folds):
            train, test = known.filter(F.col("fold") != fold), known.filter(F.col("fold") == fold)
            for part, side in ((train, "training"), (test, "validation")):
                if part.isEmpty():
                    raise ValueError(f"The {side} data at fold {fold} is empty.")
            with ThreadPoolExecutor(max(1, min(parallelism, len(groups)))) as pool:
                fits = [pool.submit(inheritable_thread_target(rows.sparkSession)(tree.fit), train, deepest[g]) for g in groups]
                models = [f.result() for f in fits]
            scored = test.select(tree.getFeaturesCol(), F.col(tree.getLabelCol()).cast("double").alias("label"))
            for i, model in enumerate(models):
                model.setPredictionCol(f"_p{i}").setLeafCol(f"_leaf{i}")
                scored = model.transform(scored)
            paths = [_leaf_paths(model._call_java("rootNode")) for model in models]
            cut = [_at_depth(paths[groups.index(at(c))], F.col(f"_leaf{groups.index(at(c))}"), c[depth]) for c in combinations]
            scores.append(_errors(scored, cut, metric))
    finally:
        known.unpersist()
    return [sum(s) / folds for s in zip(*scores)]


def _leaf_paths(node, above: tuple[float, ...] = ()) -> list[list[float]]:
    """For every leaf, in the order of their numbers, the predictions of the nodes from the root to it."""
    here = (*above, float(node.prediction()))
    if node.subtreeDepth() == 0:
        return [list(here)]
    return _leaf_paths(node.leftChild(), here) + _leaf_paths(node.rightChild(), here)


def _at_depth(paths: list[list[float]], leaf: Column, depth: int) -> Column:
    """The prediction of the tree cut off at ``depth`` for rows that reach ``leaf``."""
    values = F.array(*[F.lit(path[min(depth, len(path) - 1)]) for path in paths])
    return F.element_at(values, leaf.cast("int") + 1)


def _errors(rows: DataFrame, predictions: list[Column], metric: str) -> list[float]:
    """``metric`` of each of the predictions of ``label``, as the regression evaluator defines it, from one pass."""
    off = [F.col("label") - p for p in predictions]
    each = [F.avg(F.abs(e) if metric == "mae" else e * e) for e in off]
    found = rows.agg(F.var_pop("label").alias("spread"), *[e.alias(f"e{i}") for i, e in enumerate(each)]).first()
    errors = np.array(found[1:], float)
    if metric == "r2":
        with np.errstate(divide="ignore", invalid="ignore"):
            return list(1 - errors / np.float64(found["spread"]))
    return list(np.sqrt(errors) if metric == "rmse" else errors)


def combined(estimator, grid: dict[str, list]) -> list[dict]:
    """Every combination of a grid of Spark parameters."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def penalty_combinations(name: str, train: DataFrame, grid: dict[str, list]) -> list[dict]:
    """Combinations of the penalty grids in Spark's parameters."""
    if name == "logistic":
        n = train.count()
        model = classifiers()[name]
        return [{model.regParam: 1.0 / (c * n)} for c in grid["C"]]
    estimator, spread_n = R.LinearRegression, _label_spread(train)
    settings = []
    for alpha in grid["alpha"]:
        if name == "ridge":
            settings.append(_ridge_strength(alpha, *spread_n))
        else:
            ratios = grid.get("l1_ratio", [1.0])
            settings += [_net_strength(alpha, ratio, spread_n[0]) for ratio in ratios]
    return [{estimator.regParam: strength, estimator.elasticNetParam: ratio} for strength, ratio in settings]


def tuned_model(
    name: str, rows: DataFrame, metric: str = "r2", grid: dict | None = None, folds: int = 3, parallelism: int = 4
):
    """Best model of a tuning grid, fitted on all ``rows``; an empty grid is just fitted, a model without one is an error.

    Linear models are tuned from moments, in one pass over ``rows``, unless the metric needs the rows themselves."""
    regression = _is_regression(metric)
    grids = REGRESSION_GRIDS if regression else CLASSIFICATION_GRIDS
    if grid is None and name not in grids:
        raise ValueError(f"there is no tuning grid for {name}: give one")
    grid = grids[name] if grid is None else grid
    if name in ("ridge", "lasso", "elastic_net") and grid and metric in METRICS:
        return search_linear(name, rows, grid, metric).model
    estimator = regressor(name, rows) if regression else classifiers()[name]
    if not grid:
        return estimator.fit(rows)
    penalised = "alpha" in grid or "C" in grid
    if penalised:
        combinations = [
            {estimator.getParam(p.name): v for p, v in c.items()} for c in penalty_combinations(name, rows, grid)
        ]
    else:
        combinations = combined(estimator, grid)
    return _search(rows, estimator, combinations, metric, folds, parallelism).bestModel


def learning_curve(rows: DataFrame, estimator, shares: list[float], folds: int = 3) -> DataFrame:
    """Train and test RMSE, mean and population deviation over folds, by share of the training rows.

    Growing shares are nested: a row is in when the hash of its entity and day is below the share. A fold without training
    rows at a share counts with 0 rows and no RMSE. Least squares need one pass for the whole curve, other estimators a fit for each point.
    """
    if isinstance(estimator, R.LinearRegression) and estimator.getRegParam() == 0:
        return linear_learning_curve(rows, shares, folds)
    at = hash_fraction(F.concat_ws("_", F.col("entity").cast("string"), F.col("date").cast("string")))
    placed = rows.withColumn("at", at)
    least = {r["fold"]: r["least"] for r in placed.groupBy("fold").agg(F.min("at").alias("least")).collect()}
    scored = None
    for share in shares:
        for fold in range(folds):
            if not any(at < share for k, at in least.items() if k != fold):
                one = rows.sparkSession.createDataFrame(
                    [(float(share), side, 0, None) for side in ("train", "test")], "share double, side string, n long, rmse double"
                )
                scored = one if scored is None else scored.unionByName(one)
                continue
            train = placed.filter((F.col("fold") != fold) & (F.col("at") < share))
            model = estimator.fit(train)
            for side, part in (("train", train), ("test", placed.filter(F.col("fold") == fold))):
                one = regression_metrics(predicted(model, part), []).select(
                    F.lit(float(share)).alias("share"), F.lit(side).alias("side"), "n", "rmse"
                )
                scored = one if scored is None else scored.unionByName(one)
    return scored.groupBy("share", "side").agg(
        F.avg("n").alias("mean_rows"), F.avg("rmse").alias("rmse_mean"), F.stddev_pop("rmse").alias("rmse_std")
    )


def feature_sets(
    df: DataFrame, features: list[str], target: str, baseline: str, top: int
) -> dict[str, list[str]]:
    """One baseline feature, the ``top`` correlated ones, all of them; ``top`` names come to the driver."""
    best = [r["variable"] for r in top_correlated(df, features, target, top).collect()]
    return {"baseline": [baseline], "top_correlated": best, "all_features": list(features)}


def experiment_grid(
    df: DataFrame, features: list[str], target: str, baseline: str, top: int, models: list[str] | None = None
) -> DataFrame:
    """Regression metrics of every model on every feature set and part of the split."""

    names = models or list(REGRESSION_GRIDS)

    def score(rows: DataFrame) -> DataFrame:
        return _regression_scores(rows, fitted_regressors(rows.filter("split = 'train'"), names))

    return _over_feature_sets(df, features, target, baseline, top, score)


def fitted_regressors(train: DataFrame, names: list[str], parallelism: int = 4) -> dict:
    """The named models fitted on the same rows, which are read once and kept while the fits last."""
    return _fitted(train, names, regressor, parallelism)


def fitted_classifiers(train: DataFrame, names: list[str], parallelism: int = 4) -> dict:
    """The same for classifiers, in tasks of TASK_ROWS rows: the linear machines pass over them some thousand times."""
    few = train.coalesce(1 + train.count() // TASK_ROWS)
    return _fitted(few, names, lambda name, kept: classifiers()[name], parallelism)


def _fitted(train: DataFrame, names: list[str], estimator: Callable, parallelism: int) -> dict:
    kept = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            fit = inheritable_thread_target(train.sparkSession)(lambda name: estimator(name, kept).fit(kept))
            return dict(zip(names, pool.map(fit, names)))
    finally:
        kept.unpersist()


def _regression_scores(rows: DataFrame, models: dict) -> DataFrame:
    """Metrics of every model and part of the split, from one pass over the rows."""
    scored = rows.select("split", "features", F.col("label").alias("actual"))
    for i, model in enumerate(models.values()):
        scored = model.copy({model.predictionCol: f"_p{i}"}).transform(scored)
    pairs = [F.struct(F.lit(name).alias("model"), F.col(f"_p{i}").alias("predicted")) for i, name in enumerate(models)]
    each = scored.select("split", "actual", F.inline(F.array(*pairs)))
    metrics = regression_metrics(each, ["split", "model"])
    return metrics.select(*[c for c in metrics.columns if c != "model"], "model")


def class_experiment_grid(
    df: DataFrame,
    features: list[str],
    target: str,
    classes: list[float],
    baseline: str,
    top: int,
    models: list[str] | None = None,
) -> DataFrame:
    """Accuracy and weighted precision, recall and F1 of every classifier, feature set and part of the split."""

    def score(rows: DataFrame) -> DataFrame:
        found = []
        for name, model in fitted_classifiers(rows.filter("split = 'train'"), models or list(classifiers())).items():
            matrix = confusion_matrix(predicted(model, rows), classes, ["split"])
            found.append(classification_metrics(matrix, ["split"]).withColumn("model", F.lit(name)))
        return reduce(DataFrame.unionByName, found)

    return _over_feature_sets(df, features, target, baseline, top, score)


def _over_feature_sets(df, features, target, baseline, top, score) -> DataFrame:
    """What ``score`` finds on the assembled rows of every feature set; its last column is the model."""
    found = []
    for approach, chosen in feature_sets(df.filter("split = 'train'"), features, target, baseline, top).items():
        scores = score(assembled(df, chosen, target))
        found.append(scores.select(*scores.columns[:-1], F.lit(approach).alias("approach"), "model"))
    return reduce(DataFrame.unionByName, found)


def ols_line(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """One-feature least squares per group, in one aggregation."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double"))
    vx, vy, cxy = F.var_pop(xs), F.var_pop(ys), F.covar_pop(xs, ys)
    slope = cxy / F.nullif(vx, F.lit(0.0))
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(
        F.count(xs).alias("n"),
        slope.alias("slope"),
        (F.avg(ys) - slope * F.avg(xs)).alias("intercept"),
        (cxy * cxy / F.nullif(vx * vy, F.lit(0.0))).alias("r2"),
    )
