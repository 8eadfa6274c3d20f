"""Models on the ready panel. Fits have no SQL counterpart; their tests are in tests/test_models.py."""

from __future__ import annotations

from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.sql import functions as F

from dailypanel.fixed import REGRESSION_GRIDS
from dailypanel.operators import evaluate as V
from dailypanel.operators.correlate import target_correlation
from dailypanel.operators.lookup import for_passes, settle
from dailypanel.operators.scale import scale_by_entity
from dailypanel.operators.split import chrono_split, group_hash_split
from dailypanel.plans import models as M
from dailypanel.plans.boosting import SoftmaxBoosting
from dailypanel.plans.kernel import KernelSVC
from dailypanel.queries import bindings as B
from dailypanel.queries import sql as S
from dailypanel.queries.panels import ready
from dailypanel.queries.registry import query, r, tidy

FEATURES = S.LEVELS + ["sleep_daily"] + [f"change_{c}" for c in S.LEVELS] + [f"ewma7_{c}" for c in S.LEVELS]


@query(
    "baseline_ols",
    f"""SELECT l_returnflag, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n, {r('regr_slope(l_extendedprice, l_quantity)')} AS slope,
    {r('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept, {r('regr_r2(l_extendedprice, l_quantity)')} AS r2
    FROM lineitem GROUP BY l_returnflag""",
)
def baseline_ols(spark, sf):
    line = M.ols_line(B.table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    four = tidy(line.select("l_returnflag", "intercept"), 4)
    return tidy(line.drop("intercept")).join(four, "l_returnflag")


def scaled_rows(spark, sf, target: str = "target", kind: str = "standard"):
    """Ready panel, split by entity-day, scaled by entity; written once because every fit reads it often."""
    columns = ["entity", "date", "target", "categorical_target", *FEATURES]
    parts = group_hash_split(ready(spark, sf).select(*columns), test=0.1, val=0.1)
    return for_passes(settle(scale_by_entity(parts, FEATURES, kind).filter(F.col(target).isNotNull())))


def _regression(name: str, build):
    @query(name)
    def run(spark, sf):
        rows = M.assembled(scaled_rows(spark, sf), FEATURES, "target")
        predictions = M.fit_predict(build(rows.filter("split = 'train'")), rows)
        return tidy(V.regression_metrics(predictions, ["split"]))

    return run


_regression("fit_linear", lambda train: M.linear_regression())
_regression("fit_elastic_net", lambda train: M.elastic_net(train, 0.5, 0.5))
_regression("fit_ridge", lambda train: M.ridge(train, 1.0))
_regression("fit_forest", lambda train: R.RandomForestRegressor(numTrees=100, maxDepth=5, seed=M.SEED))
_regression("fit_gbt", lambda train: R.GBTRegressor(maxIter=10, maxDepth=3, seed=M.SEED))


def _classification(name: str, build):
    @query(name)
    def run(spark, sf):
        rows = scaled_rows(spark, sf, "categorical_target", "minmax")
        rows = M.assembled(M.class_labels(rows), FEATURES, "class_label")
        predictions = M.fit_predict(build(), rows)
        return tidy(V.classification_metrics(V.confusion_matrix(predictions, [0.0, 1.0, 2.0], ["split"]), ["split"]))

    return run


_classification("fit_logistic", lambda: C.LogisticRegression(family="multinomial", maxIter=50))
_classification("fit_forest_classifier", lambda: C.RandomForestClassifier(numTrees=100, maxDepth=5, seed=M.SEED))
_classification("fit_gbt_classifier", lambda: SoftmaxBoosting())
_classification("fit_kernel_svc", lambda: KernelSVC(seed=M.SEED))
_classification("fit_linear_svc", lambda: C.OneVsRest(classifier=C.LinearSVC(maxIter=20, regParam=0.01)))


@query("grid_search")
def grid_search(spark, sf):
    rows = M.assembled(M.with_folds(scaled_rows(spark, sf)), FEATURES, "target")
    return tidy(M.grid_search(rows, R.DecisionTreeRegressor(seed=M.SEED), REGRESSION_GRIDS["tree"], "r2"))


#: The reference's training sizes: linspace(0.01, 1, 20).
SHARES = [0.01 + 0.99 * k / 19 for k in range(19)] + [1.0]


@query("learning_curve")
def learning_curve(spark, sf):
    rows = M.assembled(M.with_folds(scaled_rows(spark, sf)), FEATURES, "target")
    return tidy(M.learning_curve(rows, M.linear_regression(), SHARES))


@query("experiment_grid")
def experiment_grid(spark, sf):
    rows = scaled_rows(spark, sf)
    return tidy(M.experiment_grid(rows, FEATURES, "target", "mood_mean_daily", 5))


@query("class_experiment_grid")
def class_experiment_grid(spark, sf):
    rows = M.class_labels(scaled_rows(spark, sf, "categorical_target", "minmax"))
    return tidy(M.class_experiment_grid(rows, FEATURES, "class_label", [0.0, 1.0, 2.0], "mood_mean_daily", 5))


_SQUARES = "t AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, pow(corr({c}, target), 2) AS importance FROM ready" for c in FEATURES
) + ")"


@query(
    "grouped_importance",
    f"""{S.upto('ready', _SQUARES)},
    g AS (SELECT CASE WHEN starts_with(feature, 'change_') THEN 'change' WHEN starts_with(feature, 'ewma7_') THEN 'ewma7'
      ELSE feature END AS source, sum(importance) AS importance FROM t GROUP BY 1),
    k AS (SELECT *, row_number() OVER (ORDER BY importance DESC, source) AS k FROM g)
    SELECT CASE WHEN k <= 6 THEN source ELSE 'Other' END AS source, {r('sum(importance)')} AS importance FROM k GROUP BY 1""",
)
def grouped_importance(spark, sf):
    """Squared correlations as importances, added up by the family a feature belongs to."""
    found = target_correlation(ready(spark, sf), FEATURES, "target").select(
        F.col("variable").alias("feature"), (F.col("r") * F.col("r")).alias("importance")
    )
    return tidy(V.grouped_importance(found, ["change", "ewma7"], 6))


@query("forest_importance")
def forest_importance(spark, sf):
    """Forest importances added up by the column a feature was derived from."""
    rows = M.assembled(scaled_rows(spark, sf), FEATURES, "target").filter("split = 'train'")
    model = R.RandomForestRegressor(numTrees=20, maxDepth=5, seed=M.SEED).fit(rows)
    found = M.coefficients(model, FEATURES, spark)
    return tidy(V.grouped_importance(found, ["change", "ewma7"], 10))
