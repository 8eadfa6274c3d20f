"""Fitted models against closed forms and objectives."""

import numpy as np
import pytest

from dailypanel.operators.evaluate import regression_metrics
from dailypanel.plans import models as M

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(2)
    x = rng.normal(0, [1, 3], (300, 2))
    return x, 2 * x[:, 0] - 0.5 * x[:, 1] + 4 + rng.normal(0, 0.5, 300)


def rows(spark, x, y):
    listed = [(i, "train" if i % 4 else "test", float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(listed, "entity bigint, split string, a double, b double, y double").coalesce(2)
    return M.assembled(df.selectExpr("*", "date_add(DATE '2024-01-01', CAST(entity % 30 AS INT)) AS date"), FEATURES, "y")


def test_linear_on_noiseless_data(spark, data):
    x, _ = data
    model = M.linear_regression().fit(rows(spark, x, 2 * x[:, 0] - 0.5 * x[:, 1] + 4))
    np.testing.assert_allclose(model.coefficients, [2, -0.5], atol=1e-8)
    assert model.intercept == pytest.approx(4)


def test_ridge_closed_form(spark, data):
    x, y = data
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 50 * np.eye(2), xc.T @ yc)
    train = rows(spark, x, y)
    np.testing.assert_allclose(M.ridge(train, 50.0).fit(train).coefficients, want, rtol=1e-5)


@pytest.mark.parametrize("alpha,ratio", [(0.3, 1.0), (0.3, 0.5)])
def test_elastic_net_minimises_its_objective(spark, data, alpha, ratio):
    x, y = data
    train = rows(spark, x, y)
    got = np.array(M.elastic_net(train, alpha, ratio).fit(train).coefficients)
    xc, yc = x - x.mean(0), y - y.mean()
    beta = np.zeros(2)
    for _ in range(500):
        for j in range(2):
            rest = yc - xc @ beta + xc[:, j] * beta[j]
            rho = xc[:, j] @ rest / len(y)
            beta[j] = np.sign(rho) * max(abs(rho) - alpha * ratio, 0) / (xc[:, j] @ xc[:, j] / len(y) + alpha * (1 - ratio))
    np.testing.assert_allclose(got, beta, rtol=1e-4)


def test_metrics_are_those_of_the_predictions(spark, data):
    predictions = M.fit_predict(M.linear_regression(), rows(spark, *data))
    pdf = predictions.toPandas()
    for row in regression_metrics(predictions, ["split"]).collect():
        part = pdf[pdf["split"] == row["split"]]
        sse = ((part["actual"] - part["predicted"]) ** 2).sum()
        sst = ((part["actual"] - part["actual"].mean()) ** 2).sum()
        assert row["r2"] == pytest.approx(1 - sse / sst) and row["n"] == len(part)


def test_every_model_fits(spark, data):
    x, y = data
    train = rows(spark, x, y)
    for name, estimator in M.regressors(train).items():
        assert M.fit_predict(estimator, train).count() == 300, name
    classes = rows(spark, x, np.digitize(y, [2, 6]).astype(float))
    for name, estimator in M.classifiers().items():
        predicted = M.fit_predict(estimator, classes).toPandas()
        assert (predicted["actual"] == predicted["predicted"]).mean() > 0.5, name


@pytest.mark.parametrize("name,metric", [("ridge", "r2"), ("elastic_net", "mse"), ("linear", "r2"), ("logistic", "accuracy")])
def test_tuning(spark, data, name, metric):
    x, y = data
    folded = M.with_folds(rows(spark, x, y if metric != "accuracy" else (y > 4).astype(float)))
    small = {"ridge": {"alpha": [0.1, 1e5]}, "elastic_net": {"alpha": [0.001, 5.0], "l1_ratio": [0.5]}, "logistic": {"C": [1e-6, 1.0]}}
    model = M.tuned_model(name, folded, metric, grid=small.get(name))
    scored = M.predicted(model, folded)
    if metric == "accuracy":
        assert scored.filter("actual = predicted").count() > 240
    else:
        assert regression_metrics(scored, []).first()["r2"] > 0.8


def test_folds_and_search(spark, data):
    folded = M.with_folds(rows(spark, *data))
    assert {r["fold"] for r in folded.select("fold").distinct().collect()} == {0, 1, 2}
    found = M.grid_search(folded, M.linear_regression(), {"regParam": [0.0, 100.0]}, "r2").orderBy("trial").collect()
    assert found[0]["score"] > found[1]["score"]


@pytest.mark.parametrize("metric", ["r2", "rmse", "mae"])
def test_tree_grids_share_fits_over_depths(spark, data, metric, monkeypatch):
    from pyspark.ml import regression as R

    x, y = data
    folded = M.with_folds(rows(spark, x, y)).cache()
    tree, grid, fits = R.DecisionTreeRegressor(seed=M.SEED), {"maxDepth": [1, 2, 3, 5], "minInstancesPerNode": [1, 30]}, []
    want = M._search(folded, tree, M.combined(tree, grid), metric, 3, 4).avgMetrics
    fit = R.DecisionTreeRegressor._fit
    monkeypatch.setattr(R.DecisionTreeRegressor, "_fit", lambda self, df: fits.append(self.getMaxDepth()) or fit(self, df))
    found = [r["score"] for r in M.grid_search(folded, tree, grid, metric).orderBy("trial").collect()]
    assert found == pytest.approx(want, rel=1e-9) and len(set(np.round(found, 6))) > 5
    assert fits == [5] * 6


def test_tree_grid_with_an_empty_fold(spark, data):
    from pyspark.ml import regression as R

    folded = M.with_folds(rows(spark, *data)).filter("fold <> 1")
    with pytest.raises(ValueError, match="fold 1 is empty"):
        M.grid_search(folded, R.DecisionTreeRegressor(), {"maxDepth": [1, 2]}, "r2")


def test_experiment_scores_a_feature_set_in_one_pass(spark, data):
    x, y = data
    listed = [(i, "train" if i % 4 else "test", float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(listed, "entity bigint, split string, a double, b double, y double").coalesce(2).cache()
    df = df.withColumn("date", M.F.lit("2024-01-01").cast("date"))
    names = ["linear", "ridge", "tree"]
    found = M.experiment_grid(df, FEATURES, "y", "a", 1, names)
    assert found.columns[:2] == ["split", "n"] and found.columns[-2:] == ["approach", "model"]
    got = {(r["approach"], r["model"], r["split"]): r for r in found.collect()}
    assert len(got) == 3 * len(names) * 2
    for approach, chosen in (("baseline", ["a"]), ("all_features", FEATURES)):
        some = M.assembled(df, chosen, "y")
        for name in names:
            model = M.regressor(name, some.filter("split = 'train'"))
            for row in regression_metrics(M.fit_predict(model, some), ["split"]).collect():
                one = got[approach, name, row["split"]]
                assert one["n"] == row["n"] and one["r2"] == pytest.approx(row["r2"], rel=1e-9)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [split") == 3


def test_queries_pass_the_full_sets(spark, monkeypatch):
    import numpy as np

    from dailypanel.fixed import REGRESSION_GRIDS
    from dailypanel.queries import models as Q

    got = {}
    for name in ("scaled_rows", "tidy"):
        monkeypatch.setattr(Q, name, lambda *a, **b: None)
    for name in ("assembled", "with_folds", "class_labels", "linear_regression"):
        monkeypatch.setattr(M, name, lambda *a, **b: None)
    for name in ("grid_search", "learning_curve", "class_experiment_grid"):
        monkeypatch.setattr(M, name, lambda *a, name=name, **b: got.update({name: (a, b)}))
        getattr(Q, name)(None, None)
    assert got["grid_search"][0][2] == REGRESSION_GRIDS["tree"]
    assert np.allclose(got["learning_curve"][0][2], np.linspace(0.01, 1.0, 20))
    assert len(got["class_experiment_grid"][0]) == 6 and not got["class_experiment_grid"][1]


def test_learning_curve_with_a_share_without_rows(spark, data):
    folded = M.with_folds(rows(spark, *data))
    found = {(r["share"], r["side"]): r for r in M.learning_curve(folded, M.linear_regression(), [0.0, 1.0]).collect()}
    assert found[0.0, "train"]["mean_rows"] == 0 and found[0.0, "train"]["rmse_mean"] is None
    assert len(found) == 4 and found[1.0, "test"]["rmse_mean"] > 0


def test_classifiers_are_fitted_in_few_tasks_and_score_as_alone(spark, monkeypatch):
    from pyspark.sql import functions as F

    r = np.random.default_rng(9)
    x = r.normal(size=(300, 2))
    made = [(i, "train" if i % 4 else "test", *map(float, v), float(v[0] > 0) + float(v[1] > 0.5)) for i, v in enumerate(x)]
    df = spark.createDataFrame(made, "entity long, split string, a double, b double, class_label double").repartition(40)
    tasks, fitted = [], M._fitted
    monkeypatch.setattr(M, "_fitted", lambda train, *a: (tasks.append(train.rdd.getNumPartitions()), fitted(train, *a))[1])
    found = M.class_experiment_grid(df, ["a", "b"], "class_label", [0.0, 1.0, 2.0], "a", 1, ["tree", "boosted"]).collect()
    assert tasks == [1, 1, 1] and len(found) == 3 * 2 * 2
    assembled = M.assembled(df, ["a", "b"], "class_label")
    for name in ("tree", "boosted"):
        predictions = M.fit_predict(M.classifiers()[name], assembled)
        right = {k["split"]: k["share"] for k in predictions.groupBy("split").agg(F.avg((F.col("actual") == F.col("predicted")).cast("int")).alias("share")).collect()}
        for one in found:
            if one["approach"] == "all_features" and one["model"] == name:
                assert abs(one["accuracy"] - right[one["split"]]) < 1e-6
