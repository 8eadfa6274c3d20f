"""Linear models on moments against fits on the rows themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dailypanel.plans import linear as N
from dailypanel.plans import models as M


@pytest.fixture(scope="module")
def folded(spark):
    r = np.random.default_rng(5)
    x = r.normal(0, [1, 3, 1, 1], (400, 4)) + [0, 50, 0, 0]
    x[:, 3] = x[:, 0] + x[:, 2]  # not of full rank
    y = 2 * x[:, 0] - 0.5 * x[:, 1] + r.normal(0, 1, 400)
    rows = [(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "entity bigint, a double, b double, c double, d double, y double").repartition(5)
    df = df.selectExpr("*", "date_add(DATE '2024-01-01', CAST(entity % 30 AS INT)) AS date")
    return M.with_folds(M.assembled(df, ["a", "b", "c", "d"], "y")).cache()


@pytest.fixture(scope="module")
def table(folded):
    rows = folded.select("fold", "entity", "date", "features", "label").collect()
    return np.array([r["fold"] for r in rows]), np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows])


def objective(x, y, w, b, alpha, ratio):
    return ((y - x @ w - b) ** 2).mean() / 2 + alpha * (ratio * np.abs(w).sum() + (1 - ratio) / 2 * (w * w).sum())


def test_every_fit_is_that_of_the_rows(folded, table):
    _, x, y = table
    block = N.together([b for _, b in sorted(N.row_moments(folded, F.col("fold")).items())])
    xc, yc = x - x.mean(0), y - y.mean()
    np.testing.assert_allclose(N.least_squares(block).weights, np.linalg.lstsq(xc, yc, rcond=1e-8)[0], atol=1e-8)
    np.testing.assert_allclose(N.ridge_fit(block, 3.0).weights, np.linalg.solve(xc.T @ xc + 3 * np.eye(4), xc.T @ yc), atol=1e-8)
    r = np.random.default_rng(1)
    for alpha, ratio in ((0.1, 1.0), (0.4, 0.3), (100.0, 1.0)):
        fit = N.net_fit(block, alpha, ratio)
        best = objective(x, y, fit.weights, fit.intercept, alpha, ratio)
        for _ in range(50):
            w = fit.weights + r.normal(0, 0.01, 4)
            assert objective(x, y, w, y.mean() - x.mean(0) @ w, alpha, ratio) >= best - 1e-9
    assert not N.net_fit(block, 100.0).weights.any()
    fit = N.ridge_fit(block, 3.0)
    error = ((y - x @ fit.weights - fit.intercept) ** 2).sum()
    assert N.squared_error(block, fit) == pytest.approx(error)
    assert N.fit_score(block, fit, "r2") == pytest.approx(1 - error / (yc ** 2).sum()) and N.fit_score(block, fit, "rmse") == pytest.approx((error / 400) ** 0.5)


@pytest.mark.parametrize("name,grid", [("linear", {}), ("ridge", {"alpha": [0.1, 10.0, 1000.0]}), ("elastic_net", {"alpha": [0.01, 1.0], "l1_ratio": [0.2, 1.0]})])
def test_search_is_cross_validation(folded, table, name, grid):
    found = N.search_linear(name, folded, grid, "rmse")
    fold, x, y = table
    trials = sorted(found.trials.collect(), key=lambda t: t["trial"])
    for t in trials:
        scores = []
        for k in range(3):
            inside = fold != k
            block = N.block_of_rows(x[inside], y[inside])
            fit = N._solve(name, block, t.asDict())
            scores.append((((y - x @ fit.weights - fit.intercept) ** 2)[~inside].mean()) ** 0.5)
        assert t["score"] == pytest.approx(np.mean(scores), rel=1e-6)
    best = min(trials, key=lambda t: (t["score"], t["trial"]))
    assert found.setting == {k: best[k] for k in grid}
    predicted = found.model.transform(folded).toPandas()
    want = np.array([f.toArray() for f in predicted["features"]]) @ found.model.weights + found.model.intercept
    np.testing.assert_allclose(predicted["prediction"], want)


def test_learning_curve_is_that_of_a_fit_for_each_point(folded):
    shares = [0.05, 0.4, 1.0]
    got = {(r["share"], r["side"]): r for r in M.learning_curve(folded, M.linear_regression(), shares).collect()}
    other = M.linear_regression().setRegParam(1e-12)  # not a plain one, so every point is fitted
    want = {(r["share"], r["side"]): r for r in M.learning_curve(folded.filter("fold >= 0"), other, shares).collect()}
    assert set(got) == set(want) and len(got) == 6
    for k, r in got.items():
        assert r["mean_rows"] == want[k]["mean_rows"]
        assert r["rmse_mean"] == pytest.approx(want[k]["rmse_mean"], rel=1e-4) and r["rmse_std"] == pytest.approx(want[k]["rmse_std"], rel=1e-2, abs=1e-4)


def test_no_rows_and_wrong_grids(folded):
    assert N.row_moments(folded.limit(0), F.col("fold")) == {}
    for grid, metric in (({}, "r2"), ({"alpha": [1.0]}, "mae")):
        with pytest.raises(ValueError):
            N.search_linear("ridge", folded, grid, metric)
    with pytest.raises(ValueError):
        N.search_linear("ridge", folded.limit(0), {"alpha": [1.0]})
    curve = M.learning_curve(folded.limit(0), M.linear_regression(), [0.5]).collect()
    assert [(r["mean_rows"], r["rmse_mean"]) for r in curve] == [(0.0, None)] * 2
