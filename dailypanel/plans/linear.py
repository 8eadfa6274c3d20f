"""Linear models from sufficient statistics: one pass over the rows for a whole grid of penalties or a whole learning curve.

A linear fit and its squared errors need only counts, means and products of the features and the label. These are gathered once for every fold
(and, for a learning curve, every growing share of the rows); the moments of any union of them are merged, and every setting is solved
from a matrix of the size of the features, on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailypanel.functions.expressions import hash_fraction
from dailypanel.operators.moments import block_of, merge, pair_moments

#: Coordinate descent ends when no coefficient moves by more than this share of the largest one.
TOLERANCE, SWEEPS = 1e-10, 20_000
#: Metrics that follow from moments.
METRICS = ("r2", "rmse", "mse")


@dataclass(frozen=True)
class LinearFit:
    """Coefficients that act as a fitted model: ``transform`` adds the column ``prediction``."""

    weights: np.ndarray
    intercept: float

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.weights)

    def transform(self, rows: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(float(w)) for w in self.weights]).cast("array<double>")
        terms = F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w)
        return rows.withColumn("prediction", F.aggregate(terms, F.lit(self.intercept), lambda a, b: a + b))


@dataclass(frozen=True)
class Search:
    """A tuning run: all trials with their scores, the best setting, and its model fitted on all rows."""

    trials: DataFrame
    setting: dict[str, float]
    model: LinearFit


def row_moments(rows: DataFrame, key: Column) -> dict[int, np.ndarray]:
    """Moments of features and label (the last) of assembled rows for each value of ``key``: keys x 6 x width^2 numbers reach the driver."""
    first = rows.select(F.size(vector_to_array("features")).alias("k")).first()
    if first is None:
        return {}
    x = F.array_append(vector_to_array("features"), F.col("label"))
    found = pair_moments(rows, x, x, first["k"] + 1, first["k"] + 1, key).collect()
    return {r["key"]: np.array(r["block"]).reshape(6, first["k"] + 1, first["k"] + 1) for r in found}


def block_of_rows(features: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The moments of rows that are already on the driver."""
    both = np.column_stack([features, label])
    return block_of(both, both)


def together(blocks: list[np.ndarray]) -> np.ndarray | None:
    return reduce(merge, blocks) if blocks else None


def least_squares(block: np.ndarray) -> LinearFit:
    """Ordinary least squares; of several best fits the one of the smallest norm."""
    products = block[5]
    return _fit(block, np.linalg.lstsq(products[:-1, :-1], products[:-1, -1], rcond=1e-12)[0])


def ridge_fit(block: np.ndarray, alpha: float) -> LinearFit:
    """Squared error sum + alpha * squared norm."""
    products = block[5]
    if alpha == 0:
        return least_squares(block)
    return _fit(block, np.linalg.solve(products[:-1, :-1] + alpha * np.eye(len(products) - 1), products[:-1, -1]))


def net_fit(block: np.ndarray, alpha: float, l1_ratio: float = 1.0, start: np.ndarray | None = None) -> LinearFit:
    """Half mean squared error + alpha * (ratio * l1 + (1 - ratio)/2 * l2) by coordinate descent; ratio 1 is the lasso."""
    n = block[0][0, 0]
    gram, target = block[5][:-1, :-1] / n, block[5][:-1, -1] / n
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    w = np.zeros(len(target)) if start is None else start.copy()
    for _ in range(SWEEPS):
        moved = 0.0
        for k in np.flatnonzero(gram.diagonal() + l2):
            pull = target[k] - gram[k] @ w + gram[k, k] * w[k]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (gram[k, k] + l2)
            moved, w[k] = max(moved, abs(new - w[k])), new
        if moved <= TOLERANCE * max(np.abs(w).max(initial=0.0), TOLERANCE):
            break
    return _fit(block, w)


def _fit(block: np.ndarray, weights: np.ndarray) -> LinearFit:
    means = block[1][:, 0]
    return LinearFit(weights, float(means[-1] - weights @ means[:-1]))


def squared_error(block: np.ndarray, fit: LinearFit) -> float:
    """Sum of squared errors of ``fit`` on the rows of ``block``."""
    products, means, w = block[5], block[1][:, 0], fit.weights
    off = means[-1] - means[:-1] @ w - fit.intercept
    return max(0.0, float(products[-1, -1] - 2 * w @ products[:-1, -1] + w @ products[:-1, :-1] @ w + block[0][0, 0] * off * off))


def fit_score(block: np.ndarray, fit: LinearFit, metric: str) -> float | None:
    """``metric`` of ``fit`` on the rows of ``block``; r2 has no value for a constant label."""
    error = squared_error(block, fit)
    if metric == "r2":
        spread = float(block[5][-1, -1])
        return 1 - error / spread if spread > 0 else None
    mean = error / block[0][0, 0]
    return mean if metric == "mse" else float(np.sqrt(mean))


def _settings(name: str, grid: dict[str, list]) -> list[dict[str, float]]:
    named = {"linear": [], "ridge": ["alpha"], "lasso": ["alpha"], "elastic_net": ["alpha", "l1_ratio"]}[name]
    if set(grid) != set(named):
        raise ValueError(f"the grid of {name} has {named}, not {sorted(grid)}")
    return [dict(zip(named, values)) for values in product(*[grid[k] for k in named])]


def _solve(name: str, block: np.ndarray, setting: dict[str, float]) -> LinearFit:
    if name == "linear":
        return least_squares(block)
    if name == "ridge":
        return ridge_fit(block, setting["alpha"])
    return net_fit(block, setting["alpha"], setting.get("l1_ratio", 1.0))


def search_linear(name: str, rows: DataFrame, grid: dict[str, list], metric: str = "r2") -> Search:
    """Cross-validate a grid of a linear model (linear, ridge, lasso, elastic_net) over the column ``fold`` in one pass over the assembled rows.

    A trial's score is the mean over the folds that have rows and others to learn from; of equal scores the first trial is best, and
    a missing score is the worst. Without rows there is nothing to fit, which is an error."""
    if metric not in METRICS:
        raise ValueError(f"moments give {METRICS}, not {metric}")
    settings = _settings(name, grid)
    blocks = row_moments(rows, F.col("fold"))
    if not blocks:
        raise ValueError("there are no rows to fit")
    trials = []
    for k, setting in enumerate(settings):
        scores = []
        for fold, test in sorted(blocks.items()):
            train = together([b for f, b in sorted(blocks.items()) if f != fold])
            if train is not None:
                scores.append(fit_score(test, _solve(name, train, setting), metric))
        known = [s for s in scores if s is not None]
        trials.append((k, *[float(setting[p]) for p in setting], metric, float(np.mean(known)) if known else None))
    sign = -1 if metric == "r2" else 1
    best = min(trials, key=lambda t: (t[-1] is None, 0 if t[-1] is None else sign * t[-1], t[0]))
    columns = "".join(f", {p} double" for p in settings[0])
    table = rows.sparkSession.createDataFrame(trials, f"trial int{columns}, metric string, score double")
    return Search(table, settings[best[0]], _solve(name, together([b for _, b in sorted(blocks.items())]), settings[best[0]]))


def linear_learning_curve(rows: DataFrame, shares: list[float], folds: int = 3) -> DataFrame:
    """Train and test RMSE of least squares, mean and population deviation over folds, by share of the training rows.

    Growing shares are nested: a row is in when the hash of its entity and day is below the share. All come from one pass that gathers the rows
    between two shares, fold by fold. A fold without training rows at a share counts with 0 rows and no RMSE."""
    at = hash_fraction(F.concat_ws("_", F.col("entity").cast("string"), F.col("date").cast("string")))
    steps = sorted(set(float(s) for s in shares))
    stratum = reduce(Column.__add__, [(at >= F.lit(s)).cast("int") for s in steps])
    blocks = row_moments(rows, stratum * folds + F.col("fold"))
    out = []
    for share in shares:
        upto = steps.index(float(share))
        sides = {"train": [], "test": []}
        for fold in range(folds):
            train = together([b for k, b in sorted(blocks.items()) if k // folds <= upto and k % folds != fold])
            test = together([b for k, b in sorted(blocks.items()) if k % folds == fold])
            fit = None if train is None else least_squares(train)
            for side, block in (("train", train), ("test", test)):
                known = fit is not None and block is not None
                sides[side].append((block[0][0, 0], fit_score(block, fit, "rmse")) if known else (0.0, None))
        for side, scored in sides.items():
            known = [e for _, e in scored if e is not None]
            out.append((float(share), side, float(np.mean([n for n, _ in scored])), float(np.mean(known)) if known else None, float(np.std(known)) if known else None))
    return _curve(rows.sparkSession, out)


def _curve(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "share double, side string, mean_rows double, rmse_mean double, rmse_std double")
