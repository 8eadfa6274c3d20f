"""Softmax boosting against a plain version on rows in memory."""

import numpy as np
import pytest

from dailypanel.plans import boosting as B
from dailypanel.plans import models as M


def plain(x, y, rounds, depth, step):
    """Scores of boosted trees with every value as a possible cut."""
    classes = int(y.max()) + 1
    score = np.tile(np.log(np.bincount(y) / len(y)), (len(y), 1))

    def leaves(rows, g, left):
        best = (1e-9, None)
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                a, b = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                gain = round(g[a].sum() ** 2 / len(a) + g[b].sum() ** 2 / len(b) - g[rows].sum() ** 2 / len(rows), 9)
                if gain > best[0]:
                    best = (gain, (a, b))
        if not left or best[1] is None:
            return [rows]
        return leaves(best[1][0], g, left - 1) + leaves(best[1][1], g, left - 1)

    for _ in range(rounds):
        p = B.chances(score)
        new = score.copy()
        for k in range(classes):
            g, h = (y == k) - p[:, k], p[:, k] * (1 - p[:, k])
            for rows in leaves(np.arange(len(y)), g, depth):
                new[rows, k] += step * (classes - 1) / classes * g[rows].sum() / h[rows].sum()
        score = new
    return B.chances(score)


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(4)
    x = r.integers(0, 12, (240, 3)).astype(float)
    y = (x[:, 0] > 5).astype(int) + ((x[:, 1] > 3) & (x[:, 0] > 2)).astype(int)
    flip = r.random(240) < 0.1
    return x, np.where(flip, r.integers(0, 3, 240), y)


def table(spark, x, y):
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    return M.assembled(spark.createDataFrame(rows, "entity long, a double, b double, c double, y int").repartition(3), ["a", "b", "c"], "y")


@pytest.mark.parametrize("rounds,depth,step", [(1, 1, 1.0), (3, 2, 0.5)])
def test_chances_are_those_of_a_plain_version(spark, data, rounds, depth, step):
    x, y = data
    model = B.SoftmaxBoosting(rounds, depth, step).fit(table(spark, x, y))
    got = {r["entity"]: r["probability"] for r in model.transform(table(spark, x, y)).collect()}
    np.testing.assert_allclose([got[i] for i in range(len(y))], plain(x, y, rounds, depth, step), atol=1e-8)


def test_written_scores_change_nothing(spark, data, monkeypatch):
    x, y = data
    rows = table(spark, x, y)
    whole = B.SoftmaxBoosting(4, 2, 0.3).fit(rows)
    monkeypatch.setattr(B, "KEEP", 2)
    parts = B.SoftmaxBoosting(4, 2, 0.3).fit(rows)
    bins = B.binned(x, whole.edges)
    np.testing.assert_allclose(whole.scores(bins), parts.scores(bins), atol=1e-9)


def test_one_class_a_missing_class_and_no_rows(spark, data):
    x, _ = data
    one = B.SoftmaxBoosting(2, 2).fit(table(spark, x, np.zeros(240, int)))
    assert one.transform(table(spark, x, np.zeros(240, int))).filter("prediction <> 0").count() == 0
    gap = B.SoftmaxBoosting(3, 2).fit(table(spark, x, np.where(x[:, 0] > 5, 2, 0)))
    assert gap.transform(table(spark, x, np.where(x[:, 0] > 5, 2, 0))).filter("prediction = label").count() == 240
    with pytest.raises(ValueError):
        B.SoftmaxBoosting().fit(table(spark, x, np.zeros(240, int)).limit(0))


def test_tasks_of_a_pass_follow_the_cores(spark, monkeypatch):
    """The sums of a pass are handed on once by every task, so their number must not grow with the rows."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from dailypanel.plans import boosting as G

    seen, settle = [], G.settle
    monkeypatch.setattr(G, "TASK_ROWS", 1)
    monkeypatch.setattr(G, "settle", lambda df: (seen.append(df.rdd.getNumPartitions()), settle(df))[1])
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 400, 1, 2 * cores + 9).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("features"), (F.col("id") % 2).alias("label"))
    G.SoftmaxBoosting(rounds=1, depth=1).fit(rows)
    assert seen == [2 * cores]


def test_one_task_grows_the_same_trees_as_passes_in_one_job(spark, data, monkeypatch):
    x, y = data
    rows, context = table(spark, x, y), spark.sparkContext

    def fit(group):
        context.setJobGroup(group, group)
        model = B.SoftmaxBoosting(6, 2, 0.3).fit(rows)
        context.setLocalProperty("spark.jobGroup.id", None)
        return model, len(context.statusTracker().getJobIdsForGroup(group))

    one, few = fit("one task")
    monkeypatch.setattr(B, "ONE_TASK", 0, raising=False)
    monkeypatch.setattr(B, "KEEP", 4)
    passes, many = fit("passes")
    for a, b in zip(one.rounds, passes.rounds, strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all()
        np.testing.assert_allclose(a.value, b.value, atol=1e-12)
    assert few < 12 < many
