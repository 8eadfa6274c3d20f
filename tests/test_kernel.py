"""The Fourier map against the kernel itself, and rings that no plane separates."""

import numpy as np
import pytest
from pyspark.ml import classification as C

from dailypanel.plans import kernel as K
from dailypanel.plans import models as M


def test_products_are_the_kernel_within_the_stated_error():
    r = np.random.default_rng(1)
    x, gamma = r.normal(0, 1, (200, 5)), 0.3
    want = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    for dims in (256, 4096):
        maps = [K.FourierMap.draw(5, gamma, dims, seed).of(x) for seed in range(10)]
        assert np.sqrt(np.mean([((z @ z.T - want) ** 2).mean() for z in maps])) <= 1 / np.sqrt(dims)


def rings(spark):
    r = np.random.default_rng(2)
    kind, angle = r.integers(0, 3, 450), r.uniform(0, 2 * np.pi, 450)
    radius = 1.0 + 1.5 * kind + r.normal(0, 0.1, 450)
    rows = [(i, float(d * np.cos(a)), float(d * np.sin(a)), int(k)) for i, (d, a, k) in enumerate(zip(radius, angle, kind))]
    return M.assembled(spark.createDataFrame(rows, "entity long, a double, b double, y int").coalesce(1), ["a", "b"], "y").cache()


def test_rings(spark):
    rows = rings(spark)
    model = K.KernelSVC(rounds=20).fit(rows)
    scored = model.transform(rows)
    assert scored.filter("prediction = label").count() >= 440
    assert scored.first()["features"].size == 2
    flat = C.OneVsRest(classifier=C.LinearSVC(maxIter=20, regParam=0.001)).fit(rows).transform(rows)
    assert flat.filter("prediction = label").count() < 300
    with pytest.raises(ValueError):
        K.KernelSVC().fit(rows.limit(0))
    gamma = K.usual_gamma(rows)
    x = np.array([r["features"].toArray() for r in rows.collect()])
    assert gamma == pytest.approx(1 / (2 * x.var()))
