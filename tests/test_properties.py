"""Randomised properties, comparisons with pandas and skewed inputs."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dailypanel.operators import encode as N
from dailypanel.operators import features as X
from dailypanel.operators import impute as I
from dailypanel.operators import lookup
from dailypanel.operators import panel as P
from dailypanel.operators import scale as C
from dailypanel.operators import split as L
from dailypanel.operators.quantiles import exact_quantiles
from dailypanel.plans import ready as R
from dailypanel.queries import bindings as B


def frame(n_entities=3, n_days=700, gaps=0.0, seed=1):
    rng = np.random.default_rng(seed)
    start = dt.date(2020, 1, 1)
    rows = []
    for e in range(n_entities):
        values = rng.normal(50 if e else 1e6, 20, n_days)
        values[rng.random(n_days) < gaps] = np.nan
        rows += [(e, start + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return pd.DataFrame(rows, columns=["entity", "date", "x"])


def to_spark(spark, pdf):
    df = spark.createDataFrame(pdf.astype({"entity": "int64"}), "entity bigint, date date, x double")
    return df.withColumn("x", F.expr("nullif(x, double('NaN'))")).repartition(5)


@pytest.mark.parametrize("span", [2, 7, 60])
def test_ewma_equals_pandas(spark, span):
    pdf = frame()
    want = pdf.groupby("entity")["x"].transform(lambda s: s.ewm(span=span, min_periods=1).mean())
    got = X.add_ewma(to_spark(spark, pdf), ["x"], span).orderBy("entity", "date").toPandas()[f"ewma{span}_x"]
    np.testing.assert_allclose(got, want, rtol=1e-12)


def test_interpolation_equals_pandas(spark):
    pdf = frame(gaps=0.6)
    want = pdf.groupby("entity")["x"].transform(lambda s: s.interpolate(limit_direction="both"))
    got = I.fill_linear(to_spark(spark, pdf), ["x"]).orderBy("entity", "date").toPandas()["x"]
    np.testing.assert_allclose(got, want, rtol=1e-12)
    known = pdf["x"].notna()
    assert (got[known].to_numpy() == pdf["x"][known].to_numpy()).all()


def test_mode_equals_pandas(spark):
    pdf = frame(gaps=0.5)
    pdf["x"] = pdf["x"].round(-1)
    want = pdf.groupby("entity")["x"].transform(lambda s: s.fillna(s.mode()[0]))
    got = I.fill_mode(to_spark(spark, pdf), ["x"]).orderBy("entity", "date").toPandas()["x"]
    assert (got == want).all()


@pytest.mark.parametrize("kind", ["standard", "minmax"])
def test_scaled_train_and_inverse(spark, kind):
    parts = L.chrono_split(to_spark(spark, frame(n_days=40))).withColumn("original", F.col("x"))
    params = C.fit(parts, ["x"], kind)
    scaled = C.apply(parts, params, ["x"])
    train = scaled.filter("split = 'train'").groupBy("entity").agg(
        F.avg("x").alias("m"), F.stddev_pop("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi")
    ).toPandas()
    if kind == "standard":
        np.testing.assert_allclose(train["m"], 0, atol=1e-9)
        np.testing.assert_allclose(train["s"], 1, rtol=1e-9)
    else:
        assert (train["lo"] == 0).all() and (train["hi"] == 1).all()
    back = C.invert(scaled, params, ["x"]).toPandas()
    np.testing.assert_allclose(back["x"], back["original"], rtol=1e-12)
    by_window = C.scale_by_entity(parts, ["x"], kind).orderBy("entity", "date").toPandas()["x"]
    np.testing.assert_allclose(by_window, scaled.orderBy("entity", "date").toPandas()["x"], rtol=1e-12)


def test_hash_split_keeps_days_whole_and_is_a_partition(spark):
    rows = to_spark(spark, frame()).withColumn("tod", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    parts = L.group_hash_split(rows)
    assert parts.count() == rows.count()
    assert parts.groupBy("entity", "date").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    shares = {r["split"]: r["count"] / 6300 for r in parts.groupBy("split").count().collect()}
    assert shares["test"] == pytest.approx(0.2, abs=0.04) and shares["val"] == pytest.approx(0.1, abs=0.04)


def test_panel_does_not_depend_on_input_partitions(spark, small):
    clean = B.clean(spark, small)
    a = R.ready_panel(clean, B.CATALOG).orderBy("entity", "date").toPandas()
    b = R.ready_panel(clean.repartition(7, "seq"), B.CATALOG).orderBy("entity", "date").toPandas()
    pd.testing.assert_frame_equal(a, b, rtol=1e-9)


def test_sliding_std_far_from_zero(spark):
    """Daily moments must not cancel when the level is large."""
    rng = np.random.default_rng(3)
    rows = []
    for d in range(20):
        for k in range(rng.integers(0, 5)):
            rows.append((1, f"2024-01-{d + 1:02d} {k + 8:02d}:00:00", "mood", 1e9 + rng.random()))
    pdf = pd.DataFrame(rows, columns=["entity", "t", "variable", "value"])
    from test_micro import CAT, readings

    panel = P.daily_panel(readings(spark, rows), CAT).orderBy("date").toPandas()
    pdf["date"] = pd.to_datetime(pdf["t"]).dt.date
    for _, row in panel.iterrows():
        window = pdf[(pdf["date"] <= row["date"]) & (pdf["date"] >= row["date"] - dt.timedelta(days=2))]["value"]
        if len(window) > 1:
            assert row["mood_std_slide_daily"] == pytest.approx(window.std(), rel=1e-5)
        else:
            assert pd.isna(row["mood_std_slide_daily"])


def test_quantiles_with_ties_outliers_and_hot_groups(spark):
    rng = np.random.default_rng(5)
    a = np.concatenate([rng.normal(0, 1, 4000), np.full(3000, 0.25), [1e18, -1e18, 1e300]])
    b = rng.integers(0, 4, 11).astype(float)
    pdf = pd.DataFrame({"g": ["a"] * len(a) + ["b"] * len(b) + ["c"], "x": np.concatenate([a, b, [7.0]])})
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf).repartition(6), ["x"], probabilities, ["g"]).toPandas()
    assert len(got) == 3 * len(probabilities)
    for g, part in got.groupby("g"):
        want = np.quantile(pdf[pdf["g"] == g]["x"], part["probability"])
        np.testing.assert_allclose(part["value"], want, rtol=1e-12)


def test_attach_gives_the_same_without_broadcast(spark):
    data = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50))
    table = data.select("k").distinct().filter("k < 40").withColumn("v", F.col("k") * 2)
    for how in ("inner", "left"):
        small = lookup.attach(data, table, ["k"], how).toPandas().sort_values("id").reset_index(drop=True)
        limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        try:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            large = lookup.attach(data, table, ["k"], how).toPandas().sort_values("id").reset_index(drop=True)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        pd.testing.assert_frame_equal(small, large[small.columns])


def test_codes_follow_sorted_order_over_partitions(spark):
    labels = spark.range(5000).select(F.concat(F.lit("label "), (F.col("id") * 7919 % 1237).cast("string")).alias("t"))
    codes = N.sorted_codes(labels, "t", "code").toPandas().sort_values("t")
    assert list(codes["code"]) == list(range(1237))


def test_frequency_counts_missing_rows_in_the_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    got = {r["t"]: r["t_freq"] for r in N.frequency_encoding(df, "t", drop_original=False).collect()}
    assert got == {"a": 0.5, "b": 0.25, None: None}
