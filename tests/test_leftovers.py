"""Missing groups, missing predictions, unlisted classes, missing scores, long histories."""

import datetime as dt
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest

from dailypanel.catalog import Catalog
from dailypanel.operators import evaluate as V
from dailypanel.operators.features import add_ewma
from dailypanel.operators.lookup import attach
from dailypanel.operators import impute as I
from dailypanel.operators import scale as C
from dailypanel.operators import split as L
from dailypanel.operators.panel import trim_override, trim_windows
from dailypanel.operators.profile import describe, histogram, log_transform
from dailypanel.operators.quantiles import exact_quantiles
from dailypanel.sources import readings as S


@pytest.mark.parametrize("span", [1, 2, 7, 200])
def test_ewma_keeps_old_rows_and_gaps(spark, span):
    rng = np.random.default_rng(span)
    values = rng.normal(size=700)
    values[127] = 1e20
    gaps = np.where(rng.random(700) < 0.2, np.nan, rng.normal(size=700))
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(700)]
    rows = [(1, d, float(v), None if np.isnan(g) else float(g)) for d, v, g in zip(days, values, gaps)]
    got = add_ewma(spark.createDataFrame(rows, "entity long, date date, v double, g double"), ["v", "g"], span).orderBy("date").toPandas()
    for name, data in (("v", values), ("g", gaps)):
        want = pd.Series(data).ewm(span=span, adjust=True).mean().to_numpy()
        assert np.allclose(got[f"ewma{span}_{name}"].to_numpy(float), want, rtol=1e-9, atol=1e-12, equal_nan=True)


def test_ewma_carries_over_empty_blocks(spark):
    """At a span of 2 a block holds 210 rows: values at both sides of an edge, then blocks without any, then values again."""
    values = np.full(3000, np.nan)
    for a, b in ((205, 211), (1200, 1201), (2310, 2320), (2999, 3000)):
        values[a:b] = np.arange(a, b) % 7 + 0.5
    days = [dt.date(2010, 1, 1) + dt.timedelta(days=i) for i in range(3000)]
    rows = [(e, d, None if np.isnan(v) else float(v)) for e in (1, 2) for d, v in zip(days, values)]
    got = add_ewma(spark.createDataFrame(rows, "entity long, date date, v double"), ["v"], 2)
    want = pd.Series(values).ewm(span=2, adjust=True).mean().to_numpy()
    for e in (1, 2):
        one = got.filter(f"entity = {e}").orderBy("date").toPandas()["ewma2_v"].to_numpy(float)
        assert np.allclose(one, want, rtol=1e-9, equal_nan=True)
    assert "collect_list" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_missing_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    counts = histogram(df, ["v"], 2, ["g"]).collect()
    assert sum(r["n"] for r in counts if r["g"] is None) == 2
    halves = {r["g"]: r["value"] for r in exact_quantiles(df, ["v"], [0.5], ["g"]).collect()}
    assert halves == {None: 2.0, "a": 5.0}


@pytest.mark.parametrize("limit", [3, 1000])
def test_quantiles_narrow_until_small(spark, limit):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), [1e300, -1e300]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r["probability"]: r["value"] for r in exact_quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.9, 1.0], limit=limit).collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantiles_of_clusters_need_one_round(spark, monkeypatch):
    """Values packed within 1e-9 of a few points, from 1e-300 to 1e300: equal steps would have to narrow them many times."""
    from dailypanel.operators import quantiles as Q

    rng = np.random.default_rng(8)
    values = np.concatenate([c * (1 + 1e-9 * rng.random(4000)) for c in (-1e300, -3.0, 1e-300, 5.0, 1e300)])
    pdf = pd.DataFrame({"g": np.where(np.arange(len(values)) % 3 == 0, None, "a"), "v": values})
    rounds, plain = [], Q._splits
    monkeypatch.setattr(Q, "_splits", lambda rows, cells: rounds.append(1) or plain(rows, cells))
    shares = [0.0, 0.1, 0.33, 0.5, 0.77, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf, "g string, v double").repartition(5), ["v"], shares, ["g"], limit=50).collect()
    assert len(got) == 12 and len(rounds) == 1
    for row in got:
        one = pdf[pdf.g.isna() if row["g"] is None else pdf.g == row["g"]].v
        assert row["value"] == pytest.approx(np.quantile(one, row["probability"]), rel=1e-12)


def test_missing_predictions_are_left_out_of_every_metric(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 2.5), ("a", 50.0, None)], "k string, actual double, predicted double")
    row = V.regression_metrics(df, ["k"]).first()
    assert row["n"] == 2 and row["r2"] == pytest.approx(1 - 0.125 / 0.25)
    assert V.missing_pairs(df, ["k"]).first()["n_missing"] == 1


def test_unlisted_and_missing_classes_count(spark):
    df = spark.createDataFrame([(1, 1), (1, 9), (None, 0)], "actual int, predicted int")
    cells = V.confusion_matrix(df, [0, 1])
    assert sum(r["n"] for r in cells.collect()) == 3
    row = V.classification_metrics(cells).first()
    assert row["n"] == 3 and row["accuracy"] == pytest.approx(1 / 3)
    assert "other" in {r["class"] for r in V.classification_report(cells).collect()}


def test_missing_score_is_never_best(spark):
    df = spark.createDataFrame([("a", "x", None), ("a", "y", 0.9)], "g string, name string, r2 double")
    assert V.best_row(df, ["g"], "r2", "name").first()["name"] == "y"


def test_values_without_log_stay(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (0.0,), (90.0,)], "v double")
    assert {r["v"] for r in log_transform(df, ["v"]).collect()} == {-2.0, 0.0, 90.0}


def test_unreadable_rows_go_to_the_audit(spark):
    raw = spark.sql("SELECT 1L AS seq, 'bad' AS id, timestamp_ntz'2024-01-01' AS time, 'm' AS variable, 1D AS value UNION ALL "
                    "SELECT 2L, 'x.7', timestamp_ntz'2024-01-01', 'm', 1D UNION ALL SELECT 3L, 'x.8', NULL, 'm', 1D")
    assert [r["entity"] for r in S.readings_from_text_id(raw).collect()] == [7]
    assert S.unreadable_audit(raw).count() == 2


def test_stored_readings_follow_the_csv(spark, tmp_path):
    import os

    csv, stored = tmp_path / "r.csv", str(tmp_path / "r.parquet")
    csv.write_text("seq,id,time,variable,value\n1,a.1,2024-01-01 10:00:00,m,1\n")
    assert S.stored_readings(spark, str(csv), stored).count() == 1
    csv.write_text("seq,id,time,variable,value\n1,a.1,2024-01-01 10:00:00,m,1\n2,a.1,2024-01-02 10:00:00,m,1\n")
    os.utime(csv, (4e9, 4e9))
    assert S.stored_readings(spark, str(csv), stored).count() == 2


def test_attach_is_lazy_and_matches_missing_keys(spark):
    data = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    table = spark.createDataFrame([(None, "n"), ("a", "x")], "k string, w string")
    assert {(r["v"], r["w"]) for r in attach(data, table, ["k"]).collect()} == {(1, "n"), (2, "x")}


def test_trim_windows_from_a_table(spark):
    day = lambda k: dt.date(2024, 1, k)
    panel = spark.createDataFrame([(e, day(k)) for e in (1, 2) for k in range(1, 6)], "entity long, date date")
    windows = spark.createDataFrame([(1, day(2), day(3)), (1, day(3), day(4))], "entity long, start date, end date")
    got = {(r["entity"], r["date"].day) for r in trim_windows(panel, windows).collect()}
    assert got == {(1, k) for k in (2, 3, 4)} | {(2, k) for k in range(1, 6)}


def test_grid_best_trial_and_concat(spark):
    grid = V.parameter_grid(spark, {"span": [3, 7], "width": [0.5, 1.0]})
    assert [tuple(r) for r in grid.orderBy("trial").collect()] == [(0, 3, 0.5), (1, 3, 1.0), (2, 7, 0.5), (3, 7, 1.0)]
    scored = spark.createDataFrame([(0, None), (1, 0.2), (2, 0.2)], "trial long, r2 double")
    assert V.best_trial(scored, "r2").first()["trial"] == V.best_trial(scored, "r2", largest=False).first()["trial"] == 1
    both = V.concat([scored, spark.createDataFrame([(9, "x")], "trial long, note string")])
    assert both.columns == ["trial", "r2", "note"] and both.filter("r2 IS NULL").count() == 2


def test_both_trims_keep_what_any_window_holds(spark):
    day = lambda k: dt.date(2024, 1, k)
    panel = spark.createDataFrame([(e, day(k)) for e in (1, 2, None) for k in range(1, 8)], "entity long, date date")
    rows = [(1, day(1), day(2)), (1, day(6), day(7)), (1, day(6), day(7))]
    want = {(1, k) for k in (1, 2, 6, 7)} | {(e, k) for e in (2, None) for k in range(1, 8)}
    by_table = trim_windows(panel, spark.createDataFrame(rows, "entity long, start date, end date"))
    by_list = trim_override(panel, [(e, str(a), str(b)) for e, a, b in rows])
    for got in (by_table, by_list):
        assert {(r["entity"], r["date"].day) for r in got.collect()} == want and got.count() == 18
    missing = spark.createDataFrame([(None, day(3), day(3))], "entity long, start date, end date")
    assert trim_windows(panel, missing).filter("entity IS NULL").count() == 1


def test_best_of_a_missing_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0), ("b", None)], "g string, r2 double")
    assert {(r["g"], r["r2"]) for r in V.best_per_group(df, ["g"], "r2").collect()} == {(None, 2.0), ("a", 3.0)}
    assert V.best_per_group(df, [], "r2").count() == 1


def test_parameters_of_a_missing_entity(spark):
    df = spark.createDataFrame([(1, "train", 1.0), (1, "train", 3.0), (None, "train", 10.0), (None, "train", 30.0), (2, "test", 5.0)], "entity long, split string, x double")
    scaled = C.apply(df, C.fit(df, ["x"]), ["x"])
    assert sorted((r["entity"] or 0, r["x"]) for r in scaled.collect()) == [(0, -1.0), (0, 1.0), (1, -1.0), (1, 1.0), (2, 5.0)]
    assert sorted(r["x"] for r in C.invert(scaled, C.fit(df, ["x"]), ["x"]).collect()) == [1.0, 3.0, 5.0, 10.0, 30.0]


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_shares_are_exact_whatever_the_hashes(spark, n):
    df = spark.range(n).selectExpr("id AS entity", "DATE '2024-01-01' AS date").unionByName(spark.range(n).selectExpr("id AS entity", "DATE '2024-01-02' AS date"))
    counts = {r["split"]: r["count"] for r in L.exact_split(df, L.entity_key(), 0.15, 0.2).groupBy("split").count().collect()}
    test, both = int(n * 0.15 + 1e-9), int(n * 0.35 + 1e-9)
    assert (counts.get("test", 0), counts.get("val", 0), counts.get("train", 0)) == (2 * test, 2 * (both - test), 2 * (n - both))
    assert L.share_edges(df, L.day_key(), [0.0, 1.0])[1] == 1.0
    assert L.exact_split(df.limit(0), L.entity_key()).count() == 0


def test_fills_chosen_by_column(spark):
    days = [(1, dt.date(2024, 1, k), v, v, v, v) for k, v in enumerate([1.0, None, 4.0, 4.0, 9.0], 1)]
    df = spark.createDataFrame(days, "entity long, date date, mood_mean_daily double, mood_min_daily double, mood_max_daily double, mood_std_daily double")
    plain = Catalog(averaged=("mood",), summed=())
    fills = {"mood_mean_daily": "mean", "mood_min_daily": "median", "mood_max_daily": "linear", "mood_std_daily": "zero"}
    catalog = replace(plain, fills=tuple(fills.items()))
    for column_name, fill in fills.items():
        assert column_name in catalog.names("daily", fill)
    for build, want in ((I.fill_mean, 4.5), (I.fill_entity_median, 4.0)):
        assert build(df, ["mood_mean_daily"]).orderBy("date").collect()[1]["mood_mean_daily"] == want
    for wrong in (("mood_mean_daily", "mood"), ("nothing", "mean")):
        with pytest.raises(ValueError):
            replace(plain, fills=(wrong,))


def test_describe_keeps_a_missing_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)], "g string, x double")
    got = {r["g"]: (r["n"], r["mean"], r["q50"], r["max"]) for r in describe(df, "x", ["g"]).collect()}
    assert got == {None: (2, 2.0, 2.0, 3.0), "a": (1, 5.0, 5.0, 5.0)}
