"""Hand-computed fixtures, one per operator."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from dailypanel.catalog import Catalog
from dailypanel.functions import expressions as E
from dailypanel.operators import correlate as K
from dailypanel.operators import evaluate as V
from dailypanel.operators import features as X
from dailypanel.operators import impute as I
from dailypanel.operators import panel as P
from dailypanel.operators import profile as A
from dailypanel.operators import scale as C
from dailypanel.operators import sequences as Q
from dailypanel.operators import split as L
from dailypanel.plans import ready as R
from dailypanel.sources.readings import drop_negative, with_time_columns

CAT = Catalog(
    averaged=("mood", "valence", "arousal"),
    summed=("screen", "activity"),
    peaked=("activity",),
    signed=("valence", "arousal"),
    static=("activity",),
)


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def series(spark, values, column="x", entity=1):
    rows = [(entity, day(i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"entity bigint, date date, {column} double")


def column(df, name="x", order="date"):
    return [r[name] for r in df.orderBy(order).collect()]


def readings(spark, rows):
    """Rows (entity, time text, variable, value)."""
    raw = [(e, t, i, v, None if x is None else float(x)) for i, (e, t, v, x) in enumerate(rows)]
    df = spark.createDataFrame(raw, "entity bigint, t string, seq bigint, variable string, value double")
    return with_time_columns(df.withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t"))


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("hour,band", [(9, 0), (10, 1), (16, 1), (17, 2)])
def test_tod_band(spark, hour, band):
    assert one(spark, E.tod_band(F.lit(hour))) == band


@pytest.mark.parametrize("text,expected", [("2024-01-02 04:59:00", day(0)), ("2024-01-02 05:00:00", day(1))])
def test_shifted_day(spark, text, expected):
    assert one(spark, E.shifted_day(F.lit(text).cast("timestamp_ntz"))) == expected


@pytest.mark.parametrize("hours,bed", [([18, 2], 2.0), ([17, 6], None), ([23], 23.0)])
def test_bed_hour(spark, hours, bed):
    # Early hours lie on the next calendar day; a last reading keeps that day in the calendar.
    rows = [(1, f"2024-01-0{2 if h < 5 else 1} {h:02d}:30:00", "mood", 1) for h in hours]
    panel = P.daily_panel(readings(spark, rows), CAT).orderBy("date").first()
    assert panel["bed_time_daily"] == bed


def test_wake_hour(spark):
    rows = [(1, f"2024-01-01 {h:02d}:00:00", "mood", 1) for h in (4, 5, 12, 13)]
    assert P.daily_panel(readings(spark, rows), CAT).first()["wake_time_daily"] == 5.0


def test_static_variables_tell_nothing_about_rest(spark):
    rows = [(1, "2024-01-01 06:00:00", "activity", 1), (1, "2024-01-01 08:00:00", "mood", 1)]
    assert P.daily_panel(readings(spark, rows), CAT).first()["wake_time_daily"] == 8.0


def test_drop_negative_keeps_missing(spark):
    rows = [(1, "2024-01-01 06:00:00", v, x) for v, x in (("mood", 1), ("mood", None), ("mood", -1), ("valence", -1))]
    kept = drop_negative(readings(spark, rows), CAT.signed).collect()
    assert sorted((r["variable"], r["value"]) for r in kept if r["value"] is not None) == [("mood", 1.0), ("valence", -1.0)]
    assert len(kept) == 3


def test_daily_statistics(spark):
    rows = [
        (1, "2024-01-01 12:00:00", "mood", 3),
        (1, "2024-01-01 11:00:00", "mood", 1),
        (1, "2024-01-01 11:00:00", "valence", 4),
        (1, "2024-01-01 12:00:00", "screen", None),
        (1, "2024-01-03 12:00:00", "mood", 7),
    ]
    first, gap, last = P.daily_panel(readings(spark, rows), CAT).orderBy("date").collect()
    assert math.isclose(first["mood_std_daily"], math.sqrt(2))
    assert first["valence_std_daily"] is None
    assert (first["mood_first_daily"], first["mood_last_daily"]) == (1.0, 3.0)
    assert first["screen_sum_daily"] == 0.0 and gap["screen_sum_daily"] is None
    assert gap["mood_mean_daily"] is None
    assert math.isclose(gap["mood_std_slide_daily"], math.sqrt(2))
    assert math.isclose(last["mood_std_slide_daily"], math.sqrt(28 / 3))


def test_first_reading_of_a_tie_is_the_lower_row(spark):
    rows = [(1, "2024-01-01 12:00:00.000001", "mood", x) for x in (5, 2, 9)]
    row = P.daily_panel(readings(spark, rows), CAT).first()
    assert (row["mood_first_daily"], row["mood_last_daily"]) == (5.0, 9.0)


def test_column_order_follows_variable_then_statistic():
    names = CAT.names("daily")
    assert names[:7] == [f"mood_{s}_daily" for s in ("mean", "std", "std_slide", "max", "min", "first", "last")]
    assert names[-2:] == ["wake_time_daily", "bed_time_daily"]
    assert names.index("activity_sum_daily") < names.index("activity_max_daily")


def test_dotted_variables_and_usage_columns(spark):
    catalog = Catalog(
        averaged=("mood", "c.valence", "c.arousal"),
        summed=("call", "it's"),
        signed=("c.valence", "c.arousal"),
        usage=("call", "it's"),
        valence="c.valence",
        arousal="c.arousal",
    )
    rows = [
        (1, f"2024-01-{d:02d} {h:02d}:00:00", v, x)
        for d, h, v, x in ((1, 9, "mood", 5), (1, 10, "c.valence", 1), (2, 8, "c.arousal", 1), (3, 8, "mood", 7), (3, 9, "it's", 4), (3, 23, "mood", 7))
    ]
    panel = R.ready_panel(readings(spark, rows), catalog).orderBy("date").collect()
    assert [r["target"] for r in panel] == [6.0, 7.0]
    assert [(r["call_sum_daily"], r["it's_sum_daily"]) for r in panel] == [(0.0, 0.0), (0.0, 0.0)]
    assert panel[0]["quadrant_daily_1"] == 1


def test_trim(spark):
    panel = series(spark, [None, 1, None, 2, None]).unionByName(series(spark, [None, None], entity=2))
    kept = P.trim_observed_span(panel, "x").orderBy("date").collect()
    assert [(r["entity"], r["date"]) for r in kept] == [(1, day(1)), (1, day(2)), (1, day(3))]
    assert P.trim_override(panel, [(1, "2024-01-02", "2024-01-02")]).count() == 3


def test_linear(spark):
    assert column(I.fill_linear(series(spark, [None, 1, None, None, 4, None]), ["x"])) == [1, 1, 2, 3, 4, 4]
    assert column(I.fill_linear(series(spark, [None, None]), ["x"])) == [None, None]


def test_mode_takes_the_smallest(spark):
    assert column(I.fill_mode(series(spark, [2, 1, 2, 1, 3, None]), ["x"]))[-1] == 1.0


def test_mean_and_zero_and_median(spark):
    df = series(spark, [1, 2, None, 6])
    assert column(I.fill_mean(df, ["x"]))[2] == 3.0
    assert column(I.fill_zero(df, ["x"]))[2] == 0.0
    assert column(I.fill_median(df, ["x"]))[2] == 2.0
    assert I.null_audit(df, ["x"]).first()["n_missing"] == 1


def test_ewma(spark):
    got = column(X.add_ewma(series(spark, [1, 2, 3]), ["x"]), "ewma7_x")
    assert got == pytest.approx([1, 2.75 / 1.75, 5.0625 / 2.3125])


def test_change(spark):
    assert column(X.add_changes(series(spark, [5, 7, 4]), ["x"]), "change_x") == [0, 2, -3]


@pytest.mark.parametrize("v,a,code", [(0, 0, -10), (0, 1, 1), (-1, 0, 2), (0, -1, 3), (1, 0, 4), (None, 1, -1)])
def test_quadrant(spark, v, a, code):
    assert one(spark, E.quadrant(F.lit(v).cast("double"), F.lit(a).cast("double"))) == code


def test_sleep(spark):
    rows = [(1, day(i), float(b), float(w)) for i, (b, w) in enumerate([(23, 7), (1, 7), (22, 8)])]
    panel = spark.createDataFrame(rows, "entity bigint, date date, bed_time_daily double, wake_time_daily double")
    assert column(X.add_sleep(panel), "sleep_daily") == [7.5, 8.0, 7.0]


def test_sleep_repairs_the_bed_hour_before(spark):
    rows = [(1, day(i), float(b), float(w)) for i, (b, w) in enumerate([(23, 7), (12, 7), (22, 8), (23, 8)])]
    panel = spark.createDataFrame(rows, "entity bigint, date date, bed_time_daily double, wake_time_daily double")
    usual = (8 + (8 - 12) + 10) / 3
    repaired = X.add_sleep(panel)
    assert column(repaired, "sleep_daily") == pytest.approx([usual, 8, usual, 10])
    assert column(repaired, "bed_time_daily") == pytest.approx([23, 8 - usual, 22, 23])


@pytest.mark.parametrize("change,label", [(1.0, 0), (1.1, 1), (-1.1, -1), (None, None)])
def test_class_target(spark, change, label):
    got = spark.createDataFrame([(change, 2.0)], "c double, e double").selectExpr(X.class_of("c", "e") + " AS k").first()["k"]
    assert got == label


def test_value_bands(spark):
    df = spark.createDataFrame([(float(i),) for i in range(4)], "x double")
    assert [r["band"] for r in A.add_value_bands(df, "x").orderBy("x").collect()] == [None, "Low", "Medium", "High"]


@pytest.mark.parametrize("n,sizes", [(10, [7, 1, 2]), (3, [1, 1, 1]), (2, [0, 0, 0])])
def test_chrono_split(spark, n, sizes):
    got = {r["split"]: r["count"] for r in L.chrono_split(series(spark, range(n))).groupBy("split").count().collect()}
    assert [got.get(s, 0) for s in ("train", "val", "test")] == sizes


def test_padded_sequences(spark):
    got = Q.padded_sequences(series(spark, range(5)), ["x"], "x", 3).orderBy("date").collect()
    flat = [([step[0] for step in r["sequence"]], list(r["mask"]), r["target"]) for r in got]
    assert flat == [
        ([0, 1, 2], [1, 1, 1], 3),
        ([1, 2, 3], [1, 1, 1], 4),
        ([2, 3, 0], [1, 1, 0], 4),
        ([3, 0, 0], [1, 0, 0], 4),
    ]
    assert Q.full_sequences(series(spark, range(5)), ["x"], "x", 3).count() == 2


def test_standard_scale_of_a_constant(spark):
    df = series(spark, [5, 5, 5]).withColumn("split", F.lit("train"))
    assert column(C.scale_by_entity(df, ["x"])) == [0, 0, 0]


def test_a_column_constant_to_rounding_is_constant(spark):
    df = series(spark, [0.1 + 0.2, 0.3, 0.3]).withColumn("split", F.lit("train"))
    for kind in ("standard", "minmax"):
        assert column(C.scale_by_entity(df, ["x"], kind)) == pytest.approx([0, 0, 0], abs=1e-12)


def test_scaling_leaves_unseen_entities(spark):
    df = series(spark, [1, 3]).withColumn("split", F.lit("train")).unionByName(
        series(spark, [7], entity=2).withColumn("split", F.lit("test"))
    )
    assert [r["x"] for r in C.scale_by_entity(df, ["x"]).orderBy("entity", "date").collect()] == [-1, 1, 7]


def test_correlation_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    rows = {(r["x"], r["y"]): r["r"] for r in K.corr_matrix(df, ["a", "b"]).collect()}
    assert rows[("a", "b")] is None and math.isclose(rows[("b", "b")], 1.0)


def test_skewness(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (5.0, 3.0)], "x double, c double")
    got = {r["variable"]: r["skewness"] for r in A.skewness_profile(df, ["x", "c"]).collect()}
    assert got["x"] == pytest.approx(1.29334278) and got["c"] is None


def test_log_transform_skips_gaps_and_exclusions(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (0.0, 0.0, 0.0), (9.0, 9.0, None)], "x double, y double, z double")
    last = A.log_transform(df, ["x", "y", "z"], exclude=["y"]).orderBy("x").collect()[-1]
    assert last["x"] == pytest.approx(math.log(10)) and last["y"] == 9.0


def test_class_never_predicted_has_precision_zero(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "actual double, predicted double")
    matrix = V.confusion_matrix(df, [0.0, 1.0])
    assert sum(r["n"] for r in matrix.collect()) == 2
    rows = {r["class"]: r for r in V.classification_report(matrix).collect()}
    assert rows["1.0"]["precision"] == 0.0 and rows["0.0"]["precision"] == 0.5
    assert V.classification_metrics(matrix).first()["accuracy"] == 0.5


@pytest.mark.parametrize(
    "text,unit,low,high",
    [
        ("150.0 to 175.0 Horsepower", "Horsepower", 150.0, 175.0),
        ("2701.0+ Lb Operating Capacity", "Lb Operating Capacity", 2701.0, None),
        ("Unidentified (Compact Construction)", "Unidentified (Compact Construction)", None, None),
        ("Unidentified", "Unidentified", None, None),
        ("11' 4\"", "Inches", 136.0, 136.0),
        (None, "Inches", 0.0, 0.0),
        ("None or Unspecified", "Inches", 0.0, 0.0),
        ("Wheeled", "Wheeled", None, None),
    ],
)
def test_spec(spark, text, unit, low, high):
    parts = A.spec_columns(F.col("t"))
    row = spark.createDataFrame([(text,)], "t string").select(*[c.alias(n) for n, c in parts.items()]).first()
    assert (row["unit"], row["low"], row["high"]) == (unit, low, high)


def test_duplicate_columns_with_gaps(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("b", 2, "p"), (None, 3, "q")], "x string, y int, z string")
    assert [(r["column"], r["duplicate_of"]) for r in A.duplicate_columns(df, ["x", "y", "z"]).collect()] == [("y", "x")]


def test_r2_needs_two_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "actual double, predicted double")
    row = V.regression_metrics(df, []).first()
    assert row["r2"] is None and row["mae"] == 1.0


def test_grouped_importance(spark):
    df = spark.createDataFrame([("a_1", 0.2), ("a_2", 0.3), ("b", 0.4), ("c", 0.1)], "feature string, importance double")
    got = {r["source"]: r["importance"] for r in V.grouped_importance(df, ["a"], 2).collect()}
    assert got == pytest.approx({"a": 0.5, "b": 0.4, "Other": 0.1})


def test_numeric_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3)], "id int, app_a double, t string, y bigint")
    assert A.numeric_columns(df, exclude=["id"], without="app") == ["y"]
