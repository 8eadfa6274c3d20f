"""Physical plans: shuffles, pushdown, and nothing that runs in Python (but the moment matrix) or in one task."""

import pytest

from dailypanel.operators.moments import correlations
from dailypanel.plans import ready as R
from dailypanel.queries import bindings as B
from dailypanel.queries.all import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ready_panel_shuffles_twice(spark, small):
    text = plan(R.ready_panel(B.clean(spark, small), B.CATALOG, B.OVERRIDES))
    assert text.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in text and "Join" not in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text


def test_both_grains_shuffle_twice_and_never_join(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(R.both_panel(B.clean(spark, small), B.CATALOG, B.OVERRIDES))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2 and text.count("FileScan") == 1 and "Join" not in text


def test_parameter_joins_use_the_entity_hashing(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["inverse_scale"](spark, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "coalesce(entity" not in text and text.count("SortMergeJoin") == 2
    # each of the three panels is shuffled as a panel is, and by nothing else
    assert text.count("Exchange hashpartitioning") == 3 * 2


@pytest.mark.parametrize("name", ["daily_panel", "both_panel", "sequence_dataset", "histogram", "corr_matrix_by_entity", "label_encode"])
def test_no_python_and_no_cartesian_product(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["corr_matrix", "value_bands", "family_sum"])
def test_columns_are_pruned(spark, small, name):
    assert "l_shipdate" not in plan(QUERIES[name](spark, small))


def test_correlations_of_80_columns_scan_once(spark, small):
    lines = B.table(spark, small, "lineitem").selectExpr(*[f"l_quantity * {k} % 7 AS c{k}" for k in range(80)])
    columns = lines.columns
    text = plan(correlations(lines, columns, columns))
    assert text.count("FileScan") == 1 and text.count("MapInArrow") == 1


def test_tasks_of_a_panel_follow_its_days(spark, monkeypatch):
    from dailypanel.operators import panel as P

    monkeypatch.setattr(P, "TASK_DAYS", 10)
    raw = spark.range(40).selectExpr("concat('user.', id) AS id", "timestamp_ntz '2024-01-01 12:00:00' + make_dt_interval(CAST(3 * (id % 2) AS INT)) AS time", "id AS seq", "'mood' AS variable", "1D AS value")
    from dailypanel.sources.readings import readings_from_text_id

    raw = raw.union(raw.selectExpr("id", "time + INTERVAL '4' DAY", "seq + 100", "variable", "value"))
    readings = readings_from_text_id(raw)
    for build in (P.daily_panel, P.tod_panel, P.both_pivot):
        panel = build(readings, B.CATALOG)
        assert panel.rdd.getNumPartitions() == 2 + 40 * 5 // 10
        assert panel.count() == 40 * 5 * (1 if build is P.daily_panel else 3)
    assert P.panel_tasks(readings.limit(0)) == 2


def test_large_daily_panels_have_fewer_tasks_of_more_days(spark, monkeypatch):
    from dailypanel.operators import panel as P
    from dailypanel.sources.readings import readings_from_text_id

    for name, value in (("TASK_DAYS", 10), ("MANY_TASKS", 4), ("DAILY_TASK_DAYS", 25)):
        monkeypatch.setattr(P, name, value)
    raw = spark.range(40).selectExpr("concat('user.', id % 20) AS id", "timestamp_ntz '2024-01-01 12:00:00' + make_dt_interval(CAST(9 * (id DIV 20) AS INT)) AS time", "id AS seq", "'mood' AS variable", "1D AS value")
    readings = readings_from_text_id(raw)
    assert P.daily_panel(readings, B.CATALOG).rdd.getNumPartitions() == 2 + 200 // 25
    assert P.tod_panel(readings, B.CATALOG).rdd.getNumPartitions() == 2 + 200 // 10
    assert P.daily_panel(readings, B.CATALOG).count() == 200
    monkeypatch.setattr(P, "DAILY_TASK_DAYS", 1000)
    assert P.daily_panel(readings, B.CATALOG).rdd.getNumPartitions() == 2 + 4


def test_rows_of_fits_are_read_in_few_tasks(spark):
    from dailypanel.operators.lookup import for_passes, settle

    many = settle(spark.range(3000, numPartitions=300))
    few = for_passes(many)
    assert few.rdd.getNumPartitions() == 75 and few.agg({"id": "sum"}).first()[0] == 3000 * 2999 // 2
    assert for_passes(settle(spark.range(100, numPartitions=70))).rdd.getNumPartitions() == 64
    assert for_passes(settle(spark.range(100, numPartitions=9))).rdd.getNumPartitions() == 9
