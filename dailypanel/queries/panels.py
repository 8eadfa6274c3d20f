"""Readings, panels, imputation and features."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from dailypanel.functions import expressions as E
from dailypanel.operators import evaluate as V
from dailypanel.operators import features as X
from dailypanel.operators import impute as I
from dailypanel.operators import panel as P
from dailypanel.plans import ready as R
from dailypanel.queries import bindings as B
from dailypanel.queries import sql as S
from dailypanel.queries.registry import D, N, T, query, r, tidy
from dailypanel.sources.readings import drop_negative, negative_audit, unreadable_audit

CAT = B.CATALOG
READING_COLUMNS = ["entity", "ts", "seq", "variable", "value", "date", "hour", "tod"]
READING_SQL = f"entity, {T}, seq, variable, value, {D}, hour, tod"


@query("load_readings", f"{S.upto('readings')} SELECT {READING_SQL} FROM readings")
def load_readings(spark, sf):
    return tidy(B.readings(spark, sf).select(*READING_COLUMNS))


@query(
    "tod_bands",
    f"{S.upto('readings')} SELECT hour, tod, count(*) AS n FROM readings GROUP BY hour, tod",
)
def tod_bands(spark, sf):
    return B.readings(spark, sf).groupBy("hour", "tod").agg(F.count("*").alias("n"))


@query("drop_negative", f"{S.upto('readings')} SELECT {READING_SQL} FROM clean")
def drop_negative_query(spark, sf):
    return tidy(drop_negative(B.readings(spark, sf), CAT.signed).select(*READING_COLUMNS))


@query(
    "negative_audit",
    f"""{S.upto('readings')} SELECT {READING_SQL} FROM readings
    WHERE value < 0 AND variable NOT IN ('valence', 'arousal')""",
)
def negative_audit_query(spark, sf):
    return tidy(negative_audit(B.readings(spark, sf), CAT.signed).select(*READING_COLUMNS))


@query("dense_calendar", f"{S.upto('calendar')} SELECT entity, {D} FROM calendar")
def dense_calendar(spark, sf):
    return tidy(P.dense_calendar(B.clean(spark, sf)))


@query("dense_tod_grid", f"{S.upto('calendar')} SELECT entity, {D}, tod FROM grid")
def dense_tod_grid(spark, sf):
    return tidy(P.dense_tod_grid(B.clean(spark, sf)))


@query("daily_panel", f"{S.upto('daily')} SELECT entity, {D}, {S.rounded(S.DAILY_COLUMNS)} FROM panel")
def daily_panel(spark, sf):
    return tidy(P.daily_panel(B.clean(spark, sf), CAT))


@query("tod_panel", f"{S.upto('tod')} SELECT entity, {D}, tod, {S.rounded(S.TOD_CELLS)} FROM tod_panel")
def tod_panel(spark, sf):
    return tidy(P.tod_panel(B.clean(spark, sf), CAT))


@query(
    "both_pivot",
    f"""{S.upto('daily', S.TOD)} SELECT entity, {D}, tod, {S.rounded(S.TOD_CELLS + S.DAILY_COLUMNS)}
    FROM tod_panel LEFT JOIN panel USING (entity, date)""",
)
def both_pivot(spark, sf):
    return tidy(P.both_pivot(B.clean(spark, sf), CAT))


@query("daily_part", f"{S.upto('daily')} SELECT entity, {D}, {S.rounded(S.DAILY_COLUMNS)} FROM panel")
def daily_part(spark, sf):
    return tidy(P.daily_part(P.both_pivot(B.clean(spark, sf), CAT), S.DAILY_COLUMNS))


_FIRST_LAST = [f"{v}_{s}_daily" for v in S.MEANS for s in ("first", "last")]


@query(
    "first_last_daily",
    f"{S.upto('daily')} SELECT entity, {D}, {S.rounded(_FIRST_LAST)} FROM panel",
)
def first_last_daily(spark, sf):
    return tidy(P.daily_panel(B.clean(spark, sf), CAT).select("entity", "date", *_FIRST_LAST))


_SLIDES = [f"{v}_std_slide_daily" for v in S.MEANS]


@query("sliding_std", f"{S.upto('daily')} SELECT entity, {D}, {S.rounded(_SLIDES)} FROM panel")
def sliding_std(spark, sf):
    return tidy(P.daily_panel(B.clean(spark, sf), CAT).select("entity", "date", *_SLIDES))


@query(
    "rest_times",
    f"""{S.upto('daily')} SELECT entity, {D}, wake_time_daily, bed_time_daily,
    CASE WHEN bed_time_daily < 15 THEN bed_time_daily + 24 ELSE bed_time_daily END AS bed_time_wrapped FROM panel""",
)
def rest_times(spark, sf):
    panel = P.daily_panel(B.clean(spark, sf), CAT)
    wrapped = E.wrapped_bed(F.col("bed_time_daily")).alias("bed_time_wrapped")
    return tidy(panel.select("entity", "date", "wake_time_daily", "bed_time_daily", wrapped))


@query(
    "trim_observed_span",
    f"""{S.upto('daily', S.SEEN)} SELECT entity, {D}, {S.rounded(S.DAILY_COLUMNS)}
    FROM panel JOIN seen USING (entity) WHERE date BETWEEN lo AND hi""",
)
def trim_observed_span(spark, sf):
    return tidy(P.trim_observed_span(P.daily_panel(B.clean(spark, sf), CAT), "mood_mean_daily"))


@query("trim_override", f"{S.upto('trimmed')} SELECT entity, {D}, {S.rounded(S.DAILY_COLUMNS)} FROM trimmed")
def trim_override(spark, sf):
    return tidy(_trimmed(spark, sf))


@query(
    "trim_windows",
    f"""{S.upto('daily')}, s AS (SELECT entity, min(date) AS lo, max(date) AS hi FROM panel GROUP BY entity),
    w AS (SELECT entity, lo + 2 AS a, lo + 5 AS b FROM s WHERE entity % 3 = 0 UNION ALL SELECT entity, lo + 9, hi FROM s WHERE entity % 3 = 0)
    SELECT entity, {D}, {S.rounded(S.DAILY_COLUMNS)} FROM panel p WHERE entity % 3 <> 0
      OR EXISTS (FROM w WHERE w.entity = p.entity AND p.date BETWEEN a AND b)""",
)
def trim_windows(spark, sf):
    """Two windows for every third entity, from a table."""
    readings = B.clean(spark, sf)
    spans = P.dense_calendar(readings).filter("entity % 3 = 0").groupBy("entity").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    windows = spans.selectExpr("entity", "inline(array(struct(date_add(lo, 2) AS start, date_add(lo, 5) AS end), struct(date_add(lo, 9) AS start, hi AS end)))")
    return tidy(P.trim_windows(P.daily_panel(readings, CAT), windows))


def _trimmed(spark, sf, grain="daily"):
    return R.trimmed_panel(B.clean(spark, sf), CAT, B.OVERRIDES, grain)


@query(
    "calendar_onehot",
    f"""{S.upto('calendar')} SELECT entity, {D}, {S.calendar_flags(True)}
    FROM grid""",
)
def calendar_onehot(spark, sf):
    return tidy(X.encode_calendar(X.add_calendar(P.dense_tod_grid(B.clean(spark, sf)))))


_SUMS = ["screen_sum_daily", "activity_sum_daily"]


@query(
    "impute_zero",
    f"{S.upto('trimmed')} SELECT entity, {D}, "
    + ", ".join(f"{r(f'coalesce({c}, 0)')} AS {c}" for c in _SUMS)
    + " FROM trimmed",
)
def impute_zero(spark, sf):
    return tidy(I.fill_zero(_trimmed(spark, sf).select("entity", "date", *_SUMS), _SUMS))


_MEANS = [f"{v}_mean_daily" for v in S.MEANS]


@query(
    "impute_mean",
    f"{S.upto('trimmed')} SELECT entity, {D}, "
    + ", ".join(f"{r(f'coalesce({c}, avg({c}) OVER (PARTITION BY entity))')} AS {c}" for c in _MEANS)
    + " FROM trimmed",
)
def impute_mean(spark, sf):
    return tidy(I.fill_mean(_trimmed(spark, sf).select("entity", "date", *_MEANS), _MEANS))


@query(
    "impute_mode",
    f"{S.upto('imputed')} SELECT entity, {D}, {S.rounded(S.DAILY_MODE)} FROM imputed",
)
def impute_mode(spark, sf):
    return tidy(I.fill_mode(_trimmed(spark, sf).select("entity", "date", *S.DAILY_MODE), S.DAILY_MODE))


@query(
    "impute_linear",
    f"{S.upto('imputed')} SELECT entity, {D}, {S.rounded(S.DAILY_LINEAR)} FROM imputed",
)
def impute_linear(spark, sf):
    return tidy(I.fill_linear(_trimmed(spark, sf).select("entity", "date", *S.DAILY_LINEAR), S.DAILY_LINEAR))


@query(
    "impute_linear_tod",
    f"{S.upto('tod_imputed')} SELECT entity, {D}, tod, {S.rounded(S.TOD_LINEAR)} FROM tod_imputed",
)
def impute_linear_tod(spark, sf):
    panel = _trimmed(spark, sf, "tod").select("entity", "date", "tod", *S.TOD_LINEAR)
    return tidy(I.fill_linear(panel, S.TOD_LINEAR, "tod"))


@query("impute_all", f"{S.upto('imputed')} SELECT entity, {D}, {S.rounded(S.DAILY_COLUMNS)} FROM imputed")
def impute_all(spark, sf):
    return tidy(I.impute_all(_trimmed(spark, sf), CAT))


_OVERRIDDEN = {"mood_std_daily": "mean", "mood_max_daily": "median", "screen_sum_daily": "zero", "valence_min_daily": "linear", "wake_time_daily": "median"}
_FILL_SQL = {
    "mean": "coalesce({0}, avg({0}) OVER (PARTITION BY entity))",
    "median": "coalesce({0}, median({0}) OVER (PARTITION BY entity))",
    "zero": "coalesce({0}, 0)",
}


@query(
    "impute_override",
    f"""{S.upto('imputed')} SELECT entity, {D}, {", ".join(
        f"{r(_FILL_SQL[f].format(c) if f in _FILL_SQL else S.line(c, S.DAY_POS, 'date'))} AS {c}" for c, f in _OVERRIDDEN.items())} FROM trimmed""",
)
def impute_override(spark, sf):
    """Fills that the caller chooses for single columns."""
    catalog = replace(CAT, fills=tuple(_OVERRIDDEN.items()))
    return tidy(I.impute_all(_trimmed(spark, sf), catalog).select("entity", "date", *_OVERRIDDEN))


@query(
    "unreadable_audit",
    f"""{S.upto('readings')} SELECT event_id AS seq, CASE WHEN event_id % 41 = 0 THEN 'user.x' ELSE 'user.' || user_id END AS id FROM events WHERE event_id % 41 = 0""",
)
def unreadable_audit_query(spark, sf):
    """Raw rows whose id says no entity."""
    raw = B.raw_readings(spark, sf).withColumn("id", F.when(F.col("seq") % 41 == 0, "user.x").otherwise(F.col("id")))
    return unreadable_audit(raw).select("seq", "id")


@query(
    "concat_grains",
    f"""{S.upto('daily', S.TOD)} SELECT entity, {D}, NULL::VARCHAR AS tod, {r('mood_mean_daily')} AS mood_mean_daily, NULL::DOUBLE AS mood_mean_tod FROM panel
    UNION ALL SELECT entity, {D}, tod::VARCHAR, NULL, {r('mood_mean_tod')} FROM tod_panel""",
)
def concat_grains(spark, sf):
    """Both grains below each other; what a grain lacks is null."""
    readings = B.clean(spark, sf)
    daily = P.daily_panel(readings, CAT).select("entity", "date", "mood_mean_daily")
    return tidy(V.concat([daily, P.tod_panel(readings, CAT).select("entity", "date", F.col("tod").cast("string").alias("tod"), "mood_mean_tod")]))


@query(
    "null_audit",
    f"""{S.upto('imputed')} {' UNION ALL '.join(
        f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM imputed"
        for c in S.DAILY_COLUMNS)}""",
)
def null_audit(spark, sf):
    return I.null_audit(I.impute_all(_trimmed(spark, sf), CAT), S.DAILY_COLUMNS)


_FLAGS = [f"quadrant_daily_{k}" for k in (1, 2, 3, 4)]


@query(
    "quadrant",
    f"{S.upto('imputed')} SELECT entity, {D}, {S.quadrant_flags('daily')} FROM imputed",
)
def quadrant(spark, sf):
    cols = ["valence_mean_daily", "arousal_mean_daily"]
    panel = I.fill_linear(_trimmed(spark, sf).select("entity", "date", *cols), cols)
    return tidy(X.add_quadrant(panel, CAT).select("entity", "date", *_FLAGS))


_RESTS = ["wake_time_daily", "bed_time_daily"]


@query(
    "sleep_hours",
    f"{S.upto('features')} SELECT entity, {D}, {S.rounded(_RESTS + ['sleep_daily'])} FROM slept",
)
def sleep_hours(spark, sf):
    panel = I.fill_linear(_trimmed(spark, sf).select("entity", "date", *_RESTS), _RESTS)
    return tidy(X.add_sleep(panel))


@query(
    "day_change",
    f"{S.upto('features')} SELECT entity, {D}, {S.rounded(['change_' + c for c in S.LEVELS])} FROM changed",
)
def day_change(spark, sf):
    panel = I.fill_linear(_trimmed(spark, sf).select("entity", "date", *S.LEVELS), S.LEVELS)
    panel = X.add_changes(X.add_sleep(panel), S.LEVELS)
    return tidy(panel.select("entity", "date", *["change_" + c for c in S.LEVELS]))


@query(
    "ewma",
    f"{S.upto('features')} SELECT entity, {D}, {S.rounded(['ewma7_' + c for c in S.SMOOTHED])} FROM smoothed",
)
def ewma(spark, sf):
    panel = R.daily_features(_trimmed(spark, sf), CAT)
    return tidy(panel.select("entity", "date", *["ewma7_" + c for c in S.SMOOTHED]))


@query(
    "class_target",
    f"""{S.upto('features')} SELECT entity, {D}, {r('change_mood_mean_daily')} AS change_mood_mean_daily,
    {r('ewma7_mood_std_daily')} AS ewma7_mood_std_daily, categorical_target FROM featured""",
)
def class_target(spark, sf):
    cols = ["mood_mean_daily", "mood_std_daily"]
    panel = I.fill_linear(_trimmed(spark, sf).select("entity", "date", *cols), cols)
    panel = X.add_ewma(X.add_changes(panel, cols[:1]), cols[1:])
    return tidy(
        X.add_class_target(panel, CAT).select(
            "entity", "date", "change_mood_mean_daily", "ewma7_mood_std_daily", "categorical_target"
        )
    )


_FEATURES = (
    S.DAILY_COLUMNS + _FLAGS + ["sleep_daily"]
    + ["change_" + c for c in S.LEVELS] + ["ewma7_" + c for c in S.SMOOTHED]
)
_FLOATS = [c for c in _FEATURES if c not in _FLAGS]
_DATED = [f"month_{m}" for m in range(2, 13)] + [f"weekday_{d}" for d in range(1, 7)]


@query(
    "feature_panel",
    f"{S.upto('features')} SELECT entity, {D}, {S.rounded(_FLOATS)}, {', '.join(_FLAGS)}, categorical_target FROM featured",
)
def feature_panel(spark, sf):
    return tidy(R.daily_features(_trimmed(spark, sf), CAT))


@query(
    "next_day_target",
    f"""{S.upto('imputed')}, t AS (SELECT entity, date, mood_mean_daily,
      lead(mood_mean_daily) OVER w AS target, lead(date) OVER w AS next_date
      FROM imputed WINDOW w AS (PARTITION BY entity ORDER BY date))
    SELECT entity, {D}, {N}, {S.rounded(['mood_mean_daily', 'target'])} FROM t
    WHERE target IS NOT NULL AND next_date IS NOT NULL""",
)
def next_day_target(spark, sf):
    panel = I.fill_linear(_trimmed(spark, sf).select("entity", "date", "mood_mean_daily"), ["mood_mean_daily"])
    return tidy(X.add_next_day(panel, "mood_mean_daily"))


@query(
    "next_day_target_tod",
    f"""{S.upto('tod_imputed')}, t AS (SELECT entity, date, tod, mood_mean_tod,
      lead(mood_mean_tod, 3) OVER w AS target, lead(date, 3) OVER w AS next_date
      FROM tod_imputed WINDOW w AS (PARTITION BY entity ORDER BY date, tod))
    SELECT entity, {D}, tod, {N}, {S.rounded(['mood_mean_tod', 'target'])} FROM t
    WHERE target IS NOT NULL AND next_date IS NOT NULL""",
)
def next_day_target_tod(spark, sf):
    panel = _trimmed(spark, sf, "tod").select("entity", "date", "tod", "mood_mean_tod")
    return tidy(X.add_next_day(I.fill_linear(panel, ["mood_mean_tod"], "tod"), "mood_mean_tod", "tod"))


def ready(spark, sf):
    """The ready daily panel that splits, models and evaluations start from."""
    return R.ready_panel(B.clean(spark, sf), CAT, B.OVERRIDES)


@query(
    "ready_panel",
    f"""{S.upto('ready')} SELECT entity, {D}, {N}, {S.rounded(_FLOATS + ['target'])},
    {', '.join(_FLAGS + _DATED)}, categorical_target FROM ready""",
)
def ready_panel(spark, sf):
    return tidy(ready(spark, sf))


_TOD_FLAGS = [f"quadrant_tod_{k}" for k in (1, 2, 3, 4)]
_TOD_FLOATS = S.TOD_CELLS + ["change_" + c for c in S.TOD_LEVELS] + ["ewma7_" + c for c in S.TOD_SMOOTHED]


@query(
    "both_panel",
    f"""{S.upto('both')} SELECT entity, {D}, {N}, {S.rounded(_FLOATS + _TOD_FLOATS + ['target'])},
    {', '.join(_FLAGS + _TOD_FLAGS + _DATED)}, tod_number, tod_1, tod_2, categorical_target FROM both_ready""",
)
def both_panel(spark, sf):
    return tidy(R.both_panel(B.clean(spark, sf), CAT, B.OVERRIDES))
