"""Building blocks of the SQL counterparts.

Written independently of the operators: brute-force joins and correlated aggregates instead of the windows
and moments that the Spark side uses.
"""

from __future__ import annotations

from dailypanel.queries.registry import r

READINGS = """
readings AS (
  SELECT user_id AS entity, ts, event_id AS seq, variable, CAST(ts AS DATE) AS date,
         CAST(hour(ts) AS INTEGER) AS hour,
         CASE WHEN hour(ts) < 10 THEN 0 WHEN hour(ts) < 17 THEN 1 ELSE 2 END AS tod,
         CASE WHEN event_id % 37 <> 0 THEN (round(value * 100) - off) / CAST(100 AS DOUBLE) END AS value
  FROM (SELECT *,
          CASE event_type WHEN 'purchase' THEN 'mood' WHEN 'view' THEN 'valence' WHEN 'click' THEN 'arousal'
                          WHEN 'error' THEN 'screen' WHEN 'signup' THEN 'activity' END AS variable,
          CASE event_type WHEN 'view' THEN 5000 WHEN 'click' THEN 5000 WHEN 'error' THEN 500 ELSE 0 END AS off
        FROM events)),
clean AS (
  SELECT * FROM readings WHERE value IS NULL OR value >= 0 OR variable IN ('valence', 'arousal'))"""

CALENDAR = """
span AS (SELECT entity, min(date) AS lo, max(date) AS hi FROM clean GROUP BY entity),
calendar AS (
  SELECT entity, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
grid AS (SELECT entity, date, unnest([0, 1, 2]) AS tod FROM calendar)"""

MEANS = ("mood", "valence", "arousal")


def of(variable: str) -> str:
    return f"FILTER (WHERE variable = '{variable}')"


def _daily_aggregates() -> str:
    cols = []
    for v in MEANS:
        has = f"FILTER (WHERE variable = '{v}' AND value IS NOT NULL)"
        cols += [
            f"avg(value) {of(v)} AS {v}_mean_daily",
            f"stddev_samp(value) {of(v)} AS {v}_std_daily",
            f"max(value) {of(v)} AS {v}_max_daily",
            f"min(value) {of(v)} AS {v}_min_daily",
            f"first(value ORDER BY ts, seq) {has} AS {v}_first_daily",
            f"last(value ORDER BY ts, seq) {has} AS {v}_last_daily",
        ]
    for v in ("screen", "activity"):
        cols.append(
            f"CASE WHEN count(*) {of(v)} > 0 THEN coalesce(sum(value) {of(v)}, 0) END AS {v}_sum_daily"
        )
    cols.append(f"max(value) {of('activity')} AS activity_max_daily")
    return ",\n    ".join(cols)


def _slides() -> str:
    return ",\n    ".join(
        f"stddev_samp(r.value) FILTER (WHERE r.variable = '{v}') AS {v}_std_slide_daily" for v in MEANS
    )


DAILY_COLUMNS = (
    [f"mood_{s}_daily" for s in ("mean", "std", "std_slide", "max", "min", "first", "last")]
    + ["screen_sum_daily", "activity_sum_daily", "activity_max_daily"]
    + [
        f"{v}_{s}_daily"
        for v in ("valence", "arousal")
        for s in ("mean", "std", "std_slide", "max", "min", "first", "last")
    ]
    + ["wake_time_daily", "bed_time_daily"]
)
DAILY_MODE = [c for c in DAILY_COLUMNS if "_min_" in c or "_max_" in c]
DAILY_LINEAR = [c for c in DAILY_COLUMNS if c not in DAILY_MODE]

REST = """
rest AS (
  SELECT entity, CAST(ts - INTERVAL 5 HOUR AS DATE) AS date,
         max(CASE WHEN hour >= 18 THEN hour WHEN hour < 5 THEN hour + 24 END) AS bed_raw,
         min(CASE WHEN hour >= 5 AND hour < 13 THEN hour END) AS wake
  FROM clean WHERE variable <> 'activity' GROUP BY ALL)"""

DAILY = f"""{REST},
agg AS (
  SELECT entity, date,
    {_daily_aggregates()}
  FROM clean GROUP BY entity, date),
slide AS (
  SELECT c.entity, c.date,
    {_slides()}
  FROM calendar c LEFT JOIN clean r ON r.entity = c.entity AND r.date BETWEEN c.date - 2 AND c.date
  GROUP BY c.entity, c.date),
panel AS (
  SELECT c.entity, c.date, agg.* EXCLUDE (entity, date), slide.* EXCLUDE (entity, date),
    CAST(rest.wake AS DOUBLE) AS wake_time_daily,
    CAST(CASE WHEN bed_raw >= 24 THEN bed_raw - 24 ELSE bed_raw END AS DOUBLE) AS bed_time_daily
  FROM calendar c LEFT JOIN agg USING (entity, date) JOIN slide USING (entity, date)
  LEFT JOIN rest USING (entity, date))"""

TOD_CELLS = (
    [f"mood_{s}_tod" for s in ("mean", "max", "min")]
    + ["activity_max_tod"]
    + [f"{v}_{s}_tod" for v in ("valence", "arousal") for s in ("mean", "max", "min")]
)
TOD_MODE = [c for c in TOD_CELLS if "_min_" in c or "_max_" in c]
TOD_LINEAR = [c for c in TOD_CELLS if c not in TOD_MODE]


def _tod_aggregates() -> str:
    stat = {"mean": "avg", "max": "max", "min": "min"}
    parts = (c.split("_") for c in TOD_CELLS)
    return ", ".join(f"{stat[s]}(value) {of(v)} AS {v}_{s}_tod" for v, s, _ in parts)


TOD = f"""
tod_agg AS (SELECT entity, date, tod, {_tod_aggregates()} FROM clean GROUP BY entity, date, tod),
tod_panel AS (SELECT * FROM grid LEFT JOIN tod_agg USING (entity, date, tod))"""

_OVERRIDE = """
  AND NOT (p.entity = 1 AND p.date NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-20')
  AND NOT (p.entity = 12 AND p.date NOT BETWEEN DATE '2024-01-03' AND DATE '2024-01-25')"""

SEEN = """
seen AS (SELECT entity, min(date) AS lo, max(date) AS hi FROM clean
         WHERE variable = 'mood' AND value IS NOT NULL GROUP BY entity)"""


def trimmed(source: str, name: str) -> str:
    return f"""
{name} AS (SELECT p.* FROM {source} p JOIN seen USING (entity)
  WHERE p.date BETWEEN seen.lo AND seen.hi {_OVERRIDE})"""


TRIMMED = SEEN + "," + trimmed("panel", "trimmed")


def modes(source: str, columns: list[str], prefix: str) -> str:
    """One table per column with the smallest most frequent value per entity."""
    return ",\n".join(
        f"""{prefix}{c} AS (SELECT entity, {c} AS m FROM (
    SELECT entity, {c}, row_number() OVER (PARTITION BY entity ORDER BY count(*) DESC, {c}) AS k
    FROM {source} WHERE {c} IS NOT NULL GROUP BY entity, {c}) WHERE k = 1)"""
        for c in columns
    )


def line(c: str, pos: str, order: str) -> str:
    """Linear interpolation of a column over an order, flat at the edges."""
    back = f"OVER (PARTITION BY entity ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = f"OVER (PARTITION BY entity ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    at = f"CASE WHEN {c} IS NOT NULL THEN {pos} END"
    v0, v1 = f"last_value({c} IGNORE NULLS) {back}", f"first_value({c} IGNORE NULLS) {ahead}"
    p0, p1 = f"last_value({at} IGNORE NULLS) {back}", f"first_value({at} IGNORE NULLS) {ahead}"
    return (
        f"coalesce({c}, {v0} + ({v1} - {v0}) * (({pos}) - {p0}) / CAST({p1} - {p0} AS DOUBLE), {v0}, {v1})"
    )


def imputed(source: str, name: str, mode_cols, linear_cols, order: str, pos: str, prefix: str) -> str:
    """``name`` is ``source`` with mode and linear fills."""
    keep = "entity, date, tod" if "tod" in order else "entity, date"
    s_keep = ", ".join(f"s.{k}" for k in keep.split(", "))
    moded = ", ".join(f"coalesce(s.{c}, {prefix}{c}.m) AS {c}" for c in mode_cols)
    joins = " ".join(f"LEFT JOIN {prefix}{c} ON {prefix}{c}.entity = s.entity" for c in mode_cols)
    lines = ",\n    ".join(f"{line(c, pos, order)} AS {c}" for c in linear_cols)
    return f"""
{modes(source, mode_cols, prefix)},
{name}_m AS (SELECT {s_keep}, {moded}, {", ".join("s." + c for c in linear_cols)} FROM {source} s {joins}),
{name} AS (SELECT {keep}, {", ".join(mode_cols)},
    {lines}
  FROM {name}_m)"""


DAY_POS = "date - DATE '1970-01-01'"
TOD_POS = "(date - DATE '1970-01-01') * 3 + tod"
IMPUTED = imputed("trimmed", "imputed", DAILY_MODE, DAILY_LINEAR, "date", DAY_POS, "m_")

LEVELS = ["mood_mean_daily", "valence_mean_daily", "arousal_mean_daily", "wake_time_daily",
          "bed_time_daily", "screen_sum_daily", "activity_sum_daily"]
SMOOTHED = (
    LEVELS
    + [f"change_{c}" for c in LEVELS]
    + [f"{v}_{s}_daily" for v in MEANS for s in ("std", "std_slide")]
    + ["sleep_daily"]
)
TOD_LEVELS = ["mood_mean_tod", "valence_mean_tod", "arousal_mean_tod"]
TOD_SMOOTHED = TOD_LEVELS + [f"change_{c}" for c in TOD_LEVELS]


def quadrant(v: str, a: str) -> str:
    return f"""CASE WHEN {v} IS NULL OR {a} IS NULL THEN -1 WHEN {v} = 0 AND {a} = 0 THEN -10
      WHEN {v} >= 0 AND {a} > 0 THEN 1 WHEN {v} < 0 AND {a} >= 0 THEN 2
      WHEN {v} <= 0 AND {a} < 0 THEN 3 ELSE 4 END"""


def quadrant_flags(grain: str) -> str:
    code = quadrant(f"valence_mean_{grain}", f"arousal_mean_{grain}")
    return ", ".join(f"CAST(({code}) = {k} AS INTEGER) AS quadrant_{grain}_{k}" for k in (1, 2, 3, 4))


def changes(columns, order: str) -> str:
    return ", ".join(
        f"coalesce({c} - lag({c}) OVER (PARTITION BY entity ORDER BY {order}), 0) AS change_{c}" for c in columns
    )


def ewma_cte(source: str, columns, order: str, name: str, span: int = 7) -> str:
    """Brute force: every earlier row of the entity with its weight."""
    decay = f"(1 - CAST(2 AS DOUBLE) / {span + 1})"
    keys = "entity, " + order
    sums = ", ".join(
        f"CASE WHEN any_value(b.{c}) IS NOT NULL THEN sum(a.{c} * pow({decay}, b.n - a.n)) "
        f"/ sum(pow({decay}, b.n - a.n)) END AS ewma{span}_{c}"
        for c in columns
    )
    numbered = f"{name}_n AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY {order}) AS n FROM {source})"
    group = ", ".join("b." + k.strip() for k in keys.split(","))
    return f"""
{numbered},
{name}_e AS (SELECT {group}, {sums} FROM {name}_n b JOIN {name}_n a ON a.entity = b.entity AND a.n <= b.n
  GROUP BY {group}),
{name} AS (SELECT * EXCLUDE (n) FROM {name}_n JOIN {name}_e USING ({keys}))"""


SLEEP = """
nights AS (
  SELECT *, CASE WHEN p BETWEEN 15 AND 23 THEN 24 - p + wake_time_daily ELSE wake_time_daily - p END AS night
  FROM (SELECT *, lag(bed_time_daily) OVER (PARTITION BY entity ORDER BY date) AS p FROM imputed)),
usual AS (SELECT entity, avg(night) AS usual FROM nights GROUP BY entity),
slept AS (
  SELECT n.* EXCLUDE (p, night, bed_time_daily),
    CASE WHEN night > 0 THEN night ELSE usual END AS sleep_daily,
    CASE WHEN lead(night) OVER w <= 0 THEN lead(wake_time_daily) OVER w - usual
         ELSE bed_time_daily END AS bed_time_daily
  FROM nights n JOIN usual USING (entity) WINDOW w AS (PARTITION BY entity ORDER BY date))"""

FEATURES = f"""{SLEEP},
changed AS (SELECT *, {quadrant_flags("daily")}, {changes(LEVELS, "date")} FROM slept),
{ewma_cte("changed", SMOOTHED, "date", "smoothed")},
featured AS (
  SELECT * EXCLUDE (c), CAST(CASE WHEN c > e THEN 1 WHEN c < -e THEN -1 WHEN c <= e AND c >= -e THEN 0 END AS DOUBLE) AS categorical_target
  FROM (SELECT *, lead(change_mood_mean_daily) OVER (PARTITION BY entity ORDER BY date) AS c,
               0.5 * ewma7_mood_std_daily AS e FROM smoothed)
  ) """
FEATURES = FEATURES.replace("EXCLUDE (c)", "EXCLUDE (c, e)")


def calendar_flags(tod: bool = False) -> str:
    parts = [f"CAST(month(date) = {m} AS INTEGER) AS month_{m}" for m in range(2, 13)]
    parts += [f"CAST(isodow(date) - 1 = {d} AS INTEGER) AS weekday_{d}" for d in range(1, 7)]
    if tod:
        parts = ["tod AS tod_number"] + parts + [f"CAST(tod = {t} AS INTEGER) AS tod_{t}" for t in (1, 2)]
    return ", ".join(parts)


BED_WRAP = "CASE WHEN bed_time_daily < 15 THEN bed_time_daily + 24 ELSE bed_time_daily END AS bed_time_daily"
READY = f"""
nexted AS (SELECT *, lead(mood_mean_daily) OVER w AS target, lead(date) OVER w AS next_date FROM featured
  WINDOW w AS (PARTITION BY entity ORDER BY date)),
ready AS (SELECT * EXCLUDE (bed_time_daily), {BED_WRAP}, {calendar_flags()}
  FROM nexted WHERE target IS NOT NULL AND next_date IS NOT NULL)"""

TOD_CHAIN = (
    trimmed("tod_panel", "tod_trimmed")
    + ","
    + imputed("tod_trimmed", "tod_imputed", TOD_MODE, TOD_LINEAR, "date, tod", TOD_POS, "mt_")
)
BOTH = f"""
tod_changed AS (SELECT *, {quadrant_flags("tod")}, {changes(TOD_LEVELS, "date, tod")} FROM tod_imputed),
{ewma_cte("tod_changed", TOD_SMOOTHED, "date, tod", "tod_smoothed")},
both_raw AS (SELECT * FROM tod_smoothed LEFT JOIN featured USING (entity, date)),
both_next AS (SELECT *, lead(mood_mean_daily, 3) OVER w AS target, lead(date, 3) OVER w AS next_date FROM both_raw
  WINDOW w AS (PARTITION BY entity ORDER BY date, tod)),
both_ready AS (SELECT * EXCLUDE (bed_time_daily, tod), {BED_WRAP}, {calendar_flags(True)}
  FROM both_next WHERE target IS NOT NULL AND next_date IS NOT NULL)"""

STEPS = {
    "readings": READINGS,
    "calendar": CALENDAR,
    "daily": DAILY,
    "tod": TOD,
    "trimmed": TRIMMED,
    "imputed": IMPUTED,
    "features": FEATURES,
    "ready": READY,
    "tod_chain": TOD_CHAIN,
    "both": BOTH,
}
UP_TO = {
    "readings": ["readings"],
    "calendar": ["readings", "calendar"],
    "daily": ["readings", "calendar", "daily"],
    "tod": ["readings", "calendar", "tod"],
    "trimmed": ["readings", "calendar", "daily", "trimmed"],
    "imputed": ["readings", "calendar", "daily", "trimmed", "imputed"],
    "features": ["readings", "calendar", "daily", "trimmed", "imputed", "features"],
    "ready": ["readings", "calendar", "daily", "trimmed", "imputed", "features", "ready"],
    "tod_imputed": ["readings", "calendar", "daily", "tod", "trimmed", "tod_chain"],
    "both": ["readings", "calendar", "daily", "tod", "trimmed", "imputed", "features", "tod_chain", "both"],
}


def upto(step: str, *more: str) -> str:
    """A WITH clause up to a step, followed by further common tables."""
    return "WITH " + ",".join([STEPS[s] for s in UP_TO[step]] + list(more))


def rounded(columns, digits: int = 6) -> str:
    return ", ".join(f"{r(c, digits)} AS {c}" for c in columns)
