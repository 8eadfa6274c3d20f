"""Profiles, encodings and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailypanel.operators import correlate as K
from dailypanel.operators import encode as N
from dailypanel.operators import impute as I
from dailypanel.operators import panel as P
from dailypanel.operators import profile as A
from dailypanel.operators.features import class_remap, family_sum
from dailypanel.queries import bindings as B
from dailypanel.queries import sql as S
from dailypanel.queries.panels import _FEATURES, ready
from dailypanel.queries.registry import D, query, r, tidy

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CONSTANT = NUMBERS + ["one"]


@query("hourly_profile", f"{S.upto('readings')} SELECT variable, hour, count(*) AS n FROM readings GROUP BY ALL")
def hourly_profile(spark, sf):
    return A.count_by(B.readings(spark, sf).filter("variable IS NOT NULL"), ["variable", "hour"])


@query("hour_histogram", f"{S.upto('readings')} SELECT hour, count(*) AS n FROM readings GROUP BY ALL")
def hour_histogram(spark, sf):
    return A.count_by(B.readings(spark, sf), ["hour"])


@query(
    "rest_hour_histogram",
    f"""{S.upto('daily')} SELECT 'bed' AS kind, CAST(floor(bed_time_daily) AS BIGINT) AS hour, count(*) AS n FROM panel
    WHERE bed_time_daily IS NOT NULL GROUP BY ALL UNION ALL
    SELECT 'wake', CAST(floor(wake_time_daily) AS BIGINT), count(*) FROM panel
    WHERE wake_time_daily IS NOT NULL GROUP BY ALL""",
)
def rest_hour_histogram(spark, sf):
    return A.rest_hour_histogram(P.daily_panel(B.clean(spark, sf), B.CATALOG))


@query(
    "entity_day_mean",
    f"{S.upto('tod')} SELECT entity, {D}, "
    + ", ".join(f"{r(f'avg({c})')} AS {c}" for c in S.TOD_CELLS)
    + " FROM tod_panel GROUP BY entity, date",
)
def entity_day_mean(spark, sf):
    return tidy(A.entity_day_mean(P.tod_panel(B.clean(spark, sf), B.CATALOG), S.TOD_CELLS))


def _missing_sql(entity: str, group: str) -> str:
    return f"""SELECT {entity} AS entity, variable, count(*) - count(value) AS n_missing,
      {r('(count(*) - count(value)) / CAST(count(*) AS DOUBLE)', 3)} AS missing_share,
      count(DISTINCT value) AS n_unique, count(*) FILTER (WHERE value = 0) AS n_zero,
      {r('count(*) FILTER (WHERE value = 0) / CAST(count(*) AS DOUBLE)', 3)} AS zero_share
    FROM long GROUP BY {group}"""


@query(
    "missing_profile",
    f"""{S.upto('daily')}, long AS ({' UNION ALL '.join(
        f"SELECT entity, '{c}' AS variable, {r(c)} AS value FROM panel" for c in S.DAILY_COLUMNS)})
    {_missing_sql('CAST(entity AS VARCHAR)', 'entity, variable')} UNION ALL {_missing_sql("'all'", 'variable')}""",
)
def missing_profile(spark, sf):
    panel = tidy(P.daily_panel(B.clean(spark, sf), B.CATALOG))
    return tidy(A.missing_profile(panel, S.DAILY_COLUMNS), 3)


TEXTS = ["c_mktsegment", "c_nation"]
CUSTOMER_SQL = """WITH c AS (SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS c_mktsegment,
  'nation ' || CAST(c_nationkey AS VARCHAR) AS c_nation FROM customer)"""


def customers(spark, sf):
    """Customers with some missing segments and a text nation."""
    return B.table(spark, sf, "customer").select(
        "c_custkey",
        "c_acctbal",
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("c_nation"),
    )


_LONG = " UNION ALL ".join(f"SELECT '{c}' AS variable, {c} AS value FROM c" for c in TEXTS)


@query(
    "categorical_profile",
    f"""{CUSTOMER_SQL}, long AS ({_LONG}),
    counted AS (SELECT variable, value, count(*) AS n FROM long GROUP BY ALL),
    best AS (SELECT variable, value AS most_frequent FROM (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC, value) AS k
      FROM counted WHERE value IS NOT NULL) WHERE k = 1)
    SELECT variable, count(DISTINCT value) AS n_unique, count(*) - count(value) AS n_missing,
      {r('count(DISTINCT value) / CAST(count(*) AS DOUBLE)')} AS unique_share,
      {r('(count(*) - count(value)) / CAST(count(*) AS DOUBLE)')} AS missing_share, any_value(most_frequent) AS most_frequent
    FROM long JOIN best USING (variable) GROUP BY variable""",
)
def categorical_profile(spark, sf):
    return tidy(A.categorical_profile(customers(spark, sf), TEXTS))


@query(
    "categorical_values",
    f"{CUSTOMER_SQL}, long AS ({_LONG}) SELECT variable, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL",
)
def categorical_values(spark, sf):
    return A.value_counts(customers(spark, sf), TEXTS).filter("value IS NOT NULL")


@query(
    "frequency_encoding",
    f"""{CUSTOMER_SQL}, f AS (SELECT c_mktsegment, count(*) / CAST((SELECT count(*) FROM c) AS DOUBLE) AS f FROM c
      WHERE c_mktsegment IS NOT NULL GROUP BY 1)
    SELECT c_custkey, {r('f')} AS c_mktsegment_freq FROM c LEFT JOIN f USING (c_mktsegment)""",
)
def frequency_encoding(spark, sf):
    encoded = N.frequency_encoding(customers(spark, sf), "c_mktsegment")
    return tidy(encoded.select("c_custkey", "c_mktsegment_freq"))


@query(
    "label_encode",
    f"""{CUSTOMER_SQL}, s AS (SELECT c_custkey, coalesce(c_mktsegment, 'nan') AS a, c_nation AS b FROM c)
    SELECT c_custkey, dense_rank() OVER (ORDER BY a) - 1 AS c_mktsegment, dense_rank() OVER (ORDER BY b) - 1 AS c_nation FROM s""",
)
def label_encode(spark, sf):
    return N.label_encode(customers(spark, sf).select("c_custkey", *TEXTS), TEXTS)


@query(
    "class_index",
    f"""{CUSTOMER_SQL} SELECT c_custkey, c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS class_index FROM c
    WHERE c_mktsegment IS NOT NULL""",
)
def class_index(spark, sf):
    labelled = customers(spark, sf).filter("c_mktsegment IS NOT NULL")
    return N.class_index(labelled.select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query(
    "class_remap",
    f"""{S.upto('ready')} SELECT entity, {D},
    CASE categorical_target WHEN -1 THEN CAST(0 AS DOUBLE) WHEN 0 THEN 1 WHEN 1 THEN 2 END AS class FROM ready""",
)
def class_remap_query(spark, sf):
    coded = class_remap(F.col("categorical_target"), {-1.0: 0.0, 0.0: 1.0, 1.0: 2.0})
    return tidy(ready(spark, sf).select("entity", "date", coded.alias("class")))


@query(
    "family_sum",
    f"""SELECT l_orderkey, l_linenumber, l_quantity,
    {r('coalesce(l_discount, 0) + coalesce(CASE WHEN l_linenumber <> 3 THEN l_tax END, 0)')} AS l_rates FROM lineitem""",
)
def family_sum_query(spark, sf):
    lines = B.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        F.when(F.col("l_linenumber") != 3, F.col("l_tax")).alias("l_tax"),
    )
    return tidy(family_sum(lines, ["l_discount", "l_tax"], "l_rates"))


LOGGED = ["l_extendedprice", "l_discount", "price_square"]


def _lines(spark, sf):
    return B.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        *NUMBERS,
        F.lit(1.0).alias("one"),
        (F.col("l_quantity") * F.col("l_quantity")).alias("price_square"),
    )


_LINES_SQL = "l AS (SELECT *, CAST(1 AS DOUBLE) AS one, l_quantity * l_quantity AS price_square FROM lineitem)"


def _skew_sql(c: str) -> str:
    return f"""(SELECT avg(pow(({c} - m) / s, 3)) FROM l, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM l))"""


@query(
    "log_transform",
    f"""WITH {_LINES_SQL} SELECT l_orderkey, l_linenumber, """
    + ", ".join(f"{r(f'CASE WHEN {_skew_sql(c)} > 0.5 THEN ln(1 + {c}) ELSE {c} END')} AS {c}" for c in LOGGED)
    + " FROM l",
)
def log_transform(spark, sf):
    lines = _lines(spark, sf).select("l_orderkey", "l_linenumber", *LOGGED)
    return tidy(A.log_transform(lines, LOGGED))


@query(
    "skewness_profile",
    f"WITH {_LINES_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {r(f'skewness({c})') if c != 'one' else 'CAST(min(NULL) AS DOUBLE)'} AS skewness FROM l"
        for c in CONSTANT
    ),
)
def skewness_profile(spark, sf):
    return tidy(A.skewness_profile(_lines(spark, sf), CONSTANT))


def _histogram_sql(by: str, bins: int) -> str:
    key = f"{by}, " if by else ""
    on = f"({by}, variable)" if by else "(variable)"
    long = " UNION ALL ".join(f"SELECT {key}'{c}' AS variable, {c} AS value FROM l" for c in CONSTANT)
    return f"""WITH {_LINES_SQL}, long AS ({long}),
    e AS (SELECT {key}variable, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
          CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM long GROUP BY ALL),
    w AS (SELECT *, (hi - lo) / {bins} AS width FROM e),
    c AS (SELECT {key}variable, least(floor((value - lo) / width), {bins - 1}) AS bin, count(*) AS n
          FROM long JOIN w USING {on} GROUP BY ALL)
    SELECT {key}w.variable, CAST(b.bin AS INTEGER) AS bin, {r('lo + b.bin * width')} AS bin_start, coalesce(n, 0) AS n
    FROM w, range({bins}) b(bin) LEFT JOIN c ON c.variable = w.variable AND c.bin = b.bin
    {f'AND c.{by} = w.{by}' if by else ''}""".replace(f"SELECT {key}w.", f"SELECT {f'w.{by}, ' if by else ''}w.")


@query("histogram", _histogram_sql("", 50))
def histogram(spark, sf):
    return tidy(A.histogram(_lines(spark, sf), CONSTANT, 50))


@query("histogram_by_entity", _histogram_sql("l_returnflag", 10))
def histogram_by_entity(spark, sf):
    return tidy(A.histogram(_lines(spark, sf), CONSTANT, 10, ["l_returnflag"]))


def _corr_sql(by: str) -> str:
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""

    def cell(x: str, y: str) -> str:
        return "CAST(NULL AS DOUBLE)" if "one" in (x, y) else r(f"corr({x}, {y})")

    return f"WITH {_LINES_SQL} " + " UNION ALL ".join(
        f"SELECT {key}'{x}' AS x, '{y}' AS y, {cell(x, y)} AS r, count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n FROM l {group}"
        for x in CONSTANT
        for y in CONSTANT
    )


@query("corr_matrix", _corr_sql(""))
def corr_matrix(spark, sf):
    return tidy(K.corr_matrix(_lines(spark, sf), CONSTANT))


@query("corr_matrix_by_entity", _corr_sql("l_returnflag"))
def corr_matrix_by_entity(spark, sf):
    return tidy(K.corr_matrix(_lines(spark, sf), CONSTANT, ["l_returnflag"]))


_TARGETED = "t AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, corr({c}, target) AS r, count(*) FILTER (WHERE {c} IS NOT NULL) AS n FROM ready"
    for c in _FEATURES
) + ")"


@query("target_correlation", f"{S.upto('ready', _TARGETED)} SELECT variable, {r('r')} AS r, n FROM t")
def target_correlation(spark, sf):
    return tidy(K.target_correlation(ready(spark, sf), _FEATURES, "target"))


@query(
    "top_correlated",
    f"""{S.upto('ready', _TARGETED)} SELECT variable, {r('r')} AS r, n FROM t
    ORDER BY round(abs(r), 9) DESC, variable LIMIT 15""",
)
def top_correlated(spark, sf):
    return tidy(K.top_correlated(ready(spark, sf), _FEATURES, "target", 15))


@query(
    "top_correlated_signed",
    f"""{S.upto('ready', _TARGETED)} SELECT variable, {r('r')} AS r, n FROM t
    ORDER BY round(r, 9) DESC, variable LIMIT 37""",
)
def top_correlated_signed(spark, sf):
    return tidy(K.top_correlated(ready(spark, sf), _FEATURES, "target", 37, signed=True))


PART_TEXT, PART_NUMBERS = ["p_brand", "p_type", "p_name"], ["p_partkey", "p_size", "p_retailprice", "p_rest"]
_PARTS_SQL = """p AS (SELECT *, CASE WHEN p_partkey % 7 <> 0 THEN p_size % 13 END AS p_rest FROM part),
m AS (SELECT median(p_rest) AS m FROM p),
e AS (SELECT dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type,
  dense_rank() OVER (ORDER BY p_name) - 1 AS p_name, p_partkey, p_size, p_retailprice, coalesce(p_rest, m) AS p_rest FROM p, m)"""


def _parts(spark, sf):
    return B.table(spark, sf, "part").withColumn(
        "p_rest", F.when(F.col("p_partkey") % 7 != 0, F.col("p_size") % 13)
    )


@query(
    "corr_extremes",
    f"WITH {_PARTS_SQL}, t AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, corr({c}, p_retailprice) AS r, count(*) AS n FROM e" for c in PART_TEXT + PART_NUMBERS
    )
    + f""") SELECT variable, {r('r')} AS r, n, 'top' AS side FROM (SELECT * FROM t ORDER BY round(r, 9) DESC, variable LIMIT 5)
    UNION ALL SELECT variable, {r('r')}, n, 'bottom' FROM (SELECT * FROM t ORDER BY round(r, 9), variable DESC LIMIT 5)""",
)
def corr_extremes(spark, sf):
    return tidy(K.corr_extremes(_parts(spark, sf), PART_TEXT, PART_NUMBERS, "p_retailprice"))


@query(
    "impute_median",
    f"""WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_size % 13 END AS p_rest,
      CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END AS p_price FROM part)
    SELECT p_partkey, CAST(coalesce(p_rest, (SELECT median(p_rest) FROM p)) AS DOUBLE) AS p_rest,
    {r('coalesce(p_price, (SELECT median(p_price) FROM p))')} AS p_price FROM p""",
)
def impute_median(spark, sf):
    parts = _parts(spark, sf).select(
        "p_partkey", "p_rest", F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice")).alias("p_price")
    )
    return tidy(I.fill_median(parts, ["p_rest", "p_price"]))


@query(
    "duplicate_columns",
    "WITH p AS (SELECT p_brand, 'x' || reverse(p_brand) AS brand_code, p_size, p_size + 1 AS size_next, p_size % 7 AS size_rest FROM part) "
    + " UNION ALL ".join(
        f"""SELECT '{b}' AS "column", '{a}' AS duplicate_of FROM p HAVING count(DISTINCT {a}) = count(DISTINCT {b})
        AND count(DISTINCT {a}) = count(DISTINCT ({a}, {b}))"""
        for a, b in (
            ("p_brand", "brand_code"), ("p_brand", "p_size"), ("p_brand", "size_next"), ("p_brand", "size_rest"),
            ("brand_code", "p_size"), ("brand_code", "size_next"), ("brand_code", "size_rest"),
            ("p_size", "size_next"), ("p_size", "size_rest"), ("size_next", "size_rest"),
        )
    ),
)
def duplicate_columns(spark, sf):
    parts = B.table(spark, sf, "part").select(
        "p_brand",
        F.concat(F.lit("x"), F.reverse("p_brand")).alias("brand_code"),
        "p_size",
        (F.col("p_size") + 1).alias("size_next"),
        (F.col("p_size") % 7).alias("size_rest"),
    )
    return A.duplicate_columns(parts, parts.columns)


@query(
    "top_category_box",
    f"""WITH t AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3)
    SELECT o_orderpriority, any_value(n) AS n, {r('min(o_totalprice)')} AS low, {r('quantile_cont(o_totalprice, 0.25)')} AS q25,
    {r('median(o_totalprice)')} AS q50, {r('quantile_cont(o_totalprice, 0.75)')} AS q75, {r('max(o_totalprice)')} AS high
    FROM orders JOIN t USING (o_orderpriority) GROUP BY 1""",
)
def top_category_box(spark, sf):
    return tidy(A.top_category_box(B.table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", 3))


def band_sql(value: str, low: str, high: str) -> str:
    return f"""CASE WHEN {value} > {low} AND {value} <= ({low} + {high}) / 3 THEN 'Low'
      WHEN {value} > ({low} + {high}) / 3 AND {value} <= 2 * ({low} + {high}) / 3 THEN 'Medium'
      WHEN {value} > 2 * ({low} + {high}) / 3 AND {value} <= {high} THEN 'High' END"""


@query(
    "value_bands",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice, {band_sql('l_extendedprice', 'lo', 'hi')} AS band
    FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)""",
)
def value_bands(spark, sf):
    lines = B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return A.add_value_bands(lines, "l_extendedprice")


@query(
    "spec_standardise",
    f"""WITH p AS (SELECT p_partkey % 5 AS k, p_size AS s FROM part),
    u AS (SELECT CASE k WHEN 0 THEN 'Horsepower' WHEN 1 THEN 'Lb Operating Capacity' WHEN 2 THEN 'Unidentified' ELSE 'Inches' END AS unit,
      CASE k WHEN 0 THEN CAST(s AS DOUBLE) WHEN 1 THEN s WHEN 3 THEN s * 12 + s % 12 WHEN 4 THEN 0 END AS low,
      CASE k WHEN 0 THEN CAST(s + 5 AS DOUBLE) WHEN 1 THEN s WHEN 3 THEN s * 12 + s % 12 WHEN 4 THEN 0 END AS high FROM p)
    SELECT unit, count(*) AS n, count(*) FILTER (WHERE low IS NULL) AS n_unparsed,
      {r('count(*) FILTER (WHERE low IS NULL) / CAST(count(*) AS DOUBLE)')} AS unparsed_share, min(low) AS low, max(high) AS high
    FROM u GROUP BY unit""",
)
def spec_standardise(spark, sf):
    kind, size = F.col("p_partkey") % 5, F.col("p_size")
    text = (
        F.when(kind == 0, F.format_string("%d.0 to %d.0 Horsepower", size, size + 5))
        .when(kind == 1, F.format_string("%d.0+ Lb Operating Capacity", size))
        .when(kind == 2, "Unidentified")
        .when(kind == 3, F.format_string("%d' %d\"", size, size % 12))
    )
    return tidy(A.spec_report(B.table(spark, sf, "part").select(text.alias("spec")), "spec"))
