"""Model families where SQL can say what the fit has to be: one feature, closed forms, group means, class frequencies."""

from __future__ import annotations

from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from dailypanel.plans import models as M
from dailypanel.plans.boosting import SoftmaxBoosting
from dailypanel.queries import sql as S
from dailypanel.queries.panels import ready
from dailypanel.queries.registry import query, r, tidy

X = "mood_mean_daily"
PAIRS = f"p AS (SELECT {X}::DOUBLE AS x, target::DOUBLE AS y FROM ready WHERE {X} IS NOT NULL AND target IS NOT NULL)"
MOMENTS = "m AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(y, x) AS c FROM p)"
UP = f"change_{X}"
GROUPS = f"p AS (SELECT ({UP} > 0)::INT AS up, target::DOUBLE AS y, (target > {X})::INT AS rises FROM ready WHERE {UP} IS NOT NULL AND target IS NOT NULL AND {X} IS NOT NULL)"


def _line(name: str, slope: str, build):
    @query(name, f"""{S.upto('ready', PAIRS)}, {MOMENTS}, s AS (SELECT *, {slope} AS slope FROM m)
    SELECT n, {r('slope', 5)} AS slope, {r('my - slope * mx', 5)} AS intercept FROM s""")
    def run(spark, sf):
        rows = M.assembled(ready(spark, sf).select("entity", "date", X, "target"), [X], "target")
        model = build(rows)
        return tidy(rows.groupBy().agg(F.count("*").alias("n")).select("n", F.lit(float(model.coefficients[0])).alias("slope"), F.lit(float(model.intercept)).alias("intercept")), 5)

    return run


_line("linear_closed_form", "c / vx", lambda rows: M.linear_regression().fit(rows))
_line("ridge_closed_form", "c * n / (vx * n + 25.0)", lambda rows: M.ridge(rows, 25.0).fit(rows))
_line("elastic_net_closed_form", "sign(c) * greatest(abs(c) - 0.5 * 0.4, 0) / (vx + 0.5 * 0.6)", lambda rows: M.elastic_net(rows, 0.5, 0.4).fit(rows))


def two_groups(spark, sf):
    """Days after a rise of the mean and other days; whether the next day rises."""
    df = ready(spark, sf).filter(f"{UP} IS NOT NULL AND target IS NOT NULL AND {X} IS NOT NULL")
    return df.select("entity", "date", F.expr(f"CAST({UP} > 0 AS INT)").alias("up"), "target", F.expr(f"CAST(target > {X} AS INT)").alias("rises"))


def _means(name: str, build):
    @query(name, f"{S.upto('ready', GROUPS)} SELECT up, count(*) AS n, {r('avg(y)')} AS predicted FROM p GROUP BY up")
    def run(spark, sf):
        rows = M.assembled(two_groups(spark, sf), ["up"], "target")
        scored = build().fit(rows).transform(rows).withColumn("up", vector_to_array("features")[0].cast("int"))
        return tidy(scored.groupBy("up").agg(F.count("*").alias("n"), F.avg("prediction").alias("predicted")))

    return run


_means("tree_group_means", lambda: R.DecisionTreeRegressor(maxDepth=1, seed=M.SEED))
_means("forest_group_means", lambda: R.RandomForestRegressor(numTrees=3, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", seed=M.SEED))
_means("boosted_group_means", lambda: R.GBTRegressor(maxIter=1, maxDepth=1, seed=M.SEED))


@query("logistic_frequencies", f"{S.upto('ready', GROUPS)} SELECT up, count(*) AS n, {r('avg(rises)', 4)} AS chance FROM p GROUP BY up")
def logistic_frequencies(spark, sf):
    """On a feature of two values the fitted chance is the share of the class."""
    rows = M.assembled(two_groups(spark, sf), ["up"], "rises")
    scored = C.LogisticRegression(maxIter=200, tol=1e-12).fit(rows).transform(rows)
    scored = scored.select(vector_to_array("features")[0].cast("int").alias("up"), vector_to_array("probability")[1].alias("chance"))
    return tidy(scored.groupBy("up").agg(F.count("*").alias("n"), F.avg("chance").alias("chance")), 4)


@query("svc_separable", f"{S.upto('ready', GROUPS)} SELECT up, up::DOUBLE AS predicted, count(*) AS n FROM p GROUP BY up")
def svc_separable(spark, sf):
    """Classes that one feature separates are all told apart."""
    rows = M.assembled(two_groups(spark, sf).withColumn("same", F.col("up")), ["up"], "same")
    scored = C.LinearSVC(maxIter=100, regParam=0.0).fit(rows).transform(rows)
    return tidy(scored.select(F.col("label").cast("int").alias("up"), F.col("prediction").alias("predicted")).groupBy("up", "predicted").agg(F.count("*").alias("n")))


@query("class_weights", f"""{S.upto('ready', 'c AS (SELECT categorical_target::DOUBLE AS class, count(*) AS n FROM ready WHERE categorical_target IS NOT NULL GROUP BY 1)')}
    SELECT class, n, {r('(SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n::DOUBLE)')} AS weight FROM c""")
def class_weights(spark, sf):
    return tidy(M.class_weights(ready(spark, sf), "categorical_target").withColumnRenamed("categorical_target", "class"))


@query(
    "boosted_classes",
    f"""{S.upto('ready', f"p AS (SELECT ({UP} > 0)::INT AS up, categorical_target::INT + 1 AS c FROM ready WHERE {UP} IS NOT NULL AND categorical_target IS NOT NULL)")},
    cells AS (SELECT up, c, count(p.c) AS n FROM (SELECT DISTINCT up FROM p) CROSS JOIN (SELECT DISTINCT c FROM p) LEFT JOIN p USING (up, c) GROUP BY ALL),
    sized AS (SELECT *, sum(n) OVER (PARTITION BY up) AS of_up, sum(n) OVER (PARTITION BY c) / (SELECT count(*) FROM p)::DOUBLE AS prior, (SELECT count(DISTINCT c) FROM p) AS k FROM cells),
    e AS (SELECT *, prior * exp((k - 1) / k::DOUBLE * (n - of_up * prior) / (of_up * prior * (1 - prior))) AS e FROM sized)
    SELECT up, c AS class, of_up::BIGINT AS n, {r('e / sum(e) OVER (PARTITION BY up)')} AS chance FROM e""",
)
def boosted_classes(spark, sf):
    """One round of one split: the start is the classes' shares, and a leaf moves them by one Newton step."""
    df = ready(spark, sf).filter(f"{UP} IS NOT NULL AND categorical_target IS NOT NULL")
    df = M.class_labels(df.select("entity", "date", F.expr(f"CAST({UP} > 0 AS INT)").alias("up"), "categorical_target"))
    rows = M.assembled(df, ["up"], "class_label")
    scored = SoftmaxBoosting(rounds=1, depth=1, step=1.0).fit(rows).transform(rows)
    scored = scored.select(vector_to_array("features")[0].cast("int").alias("up"), F.posexplode("probability").alias("class", "chance"))
    return tidy(scored.groupBy("up", "class").agg(F.count("*").alias("n"), F.avg("chance").alias("chance")))
