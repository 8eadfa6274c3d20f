"""Linear models on moments, with SQL that solves the same systems by elimination."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailypanel.fixed import REGRESSION_GRIDS
from dailypanel.operators import evaluate as V
from dailypanel.plans import linear as N
from dailypanel.plans import models as M
from dailypanel.queries import sql as S
from dailypanel.queries.models import FEATURES, SHARES, scaled_rows
from dailypanel.queries.registry import query, r, tidy
from dailypanel.queries.splits import DAY_TEXT, fraction, hashed, scaled_sql

K = len(FEATURES)
ALPHAS = REGRESSION_GRIDS["ridge"]["alpha"]
_SCALED = ", ".join(scaled_sql([c], "standard", show=lambda e, c=c: f"coalesce({e}, {c})") for c in FEATURES)

#: id, split, fold, target and the scaled features of the rows that a fit can use.
ROWS = f"""
cut AS (SELECT *, {hashed(DAY_TEXT, '0.1', '0.1')} AS split FROM ready),
sc AS (SELECT entity, date, split, target, {_SCALED} FROM cut),
f AS MATERIALIZED (SELECT row_number() OVER (ORDER BY entity, date) AS id, entity, date, split, floor({fraction("'fold_' || " + DAY_TEXT)} * 3)::INT AS fold, target, {", ".join(FEATURES)}
  FROM sc WHERE target IS NOT NULL AND {" AND ".join(f"{c} IS NOT NULL" for c in FEATURES)})"""


def eliminated(first: str, size: int) -> str:
    """Tables g1 to g<size> that bring the systems (s, i, j, v) of ``first`` to the unit matrix, the solution being column ``size``."""
    steps, before = [], first
    for p in range(size):
        steps.append(f"""g{p + 1} AS MATERIALIZED (
  SELECT g.s, g.i, g.j, CASE WHEN g.i = {p} THEN g.v / d.v ELSE g.v - c.v * o.v / d.v END AS v FROM {before} g
  JOIN {before} d ON d.s = g.s AND d.i = {p} AND d.j = {p} JOIN {before} c ON c.s = g.s AND c.i = g.i AND c.j = {p} JOIN {before} o ON o.s = g.s AND o.i = {p} AND o.j = g.j)""")
        before = f"g{p + 1}"
    return ",\n".join(steps)


#: Ridge fits w, b (t: the fold left out, 3 for none; k: the place of the penalty) on the training part, and the scores of all trials.
RIDGE = f"""{ROWS},
long AS MATERIALIZED (SELECT id, split, fold, unnest([{", ".join(FEATURES)}, target])::DOUBLE AS v, unnest(range({K + 1})) AS i FROM f),
sets AS (SELECT unnest(range(4)) AS t),
means AS MATERIALIZED (SELECT t, i, avg(v) AS m FROM long, sets WHERE split = 'train' AND fold <> t GROUP BY t, i),
near AS (SELECT t, id, l.i, v - m AS v FROM long l JOIN means USING (i) WHERE split = 'train' AND fold <> t),
products AS (SELECT a.t, a.i, b.i AS j, sum(a.v * b.v) AS v FROM near a JOIN near b ON a.t = b.t AND a.id = b.id WHERE a.i < {K} GROUP BY ALL),
alphas AS (SELECT unnest([{", ".join(f"{a}::DOUBLE" for a in ALPHAS)}]) AS alpha, unnest(range({len(ALPHAS)})) AS k),
systems AS MATERIALIZED (SELECT t * 100 + k AS s, i, j, v + CASE WHEN i = j THEN alpha ELSE 0 END AS v FROM products, alphas),
{eliminated("systems", K)},
w AS MATERIALIZED (SELECT s // 100 AS t, s % 100 AS k, i, v FROM g{K} WHERE j = {K}),
b AS (SELECT w.t, w.k, any_value(y.m) - sum(w.v * x.m) AS b FROM w JOIN means x ON x.t = w.t AND x.i = w.i JOIN means y ON y.t = w.t AND y.i = {K} GROUP BY w.t, w.k),
said AS (SELECT t, k, l.id, sum(w.v * l.v) + any_value(b.b) AS predicted FROM long l JOIN w USING (i) JOIN b USING (t, k)
  WHERE t = 3 OR (fold = t AND split = 'train') GROUP BY t, k, l.id),
told AS MATERIALIZED (SELECT said.*, f.split, f.target AS actual FROM said JOIN f USING (id)),
trials AS (SELECT k, avg(r2) AS score FROM (
  SELECT t, k, 1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*)) AS r2 FROM told WHERE t < 3 GROUP BY t, k) GROUP BY k)"""


def folded(spark, sf):
    return M.assembled(M.with_folds(scaled_rows(spark, sf)), FEATURES, "target")


@query("ridge_grid", f"{S.upto('ready', RIDGE)} SELECT k::INT AS trial, {r('alpha')} AS alpha, 'r2' AS metric, {r('score')} AS score FROM trials JOIN alphas USING (k)")
def ridge_grid(spark, sf):
    """The whole penalty grid of the ridge by cross-validation on the training part."""
    return tidy(N.search_linear("ridge", folded(spark, sf).filter("split = 'train'"), REGRESSION_GRIDS["ridge"]).trials)


@query(
    "tuned_ridge",
    f"""{S.upto('ready', RIDGE)}, best AS (SELECT k FROM trials ORDER BY score DESC, k LIMIT 1),
    c AS (SELECT *, avg(actual) OVER (PARTITION BY split) AS centre FROM told WHERE t = 3 AND k = (SELECT k FROM best))
    SELECT split, count(*) AS n, {r('1 - sum((actual - predicted) ** 2) / nullif(sum((actual - centre) ** 2), 0)')} AS r2, {r('avg(abs(actual - predicted))')} AS mae,
      {r('avg((actual - predicted) ** 2)')} AS mse, {r('sqrt(avg((actual - predicted) ** 2))')} AS rmse FROM c GROUP BY split""",
)
def tuned_ridge(spark, sf):
    """Penalty chosen by cross-validation on the training part, metrics of all parts."""
    rows = folded(spark, sf)
    model = M.tuned_model("ridge", rows.filter("split = 'train'"), grid=None)
    return tidy(V.regression_metrics(M.predicted(model, rows), ["split"]))


@query("lasso_grid")
def lasso_grid(spark, sf):
    """Every trial of the lasso's and the elastic net's grids, from the same moments."""
    rows = folded(spark, sf).filter("split = 'train'")
    found = [N.search_linear(name, rows, REGRESSION_GRIDS[name]).trials.withColumn("model", F.lit(name)) for name in ("lasso", "elastic_net")]
    return tidy(V.concat(found))


X = "mood_mean_daily"


@query(
    "learning_curve_line",
    f"""{S.upto('ready', ROWS)},
    p AS MATERIALIZED (SELECT {X}::DOUBLE AS x, target::DOUBLE AS y, fold, {fraction(DAY_TEXT)} AS place FROM f),
    s AS (SELECT share, hold FROM (SELECT unnest([{", ".join(f"{s!r}::DOUBLE" for s in SHARES)}]) AS share), (SELECT unnest(range(3)) AS hold)),
    m AS (SELECT share, hold, count(x) AS n, avg(x) AS mx, avg(y) AS my, coalesce(covar_pop(y, x) / nullif(var_pop(x), 0), 0) AS w FROM s LEFT JOIN p ON fold <> hold AND place < share GROUP BY ALL),
    e AS (SELECT m.share, m.hold, side, CASE WHEN any_value(m.n) > 0 THEN count(x) ELSE 0 END AS n,
        CASE WHEN any_value(m.n) > 0 THEN sqrt(avg((y - my - w * (x - mx)) ** 2)) END AS rmse
      FROM m, (SELECT unnest(['train', 'test']) AS side) LEFT JOIN p ON CASE WHEN side = 'train' THEN fold <> hold AND place < share ELSE fold = hold END GROUP BY m.share, m.hold, side)
    SELECT {r('share')} AS share, side, {r('avg(n)')} AS mean_rows, {r('avg(rmse)')} AS rmse_mean, {r('stddev_pop(rmse)')} AS rmse_std FROM e GROUP BY share, side""",
)
def learning_curve_line(spark, sf):
    """The learning curve of one feature, for which SQL has a closed form."""
    rows = M.assembled(M.with_folds(scaled_rows(spark, sf)).na.drop(subset=FEATURES), [X], "target")
    return tidy(M.learning_curve(rows, M.linear_regression(), SHARES))
