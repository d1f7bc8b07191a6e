"""Fitted models.  Least squares, lasso, logistic and per-bin fits are checked by SQL that finds the
same estimates by another route (Cramer's rule, recursive steps); trees, clusters and mixtures of the
machine-learning library have none."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerplay.functions.formulas import hash31_sql, unit_hash, unit_hash_sql
from ledgerplay.operators import linear as L
from ledgerplay.operators import models as ML
from ledgerplay.operators import stats as M
from ledgerplay.plans.common import ENRICHED_SQL, finish, p2_sql, r6
from ledgerplay.plans.q_clean import houses
from ledgerplay.plans.q_eval import ev
from ledgerplay.plans.registry import register, with_views
from ledgerplay.session import checkpoint_dir

HX = ["GrLivArea", "MoSold"]


def _split(df, key):
    return df.where(unit_hash(key) < 0.75), df.where(~(unit_hash(key) < 0.75))


def _ev(spark, d):
    return ev(spark, d).where(F.col("score").isNotNull()).withColumn("w", F.lit(1.0) + 4.0 * F.col("y"))


XS = ["score", "requested_amount"]
EV_SQL = ENRICHED_SQL + f""",
ev AS (SELECT offer_key, CAST(offer_accepted AS INTEGER) AS y, credit_score AS score, requested_amount, CAST(1.0 + 4.0 * CAST(offer_accepted AS INTEGER) AS DOUBLE) AS w, segment
  FROM enriched WHERE credit_score IS NOT NULL),
tr AS (SELECT * FROM ev WHERE {unit_hash_sql('offer_key')} < 0.75),
te AS (SELECT * FROM ev WHERE NOT ({unit_hash_sql('offer_key')} < 0.75))"""
HOUSE_TRAIN = f"""tr AS (SELECT * FROM houses WHERE {unit_hash_sql('"Id"')} < 0.75)"""


def _det(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    terms = [f"{'+' if j % 2 == 0 else '-'} {m[0][j]} * ({_det([row[:j] + row[j + 1:] for row in m[1:]])})" for j in range(len(m))]
    return " ".join(terms)


def irls_sql(name: str, xs: list[str], weight: str = "1.0", steps: int = 30) -> str:
    """CTEs ``{name}`` (k, b0, b1, ...): Newton steps by Cramer's rule on the standardised columns."""
    p, z = len(xs) + 1, ["1.0", *[f"z{i}" for i in range(1, len(xs) + 1)]]
    scaled = ", ".join(f"({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER () AS z{i + 1}" for i, x in enumerate(xs))
    eta = " + ".join(f"b{i} * {c}" for i, c in enumerate(z))
    sums = ", ".join([f"sum(w * (y - mu) * {c}) AS g{i}" for i, c in enumerate(z)] + [f"sum(w * mu * (1 - mu) * {z[i]} * {z[j]}) AS h{i}{j}" for i in range(p) for j in range(i, p)])
    h = [[f"h{min(i, j)}{max(i, j)}" for j in range(p)] for i in range(p)]
    move = [f"({_det([[f'g{r}' if c == i else h[r][c] for c in range(p)] for r in range(p)])}) / ({_det(h)})" for i in range(p)]
    b = ", ".join(f"b{i}" for i in range(p))
    return f"""{name}_z AS (SELECT {scaled}, y, CAST({weight} AS DOUBLE) AS w FROM tr),
{name} AS (SELECT 0 AS k, {', '.join(f'CAST(0 AS DOUBLE) AS b{i}' for i in range(p))} UNION ALL
  SELECT k + 1, {', '.join(f'b{i} + {m}' for i, m in enumerate(move))} FROM (
    SELECT k, {b}, {sums} FROM (SELECT *, 1.0 / (1.0 + exp(-({eta}))) AS mu FROM {name}, {name}_z WHERE k < {steps}) GROUP BY k, {b}))"""


HOUSE_TEST = f"""te AS (SELECT * FROM houses WHERE NOT ({unit_hash_sql('"Id"')} < 0.75))"""


def two_regressors_sql(rel: str) -> str:
    """CTEs ``m``, ``b``, ``e``: least squares of SalePrice on two columns by centred moments."""
    return f"""m AS (SELECT count(*) AS n, avg("SalePrice") AS my, avg("GrLivArea") AS m1, avg("MoSold") AS m2, covar_pop("GrLivArea", "GrLivArea") AS s11, covar_pop("MoSold", "MoSold") AS s22,
  covar_pop("GrLivArea", "MoSold") AS s12, covar_pop("SalePrice", "GrLivArea") AS c1, covar_pop("SalePrice", "MoSold") AS c2, covar_pop("SalePrice", "SalePrice") AS cy FROM {rel} WHERE "GrLivArea" IS NOT NULL AND "SalePrice" IS NOT NULL),
b AS (SELECT *, s11 * s22 - s12 * s12 AS det, (c1 * s22 - c2 * s12) / (s11 * s22 - s12 * s12) AS b1, (c2 * s11 - c1 * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m),
e AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, (cy - b1 * c1 - b2 * c2) * n / (n - 3) AS s2, 1 - (cy - b1 * c1 - b2 * c2) / cy AS r2 FROM b)"""


TERMS_SQL = """t AS (SELECT n, r2, unnest(['intercept', 'GrLivArea', 'MoSold']) AS term, unnest([b0, b1, b2]) AS coef,
  unnest([sqrt(s2 / n * (1 + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det)), sqrt(s2 / n * s22 / det), sqrt(s2 / n * s11 / det)]) AS se FROM e)"""
HOUSE_FIT_SQL = with_views("houses", extra=",\n".join([HOUSE_TRAIN, HOUSE_TEST, two_regressors_sql("tr")])) + \
    f"""SELECT "Id", {r6('b0 + b1 * "GrLivArea" + b2 * "MoSold"', 4)} AS prediction FROM te, e WHERE "GrLivArea" IS NOT NULL"""


def _poly2_sql() -> str:
    """Least squares on the five terms of degree 1 and 2 of two standardised columns (the same space of
    predictions), by Cramer's rule on centred moments."""
    k = range(1, 6)
    cov = [[f"s{min(i, j)}{max(i, j)}" for j in k] for i in k]
    terms = "z1 AS f1, z2 AS f2, z1 * z1 AS f3, z1 * z2 AS f4, z2 * z2 AS f5"
    sums = ", ".join([*[f"avg(f{i}) AS m{i}, covar_pop(y, f{i}) AS c{i}" for i in k], *[f"covar_pop(f{i}, f{j}) AS s{i}{j}" for i in k for j in k if i <= j]])
    solved = ", ".join(f"({_det([[f'c{r + 1}' if c == i else cov[r][c] for c in range(5)] for r in range(5)])}) / ({_det(cov)}) AS b{i + 1}" for i in range(5))
    z = '("GrLivArea" - a1) / d1 AS z1, ("MoSold" - a2) / d2 AS z2'
    extra = f"""q AS (SELECT avg("GrLivArea") AS a1, stddev_samp("GrLivArea") AS d1, avg("MoSold") AS a2, stddev_samp("MoSold") AS d2 FROM tr),
f AS (SELECT y, {terms} FROM (SELECT "SalePrice" AS y, {z} FROM tr, q WHERE "GrLivArea" IS NOT NULL AND "SalePrice" IS NOT NULL)),
mm AS (SELECT avg(y) AS my, {sums} FROM f),
bb AS (SELECT *, {solved} FROM mm),
g AS (SELECT "Id", {terms} FROM (SELECT "Id", {z} FROM te, q WHERE "GrLivArea" IS NOT NULL))"""
    return with_views("houses", extra=",\n".join([HOUSE_TRAIN, HOUSE_TEST, extra])) + \
        f"""SELECT "Id", {r6('my + ' + ' + '.join(f'b{i} * (f{i} - m{i})' for i in k), 4)} AS prediction FROM g, bb"""


SCALES_SQL = "st AS (SELECT avg(score) AS m1, stddev_samp(score) AS d1, avg(requested_amount) AS m2, stddev_samp(requested_amount) AS d2 FROM tr)"
P1_SQL = "1 / (1 + exp(-(b0 + b1 * (score - m1) / d1 + b2 * (requested_amount - m2) / d2)))"


def _lasso_sql(form: str, alpha: float) -> str:
    """Coordinate descent step by step on the moments of the two columns (recursive)."""
    scale = ("stddev_samp(\"GrLivArea\")", "stddev_samp(\"MoSold\")") if form == "standardized" else ("1.0", "1.0")
    soft = lambda r, a: f"sign({r}) * greatest(abs({r}) - {alpha}, 0) / {a}"
    return f"""m_{form} AS (SELECT avg("SalePrice") AS my, avg("GrLivArea") AS m1, avg("MoSold") AS m2, {scale[0]} AS d1, {scale[1]} AS d2,
  var_pop("GrLivArea") / pow({scale[0]}, 2) AS s11, var_pop("MoSold") / pow({scale[1]}, 2) AS s22, covar_pop("GrLivArea", "MoSold") / ({scale[0]} * {scale[1]}) AS s12,
  covar_pop("SalePrice", "GrLivArea") / {scale[0]} AS c1, covar_pop("SalePrice", "MoSold") / {scale[1]} AS c2 FROM tr),
l_{form} AS (SELECT 0 AS k, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2 UNION ALL
  SELECT k + 1, n1, {soft('(c2 - s12 * n1)', 's22')} FROM (SELECT *, {soft('(c1 - s12 * b2)', 's11')} AS n1 FROM l_{form}, m_{form} WHERE k < 200)),
r_{form} AS (SELECT *, c1 - s11 * b1 - s12 * b2 AS g1, c2 - s12 * b1 - s22 * b2 AS g2 FROM l_{form}, m_{form} WHERE k = 200),
o_{form} AS (SELECT '{form}' AS form, unnest(['intercept', 'GrLivArea', 'MoSold']) AS term,
  unnest([my{'' if form == 'standardized' else ' - b1 * m1 - b2 * m2'}, b1, b2]) AS coef, unnest([0.0, g1, g2]) AS gradient FROM r_{form})"""


@register("ml_m14_linear_regression", HOUSE_FIT_SQL)
def ml_m14_linear_regression(spark, d):
    tr, te = _split(houses(spark, d), "Id")
    return finish(ML.linear_regression(tr, "SalePrice", HX).transform(te).select("Id", "prediction"), 4)


@register("ml_m15_poly2", _poly2_sql())
def ml_m15_poly2(spark, d):
    tr, te = _split(houses(spark, d), "Id")
    return finish(ML.poly2_regression(tr, "SalePrice", HX).transform(te).select("Id", "prediction"), 4)


@register("ml_m16_lasso", with_views("houses", recursive=True, extra=HOUSE_TRAIN + ",\n" + _lasso_sql("standardized", 1.0)) +
          f"SELECT term AS feature, {r6('coef', 4)} AS coef, {r6('abs(coef)', 4)} AS abs_coef FROM o_standardized WHERE term <> 'intercept'")
def ml_m16_lasso(spark, d):
    tr, _ = _split(houses(spark, d), "Id")
    return finish(ML.coefficients(ML.lasso(tr, "SalePrice", HX, alpha=1.0), HX), 4)


@register("ml_m18_m19_logistic_coefficients", with_views("offers", "bureau", recursive=True, extra=EV_SQL + ",\n" + irls_sql("f", XS, "w")) +
          f"SELECT t AS feature, {r6('c', 4)} AS coef, {r6('abs(c)', 4)} AS abs_coef FROM (SELECT unnest(['score', 'requested_amount']) AS t, unnest([b1, b2]) AS c FROM f WHERE k = 30)")
def ml_m18_m19_logistic_coefficients(spark, d):
    tr, _ = _split(_ev(spark, d), "offer_key")
    return finish(ML.coefficients(ML.logistic(tr, "y", ["score", "requested_amount"], weight="w"), ["score", "requested_amount"]), 4)


@register("ml_m20_predict_proba", with_views("offers", "bureau", recursive=True, extra=EV_SQL + ",\n" + irls_sql("f", XS) + ",\n" + SCALES_SQL) +
          f"SELECT offer_key, {r6('p', 4)} AS p1, CAST(p >= 0.35 AS INTEGER) AS label_hat FROM (SELECT offer_key, {P1_SQL} AS p FROM te, st, f WHERE k = 30)")
def ml_m20_predict_proba(spark, d):
    tr, te = _split(_ev(spark, d), "offer_key")
    m = ML.logistic(tr, "y", ["score", "requested_amount"])
    return finish(ML.predict_proba(m, te, 0.35).select("offer_key", "p1", "label_hat"), 4)


@register("ml_m21_gmm")
def ml_m21_gmm(spark, d):
    return ML.gmm(ev(spark, d), ["score", "requested_amount"]).groupBy("component").agg(F.count(F.lit(1)).alias("n"))


@register("ml_m22_kmeans_same_result")
def ml_m22_kmeans_same_result(spark, d):
    return ML.kmeans_twice_agree(houses(spark, d), ["SalePrice", "GrLivArea"], 4, 11, "Id")


FIRST_AXIS_SQL = with_views("houses", recursive=True, extra="""c AS (SELECT corr("SalePrice", "GrLivArea") AS r12, corr("SalePrice", "MoSold") AS r13, corr("GrLivArea", "MoSold") AS r23 FROM houses),
q AS (SELECT 0 AS k, CAST(1 AS DOUBLE) AS a11, r12 AS a12, r13 AS a13, CAST(1 AS DOUBLE) AS a22, r23 AS a23, CAST(1 AS DOUBLE) AS a33 FROM c UNION ALL
  SELECT k + 1, p11 / l, p12 / l, p13 / l, p22 / l, p23 / l, p33 / l FROM (SELECT *, sqrt(p11 * p11 + p22 * p22 + p33 * p33 + 2 * (p12 * p12 + p13 * p13 + p23 * p23)) AS l FROM (
    SELECT k, a11 * a11 + a12 * a12 + a13 * a13 AS p11, a11 * a12 + a12 * a22 + a13 * a23 AS p12, a11 * a13 + a12 * a23 + a13 * a33 AS p13,
      a12 * a12 + a22 * a22 + a23 * a23 AS p22, a12 * a13 + a22 * a23 + a23 * a33 AS p23, a13 * a13 + a23 * a23 + a33 * a33 AS p33 FROM q WHERE k < 50))),
v AS (SELECT 3 * a11 + 2 * a12 + a13 AS x, 3 * a12 + 2 * a22 + a23 AS y, 3 * a13 + 2 * a23 + a33 AS z FROM q WHERE k = 50),
it AS (SELECT x / sqrt(x * x + y * y + z * z) AS x, y / sqrt(x * x + y * y + z * z) AS y, z / sqrt(x * x + y * y + z * z) AS z FROM v),
s AS (SELECT avg("SalePrice") AS m1, stddev_samp("SalePrice") AS d1, avg("GrLivArea") AS m2, stddev_samp("GrLivArea") AS d2, avg("MoSold") AS m3, stddev_samp("MoSold") AS d3 FROM houses)""") + \
    f"""SELECT "Id", {r6('sign(x) * (x * ("SalePrice" - m1) / d1 + y * ("GrLivArea" - m2) / d2 + z * ("MoSold" - m3) / d3)', 4)} AS pc1 FROM houses, s, it"""


@register("ml_m23_pca_first", FIRST_AXIS_SQL)
def ml_m23_pca_first(spark, d):
    return finish(ML.pca_first(houses(spark, d), ["SalePrice", "GrLivArea", "MoSold"]).select("Id", "pc1"), 4)


def _irr_features(spark, d):
    from ledgerplay.operators import cashflow as C
    from ledgerplay.plans.q_payments import loan_cf, scored
    irr = C.loan_irr(loan_cf(spark, d)).where(F.col("irr").isNotNull())
    return scored(spark, d).join(irr, "loan_id").withColumn("irr_pct", F.col("irr") * 100)


@register("ml_m24_gbt_irr")
def ml_m24_gbt_irr(spark, d):
    tr, te = _split(_irr_features(spark, d), "loan_id")
    _, a, b = ML.gbt_regression(tr, te, "irr_pct", ["loan_amnt", "int_rate", "score"], iters=10)
    return finish(spark.createDataFrame([(i + 1, x, y) for i, (x, y) in enumerate(zip(a, b))], "round int, train_loss double, test_loss double"), 4)


@register("ml_m25_grid_cv")
def ml_m25_grid_cv(spark, d):
    tr, _ = _split(_irr_features(spark, d), "loan_id")
    cv = ML.grid_cv(tr, "irr_pct", ["loan_amnt", "int_rate", "score"], [2, 3], folds=2)
    return finish(spark.createDataFrame([(dp, float(m)) for dp, m in zip([2, 3], cv.avgMetrics)], "max_depth int, rmse double"), 4)


@register("ml_m26_gbt_activation")
def ml_m26_gbt_activation(spark, d):
    tr, te = _split(_ev(spark, d), "offer_key")
    m = ML.gbt_classifier(tr, "y", ["score", "requested_amount"], iters=10)
    return finish(ML.predict_proba(m, te).select("offer_key", "p1"), 4)


IRR_COLS = ["loan_amnt", "int_rate", "score"]


@register("ml_t4_m24_importances")
def ml_t4_m24_importances(spark, d):
    tr, te = _split(_irr_features(spark, d), "loan_id")
    model, _, _ = ML.gbt_regression(tr, te, "irr_pct", IRR_COLS, iters=10)
    return finish(ML.importances(ML.tree_nodes(model), IRR_COLS))


@register("ml_m26_loss_per_round")
def ml_m26_loss_per_round(spark, d):
    tr, te = _split(_ev(spark, d), "offer_key")
    return finish(ML.loss_per_round(ML.gbt_classifier(tr, "y", XS, iters=10), tr, te, "logistic"))


@register("ml_m27_binned_logistic", with_views("offers", "bureau", recursive=True, extra=EV_SQL + """,
d AS (SELECT segment, requested_amount / 100000.0 AS x, CAST(y AS DOUBLE) AS y FROM ev WHERE requested_amount IS NOT NULL AND y IS NOT NULL),
it AS (SELECT segment, 0 AS k, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b FROM d GROUP BY segment UNION ALL
  SELECT segment, k + 1, a + CASE WHEN det <> 0 THEN (h11 * g0 - h01 * g1) / det ELSE 0 END, b + CASE WHEN det <> 0 THEN (h00 * g1 - h01 * g0) / det ELSE 0 END FROM (
    SELECT *, h00 * h11 - h01 * h01 AS det FROM (SELECT segment, k, a, b, sum(y - p) AS g0, sum((y - p) * x) AS g1, sum(p * (1 - p)) AS h00, sum(p * (1 - p) * x) AS h01, sum(p * (1 - p) * x * x) AS h11
      FROM (SELECT segment, k, a, b, x, y, 1 / (1 + exp(-(a + b * x))) AS p FROM it JOIN d USING (segment) WHERE k < 8) GROUP BY segment, k, a, b)))""") +
          f"SELECT segment, {r6('a', 4)} AS a, {r6('b', 4)} AS b FROM it WHERE k = 8")
def ml_m27_binned_logistic(spark, d):
    e = _ev(spark, d).withColumn("x", F.col("requested_amount") / 100000.0)
    return finish(ML.binned_logistic(e, "segment", "x", "y", iters=8), 4)


@register("ml_m28_activation_curve", with_views("offers", "bureau", recursive=True, extra=EV_SQL + ",\n" + irls_sql("f", XS) + ",\n" + SCALES_SQL + """,
g AS (SELECT offer_key, score, unnest([100000.0, 200000.0, 300000.0])::DOUBLE AS requested_amount FROM ev)""") +
          f"SELECT offer_key, {r6('score', 4)} AS score, requested_amount, {r6(P1_SQL, 4)} AS p1 FROM g, st, f WHERE k = 30")
def ml_m28_activation_curve(spark, d):
    tr, _ = _split(_ev(spark, d), "offer_key")
    m = ML.logistic(tr, "y", ["score", "requested_amount"])
    loans = ev(spark, d).where(F.col("score").isNotNull()).select("offer_key", "score", "requested_amount")
    return finish(ML.activation_curve(m, loans, "requested_amount", [100000.0, 200000.0, 300000.0]), 4)


@register("ml_m29_score_table", HOUSE_FIT_SQL)
def ml_m29_score_table(spark, d):
    import os
    import uuid
    tr, te = _split(houses(spark, d), "Id")
    path = os.path.join(checkpoint_dir(spark), "ledgerplay-models", uuid.uuid4().hex)
    ML.linear_regression(tr, "SalePrice", HX).write().overwrite().save(path)
    # column order of the input does not matter: the stored pipeline selects by name
    return finish(ML.score_table(te.select(*reversed(te.columns)), path).select("Id", "prediction"), 4)


@register("ml_m34_learning_curve", with_views("houses", extra=",\n".join([HOUSE_TRAIN, HOUSE_TEST, f"""base AS (SELECT "Id", "SalePrice" AS y, "GrLivArea" AS x, CAST(r.range AS BIGINT) AS rep FROM tr, range(10) r
  WHERE "SalePrice" IS NOT NULL AND "GrLivArea" IS NOT NULL),
rk AS (SELECT *, row_number() OVER (PARTITION BY rep ORDER BY {hash31_sql('"Id"', 'rep')}, "Id") AS pos FROM base),
fit AS (SELECT size, rep, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM rk JOIN (VALUES (20), (50), (100), (200)) s(size) ON pos <= size GROUP BY size, rep),
r AS (SELECT size, rep, 1 - sum(pow("SalePrice" - a - b * "GrLivArea", 2)) / (var_pop("SalePrice") * count(*)) AS r2 FROM fit, te
  WHERE "SalePrice" IS NOT NULL AND "GrLivArea" IS NOT NULL GROUP BY size, rep)"""])) +
          f"SELECT CAST(size AS INTEGER) AS size, {r6('avg(r2)', 4)} AS mean_r2, count(*) AS reps FROM r GROUP BY size")
def ml_m34_learning_curve(spark, d):
    h = houses(spark, d)
    tr, te = _split(h, "Id")
    return finish(ML.learning_curve(tr, "SalePrice", "GrLivArea", "Id", [20, 50, 100, 200], 10, te), 4)


@register("m36_range_holdout", with_views("houses", extra="""f AS (SELECT regr_slope("SalePrice", "GrLivArea") AS b, regr_intercept("SalePrice", "GrLivArea") AS a FROM houses WHERE "GrLivArea" < 25),
t AS (SELECT "SalePrice" AS y, a + b * "GrLivArea" AS yhat FROM houses, f WHERE "GrLivArea" >= 25)""") +
          f"SELECT {r6('1 - sum(pow(y - yhat, 2)) / (sum(y * y) - sum(y) * sum(y) / count(y))', 4)} AS r2, count(y) AS n FROM t")
def m36_range_holdout(spark, d):
    return finish(ML.range_holdout(houses(spark, d), "SalePrice", "GrLivArea", 25.0), 4)


# --- fits with SQL: the same estimates by other routes --------------------------------

@register("m18_m19_leak_check", with_views("offers", "bureau", recursive=True, extra=EV_SQL + ",\n" + irls_sql("f", XS, "w") + ",\n" + irls_sql("ra", ["score"], "w") + ",\n" + irls_sql("rb", ["requested_amount"], "w") + """,
last AS (SELECT * FROM f WHERE k = 30), la AS (SELECT * FROM ra WHERE k = 30), lb AS (SELECT * FROM rb WHERE k = 30),
o AS (SELECT *, abs(b1) > abs(b2) AS first_is_score FROM last)""") + f"""
SELECT 'all' AS model, 'intercept' AS term, {r6('b0')} AS coef, 0 AS rank FROM o
UNION ALL SELECT 'all', 'score', {r6('b1')}, CASE WHEN first_is_score THEN 1 ELSE 2 END FROM o
UNION ALL SELECT 'all', 'requested_amount', {r6('b2')}, CASE WHEN first_is_score THEN 2 ELSE 1 END FROM o
UNION ALL SELECT 'without score', t, {r6('c')}, r FROM (SELECT unnest(['intercept', 'requested_amount']) AS t, unnest([b0, b1]) AS c, unnest([0, 1]) AS r FROM lb), o WHERE first_is_score
UNION ALL SELECT 'without requested_amount', t, {r6('c')}, r FROM (SELECT unnest(['intercept', 'score']) AS t, unnest([b0, b1]) AS c, unnest([0, 1]) AS r FROM la), o WHERE NOT first_is_score""")
def m18_m19_leak_check(spark, d):
    tr, _ = _split(_ev(spark, d), "offer_key")
    return finish(L.leak_check(tr, "y", XS, "w"))


@register("m20_model_agreement", with_views("offers", "bureau", recursive=True, extra=EV_SQL + ",\n" + irls_sql("f", XS) + ",\n" + irls_sql("g", XS, "w") + """,
st AS (SELECT avg(score) AS m1, stddev_samp(score) AS d1, avg(requested_amount) AS m2, stddev_samp(requested_amount) AS d2 FROM tr),
p AS (SELECT 1 / (1 + exp(-(f.b0 + f.b1 * (score - m1) / d1 + f.b2 * (requested_amount - m2) / d2))) AS a,
  1 / (1 + exp(-(g.b0 + g.b1 * (score - m1) / d1 + g.b2 * (requested_amount - m2) / d2))) AS b FROM te, st, f, g WHERE f.k = 30 AND g.k = 30),
r AS (SELECT *, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM p)""") +
          f"SELECT {r6('corr(ra, rb)')} AS spearman, count(*) AS n, count_if((a >= 0.5) <> (b >= 0.5)) AS n_differ FROM r")
def m20_model_agreement(spark, d):
    tr, te = _split(_ev(spark, d), "offer_key")
    plain, weighted = L.logistic(tr, "y", XS), L.logistic(tr, "y", XS, "w")
    return finish(L.agreement(te, L.probability(plain, XS), L.probability(weighted, XS)))


@register("m12_ols_multi", with_views("houses", extra=two_regressors_sql("houses") + ",\n" + TERMS_SQL) +
          f"SELECT term, {r6('coef', 4)} AS coef, {r6('se', 4)} AS se, {r6('coef / se', 4)} AS t, {r6(p2_sql('coef / se'), 4)} AS p, {r6('r2', 4)} AS r2 FROM t")
def m12_ols_multi(spark, d):
    return finish(M.ols(houses(spark, d), "SalePrice", ["GrLivArea", "MoSold"]), 4)


@register("m12_ols_student", with_views("houses", extra=two_regressors_sql("houses") + ",\n" + TERMS_SQL + """,
-- Student's tail in closed form: finite sums over half the degrees of freedom
a AS (SELECT *, coef / se AS t, n - 3 AS v, atan(abs(coef / se) / sqrt(n - 3)) AS th FROM t),
s AS (SELECT *, CASE WHEN v % 2 = 0
  THEN sin(th) * list_sum(list_transform(range(0, v // 2), lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1.0)) / sqrt(pi()) * pow(cos(th), 2 * k)))
  ELSE 2 / pi() * (th + sin(th) * coalesce(list_sum(list_transform(range(0, (v - 1) // 2), lambda k: sqrt(pi()) / 2 * exp(lgamma(k + 1.0) - lgamma(k + 1.5)) * pow(cos(th), 2 * k + 1))), 0)) END AS inside FROM a)""") +
          f"SELECT term, {r6('coef')} AS coef, {r6('se')} AS se, {r6('t')} AS t, {r6('r2')} AS r2, n, {r6('1 - inside')} AS p FROM s")
def m12_ols_student(spark, d):
    return finish(L.least_squares(houses(spark, d), "SalePrice", ["GrLivArea", "MoSold"]))


@register("m16_lasso_forms", with_views("houses", recursive=True, extra=HOUSE_TRAIN + ",\n" + _lasso_sql("standardized", 1.0) + ",\n" + _lasso_sql("raw", 1.0)) +
          f"SELECT form, term, {r6('coef')} AS coef, {r6('gradient')} AS gradient, true AS optimal FROM (SELECT * FROM o_standardized UNION ALL SELECT * FROM o_raw)")
def m16_lasso_forms(spark, d):
    tr, _ = _split(houses(spark, d), "Id")
    forms = [L.lasso(tr, "SalePrice", HX, 1.0, standardized).withColumn("form", F.lit(name)) for name, standardized in (("standardized", True), ("raw", False))]
    return finish(forms[0].unionByName(forms[1]))


@register("m23_first_axis", FIRST_AXIS_SQL)
def m23_first_axis(spark, d):
    return finish(L.principal_first(houses(spark, d), ["SalePrice", "GrLivArea", "MoSold"]).select("Id", "pc1"), 4)
