"""Model evaluation, ranks, distribution comparison and regression in closed form:
W8-W13, W16, W17, M8-M13, M17, M30-M33, M35, G18-G20, G33-G38."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ledgerplay.functions.formulas import norm_ppf, unit_hash, unit_hash_sql
from ledgerplay.operators import aggregates as G
from ledgerplay.operators import features as X
from ledgerplay.operators import stats as M
from ledgerplay.operators import windows as W
from ledgerplay.plans import bindings as B
from ledgerplay.plans.common import ENRICHED_SQL, finish, phi, r6
from ledgerplay.plans.q_abtest import enriched
from ledgerplay.plans.q_clean import TRAIN, houses
from ledgerplay.plans.registry import register, with_views
from ledgerplay.sources.tables import read_table

EV = ENRICHED_SQL + ",\nev AS (SELECT offer_key, id, CAST(offer_accepted AS INTEGER) AS y, credit_score AS score, requested_amount, segment, town, offer_date FROM enriched)"


def ev(spark, d):
    return enriched(spark, d).select("offer_key", "id", F.col("offer_accepted").cast("int").alias("y"),
                                     F.col("credit_score").alias("score"), "requested_amount", "segment", "town", "offer_date")


def cust(spark, d):
    c = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    o = read_table(spark, d, "orders", ["o_custkey", "o_totalprice"]).groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spend"))
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "c_acctbal", "spend")


CUST_SQL = "cust AS (SELECT c_custkey, c_acctbal, spend FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS spend FROM orders GROUP BY 1) o ON c_custkey = o_custkey)"


@register("w8_average_rank", f"""SELECT c_custkey, {r6('rank() OVER (ORDER BY c_acctbal) + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2.0')} AS rank FROM customer""")
def w8_average_rank(spark, d):
    c = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    return finish(W.average_rank(c, "c_acctbal").select("c_custkey", "rank"))


@register("w9_spearman", "WITH " + CUST_SQL + f""", r AS (SELECT rank() OVER (ORDER BY c_acctbal) + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2.0 AS ra,
  rank() OVER (ORDER BY spend) + (count(*) OVER (PARTITION BY spend) - 1) / 2.0 AS rb FROM cust WHERE c_acctbal IS NOT NULL AND spend IS NOT NULL)
SELECT {r6('corr(ra, rb)')} AS spearman FROM r""")
def w9_spearman(spark, d):
    return finish(W.spearman(cust(spark, d), "c_acctbal", "spend"))


ROC_SQL = EV + """,
per AS (SELECT score AS threshold, CAST(sum(y) AS DOUBLE) AS tp, CAST(sum(1 - y) AS DOUBLE) AS fp FROM ev WHERE score IS NOT NULL GROUP BY score),
roc AS (SELECT threshold, sum(tp) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(tp) OVER () AS tpr,
  sum(fp) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(fp) OVER () AS fpr FROM per)"""


@register("w10_roc_curve", with_views("offers", "bureau", extra=ROC_SQL) + f"SELECT {r6('threshold')} AS threshold, {r6('tpr')} AS tpr, {r6('fpr')} AS fpr FROM roc")
def w10_roc_curve(spark, d):
    return finish(W.roc_curve(ev(spark, d), "y", "score"))


@register("w11_auc", with_views("offers", "bureau", extra=EV + """,
per AS (SELECT segment, score AS s, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM ev WHERE score IS NOT NULL GROUP BY segment, score),
c AS (SELECT *, coalesce(sum(pos) OVER (PARTITION BY segment ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM per)""") +
    f"SELECT segment, {r6('sum(neg * (above + pos / 2.0)) / (sum(pos) * sum(neg))')} AS auc FROM c GROUP BY segment")
def w11_auc(spark, d):
    return finish(W.auc(ev(spark, d), "y", "score", ["segment"]))


@register("w12_threshold_at_fpr", with_views("offers", "bureau", extra=EV + """,
per AS (SELECT segment, score AS threshold, CAST(sum(y) AS DOUBLE) AS tp, CAST(sum(1 - y) AS DOUBLE) AS fp FROM ev WHERE score IS NOT NULL GROUP BY 1, 2),
roc AS (SELECT segment, threshold, sum(fp) OVER (PARTITION BY segment ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  / sum(fp) OVER (PARTITION BY segment) AS fpr FROM per)""") + f"SELECT segment, {r6('max(threshold)')} AS threshold FROM roc WHERE fpr > 0.2 GROUP BY segment")
def w12_threshold_at_fpr(spark, d):
    return finish(W.threshold_at_fpr(ev(spark, d), "y", "score", 0.2, ["segment"]))


@register("w13_rolling_mean", with_views("offers", "bureau", extra=EV + """,
c AS (SELECT CAST(floor(score / 500) AS BIGINT) AS x, avg(y) AS rate FROM ev WHERE score IS NOT NULL GROUP BY 1)""") +
    f"SELECT x, {r6('rate')} AS rate, {r6('avg(rate) OVER (ORDER BY x ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)')} AS rate_smooth FROM c")
def w13_rolling_mean(spark, d):
    curve = G.binned_rate(ev(spark, d).where(F.col("score").isNotNull()), F.floor(F.col("score") / 500).cast("long"), "y").drop("n")
    return finish(W.rolling_mean(curve, "x", "rate", 2))


@register("w16_is_monotonic", """SELECT coalesce(bool_and(prev IS NULL OR value >= prev), true) AS monotonic FROM (
  SELECT value, max(value) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM events)""")
def w16_is_monotonic(spark, d):
    e = read_table(spark, d, "events", ["event_id", "ts", "value"]).withColumn("tsd", F.unix_micros(F.col("ts").cast("timestamp")).cast("double"))
    return W.is_monotonic(e, "tsd", "value", tie=["event_id"])


@register("w16_is_monotonic_running_total", """SELECT coalesce(bool_and(prev IS NULL OR v >= prev), true) AS monotonic FROM (
  SELECT v, max(v) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM (
    SELECT event_id, sum(abs(value)) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM events))""")
def w16_is_monotonic_running_total(spark, d):
    from ledgerplay.operators.prefix import prefix_agg
    e = read_table(spark, d, "events", ["event_id", "value"]).withColumn("a", F.abs("value"))
    run = prefix_agg(e, "event_id", ["a"])
    return W.is_monotonic(run, "event_id", "a_cum")


@register("w17_ordinal_encode", with_views("offers") + "SELECT offer_key, occupation, CAST(dense_rank() OVER (ORDER BY occupation) - 1 AS INTEGER) AS occupation_code FROM offers")
def w17_ordinal_encode(spark, d):
    return W.ordinal_encode(B.offers(spark, d).select("offer_key", "occupation"), "occupation")


def _ks_p_sql(d: str, na: str, nb: str) -> str:
    ne = f"(({na}) * ({nb}) / (({na}) + ({nb})))"
    lam = f"((sqrt({ne}) + 0.12 + 0.11 / sqrt({ne})) * {d})"
    series = f"list_sum(list_transform(range(1, 101), lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * {lam} * {lam})))"
    return f"CASE WHEN {d} > 0 THEN least(1.0, greatest(0.0, 2 * {series})) ELSE 1.0 END"


@register("m8_ks_2samp", with_views("offers", extra="""per AS (SELECT requested_amount AS v, CAST(count_if(offer_accepted) AS DOUBLE) AS ca,
  CAST(count_if(NOT offer_accepted) AS DOUBLE) AS cb FROM offers WHERE requested_amount IS NOT NULL GROUP BY 1),
t AS (SELECT sum(ca) AS na, sum(cb) AS nb FROM per),
c AS (SELECT sum(ca) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fa,
  sum(cb) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fb FROM per),
k AS (SELECT max(abs(fa / na - fb / nb)) AS d, na, nb FROM c, t GROUP BY na, nb)""") +
    f"SELECT {r6('d')} AS d, na AS n_a, nb AS n_b, {r6(_ks_p_sql('d', 'na', 'nb'))} AS p_value FROM k")
def m8_ks_2samp(spark, d):
    return finish(M.ks_2samp(B.offers(spark, d), "offer_accepted", "requested_amount", True, False))


QQ = [i / 10 for i in range(11)]


@register("m9_qq_points", with_views("offers") + " UNION ALL ".join(
    f"SELECT CAST({q} AS DOUBLE) AS q, {r6(f'quantile_cont(requested_amount, {q}) FILTER (WHERE offer_accepted)')} AS q_a, "
    f"{r6(f'quantile_cont(requested_amount, {q}) FILTER (WHERE NOT offer_accepted)')} AS q_b FROM offers" for q in QQ))
def m9_qq_points(spark, d):
    return finish(M.qq_points(B.offers(spark, d), "offer_accepted", "requested_amount", True, False, n=11))


QN = 20


@register("m10_qq_normal", " UNION ALL ".join(
    f"SELECT CAST({(i - 0.5) / QN} AS DOUBLE) AS q, {r6(repr(norm_ppf((i - 0.5) / QN)))} AS theoretical, "
    f"{r6(f'quantile_cont(o_totalprice, {(i - 0.5) / QN})')} AS sample FROM orders" for i in range(1, QN + 1)))
def m10_qq_normal(spark, d):
    return finish(M.qq_normal(read_table(spark, d, "orders", ["o_totalprice"]), "o_totalprice", QN))


BK, BN = 20, 100


@register("m11_bootstrap_means", f"""WITH v AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS idx, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL),
n AS (SELECT count(*) AS n FROM v),
dr AS (SELECT r.range // {BN} AS rep, r.range % {BN} AS i FROM range({BK * BN}) r),
dx AS (SELECT rep, {M.draw_index_sql('rep', 'i', 'n')} AS idx FROM dr, n)
SELECT rep, {r6('avg(c_acctbal)')} AS mean FROM dx JOIN v USING (idx) GROUP BY rep""")
def m11_bootstrap_means(spark, d):
    c = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    return finish(M.bootstrap_means(c, "c_acctbal", "c_custkey", BN, BK))


@register("m12_ols_one", with_views("houses", extra="""f AS (SELECT "BldgType", CAST(regr_count("SalePrice", "GrLivArea") AS DOUBLE) AS n,
  regr_slope("SalePrice", "GrLivArea") AS slope, regr_intercept("SalePrice", "GrLivArea") AS intercept, regr_r2("SalePrice", "GrLivArea") AS r2,
  regr_sxx("SalePrice", "GrLivArea") AS sxx, regr_syy("SalePrice", "GrLivArea") AS syy, regr_sxy("SalePrice", "GrLivArea") AS sxy,
  regr_avgx("SalePrice", "GrLivArea") AS xbar FROM houses WHERE "GrLivArea" IS NOT NULL AND "SalePrice" IS NOT NULL GROUP BY 1),
g AS (SELECT *, (syy - sxy * sxy / sxx) / (n - 2) AS s2 FROM f),
h AS (SELECT *, slope / sqrt(s2 / sxx) AS t FROM g)""") + f"""SELECT "BldgType", n, {r6('slope')} AS slope, {r6('intercept')} AS intercept, {r6('r2')} AS r2,
  {r6('sqrt(s2 / sxx)')} AS se_slope, {r6('sqrt(s2 * (1.0 / n + xbar * xbar / sxx))')} AS se_intercept, {r6('t')} AS t_slope,
  {r6(f"2.0 * {phi('-abs(t)')}")} AS p_slope FROM h""")
def m12_ols_one(spark, d):
    r = M.ols_one(houses(spark, d), "SalePrice", "GrLivArea", ["BldgType"])
    return finish(r.select("BldgType", "n", "slope", "intercept", "r2", "se_slope", "se_intercept", "t_slope", "p_slope"))


Z975 = repr(norm_ppf(0.975))


@register("m13_ols_intervals", with_views("houses", extra="""f AS (SELECT "BldgType", CAST(regr_count("SalePrice", "GrLivArea") AS DOUBLE) AS n,
  regr_slope("SalePrice", "GrLivArea") AS slope, regr_intercept("SalePrice", "GrLivArea") AS intercept,
  regr_sxx("SalePrice", "GrLivArea") AS sxx, regr_syy("SalePrice", "GrLivArea") AS syy, regr_sxy("SalePrice", "GrLivArea") AS sxy,
  regr_avgx("SalePrice", "GrLivArea") AS xbar FROM houses WHERE "GrLivArea" IS NOT NULL AND "SalePrice" IS NOT NULL GROUP BY 1),
g AS (SELECT *, (syy - sxy * sxy / sxx) / (n - 2) AS s2 FROM f)""") + f"""SELECT h."Id", {r6('intercept + slope * h."GrLivArea"', 4)} AS fitted,
  {r6(f'intercept + slope * h."GrLivArea" - {Z975} * sqrt(s2 * (1 + 1 / n + pow(h."GrLivArea" - xbar, 2) / sxx))', 4)} AS lower,
  {r6(f'intercept + slope * h."GrLivArea" + {Z975} * sqrt(s2 * (1 + 1 / n + pow(h."GrLivArea" - xbar, 2) / sxx))', 4)} AS upper
  FROM houses h JOIN g USING ("BldgType")""")
def m13_ols_intervals(spark, d):
    r = M.ols_intervals(houses(spark, d), "SalePrice", "GrLivArea", by=["BldgType"])
    return finish(r.select("Id", "fitted", "lower", "upper"), 4)


@register("m17_standardize", with_views("houses", extra=f"""s AS (SELECT avg("SalePrice") AS m, stddev_pop("SalePrice") AS sd FROM houses WHERE {TRAIN})""") +
          f"""SELECT "Id", {r6('("SalePrice" - m) / sd')} AS "SalePrice_z" FROM houses, s""")
def m17_standardize(spark, d):
    h = houses(spark, d)
    return finish(X.standardize(h, h.where(unit_hash("Id") < 0.75), ["SalePrice"]).select("Id", "SalePrice_z"))


def _bldg_types(spark, d):
    return sorted(r[0] for r in houses(spark, d).select("BldgType").distinct().collect() if r[0] is not None)


@register("m30_one_hot", with_views("houses") + """SELECT "Id", """ + ", ".join(
    f"""coalesce(CAST("BldgType" = '{c}' AS INTEGER), 0) AS "BldgType_{c}\"""" for c in ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]) + " FROM houses")
def m30_one_hot(spark, d):
    h = houses(spark, d).select("Id", "BldgType")
    return X.one_hot(h, "BldgType").drop("BldgType")  # one column per category of the data


@register("m31_split_random", with_views("houses") + f"""SELECT "Id", CASE WHEN {TRAIN} THEN 'train' ELSE 'test' END AS "set" FROM houses""")
def m31_split_random(spark, d):
    return X.split_random(houses(spark, d), "Id").select("Id", "set")


@register("m32_split_stratified", with_views("offers", extra=f"""h AS (SELECT offer_key, offer_accepted, {unit_hash_sql('offer_key')} AS hsh FROM offers),
r AS (SELECT *, row_number() OVER (PARTITION BY offer_accepted ORDER BY hsh, offer_key) AS rn, count(*) OVER (PARTITION BY offer_accepted) AS n FROM h)""") +
    """SELECT offer_key, offer_accepted, CASE WHEN rn <= round(n * 0.75) THEN 'train' ELSE 'test' END AS "set" FROM r""")
def m32_split_stratified(spark, d):
    o = B.offers(spark, d).select("offer_key", "offer_accepted")
    return X.split_stratified(o, "offer_accepted", "offer_key").select("offer_key", "offer_accepted", "set")


@register("m33_split_by_date", with_views("offers") + """SELECT offer_key, CASE WHEN offer_date < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'test' END AS "set" FROM offers""")
def m33_split_by_date(spark, d):
    return X.split_by_date(B.offers(spark, d), "offer_date", "1998-01-01").select("offer_key", "set")


@register("m35_periodic_powers", f"""SELECT o_orderkey, {r6(f'pow(fmod(o_totalprice / CAST(100000.0 AS DOUBLE), CAST({2 * math.pi!r} AS DOUBLE)), 1)')} AS p1,
  {r6(f'pow(fmod(o_totalprice / CAST(100000.0 AS DOUBLE), CAST({2 * math.pi!r} AS DOUBLE)), 2)')} AS p2, {r6(f'pow(fmod(o_totalprice / CAST(100000.0 AS DOUBLE), CAST({2 * math.pi!r} AS DOUBLE)), 3)')} AS p3 FROM orders""")
def m35_periodic_powers(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_totalprice"]).withColumn("x", F.col("o_totalprice") / 100000.0)
    return finish(X.periodic_powers(o, "x", 3).select("o_orderkey", "p1", "p2", "p3"))


@register("g19_binned_rate", with_views("offers", "bureau", extra=EV) + f"""SELECT segment, CAST(floor(score / 1000) AS BIGINT) AS x, {r6('avg(CAST(y AS DOUBLE))')} AS rate, count(*) AS n
  FROM ev WHERE score IS NOT NULL GROUP BY 1, 2""")
def g19_binned_rate(spark, d):
    e = ev(spark, d).where(F.col("score").isNotNull())
    return finish(G.binned_rate(e, F.floor(F.col("score") / 1000).cast("long"), "y", ["segment"]))


G20_SQL = EV + """,
e AS (SELECT list_sort(list_distinct(quantile_cont(requested_amount, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS edges FROM ev),
b AS (SELECT ev.*, requested_amount / 500000.0 AS pred, CASE WHEN requested_amount >= edges[1] AND requested_amount <= edges[-1]
  THEN CAST(greatest(len(list_filter(edges, lambda x: x < requested_amount)), 1) AS INTEGER) END AS bin FROM ev, e)"""


@register("g20_binned_scatter", with_views("offers", "bureau", extra=G20_SQL) + f"""SELECT bin, {r6('avg(pred)')} AS mean_pred, {r6('avg(CAST(y AS DOUBLE))')} AS mean_true, count(*) AS n FROM b GROUP BY bin""")
def g20_binned_scatter(spark, d):
    e = W.qcut(ev(spark, d), "requested_amount", 10).withColumn("pred", F.col("requested_amount") / 500000.0)
    return finish(G.binned_scatter(e, "bin", "pred", "y"))


@register("g18_kde_grid", with_views("offers", extra="""g AS (SELECT offer_accepted, requested_amount AS c, CAST(x AS DOUBLE) AS x FROM offers, (VALUES """ +
          ", ".join(f"({float(v)})" for v in range(0, 500001, 50000)) + """) t(x) WHERE requested_amount IS NOT NULL)""") +
    f"SELECT offer_accepted, x, {r6(f'sum(exp(-0.5 * pow((x - c) / 20000.0, 2))) / (count(*) * 20000.0 * {math.sqrt(2 * math.pi)!r})', 12)} AS density FROM g GROUP BY 1, 2")
def g18_kde_grid(spark, d):
    grid = [float(v) for v in range(0, 500001, 50000)]
    return finish(G.kde_grid(B.offers(spark, d), "requested_amount", grid, 20000.0, ["offer_accepted"]), 12)


@register("g33_confusion", with_views("offers", "bureau", extra=EV) + """SELECT y, yhat, count_if(yy = y AND pp = yhat) AS n FROM
  (SELECT y AS yy, CAST(score > 5000 AS INTEGER) AS pp FROM ev), (VALUES (0), (1)) a(y), (VALUES (0), (1)) b(yhat) GROUP BY y, yhat""")
def g33_confusion(spark, d):
    e = ev(spark, d).withColumn("yhat", (F.col("score") > 5000).cast("int"))
    return G.confusion(e, "y", "yhat")


@register("g34_accuracy", with_views("offers", "bureau", extra=EV) + f"""SELECT {r6('sum((1 + 4 * y) * CAST(y = CAST(score > 5000 AS INTEGER) AS DOUBLE)) / sum(1 + 4 * y)')} AS accuracy FROM ev""")
def g34_accuracy(spark, d):
    e = ev(spark, d).withColumn("yhat", (F.col("score") > 5000).cast("int"))
    return finish(G.accuracy(e, "y", "yhat", F.lit(1) + 4 * F.col("y")))


FIT_SQL = f"""fit AS (SELECT regr_slope("SalePrice", "GrLivArea") AS b, regr_intercept("SalePrice", "GrLivArea") AS a, avg("SalePrice") AS m FROM houses WHERE {TRAIN}),
pr AS (SELECT houses.*, a + b * "GrLivArea" AS yhat, m AS ybase FROM houses, fit WHERE NOT ({TRAIN}))"""


def fitted_test(spark, d):
    h = houses(spark, d)
    tr = h.where(unit_hash("Id") < 0.75)
    f = tr.agg(F.regr_slope("SalePrice", "GrLivArea").alias("b"), F.regr_intercept("SalePrice", "GrLivArea").alias("a"),
               F.avg("SalePrice").alias("m")).collect()[0]
    te = h.where(~(unit_hash("Id") < 0.75))
    return te.withColumn("yhat", F.lit(f["a"]) + F.lit(f["b"]) * F.col("GrLivArea")).withColumn("ybase", F.lit(f["m"]))


@register("g35_rmse", with_views("houses", extra=FIT_SQL) + f"""SELECT {r6('sqrt(avg(pow("SalePrice" - yhat, 2)))', 4)} AS rmse,
  {r6('sqrt(avg(pow("SalePrice" - ybase, 2)))', 4)} AS rmse_baseline FROM pr""")
def g35_rmse(spark, d):
    t = fitted_test(spark, d)
    a = G.rmse(t, "SalePrice", "yhat").collect()[0][0]
    b = G.rmse(t, "SalePrice", "ybase").collect()[0][0]
    return finish(spark.createDataFrame([(a, b)], "rmse double, rmse_baseline double"), 4)


@register("g36_r2", with_views("houses", extra=FIT_SQL) + f"""SELECT "BldgType", {r6('1 - sum(pow("SalePrice" - yhat, 2)) / (sum("SalePrice" * "SalePrice") - sum("SalePrice") * sum("SalePrice") / count("SalePrice"))', 4)} AS r2,
  count("SalePrice") AS n FROM pr GROUP BY 1""")
def g36_r2(spark, d):
    return finish(G.r2(fitted_test(spark, d), "SalePrice", "yhat", ["BldgType"]), 4)


@register("g37_selection_profile", with_views("offers", "bureau", extra=EV) + f"""SELECT CAST(y AS BOOLEAN) AS selected, {r6('avg(score)')} AS mean_score,
  {r6('avg(requested_amount)')} AS mean_requested_amount, count(*) AS n FROM ev GROUP BY ROLLUP (CAST(y AS BOOLEAN))""")
def g37_selection_profile(spark, d):
    e = ev(spark, d).withColumn("y", F.col("y").cast("boolean"))
    return finish(G.selection_profile(e, "y", ["score", "requested_amount"]))


@register("g38_bias_check", with_views("offers", "bureau", extra=ENRICHED_SQL) + f"""SELECT
  {r6('(SELECT avg(CAST(offer_accepted AS DOUBLE)) FROM offers)')} AS rate_before, (SELECT count(*) FROM offers) AS n_before,
  {r6('(SELECT avg(CAST(offer_accepted AS DOUBLE)) FROM enriched)')} AS rate_after, (SELECT count(*) FROM enriched) AS n_after""")
def g38_bias_check(spark, d):
    return finish(G.bias_check(B.offers(spark, d), enriched(spark, d), "offer_accepted"))
