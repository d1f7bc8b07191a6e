"""Second forms of operators: other conventions, tails, quantiles and long inputs
(F1, F13, G37, M1, P20, S4, W2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerplay.functions.formulas import pmt, pmt_sql
from ledgerplay.operators import aggregates as G
from ledgerplay.operators import cashflow as C
from ledgerplay.operators import clean as P
from ledgerplay.operators import stats as M
from ledgerplay.operators import windows as W
from ledgerplay.plans import bindings as B
from ledgerplay.plans.common import ENRICHED_SQL, finish, phi, r6, round_half_away
from ledgerplay.plans.q_abtest import enriched
from ledgerplay.plans.q_eval import EV, ev
from ledgerplay.plans.q_misc import scratch
from ledgerplay.plans.q_payments import BUY_DATE, PAID_MOB_SQL, SEC_SQL, sched
from ledgerplay.plans.registry import register, with_views
from ledgerplay.sources import tables as S

QS = [0.1, 0.25, 0.5, 0.75, 0.9]
PROFILE = ["score", "requested_amount"]


@register("g37_selection_quantiles", with_views("offers", "bureau", extra=EV + """,
sc AS (SELECT 'all' AS scope, * FROM ev UNION ALL SELECT CASE WHEN y = 1 THEN 'selected' ELSE 'rest' END, * FROM ev WHERE y IS NOT NULL)""") + " UNION ALL ".join(
    f"SELECT scope, '{c}' AS \"column\", CAST({q} AS DOUBLE) AS q, {r6(f'quantile_cont({c}, {q})', 4)} AS value FROM sc GROUP BY scope" for c in PROFILE for q in QS))
def g37_selection_quantiles(spark, d):
    e = ev(spark, d).withColumn("y", F.col("y").cast("boolean"))
    return finish(G.selection_quantiles(e, "y", PROFILE, QS), 4)


@register("p20_outlier_share", f"""WITH q AS (SELECT quantile_cont(o_totalprice, 0.75) AS q3, quantile_cont(o_totalprice, 0.25) AS q1 FROM orders),
f AS (SELECT q3 + 0.5 * (q3 - q1) AS fence FROM q)
SELECT {r6('any_value(fence)', 4)} AS fence, count_if(o_totalprice > fence) AS n_above, {r6('count_if(o_totalprice > fence) / count(o_totalprice)')} AS share FROM orders, f""")
def p20_outlier_share(spark, d):
    share = P.outlier_share(S.read_table(spark, d, "orders", ["o_totalprice"]), "o_totalprice", k=0.5)
    return share.select(round_half_away(F.col("fence"), 4).alias("fence"), "n_above", round_half_away(F.col("share")).alias("share"))


def _one_sided(variance: str, tail: str) -> str:
    return with_views("offers", "bureau", extra=ENRICHED_SQL + f""",
a AS (SELECT town, CAST(sum(CAST(offer_accepted AS INTEGER)) AS DOUBLE) AS x, count(*) AS n FROM enriched GROUP BY town),
b AS (SELECT *, x / n AS p_hat FROM a), c AS (SELECT *, CASE WHEN {variance} > 0 THEN (p_hat - 0.3333) / sqrt({variance}) END AS z FROM b)""") + \
        f"SELECT town, x, n, {r6('p_hat')} AS p_hat, {r6('z')} AS z, {r6(tail)} AS p_value FROM c"


@register("m1_prop_ztest_null_variance", _one_sided("0.3333 * (1 - 0.3333) / n", phi("-z")))
def m1_prop_ztest_null_variance(spark, d):
    return finish(M.prop_ztest_1(enriched(spark, d, ["offer_accepted"]), "offer_accepted", 0.3333, "larger", "null", by=["town"]))


@register("m1_prop_ztest_smaller", _one_sided("p_hat * (1 - p_hat) / n", phi("z")))
def m1_prop_ztest_smaller(spark, d):
    return finish(M.prop_ztest_1(enriched(spark, d, ["offer_accepted"]), "offer_accepted", 0.3333, "smaller", by=["town"]))


# the monthly rate that compounds to the yearly one, beside a twelfth of it
EFFECTIVE = "power(CAST(1 AS DOUBLE) + int_rate / 100, CAST(1 AS DOUBLE) / 12) - 1"


@register("f1_pmt_effective_rate", with_views("loans") + f"SELECT loan_id, {r6(pmt_sql(EFFECTIVE, 'term', 'loan_amnt'), 4)} AS monthly_pmt FROM loans")
def f1_pmt_effective_rate(spark, d):
    return finish(B.loans(spark, d).select("loan_id", pmt(EFFECTIVE, "term", "loan_amnt").alias("monthly_pmt")), 4)


@register("f13_later_payments", with_views("loans", "payments", extra=SEC_SQL + ",\n" + PAID_MOB_SQL) + f"""SELECT purchase_mob, count(*) AS n, {r6('sum(paid)', 2)} AS paid
  FROM pool JOIN paid_mob USING (loan_id) WHERE purchase_mob > 0 AND mob > purchase_mob GROUP BY purchase_mob""")
def f13_later_payments(spark, d):
    paid = B.payments(spark, d).groupBy("loan_id", "mob").agg(F.sum("paid").alias("paid"))
    _, later = C.mock_secondary(sched(spark, d), paid, BUY_DATE)
    return finish(later.groupBy("purchase_mob").agg(F.count(F.lit(1)).alias("n"), F.sum("paid").alias("paid")), 2)


@register("w2_uncumulate_long", with_views("payments", extra=PAID_MOB_SQL) + f"SELECT loan_id, mob, {r6('paid', 4)} AS paid FROM paid_mob")
def w2_uncumulate_long(spark, d):
    from pyspark.sql import Window
    paid = B.payments(spark, d).groupBy("loan_id", "mob").agg(F.sum("paid").alias("p"))
    w = Window.partitionBy("loan_id").orderBy("mob").rowsBetween(Window.unboundedPreceding, 0)
    total = paid.withColumn("agg_paid", F.sum("p").over(w)).drop("p")
    return finish(W.uncumulate_long(total, "loan_id", "mob", "agg_paid").drop("agg_paid"), 4)


@register("s4_read_csv", f"SELECT o_orderkey, {r6('o_totalprice', 2)} AS o_totalprice, o_orderpriority FROM orders")
def s4_read_csv(spark, d):
    path = scratch(spark, "orders-csv")
    S.write_table(S.read_table(spark, d, "orders", ["o_orderkey", "o_totalprice", "o_orderpriority"]), path, fmt="csv")
    return finish(S.read_csv(spark, path, "o_orderkey long, o_totalprice double, o_orderpriority string"), 2)
