"""Payments, late counts, IRR and portfolio curves: W2, W5, W6, J13,
G21-G23, M7, F1-F8, F13-F16."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerplay.functions.formulas import pmt, pmt_sql
from ledgerplay.operators import aggregates as G
from ledgerplay.operators import cashflow as C
from ledgerplay.operators import joins as J
from ledgerplay.operators import windows as W
from ledgerplay.plans import bindings as B
from ledgerplay.plans.common import finish, phi, r6
from ledgerplay.plans.registry import register, with_views
from ledgerplay.sources.tables import read_table

TERM = B.TERM_MONTHS
MOBS = list(range(1, TERM + 1))
BUY_DATE = "1998-01-01"
DISCOUNTS = [0.0, 0.02, 0.03]


def irr_sql(src: str, keys: list[str], out: str = "irr_out") -> str:
    """CTEs computing a monthly IRR per key from ``src(keys..., period, cf)``.

    Same algorithm as the engine: bisection on the bracket, no inflow -> -1,
    no sign change -> NULL.
    """
    k = ", ".join(keys)
    npv = lambda r: f"list_sum(list_transform(l, lambda s: s.c / pow(1.0 + {r}, s.p)))"
    return f"""packed_{out} AS (SELECT {k}, list({{'p': CAST(period AS DOUBLE), 'c': cf}} ORDER BY period) AS l,
  sum(CASE WHEN period > 0 THEN cf ELSE 0 END) AS inflow FROM {src} GROUP BY {k}),
bis_{out} AS (SELECT {k}, l, inflow, 0 AS step, CAST({C.IRR_LO} AS DOUBLE) AS lo, CAST({C.IRR_HI} AS DOUBLE) AS hi,
    {npv(C.IRR_LO)} AS f_lo, {npv(C.IRR_HI)} AS f_hi FROM packed_{out}
  UNION ALL
  SELECT {k}, l, inflow, step + 1,
    CASE WHEN {npv('(lo + hi) / 2')} > 0 THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN {npv('(lo + hi) / 2')} > 0 THEN hi ELSE (lo + hi) / 2 END, f_lo, f_hi
  FROM bis_{out} WHERE step < {C.IRR_STEPS}),
{out} AS (SELECT {k}, CASE WHEN inflow = 0 THEN -1.0 WHEN f_lo > 0 AND f_hi < 0 THEN (lo + hi) / 2 END AS irr
  FROM bis_{out} WHERE step = {C.IRR_STEPS})"""


PAID_MOB_SQL = "paid_mob AS (SELECT loan_id, mob, sum(paid) AS paid FROM payments GROUP BY loan_id, mob)"
CF_SQL = PAID_MOB_SQL + """,
cf AS (SELECT loan_id, period, sum(cf) AS cf FROM (SELECT loan_id, 0 AS period, -loan_amnt AS cf FROM loans
  UNION ALL SELECT loan_id, mob AS period, paid AS cf FROM payments) GROUP BY loan_id, period)"""


def paid_mob(spark, d):
    return B.payments(spark, d).groupBy("loan_id", "mob").agg(F.sum("paid").alias("paid"))


def loan_cf(spark, d):
    return C.cashflows(B.loans(spark, d), B.payments(spark, d))


@register("g21_payments_wide", with_views("payments", extra=PAID_MOB_SQL) + "SELECT loan_id, " + ", ".join(
    f"{r6(f'sum(CASE WHEN mob = {m} THEN paid END)')} AS paid{m}" for m in MOBS) + " FROM paid_mob GROUP BY loan_id")
def g21_payments_wide(spark, d):
    return finish(G.payments_wide(B.payments(spark, d), "loan_id", "mob", "paid", MOBS))


RUNNING_SQL = PAID_MOB_SQL + ",\nrunning AS (SELECT loan_id, " + ", ".join(
    f"{' + '.join(f'coalesce(sum(CASE WHEN mob = {j} THEN paid END), 0.0)' for j in range(1, m + 1))} AS agg_paid{m}" for m in MOBS
) + " FROM paid_mob GROUP BY loan_id)"


def running_totals(spark, d):
    wide = G.payments_wide(B.payments(spark, d), "loan_id", "mob", "paid", MOBS)
    cols = {}
    acc = None
    for m in MOBS:
        term = F.coalesce(F.col(f"paid{m}"), F.lit(0.0))
        acc = term if acc is None else acc + term
        cols[f"agg_paid{m}"] = acc
    return wide.select("loan_id", *[v.alias(k) for k, v in cols.items()])


@register("w2_uncumulate", with_views("payments", extra=RUNNING_SQL + ",\nlong AS (" + " UNION ALL ".join(
    f"SELECT loan_id, {m} AS mob, agg_paid{m}" + (f" - agg_paid{m - 1}" if m > 1 else "") + " AS paid FROM running" for m in MOBS) + ")")
    + f"SELECT loan_id, mob, {r6('paid', 4)} AS paid FROM long")
def w2_uncumulate(spark, d):
    return finish(W.uncumulate_wide(running_totals(spark, d), "loan_id", "agg_paid", TERM).withColumn("mob", F.col("mob").cast("int")), 4)


MONTHLY_SQL = f"""sched AS (SELECT loan_id, id, loan_amnt, int_rate, term,
  {pmt_sql('int_rate / 1200.0', 'term', 'loan_amnt')} AS monthly_pmt FROM loans)"""


def sched(spark, d):
    return B.loans(spark, d).withColumn("monthly_pmt", pmt("int_rate / 1200.0", "term", "loan_amnt"))


@register("f1_pmt", with_views("loans", extra=MONTHLY_SQL) + f"SELECT loan_id, {r6('monthly_pmt')} AS monthly_pmt FROM sched")
def f1_pmt(spark, d):
    return finish(sched(spark, d).select("loan_id", "monthly_pmt"))


LATE_SQL = MONTHLY_SQL + ",\n" + PAID_MOB_SQL + """,
grid AS (SELECT loan_id, monthly_pmt, CAST(g.range AS INTEGER) AS mob FROM sched, range(1, """ + str(TERM + 1) + """) g),
late AS (SELECT loan_id, count_if(paid IS NULL OR paid < 0.95 * monthly_pmt) AS n_late
  FROM grid LEFT JOIN paid_mob USING (loan_id, mob) GROUP BY loan_id)"""


def late(spark, d):
    return G.late_count(sched(spark, d), B.payments(spark, d), "loan_id", "monthly_pmt", TERM)


@register("g22_late_count", with_views("loans", "payments", extra=LATE_SQL) + "SELECT loan_id, n_late FROM late")
def g22_late_count(spark, d):
    return late(spark, d)


@register("g23_late_distribution", with_views("loans", "payments", extra=LATE_SQL) +
          f"SELECT n_late, count(*) AS n, {r6('count(*) / sum(count(*)) OVER ()')} AS share FROM late GROUP BY n_late")
def g23_late_distribution(spark, d):
    return finish(G.late_distribution(late(spark, d)))


@register("j13_attach_first", """WITH w AS (SELECT l_orderkey AS loan_id, """ + ", ".join(
    f"{r6(f'sum(CASE WHEN l_linenumber = {m} THEN l_extendedprice * (1 - l_discount) END)')} AS paid{m}" for m in MOBS) +
    """ FROM lineitem GROUP BY l_orderkey),
f AS (SELECT l_orderkey AS loan_id, min(l_shipdate) AS first_ship FROM lineitem
  WHERE (l_orderkey, l_linenumber) IN (SELECT l_orderkey, min(l_linenumber) FROM lineitem GROUP BY l_orderkey) GROUP BY l_orderkey)
SELECT w.*, f.first_ship FROM w LEFT JOIN f USING (loan_id)""")
def j13_attach_first(spark, d):
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"]).select(
        F.col("l_orderkey").alias("loan_id"), F.struct("l_linenumber", "l_shipdate").alias("__o"), F.col("l_shipdate").alias("first_ship"))
    wide = G.payments_wide(B.payments(spark, d), "loan_id", "mob", "paid", MOBS)
    return finish(J.attach_first(wide, li, "loan_id", "__o", ["first_ship"]))


# --- IRR ---------------------------------------------------------------------------

@register("f3_loan_irr", with_views("loans", "payments", extra=CF_SQL + ",\n" + irr_sql("cf", ["loan_id"]), recursive=True) +
          f"SELECT loan_id, {r6('irr')} AS irr FROM irr_out")
def f3_loan_irr(spark, d):
    return finish(C.loan_irr(loan_cf(spark, d)))


@register("f4_portfolio_irr", with_views("loans", "payments", extra=CF_SQL + """,
pcf AS (SELECT occupation, period, sum(cf) AS cf FROM cf JOIN loans USING (loan_id) GROUP BY occupation, period),
""" + irr_sql("pcf", ["occupation"]), recursive=True) +
          f"SELECT occupation, {r6('irr')} AS irr, {r6('(pow(1 + irr, 12) - 1) * 100.0')} AS irr_year_pct FROM irr_out")
def f4_portfolio_irr(spark, d):
    return finish(C.portfolio_irr(loan_cf(spark, d), B.loans(spark, d), by=["occupation"]))


SCORE_SQL = """scored AS (SELECT loans.*, c_acctbal AS score FROM loans JOIN customer ON id = c_custkey)"""


def scored(spark, d):
    c = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    return B.loans(spark, d).join(c, F.col("id") == F.col("c_custkey")).withColumnRenamed("c_acctbal", "score").drop("c_custkey")


NB = 25
QL = "[" + ", ".join(str(i / NB) for i in range(NB + 1)) + "]"
BINS_SQL = SCORE_SQL + f""",
e AS (SELECT list_sort(list_distinct(quantile_cont(score, {QL}))) AS edges FROM scored),
binned AS (SELECT scored.*, CASE WHEN score IS NOT NULL AND score >= edges[1] AND score <= edges[-1]
  THEN CAST(greatest(len(list_filter(edges, lambda x: x < score)), 1) AS INTEGER) END AS bin FROM scored, e)"""


def binned(spark, d):
    return W.qcut(scored(spark, d), "score", NB)


@register("w3_qcut", with_views("loans", extra=BINS_SQL) + "SELECT loan_id, bin FROM binned")
def w3_qcut(spark, d):
    return binned(spark, d).select("loan_id", "bin")


@register("w5_cumulative_by_bin", with_views("loans", extra=BINS_SQL) + f"""SELECT bin, {r6('sum(loan_amnt)', 2)} AS loan_amnt,
  {r6('sum(sum(loan_amnt)) OVER (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 2)} AS cum_loan_amnt
  FROM binned GROUP BY bin""")
def w5_cumulative_by_bin(spark, d):
    return finish(W.cumulative_by_bin(binned(spark, d), "bin", ["loan_amnt"], desc=True), 2)


@register("f5_volume_irr_curve", with_views("loans", "payments", extra=BINS_SQL + ",\n" + CF_SQL + """,
bcf AS (SELECT bin, period, sum(cf) AS cf FROM cf JOIN binned USING (loan_id) GROUP BY bin, period),
ccf AS (SELECT bin, period, sum(cf) OVER (PARTITION BY period ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cf FROM bcf),
vol AS (SELECT bin, sum(sum(loan_amnt)) OVER (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS volume FROM binned GROUP BY bin),
""" + irr_sql("ccf", ["bin"]), recursive=True) + f"""SELECT bin, {r6('volume', 2)} AS volume, {r6('irr')} AS irr,
  {r6('(pow(1 + irr, 12) - 1) * 100.0')} AS irr_year_pct FROM irr_out JOIN vol USING (bin)""")
def f5_volume_irr_curve(spark, d):
    from ledgerplay.operators import portfolio as PF
    c = PF.volume_irr_curve(binned(spark, d), loan_cf(spark, d), "bin")
    return finish(c.withColumn("volume", F.round("volume", 2)))


@register("w6_top_by_volume", with_views("loans", extra=SCORE_SQL + """,
c AS (SELECT loan_id, score, loan_amnt, sum(loan_amnt) OVER (ORDER BY score DESC, loan_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
  sum(loan_amnt) OVER () AS total FROM scored)""") + f"SELECT loan_id, {r6('score')} AS score, {r6('loan_amnt')} AS loan_amnt FROM c WHERE coalesce(before, 0) < 0.2 * total")
def w6_top_by_volume(spark, d):
    return finish(W.top_by_volume(scored(spark, d), "score", "loan_amnt", 0.2, "loan_id"))


@register("f7_irr_at_share", with_views("loans", "payments", extra=SCORE_SQL + """,
c AS (SELECT loan_id, sum(loan_amnt) OVER (ORDER BY score DESC, loan_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
  sum(loan_amnt) OVER () AS total FROM scored),
top AS (SELECT loan_id FROM c WHERE coalesce(before, 0) < 0.2 * total),
""" + CF_SQL + """,
pcf AS (SELECT 0 AS k, period, sum(cf) AS cf FROM cf WHERE loan_id IN (SELECT loan_id FROM top) GROUP BY period),
""" + irr_sql("pcf", ["k"]), recursive=True) + f"SELECT {r6('irr')} AS irr, {r6('(pow(1 + irr, 12) - 1) * 100.0')} AS irr_year_pct FROM irr_out")
def f7_irr_at_share(spark, d):
    from ledgerplay.operators import portfolio as PF
    return finish(PF.irr_at_share(scored(spark, d), loan_cf(spark, d), "score", "loan_amnt", 0.2))


LOAN_STATUS_SQL = """last_mob AS (SELECT loan_id, max(mob) AS last_mob FROM paid_mob WHERE paid > 0 GROUP BY loan_id),
loan_status AS (SELECT loans.*, CASE WHEN coalesce(last_mob, 0) < term THEN coalesce(last_mob, 0) + 1 END AS co_mob
  FROM loans LEFT JOIN last_mob USING (loan_id))"""


@register("f8_irr_by_group", with_views("loans", "payments", extra=CF_SQL + ",\n" + LOAN_STATUS_SQL + ",\n" + irr_sql("cf", ["loan_id"]), recursive=True) +
          f"""SELECT co_mob IS NOT NULL AS charged_off, {r6('avg(irr)')} AS mean_irr, count(*) AS n FROM irr_out JOIN loan_status USING (loan_id) GROUP BY 1""")
def f8_irr_by_group(spark, d):
    from ledgerplay.plans.q_clean import loan_status
    st = loan_status(spark, d).select("loan_id", F.col("co_mob").isNotNull().alias("charged_off"))
    return finish(C.irr_by_group(C.loan_irr(loan_cf(spark, d)).join(st, "loan_id"), "charged_off"))


# --- late payments against the population (M7) -------------------------------------

M7_SQL = MONTHLY_SQL + ",\n" + PAID_MOB_SQL + """,
grid AS (SELECT loan_id, id, monthly_pmt, CAST(g.range AS INTEGER) AS mob FROM sched, range(1, """ + str(TERM + 1) + """) g),
lf AS (SELECT grid.loan_id, grid.mob, r_name AS town, (paid IS NULL OR paid < 0.95 * monthly_pmt) AS late
  FROM grid LEFT JOIN paid_mob USING (loan_id, mob) JOIN customer ON id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
per AS (SELECT mob, town, CAST(count(*) AS DOUBLE) AS n_a, CAST(count_if(late) AS DOUBLE) AS x_a FROM lf GROUP BY mob, town),
t AS (SELECT *, sum(n_a) OVER (PARTITION BY mob) - n_a AS n_b, sum(x_a) OVER (PARTITION BY mob) - x_a AS x_b FROM per),
tz AS (SELECT *, CASE WHEN (x_a + x_b) / (n_a + n_b) * (1 - (x_a + x_b) / (n_a + n_b)) * (1.0 / n_a + 1.0 / n_b) > 0
  THEN (x_a / n_a - x_b / n_b) / sqrt((x_a + x_b) / (n_a + n_b) * (1 - (x_a + x_b) / (n_a + n_b)) * (1.0 / n_a + 1.0 / n_b)) END AS z FROM t),
tp AS (SELECT *, """ + phi("-z") + """ AS p_value FROM tz),
r AS (SELECT *, row_number() OVER (ORDER BY p_value, mob, town) AS i, count(*) OVER () AS m FROM tp WHERE p_value IS NOT NULL),
k AS (SELECT max(CASE WHEN p_value <= i / m * 0.05 THEN i END) AS kmax FROM r)"""


@register("m7_late_vs_population", with_views("loans", "payments", extra=M7_SQL) + f"""SELECT mob, town, n_a, x_a,
  {r6('z')} AS z, {r6('p_value')} AS p_value, coalesce(i <= kmax, false) AS reject_bh FROM r, k""")
def m7_late_vs_population(spark, d):
    from ledgerplay.operators import portfolio as PF
    return finish(PF.late_vs_population(sched(spark, d), B.payments(spark, d), B.bureau(spark, d), TERM))


# --- secondary pool (F13-F16) --------------------------------------------------------

SEC_SQL = MONTHLY_SQL + """,
pool AS (SELECT sched.*, CAST((year(TIMESTAMP '""" + BUY_DATE + """') - year(l.issue_date)) * 12 + (month(TIMESTAMP '""" + BUY_DATE + """') - month(l.issue_date)) AS INTEGER) AS purchase_mob
  FROM sched JOIN loans l USING (loan_id)),
bought AS (SELECT * FROM pool WHERE purchase_mob > 0 AND purchase_mob < term)"""


@register("f13_mock_secondary", with_views("loans", extra=SEC_SQL) +
          f"SELECT purchase_mob, count(*) AS n, {r6('count(*) / sum(count(*)) OVER ()')} AS share FROM bought GROUP BY purchase_mob")
def f13_mock_secondary(spark, d):
    from ledgerplay.operators import portfolio as PF
    pool = PF.secondary_pool(sched(spark, d), BUY_DATE)
    return finish(G.value_shares(pool, "purchase_mob"))


@register("f14_secondary_irr", with_views("loans", "payments", extra=SEC_SQL + ",\n" + PAID_MOB_SQL + """,
d AS (SELECT CAST(x AS DOUBLE) AS discount FROM (VALUES """ + ", ".join(f"({x})" for x in DISCOUNTS) + """) t(x)),
bal AS (SELECT loan_id, purchase_mob, CASE WHEN int_rate / 1200.0 = 0 THEN loan_amnt * (1 - purchase_mob / term)
  ELSE loan_amnt * (pow(1.0 + int_rate / 1200.0, term) - pow(1.0 + int_rate / 1200.0, purchase_mob)) / (pow(1.0 + int_rate / 1200.0, term) - 1.0) END AS balance FROM bought),
scf AS (SELECT discount, period, sum(cf) AS cf FROM (
  SELECT discount, 0 AS period, -balance * (1 - discount) AS cf FROM bal, d
  UNION ALL SELECT discount, p.mob - b.purchase_mob AS period, p.paid AS cf FROM paid_mob p JOIN bal b USING (loan_id), d
  WHERE p.mob > b.purchase_mob) GROUP BY discount, period),
""" + irr_sql("scf", ["discount"]), recursive=True) + f"SELECT discount, {r6('irr')} AS irr, {r6('(pow(1 + irr, 12) - 1) * 100.0')} AS irr_year_pct FROM irr_out")
def f14_secondary_irr(spark, d):
    from ledgerplay.operators import portfolio as PF
    pool = PF.secondary_pool(sched(spark, d), BUY_DATE)
    cf = C.secondary_cashflows(pool, paid_mob(spark, d), DISCOUNTS)
    pooled = cf.groupBy("discount", "period").agg(F.sum("cf").alias("cf"))
    return finish(C.loan_irr(pooled, "discount").withColumn("irr_year_pct", C.annualize("irr") * 100.0))


@register("f15_history_features", with_views("loans", "payments", extra=SEC_SQL + ",\n" + PAID_MOB_SQL + """,
g AS (SELECT b.loan_id, b.monthly_pmt, CAST(s.range AS INTEGER) AS mob FROM bought b, range(1, """ + str(TERM + 1) + """) s WHERE s.range <= b.purchase_mob),
j AS (SELECT g.*, p.paid, (p.paid IS NULL OR p.paid < 0.95 * g.monthly_pmt) AS late FROM g LEFT JOIN paid_mob p USING (loan_id, mob)),
isl AS (SELECT *, mob - sum(CAST(late AS INTEGER)) OVER (PARTITION BY loan_id ORDER BY mob) AS island FROM j),
runs AS (SELECT loan_id, island, count(*) AS run FROM isl WHERE late GROUP BY loan_id, island),
lg AS (SELECT loan_id, max(run) AS longest FROM runs GROUP BY loan_id)""") + f"""
SELECT loan_id, {r6('sum(coalesce(paid, 0.0)) / sum(monthly_pmt)')} AS paid_share, {r6('avg(CAST(late AS DOUBLE))')} AS late_share,
  {r6('arg_max(coalesce(paid, 0.0), mob) / first(monthly_pmt)')} AS last_payment_ratio, coalesce(max(lg.longest), 0) AS longest_late_run
FROM j LEFT JOIN lg USING (loan_id) GROUP BY loan_id""")
def f15_history_features(spark, d):
    from ledgerplay.operators import portfolio as PF
    pool = PF.secondary_pool(sched(spark, d), BUY_DATE)
    return finish(C.history_features(B.payments(spark, d), pool))
