"""Pricing and pool selection: F6, F9-F12, F16-F18.

The rate grid binds each loan to the 26 integer rates 5..30 with an activation
probability and a predicted IRR that are closed forms of the loan's own data
(credit score, key) - see ``rate_grid``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerplay.operators import portfolio as PF
from ledgerplay.plans.common import finish, r6
from ledgerplay.plans.q_payments import (BUY_DATE, CF_SQL, DISCOUNTS, PAID_MOB_SQL, SEC_SQL, irr_sql,
                                         loan_cf, paid_mob, sched, scored)
from ledgerplay.plans.registry import register, with_views

RATES = list(range(5, 31))
LAMBDAS = [i / 10 for i in range(11)]

P_SQL = "1.0 / (1.0 + exp(0.3 * (rate - 10.0 - score / 1000.0)))"
IRR_SQL = "(rate - CAST(loan_id % 9 AS DOUBLE)) / 100.0"
GRID_SQL = f"""scored AS (SELECT loans.*, c_acctbal AS score FROM loans JOIN customer ON id = c_custkey),
grid AS (SELECT loan_id, loan_amnt, occupation, CAST(r.range AS DOUBLE) AS rate,
  {P_SQL.replace('rate', 'CAST(r.range AS DOUBLE)')} AS p, {IRR_SQL.replace('rate', 'CAST(r.range AS DOUBLE)')} AS irr
  FROM scored, range(5, 31) r)"""


def option(r):
    """(rate, p, irr) of a loan at rate ``r``."""
    return F.struct(
        r.alias("rate"),
        (1.0 / (1.0 + F.exp(0.3 * (r - 10.0 - F.col("score") / 1000.0)))).alias("p"),
        ((r - (F.col("loan_id") % 9).cast("double")) / 100.0).alias("irr"))


def rate_grid(spark, d):
    """One row per loan with its options: array<struct<rate, p, irr>> over 5..30."""
    s = scored(spark, d)
    opts = F.transform(F.array(*[F.lit(float(r)) for r in RATES]), option)
    return s.select("loan_id", "loan_amnt", "occupation", "int_rate", "score", opts.alias("opts"))


def rate_rows(spark, d):
    """The same grid as rows (loan, rate): an explode of the option array."""
    g = rate_grid(spark, d)
    return g.select("loan_id", "loan_amnt", "occupation", "int_rate", "score", F.explode("opts").alias("o")).select(
        "loan_id", "loan_amnt", "occupation", "int_rate", "score", "o.rate", "o.p", "o.irr")


@register("f9_expected_volume", with_views("loans", extra=GRID_SQL) + f"""SELECT grid.occupation, {r6("sum(p * grid.loan_amnt)", 2)} AS expected_volume
  FROM grid JOIN loans USING (loan_id) WHERE grid.rate = loans.int_rate GROUP BY grid.occupation""")
def f9_expected_volume(spark, d):
    on_grid = F.col("int_rate").isin([float(r) for r in RATES])
    g = scored(spark, d).where(on_grid).select("loan_amnt", "occupation", option(F.col("int_rate"))["p"].alias("p"))
    return finish(PF.expected_volume(g, "p", "loan_amnt", ["occupation"]), 2)


def _reprice_sql(obj: str) -> str:
    return with_views("loans", extra=GRID_SQL + f""",
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY {obj} DESC, rate) AS rn FROM grid) WHERE rn = 1)""") + \
        f"""SELECT {r6('sum(p * loan_amnt)', 2)} AS expected_volume, {r6('sum(p * loan_amnt * irr) / sum(p * loan_amnt)')} AS mean_irr,
  {r6('avg(rate)')} AS mean_rate, count(*) AS n_loans FROM best"""


@register("f10_reprice_volume", _reprice_sql("p * loan_amnt"))
def f10_reprice_volume(spark, d):
    r = PF.reprice(rate_grid(spark, d), "opts", "loan_amnt", "volume")
    return finish(r.withColumn("expected_volume", F.round("expected_volume", 2)))


@register("f10_reprice_irr", _reprice_sql("irr"))
def f10_reprice_irr(spark, d):
    r = PF.reprice(rate_grid(spark, d), "opts", "loan_amnt", "irr")
    return finish(r.withColumn("expected_volume", F.round("expected_volume", 2)))


SWEEP_SQL = GRID_SQL + f""",
sc AS (SELECT avg(loan_amnt) AS scale FROM grid),
lg AS (SELECT grid.*, CAST(l.x AS DOUBLE) AS lam FROM grid, (VALUES {', '.join(f'({x})' for x in LAMBDAS)}) l(x)),
best AS (SELECT * FROM (SELECT lg.*, row_number() OVER (PARTITION BY lam, loan_id
  ORDER BY lam * p * loan_amnt / scale + (1 - lam) * p * irr DESC, rate) AS rn FROM lg, sc) WHERE rn = 1),
sweep AS (SELECT lam, sum(p * loan_amnt) AS volume, sum(p * loan_amnt * irr) / sum(p * loan_amnt) AS mean_irr FROM best GROUP BY lam)"""


def sweep(spark, d):
    return PF.price_sweep(rate_grid(spark, d), "opts", "loan_amnt", LAMBDAS)


@register("f12_price_sweep", with_views("loans", extra=SWEEP_SQL) + f"SELECT lam, {r6('volume', 2)} AS volume, {r6('mean_irr')} AS mean_irr FROM sweep")
def f12_price_sweep(spark, d):
    return finish(sweep(spark, d).withColumn("volume", F.round("volume", 2)))


@register("f12_nearest_to_volume", with_views("loans", extra=SWEEP_SQL + """,
tgt AS (SELECT 0.3 * sum(loan_amnt) AS t FROM loans)""") + f"""SELECT lam, {r6('volume', 2)} AS volume, {r6('mean_irr')} AS mean_irr FROM sweep, tgt
  ORDER BY abs(volume - t), lam LIMIT 1""")
def f12_nearest_to_volume(spark, d):
    from ledgerplay.plans import bindings as B
    t = B.loans(spark, d).agg(F.sum("loan_amnt")).collect()[0][0] * 0.3
    return finish(PF.nearest_to_volume(sweep(spark, d), t).withColumn("volume", F.round("volume", 2)))


@register("f11_pareto_front", with_views("loans", extra=GRID_SQL + """,
pts AS (SELECT loan_id, p * loan_amnt AS volume, irr FROM grid WHERE rate = 12),
c AS (SELECT *, max(irr) OVER (ORDER BY volume DESC, irr DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM pts)""") +
          f"SELECT loan_id, {r6('volume', 4)} AS volume, {r6('irr')} AS irr FROM c WHERE best_before IS NULL OR irr > best_before")
def f11_pareto_front(spark, d):
    at = scored(spark, d).select("loan_id", "loan_amnt", option(F.lit(12.0)).alias("o"))
    pts = at.select("loan_id", (F.col("o.p") * F.col("loan_amnt")).alias("volume"), "o.irr")
    return finish(PF.pareto_front(pts, "volume", "irr").select("loan_id", F.round("volume", 4).alias("volume"), "irr"))


@register("f16_discount_sweep", with_views("loans", "payments", extra=SEC_SQL + ",\n" + PAID_MOB_SQL + """,
bs AS (SELECT bought.*, c_acctbal AS score FROM bought JOIN customer ON id = c_custkey),
c AS (SELECT *, sum(loan_amnt) OVER (ORDER BY score DESC, loan_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
  sum(loan_amnt) OVER () AS total FROM bs),
top AS (SELECT * FROM c WHERE coalesce(before, 0) < 0.5 * total),
d AS (SELECT CAST(x AS DOUBLE) AS discount FROM (VALUES """ + ", ".join(f"({x})" for x in DISCOUNTS) + """) t(x)),
bal AS (SELECT loan_id, purchase_mob, CASE WHEN int_rate / 1200.0 = 0 THEN loan_amnt * (1 - purchase_mob / term)
  ELSE loan_amnt * (pow(1.0 + int_rate / 1200.0, term) - pow(1.0 + int_rate / 1200.0, purchase_mob)) / (pow(1.0 + int_rate / 1200.0, term) - 1.0) END AS balance FROM top),
scf AS (SELECT discount, period, sum(cf) AS cf FROM (
  SELECT discount, 0 AS period, -balance * (1 - discount) AS cf FROM bal, d
  UNION ALL SELECT discount, p.mob - b.purchase_mob AS period, p.paid AS cf FROM paid_mob p JOIN bal b USING (loan_id), d
  WHERE p.mob > b.purchase_mob) GROUP BY discount, period),
""" + irr_sql("scf", ["discount"]), recursive=True) + f"SELECT discount, {r6('irr')} AS irr, {r6('(pow(1 + irr, 12) - 1) * 100.0')} AS irr_year_pct FROM irr_out")
def f16_discount_sweep(spark, d):
    from ledgerplay.sources.tables import read_table
    c = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    pool = PF.secondary_pool(sched(spark, d), BUY_DATE).join(c, F.col("id") == F.col("c_custkey")).withColumnRenamed("c_acctbal", "score")
    return finish(PF.discount_sweep(pool, paid_mob(spark, d), DISCOUNTS, "score", 0.5))


@register("f17_constrained_selection", with_views("loans", extra="""scored AS (SELECT loans.*, c_acctbal AS score FROM loans JOIN customer ON id = c_custkey),
st AS (SELECT avg(int_rate) AS m, stddev_pop(int_rate) AS sd, sum(loan_amnt) AS total FROM scored),
g AS (SELECT *, score - mu * ((int_rate - m) / sd) AS pen FROM scored, st, (VALUES (0.0::DOUBLE), (500.0), (1000.0), (2000.0)) v(mu)),
c AS (SELECT *, coalesce(sum(loan_amnt) OVER (PARTITION BY mu ORDER BY pen DESC, loan_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 0.5 * total AS chosen FROM g)""") +
          f"""SELECT CAST(mu AS DOUBLE) AS mu, {r6('avg(score) FILTER (chosen)', 4)} AS mean_score_selected, {r6('avg(int_rate) FILTER (NOT chosen)', 4)} AS rest_int_rate,
  avg(int_rate) FILTER (NOT chosen) >= any_value(m) AS feasible FROM c GROUP BY mu""")
def f17_constrained_selection(spark, d):
    s = scored(spark, d)
    return finish(PF.constrained_selection(s, "score", "loan_amnt", 0.5, ["int_rate"], [0.0, 500.0, 1000.0, 2000.0]), 4)


GUARDS = {"fico": 1, "int_rate": -1, "dti": -1}
MUS = [0.0, 0.5, 1.0, 2.0]


@register("f17_best_feasible_selection", with_views("loans", extra="""pool AS (SELECT loan_id, loan_amnt, int_rate, int_rate - loan_id % 9 AS score, c_acctbal AS fico, loan_amnt / (abs(c_acctbal) + 1000.0) AS dti
  FROM loans JOIN customer ON id = c_custkey),
st AS (SELECT avg(score) AS ms, stddev_pop(score) AS ss, avg(fico) AS mf, stddev_pop(fico) AS sf, avg(int_rate) AS mr, stddev_pop(int_rate) AS sr, avg(dti) AS md, stddev_pop(dti) AS sd FROM pool),
z AS (SELECT pool.*, (score - ms) / ss AS zs, (fico - mf) / sf AS zf, (int_rate - mr) / sr AS zr, (dti - md) / sd AS zd, mf, mr, md FROM pool, st),
mu AS (SELECT a.m AS f, b.m AS r, c.m AS d FROM (VALUES (0.0), (0.5), (1.0), (2.0)) a(m), (VALUES (0.0), (0.5), (1.0), (2.0)) b(m), (VALUES (0.0), (0.5), (1.0), (2.0)) c(m)),
pen AS (SELECT z.*, f, r, d, zs + f * zf - r * zr - d * zd AS pen FROM z, mu),
cum AS (SELECT *, sum(loan_amnt) OVER (PARTITION BY f, r, d ORDER BY pen DESC, loan_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, sum(loan_amnt) OVER (PARTITION BY f, r, d) AS total FROM pen),
sel AS (SELECT * FROM cum WHERE coalesce(before, 0) < 0.3 * total),
best AS (SELECT f, r, d FROM sel GROUP BY f, r, d HAVING avg(fico) >= any_value(mf) AND avg(int_rate) <= any_value(mr) AND avg(dti) <= any_value(md) ORDER BY avg(score) DESC, f, r, d LIMIT 1)""") +
          "SELECT loan_id, CAST(f AS DOUBLE) AS mu_fico, CAST(r AS DOUBLE) AS mu_int_rate, CAST(d AS DOUBLE) AS mu_dti FROM sel JOIN best USING (f, r, d)")
def f17_best_feasible_selection(spark, d):
    s = scored(spark, d).withColumnRenamed("score", "fico")
    s = s.withColumns({"score": F.col("int_rate") - F.col("loan_id") % 9, "dti": F.col("loan_amnt") / (F.abs("fico") + 1000.0)})
    return PF.best_feasible_selection(s, "score", "loan_amnt", 0.3, GUARDS, MUS).select("loan_id", "mu_fico", "mu_int_rate", "mu_dti")


@register("f18_balance_selection", with_views("loans", extra="""scored AS (SELECT loans.*, c_acctbal AS score FROM loans JOIN customer ON id = c_custkey),
c AS (SELECT *, sum(loan_amnt) OVER (PARTITION BY occupation ORDER BY score DESC, loan_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
  sum(loan_amnt) OVER (PARTITION BY occupation) AS total FROM scored)""") + "SELECT loan_id, occupation FROM c WHERE coalesce(before, 0) < 0.5 * total")
def f18_balance_selection(spark, d):
    return PF.balance_selection(scored(spark, d), ["occupation"], "score", "loan_amnt", 0.5).select("loan_id", "occupation")


def _curve_sql(score_expr: str, tag: str) -> str:
    q = "[" + ", ".join(str(i / 25) for i in range(26)) + "]"
    return f"""s_{tag} AS (SELECT loans.loan_id, loans.loan_amnt, {score_expr} AS score FROM loans JOIN customer ON id = c_custkey),
e_{tag} AS (SELECT list_sort(list_distinct(quantile_cont(score, {q}))) AS edges FROM s_{tag}),
b_{tag} AS (SELECT s_{tag}.*, CAST(greatest(len(list_filter(edges, lambda x: x < score)), 1) AS INTEGER) AS bin FROM s_{tag}, e_{tag}),
bcf_{tag} AS (SELECT bin, period, sum(cf) AS cf FROM cf JOIN b_{tag} USING (loan_id) GROUP BY bin, period),
g_{tag} AS (SELECT bin, CAST(p.range AS INTEGER) AS period FROM (SELECT DISTINCT bin FROM b_{tag}), range(0, (SELECT max(period) FROM bcf_{tag}) + 1) p),
ccf_{tag} AS (SELECT bin, period, sum(coalesce(cf, 0.0)) OVER (PARTITION BY period ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cf
  FROM g_{tag} LEFT JOIN bcf_{tag} USING (bin, period)),
vol_{tag} AS (SELECT bin, sum(sum(loan_amnt)) OVER (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS volume FROM b_{tag} GROUP BY bin),
""" + irr_sql(f"ccf_{tag}", ["bin"], out=f"irr_{tag}")


@register("f6_compare_curves", with_views("loans", "payments", extra=CF_SQL + ",\n" + _curve_sql("c_acctbal", "a") + ",\n" + _curve_sql("loans.int_rate", "b"), recursive=True) +
          " UNION ALL ".join(f"""SELECT '{name}' AS score_name, bin, {r6('volume', 2)} AS volume, {r6('irr')} AS irr, {r6('(pow(1 + irr, 12) - 1) * 100.0')} AS irr_year_pct
  FROM irr_{tag} JOIN vol_{tag} USING (bin)""" for name, tag in (("score", "a"), ("int_rate", "b"))))
def f6_compare_curves(spark, d):
    c = PF.compare_curves(scored(spark, d), loan_cf(spark, d), ["score", "int_rate"])
    return finish(c.withColumn("volume", F.round("volume", 2)))
