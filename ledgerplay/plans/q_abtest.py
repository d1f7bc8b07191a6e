"""Offer activation tests: W1, J1, G1-G2, W3-W4, J6, M1-M6."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerplay.operators import aggregates as G
from ledgerplay.operators import clean as P
from ledgerplay.operators import joins as J
from ledgerplay.operators import stats as M
from ledgerplay.operators import windows as W
from ledgerplay.plans import bindings as B
from ledgerplay.plans.common import ENRICHED_SQL, finish, p2_sql, phi, r6, z2_sql
from ledgerplay.plans.registry import register, with_views
from ledgerplay.session import cut_lineage

TOWN_A, TOWN_B = "AMERICA", "EUROPE"
Q = [i / 10 for i in range(11)]
QL = "[" + ", ".join(str(q) for q in Q) + "]"


def enriched(spark, d, cols=None):
    """Last offer per client, enriched with the bureau row (J1 keeps the row count).

    ``cols`` narrows the offer columns carried through the last-row aggregate:
    a struct in an aggregate hides unused fields from column pruning, so the
    projection is done before it.
    """
    o = B.offers(spark, d)
    if cols:
        o = o.select(*dict.fromkeys(["id", "offer_date", "offer_key", *cols]))
    last = W.latest_per_key(o, "id", "offer_date", "offer_key")
    return J.enrich(last, B.bureau(spark, d), "id")


def ab_town_vs_rest(spark, d):
    e = enriched(spark, d, ["offer_accepted"])
    return finish(M.one_vs_rest(e, "town", "offer_accepted").select(
        "town", "n_a", "x_a", "n_b", "x_b", "rate_a", "rate_b", "z", "p_value"))


AB_TOWN_VS_REST_SQL = with_views("offers", "bureau", extra=ENRICHED_SQL + """,
per AS (SELECT town, CAST(count(*) AS DOUBLE) AS n_a,
  CAST(sum(CASE WHEN offer_accepted THEN 1 ELSE 0 END) AS DOUBLE) AS x_a FROM enriched GROUP BY town),
t AS (SELECT town, n_a, x_a, sum(n_a) OVER () - n_a AS n_b, sum(x_a) OVER () - x_a AS x_b FROM per),
z AS (SELECT *, """ + z2_sql("n_a", "x_a", "n_b", "x_b") + """ AS z FROM t)""") + f"""
SELECT town, n_a, x_a, n_b, x_b, {r6('x_a/n_a')} AS rate_a, {r6('x_b/n_b')} AS rate_b, {r6('z')} AS z,
  {r6(p2_sql('z'))} AS p_value FROM z"""
register("ab_town_vs_rest", AB_TOWN_VS_REST_SQL)(ab_town_vs_rest)


@register("w1_latest_offer", with_views("offers", extra=ENRICHED_SQL.split(",\nenriched")[0]) + """
SELECT id, offer_key, offer_date, """ + r6("requested_amount") + """ AS requested_amount, offer_accepted, occupation FROM last_offer""")
def w1_latest_offer(spark, d):
    return finish(W.latest_per_key(B.offers(spark, d), "id", "offer_date", "offer_key"))


@register("j1_enrich", with_views("offers", "bureau", extra=ENRICHED_SQL) + """
SELECT id, offer_key, """ + r6("credit_score") + """ AS credit_score, segment, town FROM enriched""")
def j1_enrich(spark, d):
    return finish(enriched(spark, d).select("id", "offer_key", "credit_score", "segment", "town"))


@register("g1_mean_overall_and_where", with_views("offers", "bureau", extra=ENRICHED_SQL) + f"""
SELECT town, {r6('avg(requested_amount)')} AS mean_all,
  {r6('avg(CASE WHEN offer_accepted THEN requested_amount END)')} AS mean_where FROM enriched GROUP BY town""")
def g1_mean_overall_and_where(spark, d):
    return finish(G.mean_overall_and_where(enriched(spark, d), "requested_amount", F.col("offer_accepted"), ["town"]))


@register("g2_activation_rate", with_views("offers", "bureau", extra=ENRICHED_SQL) + f"""
SELECT town, {r6('avg(CAST(offer_accepted AS INTEGER))')} AS rate, count(*) AS n FROM enriched GROUP BY town""")
def g2_activation_rate(spark, d):
    return finish(G.rate(enriched(spark, d, ["offer_accepted"]), "offer_accepted", ["town"]))


@register("m1_prop_ztest_1", with_views("offers", "bureau", extra=ENRICHED_SQL + """,
a AS (SELECT town, CAST(sum(CAST(offer_accepted AS INTEGER)) AS DOUBLE) AS x, count(*) AS n FROM enriched GROUP BY town),
b AS (SELECT *, x / n AS p_hat FROM a),
c AS (SELECT *, CASE WHEN p_hat*(1-p_hat)/n > 0 THEN (p_hat - 0.3333)/sqrt(p_hat*(1-p_hat)/n) END AS z FROM b)""") + f"""
SELECT town, x, n, {r6('p_hat')} AS p_hat, {r6('z')} AS z, {r6(p2_sql('z'))} AS p_value FROM c""")
def m1_prop_ztest_1(spark, d):
    return finish(M.prop_ztest_1(enriched(spark, d, ["offer_accepted"]), "offer_accepted", 0.3333, by=["town"]))


@register("m2_two_towns", with_views("offers", "bureau", extra=ENRICHED_SQL + f""",
a AS (SELECT CAST(count_if(town = '{TOWN_A}') AS DOUBLE) AS n_a,
  CAST(sum(CASE WHEN town = '{TOWN_A}' THEN CAST(offer_accepted AS INTEGER) END) AS DOUBLE) AS x_a,
  CAST(count_if(town = '{TOWN_B}') AS DOUBLE) AS n_b,
  CAST(sum(CASE WHEN town = '{TOWN_B}' THEN CAST(offer_accepted AS INTEGER) END) AS DOUBLE) AS x_b FROM enriched),
z AS (SELECT *, """ + z2_sql("n_a", "x_a", "n_b", "x_b") + """ AS z FROM a)""") + f"""
SELECT n_a, x_a, n_b, x_b, {r6('x_a/n_a')} AS rate_a, {r6('x_b/n_b')} AS rate_b, {r6('z')} AS z,
  {r6(p2_sql('z'))} AS p_value FROM z""")
def m2_two_towns(spark, d):
    return finish(M.prop_ztest_2(enriched(spark, d, ["offer_accepted"]), "town", "offer_accepted", TOWN_A, TOWN_B))


@register("m3_power_table", with_views("offers", "bureau", extra=ENRICHED_SQL + f""",
a AS (SELECT town, count(*) AS n, avg(CAST(offer_accepted AS INTEGER)) AS rate FROM enriched GROUP BY town),
p0 AS (SELECT avg(CAST(offer_accepted AS INTEGER)) AS p0 FROM enriched),
t AS (SELECT town, n, rate, p0, sqrt(p0*(1-p0)/n) AS sd FROM a, p0)""") + """
SELECT town, n, {rate} AS rate, {p0} AS p0, {sd} AS sd, {lo} AS crit_low, {hi} AS crit_high, {b} AS type2, {pw} AS power FROM t""".format(
    rate=r6("rate"), p0=r6("p0"), sd=r6("sd"), lo=r6(f"p0 - {M.norm_ppf(0.975)!r}*sd"), hi=r6(f"p0 + {M.norm_ppf(0.975)!r}*sd"),
    b=r6(f"{phi(f'((p0 + {M.norm_ppf(0.975)!r}*sd) - rate)/sd')} - {phi(f'((p0 - {M.norm_ppf(0.975)!r}*sd) - rate)/sd')}"),
    pw=r6(f"1 - ({phi(f'((p0 + {M.norm_ppf(0.975)!r}*sd) - rate)/sd')} - {phi(f'((p0 - {M.norm_ppf(0.975)!r}*sd) - rate)/sd')})")))
def m3_power_table(spark, d):
    e = enriched(spark, d)
    p0 = e.agg(F.avg(F.col("offer_accepted").cast("int"))).collect()[0][0]
    t = e.groupBy("town").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("offer_accepted").cast("int")).alias("rate"))
    t = t.withColumn("p0", F.lit(p0)).withColumn("sd", F.sqrt(F.col("p0") * (1 - F.col("p0")) / F.col("n")))
    return finish(M.power_table(t, "p0", "sd", "rate"))


# --- segmented test: nested quantile bins of the population, then a test per segment ----

def segments(spark, d):
    # the population is scanned by every quantile pass and by the binning:
    # materialise it once in the shared checkpoint folder
    e = cut_lineage(P.range_to_null(enriched(spark, d, ["offer_accepted", "requested_amount"]), "credit_score", 0, 10000))
    binned = W.nested_qcut(e, "credit_score", 10, "requested_amount", 10)
    return binned.where(F.col("bin1").isNotNull() & F.col("bin2").isNotNull())


SEGMENTS_SQL = ENRICHED_SQL + f""",
pop AS (SELECT * REPLACE (CASE WHEN credit_score BETWEEN 0 AND 10000 THEN credit_score END AS credit_score) FROM enriched),
e1 AS (SELECT list_sort(list_distinct(quantile_cont(credit_score, {QL}))) AS edges FROM pop),
b1 AS (SELECT pop.*, CASE WHEN credit_score IS NOT NULL AND credit_score >= edges[1] AND credit_score <= edges[-1]
  THEN CAST(greatest(len(list_filter(edges, lambda e: e < credit_score)), 1) AS INTEGER) END AS bin1 FROM pop, e1),
e2 AS (SELECT bin1, list_sort(list_distinct(quantile_cont(requested_amount, {QL}))) AS edges FROM b1
  WHERE bin1 IS NOT NULL GROUP BY bin1),
b2 AS (SELECT b1.*, CASE WHEN requested_amount IS NOT NULL AND requested_amount >= e2.edges[1] AND requested_amount <= e2.edges[-1]
  THEN CAST(greatest(len(list_filter(e2.edges, lambda e: e < requested_amount)), 1) AS INTEGER) END AS bin2 FROM b1 LEFT JOIN e2 USING (bin1)),
seg AS (SELECT * FROM b2 WHERE bin1 IS NOT NULL AND bin2 IS NOT NULL)"""


@register("w4_nested_qcut", with_views("offers", "bureau", extra=SEGMENTS_SQL) + "SELECT id, bin1, bin2 FROM seg")
def w4_nested_qcut(spark, d):
    return segments(spark, d).select("id", "bin1", "bin2")


TESTS_SQL = SEGMENTS_SQL + f""",
a AS (SELECT bin1, bin2, CAST(count_if(town = '{TOWN_A}') AS DOUBLE) AS n_a,
  CAST(sum(CASE WHEN town = '{TOWN_A}' THEN CAST(offer_accepted AS INTEGER) END) AS DOUBLE) AS x_a,
  CAST(count_if(town = '{TOWN_B}') AS DOUBLE) AS n_b,
  CAST(sum(CASE WHEN town = '{TOWN_B}' THEN CAST(offer_accepted AS INTEGER) END) AS DOUBLE) AS x_b FROM seg GROUP BY bin1, bin2),
tz AS (SELECT *, """ + z2_sql("n_a", "coalesce(x_a, 0.0)", "n_b", "coalesce(x_b, 0.0)") + """ AS z FROM a),
tests AS (SELECT *, """ + p2_sql("z") + """ AS p_value FROM tz)"""


def seg_tests(spark, d):
    return M.segmented_ab(segments(spark, d), ["bin1", "bin2"], "town", "offer_accepted", TOWN_A, TOWN_B)


@register("m4_segmented_ab", with_views("offers", "bureau", extra=TESTS_SQL) + f"""
SELECT bin1, bin2, n_a, x_a, n_b, x_b, {r6('z')} AS z, {r6('p_value')} AS p_value FROM tests""")
def m4_segmented_ab(spark, d):
    return finish(seg_tests(spark, d).select("bin1", "bin2", "n_a", "x_a", "n_b", "x_b", "z", "p_value"))


CORR_SQL = TESTS_SQL + """,
r AS (SELECT *, row_number() OVER (ORDER BY p_value, bin1, bin2) AS i, count(*) OVER () AS m FROM tests WHERE p_value IS NOT NULL),
k AS (SELECT max(CASE WHEN p_value <= i / m * 0.05 THEN i END) AS kmax FROM r)"""


@register("m5_m6_corrections", with_views("offers", "bureau", extra=CORR_SQL) + f"""
SELECT bin1, bin2, {r6('p_value')} AS p_value, p_value < 0.05 / m AS reject_bonf,
  coalesce(i <= kmax, false) AS reject_bh,
  {r6('least(1.0, min(p_value * m / i) OVER (ORDER BY p_value DESC, bin1 DESC, bin2 DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))')} AS p_adj_bh
FROM r, k""")
def m5_m6_corrections(spark, d):
    t = seg_tests(spark, d).where(F.col("p_value").isNotNull()).select("bin1", "bin2", "p_value")
    t = M.bonferroni(t)
    t = M.benjamini_hochberg(t, tie=["bin1", "bin2"])
    return finish(t)


@register("m3_power_two_sample", with_views("offers", "bureau", extra=ENRICHED_SQL + f""",
a AS (SELECT CAST(count_if(town = '{TOWN_A}') AS DOUBLE) AS n_a,
  CAST(sum(CASE WHEN town = '{TOWN_A}' THEN CAST(offer_accepted AS INTEGER) END) AS DOUBLE) AS x_a,
  CAST(count_if(town = '{TOWN_B}') AS DOUBLE) AS n_b,
  CAST(sum(CASE WHEN town = '{TOWN_B}' THEN CAST(offer_accepted AS INTEGER) END) AS DOUBLE) AS x_b FROM enriched),
t AS (SELECT x_a / n_a - x_b / n_b AS diff,
  sqrt((x_a + x_b) / (n_a + n_b) * (1 - (x_a + x_b) / (n_a + n_b)) * (1.0 / n_a + 1.0 / n_b)) AS sd, 0.0 AS mean0 FROM a)""") +
    """SELECT {d} AS diff, {sd} AS sd, {lo} AS crit_low, {hi} AS crit_high, {b} AS type2, {pw} AS power FROM t""".format(
        d=r6("diff"), sd=r6("sd"), lo=r6(f"mean0 - {M.norm_ppf(0.975)!r}*sd"), hi=r6(f"mean0 + {M.norm_ppf(0.975)!r}*sd"),
        b=r6(f"{phi(f'((mean0 + {M.norm_ppf(0.975)!r}*sd) - diff)/sd')} - {phi(f'((mean0 - {M.norm_ppf(0.975)!r}*sd) - diff)/sd')}"),
        pw=r6(f"1 - ({phi(f'((mean0 + {M.norm_ppf(0.975)!r}*sd) - diff)/sd')} - {phi(f'((mean0 - {M.norm_ppf(0.975)!r}*sd) - diff)/sd')})")))
def m3_power_two_sample(spark, d):
    """M3, two samples: under H0 the difference is 0 with the pooled standard
    error; the alternative is the observed difference."""
    t = M.prop_ztest_2(enriched(spark, d, ["offer_accepted"]), "town", "offer_accepted", TOWN_A, TOWN_B)
    ph = (F.col("x_a") + F.col("x_b")) / (F.col("n_a") + F.col("n_b"))
    t = t.select((F.col("x_a") / F.col("n_a") - F.col("x_b") / F.col("n_b")).alias("diff"),
                 F.sqrt(ph * (1 - ph) * (1.0 / F.col("n_a") + 1.0 / F.col("n_b"))).alias("sd"), F.lit(0.0).alias("mean0"))
    return finish(M.power_table(t, "mean0", "sd", "diff").select("diff", "sd", "crit_low", "crit_high", "type2", "power"))


@register("m5_fwer", with_views("offers", "bureau", extra=TESTS_SQL) + f"""SELECT count(*) AS m, {r6('1 - pow(0.95, count(*))')} AS fwer,
  count_if(p_value < 0.05) AS n_raw_reject FROM tests WHERE p_value IS NOT NULL""")
def m5_fwer(spark, d):
    """M5: family-wise error of the segment tests at alpha 0.05, next to the
    number of unadjusted rejections."""
    t = seg_tests(spark, d).where(F.col("p_value").isNotNull())
    r = t.agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("p_value") < 0.05).alias("n_raw_reject"))
    return finish(r.withColumn("fwer", F.lit(1.0) - F.pow(F.lit(0.95), F.col("m").cast("double"))))
