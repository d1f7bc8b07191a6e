"""Invariants on the small test tables."""

import pytest
from pyspark.sql import functions as F

from ledgerplay.operators import aggregates as G
from ledgerplay.operators import portfolio as PF
from ledgerplay.operators import windows as W
from ledgerplay.operators.prefix import exact_quantiles, prefix_agg
from ledgerplay.plans import bindings as B
from tests.conftest import SF_SMALL


def test_running_sums_end_at_totals(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    cum = prefix_agg(o, "o_orderkey", ["o_totalprice"], n_buckets=7)
    last = cum.orderBy(F.col("o_orderkey").desc()).first()["o_totalprice_cum"]
    total = o.agg(F.sum("o_totalprice")).first()[0]
    assert last == pytest.approx(total)
    # running sums are non-decreasing for non-negative values
    rows = [r["o_totalprice_cum"] for r in cum.orderBy("o_orderkey").collect()]
    assert all(a <= b + 1e-6 for a, b in zip(rows, rows[1:]))


def test_prefix_matches_plain_window_with_ties(spark):
    df = spark.createDataFrame([(i, float(i % 5), float(i)) for i in range(200)], "k int, s double, v double")
    a = {r.k: r.v_cum for r in prefix_agg(df, "s", ["v"], tie_cols=["k"], n_buckets=3).collect()}
    from pyspark.sql import Window
    w = Window.orderBy("s", "k").rowsBetween(Window.unboundedPreceding, 0)
    b = {r.k: r.c for r in df.withColumn("c", F.sum("v").over(w)).collect()}
    assert a == pytest.approx(b)


def test_quantiles_match_sorted_list(spark):
    vals = [float((i * 37) % 101) for i in range(1, 250)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    n = len(s)

    def q(p):
        pos = p * (n - 1)
        lo = int(pos)
        hi = min(lo + 1, n - 1)
        return s[lo] + (pos - lo) * (s[hi] - s[lo])
    got = exact_quantiles(df, "x", [0.0, 0.1, 0.33, 0.5, 0.9, 1.0])
    assert got == pytest.approx([q(p) for p in [0.0, 0.1, 0.33, 0.5, 0.9, 1.0]])


def test_shares_sum_to_one(spark):
    o = B.offers(spark, SF_SMALL)
    assert G.value_shares(o, "occupation").agg(F.sum("share")).first()[0] == pytest.approx(1.0)
    by = G.value_shares(o, "occupation", by=["offer_accepted"]).groupBy("offer_accepted").agg(F.sum("share").alias("s"))
    assert all(r.s == pytest.approx(1.0) for r in by.collect())


def test_roc_ends_at_one(spark):
    o = B.offers(spark, SF_SMALL).withColumn("y", F.col("offer_accepted").cast("int"))
    roc = W.roc_curve(o, "y", "requested_amount")
    last = roc.orderBy("threshold").first()
    assert last.tpr == pytest.approx(1.0) and last.fpr == pytest.approx(1.0)


def test_top_by_volume_share(spark):
    l = B.loans(spark, SF_SMALL)
    top = W.top_by_volume(l, "loan_amnt", "loan_amnt", 0.2, "loan_id")
    total = l.agg(F.sum("loan_amnt")).first()[0]
    chosen = top.agg(F.sum("loan_amnt"), F.min("loan_amnt")).first()
    rest_max = l.join(top.select("loan_id"), "loan_id", "left_anti").agg(F.max("loan_amnt")).first()[0]
    assert chosen[0] >= 0.2 * total and chosen[0] - chosen[1] < 0.2 * total
    assert rest_max <= chosen[1]


def test_pareto_points_not_dominated(spark):
    pts = spark.createDataFrame([(1, 10.0, 0.05), (2, 8.0, 0.07), (3, 9.0, 0.04), (4, 5.0, 0.09), (5, 4.0, 0.08)],
                                "k int, volume double, irr double")
    front = {r.k for r in PF.pareto_front(pts, "volume", "irr").collect()}
    assert front == {1, 2, 4}


def test_stratified_split_keeps_class_share(spark):
    from ledgerplay.operators.features import split_stratified
    o = B.offers(spark, SF_SMALL).select("offer_key", "offer_accepted")
    s = split_stratified(o, "offer_accepted", "offer_key", 0.75)
    t = s.groupBy("set").agg(F.avg(F.col("offer_accepted").cast("double")).alias("r")).collect()
    r = {x.set: x.r for x in t}
    assert r["train"] == pytest.approx(r["test"], abs=0.01)


def test_same_seed_same_clusters(spark):
    from ledgerplay.operators.models import kmeans_twice_agree
    h = B.houses(spark, SF_SMALL)
    assert kmeans_twice_agree(h, ["SalePrice", "GrLivArea"], 3, 5, "Id").first().n_differ == 0
