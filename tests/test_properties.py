"""Randomised checks (hypothesis): the distributed running totals and
quantiles equal a direct computation on random data with ties and NULLs."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerplay.operators.aggregates import group_stat, value_shares
from ledgerplay.operators.features import split_stratified
from ledgerplay.operators.gamelog import rank_standings
from ledgerplay.operators.portfolio import balance_selection
from ledgerplay.operators.prefix import exact_quantiles, prefix_agg, range_parts
from ledgerplay.operators.stats import benjamini_hochberg
from ledgerplay.operators.windows import ordinal_encode, top_by_volume

VALUES = st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=120)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=VALUES, buckets=st.integers(1, 9), desc=st.booleans())
def test_prefix_equals_window(spark, vals, buckets, desc):
    rows = [(i, v, float(i % 7)) for i, v in enumerate(vals) if v is not None]
    if not rows:
        return
    df = spark.createDataFrame(rows, "k int, s double, v double")
    got = {r.k: r.v_cum for r in prefix_agg(df, "s", ["v"], desc=desc, tie_cols=["k"], n_buckets=buckets).collect()}
    o = F.col("s").desc() if desc else F.col("s").asc()
    w = Window.orderBy(o, F.col("k")).rowsBetween(Window.unboundedPreceding, 0)
    want = {r.k: r.c for r in df.withColumn("c", F.sum("v").over(w)).collect()}
    assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=VALUES, qs=st.lists(st.floats(0, 1), min_size=1, max_size=5))
def test_quantiles_equal_sorted_interpolation(spark, vals, qs):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(v for v in vals if v is not None)
    got = exact_quantiles(df, "x", qs)
    for q, g in zip(qs, got):
        if not s:
            assert g is None
            continue
        pos = q * (len(s) - 1)
        lo = math.floor(pos)
        hi = min(lo + 1, len(s) - 1)
        assert abs(g - (s[lo] + (pos - lo) * (s[hi] - s[lo]))) < 1e-9


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=VALUES, buckets=st.integers(2, 9))
def test_prefix_with_null_groups_and_null_keys_equals_window(spark, vals, buckets):
    rows = [(i, ("a", "b", None)[i % 3], v, float(i % 7)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k int, g string, s double, v double")
    got = {r.k: r.v_cum for r in prefix_agg(df, "s", ["v"], tie_cols=["k"], n_buckets=buckets, by=["g"]).collect()}
    w = Window.partitionBy("g").orderBy(F.col("s").asc_nulls_last(), "k").rowsBetween(Window.unboundedPreceding, 0)
    assert got == {r.k: r.c for r in df.withColumn("c", F.sum("v").over(w)).collect()}


def test_null_is_a_group_of_its_own(spark):
    df = spark.createDataFrame([(i, ("a", None)[i % 2], float(i)) for i in range(40)], "k int, g string, x double")
    assert {(r.g, r.n, r.median) for r in group_stat(df, "g", "x", "median").collect()} == {("a", 20, 19.0), (None, 20, 20.0)}
    assert {(r.g, r.set, r["count"]) for r in split_stratified(df, "g", "k").groupBy("g", "set").count().collect()} == {
        (g, t, n) for g in ("a", None) for t, n in (("train", 15), ("test", 5))}
    assert balance_selection(df.withColumn("one", F.lit(1.0)), ["g"], "x", "one", 0.5, key="k").groupBy("g").count().count() == 2
    assert {(r.g, r.share) for r in value_shares(df.withColumn("c", F.lit("c")), "c", by=["g"]).collect()} == {("a", 1.0), (None, 1.0)}


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(200, 2000), parts=st.integers(4, 12), desc=st.booleans())
def test_one_value_with_nine_tenths_of_the_rows_is_spread(spark, n, parts, desc):
    df = spark.range(n).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("v"), F.col("id").cast("string"))).otherwise("hot").alias("s"),
                               F.lit("one").alias("g"), (F.col("id") % 7).cast("double").alias("v"))
    got = {r.id: (r.v_cum, r.v_all) for r in prefix_agg(df, "s", ["v"], desc=desc, tie_cols=["id"], by=["g"], n_buckets=parts, total_suffix="_all").collect()}
    w = Window.partitionBy("g").orderBy(F.col("s").desc() if desc else F.col("s"), "id")
    want = df.withColumns({"c": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), "t": F.sum("v").over(Window.partitionBy("g"))}).collect()
    assert got == {r.id: (r.c, r.t) for r in want}
    order = [F.col("s").desc() if desc else F.col("s"), F.col("id")]
    largest = range_parts(df, order, ["g"], parts).groupBy("__range_part").count().agg(F.max("count")).first()[0]
    assert largest < 0.6 * n  # all rows of the hot value in one task would be 0.9 * n


def test_volume_of_one_score_is_cut_inside_it(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, 5.0).otherwise(F.col("id").cast("double") / 1000).alias("score"), F.lit(1.0).alias("amount"))
    got = {r.id for r in top_by_volume(df, "score", "amount", 0.5, "id").collect()}
    assert got == set(range(500))


def test_ordered_keys_keep_their_type(spark):
    big = 2 ** 60
    df = spark.createDataFrame([(big + i, f"k{i:03d}", 1.0) for i in range(300)], "k long, s string, v double").repartition(7)
    assert {r.k - big: r.v_cum for r in prefix_agg(df, "k", ["v"]).collect()} == {i: i + 1.0 for i in range(300)}
    assert {r.s: r.s_code for r in ordinal_encode(df, "s").collect()} == {f"k{i:03d}": i for i in range(300)}
    ranks = rank_standings(df.select(F.col("s").alias("player_name"), (F.col("k") - big).cast("double").alias("points")))
    assert {r.player_name: r["rank"] for r in ranks.collect()} == {f"k{i:03d}": 300 - i for i in range(300)}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ps=st.lists(st.sampled_from([0.0, 0.001, 0.01, 0.02, 0.04, 0.2, 0.5, 1.0]), min_size=1, max_size=40))
def test_step_up_equals_its_definition(spark, ps):
    got = {(r.a, r.b): (r.reject_bh, r.p_adj_bh) for r in benjamini_hochberg(
        spark.createDataFrame([(i % 3, i, p) for i, p in enumerate(ps)], "a int, b int, p_value double"), tie=["a", "b"]).collect()}
    order = sorted(range(len(ps)), key=lambda i: (ps[i], i % 3, i))
    m = len(ps)
    k = max([j + 1 for j, i in enumerate(order) if ps[i] <= (j + 1) / m * 0.05], default=0)
    for j, i in enumerate(order):
        adjusted = min([1.0, *(ps[order[x]] * m / (x + 1) for x in range(j, m))])
        assert got[(i % 3, i)][0] == (j < k) and abs(got[(i % 3, i)][1] - adjusted) < 1e-12
