"""Hand-sized cases for the semantic traps."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerplay.functions.formulas import norm_cdf_py, norm_ppf
from ledgerplay.operators import aggregates as G
from ledgerplay.operators import cashflow as C
from ledgerplay.operators import gamelog as GL
from ledgerplay.operators import stats as M
from ledgerplay.operators import windows as W


def test_last_offer_tie_takes_larger_key(spark):
    df = spark.createDataFrame([(1, "2020-01-02", 7), (1, "2020-01-02", 9), (1, "2019-01-01", 11)], "id int, d string, k int")
    r = W.latest_per_key(df, "id", "d", "k").collect()
    assert [(x.id, x.k) for x in r] == [(1, 9)]


def test_uncumulate(spark):
    df = spark.createDataFrame([(1, 10.0, 25.0, 25.0)], "id int, agg1 double, agg2 double, agg3 double")
    r = W.uncumulate_wide(df, "id", "agg", 3).orderBy("mob").collect()
    assert [x.paid for x in r] == [10.0, 15.0, 0.0]


def test_irr_hand_cases(spark):
    cf = spark.createDataFrame(
        [(1, 0, -100.0), (1, 1, 36.0), (1, 2, 36.0), (1, 3, 36.0), (2, 0, -100.0), (2, 1, 0.0), (2, 2, 0.0)],
        "loan_id int, period int, cf double")
    r = {x.loan_id: x.irr for x in C.loan_irr(cf).collect()}
    assert r[1] == pytest.approx(0.0394903, abs=1e-7)
    assert r[2] == -1.0


def test_npv_at_irr_is_zero(spark):
    cf = spark.createDataFrame([(1, 0, -1000.0), (1, 1, 300.0), (1, 3, 500.0), (1, 5, 400.0)], "loan_id int, period int, cf double")
    irr = C.loan_irr(cf).collect()[0].irr
    npv = -1000 + 300 / (1 + irr) + 500 / (1 + irr) ** 3 + 400 / (1 + irr) ** 5
    assert abs(npv) < 1e-6


def test_late_count(spark):
    loans = spark.createDataFrame([(1, 100.0)], "loan_id int, monthly_pmt double")
    pays = spark.createDataFrame([(1, 1, 95.0), (1, 2, 94.99)], "loan_id int, mob int, paid double")
    r = G.late_count(loans, pays, "loan_id", "monthly_pmt", 3).collect()
    assert r[0].n_late == 2


@pytest.mark.parametrize("n,expected_bin", [(10, 2), (11, 1)])
def test_qcut_edge_value(spark, n, expected_bin):
    df = spark.createDataFrame([(float(i),) for i in range(1, n + 1)], "x double")
    r = {x.x: x.bin for x in W.qcut(df, "x", 2).collect()}
    assert r[6.0] == expected_bin
    assert r[1.0] == 1


def test_step_up_and_bonferroni(spark):
    t = spark.createDataFrame([(1, 0.010), (2, 0.030), (3, 0.035), (4, 0.9)], "k int, p_value double")
    bh = {x.k: x.reject_bh for x in M.benjamini_hochberg(t, tie="k").collect()}
    assert bh == {1: True, 2: True, 3: True, 4: False}
    bf = {x.k: x.reject_bonf for x in M.bonferroni(t).collect()}
    assert bf == {1: True, 2: False, 3: False, 4: False}


def test_bh_contains_bonferroni(spark):
    rows = [(i, (i * 7919 % 1000) / 20000.0) for i in range(1, 60)]
    t = spark.createDataFrame(rows, "k int, p_value double")
    r = M.benjamini_hochberg(M.bonferroni(t), tie="k").collect()
    assert all(x.reject_bh for x in r if x.reject_bonf)


def test_fwer_and_critical_values():
    assert M.fwer(0.05, 100) == pytest.approx(0.994079, abs=1e-6)
    lo, hi = M.critical_values(0.0685, 0.00264)
    assert round(lo, 4) == 0.0633 and round(hi, 4) == 0.0737


def test_normal_closed_forms():
    assert norm_cdf_py(0.0) == pytest.approx(0.5, abs=1e-7)
    assert norm_cdf_py(1.959964) == pytest.approx(0.975, abs=1e-6)
    assert norm_ppf(0.975) == pytest.approx(1.959964, abs=1e-5)


def test_contest(spark):
    planets = spark.createDataFrame([(0, 0, 1, 1, 10), (0, 0, 2, 1, 10)], "game_id int, turn int, planet_id int, owner int, num_ships int")
    fleets = spark.createDataFrame([(0, 0, 1, 2, 7, 0), (0, 0, 2, 2, 10, 0)],
                                   "game_id int, turn int, destination_planet_id int, owner int, num_ships int, turns_remaining int")
    r = {x.planet_id: (x.owner, x.num_ships) for x in GL.contest_resolve(planets, fleets).collect()}
    assert r[1] == (1, 3)
    assert r[2] == (1, 0)


def test_greedy_fill(spark):
    s = spark.createDataFrame([(0, 1, 4), (0, 2, 4), (0, 3, 9)], "g int, o int, avail int")
    r = [x.give for x in GL.greedy_fill(s, ["g"], "o", "avail", F.lit(10)).orderBy("o").collect()]
    assert r == [4, 4, 2]


@pytest.mark.parametrize("x,w,expected", [([2.5, 7.5, 40], [10, 6, 4], 11.5), ([3, 8], [2.5, -2.5], None), ([-4, 12], [0, 0.25], 12.0)])
def test_weighted_mean(spark, x, w, expected):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, w)], "x double, w double")
    r = G.weighted_mean(df, "x", "w").collect()[0][0]
    assert (r is None and expected is None) or r == pytest.approx(expected)


def test_skewness_is_bias_corrected(spark):
    vals = [1.0, 2.0, 2.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = G.skewness_g1(df, "x").collect()[0].skew
    n = len(vals)
    m = sum(vals) / n
    m2 = sum((v - m) ** 2 for v in vals) / n
    m3 = sum((v - m) ** 3 for v in vals) / n
    g1 = m3 / m2 ** 1.5
    assert r == pytest.approx(g1 * math.sqrt(n * (n - 1)) / (n - 2))


def test_auc_perfect_and_random(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)], "y int, s double")
    assert W.auc(df, "y", "s").collect()[0].auc == pytest.approx(1.0)
    df2 = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, s double")
    assert W.auc(df2, "y", "s").collect()[0].auc == pytest.approx(0.5)


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 20.0), (4, 30.0)], "k int, v double")
    r = {x.k: x.rank for x in W.average_rank(df, "v").collect()}
    assert r == {1: 1.0, 2: 2.5, 3: 2.5, 4: 4.0}


def test_upper_tail_keeps_its_digits(spark):
    from pyspark.sql import functions as F
    from ledgerplay.operators.stats import p_value
    r = spark.createDataFrame([(9.0,), (-9.0,)], "z double").select(p_value(F.col("z")).alias("two"), p_value(F.col("z"), "larger").alias("up")).collect()
    assert all(abs(x.two / 2.2571768e-19 - 1) < 0.01 for x in r)
    assert abs(r[0].up / 1.1285884e-19 - 1) < 0.01 and r[1].up == 1.0


def test_r2_of_a_shifted_target(spark):
    from pyspark.sql import functions as F
    from ledgerplay.operators.aggregates import r2
    rows = [(float(i % 7), float(i % 7) + (0.01 if i % 2 else -0.01)) for i in range(700)]
    df = spark.createDataFrame(rows, "y double, p double")
    a = r2(df, "y", "p").first().r2
    b = r2(df.select((F.col("y") + 1e6).alias("y"), (F.col("p") + 1e6).alias("p")), "y", "p").first().r2
    assert a < 1 and abs(a - b) < 1e-6


def test_portable_hash_spreads_keys(spark):
    from pyspark.sql import functions as F
    from ledgerplay.functions.formulas import unit_hash
    from ledgerplay.operators.stats import draw_index_sql
    h = spark.range(200_000).select(unit_hash("id").alias("h"), unit_hash("id", 1).alias("g"))
    r = h.agg(F.countDistinct("h").alias("n"), F.avg("h").alias("m"), F.corr("h", "g").alias("c"), F.max("h").alias("x")).first()
    assert r.n > 199_000 and abs(r.m - 0.5) < 0.01 and abs(r.c) < 0.02 and r.x < 1
    d = spark.range(300_000).select(F.expr(draw_index_sql("id % 3", "id div 3", "5000000")).alias("d")).agg(F.countDistinct("d").alias("n"), F.max("d").alias("x")).first()
    assert d.n > 285_000 and d.x < 5_000_000


def test_high_irr_has_a_root(spark):
    from ledgerplay.operators.cashflow import loan_irr
    cf = spark.createDataFrame([(1, 0, -100.0), (1, 1, 2000.0)], "loan_id long, period int, cf double")
    assert abs(loan_irr(cf).first().irr - 19.0) < 1e-9


def test_samples_without_values(spark):
    from ledgerplay.operators.aggregates import box_stats
    from ledgerplay.operators.clean import count_outliers, drop_iqr_outliers
    from ledgerplay.operators.stats import ks_2samp
    df = spark.createDataFrame([("a", 1.0, None), ("a", 2.0, None)], "g string, v double, nothing double")
    assert ks_2samp(df, "g", "v", "a", "b").first().p_value is None
    assert box_stats(df, "nothing").first().n_outliers == 0
    assert drop_iqr_outliers(df, "nothing").count() == 2
    assert count_outliers(df, "nothing", log=False).first().n_low == 0
