"""Fits from distributed sums against numpy, and their defined failures."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerplay.operators import linear as L
from ledgerplay.operators import portfolio
from ledgerplay.operators.aggregates import kde_grid
from ledgerplay.operators.features import one_hot
from ledgerplay.operators.portfolio import best_feasible_selection
from ledgerplay.operators.prefix import prefix_agg


@pytest.fixture(scope="module")
def points(spark):
    g = np.random.default_rng(3)
    a, b = g.normal(size=600), g.normal(size=600)
    c = 0.5 * a + g.normal(size=600)
    y = 3 + 2 * a - b + 0.2 * c + g.normal(size=600)
    rows = [tuple(map(float, r)) for r in zip(a, b, c, y, (y + g.normal(size=600) > 3).astype(float), 1 + (np.arange(600) % 3))]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, f double, w double"), np.array(rows)


def student_tail(t, v):
    x = np.linspace(0, abs(t), 200_001)
    f = (1 + x * x / v) ** (-(v + 1) / 2)
    inside = np.trapezoid(f, x) * math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
    return 1 - 2 * inside


@pytest.mark.parametrize("offset,parts", [(0.0, 1), (1e9, 5), (0.0, 70)])
def test_least_squares_equals_numpy(points, offset, parts):
    df, m = points
    x = np.column_stack([np.ones(len(m)), m[:, :3]])
    beta, *_ = np.linalg.lstsq(x, m[:, 3], rcond=None)
    res = m[:, 3] - x @ beta
    se = np.sqrt(np.diag(res @ res / (len(m) - 4) * np.linalg.inv(x.T @ x)))
    moved = df.repartition(parts).withColumns({c: F.col(c) + offset for c in "abc"})
    got = {r["term"]: r for r in L.least_squares(moved, "y", ["a", "b", "c"]).collect()}
    for k, name in enumerate(["a", "b", "c"], 1):
        tol = 1e-6 if offset else 1e-9
        assert got[name]["coef"] == pytest.approx(beta[k], abs=tol) and got[name]["se"] == pytest.approx(se[k], rel=1e-5)
        assert got[name]["p"] == pytest.approx(student_tail(beta[k] / se[k], len(m) - 4), abs=1e-7)
    assert got["a"]["n"] == 600 and got["a"]["r2"] == pytest.approx(1 - res @ res / ((m[:, 3] - m[:, 3].mean()) ** 2).sum())
    if not offset:
        assert got["intercept"]["coef"] == pytest.approx(beta[0], abs=1e-9) and got["intercept"]["se"] == pytest.approx(se[0], rel=1e-9)


def test_least_squares_passes_over_splits_without_rows(spark):
    """A file with fewer row groups than splits gives tasks without rows."""
    df = spark.range(0, 400, 1, 4).where("id >= 250").selectExpr("sin(id) AS a", "id % 7 AS b", "3 + 2 * sin(id) - id % 7 + cos(5 * id) AS y")
    got, want = ({r["term"]: r for r in L.least_squares(d, "y", ["a", "b"]).collect()} for d in (df, df.coalesce(1)))
    assert all(got[t]["n"] == 150 and got[t]["coef"] == pytest.approx(want[t]["coef"]) and got[t]["se"] == pytest.approx(want[t]["se"]) for t in want)


def test_student_tails(spark):
    cases = [(t, v) for t in (0.0, 0.3, 1.0, 2.5, 8.0) for v in (1.0, 2.0, 7.0, 40.0, 5000.0)]
    for r in spark.createDataFrame(cases, "t double, v double").withColumn("p", L.t_two_sided(F.col("t"), F.col("v"))).collect():
        want = 1 - 2 * math.atan(r.t) / math.pi if r.v == 1 else student_tail(r.t, r.v)
        assert r.p == pytest.approx(want, abs=1e-8)


def test_undetermined_fits_raise(spark, points):
    df, _ = points
    with pytest.raises(ValueError):
        L.least_squares(df.limit(0), "y", ["a"])
    with pytest.raises(ValueError):
        L.least_squares(df.withColumn("twice", 2 * F.col("a")), "y", ["a", "twice"])
    with pytest.raises(ValueError):
        L.first_axis(df.withColumn("one", F.lit(1.0)), ["a", "one"])
    with pytest.raises(ValueError):
        L.logistic(df.where("a IS NULL"), "f", ["a"])


def test_lasso_meets_its_conditions(points):
    df, m = points
    for standardized in (True, False):
        for alpha in (0.0, 0.1, 0.5, 50.0):
            rows = L.lasso(df, "y", ["a", "b", "c"], alpha, standardized).collect()
            assert all(r["optimal"] for r in rows)
            if alpha == 50.0:
                assert all(r["coef"] == 0 for r in rows if r["term"] != "intercept")
            if alpha == 0 and not standardized:
                beta, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(m)), m[:, :3]]), m[:, 3], rcond=None)
                assert [r["coef"] for r in rows] == pytest.approx(list(beta), abs=1e-8)


def test_logistic_solves_its_equations(points):
    df, m = points
    for weight in (None, "w"):
        model = L.logistic(df, "f", ["a", "b"], weight)
        z = np.column_stack([np.ones(len(m)), *[(m[:, i] - m[:, i].mean()) / m[:, i].std(ddof=1) for i in (0, 1)]])
        mu = 1 / (1 + np.exp(-z @ np.array([model["intercept"], model["a"], model["b"]])))
        assert np.abs(z.T @ ((m[:, 5] if weight else 1.0) * (m[:, 4] - mu))).max() < 1e-6
        assert [r.p for r in df.select(L.probability(model, ["a", "b"]).alias("p")).collect()] == pytest.approx(list(mu), abs=1e-9)
    leak = df.withColumn("leak", 5 * F.col("f") + F.col("b"))
    rows = [(r["model"], r["term"], r["rank"]) for r in L.leak_check(leak, "f", ["a", "leak"]).collect()]
    assert ("all", "leak", 1) in rows and ("without leak", "a", 1) in rows and not any(m == "without leak" and t == "leak" for m, t, _ in rows)
    same = L.agreement(df, F.col("a"), 2 * F.col("a") + 1, 0.5).first()
    assert same["spearman"] == pytest.approx(1.0) and same["n"] == 600


def test_first_axis_equals_eigenvector(points):
    df, m = points
    _, v = np.linalg.eigh(np.corrcoef(m[:, :3].T))
    want = v[:, -1] * np.sign(v[0, -1])
    assert L.first_axis(df, ["a", "b", "c"])[2] == pytest.approx(want, abs=1e-9)


def test_density_equals_the_direct_sum_also_with_an_outlier(spark):
    g = np.random.default_rng(1)
    x = np.append(g.normal(100, 30, 3000), [1e12, -1e9])
    grid = [float(v) for v in range(0, 260, 20)]
    df = spark.createDataFrame([("a" if i % 2 else None, float(v)) for i, v in enumerate(x)] + [("a", None)], "g string, x double")
    got = {(r.g, r.x): r.density for r in kde_grid(df, "x", grid, 7.0, ["g"]).collect()}
    for name, part in (("a", x[1::2]), (None, x[0::2])):
        for p in grid:
            want = np.exp(-0.5 * ((p - part) / 7.0) ** 2).sum() / (len(part) * 7.0 * math.sqrt(2 * math.pi))
            assert got[name, p] == pytest.approx(want, rel=1e-6, abs=1e-15)


def test_categories_come_from_the_data(spark):
    df = spark.createDataFrame([(1, "x"), (2, "new"), (3, None)], "k int, c string")
    assert {tuple(r) for r in one_hot(df, "c").select("k", "c_new", "c_x").collect()} == {(1, 0, 1), (2, 1, 0), (3, 0, 0)}


def test_selection_meets_its_guards_and_rounds_do_not_lose(spark):
    g = np.random.default_rng(5)
    rate = g.normal(size=400)
    rows = [(i, float(r + 0.3 * e), 1.0, float(r), float(f)) for i, (r, e, f) in enumerate(zip(rate, g.normal(size=400), g.normal(size=400) - rate))]
    df = spark.createDataFrame(rows, "loan_id long, score double, amount double, rate double, fico double")
    pool = df.agg(F.avg("rate"), F.avg("fico"), F.avg("score")).first()
    seen = []
    for rounds in (1, 3):
        s = best_feasible_selection(df, "score", "amount", 0.25, {"rate": -1, "fico": 1}, [0.0, 1.0, 2.0], rounds).agg(F.avg("rate"), F.avg("fico"), F.avg("score"), F.count("*")).first()
        assert s[0] <= pool[0] and s[1] >= pool[1] and s[3] == 100 and s[2] > pool[2]
        seen.append(s[2])
    assert seen[1] >= seen[0]
    assert best_feasible_selection(df, "score", "amount", 0.25, {"rate": -1, "fico": 1}, [0.0], 1).count() == 0  # greedy by score alone breaks a guard


def _best_by_sorting(rows, share, signs, mus):
    """Every combination sorted whole: (combination, keys of its selection) of the best feasible one."""
    m = np.array([r[1:2] + r[3:] for r in rows], dtype=float)
    z = (m - m.mean(0)) / np.where(m.std(0) == 0, 1, m.std(0))
    best = None
    for mu in itertools.product(mus, repeat=len(signs)):
        pen = z[:, 0]
        for k, (w, s) in enumerate(zip(mu, signs), 1):
            pen = pen + w * s * z[:, k]
        order = sorted(range(len(rows)), key=lambda i: (-pen[i], rows[i][0]))
        amounts = np.array([rows[i][2] for i in order])
        taken = [i for i, before in zip(order, np.cumsum(amounts) - amounts) if before < share * amounts.sum()]
        mean = m[taken].mean(0)
        if all(s * (mean[k] - m[:, k].mean()) >= -1e-12 for k, s in enumerate(signs, 1)) and (best is None or mean[0] > best[2] + 1e-12):
            best = (mu, {rows[i][0] for i in taken}, mean[0])
    return best[:2]


@pytest.mark.parametrize("kind", ["plain", "one score", "outlier", "negative amounts"])
def test_selection_equals_sorting_every_combination(spark, monkeypatch, kind):
    """And puts in order far fewer rows than combinations x rows, unless volumes can fall again."""
    g = np.random.default_rng(8)
    score = np.full(600, 2.0) if kind == "one score" else np.where(np.arange(600) == 7, 1e9, g.normal(size=600)) if kind == "outlier" else g.integers(0, 40, 600) / 4
    amount = g.integers(-3 if kind == "negative amounts" else 1, 50, 600)
    same = kind == "one score"
    rows = [(int(k), float(s), float(a), 1.0 if same else float(r), 1.0 if same else float(f)) for k, s, a, r, f in
            zip(g.permutation(600) * 3 - 500, score, amount, g.integers(0, 8, 600), g.integers(0, 90, 600))]
    df = spark.createDataFrame(rows, "loan_id long, score double, amount double, rate double, fico double").repartition(3)
    ordered = []
    monkeypatch.setattr(portfolio, "prefix_agg", lambda d, *a, **k: ordered.append(d.count()) or prefix_agg(d, *a, **k))
    got = best_feasible_selection(df, "score", "amount", 0.3, {"rate": -1, "fico": 1}, [0.0, 0.5, 2.0]).collect()
    mu, keys = _best_by_sorting(rows, 0.3, (-1, 1), [0.0, 0.5, 2.0])
    assert {r["loan_id"] for r in got} == keys and len(got) == len(keys) and {(r["mu_rate"], r["mu_fico"]) for r in got} == {mu}
    assert kind == "negative amounts" or sum(ordered) <= 0.25 * 600


def test_first_axis_of_hardly_correlated_columns(spark):
    """Largest roots 1.0005 and 1: plain power steps would need thousands."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(400, 3))
    x -= x.mean(0)
    x = x @ np.linalg.inv(np.linalg.cholesky(np.cov(x.T))).T  # exactly uncorrelated
    x = x @ np.linalg.cholesky(np.array([[1, 0.0005, 0], [0.0005, 1, 0], [0, 0, 1]])).T
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    assert L.first_axis(df, ["a", "b", "c"])[2] == pytest.approx([np.sqrt(0.5), np.sqrt(0.5), 0.0], abs=1e-6)
