"""Linear models from distributed sums.

The table is reduced to a matrix whose size depends on the number of columns only
(a QR factor, centred moments, or weighted normal equations of one Newton step); the
small system is then solved on the driver.  Rows never leave their tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerplay.operators.stats import let
from ledgerplay.operators.windows import spearman
from ledgerplay.session import cut_lineage

MERGE = 64  # QR factors merged by one task
BETA_TERMS = 300  # terms of the continued fraction


def _complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()


# --- least squares by a tall-skinny QR ---------------------------------------

def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def qr_factor(df: DataFrame, cols: Sequence[str], shift: Sequence[float]) -> np.ndarray:
    """R of the matrix [1, cols - shift]: every partition is factored on its own, and the
    factors are stacked and factored again, ``MERGE`` at a time, until one is left."""
    width = len(cols) + 1
    schema = "part long, r array<double>"

    def local(batches):
        r = np.zeros((0, width))
        for pdf in batches:
            x = pdf[list(cols)].to_numpy(dtype=float) - np.asarray(shift)
            r = _triangle(np.vstack([r, np.column_stack([np.ones(len(x)), x])]))
        if len(r):  # a split without rows has no factor (and an empty column no list type)
            yield pd.DataFrame({"part": [0] * len(r), "r": list(r)})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        r = _triangle(np.vstack(pdf["r"].to_list()))
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])] * len(r), "r": list(r)})

    factors = cut_lineage(df.mapInPandas(local, schema).withColumn("part", F.spark_partition_id().cast("long")))
    n = factors.agg(F.max("part")).first()[0] or 0
    while n > 0:
        factors = cut_lineage(factors.withColumn("part", F.expr(f"part div {MERGE}")).groupBy("part").applyInPandas(merge, schema))
        n //= MERGE
    rows = [r["r"] for r in factors.collect()]
    return _triangle(np.vstack([np.zeros((width, width)), *[np.asarray([r]) for r in rows]]))


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    tiny = 1e-300

    def fraction(p: Column, q: Column, z: Column) -> Column:
        keep = lambda v: F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)
        state = lambda c, d, h: F.struct(c.alias("c"), d.alias("d"), h.alias("h"))

        def step(s: Column, k: Column) -> Column:
            m = k.cast("double")
            even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
            odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))

            def half(old: Column, numerator: Column) -> Column:
                c, d = keep(1.0 + numerator / old["c"]), 1.0 / keep(1.0 + numerator * old["d"])
                return state(c, d, old["h"] * c * d)
            return let(half(s, even), lambda t: half(t, odd))
        d0 = 1.0 / keep(1.0 - (p + q) * z / (p + 1))
        return F.aggregate(F.sequence(F.lit(1), F.lit(BETA_TERMS)), state(F.lit(1.0), d0, d0), step)["h"]

    def value(p: Column, q: Column, z: Column) -> Column:
        log_gamma = lambda v: _log_gamma(v)
        front = F.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * F.log(z) + q * F.log(1.0 - z))
        return front * fraction(p, q, z) / p
    # the fraction converges fast below the mean; above it, by symmetry
    inner = F.when(x < (a + 1) / (a + b + 2), value(a, b, x)).otherwise(1.0 - value(b, a, 1.0 - x))
    return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).otherwise(inner)


def _log_gamma(v: Column) -> Column:
    """Stirling's series after shifting the argument above 10."""
    shift = F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda s, k: s + F.log(v + k))
    z = v + 10.0
    series = 1.0 / (12.0 * z) - 1.0 / (360.0 * z * z * z) + 1.0 / (1260.0 * F.pow(z, F.lit(5.0)))
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + series - shift


def t_two_sided(t: Column, dof: Column) -> Column:
    """Two-sided tail of Student's t."""
    return incomplete_beta(dof / 2.0, F.lit(0.5), dof / (dof + t * t))


def least_squares(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """One row per term (intercept first): coef, se, t, p (Student), r2, n.

    Columns are shifted by their means before the QR, so large offsets cost no digits.
    Collinear columns have no unique solution and raise an error."""
    cols = [*xs, y]
    d = _complete(df, cols)
    means = d.agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in cols]).first()
    n = means["n"]
    schema = "term string, coef double, se double, t double, dof double, r2 double, n long"
    if n <= len(xs) + 1:
        raise ValueError(f"{n} complete rows do not determine {len(xs) + 1} terms")
    r = qr_factor(d, cols, [means[c] for c in cols])
    p = len(xs) + 1
    size = np.abs(np.diag(r[:p, :p]))
    scale = np.sqrt(np.sum(r[:p, :p] ** 2, axis=0))  # each column's own length
    if (size <= 1e-10 * scale).any():
        raise ValueError("the regressors are collinear")
    inverse = np.linalg.inv(r[:p, :p])
    beta, sse = inverse @ r[:p, p], r[p, p] ** 2
    total = float(np.sum(r[1:, p] ** 2))
    at = np.array([1.0, *[-means[c] for c in xs]])  # the intercept undoes the shift
    coef = [means[y] + float(at @ beta), *map(float, beta[1:])]
    cov = sse / (n - p) * (inverse @ inverse.T)
    se = [float(np.sqrt(at @ cov @ at)), *map(float, np.sqrt(np.diag(cov)[1:]))]
    rows = [(t, c, s, c / s if s else None, float(n - p), float(1 - sse / total) if total else None, n) for t, c, s in zip(["intercept", *xs], coef, se)]
    out = df.sparkSession.createDataFrame(rows, schema)
    return out.withColumn("p", t_two_sided(F.col("t"), F.col("dof"))).drop("dof")


# --- centred moments: lasso and first principal axis --------------------------

def moments(df: DataFrame, cols: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of complete rows, means and covariance matrix (1/n) in one aggregate; the
    engine merges centred sums, so offsets cost no digits."""
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = _complete(df, cols).agg(F.count("*").alias("n"), *[F.avg(c) for c in cols], *[F.covar_pop(cols[i], cols[j]) for i, j in pairs]).first()
    if not row["n"]:
        raise ValueError("no complete row")
    cov = np.zeros((len(cols), len(cols)))
    for k, (i, j) in enumerate(pairs):
        cov[i, j] = cov[j, i] = row[1 + len(cols) + k]
    return row["n"], np.array(row[1:1 + len(cols)], dtype=float), cov


def lasso(df: DataFrame, y: str, xs: Sequence[str], alpha: float, standardized: bool = True, rounds: int = 1000) -> DataFrame:
    """Minimiser of mean squared error / 2 + alpha * sum |coef|, by coordinate descent
    on the moments: term, coef, gradient, optimal.

    ``standardized`` scales the columns to mean 0 and sample deviation 1 first.  ``gradient``
    is the covariance of column and residual: alpha * sign(coef), or at most alpha in
    size where the coefficient is 0; ``optimal`` tells that this holds."""
    n, mean, cov = moments(df, [*xs, y])
    p = len(xs)
    scale = np.sqrt(np.diag(cov)[:p] * n / max(1, n - 1)) if standardized else np.ones(p)
    if not scale.all():
        raise ValueError("a constant column cannot be standardised")
    a, c = cov[:p, :p] / np.outer(scale, scale), cov[:p, p] / scale
    b = np.zeros(p)
    for _ in range(rounds):
        before = b.copy()
        for j in range(p):
            rho = c[j] - a[j] @ b + a[j, j] * b[j]
            b[j] = np.sign(rho) * max(abs(rho) - alpha, 0.0) / a[j, j] if a[j, j] else 0.0
        if np.abs(b - before).max(initial=0.0) <= 1e-14 * np.abs(b).max(initial=1.0):
            break
    gradient = c - a @ b
    slack = 1e-6 * max(1.0, np.abs(c).max(initial=0.0))
    ok = np.where(b == 0, np.abs(gradient) <= alpha + slack, np.abs(gradient - alpha * np.sign(b)) <= slack)
    center = np.zeros(p) if not standardized else mean[:p]
    intercept = mean[p] - ((mean[:p] - center) / scale) @ b
    rows = [("intercept", float(intercept), 0.0, True)] + [(x, float(v), float(g), bool(o)) for x, v, g, o in zip(xs, b, gradient, ok)]
    return df.sparkSession.createDataFrame(rows, "term string, coef double, gradient double, optimal boolean")


def first_axis(df: DataFrame, cols: Sequence[str], rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, sample deviations and first principal axis of the standardised columns; first
    loading that is not 0 positive.

    Power iteration by squaring the correlation matrix: ``rounds`` squarings are 2^rounds steps,
    so columns that are hardly correlated (nearly equal axes) converge too."""
    n, mean, cov = moments(df, cols)
    dev = np.sqrt(np.diag(cov))
    if not dev.all():
        raise ValueError("a constant column has no correlation")
    power = cov / np.outer(dev, dev)
    for _ in range(rounds):
        power = power @ power
        power /= np.sqrt((power * power).sum())
    v = power @ np.arange(len(cols), 0, -1.0)
    v /= np.sqrt(v @ v)
    v *= np.sign(v[np.flatnonzero(np.abs(v) > 1e-12)[0]])
    return mean, dev * np.sqrt(n / max(1, n - 1)), v


def principal_first(df: DataFrame, cols: Sequence[str], out: str = "pc1") -> DataFrame:
    """Score of every complete row on the first principal axis."""
    mean, dev, v = first_axis(df, cols)
    score = sum(((F.col(c) - float(m)) / float(s) * float(w) for c, m, s, w in zip(cols, mean, dev, v)), F.lit(0.0))
    return df.dropna(subset=list(cols)).withColumn(out, score)


# --- logistic regression by reweighted least squares --------------------------

def logistic(df: DataFrame, y: str, xs: Sequence[str], weight: str | None = None, rounds: int = 50) -> dict[str, float]:
    """Unpenalised (weighted) logistic regression on standardised columns.

    Every Newton step is one aggregate of the weighted normal equations; their size depends
    on the number of columns only.  Returns the terms (intercept and per deviation)
    and, as ``mean <col>`` and ``dev <col>``, the scaling."""
    cols = [*xs, y, *([weight] if weight else [])]
    d = cut_lineage(_complete(df, cols))
    st = d.agg(*[F.avg(x) for x in xs], *[F.stddev_samp(x) for x in xs]).first()
    mean, dev = st[:len(xs)], st[len(xs):]
    if not all(dev):
        raise ValueError("a constant column (or fewer than two rows) cannot be standardised")
    z = [F.lit(1.0), *[(F.col(x) - m) / s for x, m, s in zip(xs, mean, dev)]]
    w = F.col(weight) if weight else F.lit(1.0)
    p, beta = len(z), np.zeros(len(z))
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    rows = d.select(*[c.alias(f"z{i}") for i, c in enumerate(z)], F.col(y).alias("y"), w.alias("w"))
    for _ in range(rounds):
        mu = 1.0 / (1.0 + F.exp(-sum((F.col(f"z{i}") * float(b) for i, b in enumerate(beta)), F.lit(0.0))))
        step = rows.withColumn("mu", mu).withColumns({"e": F.col("w") * (F.col("y") - F.col("mu")), "v": F.col("w") * F.col("mu") * (1 - F.col("mu"))})
        sums = step.agg(*[F.sum(F.col("e") * F.col(f"z{i}")) for i in range(p)], *[F.sum(F.col("v") * F.col(f"z{i}") * F.col(f"z{j}")) for i, j in pairs]).first()
        hessian = np.zeros((p, p))
        for k, (i, j) in enumerate(pairs):
            hessian[i, j] = hessian[j, i] = sums[p + k]
        move = np.linalg.solve(hessian, np.array(sums[:p], dtype=float))
        beta = beta + move
        if np.abs(move).max() < 1e-12:
            break
    return {"intercept": float(beta[0]), **{x: float(b) for x, b in zip(xs, beta[1:])}, **{f"mean {x}": m for x, m in zip(xs, mean)}, **{f"dev {x}": s for x, s in zip(xs, dev)}}


def probability(model: dict[str, float], xs: Sequence[str]) -> Column:
    """Probability of class 1 of a row (NULL where a column is NULL)."""
    score = sum((F.lit(model[x]) * (F.col(x) - model[f"mean {x}"]) / model[f"dev {x}"] for x in xs), F.lit(model["intercept"]))
    return 1.0 / (1.0 + F.exp(-score))


def leak_check(df: DataFrame, y: str, xs: Sequence[str], weight: str | None = None) -> DataFrame:
    """Coefficients by size, then those of a refit without the largest one (the
    suspected leak): model ('all' or 'without <col>'), term, coef, rank."""
    full = logistic(df, y, xs, weight)
    leak = max(xs, key=lambda x: (abs(full[x]), x))
    rest = [x for x in xs if x != leak]
    refit = logistic(df, y, rest, weight)
    rows = []
    for name, model, terms in (("all", full, xs), (f"without {leak}", refit, rest)):
        order = sorted(terms, key=lambda x: (-abs(model[x]), x))
        rows += [(name, t, model[t], order.index(t) + 1 if t in order else 0) for t in ["intercept", *terms]]
    return df.sparkSession.createDataFrame(rows, "model string, term string, coef double, rank int")


def agreement(df: DataFrame, a: Column, b: Column, threshold: float = 0.5) -> DataFrame:
    """Do two models agree? Spearman correlation of their probabilities, rows, and rows
    whose thresholded labels differ."""
    p = cut_lineage(df.select(a.alias("a"), b.alias("b")).dropna())
    one = p.agg(F.count("*").alias("n"), F.count_if((F.col("a") >= threshold) != (F.col("b") >= threshold)).alias("n_differ")).first()
    return spearman(p, "a", "b").withColumns({"n": F.lit(one["n"]).cast("long"), "n_differ": F.lit(one["n_differ"]).cast("long")})
