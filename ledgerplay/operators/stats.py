"""Statistical tests.

Tests run on aggregated rows: one pass of conditional sums produces the counts,
and z, p and power are column arithmetic with the shared closed-form normal
CDF - one job for any number of segments, no Python loop over groups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerplay.functions.formulas import hash31_sql, norm_ppf
from ledgerplay.operators.prefix import grouped_quantiles, join_null_safe, prefix_agg


def p_value(z: Column, alternative: str = "two-sided") -> Column:
    if alternative == "two-sided":
        return F.lit(2.0) * norm_cdf_col(-F.abs(z))  # not 1 - cdf, which is 0 far out
    if alternative == "larger":
        return norm_cdf_col(-z)
    if alternative == "smaller":
        return norm_cdf_col(z)
    raise ValueError(alternative)


def norm_cdf_col(c: Column) -> Column:
    """Phi of an arbitrary Column."""
    return _phi(c)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once and named: expressions that need it many
    times stay small when the optimizer moves them (a filter on p would repeat all of z)."""
    return F.transform(F.array(value), use)[0]


def _phi(c: Column) -> Column:
    # erfc Chebyshev fit with the argument as a Column
    from ledgerplay.functions.formulas import ERFC_COEFFS

    def tail(z: Column) -> Column:
        def fit(t: Column) -> Column:
            poly = F.lit(ERFC_COEFFS[-1])
            for k in reversed(ERFC_COEFFS[:-1]):
                poly = F.lit(k) + t * poly
            return t * F.exp(-z * z + poly)
        return let(1.0 / (1.0 + 0.5 * z), fit)

    def signed(x: Column) -> Column:
        return let(tail(F.abs(x) / math.sqrt(2.0)), lambda e: F.when(x.isNull(), None).when(x >= 0, 1.0 - 0.5 * e).otherwise(0.5 * e))
    return let(c, signed)


def prop_ztest_1(df: DataFrame, flag: str, p0: float, alternative: str = "two-sided",
                 prop_var: str = "sample", by: Sequence[str] = ()) -> DataFrame:
    """M1: one-sample proportion z test (variance from the sample or from p0)."""
    agg = df.groupBy(*by).agg(F.sum(F.col(flag).cast("int")).cast("double").alias("x"), F.count(F.lit(1)).alias("n"))
    p = F.col("x") / F.col("n")
    v = p * (1 - p) / F.col("n") if prop_var == "sample" else F.lit(p0 * (1 - p0)) / F.col("n")
    z = F.when(v > 0, (p - p0) / F.sqrt(v))
    return agg.withColumn("p_hat", p).withColumn("z", z).withColumn("p_value", p_value(F.col("z"), alternative))


def two_sample(df: DataFrame, n1: Column, x1: Column, n2: Column, x2: Column, alternative: str = "two-sided") -> DataFrame:
    """Pooled two-sample z and p; NULL when a count or the variance is 0.

    z is materialised before p so the CDF formula references a column, not
    the whole z expression (keeps generated code small).
    """
    p1, p2 = x1 / n1, x2 / n2
    ph = (x1 + x2) / (n1 + n2)
    var = ph * (1 - ph) * (1.0 / n1 + 1.0 / n2)
    z = F.when((n1 > 0) & (n2 > 0) & (var > 0), (p1 - p2) / F.sqrt(var))
    out = df.withColumns({"rate_a": p1, "rate_b": p2, "z": z})
    return out.withColumn("p_value", p_value(F.col("z"), alternative))


def prop_ztest_2(df: DataFrame, group: str, flag: str, a, b, alternative: str = "two-sided",
                 by: Sequence[str] = ()) -> DataFrame:
    """M2: pooled two-sample test of group a against group b (per ``by``)."""
    g, f = F.col(group), F.col(flag).cast("int")
    agg = df.groupBy(*by).agg(
        F.count_if(g == a).cast("double").alias("n_a"), F.sum(F.when(g == a, f)).cast("double").alias("x_a"),
        F.count_if(g == b).cast("double").alias("n_b"), F.sum(F.when(g == b, f)).cast("double").alias("x_b"))
    return two_sample(agg, F.col("n_a"), F.coalesce("x_a", F.lit(0.0)), F.col("n_b"), F.coalesce("x_b", F.lit(0.0)), alternative)


def one_vs_rest(df: DataFrame, group: str, flag: str, alternative: str = "two-sided") -> DataFrame:
    """M2 for every group value against all other rows: no pairs are formed.

    The per-group table (one row per group value) gets the totals by a window
    over that small table.
    """
    per = df.groupBy(group).agg(F.count(F.lit(1)).cast("double").alias("n_a"),
                                F.sum(F.col(flag).cast("int")).cast("double").alias("x_a"))
    w = Window.partitionBy()
    per = per.withColumn("n_b", F.sum("n_a").over(w) - F.col("n_a")).withColumn("x_b", F.sum("x_a").over(w) - F.col("x_a"))
    return two_sample(per, F.col("n_a"), F.col("x_a"), F.col("n_b"), F.col("x_b"), alternative)


def critical_values(mean: float, sd: float, alpha: float = 0.05) -> tuple[float, float]:
    z = norm_ppf(1 - alpha / 2)
    return mean - z * sd, mean + z * sd


def power_table(tests: DataFrame, mean_col: str, sd_col: str, alt_col: str, alpha: float = 0.05) -> DataFrame:
    """M3: per test row, two critical values, type II error and power under the alternative mean."""
    z = norm_ppf(1 - alpha / 2)
    m, s, a = F.col(mean_col), F.col(sd_col), F.col(alt_col)
    lo, hi = m - z * s, m + z * s
    beta = _phi((hi - a) / s) - _phi((lo - a) / s)
    return tests.withColumns({"crit_low": lo, "crit_high": hi, "type2": beta, "power": 1 - beta})


def segmented_ab(df: DataFrame, seg_cols: Sequence[str], group: str, flag: str, a, b,
                 alternative: str = "two-sided") -> DataFrame:
    """M4: the two-sample test inside every segment - one aggregate, no loop."""
    return prop_ztest_2(df, group, flag, a, b, alternative, by=seg_cols)


def bonferroni(tests: DataFrame, p_col: str = "p_value", alpha: float = 0.05) -> DataFrame:
    """M5: reject when p < alpha/m; m = number of tests (window over the test table)."""
    m = F.count(F.lit(1)).over(Window.partitionBy())
    return tests.withColumn("reject_bonf", F.col(p_col) < F.lit(alpha) / m)


def fwer(alpha: float, m: int) -> float:
    """M5: family-wise error of m independent tests at level alpha."""
    return 1 - (1 - alpha) ** m


def benjamini_hochberg(tests: DataFrame, p_col: str = "p_value", alpha: float = 0.05, tie: str | Sequence[str] | None = None) -> DataFrame:
    """M6: step-up rule; reject all ranks <= the largest i with p(i) <= i/m*alpha.

    Adjusted p = min over j >= i of p(j)*m/j, capped at 1.  Ranks and the running
    extremes from the last rank down come from ranges of (p, tie), so any number of
    tests (one per month and town) is spread over tasks.
    """
    ties = [tie] if isinstance(tie, str) else list(tie or [])
    t = prefix_agg(tests.withColumn("__one", F.lit(1)), p_col, ["__one"], tie_cols=ties, total_suffix="_all")
    i, m, p = F.col("__one_cum"), F.col("__one_all"), F.col(p_col)
    # over the ranks from the last one down to i: any rank that passes, and the least p * m / j
    t = t.withColumns({"__ok": F.when(p <= i / m * alpha, 1).otherwise(0), "__adj": -p * m / i})
    t = prefix_agg(t, "__one_cum", ["__ok", "__adj"], how="max", desc=True)
    t = t.withColumns({"p_adj_bh": F.least(F.lit(1.0), -F.col("__adj_cum")), "reject_bh": F.col("__ok_cum") == 1})
    return t.drop("__one", "__one_cum", "__one_all", "__ok", "__adj", "__ok_cum", "__adj_cum")


def ks_2samp(df: DataFrame, group: str, col: str, a, b) -> DataFrame:
    """M8: two-sample Kolmogorov-Smirnov D and its asymptotic p-value.

    Per distinct value: counts of each sample; running sums and totals by ranges
    give both ECDFs; D = max |F_a - F_b| (NULL when a sample is empty).
    p = Q_KS((sqrt(ne) + 0.12 + 0.11/sqrt(ne)) * D) with the alternating series.
    """
    g = F.col(group)
    per = df.where(F.col(col).isNotNull() & g.isin(a, b)).groupBy(F.col(col).alias("v")).agg(
        F.count_if(g == a).cast("double").alias("ca"), F.count_if(g == b).cast("double").alias("cb"))
    cum = prefix_agg(per, "v", ["ca", "cb"], total_suffix="_all")
    gap = F.abs(F.col("ca_cum") / F.nullif("ca_all", F.lit(0.0)) - F.col("cb_cum") / F.nullif("cb_all", F.lit(0.0)))
    d = cum.agg(F.max(gap).alias("d"), F.coalesce(F.max("ca_all"), F.lit(0.0)).alias("n_a"), F.coalesce(F.max("cb_all"), F.lit(0.0)).alias("n_b"))
    ne = F.col("n_a") * F.col("n_b") / F.nullif(F.col("n_a") + F.col("n_b"), F.lit(0.0))
    lam = (F.sqrt(ne) + 0.12 + 0.11 / F.sqrt(F.nullif(ne, F.lit(0.0)))) * F.col("d")
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam))
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * terms))
    return d.withColumn("p_value", F.when(F.col("d") > 0, p).when(F.col("d") == 0, F.lit(1.0)))


def qq_points(df: DataFrame, group: str, col: str, a, b, n: int = 100) -> DataFrame:
    """M9: matching quantiles of two samples at probabilities i/(n-1)."""
    qs = [i / (n - 1) for i in range(n)]
    gq = grouped_quantiles(df.where(F.col(group).isin(a, b)), col, qs, [group])
    return gq.groupBy("q").agg(F.max(F.when(F.col(group) == a, F.col("value"))).alias("q_a"),
                               F.max(F.when(F.col(group) == b, F.col("value"))).alias("q_b"))


def qq_normal(df: DataFrame, col: str, n: int = 100) -> DataFrame:
    """Sample quantiles against standard normal quantiles at (i-0.5)/n."""
    probs = [(i - 0.5) / n for i in range(1, n + 1)]
    gq = grouped_quantiles(df, col, probs)
    theo = df.sparkSession.createDataFrame([(p, norm_ppf(p)) for p in probs], "q double, theoretical double")
    return gq.join(F.broadcast(theo), "q").select("q", "theoretical", F.col("value").alias("sample"))


def draw_index_sql(rep: str, i: str, n_rows: str, seed: int = 0) -> str:
    """Portable draw of a row index in [0, N) for (rep, i): 62 hash bits, so every row can be drawn."""
    return f"({hash31_sql(rep, i, str(2 * int(seed)))} * 2147483648 + {hash31_sql(rep, i, str(2 * int(seed) + 1))}) % ({n_rows})"


def bootstrap_means(df: DataFrame, col: str, order: str, n: int, k: int, seed: int = 0) -> DataFrame:
    """K resamples of n draws with replacement; one mean per resample.

    Rows get a dense index by running count over ranges of ``order``;
    draws are generated (rep, i) -> hashed index, then equi-joined to the values.
    """
    vals = df.where(F.col(col).isNotNull()).select(order, col).withColumn("__one", F.lit(1.0))
    idx = prefix_agg(vals, order, ["__one"], inclusive=False).select(F.col("__one_cum").cast("long").alias("__idx"), col)
    N = idx.count()
    spark = df.sparkSession
    draws = spark.range(k * n).select((F.col("id") / n).cast("long").alias("rep"), (F.col("id") % n).alias("i"))
    draws = draws.withColumn("__idx", F.expr(draw_index_sql("rep", "i", str(N), seed)))
    return draws.join(idx, "__idx").groupBy("rep").agg(F.avg(col).alias("mean"))


def ols_one(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """M12 (one regressor): slope, intercept, their standard errors, t, p (normal), R^2."""
    yc, xc = F.col(y), F.col(x)
    a = df.where(xc.isNotNull() & yc.isNotNull()).groupBy(*by).agg(
        F.regr_count(y, x).cast("double").alias("n"), F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"),
        F.regr_avgx(y, x).alias("xbar"))
    sse = F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")
    s2 = sse / (F.col("n") - 2)
    se_b = F.sqrt(s2 / F.col("sxx"))
    se_a = F.sqrt(s2 * (1.0 / F.col("n") + F.col("xbar") * F.col("xbar") / F.col("sxx")))
    out = a.withColumns({"se_slope": se_b, "se_intercept": se_a, "sigma2": s2})
    out = out.withColumn("t_slope", F.col("slope") / F.col("se_slope"))
    return out.withColumn("p_slope", p_value(F.col("t_slope")))


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Least squares with intercept for several regressors.

    One aggregate pass collects X'X and X'y (p+1 squared sums - a bounded
    row); the small system is solved on the driver.
    """
    xs = list(xs)
    terms = ["__1"] + xs
    d = df.where(F.col(y).isNotNull()).dropna(subset=xs).withColumn("__1", F.lit(1.0))
    aggs = [F.sum(F.col(a) * F.col(b)).alias(f"{a}|{b}") for i, a in enumerate(terms) for b in terms[i:]]
    aggs += [F.sum(F.col(a) * F.col(y)).alias(f"{a}|y") for a in terms] + [F.sum(F.col(y) * F.col(y)).alias("y|y")]
    row = d.agg(*aggs).collect()[0].asDict()
    p = len(terms)
    xtx = np.zeros((p, p))
    for i, a in enumerate(terms):
        for j in range(i, p):
            xtx[i, j] = xtx[j, i] = row[f"{a}|{terms[j]}"]
    xty = np.array([row[f"{a}|y"] for a in terms])
    beta = np.linalg.solve(xtx, xty)
    n = xtx[0, 0]
    sse = row["y|y"] - 2 * beta @ xty + beta @ xtx @ beta
    sst = row["y|y"] - xty[0] ** 2 / n
    s2 = sse / (n - p)
    cov = s2 * np.linalg.inv(xtx)
    se = np.sqrt(np.diag(cov))
    rows = []
    for i, t in enumerate(["intercept"] + xs):
        tval = beta[i] / se[i]
        pval = 2 * (1 - _phi_py(abs(tval)))
        rows.append((t, float(beta[i]), float(se[i]), float(tval), float(pval), float(1 - sse / sst)))
    return df.sparkSession.createDataFrame(rows, "term string, coef double, se double, t double, p double, r2 double")


def _phi_py(x: float) -> float:
    from ledgerplay.functions.formulas import norm_cdf_py
    return norm_cdf_py(x)


def ols_intervals(df: DataFrame, y: str, x: str, level: float = 0.95, by: Sequence[str] = ()) -> DataFrame:
    """Fitted value and prediction bounds per row (one regressor, per group).

    The fit is one row per group, joined back (broadcast: bounded by groups).
    """
    fit = ols_one(df, y, x, by).select(*by, "slope", "intercept", "sigma2", "n", "sxx", "xbar")
    z = norm_ppf(0.5 + level / 2)
    j = join_null_safe(df, fit, list(by)) if by else df.withColumns(
        {k: F.lit(v) for k, v in fit.collect()[0].asDict().items()})
    fitted = F.col("intercept") + F.col("slope") * F.col(x)
    half = z * F.sqrt(F.col("sigma2") * (1 + 1 / F.col("n") + (F.col(x) - F.col("xbar")) ** 2 / F.col("sxx")))
    return j.withColumns({"fitted": fitted, "lower": fitted - half, "upper": fitted + half}).drop(
        "slope", "intercept", "sigma2", "n", "sxx", "xbar")
