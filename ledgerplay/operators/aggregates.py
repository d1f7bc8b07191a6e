"""Aggregations.

All of these are single ``groupBy``/``agg`` passes: Catalyst plans a partial
aggregate before the shuffle, so a hot key is reduced map-side and never
travels as raw rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerplay.operators.prefix import exact_quantiles, grouped_quantiles, join_null_safe

KDE_REACH = 9.0  # bandwidths


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mean_overall_and_where(df: DataFrame, col: str, cond: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """G1: mean of all rows and of the rows meeting ``cond`` (one pass)."""
    cnd = F.expr(cond) if isinstance(cond, str) else cond
    return df.groupBy(*by).agg(F.avg(col).alias("mean_all"), F.avg(F.when(cnd, F.col(col))).alias("mean_where"))


def rate(df: DataFrame, flag: str | Column, by: Sequence[str] = (), out: str = "rate") -> DataFrame:
    """Share of true values of a flag."""
    return df.groupBy(*by).agg(F.avg(_c(flag).cast("int")).alias(out), F.count(F.lit(1)).alias("n"))


def value_shares(df: DataFrame, col: str, dropna: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Count and share of each value (share within ``by``).

    Without ``by`` the total is one scalar aggregate; with ``by`` the per-group
    totals (one row per group) are joined back.
    """
    d = df.where(F.col(col).isNotNull()) if dropna else df
    cnt = d.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    if not by:
        total = cnt.agg(F.sum("n")).collect()[0][0] or 0
        return cnt.withColumn("share", F.col("n") / F.lit(float(total)))
    tot = cnt.groupBy(*by).agg(F.sum("n").alias("__t"))
    return join_null_safe(cnt, tot, list(by)).withColumn("share", F.col("n") / F.col("__t")).drop("__t")


def distinct_count(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """Rows vs distinct values (``approx`` uses HyperLogLog++ at scale)."""
    dc = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(F.count(F.lit(1)).alias("rows"), dc.alias("distinct"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std (n-1), min, quartiles, max per column.

    The columns become groups of one long table, so all quartiles are one set of
    distributed order statistics (no task holds a column's values).
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s")).select("s.*")
    moments = long.groupBy("column").agg(F.count("v").cast("double").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                                         F.min("v").alias("min"), F.max("v").alias("max"))
    at = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    quart = grouped_quantiles(long, "v", list(at), ["column"]).groupBy("column").agg(
        *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(name) for q, name in at.items()])
    return moments.join(quart, "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def quantiles(df: DataFrame, col: str, qs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles, exact and distributed (order statistics)."""
    return grouped_quantiles(df, col, list(qs))


def group_stat(df: DataFrame, key: str | Sequence[str], col: str, stat: str = "mean") -> DataFrame:
    """Mean, std or median per group (median: exact, per-group order statistics)."""
    keys = [key] if isinstance(key, str) else list(key)
    n = df.groupBy(*keys).agg(F.count(col).alias("n"))
    if stat == "median":
        med = grouped_quantiles(df, col, [0.5], keys).select(*keys, F.col("value").alias("median"))
        return join_null_safe(n, med, keys, "left")
    f = {"mean": F.avg(col), "std": F.stddev_samp(col)}[stat]
    return df.groupBy(*keys).agg(f.alias(stat), F.count(col).alias("n"))


def target_encode(fit: DataFrame, cat: str, y: str) -> DataFrame:
    """Mean target per category (NULL category -> 'NA'), from training rows."""
    return fit.groupBy(F.coalesce(F.col(cat).cast("string"), F.lit("NA")).alias(cat)).agg(F.avg(F.col(y).cast("double")).alias(f"{cat}_te"))


def std_ranking(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns by sample standard deviation."""
    wide = df.agg(*[F.stddev_samp(c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "std")


def corr_with(df: DataFrame, y: str, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of each column with y, pairwise complete (one pass)."""
    wide = df.agg(*[F.corr(c, y).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "corr").withColumn("abs_corr", F.abs("corr"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long (a, b, corr) for every ordered pair of columns, one pass over the rows.

    The pairs are of *columns* (a fixed, small set), generated as expressions.
    """
    cols = list(cols)
    aggs = [F.corr(a, b).alias(f"{a}|{b}") for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*aggs) if aggs else None
    pairs = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            pairs.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("corr")))
            pairs.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"`{a}|{b}`").alias("corr")))
    return wide.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def collinear_drop(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """Per column, number of other columns with |corr| > threshold."""
    cm = corr_matrix(df, cols)
    return cm.groupBy("a").agg(F.count_if(F.abs("corr") > threshold).alias("n_high")).withColumnRenamed("a", "column")


def skewness_g1(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Bias-corrected sample skewness G1 = g1*sqrt(n(n-1))/(n-2)."""
    n = F.count(col).cast("double")
    g1 = F.skewness(col)
    return df.groupBy(*by).agg(F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"), n.alias("n"))


def weighted_mean(df: DataFrame, x: str, w: str, by: Sequence[str] = ()) -> DataFrame:
    """sum(x*w)/sum(w); NULL when the total weight is 0."""
    return df.groupBy(*by).agg(F.try_divide(F.sum(F.col(x) * F.col(w)), F.sum(w)).alias("weighted_mean"))


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int, density: bool = False,
              by: Sequence[str] = ()) -> DataFrame:
    """Fixed-width bins on [lo, hi], last bin closed, out of range ignored.

    Empty bins appear with 0 (the bin list is a generated sequence, not a join
    to data).  ``density`` = count / (n_in_range * width).
    """
    width = (hi - lo) / bins
    x = F.col(col)
    b = F.when((x >= lo) & (x <= hi), F.least(F.floor((x - lo) / width).cast("int"), F.lit(bins - 1)))
    counts = df.where(b.isNotNull()).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if by:
        keys = counts.select(*by).distinct()
        # grid of bins per group = group keys expanded by the fixed bin list
        grid = keys.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = join_null_safe(grid, counts, [*by, "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    out = out.withColumn("left", F.lit(lo) + F.col("bin") * width).withColumn("right", F.lit(lo) + (F.col("bin") + 1) * width)
    if density:
        w = Window.partitionBy(*by) if by else Window.partitionBy()
        out = out.withColumn("density", F.col("count") / (F.sum("count").over(w) * width))
    return out


def sqrt_bins(df: DataFrame, col: str) -> int:
    """Number of bins = floor(sqrt(distinct values))."""
    n = df.agg(F.count_distinct(col)).collect()[0][0]
    return max(1, int(math.sqrt(n)))


def box_stats(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (last value inside the fences) and outlier count."""
    q1, q2, q3 = exact_quantiles(df.select(F.col(col).cast("double").alias(col)), col, [0.25, 0.5, 0.75])
    if q1 is None:  # no value at all: no quartiles, no outliers
        return df.sparkSession.createDataFrame([(None,) * 5 + (0,)], "q1 double, median double, q3 double, whisker_low double, whisker_high double, n_outliers long")
    lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
    x = F.col(col)
    return df.agg(
        F.lit(q1).alias("q1"), F.lit(q2).alias("median"), F.lit(q3).alias("q3"),
        F.min(F.when(x >= lo, x)).cast("double").alias("whisker_low"),
        F.max(F.when(x <= hi, x)).cast("double").alias("whisker_high"),
        F.count_if((x < lo) | (x > hi)).alias("n_outliers"),
    )


def kde_grid(df: DataFrame, col: str, grid: Sequence[float], bw: float, by: Sequence[str] = (), parts: int = 512) -> DataFrame:
    """Gaussian kernel density on a grid, normalised per group (0 where no row is near).

    Rows are summed into bins of a ``parts``-th of the bandwidth, whatever their range, with
    count, mean and spread; a bin meets only the grid points within ``KDE_REACH``
    bandwidths, so far outliers cost nothing and the work per group is bounded by the
    grid.  The kernel is expanded around the bin's mean to the second order: the
    relative error is below 1 / (4 * (2 * parts) ** 3), beyond the reach below 1e-17.
    """
    base = df.where(F.col(col).isNotNull()).withColumn("__x", F.col(col).cast("double"))
    points = F.array(*[F.lit(float(v)) for v in grid])
    bins = base.groupBy(*by, F.floor(F.col("__x") / (bw / parts)).alias("__b")).agg(F.avg("__x").alias("__c"), F.count("__x").alias("__m"), F.var_pop("__x").alias("__v"))
    near = F.filter(points, lambda x: F.abs(x - F.col("__c")) <= KDE_REACH * bw)
    g = bins.withColumn("x", F.explode(near))
    u = (F.col("x") - F.col("__c")) / bw
    kernel = F.exp(-0.5 * u * u) * (1.0 + 0.5 * (u * u - 1.0) * F.col("__v") / (bw * bw))
    sums = g.groupBy(*by, "x").agg(F.sum(F.col("__m") * kernel).alias("__k"))
    every = base.groupBy(*by).agg(F.count("__x").alias("__n")).withColumn("x", F.explode(points))
    full = join_null_safe(every, sums, [*by, "x"], "left")
    return full.select(*by, "x", (F.coalesce("__k", F.lit(0.0)) / (F.col("__n") * bw * math.sqrt(2 * math.pi))).alias("density"))


def binned_rate(df: DataFrame, x: str | Column, flag: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean of a flag and row count per x value (or bin), optionally stratified."""
    return df.groupBy(*by, _c(x).alias("x")).agg(F.avg(F.col(flag).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"))


def binned_scatter(df: DataFrame, bin_col: str, pred: str, truth: str) -> DataFrame:
    """Mean predicted vs mean true per bin."""
    return df.groupBy(bin_col).agg(F.avg(pred).alias("mean_pred"), F.avg(F.col(truth).cast("double")).alias("mean_true"),
                                   F.count(F.lit(1)).alias("n"))


def payments_wide(pays: DataFrame, id_col: str, num_col: str, value_col: str, nums: Sequence[int],
                  prefix: str = "paid") -> DataFrame:
    """One row per loan, one column per payment number (duplicates summed).

    The pivot values are given, so Spark needs no extra pass to find them.
    """
    w = pays.groupBy(id_col).pivot(num_col, list(nums)).agg(F.sum(value_col))
    return w.withColumnsRenamed({str(n): f"{prefix}{n}" for n in nums})


def late_count(loans: DataFrame, pays: DataFrame, id_col: str, pmt_col: str, n: int, share: float = 0.95) -> DataFrame:
    """Months 1..n whose payment is missing or below ``share`` of the schedule.

    n less the months that were paid: payments are summed per (id, month) and meet
    their loan once, without a grid of loans and months; join and count share one
    partitioning on the id.
    """
    months = pays.where(F.col("mob").between(1, n)).groupBy(id_col, "mob").agg(F.sum("paid").alias("paid"))
    j = loans.select(id_col, pmt_col).join(months, id_col, "left")
    paid = F.col("paid").isNotNull() & ~F.coalesce(F.col("paid") < share * F.col(pmt_col), F.lit(False))
    return j.groupBy(id_col).agg((F.lit(n).cast("long") - F.count_if(paid)).alias("n_late"))


def late_distribution(late: DataFrame) -> DataFrame:
    """Share of loans per late count."""
    return value_shares(late, "n_late")


def date_span(df: DataFrame, col: str, status: str | None = None) -> DataFrame:
    """Earliest and latest date (per status)."""
    by = [status] if status else []
    return df.groupBy(*by).agg(F.min(col).alias("first"), F.max(col).alias("last"), F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Full 2x2 counts (zeros included)."""
    cells = df.agg(*[
        F.count_if((F.col(y).cast("int") == a) & (F.col(yhat).cast("int") == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)
    ])
    return cells.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("y"), F.lit(b).alias("yhat"), F.col(f"c{a}{b}").alias("n")) for a in (0, 1) for b in (0, 1)
    ])).alias("c")).select("c.*")


def accuracy(df: DataFrame, y: str, yhat: str, w: str | Column | None = None) -> DataFrame:
    """Weighted share of equal labels."""
    wc = F.lit(1.0) if w is None else _c(w).cast("double")
    eq = (F.col(y).cast("int") == F.col(yhat).cast("int")).cast("double")
    return df.agg((F.sum(wc * eq) / F.sum(wc)).alias("accuracy"))


def rmse(df: DataFrame, y: str, yhat: str | Column) -> DataFrame:
    """Root mean squared error."""
    e = F.col(y) - _c(yhat)
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"))


def r2(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """1 - SSE/SST in one pass; SST is the centred n * var_pop(y)."""
    yc, pc = F.col(y), F.col(yhat)
    sse = F.sum((yc - pc) * (yc - pc))
    n = F.count(y)
    sst = F.var_pop(yc) * n
    return df.groupBy(*by).agg((1 - sse / sst).alias("r2"), n.alias("n"))


def selection_profile(df: DataFrame, flag: str, cols: Sequence[str]) -> DataFrame:
    """Means of ``cols`` for selected rows, the rest, and the whole pool."""
    aggs = [F.avg(c).alias(f"mean_{c}") for c in cols] + [F.count(F.lit(1)).alias("n")]
    return df.rollup(F.col(flag).alias("selected")).agg(*aggs)


def selection_quantiles(df: DataFrame, flag: str, cols: Sequence[str], qs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles of ``cols`` for selected rows, the rest, and the whole pool.

    Rows (scope, column, q, value); scope is selected / rest / all, a NULL flag counts in
    ``all`` only.  All scopes and columns are groups of one distributed order statistic.
    """
    own = F.when(F.col(flag), "selected").when(~F.col(flag), "rest")
    scopes = F.filter(F.array(F.lit("all"), own), lambda s: s.isNotNull())
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])
    long = df.select(F.explode(scopes).alias("scope"), values.alias("s")).select("scope", F.explode("s").alias("s")).select("scope", "s.column", "s.v")
    return grouped_quantiles(long.where(F.col("v").isNotNull()), "v", list(qs), ["scope", "column"])


def bias_check(before: DataFrame, after: DataFrame, flag: str) -> DataFrame:
    """Rate of a flag in two row sets, side by side (one pass over both)."""
    u = before.select(F.col(flag).cast("double").alias("__f"), F.lit(0).alias("__s")).unionByName(
        after.select(F.col(flag).cast("double").alias("__f"), F.lit(1).alias("__s")))
    return u.agg(
        F.avg(F.when(F.col("__s") == 0, F.col("__f"))).alias("rate_before"), F.count_if(F.col("__s") == 0).alias("n_before"),
        F.avg(F.when(F.col("__s") == 1, F.col("__f"))).alias("rate_after"), F.count_if(F.col("__s") == 1).alias("n_after"),
    )


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
