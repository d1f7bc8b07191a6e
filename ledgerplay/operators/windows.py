"""Window-style operators (W1-W13, W16, W17), sort/top-k (T1-T7), set ops.

No operator orders a whole raw table in one window: "last row per key" is an
aggregate (``max`` of a struct, reduced map-side), and running totals over a
whole table go through ``prefix.prefix_agg`` (composite-key ranges, exact).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerplay.operators.joins import bin_join, broadcast_if_small, edges_index
from ledgerplay.operators.prefix import prefix_agg, quantile_edges, value_counts
from ledgerplay.session import cut_lineage


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: str, tie: str) -> DataFrame:
    """The last row per key by ``order``, ties broken by the larger ``tie``.

    ``max(struct(order, tie, row))`` per key: a partial aggregate, so a key that
    holds a third of the table is reduced before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(F.col(order).alias("__o"), F.col(tie).alias("__t"), *[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.max(packed).alias("__m")).select(*keys, *[F.col(f"__m.{c}").alias(c) for c in rest])


def uncumulate_wide(df: DataFrame, id_col: str, prefix: str, n: int, out: str = "paid") -> DataFrame:
    """Running totals ``<prefix>1..n`` -> long (id, mob, paid) with paid_i = agg_i - agg_{i-1}.

    Column arithmetic on the wide row: no shuffle, no window.  agg_0 = 0.
    """
    def diff(i: int) -> Column:
        cur = F.col(f"{prefix}{i}")
        return cur if i == 1 else cur - F.col(f"{prefix}{i - 1}")
    arr = F.array(*[F.struct(F.lit(i).alias("mob"), diff(i).alias(out)) for i in range(1, n + 1)])
    return df.select(id_col, F.explode(arr).alias("__s")).select(id_col, "__s.mob", f"__s.{out}")


def uncumulate_long(df: DataFrame, id_col: str, mob: str, agg: str, out: str = "paid") -> DataFrame:
    """W2 on long input: agg - lag(agg) per id (rows per id = months, bounded)."""
    w = Window.partitionBy(id_col).orderBy(mob)
    return df.withColumn(out, F.col(agg) - F.coalesce(F.lag(agg).over(w), F.lit(0.0)))


def qcut(df: DataFrame, col: str, q: int, out: str = "bin", by: Sequence[str] = ()) -> DataFrame:
    """Quantile bins (left, right], lowest included, on unrounded exact edges.

    Bin = number of edges strictly below x (at least 1).  Duplicate edges are
    dropped (fewer bins), as ``duplicates='drop'``.  Not ``ntile``: equal values
    always share a bin.
    """
    edges = quantile_edges(df, col, q, by)
    if by:
        return bin_join(df, col, edges, out, by=list(by)[0]) if len(by) == 1 else _bin_multi(df, col, edges, out, by)
    return bin_join(df, col, edges, out)


def _bin_multi(df: DataFrame, col: str, edges: DataFrame, out: str, by: Sequence[str]) -> DataFrame:
    # one row per group; groups are not bounded in general, so the join
    # strategy is left to AQE (broadcast only when the runtime size is small)
    j = df.join(edges, list(by), "left")
    return j.withColumn(out, edges_index(F.col(col), F.col("edges"))).drop("edges")


def nested_qcut(df: DataFrame, c1: str, q1: int, c2: str, q2: int, apply_to: DataFrame | None = None) -> DataFrame:
    """Bins of c1, then bins of c2 inside each c1 bin; ``apply_to`` gets the same edges."""
    e1 = quantile_edges(df, c1, q1)
    ref = bin_join(df, c1, e1, "bin1")
    e2 = quantile_edges(ref.where(F.col("bin1").isNotNull()), c2, q2, ["bin1"])
    target = bin_join(apply_to if apply_to is not None else df, c1, e1, "bin1")
    return bin_join(target, c2, e2, "bin2", by="bin1")


def cumulative_by_bin(df: DataFrame, bin_col: str, cols: Sequence[str], desc: bool = False) -> DataFrame:
    """Sums per bin, then running sums over the (few) bins."""
    per = df.groupBy(bin_col).agg(*[F.sum(c).alias(c) for c in cols])
    o = F.col(bin_col).desc() if desc else F.col(bin_col).asc()
    w = Window.orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per bin: a single-partition window over a bounded table
    return per.select(bin_col, *cols, *[F.sum(c).over(w).alias(f"cum_{c}") for c in cols])


def top_by_volume(df: DataFrame, score: str, amount: str, share: float, id_col: str) -> DataFrame:
    """Best rows by score (ties: smaller id first) until ``share`` of total volume.

    A row is taken when the volume strictly before it is below share*total.  Ranges are
    cut on (score, id), so rows of one score may fill many tasks.
    """
    cum = prefix_agg(df.select(id_col, score, amount), score, [amount], desc=True, tie_cols=[id_col], inclusive=False, total_suffix="_all")
    return cum.where(F.col(f"{amount}_cum") < share * F.col(f"{amount}_all")).drop(f"{amount}_cum", f"{amount}_all")


def average_rank(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """Rank with ties averaged (1-based), via per-value counts and running counts."""
    vc = value_counts(df, col)
    cum = prefix_agg(vc, col, ["n"], inclusive=False)
    ranks = cum.select(col, (F.col("n_cum") + (F.col("n") + 1) / 2.0).alias(out))
    return df.join(ranks, col, "left")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation of the average ranks (complete rows only)."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    d = cut_lineage(d.select(a, b))  # read by two rankings and the join
    r = average_rank(average_rank(d, a, "__ra"), b, "__rb")
    return r.agg(F.corr("__ra", "__rb").alias("spearman"))


def roc_curve(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, tpr, fpr) at each distinct score, descending thresholds.

    Positive/negative counts per distinct score, then running sums from the top.
    """
    by = list(by)
    yc = F.col(y).cast("int")
    per = df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("threshold")).agg(
        F.sum(yc).cast("double").alias("tp"), F.sum(1 - yc).cast("double").alias("fp"))
    cum = prefix_agg(per, "threshold", ["tp", "fp"], desc=True, by=by, total_suffix="_all")
    return cum.select(*by, "threshold", (F.col("tp_cum") / F.col("tp_all")).alias("tpr"), (F.col("fp_cum") / F.col("fp_all")).alias("fpr"))


def auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, trapezoids, starting from (0, 0).

    Equals the Mann-Whitney statistic: sum over distinct scores of
    neg_at_s * (pos_above_s + pos_at_s / 2), divided by P*N.
    """
    by = list(by)
    yc = F.col(y).cast("int")
    per = df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("s")).agg(
        F.sum(yc).cast("double").alias("pos"), F.sum(1 - yc).cast("double").alias("neg"))
    cum = prefix_agg(per, "s", ["pos"], desc=True, inclusive=False, by=by)
    return cum.groupBy(*by).agg(
        (F.sum(F.col("neg") * (F.col("pos_cum") + F.col("pos") / 2.0)) / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def threshold_at_fpr(df: DataFrame, y: str, score: str, fpr: float = 0.2, by: Sequence[str] = ()) -> DataFrame:
    """Per group, walking thresholds downwards, the first whose FPR exceeds ``fpr``."""
    roc = roc_curve(df, y, score, by)
    return roc.where(F.col("fpr") > fpr).groupBy(*by).agg(F.max("threshold").alias("threshold"))


def rolling_mean(curve: DataFrame, x: str, col: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Mean over +-k neighbouring x values of an aggregated curve."""
    w = Window.partitionBy(*by).orderBy(x).rowsBetween(-k, k)
    return curve.withColumn(f"{col}_smooth", F.avg(col).over(w))


def is_monotonic(df: DataFrame, order: str, col: str, decimals: int | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """Is the (rounded) series non-decreasing in ``order``?

    Each value is compared with the running maximum of the values before it.
    """
    v = F.round(F.col(col), decimals) if decimals is not None else F.col(col)
    d = df.select(order, *tie, v.alias("__v"))
    cum = prefix_agg(d, order, ["__v"], how="max", inclusive=False, tie_cols=list(tie))
    ok = F.col("__v_cum").isNull() | (F.col("__v") >= F.col("__v_cum"))
    return cum.agg(F.coalesce(F.bool_and(ok), F.lit(True)).alias("monotonic"))


def ordinal_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """0-based position of the value among the sorted distinct values.

    The distinct values are ranked by ranges in their own type (any number of
    categories) and materialised, then joined back (broadcast while their number is small).
    """
    cats = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn("__one", F.lit(1))
    ranked = cut_lineage(prefix_agg(cats, col, ["__one"], inclusive=False).select(col, F.col("__one_cum").cast("int").alias("__code")))
    return df.join(broadcast_if_small(ranked), col, "left").withColumnRenamed("__code", out or f"{col}_code")


# --- sort, limit, top-k ------------------------------------------------------

def sort(df: DataFrame, *cols: str | Column, ascending: bool = True) -> DataFrame:
    """Total order (use only at the end of a plan)."""
    return df.orderBy(*cols, ascending=ascending)


def head(df: DataFrame, n: int, key: str | None = None, seed: int = 0) -> DataFrame:
    """N rows for display; with ``key`` a deterministic sample (portable key
    hash order, so the same rows in any engine).  ``limit`` after ``orderBy``
    is a top-k: each partition keeps n rows, no global sort."""
    if key is None:
        return df.limit(n)
    from ledgerplay.functions.formulas import unit_hash
    return df.orderBy(unit_hash(key, seed), F.col(key)).limit(n)


def top_columns(stat: DataFrame, value: str, k: int, by_abs: bool = True) -> DataFrame:
    """The k columns with the largest |statistic| (input: one row per column)."""
    o = F.abs(value) if by_abs else F.col(value)
    return stat.orderBy(o.desc(), F.col("column")).limit(k)


def top_fraction(df: DataFrame, score: str, frac: float, by: Sequence[str], tie: str) -> DataFrame:
    """The best ceil(frac*n) rows of each group (groups are snapshots: bounded)."""
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie))
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    out = df.withColumn("__rn", F.row_number().over(w)).withColumn("__n", n)
    return out.where(F.col("__rn") <= F.ceil(F.col("__n") * frac)).drop("__rn", "__n")


# --- set operations ----------------------------------------------------------

def union_all(*dfs: DataFrame) -> DataFrame:
    """Concat by column name; missing columns become NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct common rows."""
    return a.intersect(b)


def except_(a: DataFrame, b: DataFrame, all_rows: bool = False) -> DataFrame:
    """Rows of a not in b (``exceptAll`` keeps multiplicities)."""
    return a.exceptAll(b) if all_rows else a.subtract(b)


def distinct(df: DataFrame) -> DataFrame:
    """U4."""
    return df.distinct()
