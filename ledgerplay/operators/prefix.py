"""Scalable running aggregates and exact order statistics.

A ``Window`` ordered over a whole table runs in one task.  Here the table is
range-partitioned on the composite key (group, order value, tie columns) in the
columns' own types and materialised once; the totals of each (group, partition)
form a small table whose running totals are the offsets; the exact running value
is the offset plus a running value inside the partition.  One order value, or one
group, may hold most rows: its rows are spread by the tie columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerplay.session import cut_lineage

_P = "__range_part"


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL (NULL is a group of its own);
    the result has the columns of ``left`` and the further ones of ``right``."""
    r = right.withColumnsRenamed({k: f"__r_{i}" for i, k in enumerate(keys)})
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{i}"))
    return left.join(r, cond, how).drop(*[f"__r_{i}" for i in range(len(keys))])


def range_parts(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), n_parts: int | None = None) -> DataFrame:
    """Rows range-partitioned on (by..., order...) with their partition number,
    materialised in the shared checkpoint folder.

    Without ``n_parts`` the session's shuffle parallelism cuts the ranges and AQE
    merges small ones, so a small table gets few."""
    keys = [F.col(k) for k in by] + list(order)
    cut = df.repartitionByRange(n_parts, *keys) if n_parts else df.repartitionByRange(*keys)
    return cut_lineage(cut.withColumn(_P, F.spark_partition_id()))


def prefix_agg(
    df: DataFrame,
    order_col: str,
    cols: Sequence[str],
    how: str = "sum",
    desc: bool = False,
    tie_cols: Sequence[str] = (),
    inclusive: bool = True,
    n_buckets: int | None = None,
    suffix: str = "_cum",
    by: Sequence[str] = (),
    total_suffix: str | None = None,
) -> DataFrame:
    """Running ``sum`` or ``max`` of ``cols`` in order of ``order_col`` (per ``by``; NULL is a
    group of its own, NULL order values come last).

    ``inclusive=False`` gives the value over the rows strictly before.  Adds
    ``<col><suffix>`` columns, and with ``total_suffix`` the value over the whole group.
    Rows with equal ``order_col`` are ordered by ``tie_cols``.  Exact; no task ever
    holds more than one range of (group, order value, ties).
    """
    by = list(by)
    first = F.col(order_col).desc_nulls_last() if desc else F.col(order_col).asc_nulls_last()
    order = [first, *[F.col(t) for t in tie_cols]]
    d = range_parts(df, order, by, n_buckets)
    agg = F.sum if how == "sum" else F.max
    tot = d.groupBy(*by, _P).agg(*[agg(c).alias(f"{c}__t") for c in cols])
    # a group has at most one row per partition here, and a partition few groups or a whole one each
    group = Window.partitionBy(*by)
    earlier = group.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    off = [agg(f"{c}__t").over(earlier).alias(f"{c}__o") for c in cols]
    if total_suffix:
        off += [agg(f"{c}__t").over(group).alias(f"{c}{total_suffix}") for c in cols]
    off = tot.select(*by, _P, *off)
    inner = Window.partitionBy(*by, _P).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    running = d.withColumns({f"{c}__i": agg(c).over(inner) for c in cols})
    # one group: at most one row per partition, broadcast; else AQE picks the join
    res = join_null_safe(running, off, [*by, _P], "left") if by else running.join(F.broadcast(off), _P, "left")
    value = {}
    for c in cols:
        if how == "sum":
            value[f"{c}{suffix}"] = F.coalesce(F.col(f"{c}__o"), F.lit(0.0)) + F.coalesce(F.col(f"{c}__i"), F.lit(0.0))
        else:
            value[f"{c}{suffix}"] = F.greatest(F.col(f"{c}__o"), F.col(f"{c}__i"))
    return res.withColumns(value).drop(_P, *[f"{c}__{x}" for c in cols for x in "oi"])


def value_counts(df: DataFrame, col: str, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value with its count (partial aggregation map-side)."""
    w = F.col(weight) if weight else F.lit(1)
    return df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.sum(w).cast("double").alias("n"))


def grouped_quantiles(df: DataFrame, col: str, qs: Sequence[float], by: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (type 7) per group: (by..., q, value).

    Distributed order statistics: distinct values with running counts and the
    group's total; a value that covers one of the (at most two) ranks a quantile
    needs gives a row, and one aggregate per (group, q) interpolates.  No task holds
    a whole group and nothing passes the driver.  One group always has a row
    per q (NULL for no values).
    """
    by = list(by)
    cum = prefix_agg(value_counts(df, col, by=by), col, ["n"], n_buckets=n_buckets, by=by, total_suffix="_all")
    start, end = F.col("n_cum") - F.col("n"), F.col("n_cum")

    def rank(q: Column) -> Column:
        at = q * (F.col("n_all") - 1)
        low = F.floor(at).cast("double")
        return F.struct(q.alias("q"), low.alias("lo"), F.least(low + 1, F.col("n_all") - 1).alias("hi"), (at - low).alias("frac"))

    def covers(k: Column) -> Column:
        return (start <= k) & (k < end)

    ranks = F.transform(F.array(*[F.lit(float(q)) for q in dict.fromkeys(qs)]), rank)
    hits = cum.select(*by, F.col(col).cast("double").alias("__v"), F.explode(F.filter(ranks, lambda r: covers(r["lo"]) | covers(r["hi"]))).alias("r"), start.alias("__s"), end.alias("__e"))
    inside = lambda k: (F.col("__s") <= F.col(k)) & (F.col(k) < F.col("__e"))
    low, high = (F.max(F.when(inside(k), F.col("__v"))) for k in ("r.lo", "r.hi"))
    got = hits.groupBy(*by, F.col("r.q").alias("q")).agg((low + F.max("r.frac") * (high - low)).alias("value"))
    if by:
        return got
    every = df.sparkSession.createDataFrame([(float(q),) for q in dict.fromkeys(qs)], "q double")
    return every.join(F.broadcast(got), "q", "left")


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], n_buckets: int | None = None) -> list[float | None]:
    """Global exact quantiles; only len(qs) rows reach the driver."""
    got = {r["q"]: r["value"] for r in grouped_quantiles(df, col, qs, (), n_buckets).collect()}
    return [got.get(float(q)) for q in qs]


def quantile_edges(df: DataFrame, col: str, q: int, by: Sequence[str] = ()) -> DataFrame:
    """Edges of ``q`` quantile bins per group: (by..., edges array, ascending, duplicates dropped)."""
    qs = [i / q for i in range(q + 1)]
    gq = grouped_quantiles(df, col, qs, by)
    return gq.groupBy(*by).agg(
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("q", "value"))), lambda s: s["value"])).alias("edges"))
