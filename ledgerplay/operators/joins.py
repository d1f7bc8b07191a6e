"""Joins (J1-J6, J8, J11-J14).

Broadcasts are used only for tables whose size is bounded by construction
(bin edges, encoders, per-category statistics, fixed grids) or checked by
``broadcast_if_small``; everything else is left to Catalyst/AQE, which choose
sort-merge or shuffle-hash joins and split skewed partitions at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROW_LIMIT = 1_000_000


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint only after a bounded row-count probe (``limit(n+1).count``)."""
    n = df.limit(limit + 1).count()
    return F.broadcast(df) if n <= limit else df


def enrich(left: DataFrame, right: DataFrame, keys: str | Sequence[str], check_unique: bool = False) -> DataFrame:
    """Left equi-join; the row count of ``left`` must not change.

    With ``check_unique`` the right side's key uniqueness is verified first (one
    aggregate over the right side), so the join cannot fan out.
    """
    ks = [keys] if isinstance(keys, str) else list(keys)
    if check_unique:
        dup = right.groupBy(*ks).count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"right side is not unique on {ks}")
    return left.join(right, ks, "left")


def enrich_suffixed(left: DataFrame, right: DataFrame, lkey: str, rkey: str, suffix: str = "_r") -> DataFrame:
    """Left join on differently named keys; clashing right columns get a suffix."""
    clash = {c: f"{c}{suffix}" for c in right.columns if c in left.columns and c != rkey}
    r = right.withColumnsRenamed(clash)
    if rkey in left.columns and rkey != lkey:
        r = r.withColumnRenamed(rkey, f"{rkey}{suffix}")
        rkey = f"{rkey}{suffix}"
    return left.join(r, left[lkey] == r[rkey], "left").drop(r[rkey])


def map_lookup(df: DataFrame, col: str, table: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Value -> encoded value through a small table; unseen -> NULL.

    ``table`` has one row per category (bounded by the category count).
    """
    t = table.select(F.col(key).alias("__k"), F.col(value).alias(out or f"{col}_enc"))
    return df.join(broadcast_if_small(t), df[col].eqNullSafe(t["__k"]), "left").drop("__k")


def anti_rows(df: DataFrame, part: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The rows of ``df`` not in ``part`` (e.g. the rest after a sample)."""
    return df.join(part.select(*([keys] if isinstance(keys, str) else keys)), keys, "left_anti")


def semi_rows(df: DataFrame, ids: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in ``ids``."""
    return df.join(ids.select(*([keys] if isinstance(keys, str) else keys)), keys, "left_semi")


def edges_index(x: Column, edges: Column) -> Column:
    """Bin number of x for ascending edges e0..eq: (left, right] bins, lowest closed.

    Returns 1..q; NULL outside [e0, eq] or for NULL x.
    """
    n_lt = F.size(F.filter(edges, lambda e: e < x))
    inside = (x >= F.element_at(edges, 1)) & (x <= F.element_at(edges, -1))
    return F.when(x.isNotNull() & inside, F.greatest(n_lt, F.lit(1)))


def bin_join(df: DataFrame, col: str, bins: DataFrame, out: str = "bin", by: str | None = None) -> DataFrame:
    """Assign each row its interval from a small bin table.

    ``bins`` has an ``edges`` array column (ascending), and, for nested bins, the
    key ``by`` of the outer bin.  The table holds one row per outer bin (or one
    row), so the broadcast is bounded by the number of bins.
    """
    if by is None:
        # one edge list (bounded by the bin count) becomes a literal
        edges = bins.select("edges").collect()[0][0]
        return df.withColumn(out, edges_index(F.col(col), F.lit(edges)))
    b = bins.select(F.col(by).alias("__by"), F.col("edges").alias("__edges"))
    j = df.join(F.broadcast(b), df[by] == b["__by"], "left")
    return j.withColumn(out, edges_index(F.col(col), F.col("__edges"))).drop("__by", "__edges")


def scenario_grid(df: DataFrame, **values: Sequence) -> DataFrame:
    """Every row times every combination of the given scenario values.

    Expressed as ``explode`` of literal arrays: the row stays in its partition,
    so the expansion needs no join and no shuffle.
    """
    out = df
    for name, vals in values.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in vals])))
    return out


def rate_lookup(loans: DataFrame, preds_wide: DataFrame, id_col: str, rate_col: str, prefix: str = "irr_") -> DataFrame:
    """Prediction at the loan's rate rounded to an integer.

    ``preds_wide`` has one column per integer rate (``irr_5`` ...).  The tables are
    joined on the id alone, one row per loan, and the column is picked in the row
    (null where no column has the rate).
    """
    cols = [c for c in preds_wide.columns if c.startswith(prefix)]
    wide = preds_wide.select(id_col, F.struct(*[F.col(c).alias(c) for c in cols]).alias("__preds"))
    key = F.round(F.col(rate_col)).cast("int")
    pred = F.coalesce(*[F.when(key == int(c[len(prefix):]), F.col(f"__preds.{c}")) for c in cols])
    return loans.join(wide, id_col, "left").withColumn("pred", pred).drop("__preds")


def same_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: ids only in a, only in b, and in both."""
    x = a.select(F.col(key).alias("__k")).distinct().withColumn("__a", F.lit(1))
    y = b.select(F.col(key).alias("__k")).distinct().withColumn("__b", F.lit(1))
    j = x.join(y, "__k", "full_outer")
    return j.agg(
        F.count_if(F.col("__b").isNull()).alias("only_left"),
        F.count_if(F.col("__a").isNull()).alias("only_right"),
        F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("both"),
    )


def attach_first(wide: DataFrame, long: DataFrame, id_col: str, order_col: str, cols: Sequence[str]) -> DataFrame:
    """Per-id attributes (taken at the first ``order_col``) joined onto a wide table."""
    firsts = long.groupBy(id_col).agg(*[F.min_by(c, order_col).alias(c) for c in cols])
    return wide.join(firsts, id_col, "left")
