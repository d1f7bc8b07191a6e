"""Feature helpers and splits.

Splits are keyed hashes, so a row's side does not depend on partitioning or
on the order rows arrive in (unlike ``randomSplit``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerplay.functions.formulas import unit_hash
from ledgerplay.operators.prefix import prefix_agg

MAX_CATEGORIES = 10_000


def standardize(df: DataFrame, fit: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / population std, statistics from ``fit`` (one aggregate row)."""
    st = fit.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).collect()[0]
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(st[f"m_{c}"])) / F.lit(st[f"s_{c}"]) for c in cols})


def one_hot(df: DataFrame, col: str, categories: Sequence[str] | None = None, prefix: str | None = None) -> DataFrame:
    """One 0/1 column per category, none dropped; NULL -> all zeros.

    Categories become columns, so they pass the driver; more than ``MAX_CATEGORIES`` raise
    an error (``ordinal_encode`` takes any number).
    """
    if categories is None:
        found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_CATEGORIES + 1).collect()
        if len(found) > MAX_CATEGORIES:
            raise ValueError(f"{col} has more than {MAX_CATEGORIES} categories")
        categories = sorted(r[0] for r in found)
    cats = categories
    pre = prefix if prefix is not None else f"{col}_"
    return df.withColumns({f"{pre}{c}": F.coalesce((F.col(col) == F.lit(c)).cast("int"), F.lit(0)) for c in cats})


def split_random(df: DataFrame, key: str, frac: float = 0.75, seed: int = 0, out: str = "set") -> DataFrame:
    """M31: 'train' when the key's portable hash is below ``frac``."""
    return df.withColumn(out, F.when(unit_hash(key, seed) < frac, "train").otherwise("test"))


def split_stratified(df: DataFrame, y: str, key: str, frac: float = 0.75, seed: int = 0, out: str = "set") -> DataFrame:
    """Within each class, the first round(frac * n_class) rows in hash order are 'train'.

    Position in hash order comes from running counts by ranges of (class, hash, key),
    so a class holding most rows is spread over many tasks.
    """
    d = df.withColumn("__h", unit_hash(key, seed)).withColumn("__one", F.lit(1.0))
    cum = prefix_agg(d, "__h", ["__one"], inclusive=True, tie_cols=[key], by=[y], total_suffix="_all")
    return cum.withColumn(out, F.when(F.col("__one_cum") <= F.round(F.col("__one_all") * frac), "train").otherwise("test")).drop(
        "__h", "__one", "__one_cum", "__one_all")


def split_by_date(df: DataFrame, col: str, cut: str, out: str = "set") -> DataFrame:
    """Out-of-time split: before ``cut`` is 'train'."""
    return df.withColumn(out, F.when(F.col(col) < F.to_timestamp(F.lit(cut)), "train").otherwise("test"))


def periodic_powers(df: DataFrame, x: str, k: int, prefix: str = "p") -> DataFrame:
    """Powers 1..k of x mod 2*pi."""
    m = F.pmod(F.col(x), F.lit(2 * math.pi))
    return df.withColumns({f"{prefix}{i}": F.pow(m, float(i)) for i in range(1, k + 1)})
