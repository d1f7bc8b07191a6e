"""Projections, filters and cleaning.

Column statistics needed to decide a projection (null counts, distinct counts)
are computed in ONE aggregate pass and only that one row reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerplay.functions.formulas import rnd
from ledgerplay.operators.prefix import exact_quantiles, join_null_safe

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def where(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Row filter (pushed into the scan by Catalyst when possible)."""
    return df.where(predicate)


def range_to_null(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Values outside [lo, hi] become NULL."""
    return df.withColumn(col, F.when(F.col(col).between(lo, hi), F.col(col)))


def clip(col: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a column."""
    c = F.col(col) if isinstance(col, str) else col
    if lo is not None:
        c = F.when(c.isNull(), None).otherwise(F.greatest(c, F.lit(lo)))
    if hi is not None:
        c = F.when(c.isNull(), None).otherwise(F.least(c, F.lit(hi)))
    return c


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Parse to double; unparsable -> NULL."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in cols})


def coerce_timestamp(df: DataFrame, cols: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Parse to timestamp; unparsable -> NULL."""
    def parse(c: str) -> Column:
        if fmt:
            return F.try_to_timestamp(F.col(c).cast("string"), F.lit(fmt))
        return F.try_to_timestamp(F.col(c).cast("string"))
    return df.withColumns({c: parse(c) for c in cols})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column (pandas skips NaN, Spark aggregates it)."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in fl})


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P5: drop rows with any NULL (in ``subset``)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One-row table: rows and missing count per column (single pass)."""
    cols = list(cols or df.columns)
    return df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value (one aggregate pass)."""
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).collect()[0]
    return df.drop(*[c for c in df.columns if row[c] == 0])


def drop_sparse_columns(df: DataFrame, threshold: float) -> DataFrame:
    """Drop columns whose missing share exceeds ``threshold``."""
    row = null_counts(df).collect()[0]
    n = row["__rows"] or 1
    return df.drop(*[c for c in df.columns if row[c] / n > threshold])


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, missing, percent) for columns with missing values, most first."""
    cols = list(cols or df.columns)
    wide = null_counts(df, cols)
    long = wide.unpivot("__rows", cols, "column", "missing")
    return (
        long.where(F.col("missing") > 0)
        .select("column", F.col("missing").cast("long").alias("missing"),
                rnd(F.col("missing") * 100.0 / F.col("__rows"), 2).alias("percent"))
    )


def select_by_type(df: DataFrame, include: str = "number") -> DataFrame:
    """Numeric ('number') or non-numeric ('object') columns."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    keep = num if include == "number" else [c for c in df.columns if c not in num]
    return df.select(*keep)


def dtype_counts(df: DataFrame) -> DataFrame:
    """Number of columns per Spark type (schema only, no data read)."""
    spark = df.sparkSession
    rows = {}
    for f in df.schema.fields:
        rows[f.dataType.simpleString()] = rows.get(f.dataType.simpleString(), 0) + 1
    return spark.createDataFrame(sorted(rows.items()), "dtype string, n_columns int")


def select_like(df: DataFrame, pattern: str) -> DataFrame:
    """P10: columns whose name matches a regex (substring match)."""
    rx = re.compile(pattern)
    return df.select(*[c for c in df.columns if rx.search(c)])


def rename_columns(df: DataFrame, fn: Callable[[str], str] | None = None, prefix: str | None = None) -> DataFrame:
    """Rename by a function or by adding a prefix."""
    f = fn or (lambda c: f"{prefix}{c}")
    return df.withColumnsRenamed({c: f(c) for c in df.columns if f(c) != c})


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P12."""
    return df.drop(*cols)


def target_from_null(df: DataFrame, col: str, out: str = "target") -> DataFrame:
    """target = column is not null (charge-off iff co_mob present)."""
    return df.withColumn(out, F.col(col).isNotNull())


def indicator(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """new = 1 if src > 0 else 0 (NULL -> 0)."""
    return df.withColumns({new: F.coalesce((F.col(src) > 0).cast("int"), F.lit(0)) for new, src in mapping.items()})


def cast_columns(df: DataFrame, cols: Sequence[str], to: str = "string") -> DataFrame:
    """E.g. integer categories read as strings."""
    return df.withColumns({c: F.col(c).cast(to) for c in cols})


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """NULL -> constant per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def fill_group_stat(df: DataFrame, fit: DataFrame, key: str, col: str, stat: str = "mean") -> DataFrame:
    """NULL -> mean/median of the row's group, statistics from ``fit`` only.

    The statistics table has one row per group; it is joined on the key (a
    broadcast when the optimizer sees it is small).
    """
    if stat == "mean":
        stats = fit.groupBy(key).agg(F.avg(col).alias("__fill"))
    else:
        from ledgerplay.operators.prefix import grouped_quantiles
        stats = grouped_quantiles(fit, col, [0.5], [key]).select(key, F.col("value").alias("__fill"))
    return join_null_safe(df, stats, [key], "left").withColumn(col, F.coalesce(F.col(col), F.col("__fill"))).drop("__fill")


def fill_mode(df: DataFrame, fit: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> most common value of ``fit`` (smallest on ties; a column without values stays NULL).

    Values are counted across the cluster first, so no task holds them all."""
    fill = {}
    for c in cols:
        n = fit.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        fill[c] = n.agg(F.min_by("v", F.struct(-F.col("n"), F.col("v")))).first()[0]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(fill[c])) for c in cols})


def fill_mean(df: DataFrame, fit: DataFrame, col: str) -> DataFrame:
    """NULL -> training mean."""
    m = fit.agg(F.avg(col)).collect()[0][0]
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(m)))


def iqr_fences(df: DataFrame, col: str | Column, k: float = 1.5) -> tuple[float, float, float, float]:
    """Q1, Q3 and the two fences, by exact distributed quantiles."""
    d = df.select((F.col(col) if isinstance(col, str) else col).cast("double").alias("__v"))
    q1, q3 = exact_quantiles(d, "__v", [0.25, 0.75])
    if q1 is None:  # no value at all: nothing is outside
        return None, None, float("-inf"), float("inf")
    iqr = q3 - q1
    return q1, q3, q1 - k * iqr, q3 + k * iqr


def drop_iqr_outliers(df: DataFrame, col: str, k: float = 1.5, slack: float = 0.0) -> DataFrame:
    """P20: keep rows with value <= Q3 + k*IQR + slack (NULLs kept)."""
    _, _, _, hi = iqr_fences(df, col, k)
    return df.where(F.col(col).isNull() | (F.col(col) <= hi + slack))


def outlier_share(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """P20: upper fence, rows above it, and their share of the rows with a value (one row)."""
    _, _, _, hi = iqr_fences(df, col, k)
    above, n = F.count_if(F.col(col) > hi), F.count(col)
    return df.agg(F.lit(hi).cast("double").alias("fence"), above.alias("n_above"), F.when(n > 0, above / n).alias("share"))


def count_outliers(df: DataFrame, col: str, k: float = 1.5, log: bool = True) -> DataFrame:
    """Counts below Q1-k*IQR and above Q3+k*IQR (on ln of positive values)."""
    expr = F.when(F.col(col) > 0, F.ln(col)) if log else F.col(col)
    _, _, lo, hi = iqr_fences(df, expr, k)
    return df.agg(F.count_if(expr < lo).alias("n_low"), F.count_if(expr > hi).alias("n_high"))


def low_variability(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct count per column, ascending (one pass)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_distinct")


def drop_lowest_variability(df: DataFrame, n: int) -> DataFrame:
    """Drop the n columns with the fewest distinct values."""
    rows = low_variability(df).orderBy("n_distinct", "column").limit(n).collect()
    return df.drop(*[r["column"] for r in rows])


def log_transform(df: DataFrame, col: str, base: str = "e", out: str | None = None) -> DataFrame:
    """Ln / log10 / log1p; non-positive -> NULL instead of -inf."""
    c = F.col(col)
    f = {"e": F.when(c > 0, F.ln(c)), "10": F.when(c > 0, F.log10(c)), "1p": F.when(c > -1, F.log1p(c))}[base]
    return df.withColumn(out or col, f)


def prepare_loans(df: DataFrame, rate_col: str, label: str | None = None, na_threshold: float | None = None,
                  timestamp_cols: Sequence[str] = ()) -> DataFrame:
    """Coerce, drop rows without rate (and label), drop sparse columns, keep numerics."""
    d = coerce_timestamp(df, timestamp_cols) if timestamp_cols else df
    d = drop_null_rows(d, [rate_col] + ([label] if label else []))
    if na_threshold is not None:
        d = drop_sparse_columns(d, na_threshold)
    return select_by_type(d, "number")


def tag_and_recombine(train: DataFrame, test: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """P25: tag, union, transform once, split back."""
    both = train.withColumn("set", F.lit("train")).unionByName(test.withColumn("set", F.lit("test")), allowMissingColumns=True)
    out = fn(both)
    return out.where(F.col("set") == "train").drop("set"), out.where(F.col("set") == "test").drop("set")


def invalid_cashflow_rows(loans: DataFrame, pays: DataFrame, id_col: str = "loan_id") -> DataFrame:
    """Per loan, flags of impossible monthly payment rows.

    A row is invalid when the payment is negative, or comes after the loan was
    fully repaid, or after ``co_mob``.  ``loans`` needs (id, loan_amnt, co_mob);
    ``pays`` needs (id, mob, paid) with one row per (id, mob).
    """
    from pyspark.sql import Window
    w = Window.partitionBy(id_col).orderBy("mob").rowsBetween(Window.unboundedPreceding, -1)
    p = pays.join(loans.select(id_col, "loan_amnt", "co_mob"), id_col, "inner")
    p = p.withColumn("paid_before", F.coalesce(F.sum("paid").over(w), F.lit(0.0)))
    bad = (F.col("paid") < 0) | ((F.col("paid_before") >= F.col("loan_amnt")) & (F.col("paid") > 0)) | (
        F.col("co_mob").isNotNull() & (F.col("mob") > F.col("co_mob")) & (F.col("paid") > 0))
    return p.groupBy(id_col).agg(F.bool_or(bad).alias("invalid"))


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys with more than one row, with their count."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
