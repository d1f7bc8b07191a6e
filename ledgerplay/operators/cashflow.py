"""Cashflows and IRR.

Cashflows are long: (key, period, cf) with period 0 = -principal.  They are
summed per (key, period) first - a partial aggregate, so duplicate payment rows
or a hot key never reach one task as raw rows - and only then packed into one
short array per key (bounded by the number of periods).  The root finder is an
Arrow-batched pandas UDF that runs bisection for a whole batch of loans at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerplay.functions.formulas import annualize, pmt  # noqa: F401  (F1, F2 re-exported)

# --- fixed values -------------------------------------------------------------
IRR_LO, IRR_HI = -0.9999, 1e6    # monthly bracket; NPV is decreasing on it
IRR_STEPS = 100                  # bisection steps (width 1e-24 after 100 halvings)
# -------------------------------------------------------------------------------


def cashflows(loans: DataFrame, pays: DataFrame, key: str = "loan_id", principal: str = "loan_amnt",
              period: str = "mob", value: str = "paid") -> DataFrame:
    """Long cashflows: -principal at period 0 and the summed payments by period."""
    out0 = loans.select(F.col(key), F.lit(0).alias("period"), (-F.col(principal)).cast("double").alias("cf"))
    p = pays.select(F.col(key), F.col(period).cast("int").alias("period"), F.col(value).cast("double").alias("cf"))
    return out0.unionByName(p).groupBy(key, "period").agg(F.sum("cf").alias("cf"))


@F.pandas_udf(DoubleType())
def _irr_udf(periods: pd.Series, cfs: pd.Series) -> pd.Series:
    n = len(periods)
    if n == 0:
        return pd.Series([], dtype="float64")
    lens = np.fromiter((len(p) for p in periods), dtype=np.int64, count=n)
    flat_t = np.concatenate([np.asarray(p, dtype=np.float64) for p in periods]) if lens.sum() else np.zeros(0)
    flat_c = np.concatenate([np.asarray(c, dtype=np.float64) for c in cfs]) if lens.sum() else np.zeros(0)
    row = np.repeat(np.arange(n), lens)

    def npv(r: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=flat_c / np.power(1.0 + r[row], flat_t), minlength=n)

    lo = np.full(n, IRR_LO)
    hi = np.full(n, IRR_HI)
    f_lo, f_hi = npv(lo), npv(hi)
    inflow = np.bincount(row, weights=np.where(flat_t > 0, flat_c, 0.0), minlength=n)
    for _ in range(IRR_STEPS):
        mid = 0.5 * (lo + hi)
        pos = npv(mid) > 0
        lo = np.where(pos, mid, lo)
        hi = np.where(pos, hi, mid)
    res = 0.5 * (lo + hi)
    res = np.where((f_lo > 0) & (f_hi < 0), res, np.nan)
    res = np.where(inflow == 0, -1.0, res)
    return pd.Series(res)


def loan_irr(cf: DataFrame, key: str | Sequence[str] = "loan_id") -> DataFrame:
    """monthly IRR per key; no inflow at all -> -1; no root in the bracket -> NULL."""
    keys = [key] if isinstance(key, str) else list(key)
    packed = cf.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("period", "cf"))).alias("__s"))
    out = packed.select(*keys, _irr_udf(F.transform("__s", lambda s: s["period"]),
                                        F.transform("__s", lambda s: s["cf"])).alias("irr"))
    return out.withColumn("irr", F.nanvl("irr", F.lit(None).cast("double")))


def portfolio_irr(cf: DataFrame, ids: DataFrame, key: str = "loan_id", by: Sequence[str] = ()) -> DataFrame:
    """sum the cashflows of the chosen loans by period, one IRR per portfolio.

    Returns the monthly IRR and the yearly IRR in percent ((1+m)^12-1)*100.
    ``ids`` may carry ``by`` columns (portfolio keys).
    """
    chosen = cf.join(ids.select(key, *by), key, "inner")
    pooled = chosen.groupBy(*by, "period").agg(F.sum("cf").alias("cf"))
    if not by:
        pooled = pooled.withColumn("__p", F.lit(0))
    r = loan_irr(pooled, list(by) or ["__p"])
    r = r.withColumn("irr_year_pct", annualize("irr") * 100.0)
    return r.drop("__p") if not by else r


def irr_by_group(df: DataFrame, label: str, irr: str = "irr") -> DataFrame:
    """F8: mean IRR per predicted label."""
    return df.groupBy(label).agg(F.avg(irr).alias("mean_irr"), F.count(F.lit(1)).alias("n"))


def months_between_int(a: Column, b: Column) -> Column:
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def mock_secondary(loans: DataFrame, pays: DataFrame, buy_date: str, key: str = "loan_id",
                   issue: str = "issue_date") -> tuple[DataFrame, DataFrame]:
    """purchase mob = months from origination to one buy date; later payments only."""
    l2 = loans.withColumn("purchase_mob", months_between_int(F.col(issue), F.to_timestamp(F.lit(buy_date))))
    l2 = l2.where(F.col("purchase_mob") > 0)
    p2 = pays.join(l2.select(key, "purchase_mob"), key, "inner").where(F.col("mob") > F.col("purchase_mob"))
    return l2, p2


def outstanding_principal(amount: Column, monthly_rate: Column, n: Column, k: Column) -> Column:
    """Balance of a level-payment loan after k payments (closed form)."""
    g = F.pow(1.0 + monthly_rate, k)
    gn = F.pow(1.0 + monthly_rate, n)
    return F.when(monthly_rate == 0, amount * (1 - k / n)).otherwise(amount * (gn - g) / (gn - 1.0))


def secondary_cashflows(loans: DataFrame, pays: DataFrame, discounts: Sequence[float], key: str = "loan_id") -> DataFrame:
    """per (loan, discount): outflow = outstanding x (1-discount) at the purchase
    mob, then the later payments; periods counted from the purchase.

    ``loans`` needs (key, loan_amnt, int_rate [yearly %], term, purchase_mob);
    ``pays`` (key, mob, paid).  Discounts expand each loan by a fixed list.
    """
    r = F.col("int_rate") / 1200.0
    bal = outstanding_principal(F.col("loan_amnt"), r, F.col("term").cast("double"), F.col("purchase_mob").cast("double"))
    l2 = loans.withColumn("discount", F.explode(F.array(*[F.lit(float(d)) for d in discounts])))
    out0 = l2.select(key, "discount", F.lit(0).alias("period"), (-bal * (1 - F.col("discount"))).alias("cf"))
    later = pays.join(loans.select(key, "purchase_mob"), key, "inner").where(F.col("mob") > F.col("purchase_mob"))
    later = later.groupBy(key, (F.col("mob") - F.col("purchase_mob")).cast("int").alias("period")).agg(F.sum("paid").alias("cf"))
    later = later.withColumn("discount", F.explode(F.array(*[F.lit(float(d)) for d in discounts])))
    return out0.unionByName(later.select(key, "discount", "period", "cf")).groupBy(key, "discount", "period").agg(F.sum("cf").alias("cf"))


def history_features(pays: DataFrame, loans: DataFrame, key: str = "loan_id", pmt_col: str = "monthly_pmt",
                     share: float = 0.95) -> DataFrame:
    """pre-purchase features normalised by months on book.

    paid share of schedule, late share, longest late run (gaps-and-islands on
    the month grid), last payment ratio.  ``loans`` needs (key, purchase_mob,
    monthly_pmt); months 1..purchase_mob are generated per loan (bounded by
    the term), payments summed per (key, mob).
    """
    per = pays.groupBy(key, "mob").agg(F.sum("paid").alias("paid"))
    grid = loans.select(key, "purchase_mob", pmt_col).withColumn(
        "mob", F.explode(F.sequence(F.lit(1), F.greatest(F.col("purchase_mob"), F.lit(1)))))
    g = grid.where(F.col("mob") <= F.col("purchase_mob")).join(per, [key, "mob"], "left")
    late = F.col("paid").isNull() | (F.col("paid") < share * F.col(pmt_col))
    g = g.withColumn("__late", late)
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy("mob")
    # island id: mob minus running count of late months, constant along a late run
    g = g.withColumn("__island", F.col("mob") - F.sum(F.col("__late").cast("int")).over(w))
    runs = g.where("__late").groupBy(key, "__island").agg(F.count(F.lit(1)).alias("__run"))
    longest = runs.groupBy(key).agg(F.max("__run").alias("longest_late_run"))
    base = g.groupBy(key).agg(
        (F.sum(F.coalesce("paid", F.lit(0.0))) / F.sum(pmt_col)).alias("paid_share"),
        F.avg(F.col("__late").cast("double")).alias("late_share"),
        (F.max_by(F.coalesce("paid", F.lit(0.0)), "mob") / F.first(pmt_col)).alias("last_payment_ratio"),
    )
    return base.join(longest, key, "left").withColumn("longest_late_run", F.coalesce("longest_late_run", F.lit(0)))
