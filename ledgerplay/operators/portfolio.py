"""Portfolio curves, pricing and pool selection.

Per-loan work (scenario grids over rates, discounts or weights) is an
``explode`` of a fixed list - the loan's rows stay in their partition - and
the choice per loan is ``max_by`` (a partial aggregate).  Only per-scenario
totals (a handful of rows) are ever ordered globally.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerplay.operators import cashflow as C
from ledgerplay.operators import stats as M
from ledgerplay.operators import windows as W
from ledgerplay.operators.prefix import join_null_safe, prefix_agg
from ledgerplay.session import cut_lineage

BINS = 512  # ranges of one combination in one pass
OPEN_SHARE = 0.25  # rows put in order, as a share of the table


def volume_irr_curve(binned: DataFrame, cf: DataFrame, bin_col: str = "bin", key: str = "loan_id",
                     amount: str = "loan_amnt") -> DataFrame:
    """bins best first; after each bin the volume so far and the IRR of all
    cashflows so far.

    Cashflows are summed per (bin, period) - a small table - completed to the
    full bins x periods grid by ``explode`` and accumulated over bins with a
    window per period.  One IRR per bin prefix.
    """
    b = binned.where(F.col(bin_col).isNotNull())
    per = cf.join(b.select(key, bin_col), key, "inner").groupBy(bin_col, "period").agg(F.sum("cf").alias("cf"))
    # full bins x periods grid, built from the small (bin, period) table itself:
    # the last period comes from a window over that table, then each bin row
    # expands to 0..last (no join of bins with periods)
    lastp = per.withColumn("__last", F.max("period").over(Window.partitionBy())).groupBy(bin_col).agg(F.max("__last").alias("__last"))
    grid = lastp.select(bin_col, F.explode(F.sequence(F.lit(0), F.col("__last"))).alias("period"))
    full = grid.join(per, [bin_col, "period"], "left").fillna({"cf": 0.0})
    w = Window.partitionBy("period").orderBy(F.col(bin_col).desc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = full.withColumn("cf", F.sum("cf").over(w))
    irr = C.loan_irr(cum, bin_col)
    vol = b.groupBy(bin_col).agg(F.sum(amount).alias("__v"))
    wv = Window.orderBy(F.col(bin_col).desc()).rowsBetween(Window.unboundedPreceding, 0)
    vol = vol.select(bin_col, F.sum("__v").over(wv).alias("volume"))  # one row per bin
    return vol.join(irr, bin_col).withColumn("irr_year_pct", C.annualize("irr") * 100.0)


def compare_curves(df: DataFrame, cf: DataFrame, scores: Sequence[str], q: int = 25, key: str = "loan_id",
                   amount: str = "loan_amnt") -> DataFrame:
    """the F5 curve for several score columns (score_name in the keys)."""
    outs = []
    for s in scores:
        b = W.qcut(df.select(key, amount, s), s, q)
        outs.append(volume_irr_curve(b, cf, "bin", key, amount).withColumn("score_name", F.lit(s)))
    res = outs[0]
    for o in outs[1:]:
        res = res.unionByName(o)
    return res


def irr_at_share(df: DataFrame, cf: DataFrame, score: str, amount: str, share: float, key: str = "loan_id") -> DataFrame:
    """IRR of the best ``share`` of volume by score."""
    top = W.top_by_volume(df.select(key, score, amount), score, amount, share, key)
    return C.portfolio_irr(cf, top.select(key), key)


def expected_volume(df: DataFrame, p: str, amount: str, by: Sequence[str] = ()) -> DataFrame:
    """sum of p * amount."""
    return df.groupBy(*by).agg(F.sum(F.col(p) * F.col(amount)).alias("expected_volume"))


def _best_option(opts: str, objective) -> F.Column:
    """Best struct of a per-loan option array by ``objective(option)``; ties: lower rate.

    ``array_max`` over (objective, -rate, option): the choice is made inside the
    loan's row, so choosing needs no shuffle at all.
    """
    ranked = F.transform(opts, lambda o: F.struct(objective(o).alias("__obj"), (-o["rate"]).alias("__r"), o.alias("o")))
    return F.array_max(ranked)["o"]


def reprice(loans: DataFrame, opts: str, amount: str, objective: str = "volume") -> DataFrame:
    """per loan the rate with the largest expected volume (or IRR), then totals.

    ``opts`` is an array<struct<rate, p, irr>> per loan (one entry per rate of
    the grid).  One aggregate for the totals.
    """
    if objective == "volume":
        best = _best_option(opts, lambda o: o["p"] * F.col(amount))
    else:
        best = _best_option(opts, lambda o: o["irr"])
    b = loans.select(F.col(amount).alias("__a"), best.alias("b")).select("__a", "b.*")
    pv = F.col("p") * F.col("__a")
    return b.agg(F.sum(pv).alias("expected_volume"), (F.sum(pv * F.col("irr")) / F.sum(pv)).alias("mean_irr"),
                 F.avg("rate").alias("mean_rate"), F.count(F.lit(1)).alias("n_loans"))


def price_sweep(loans: DataFrame, opts: str, amount: str, lambdas: Sequence[float]) -> DataFrame:
    """for each weight l choose per loan the rate maximising
    l * p*amount/scale + (1-l) * p*irr; totals per l.

    Each loan row is expanded by the weight list only; the choice per
    (loan, weight) is an array operation in the row, and the totals per weight
    are one partially aggregated group-by (as many groups as weights).
    """
    scale = loans.agg(F.avg(amount)).collect()[0][0] or 1.0
    g = loans.select(F.col(amount).alias("__a"), opts).withColumn("lam", F.explode(F.array(*[F.lit(float(x)) for x in lambdas])))
    best = _best_option(opts, lambda o: F.col("lam") * o["p"] * F.col("__a") / scale + (1 - F.col("lam")) * o["p"] * o["irr"])
    b = g.select("lam", "__a", best.alias("b")).select("lam", "__a", "b.*")
    pv = F.col("p") * F.col("__a")
    return b.groupBy("lam").agg(F.sum(pv).alias("volume"), (F.sum(pv * F.col("irr")) / F.sum(pv)).alias("mean_irr"))


def nearest_to_volume(sweep: DataFrame, target: float) -> DataFrame:
    """the sweep point whose volume is closest to ``target``."""
    return sweep.agg(F.min_by(F.struct("lam", "volume", "mean_irr"), F.struct(F.abs(F.col("volume") - target), "lam")).alias("b")).select("b.*")


def pareto_front(points: DataFrame, x: str, y: str) -> DataFrame:
    """points not dominated: in order of x descending, y above every y before."""
    cum = prefix_agg(points, x, [y], how="max", desc=True, inclusive=False, tie_cols=[y])
    return cum.where(F.col(f"{y}_cum").isNull() | (F.col(y) > F.col(f"{y}_cum"))).drop(f"{y}_cum")


def secondary_pool(loans: DataFrame, buy_date: str, issue: str = "issue_date") -> DataFrame:
    """purchase mob from origination to one buy date; loans still running."""
    pm = C.months_between_int(F.col(issue), F.to_timestamp(F.lit(buy_date)))
    return loans.withColumn("purchase_mob", pm).where((F.col("purchase_mob") > 0) & (F.col("purchase_mob") < F.col("term")))


def discount_sweep(pool: DataFrame, pays: DataFrame, discounts: Sequence[float], score: str, share: float,
                   key: str = "loan_id", amount: str = "loan_amnt") -> DataFrame:
    """F16: IRR of the best ``share`` of the pool (by score) at each discount."""
    top = W.top_by_volume(pool.select(key, score, amount), score, amount, share, key)
    cf = C.secondary_cashflows(pool.join(top.select(key), key, "left_semi"), pays, discounts, key)
    pooled = cf.groupBy("discount", "period").agg(F.sum("cf").alias("cf"))
    return C.loan_irr(pooled, "discount").withColumn("irr_year_pct", C.annualize("irr") * 100.0)


def balance_selection(df: DataFrame, bin_cols: Sequence[str], score: str, amount: str, share: float,
                      key: str = "loan_id") -> DataFrame:
    """the best ``share`` of volume inside every joint bin (distributions kept)."""
    cum = prefix_agg(df, score, [amount], desc=True, tie_cols=[key], inclusive=False, by=list(bin_cols), total_suffix="_all")
    return cum.where(F.col(f"{amount}_cum") < share * F.col(f"{amount}_all")).drop(f"{amount}_cum", f"{amount}_all")


def constrained_selection(df: DataFrame, score: str, amount: str, share: float, guards: Sequence[str],
                          mus: Sequence[float], key: str = "loan_id") -> DataFrame:
    """best ``share`` of volume by the penalised score s - mu * sum_j z_j,
    for every mu of a grid at once; a grid point is feasible when the guard
    means of the rows *not* chosen are not below the pool's.

    z_j are the standardised guards (one statistics row).  Each row is expanded
    by the mu list; running volume per mu comes from range-bucketed prefix sums
    partitioned by mu, so all grid points are one pass.
    """
    st = df.agg(*[F.avg(g).alias(f"m_{g}") for g in guards], *[F.stddev_pop(g).alias(f"s_{g}") for g in guards]).collect()[0]
    z = sum(((F.col(g) - st[f"m_{g}"]) / (st[f"s_{g}"] or 1.0) for g in guards), F.lit(0.0))
    total = df.agg(F.sum(amount)).collect()[0][0] or 0.0
    d = df.select(key, score, amount, *guards).withColumn("mu", F.explode(F.array(*[F.lit(float(m)) for m in mus])))
    d = d.withColumn("__pen", F.col(score) - F.col("mu") * z)
    cum = prefix_agg(d, "__pen", [amount], desc=True, tie_cols=[key], inclusive=False, by=["mu"])
    cum = cum.withColumn("__sel", F.col(f"{amount}_cum") < share * total)
    agg = cum.groupBy("mu").agg(
        F.avg(F.when(F.col("__sel"), F.col(score))).alias("mean_score_selected"),
        *[F.avg(F.when(~F.col("__sel"), F.col(g))).alias(f"rest_{g}") for g in guards])
    feas = None
    for g in guards:
        c = F.col(f"rest_{g}") >= F.lit(st[f"m_{g}"])
        feas = c if feas is None else feas & c
    return agg.withColumn("feasible", feas)


def best_feasible_selection(df: DataFrame, score: str, amount: str, share: float, guards: dict[str, int], multipliers: Sequence[float],
                            rounds: int = 1, key: str = "loan_id") -> DataFrame:
    """the best ``share`` of volume by score whose guard means are no worse than the pool's.

    ``guards`` gives the direction of each guard column: +1, the selected rows' mean must
    not be below the pool's, -1, not above.  A row's penalised score is its standardised
    score plus, per guard, multiplier * direction * standardised guard (the Lagrangian).
    All combinations of ``multipliers`` are one job.  A combination's selection ends at one row,
    found without ordering the table once per combination: one aggregate gives the volume of ``BINS``
    equal ranges of each combination's penalised score, the ranges above the end count whole, and the
    range that holds the end is divided again (by the key, when all its rows have one score) until
    the open ranges together hold at most ``OPEN_SHARE`` of the table's rows; only those are
    put in order.  (Keys that are no numbers are not divided.  With negative amounts the running
    volume may fall again, so all rows are put in order.)  The feasible combination with
    the largest mean score wins (ties: the first); each further round tries
    the combinations half a step around it.  Returns the selected rows (key, score, amount,
    guards) with the winning ``mu`` per guard, and no rows if no combination is feasible.
    """
    names = list(guards)
    d = cut_lineage(df.select(key, score, amount, *names).dropna())
    st = d.agg(F.count("*").alias("n"), F.sum(amount).alias("total"), F.min(amount).alias("least"), *[f(c).alias(f"{n}_{c}") for c in [score, *names] for n, f in
               (("m", F.avg), ("s", F.stddev_pop), ("lo", F.min), ("hi", F.max))]).first()
    target = share * st["total"] if st["n"] else 0.0
    falling = bool(st["n"]) and st["least"] < 0
    numeric = isinstance(d.schema[key].dataType, T.NumericType)
    place = F.col(key).cast("double") if numeric else F.lit(0.0)
    means = [score, *names]

    def z(c: str):
        return (F.col(c) - F.lit(st[f"m_{c}"])) / F.lit(st[f"s_{c}"] or 1.0)

    def penalised(mu):
        return sum((mu[f"mu_{g}"] * float(s) * z(g) for g, s in guards.items()), z(score))

    def whole(no: int, mus: tuple[float, ...]) -> dict:
        """A combination of which nothing is known: bounds of its penalised scores, all rows open."""
        lo = hi = 0.0
        for c, by in zip(means, [1.0, *[float(s) * m for s, m in zip(guards.values(), mus)]]):
            ends = [by * (st[f"{e}_{c}"] - st[f"m_{c}"]) / (st[f"s_{c}"] or 1.0) for e in ("lo", "hi")]
            lo, hi = lo + min(ends), hi + max(ends)
        slack = 1e-9 * (1.0 + abs(lo) + abs(hi))  # the rows' own rounding
        return {"no": no, "lo": lo - slack, "hi": hi + slack, "first": -math.inf, "last": math.inf, "n": st["n"], "above": {c: 0.0 for c in ["__n", amount, *means]}}

    def open_rows(grid, state: list[dict]) -> DataFrame:
        """The rows of every combination's open range, with __no and __pen."""
        options = F.array(*[F.struct(F.lit(x["no"]).alias("no"), *[F.lit(float(m)).alias(f"mu_{g}") for g, m in zip(names, grid[x["no"]])],
                                     *[F.lit(float(x[e])).alias(e) for e in ("lo", "hi", "first", "last")]) for x in state])
        rows = d.withColumn("__mu", F.explode(options)).withColumn("__pen", penalised(F.col("__mu")))
        return rows.where(F.col("__pen").between(F.col("__mu.lo"), F.col("__mu.hi")) & place.between(F.col("__mu.first"), F.col("__mu.last"))).withColumn("__no", F.col("__mu.no"))

    def narrowed(grid, state: list[dict]) -> list[dict]:
        """Each open range cut down to the one of its ``BINS`` parts that holds the end."""
        at = F.when(F.col("__mu.hi") > F.col("__mu.lo"), (F.col("__mu.hi") - F.col("__pen")) / (F.col("__mu.hi") - F.col("__mu.lo")))
        at = at.otherwise((place - F.col("__mu.first")) / (F.col("__mu.last") - F.col("__mu.first")))
        sums = {"__n": F.count("*").cast("double"), **{c: F.sum(c).cast("double") for c in [amount, *means]}}
        ends = {"lo": F.min("__pen"), "hi": F.max("__pen"), "first": F.min(place), "last": F.max(place)}
        parts = open_rows(grid, state).groupBy("__no", F.least(F.floor(at * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).agg(
            *[v.alias(f"in_{c}") for c, v in sums.items()], *[v.alias(e) for e, v in ends.items()])
        earlier = Window.partitionBy("__no").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # at most BINS rows each
        known = F.create_map(*[F.lit(v) for x in state for v in (x["no"], float(x["above"][amount]))])
        parts = parts.withColumns({f"before_{c}": F.coalesce(F.sum(f"in_{c}").over(earlier), F.lit(0.0)) for c in sums})
        parts = parts.where(F.col(f"before_{amount}") + known[F.col("__no")] < target)
        held = parts.groupBy("__no").agg(F.max_by(F.struct(*[c for c in parts.columns if c != "__no"]), "bin").alias("p")).collect()  # one row per combination
        last = {r["__no"]: r["p"] for r in held}
        return [{"no": x["no"], **{e: p[e] for e in ends}, "n": int(p["in___n"]), "above": {c: x["above"][c] + p[f"before_{c}"] for c in sums}}
                for x in state for p in [last[x["no"]]]]

    def outcome(grid: list[tuple[float, ...]]) -> list:
        """(mean score, combination, its last selected row) of the feasible combinations, best first."""
        if not target > 0 and not falling:
            return []
        state = [whole(i, mus) for i, mus in enumerate(grid)]
        while not falling and sum(x["n"] for x in state) > OPEN_SHARE * st["n"]:
            wide = [x for x in state if x["hi"] > x["lo"] or (numeric and x["last"] > x["first"])]
            if not wide:
                break
            cut = {x["no"]: x for x in narrowed(grid, wide)}
            state = [cut.get(x["no"], x) for x in state]
        cum = prefix_agg(open_rows(grid, state).select(key, amount, *means, "__no", "__pen"), "__pen", [amount], desc=True, tie_cols=[key], inclusive=False, by=["__no"])
        known = F.create_map(*[F.lit(v) for x in state for v in (x["no"], float(x["above"][amount]))])
        picked = cum.where(F.col(f"{amount}_cum") + known[F.col("__no")] < target).groupBy("__no").agg(
            F.count("*").alias("__n"), *[F.sum(c).alias(c) for c in means], F.max(F.struct((-F.col("__pen")).alias("p"), F.col(key).alias("k"))).alias("__end"))
        found = []
        for r in picked.collect():  # one row per combination
            above = state[r["__no"]]["above"]
            mean = {c: (above[c] + r[c]) / (above["__n"] + r["__n"]) for c in means}
            if all(s * (mean[g] - st[f"m_{g}"]) >= 0 for g, s in guards.items()):
                found.append((mean[score], grid[r["__no"]], (-r["__end"]["p"], r["__end"]["k"])))
        return sorted(found, key=lambda x: (-x[0], grid.index(x[1])))

    grid = list(itertools.product(multipliers, repeat=len(names)))
    best: tuple[float, tuple[float, ...], tuple] | None = None
    step = min((b - a for a, b in itertools.pairwise(sorted(multipliers))), default=1.0)
    for _ in range(rounds):
        found = outcome(grid)
        if found and (best is None or found[0][0] > best[0]):
            best = found[0]
        if best is None:
            return d.limit(0).withColumns({f"mu_{g}": F.lit(0.0) for g in names})
        step /= 2
        grid = [tuple(max(0.0, m + k * step) for m, k in zip(best[1], ks)) for ks in itertools.product((-1, 0, 1), repeat=len(names))]
        grid = list(dict.fromkeys(grid))
    chosen = {f"mu_{g}": F.lit(float(m)) for g, m in zip(names, best[1])}
    rows = d.withColumn("__pen", penalised(chosen))
    if falling:
        cum = prefix_agg(rows, "__pen", [amount], desc=True, tie_cols=[key], inclusive=False)
        rows = cum.where(F.col(f"{amount}_cum") < target)
    else:
        pen, last = F.lit(best[2][0]), F.lit(best[2][1])
        rows = rows.where((F.col("__pen") > pen) | ((F.col("__pen") == pen) & (F.col(key) <= last)))
    return rows.select(key, score, amount, *names).withColumns(chosen)


def late_vs_population(sched: DataFrame, pays: DataFrame, bureau: DataFrame, n: int, key: str = "loan_id",
                       share: float = 0.95, alpha: float = 0.05) -> DataFrame:
    """M7: per month and town, is the late share higher than in the other towns?
    One-sided pooled z test per (month, town), then the step-up correction."""
    # a loan is late in a month unless its payments of the month reach the share: counting the
    # loans that paid needs only rows of the payment table, no grid of loans and months
    town = cut_lineage(sched.select(key, "id", "monthly_pmt").join(bureau.select("id", "town"), "id").select(key, "monthly_pmt", "town"))
    months = pays.where(F.col("mob").between(1, n)).groupBy(key, "mob").agg(F.sum("paid").alias("paid"))
    paid = months.where(F.col("paid").isNotNull()).join(town, key).where(~F.coalesce(F.col("paid") < share * F.col("monthly_pmt"), F.lit(False)))
    paid = paid.groupBy("town", "mob").agg(F.count(F.lit(1)).cast("double").alias("paid"))
    loans = town.groupBy("town").agg(F.count(F.lit(1)).cast("double").alias("n_a")).withColumn("mob", F.explode(F.sequence(F.lit(1), F.lit(n))))
    t = join_null_safe(loans, paid, ["town", "mob"], "left").withColumn("x_a", F.col("n_a") - F.coalesce("paid", F.lit(0.0)))
    all_towns = t.groupBy("mob").agg(F.sum("n_a").alias("__n"), F.sum("x_a").alias("__x"))  # one row per month
    t = t.join(F.broadcast(all_towns), "mob").withColumns({"n_b": F.col("__n") - F.col("n_a"), "x_b": F.col("__x") - F.col("x_a")})
    t = M.two_sample(t, F.col("n_a"), F.col("x_a"), F.col("n_b"), F.col("x_b"), "larger").where(F.col("p_value").isNotNull())
    return M.benjamini_hochberg(t, alpha=alpha, tie=["mob", "town"]).select("mob", "town", "n_a", "x_a", "z", "p_value", "reject_bh")
