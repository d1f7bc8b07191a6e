"""Mixtures of bivariate normal densities and their highest-density levels.

A round of EM is one aggregate of six weighted sums per component; the table is never
sorted, shuffled or collected.  The grid of the level search depends on its own size
only; the rows inside each level are counted in one pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerplay.session import cut_lineage

RIDGE = 1e-6   # added to the variances of every round (standardised units)
REACH = 3.0    # the grid covers this many deviations around the means
GRID = 61      # grid points per axis


@dataclass
class Mixture:
    """Weights, means and (var x, cov, var y) of the components, in standardised units."""

    cols: tuple[str, str]
    mean: tuple[float, float]
    dev: tuple[float, float]
    weight: list[float]
    center: list[tuple[float, float]]
    spread: list[tuple[float, float, float]]
    n: int

    def scaled(self) -> tuple[Column, Column]:
        return tuple((F.col(c) - m) / s for c, m, s in zip(self.cols, self.mean, self.dev))

    def table(self, spark) -> DataFrame:
        """One row per component in the units of the columns."""
        (mx, my), (dx, dy) = self.mean, self.dev
        rows = [(j, w, mx + dx * a, my + dy * b, dx * dx * p, dx * dy * q, dy * dy * s)
                for j, (w, (a, b), (p, q, s)) in enumerate(zip(self.weight, self.center, self.spread))]
        return spark.createDataFrame(rows, "component int, weight double, mean_x double, mean_y double, var_x double, cov_xy double, var_y double")


def log_normal2(x, y, center: tuple[float, float], spread: tuple[float, float, float]):
    """Log density of a bivariate normal at (x, y): columns or arrays."""
    p, q, s = spread
    det = p * s - q * q
    dx, dy = x - center[0], y - center[1]
    return (dx * dx * s - dx * dy * (2 * q) + dy * dy * p) * (-0.5 / det) - (math.log(2 * math.pi) + 0.5 * math.log(det))


def _log_parts(x, y, m: Mixture) -> list:
    return [log_normal2(x, y, c, s) + math.log(w) for w, c, s in zip(m.weight, m.center, m.spread)]


def _shares(x: Column, y: Column, m: Mixture) -> list[Column]:
    """Responsibility of each component, safe against underflow far out."""
    parts = _log_parts(x, y, m)
    top = F.greatest(*parts) if len(parts) > 1 else parts[0]
    raised = [F.exp(p - top) for p in parts]
    total = sum(raised[1:], raised[0])
    return [r / total for r in raised]


def density(x: Column, y: Column, m: Mixture) -> Column:
    parts = [F.exp(p) for p in _log_parts(x, y, m)]
    return sum(parts[1:], parts[0])


def fit_mixture(df: DataFrame, cols: Sequence[str], k: int = 2, rounds: int = 20) -> Mixture:
    """EM for ``k`` components on two columns, a fixed number of rounds.

    Rows with a null in either column take no part.  The start is a cut of the first
    column into k slices of equal width between -1.5 and 1.5 deviations (the outer ones
    open), so reruns agree.  A constant column, or a slice or component without rows, raises an error.
    """
    cx, cy = cols
    d = cut_lineage(df.select(F.col(cx).cast("double").alias(cx), F.col(cy).cast("double").alias(cy)).dropna())
    n, mx, my, sx, sy = d.agg(F.count("*"), F.avg(cx), F.avg(cy), F.stddev_pop(cx), F.stddev_pop(cy)).first()
    if not n or not sx or not sy:
        raise ValueError("a mixture needs two columns that vary")
    m = Mixture((cx, cy), (mx, my), (sx, sy), [], [], [], n)
    x, y = m.scaled()
    slice_no = F.greatest(F.lit(0), F.least(F.lit(k - 1), F.floor((x + 1.5) / 3.0 * k)))
    shares = [(slice_no == j).cast("double") for j in range(k)]
    for _ in range(rounds + 1):
        terms = [(F.lit(1.0)), x, y, x * x, x * y, y * y]
        named = d.select(*[s.alias(f"r{j}") for j, s in enumerate(shares)], *[t.alias(f"t{i}") for i, t in enumerate(terms)])
        got = named.agg(*[F.sum(F.col(f"r{j}") * F.col(f"t{i}")) for j in range(k) for i in range(6)]).first()
        m.weight, m.center, m.spread = [], [], []
        for j in range(k):
            r, a, b, aa, ab, bb = got[6 * j:6 * j + 6]
            if r <= 0:
                raise ValueError(f"component {j} has no rows")
            a, b = a / r, b / r
            m.weight.append(r / n)
            m.center.append((a, b))
            m.spread.append((aa / r - a * a + RIDGE, ab / r - a * b, bb / r - b * b + RIDGE))
        shares = _shares(x, y, m)
    return m


def density_levels(df: DataFrame, m: Mixture, masses: Sequence[float]) -> DataFrame:
    """Highest-density regions of the mixture: one row per mass.

    The density is taken at the points of a fixed grid (``REACH`` deviations, ``GRID``
    points an axis) and summed from the densest point on; the level is the density of the
    point at which the share of the grid's mass reaches ``mass``.  Returns mass, level
    (standardised units), cells (grid points at or above the level) and n_rows (complete
    rows of ``df`` there).
    """
    axis = np.linspace(-REACH, REACH, GRID)
    gx, gy = (g.ravel() for g in np.meshgrid(axis, axis))
    f = np.sort(sum(np.exp(p) for p in _log_parts(gx, gy, m)))[::-1]
    before = (np.cumsum(f) - f) / f.sum()
    levels = [(float(q), float(f[before < q][-1])) for q in masses]
    x, y = m.scaled()
    inside = df.select(*m.cols).dropna().select(density(x, y, m).alias("f"))
    counts = inside.agg(*[F.count_if(F.col("f") >= level).alias(f"n{i}") for i, (_, level) in enumerate(levels)])
    rows = F.array(*[F.struct(F.lit(q).alias("mass"), F.lit(level).alias("level"), F.lit(int((f >= level).sum())).cast("long").alias("cells"),
                              F.col(f"n{i}").alias("n_rows")) for i, (q, level) in enumerate(levels)])
    return counts.select(F.explode(rows).alias("s")).select("s.*")


def assign_component(df: DataFrame, m: Mixture, out: str = "component") -> DataFrame:
    """Likeliest component per row (smallest on ties; null where a column is null)."""
    x, y = m.scaled()
    parts = _log_parts(x, y, m)
    top = F.greatest(*parts) if len(parts) > 1 else parts[0]
    label = F.coalesce(*[F.when(p == top, F.lit(j)) for j, p in enumerate(parts)])
    return df.withColumn(out, F.when(F.col(m.cols[0]).isNotNull() & F.col(m.cols[1]).isNotNull(), label))
