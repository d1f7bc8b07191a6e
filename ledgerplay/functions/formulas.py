"""Shared closed forms (normal distribution, rounding, hashing, annuities)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Chebyshev fit of erfc (Numerical Recipes), relative error ~1.2e-7 everywhere.
# Coefficients in the order they appear in the nested polynomial:
ERFC_COEFFS = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)
# Portable hash: two primes below 2^31 (so products stay inside BIGINT) and odd
# multipliers; 5 is prime to HASH_P - 1, so x^5 permutes the residues.
HASH_P = 2147483647
HASH_Q = 2147483629
HASH_MULTIPLIERS = (1103515245, 1013904223, 1140671485, 1664525, 22695477, 134775813)
# ---------------------------------------------------------------------------


def _erfc_pos_sql(z: str) -> str:
    """erfc(z) for z >= 0 as SQL text."""
    t = f"(1.0/(1.0+0.5*({z})))"
    poly = str(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[1:-1]):
        poly = f"({c}+{t}*{poly})"
    poly = f"({ERFC_COEFFS[0]}+{t}*{poly})"
    return f"({t}*exp(-({z})*({z})+{poly}))"


def norm_cdf_sql(x: str) -> str:
    """Phi(x) = erfc(-x/sqrt2)/2 with the sign handled explicitly."""
    z = f"(abs({x})/sqrt(2.0))"
    e = _erfc_pos_sql(z)
    return f"(CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) >= 0 THEN 1.0-0.5*{e} ELSE 0.5*{e} END)"


def norm_pdf_sql(x: str) -> str:
    return f"(exp(-0.5*({x})*({x}))/sqrt(2.0*pi()))"


def norm_sf_sql(x: str) -> str:
    """1 - Phi(x) without the cancellation of 1 - cdf: tails keep their digits."""
    e = _erfc_pos_sql(f"(abs({x})/sqrt(2.0))")
    return f"(CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) >= 0 THEN 0.5*{e} ELSE 1.0-0.5*{e} END)"


def norm_cdf(c) -> Column:
    return F.expr(norm_cdf_sql(_sql(c)))


def norm_sf(c) -> Column:
    return F.expr(norm_sf_sql(_sql(c)))


def norm_pdf(c) -> Column:
    return F.expr(norm_pdf_sql(_sql(c)))


def _erfc_py(z: float) -> float:
    t = 1.0 / (1.0 + 0.5 * z)
    poly = ERFC_COEFFS[-1]
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = c + t * poly
    return t * math.exp(-z * z + poly)


def norm_cdf_py(x: float) -> float:
    e = _erfc_py(abs(x) / math.sqrt(2.0))
    return 1.0 - 0.5 * e if x >= 0 else 0.5 * e


def norm_ppf(p: float) -> float:
    """Inverse of ``norm_cdf_py`` by bisection (driver-side, for literal levels)."""
    if not 0.0 < p < 1.0:
        raise ValueError("p must be in (0, 1)")
    lo, hi = -40.0, 40.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if norm_cdf_py(mid) < p:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def rnd_sql(x: str, d: int = 6) -> str:
    """Round and fold -0.0 into 0.0 so that values hash the same everywhere."""
    return f"(round({x}, {d}) + 0.0)"


def rnd(c, d: int = 6) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), d) + F.lit(0.0)


def hash31_sql(*keys: str) -> str:
    """Portable hash of up to three integers into [0, HASH_P): the same in any SQL engine.

    Each key enters by its residues to two primes, so all 62 low bits count; the
    fifth power breaks the linear order of consecutive keys.
    """
    terms = []
    for n, key in enumerate(keys):
        k = f"CAST({key} AS BIGINT)"
        for m, p in zip(HASH_MULTIPLIERS[2 * n:2 * n + 2], (HASH_P, HASH_Q)):
            terms.append(f"((({k}) % {p} + {p}) % {p}) * {m} % {HASH_P}")
    x = f"(({' + '.join(terms)} + 12345) % {HASH_P})"
    x2 = f"({x} * {x} % {HASH_P})"
    x4 = f"({x2} * {x2} % {HASH_P})"
    return f"(({x4} * {x} % {HASH_P}) * {HASH_MULTIPLIERS[0]} % {HASH_P})"


def unit_hash_sql(key: str, seed: int = 0) -> str:
    """Portable hash of an integer key into [0, 1), about 2^31 values."""
    return f"(CAST({hash31_sql(key, str(int(seed)))} AS DOUBLE) / {HASH_P})"


def unit_hash(key, seed: int = 0) -> Column:
    return F.expr(unit_hash_sql(_sql(key), seed))


def pmt_sql(rate: str, n: str, pv: str) -> str:
    """Level payment of an annuity; rate 0 -> pv/n.  Computed in DOUBLE."""
    r = f"CAST(({rate}) AS DOUBLE)"
    return (
        f"(CASE WHEN {r} = 0 THEN ({pv})/({n}) "
        f"ELSE ({pv})*{r}/(1.0-power(1.0+{r}, -({n}))) END)"
    )


def pmt(rate, n, pv) -> Column:
    return F.expr(pmt_sql(_sql(rate), _sql(n), _sql(pv)))


def annualize(monthly) -> Column:
    m = F.col(monthly) if isinstance(monthly, str) else monthly
    return F.pow(1.0 + m, 12.0) - 1.0


def deannualize(yearly) -> Column:
    a = F.col(yearly) if isinstance(yearly, str) else yearly
    return F.pow(1.0 + a, 1.0 / 12.0) - 1.0


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`" if c.isidentifier() else c
    raise TypeError("formula helpers take column names or SQL text")
