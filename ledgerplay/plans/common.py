"""Helpers shared by the query modules: result rounding on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerplay.functions.formulas import norm_cdf_sql, norm_sf_sql


def round_half_away(c, digits: int = 6):
    """round(x * 10^d) / 10^d with halves away from zero: the same double that
    ``round(x, d)`` gives in engines that round the scaled binary value."""
    m = float(10 ** digits)
    return F.round(c.cast("double") * m, 0) / m + F.lit(0.0)


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (and fold -0.0) so results compare exactly."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = round_half_away(F.col(f"`{f.name}`"), digits)
    return df.withColumns(out) if out else df


def r6(expr: str, d: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {d}) + 0.0)"


def phi(expr: str) -> str:
    return norm_cdf_sql(expr)


def z2_sql(n1: str, x1: str, n2: str, x2: str) -> str:
    """Pooled two-sample z (NULL for empty groups or zero variance)."""
    ph = f"(({x1})+({x2}))/(({n1})+({n2}))"
    var = f"({ph})*(1-({ph}))*(1.0/({n1})+1.0/({n2}))"
    return f"(CASE WHEN ({n1}) > 0 AND ({n2}) > 0 AND {var} > 0 THEN (({x1})/({n1})-({x2})/({n2}))/sqrt({var}) END)"


def p2_sql(z: str) -> str:
    return f"(2.0*{norm_sf_sql(f'abs({z})')})"


LAST_OFFER_SQL = """last_offer AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id
  ORDER BY offer_date DESC, offer_key DESC) AS rn FROM offers) WHERE rn = 1)"""

ENRICHED_SQL = LAST_OFFER_SQL + """,
enriched AS (SELECT last_offer.*, bureau.credit_score, bureau.segment, bureau.state, bureau.town
  FROM last_offer LEFT JOIN bureau USING (id))"""
