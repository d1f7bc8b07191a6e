"""Query registry: name -> (DataFrame builder, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerplay.plans import bindings as B

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

VIEW_SQL = {
    "offers": B.OFFERS_SQL,
    "bureau": B.BUREAU_SQL,
    "payments": B.PAYMENTS_SQL,
    "loans": B.LOANS_SQL,
    "houses": B.HOUSES_SQL,
    "battles": B.BATTLES_SQL,
    "planets": B.PLANETS_SQL,
    "fleets": B.FLEETS_SQL,
    "planet_turns": B.PLANET_TURNS_SQL,
    "fleet_turns": B.FLEET_TURNS_SQL,
}


def _bigint_counts(sql: str) -> str:
    """Wrap every ``count_if(...)`` in ``CAST(... AS BIGINT)`` (the check engine
    returns a 128-bit integer for it; the engine's type is 64-bit)."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(tok) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _bigint_counts(sql[j + len(tok):k])
        out.append(sql[i:j] + f"CAST(count_if({inner}) AS BIGINT)")
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = (fn, _bigint_counts(sql) if sql else sql)
        return fn
    return deco


def with_views(*names: str, extra: str = "", recursive: bool = False) -> str:
    """``WITH [RECURSIVE] <views>[, <extra CTEs>]`` prefix for an oracle statement."""
    parts = [VIEW_SQL[n] for n in names]
    if extra:
        parts.append(extra)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"
