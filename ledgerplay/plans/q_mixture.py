"""Mixture of two normals and its density levels (M21), with SQL that repeats EM row by row."""

from __future__ import annotations

from ledgerplay.operators import mixture as MX
from ledgerplay.plans.common import ENRICHED_SQL, finish, r6
from ledgerplay.plans.q_eval import ev
from ledgerplay.plans.registry import register, with_views

COLS = ["score", "requested_amount"]
ROUNDS = 20
MASSES = [0.5, 0.8, 0.95]


def _log_part(j: int, x: str, y: str) -> str:
    det = f"(p{j} * s{j} - q{j} * q{j})"
    dx, dy = f"({x} - a{j})", f"({y} - b{j})"
    return f"(ln(w{j}) - ln(2 * pi()) - 0.5 * ln{det} - 0.5 * (s{j} * {dx} * {dx} - 2 * q{j} * {dx} * {dy} + p{j} * {dy} * {dy}) / {det})"


def _estimates(j: int) -> str:
    r = f"r{j}"
    ax, ay = f"sum({r} * x) / sum({r})", f"sum({r} * y) / sum({r})"
    return (f"sum({r}) / count(*) AS w{j}, {ax} AS a{j}, {ay} AS b{j}, sum({r} * x * x) / sum({r}) - pow({ax}, 2) + {MX.RIDGE} AS p{j}, "
            f"sum({r} * x * y) / sum({r}) - ({ax}) * ({ay}) AS q{j}, sum({r} * y * y) / sum({r}) - pow({ay}, 2) + {MX.RIDGE} AS s{j}")


_BOTH = f"{_estimates(1)}, {_estimates(2)}"
EM_SQL = ENRICHED_SQL + f""",
e AS (SELECT credit_score AS vx, requested_amount AS vy FROM enriched WHERE credit_score IS NOT NULL AND requested_amount IS NOT NULL),
st AS (SELECT avg(vx) AS mx, avg(vy) AS my, stddev_pop(vx) AS dx, stddev_pop(vy) AS dy FROM e),
z AS (SELECT (vx - mx) / dx AS x, (vy - my) / dy AS y FROM e, st),
em AS (SELECT 0 AS k, {_BOTH} FROM (SELECT x, y, CASE WHEN x < 0 THEN 1.0 ELSE 0.0 END AS r1, CASE WHEN x < 0 THEN 0.0 ELSE 1.0 END AS r2 FROM z)
  UNION ALL SELECT k + 1, {_BOTH} FROM (SELECT *, 1 - r1 AS r2 FROM (
    SELECT k, x, y, 1 / (1 + exp(least(700, {_log_part(2, 'x', 'y')} - {_log_part(1, 'x', 'y')}))) AS r1 FROM em, z WHERE k < {ROUNDS})) GROUP BY k),
fit AS (SELECT * FROM em WHERE k = {ROUNDS})"""


def _fit(spark, d):
    e = ev(spark, d).select(*COLS)
    return e, MX.fit_mixture(e, COLS, 2, ROUNDS)


@register("m21_mixture", with_views("offers", "bureau", recursive=True, extra=EM_SQL) + " UNION ALL ".join(
    f"SELECT {j - 1} AS component, {r6(f'w{j}', 4)} AS weight, {r6(f'mx + dx * a{j}', 4)} AS mean_x, {r6(f'my + dy * b{j}', 2)} AS mean_y, "
    f"{r6(f'sqrt(dx * dx * p{j})', 4)} AS dev_x, {r6(f'q{j} / sqrt(p{j} * s{j})', 4)} AS corr_xy, {r6(f'sqrt(dy * dy * s{j})', 2)} AS dev_y FROM fit, st" for j in (1, 2)))
def m21_mixture(spark, d):
    _, m = _fit(spark, d)
    t = m.table(spark).selectExpr("component", "weight", "mean_x", "sqrt(var_x) AS dev_x", "cov_xy / sqrt(var_x * var_y) AS corr_xy", "mean_y", "sqrt(var_y) AS dev_y")
    small = finish(t.drop("mean_y", "dev_y"), 4)
    return small.join(finish(t.select("component", "mean_y", "dev_y"), 2), "component")


_STEP = 2 * MX.REACH / (MX.GRID - 1)


@register("m21_density_levels", with_views("offers", "bureau", recursive=True, extra=EM_SQL + f""",
ax AS (SELECT {-MX.REACH} + {_STEP} * range AS v FROM range(0, {MX.GRID})),
g AS (SELECT exp({_log_part(1, 'gx.v', 'gy.v')}) + exp({_log_part(2, 'gx.v', 'gy.v')}) AS f FROM ax gx, ax gy, fit),
c AS (SELECT f, (sum(f) OVER (ORDER BY f DESC ROWS UNBOUNDED PRECEDING) - f) / sum(f) OVER () AS before FROM g),
l AS (SELECT CAST(t.q AS DOUBLE) AS mass, min(f) AS level FROM c, (VALUES {', '.join(f'({q})' for q in MASSES)}) t(q) WHERE before < t.q GROUP BY 1),
n AS (SELECT exp({_log_part(1, 'x', 'y')}) + exp({_log_part(2, 'x', 'y')}) AS f FROM z, fit)""") +
          f"SELECT mass, {r6('level', 5)} AS level, (SELECT count(*) FROM g WHERE g.f >= l.level * (1 - 1e-12)) AS cells, (SELECT count(*) FROM n WHERE n.f >= l.level) AS n_rows FROM l")
def m21_density_levels(spark, d):
    e, m = _fit(spark, d)
    return finish(MX.density_levels(e, m, MASSES), 5)
