"""Game-log queries: G24-G30, W7, W14, W15, W18, W19, J14,
P27, T5-T7, B8, S6, S7."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerplay.operators import gamelog as GL
from ledgerplay.operators import windows as W
from ledgerplay.plans import bindings as B
from ledgerplay.plans.common import finish, r6
from ledgerplay.plans.registry import register, with_views
from ledgerplay.sources import gamefiles as GF

ME = 1

SIDES_SQL = """sides AS (
  SELECT battle_id, player_1_name AS player_name, player_2_name AS enemy_name, player_1_score AS player_score,
    player_2_score AS enemy_score, 1 AS player_number, winner, finish_state, turns FROM battles
  UNION ALL
  SELECT battle_id, player_2_name, player_1_name, player_2_score, player_1_score, 2, winner, finish_state, turns FROM battles),
sides2 AS (SELECT *, player_number = winner AS won, winner = 0 AS tie, NOT (player_number = winner) AND NOT (winner = 0) AS lost FROM sides)"""


def sides(spark, d):
    return GL.battle_sides(B.battles(spark, d))


@register("g24_battle_sides", with_views("battles", extra=SIDES_SQL) + "SELECT * FROM sides2")
def g24_battle_sides(spark, d):
    return sides(spark, d)


STANDINGS_SQL = SIDES_SQL + """,
st AS (SELECT player_name, count(*) AS battle_count, CAST(sum(CAST(won AS INTEGER)) AS BIGINT) AS won,
  CAST(sum(CAST(lost AS INTEGER)) AS BIGINT) AS lost, CAST(sum(CAST(tie AS INTEGER)) AS BIGINT) AS tie,
  CAST(sum(CAST(won AS INTEGER)) + 0.5 * sum(CAST(tie AS INTEGER)) AS DOUBLE) AS points,
  CAST(sum(player_score) AS BIGINT) AS total_score, CAST(sum(enemy_score) AS BIGINT) AS total_enemy_score,
  avg(player_score) AS mean_score, avg(enemy_score) AS mean_enemy_score,
  count_if(enemy_score = 0) AS killed_all_enemy_units, count_if(player_score = 0) AS all_units_died,
  count_if(player_number = 1 AND won) AS wins_as_player_1, count_if(player_number = 2 AND won) AS wins_as_player_2
  FROM sides2 GROUP BY player_name)"""


@register("g25_w7_standings", with_views("battles", extra=STANDINGS_SQL) + f"""SELECT player_name, battle_count, won, lost, tie,
  {r6('points')} AS points, total_score, total_enemy_score, {r6('mean_score')} AS mean_score, {r6('mean_enemy_score')} AS mean_enemy_score,
  killed_all_enemy_units, all_units_died, wins_as_player_1, wins_as_player_2,
  CAST(row_number() OVER (ORDER BY points DESC, player_name) AS INTEGER) AS rank FROM st""")
def g25_w7_standings(spark, d):
    return finish(GL.rank_standings(GL.standings(sides(spark, d))))


@register("g26_head_to_head", with_views("battles", extra=SIDES_SQL) + f"""SELECT enemy_name, count(*) AS battles, count_if(won) AS won,
  count_if(lost) AS lost, count_if(tie) AS tie, {r6('avg(player_score)')} AS mean_score, {r6('avg(enemy_score)')} AS mean_enemy_score
  FROM sides2 WHERE player_name = 'P1' GROUP BY enemy_name""")
def g26_head_to_head(spark, d):
    return finish(GL.head_to_head(sides(spark, d), "P1"))


@register("g27_ships_by_owner", with_views("planets", "fleets") + """SELECT game_id, turn, owner, CAST(sum(num_ships) AS BIGINT) AS ships FROM (
  SELECT game_id, turn, owner, num_ships FROM planets UNION ALL SELECT game_id, turn, owner, num_ships FROM fleets) GROUP BY ALL""")
def g27_ships_by_owner(spark, d):
    return GL.ships_by_owner(B.planets(spark, d), B.fleets(spark, d))


@register("g28_inflight_by_target", with_views("fleets") + f"""SELECT game_id, turn, destination_planet_id AS planet_id,
  CAST(sum(CASE WHEN owner = {ME} THEN num_ships ELSE 0 END) AS BIGINT) AS own_incoming,
  CAST(sum(CASE WHEN owner <> {ME} THEN num_ships ELSE 0 END) AS BIGINT) AS enemy_incoming, min(turns_remaining) AS first_arrival,
  CAST(sum(CASE WHEN owner = {ME} THEN num_ships ELSE 0 END) - sum(CASE WHEN owner <> {ME} THEN num_ships ELSE 0 END) AS BIGINT) AS net_incoming
  FROM fleets GROUP BY 1, 2, 3""")
def g28_inflight_by_target(spark, d):
    return GL.inflight_by_target(B.fleets(spark, d), ME)


@register("g29_contest_resolve", with_views("planets", "fleets", extra="""arr AS (SELECT game_id, turn, destination_planet_id AS planet_id, owner, num_ships FROM fleets WHERE turns_remaining = 0),
gar AS (SELECT game_id, turn, planet_id, owner, num_ships FROM planets WHERE (game_id, turn, planet_id) IN (SELECT game_id, turn, planet_id FROM arr)),
forces AS (SELECT game_id, turn, planet_id, owner, sum(num_ships) AS force FROM (SELECT * FROM gar UNION ALL SELECT * FROM arr) GROUP BY ALL),
f3 AS (SELECT game_id, turn, planet_id, sum(CASE WHEN owner = 0 THEN force ELSE 0 END) AS f0, sum(CASE WHEN owner = 1 THEN force ELSE 0 END) AS f1,
  sum(CASE WHEN owner = 2 THEN force ELSE 0 END) AS f2 FROM forces GROUP BY ALL),
r AS (SELECT f3.*, greatest(f0, f1, f2) AS mx, p.owner AS old_owner FROM f3 LEFT JOIN planets p USING (game_id, turn, planet_id)),
t AS (SELECT *, CAST(f0 = mx AS INTEGER) + CAST(f1 = mx AS INTEGER) + CAST(f2 = mx AS INTEGER) AS nmax,
  greatest(CASE WHEN f0 < mx THEN f0 ELSE -1 END, CASE WHEN f1 < mx THEN f1 ELSE -1 END, CASE WHEN f2 < mx THEN f2 ELSE -1 END) AS second FROM r)""") +
    """SELECT game_id, turn, planet_id, CAST(CASE WHEN nmax > 1 THEN old_owner WHEN f0 = mx THEN 0 WHEN f1 = mx THEN 1 ELSE 2 END AS INTEGER) AS owner,
  CAST(CASE WHEN nmax > 1 THEN 0 ELSE mx - second END AS BIGINT) AS num_ships FROM t""")
def g29_contest_resolve(spark, d):
    r = GL.contest_resolve(B.planets(spark, d), B.fleets(spark, d))
    return r.withColumn("owner", F.col("owner").cast("int"))


@register("g30_centroid", with_views("planets") + f"""SELECT game_id, turn, {r6('avg(x)')} AS cx, {r6('avg(y)')} AS cy, count(*) AS n_planets
  FROM planets WHERE owner = {ME} GROUP BY 1, 2""")
def g30_centroid(spark, d):
    return finish(GL.centroid(B.planets(spark, d), ME))


@register("g30_nearest_to_centroid", with_views("planets", extra=f"""c AS (SELECT game_id, turn, avg(x) AS cx, avg(y) AS cy FROM planets WHERE owner = {ME} GROUP BY 1, 2),
o AS (SELECT p.game_id, p.turn, p.planet_id, row_number() OVER (PARTITION BY p.game_id, p.turn
  ORDER BY (p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy), p.planet_id) AS rn FROM planets p JOIN c USING (game_id, turn) WHERE p.owner = {ME})""") +
    "SELECT game_id, turn, planet_id FROM o WHERE rn = 1")
def g30_nearest_to_centroid(spark, d):
    return GL.nearest_to_centroid(B.planets(spark, d), ME)


@register("w18_turn_series", with_views("planets", "fleets", extra="""s AS (SELECT game_id, turn, owner, sum(num_ships) AS ships FROM (
  SELECT game_id, turn, owner, num_ships FROM planets UNION ALL SELECT game_id, turn, owner, num_ships FROM fleets) GROUP BY ALL),
w AS (SELECT game_id, turn, CAST(sum(CASE WHEN owner = 1 THEN ships ELSE 0 END) AS BIGINT) AS ships_1,
  CAST(sum(CASE WHEN owner = 2 THEN ships ELSE 0 END) AS BIGINT) AS ships_2 FROM s GROUP BY 1, 2),
l AS (SELECT *, CASE WHEN ships_1 > ships_2 THEN 1 WHEN ships_1 < ships_2 THEN 2 ELSE 0 END AS leader FROM w),
c AS (SELECT *, CASE WHEN lag(leader) OVER (PARTITION BY game_id ORDER BY turn) IS NOT NULL
  AND lag(leader) OVER (PARTITION BY game_id ORDER BY turn) <> leader THEN 1 ELSE 0 END AS chg FROM l)""") +
    """SELECT game_id, turn, ships_1, ships_2, leader, CAST(sum(chg) OVER (PARTITION BY game_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS lead_changes,
  min(CASE WHEN ships_1 = 0 OR ships_2 = 0 THEN turn END) OVER (PARTITION BY game_id) AS first_wipeout_turn FROM c""")
def w18_turn_series(spark, d):
    return GL.turn_series(B.planets(spark, d), B.fleets(spark, d))


@register("w19_new_threats", with_views("planets", "fleets") + f"""SELECT f.* FROM fleets f WHERE owner <> {ME} AND owner <> 0
  AND total_trip_length = turns_remaining + 1 AND (game_id, turn, destination_planet_id) IN
  (SELECT game_id, turn, planet_id FROM planets WHERE owner = {ME})""")
def w19_new_threats(spark, d):
    return GL.new_threats(B.fleets(spark, d), B.planets(spark, d), ME)


@register("j14_exclude_targeted", with_views("planets", "fleets") + f"""SELECT * FROM planets p WHERE NOT EXISTS (SELECT 1 FROM fleets f
  WHERE f.owner = {ME} AND f.game_id = p.game_id AND f.turn = p.turn AND f.destination_planet_id = p.planet_id)""")
def j14_exclude_targeted(spark, d):
    return finish(GL.exclude_targeted(B.planets(spark, d), B.fleets(spark, d), ME))


@register("w14_best_target", with_views("fleets", extra="""o AS (SELECT *, row_number() OVER (PARTITION BY game_id, turn, source_planet_id
  ORDER BY num_ships DESC, fleet_id, destination_planet_id) AS rn FROM fleets)""") +
    "SELECT game_id, turn, source_planet_id, fleet_id, num_ships, destination_planet_id FROM o WHERE rn = 1")
def w14_best_target(spark, d):
    f = B.fleets(spark, d).select("game_id", "turn", "source_planet_id", "fleet_id", "num_ships", "destination_planet_id")
    return GL.best_target(f, ["game_id", "turn", "source_planet_id"], "num_ships", ["fleet_id", "destination_planet_id"])


@register("w14_second_best_target", with_views("fleets", extra="""o AS (SELECT *, row_number() OVER (PARTITION BY game_id, turn, source_planet_id
  ORDER BY num_ships DESC, fleet_id, destination_planet_id) AS rn FROM fleets)""") +
    "SELECT game_id, turn, source_planet_id, fleet_id, num_ships, destination_planet_id FROM o WHERE rn = 2")
def w14_second_best_target(spark, d):
    f = B.fleets(spark, d).select("game_id", "turn", "source_planet_id", "fleet_id", "num_ships", "destination_planet_id")
    return GL.best_target(f, ["game_id", "turn", "source_planet_id"], "num_ships", ["fleet_id", "destination_planet_id"], n=2)


@register("t5_extreme_per_group", with_views("planets", extra=f"""s AS (SELECT game_id, turn, planet_id AS strongest_source,
  row_number() OVER (PARTITION BY game_id, turn ORDER BY num_ships DESC, planet_id) AS rn FROM planets WHERE owner = {ME}),
t AS (SELECT game_id, turn, planet_id AS weakest_target,
  row_number() OVER (PARTITION BY game_id, turn ORDER BY num_ships, planet_id) AS rn FROM planets WHERE owner <> {ME})""") +
    "SELECT s.game_id, s.turn, strongest_source, weakest_target FROM s JOIN t ON s.game_id = t.game_id AND s.turn = t.turn AND s.rn = 1 AND t.rn = 1")
def t5_extreme_per_group(spark, d):
    p = B.planets(spark, d)
    own = GL.best_target(p.where(F.col("owner") == ME), ["game_id", "turn"], "num_ships", "planet_id").select(
        "game_id", "turn", F.col("planet_id").alias("strongest_source"))
    oth = GL.best_target(p.where(F.col("owner") != ME), ["game_id", "turn"], "num_ships", "planet_id", highest=False).select(
        "game_id", "turn", F.col("planet_id").alias("weakest_target"))
    return own.join(oth, ["game_id", "turn"])


@register("t7_top_fraction", with_views("planets", extra="""o AS (SELECT *, row_number() OVER (PARTITION BY game_id, turn ORDER BY num_ships DESC, planet_id) AS rn,
  count(*) OVER (PARTITION BY game_id, turn) AS n FROM planets)""") + "SELECT game_id, turn, planet_id, num_ships FROM o WHERE rn <= ceil(n * 0.3)")
def t7_top_fraction(spark, d):
    p = B.planets(spark, d).select("game_id", "turn", "planet_id", "num_ships")
    return W.top_fraction(p, "num_ships", 0.3, ["game_id", "turn"], "planet_id")


@register("w15_greedy_fill", with_views("planets", extra=f"""o AS (SELECT game_id, turn, planet_id, num_ships,
  coalesce(sum(num_ships) OVER (PARTITION BY game_id, turn ORDER BY planet_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM planets WHERE owner = {ME})""") + "SELECT game_id, turn, planet_id, num_ships, CAST(greatest(0, least(num_ships, 500 - before)) AS BIGINT) AS give FROM o")
def w15_greedy_fill(spark, d):
    p = B.planets(spark, d).where(F.col("owner") == ME).select("game_id", "turn", "planet_id", "num_ships")
    out = GL.greedy_fill(p, ["game_id", "turn"], "planet_id", "num_ships", F.lit(500))
    return out.withColumn("give", F.col("give").cast("long"))


@register("p27_validate_orders", with_views("planets", "fleets", extra="""ord AS (SELECT game_id, turn, fleet_id AS order_seq, owner AS player,
  source_planet_id, destination_planet_id, num_ships FROM fleets),
j AS (SELECT o.*, s.owner AS src_owner, s.num_ships AS src_ships, d.planet_id IS NOT NULL AS dst_ok,
  sum(o.num_ships) OVER (PARTITION BY o.game_id, o.turn, o.source_planet_id ORDER BY o.order_seq, o.destination_planet_id, o.num_ships ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sent
  FROM ord o LEFT JOIN planets s ON s.game_id = o.game_id AND s.turn = o.turn AND s.planet_id = o.source_planet_id
  LEFT JOIN planets d ON d.game_id = o.game_id AND d.turn = o.turn AND d.planet_id = o.destination_planet_id)""") +
    """SELECT game_id, turn, order_seq, player, source_planet_id, destination_planet_id, num_ships,
  CASE WHEN src_owner IS NULL THEN 'unknown source' WHEN NOT dst_ok THEN 'unknown destination'
    WHEN source_planet_id = destination_planet_id THEN 'same planet' WHEN src_owner <> player THEN 'not owner'
    WHEN num_ships <= 0 THEN 'no ships' WHEN sent > src_ships THEN 'not enough ships' END AS reason,
  CASE WHEN src_owner IS NULL THEN false WHEN NOT dst_ok THEN false WHEN source_planet_id = destination_planet_id THEN false
    WHEN src_owner <> player THEN false WHEN num_ships <= 0 THEN false WHEN sent > src_ships THEN false ELSE true END AS valid FROM j""")
def p27_validate_orders(spark, d):
    o = B.fleets(spark, d).select("game_id", "turn", F.col("fleet_id").alias("order_seq"), F.col("owner").alias("player"),
                                  "source_planet_id", "destination_planet_id", "num_ships")
    return GL.validate_orders(o, B.planets(spark, d), ["order_seq", "destination_planet_id", "num_ships"])


@register("b8_arrival_projection", with_views("planets", "fleets", recursive=True, extra="""f AS (SELECT game_id, turn, destination_planet_id AS planet_id, turns_remaining AS due,
  CAST(sum(CASE WHEN owner = 0 THEN num_ships ELSE 0 END) AS BIGINT) AS f0, CAST(sum(CASE WHEN owner = 1 THEN num_ships ELSE 0 END) AS BIGINT) AS f1,
  CAST(sum(CASE WHEN owner = 2 THEN num_ships ELSE 0 END) AS BIGINT) AS f2 FROM fleets GROUP BY ALL),
a AS (SELECT *, row_number() OVER (PARTITION BY game_id, turn, planet_id ORDER BY due) AS rn FROM f),
it AS (SELECT game_id, turn, planet_id, growth_rate, CAST(0 AS BIGINT) AS k, CAST(owner AS INTEGER) AS o, CAST(num_ships AS BIGINT) AS s, CAST(0 AS INTEGER) AS t FROM planets UNION ALL
  SELECT game_id, turn, planet_id, growth_rate, k, CASE WHEN n > 1 THEN o WHEN g0 = mx THEN 0 WHEN g1 = mx THEN 1 ELSE 2 END,
    CASE WHEN n > 1 THEN 0 ELSE mx - coalesce(greatest(CASE WHEN g0 < mx THEN g0 END, CASE WHEN g1 < mx THEN g1 END, CASE WHEN g2 < mx THEN g2 END), 0) END, due
  FROM (SELECT *, greatest(g0, g1, g2) AS mx, (g0 = greatest(g0, g1, g2))::INT + (g1 = greatest(g0, g1, g2))::INT + (g2 = greatest(g0, g1, g2))::INT AS n FROM (
    SELECT it.game_id, it.turn, it.planet_id, growth_rate, it.k + 1 AS k, o, CAST(due AS INTEGER) AS due, f0 + CASE WHEN o = 0 THEN s ELSE 0 END AS g0,
      f1 + CASE WHEN o = 1 THEN s + growth_rate * (due - t) ELSE 0 END AS g1, f2 + CASE WHEN o = 2 THEN s + growth_rate * (due - t) ELSE 0 END AS g2
    FROM it JOIN a ON a.game_id = it.game_id AND a.turn = it.turn AND a.planet_id = it.planet_id AND a.rn = it.k + 1)))""") + """
SELECT game_id, turn, planet_id, o AS final_owner, s AS final_ships, t AS last_arrival FROM it QUALIFY row_number() OVER (PARTITION BY game_id, turn, planet_id ORDER BY k DESC) = 1""")
def b8_arrival_projection(spark, d):
    return GL.arrival_projection(B.planets(spark, d), B.fleets(spark, d))


@register("s6_parse_maps", with_views("planets") + f"""SELECT CAST(game_id AS VARCHAR) AS file,
  CAST(row_number() OVER (PARTITION BY game_id ORDER BY planet_id) - 1 AS INTEGER) AS planet_id,
  {r6('x')} AS x, {r6('y')} AS y, owner, num_ships, growth_rate FROM planets""")
def s6_parse_maps(spark, d):
    maps = GF.render_maps(B.planets(spark, d)).select(F.col("game_id").cast("string").alias("file"), "text")
    planets, _fleets = GF.parse_maps(maps)
    return finish(planets.withColumn("planet_id", F.col("planet_id").cast("int")))


@register("s7_decode_replays", with_views("planets") + """SELECT game_id AS battle_id, 0 AS turn,
  CAST(row_number() OVER (PARTITION BY game_id ORDER BY planet_id) - 1 AS INTEGER) AS planet_id, owner, num_ships FROM planets""")
def s7_decode_replays(spark, d):
    p = B.planets(spark, d)
    rep = GF.render_replays(p, B.fleet_turns(spark, d).where("turn = 0"))
    _maps, states, _fl = GF.decode_replays(rep)
    return states.withColumn("planet_id", F.col("planet_id").cast("int")).withColumn("turn", F.col("turn").cast("int"))


@register("b6_score_density", with_views("planets", "fleets", extra=f"""inc AS (SELECT game_id, turn, destination_planet_id AS planet_id,
  sum(CASE WHEN owner = {ME} THEN num_ships ELSE 0 END) AS own_incoming, sum(CASE WHEN owner <> {ME} THEN num_ships ELSE 0 END) AS enemy_incoming
  FROM fleets GROUP BY 1, 2, 3),
j AS (SELECT p.*, coalesce(own_incoming, 0) AS oi, coalesce(enemy_incoming, 0) AS ei FROM planets p LEFT JOIN inc USING (game_id, turn, planet_id)),
d AS (SELECT *, num_ships + CASE WHEN owner = {ME} THEN oi - ei ELSE ei - oi END AS d0 FROM j),
e AS (SELECT *, CASE WHEN owner IN (0, {ME}) THEN (CASE WHEN d0 = 0 THEN 1 ELSE d0 END) * 4 ELSE (CASE WHEN d0 = 0 THEN 1 ELSE d0 END) END AS dd FROM d),
s AS (SELECT game_id, turn, planet_id, abs(growth_rate / CAST(dd AS DOUBLE)) AS score FROM e)""") +
    f"""SELECT game_id, turn, planet_id, {r6('score')} AS score,
  CAST(row_number() OVER (PARTITION BY game_id, turn ORDER BY score, planet_id) AS INTEGER) AS density_rank FROM s""")
def b6_score_density(spark, d):
    return finish(GL.score_density(B.planets(spark, d), B.fleets(spark, d), ME))


SRC_SQL = f"""src AS (SELECT game_id, turn, planet_id AS src_id, num_ships AS src_ships, growth_rate AS src_growth, x AS src_x, y AS src_y
  FROM (SELECT *, row_number() OVER (PARTITION BY game_id, turn ORDER BY num_ships DESC, planet_id) AS rn FROM planets WHERE owner = {ME}) WHERE rn = 1),
t AS (SELECT p.*, s.src_id, s.src_ships, s.src_growth, CAST(ceil(sqrt(pow(p.x - s.src_x, 2) + pow(p.y - s.src_y, 2))) AS DOUBLE) AS dist,
  CAST(p.growth_rate AS DOUBLE) AS g, CAST(p.num_ships AS DOUBLE) AS n
  FROM planets p JOIN src s USING (game_id, turn) WHERE p.planet_id <> s.src_id)"""

B_SCORE_SQL = {
    "linear": ("g - CASE WHEN owner = 2 THEN g * dist + n ELSE n END - 10.0 * dist", "true"),
    "cost": ("CASE WHEN owner = 2 THEN n + g * dist ELSE n END", "CASE WHEN owner = 2 THEN n + g * dist ELSE n END < src_ships"),
    "yield": ("g * (1 + 4 * CAST(owner = 2 AS DOUBLE)) / greatest(dist * (n + CAST(owner AS DOUBLE) * 0.5 * g * dist), 1.0)",
              "n + CAST(owner AS DOUBLE) * 0.5 * g * dist < src_ships"),
    "mix": ("CASE WHEN src_ships = 0 OR dist = 0 THEN NULL ELSE (CASE WHEN owner = 0 THEN 1.0 ELSE 2.0 END) + 4.0 / dist"
            " + 2.0 * (g - CAST(src_growth AS DOUBLE)) / greatest(CAST(src_growth AS DOUBLE), g, 1.0) + (1.0 - (n + dist * g) / src_ships) END",
            "src_ships > 0"),
    "match": ("n + 4.0 * dist - 3.0 * g", "n + 4.0 * dist - 3.0 * g < src_ships"),
}
B_IDS = {"linear": "b1", "cost": "b2", "yield": "b3", "mix": "b4", "match": "b7"}


def _b_query(kind):
    score, aff = B_SCORE_SQL[kind]

    def q(spark, d):
        return finish(GL.score_targets(B.planets(spark, d), B.fleets(spark, d), kind, ME))
    sql = with_views("planets", extra=SRC_SQL) + f"""SELECT game_id, turn, src_id AS source_planet_id, planet_id, owner, dist,
  {r6(score)} AS score, {aff} AS affordable FROM t"""
    register(f"{B_IDS[kind]}_score_{kind}", sql)(q)


for _k in ("linear", "cost", "yield", "mix", "match"):
    _b_query(_k)


@register("b5_score_payoff", with_views("planets", "fleets", extra=SRC_SQL + f""",
inc AS (SELECT game_id, turn, destination_planet_id AS planet_id,
  sum(CASE WHEN owner = {ME} THEN num_ships ELSE 0 END) - sum(CASE WHEN owner <> {ME} THEN num_ships ELSE 0 END) AS net_incoming FROM fleets GROUP BY 1, 2, 3),
u AS (SELECT t.*, -CAST(coalesce(inc.net_incoming, 0) AS DOUBLE) AS enemy_net FROM t LEFT JOIN inc USING (game_id, turn, planet_id)),
v AS (SELECT *, CASE WHEN owner = 0 THEN g * 100 - n - enemy_net ELSE g * (100 - dist) - n - enemy_net END AS base FROM u)""") +
    f"""SELECT game_id, turn, src_id AS source_planet_id, planet_id, owner, dist, {r6(f'CASE WHEN owner = {ME} THEN -base ELSE base END')} AS score,
  true AS affordable FROM v""")
def b5_score_payoff(spark, d):
    return finish(GL.score_targets(B.planets(spark, d), B.fleets(spark, d), "payoff", ME))


@register("j10_nearest_to_centroid_enemy", with_views("planets", extra=f"""c AS (SELECT game_id, turn, avg(x) AS ax, avg(y) AS ay FROM planets WHERE owner = {ME} GROUP BY 1, 2),
o AS (SELECT p.game_id, p.turn, p.planet_id, sqrt(pow(p.x - c.ax, 2) + pow(p.y - c.ay, 2)) AS dist FROM planets p JOIN c USING (game_id, turn) WHERE p.owner = 2),
r AS (SELECT *, row_number() OVER (PARTITION BY game_id, turn ORDER BY dist, planet_id) AS k FROM o)""") +
    f"SELECT game_id, turn, planet_id, {r6('dist')} AS dist, CAST(k AS INTEGER) AS k FROM r WHERE k <= 2")
def j10_nearest_to_centroid_enemy(spark, d):
    p = B.planets(spark, d)
    anchor = GL.centroid(p, ME).select("game_id", "turn", F.col("cx").alias("ax"), F.col("cy").alias("ay"))
    return finish(GL.nearest_to_anchor(p, anchor, 2, (2,)))


@register("j15_intercept_join", with_views("planets", "fleets", extra=f"""src AS (SELECT game_id, turn, planet_id AS src_id, x AS src_x, y AS src_y
  FROM (SELECT *, row_number() OVER (PARTITION BY game_id, turn ORDER BY num_ships DESC, planet_id) AS rn FROM planets WHERE owner = {ME}) WHERE rn = 1),
f AS (SELECT fl.game_id, fl.turn, fl.fleet_id, fl.destination_planet_id, fl.turns_remaining, s.src_id,
  CAST(ceil(sqrt(pow(p.x - s.src_x, 2) + pow(p.y - s.src_y, 2))) AS BIGINT) AS dist
  FROM fleets fl JOIN planets p ON p.game_id = fl.game_id AND p.turn = fl.turn AND p.planet_id = fl.destination_planet_id
  JOIN src s ON s.game_id = fl.game_id AND s.turn = fl.turn WHERE fl.owner <> {ME} AND fl.owner <> 0)""") +
    """SELECT game_id, turn, fleet_id, destination_planet_id, src_id AS source_planet_id, dist, turns_remaining,
  dist = turns_remaining + 1 AS just_after, dist < turns_remaining AS before FROM f""")
def j15_intercept_join(spark, d):
    return GL.intercept_join(B.planets(spark, d), B.fleets(spark, d), ME)


@register("j9_distance_from_source", with_views("planets", extra=f"""src AS (SELECT game_id, turn, planet_id AS src_id, x AS src_x, y AS src_y
  FROM (SELECT *, row_number() OVER (PARTITION BY game_id, turn ORDER BY num_ships DESC, planet_id) AS rn FROM planets WHERE owner = {ME}) WHERE rn = 1),
t AS (SELECT p.game_id, p.turn, s.src_id, p.planet_id, sqrt(pow(p.x - s.src_x, 2) + pow(p.y - s.src_y, 2)) AS dist
  FROM planets p JOIN src s USING (game_id, turn))""") +
    f"""SELECT game_id, turn, src_id AS source_planet_id, planet_id, {r6('dist')} AS dist, CAST(ceil(dist) AS BIGINT) AS dist_ceil,
  CAST(floor(dist) AS BIGINT) AS dist_floor FROM t""")
def j9_distance_from_source(spark, d):
    return finish(GL.distance_from_source(B.planets(spark, d), ME))
