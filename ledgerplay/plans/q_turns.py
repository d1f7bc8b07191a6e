"""Games over several turns: replays with fleets (S7), lead changes and spans (W18), battle rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerplay.operators import gamelog as GL
from ledgerplay.plans import bindings as B
from ledgerplay.plans.common import finish, r6
from ledgerplay.plans.registry import register, with_views
from ledgerplay.sources import gamefiles as GF


def _replay(spark, d):
    return GF.render_replay_rows(B.planet_turns(spark, d), B.fleet_turns(spark, d))


@register("s7_replay_planets", with_views("planets", "planet_turns") + """SELECT game_id AS battle_id, turn,
  CAST(row_number() OVER (PARTITION BY game_id, turn ORDER BY planet_id) - 1 AS INTEGER) AS planet_id, owner, num_ships FROM planet_turns""")
def s7_replay_planets(spark, d):
    return GF.decode_replay_rows(_replay(spark, d))[1]


@register("s7_replay_fleets", with_views("fleet_turns") + """SELECT game_id AS battle_id, turn,
  CAST(row_number() OVER (PARTITION BY game_id, turn ORDER BY fleet_id,
    concat_ws('.', owner, num_ships, source_planet_id, destination_planet_id, total_trip_length, turns_remaining)) - 1 AS INTEGER) AS fleet_seq, owner, num_ships,
  source_planet_id, destination_planet_id, total_trip_length, turns_remaining FROM fleet_turns
  WHERE game_id IN (SELECT vec_id // 10 FROM embeddings)""")
def s7_replay_fleets(spark, d):
    return GF.decode_replay_rows(_replay(spark, d))[2]


@register("s7_replay_maps", with_views("planets", "planet_turns") + f"""SELECT game_id AS battle_id,
  CAST(row_number() OVER (PARTITION BY game_id ORDER BY planet_id) - 1 AS INTEGER) AS planet_id, {r6('x')} AS x, {r6('y')} AS y,
  owner, num_ships, growth_rate FROM planet_turns WHERE turn = 0""")
def s7_replay_maps(spark, d):
    strings = GF.render_replays(B.planet_turns(spark, d), B.fleet_turns(spark, d))
    return finish(GF.decode_replays(strings)[0])


SERIES_SQL = """s AS (SELECT game_id, turn, owner, sum(num_ships) AS ships FROM (
  SELECT game_id, turn, owner, num_ships FROM planet_turns UNION ALL SELECT game_id, turn, owner, num_ships FROM fleet_turns) GROUP BY ALL),
w AS (SELECT game_id, turn, CAST(sum(CASE WHEN owner = 1 THEN ships ELSE 0 END) AS BIGINT) AS ships_1,
  CAST(sum(CASE WHEN owner = 2 THEN ships ELSE 0 END) AS BIGINT) AS ships_2 FROM s GROUP BY 1, 2),
l AS (SELECT *, CASE WHEN ships_1 > ships_2 THEN 1 WHEN ships_1 < ships_2 THEN 2 ELSE 0 END AS leader FROM w),
c AS (SELECT *, CASE WHEN lag(leader) OVER (PARTITION BY game_id ORDER BY turn) <> leader THEN 1 ELSE 0 END AS chg FROM l)"""


def _series(spark, d):
    return GL.turn_series(B.planet_turns(spark, d), B.fleet_turns(spark, d))


@register("w18_lead_changes", with_views("planets", "planet_turns", "fleet_turns", extra=SERIES_SQL) + """SELECT game_id, turn, ships_1, ships_2, leader,
  CAST(sum(chg) OVER (PARTITION BY game_id ORDER BY turn) AS BIGINT) AS lead_changes,
  min(CASE WHEN ships_1 = 0 OR ships_2 = 0 THEN turn END) OVER (PARTITION BY game_id) AS first_wipeout_turn FROM c""")
def w18_lead_changes(spark, d):
    return _series(spark, d)


@register("w18_leader_spans", with_views("planets", "planet_turns", "fleet_turns", extra=SERIES_SQL + """,
-- turns minus their place among the turns of one leader is constant inside a span
i AS (SELECT *, turn - row_number() OVER (PARTITION BY game_id, leader ORDER BY turn) AS island FROM l),
sp AS (SELECT game_id, leader, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS turns FROM i GROUP BY game_id, leader, island)""") +
          "SELECT game_id, row_number() OVER (PARTITION BY game_id ORDER BY first_turn) - 1 AS span, leader, first_turn, last_turn, turns FROM sp")
def w18_leader_spans(spark, d):
    return GL.leader_spans(_series(spark, d))


# one printed table: names right-aligned under their headers
LOG_HEADER = f"{'':>12}{'player_1_name':>20}{'player_2_name':>20}  winner  finish_state  player_1_score  player_2_score  turns  description_for_display"


@register("s8_battle_rows", with_views("battles") + """SELECT battle_id, player_1_name, player_2_name, winner, finish_state,
  player_1_score, player_2_score, turns, 'map-' || CAST(battle_id AS VARCHAR) AS description_for_display FROM battles""")
def s8_battle_rows(spark, d):
    b = B.battles(spark, d)
    text = lambda c: F.col(c).cast("string")
    tail = [x for c in ("winner", "finish_state", "player_1_score", "player_2_score", "turns") for x in (F.lit("  "), text(c))]
    line = F.concat(F.rpad(text("battle_id"), 12, " "), F.lpad("player_1_name", 20, " "), F.lpad("player_2_name", 20, " "), *tail, F.lit("  map-"), text("battle_id"))
    # one scan; filters on exploded lines are not pushed below them, so each line is printed once
    printed = spark.createDataFrame([(LOG_HEADER,), ("",)], "value string").unionByName(b.select(F.explode(F.array(line, "finish_state")).alias("value")))
    return GF.parse_battle_rows(printed)
