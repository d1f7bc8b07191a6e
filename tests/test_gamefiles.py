"""Map, replay and console-log parsing (FIXTURES 1.2-1.4)."""

from ledgerplay.operators import gamelog as GL
from ledgerplay.sources import gamefiles as GF


def test_parse_maps_cases(spark):
    maps = spark.createDataFrame([
        ("a", "P 0 0 1 10 1\nP 1 2 0 5 1# note\nF 1 20 1 2 10 4\n"),
        ("b", "P 1 2 0\nP 0 0 1 10 1\n"),
    ], "file string, text string")
    planets, fleets = GF.parse_maps(maps)
    p = sorted((r.file, r.planet_id, r.num_ships, r.growth_rate) for r in planets.collect())
    assert p == [("a", 0, 10, 1), ("a", 1, 5, 1)]
    f = [(r.owner, r.num_ships, r.source_planet_id, r.destination_planet_id, r.total_trip_length, r.turns_remaining)
         for r in fleets.collect()]
    assert f == [(1, 20, 1, 2, 10, 4)]


def test_map_numbers(spark):
    maps = spark.createDataFrame([("a", "P 5.0E-4 -1e2 1 10 1"), ("b", "P 0 0 1 3.5 1"), ("c", "P nope 0 1 3 1")], "file string, text string")
    planets, _ = GF.parse_maps(maps)
    assert [(r.file, r.x, r.y) for r in planets.collect()] == [("a", 0.0005, -100.0)]


def test_decode_replay_hand_case(spark):
    b = spark.createDataFrame([(1, "0.0,0.0,1,10,1:3.0,4.0,2,8,1|1.11,2.9:1.7,2.10,1.5.0.1.5.4")],
                              "battle_id int, description_for_display string")
    maps, states, fleets = GF.decode_replays(b)
    assert maps.count() == 2
    s = sorted((r.turn, r.planet_id, r.owner, r.num_ships) for r in states.collect())
    assert s == [(0, 0, 1, 11), (0, 1, 2, 9), (1, 0, 1, 7), (1, 1, 2, 10)]
    f = [(r.turn, r.owner, r.num_ships, r.source_planet_id, r.destination_planet_id, r.total_trip_length, r.turns_remaining)
         for r in fleets.collect()]
    assert f == [(1, 1, 5, 0, 1, 5, 4)]


LOG = """Player 1 Wins
Player Mudlark throw exception KeyError: 'no such planet'
Tie
        player_name  rank  battle_count  won  lost  tie  points
0   Quiet Lighthouse     1             7    5     1    1     5.5
1           gravel_9     2             7    4     3    0     4.0
        player_1_name     player_2_name  winner   finish_state  player_1_score  player_2_score  turns  description_for_display
battle_id
4            gravel_9  Quiet Lighthouse       2  Player 2 Wins               0             742     88  2.5,7.0,0,12,3:9.0,4...
5    Quiet Lighthouse          gravel_9       1  Player 1 Wins             316               0     41  2.5,7.0,0,12,3:9.0,4...
6          north wind  Quiet Lighthouse       0            Tie             205             205    150  6.0,6.0,1,30,2:1.0,8...
"""


def test_console_log_and_golden_standings(spark):
    lines = spark.createDataFrame([(l,) for l in LOG.splitlines()], "value string")
    ev = GF.parse_console_log(lines)
    counts = {(r.kind, r.player, r.detail): r.n for r in GL.log_counts(ev).collect()}
    assert counts[("result", None, "Player 1 Wins")] == 1
    assert counts[("failure", "Mudlark", "KeyError")] == 1
    battles = GF.parse_battle_rows(lines)
    rows = sorted((r.battle_id, r.player_1_name, r.player_2_name, r.winner, r.player_1_score, r.player_2_score, r.turns)
                  for r in battles.collect())
    assert len(rows) == 3  # the printed standings table is not taken for battles
    assert rows[0] == (4, "gravel_9", "Quiet Lighthouse", 2, 0, 742, 88)
    st = {r.player_name: r for r in GL.rank_standings(GL.standings(GL.battle_sides(battles))).collect()}
    f = st["Quiet Lighthouse"]
    assert (f.battle_count, f.won, f.lost, f.tie, f.points, f.total_score, f.total_enemy_score) == (3, 2, 0, 1, 2.5, 1263, 205)
    assert (f.killed_all_enemy_units, f.all_units_died, f.wins_as_player_1, f.wins_as_player_2, f.rank) == (2, 0, 1, 1, 1)
    assert st["gravel_9"].all_units_died == 2
