"""Replays over several turns, leader spans and printed battle rows on hand cases."""

from ledgerplay.operators import gamelog as GL
from ledgerplay.sources import gamefiles as GF

PLANET = "game_id long, turn int, planet_id long, owner int, num_ships int, growth_rate int, x double, y double"
FLEET = "game_id long, turn int, fleet_id long, owner int, num_ships int, source_planet_id int, destination_planet_id int, total_trip_length int, turns_remaining int"


def tables(spark):
    planets = [(g, t, p, (p + t) % 3, 10 + p + t, 2, p * 1.5, -p * 0.5) for g in (1, 2) for t in (0, 1, 2) for p in (5, 7)]
    fleets = [(1, 1, 9, 1, 4, 0, 1, 3, 2), (1, 2, 9, 1, 4, 0, 1, 3, 1), (1, 2, 3, 2, 6, 1, 0, 2, 2), (8, 0, 1, 1, 1, 0, 0, 1, 1)]
    return spark.createDataFrame(planets, PLANET), spark.createDataFrame(fleets, FLEET)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replay_round_trip_over_turns(spark):
    planets, fleets = tables(spark)
    rows = GF.render_replay_rows(planets, fleets)
    maps, states, flights = GF.decode_replay_rows(rows)
    assert _rows(states) == sorted((g, t, i, (p + t) % 3, 10 + p + t) for g in (1, 2) for t in (0, 1, 2) for i, p in enumerate((5, 7)))
    assert _rows(flights) == [(1, 1, 0, 1, 4, 0, 1, 3, 2), (1, 2, 0, 2, 6, 1, 0, 2, 2), (1, 2, 1, 1, 4, 0, 1, 3, 1)]  # no row for game 8: it has no planets
    assert len(_rows(maps)) == 4
    whole = GF.decode_replays(GF.render_replays(planets, fleets))
    assert [_rows(a) for a in whole] == [_rows(a) for a in (maps, states, flights)]


def test_replay_without_rows_or_numbers(spark):
    none = spark.createDataFrame([], "battle_id long, description_for_display string")
    assert [_rows(x) for x in GF.decode_replays(none)] == [[], [], []]
    odd = spark.createDataFrame([(1, None), (2, "1,2,0,5,1"), (3, "1,2,0,x,1|0.5,q.7.1.2.3.4")], "battle_id long, description_for_display string")
    maps, states, flights = GF.decode_replays(odd)
    assert [r["num_ships"] for r in maps.where("battle_id > 1").orderBy("battle_id").collect()] == [5, None]
    assert _rows(states) == [(3, 0, 0, 0, 5)]
    assert [tuple(r) for r in flights.collect()] == [(3, 0, 0, None, 7, 1, 2, 3, 4)]


def test_leader_spans(spark):
    turns = [(1, 0, 1), (1, 1, 1), (1, 2, 2), (1, 3, 1), (1, 5, 1), (2, 4, 0)]
    got = _rows(GL.leader_spans(spark.createDataFrame(turns, "game_id long, turn int, leader int")))
    assert got == [(1, 0, 1, 0, 1, 2), (1, 1, 2, 2, 2, 1), (1, 2, 1, 3, 3, 1), (1, 3, 1, 5, 5, 1), (2, 0, 0, 4, 4, 1)]


def test_battle_row_keeps_a_very_long_description(spark):
    header = f"{'':>8}{'player_1_name':>20}{'player_2_name':>20} rest"
    long = "m" * 1_200_000
    line = f"{'7':<8}{'Ann Bee':>20}{'Cy':>20} 2 Player 2 Wins 3 9 41 {long}"
    row = GF.parse_battle_rows(spark.createDataFrame([(header,), (line,), ("8 planets left",)], "value string")).collect()
    assert len(row) == 1 and row[0]["player_1_name"] == "Ann Bee" and row[0]["turns"] == 41
    assert row[0]["description_for_display"] == long


def test_battle_lines_are_printed_once(spark):
    """Filters of the parser pushed below the printing would print every line again for each of them."""
    from ledgerplay.plans.q_turns import s8_battle_rows
    df = s8_battle_rows(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rpad(") == 1 and plan.count("FileScan") == 1


def test_battle_row_description_may_hold_the_separator(spark):
    header = f"{'':>8}{'player_1_name':>20}{'player_2_name':>20} rest"
    lines = [f"{'7':<8}{'Ann':>20}{'Cy':>20} 0  Tie  3  99999999999  41  a\u0001$1\u0001b  ", f"{'8':<8}{'Ann':>20}{'Cy':>20} 1 Tie\u00013 9 41 m"]
    rows = GF.parse_battle_rows(spark.createDataFrame([(x,) for x in [header, *lines]], "value string")).collect()
    assert [tuple(r) for r in rows] == [(7, "Ann", "Cy", 0, "Tie", 3, None, 41, "a\u0001$1\u0001b")]
