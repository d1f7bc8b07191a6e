"""Game text formats: map files, replay strings, console logs.

Parsing is expression-only (``split``/``posexplode``/``regexp_extract``), so it
runs in whole-stage codegen next to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# --- fixed values: text formats --------------------------------------------------
PLANET_TOKENS = 6      # P x y owner num_ships growth_rate
FLEET_TOKENS = 7       # F owner num_ships source destination total_trip remaining
COMMENT = "#"
RESULT_LINE = r"^(Player 1 Wins|Player 2 Wins|Tie)$"
FAILURE_LINE = r"^Player (.+?) throw exception (\w+): (.*)$"
# -----------------------------------------------------------------------------------


def read_map_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per map file: (file, text).  A map is a small, bounded text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def parse_maps(maps: DataFrame, file_col: str = "file", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Map text -> (planets, fleets).

    ``#`` starts a comment; blank lines are skipped; planet_id is the 0-based
    order of ``P`` lines in the file; one malformed line rejects the whole file.
    Coordinates are doubles in any notation, all other fields whole numbers.
    """
    lines = maps.select(file_col, F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
    body = F.trim(F.split(F.col("line"), COMMENT, 2)[0])
    lines = lines.withColumn("body", body).where(F.length("body") > 0)
    toks = F.split(F.col("body"), r"\s+")
    lines = lines.withColumn("tok", toks).withColumn("kind", F.col("tok")[0])
    num = lambda i: F.expr(f"try_cast(tok[{i}] AS DOUBLE)")
    whole = lambda start, n: F.forall(F.slice("tok", start, n), lambda t: t.rlike(r"^[+-]?[0-9]+$"))
    ok_p = (F.col("kind") == "P") & (F.size("tok") == PLANET_TOKENS) & num(1).isNotNull() & num(2).isNotNull() & whole(4, PLANET_TOKENS - 3)
    ok_f = (F.col("kind") == "F") & (F.size("tok") == FLEET_TOKENS) & whole(2, FLEET_TOKENS - 1)
    lines = lines.withColumn("ok", ok_p | ok_f)
    good = lines.groupBy(file_col).agg(F.bool_and("ok").alias("__good")).where("__good").select(file_col)
    valid = lines.join(good, file_col, "left_semi")
    w = Window.partitionBy(file_col).orderBy("pos")
    planets = valid.where(F.col("kind") == "P").withColumn("planet_id", F.row_number().over(w) - 1).select(
        file_col, "planet_id", num(1).alias("x"), num(2).alias("y"), num(3).cast("int").alias("owner"),
        num(4).cast("int").alias("num_ships"), num(5).cast("int").alias("growth_rate"))
    fleets = valid.where(F.col("kind") == "F").select(
        file_col, num(1).cast("int").alias("owner"), num(2).cast("int").alias("num_ships"),
        num(3).cast("int").alias("source_planet_id"), num(4).cast("int").alias("destination_planet_id"),
        num(5).cast("int").alias("total_trip_length"), num(6).cast("int").alias("turns_remaining"))
    return planets, fleets


def render_maps(planets: DataFrame, game_col: str = "game_id") -> DataFrame:
    """Map text per game from a planet table (planets in planet_id order)."""
    line = F.format_string("P %s %s %d %d %d", F.col("x").cast("string"), F.col("y").cast("string"),
                           "owner", "num_ships", "growth_rate")
    return planets.groupBy(game_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("planet_id", line.alias("l")))), lambda s: s["l"]), "\n").alias("text"))


def replay_rows(battles: DataFrame, id_col: str = "battle_id", text_col: str = "description_for_display") -> DataFrame:
    """Replay string -> (id, seq, text): the map at seq 0, turn k at seq k + 1."""
    parts = battles.select(id_col, F.split(F.col(text_col), r"\|", 2).alias("p"))
    pieces = F.concat(F.array(F.get("p", F.lit(0))), F.coalesce(F.split(F.get("p", F.lit(1)), ":"), F.array().cast("array<string>")))
    return parts.select(id_col, F.posexplode(pieces).alias("seq", "text"))


def decode_replay_rows(rows: DataFrame, id_col: str = "battle_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """S7 on one row per turn: (id, seq, text) -> (map planets, planet states per turn, fleets per turn).

    Seq 0 holds the map ``x,y,owner,ships,growth:...``; seq k + 1 holds turn k:
    ``owner.ships`` per planet in map order, then ``owner.ships.src.dst.total.remaining``
    per fleet.  A turn is the largest text of one row, however long the game is; the only
    thing a turn needs from the map is its number of planets.  Fields that are no numbers
    become null, rows of games without a map give no states.
    """
    field = lambda i, kind="int": F.expr(f"try_cast(get(t, {i}) AS {kind})")
    header = rows.where(F.col("seq") == 0)
    maps = header.select(id_col, F.posexplode(F.split("text", ":")).alias("planet_id", "d")).select(id_col, "planet_id", F.split("d", ",").alias("t"))
    maps = maps.select(id_col, "planet_id", field(0, "double").alias("x"), field(1, "double").alias("y"), field(2).alias("owner"),
                       field(3).alias("num_ships"), field(4).alias("growth_rate"))
    n_planets = header.groupBy(id_col).agg(F.max(F.size(F.split("text", ":"))).alias("__np"))
    items = (rows.where(F.col("seq") > 0).join(n_planets, id_col)
             .select(id_col, (F.col("seq") - 1).alias("turn"), "__np", F.posexplode(F.split("text", ",")).alias("pos", "it"))
             .withColumn("t", F.split("it", r"\.")))
    states = items.where(F.col("pos") < F.col("__np")).select(
        id_col, "turn", F.col("pos").alias("planet_id"), field(0).alias("owner"), field(1).alias("num_ships"))
    fleets = items.where((F.col("pos") >= F.col("__np")) & (F.size("t") == 6)).select(
        id_col, "turn", (F.col("pos") - F.col("__np")).alias("fleet_seq"), field(0).alias("owner"), field(1).alias("num_ships"),
        field(2).alias("source_planet_id"), field(3).alias("destination_planet_id"),
        field(4).alias("total_trip_length"), field(5).alias("turns_remaining"))
    return maps, states, fleets


def decode_replays(battles: DataFrame, id_col: str = "battle_id", text_col: str = "description_for_display"
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Replay string ``map|turn:turn:...`` -> (map planets, planet states per turn, fleets per turn)."""
    return decode_replay_rows(replay_rows(battles, id_col, text_col), id_col)


def _joined(rows: DataFrame, keys: list[str], order: list[str], piece: str, sep: str, out: str) -> DataFrame:
    """The texts of a group in order, as one text."""
    texts = F.array_sort(F.collect_list(F.struct(*order, piece)))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(texts, lambda s: s[piece]), sep).alias(out))


def render_replay_rows(planets: DataFrame, fleets: DataFrame) -> DataFrame:
    """Snapshot tables -> (battle_id, seq, text), one row per turn and the map (of turn 0) first.

    Planets stand in planet_id order, fleets behind them in fleet_id order
    (equal ids by their text).  Fleets of turns without planets have no row.
    """
    at = F.col("turn") + 1
    header = planets.where(F.col("turn") == 0).select(
        F.col("game_id").alias("battle_id"), F.lit(0).alias("seq"), F.lit(0).alias("kind"), F.col("planet_id").cast("long").alias("at"),
        F.format_string("%s,%s,%d,%d,%d", F.col("x").cast("string"), F.col("y").cast("string"), "owner", "num_ships", "growth_rate").alias("piece"))
    states = planets.select(F.col("game_id").alias("battle_id"), at.alias("seq"), F.lit(0).alias("kind"), F.col("planet_id").cast("long").alias("at"),
                            F.format_string("%d.%d", "owner", "num_ships").alias("piece"))
    flights = fleets.select(F.col("game_id").alias("battle_id"), at.alias("seq"), F.lit(1).alias("kind"), F.col("fleet_id").cast("long").alias("at"),
                            F.format_string("%d.%d.%d.%d.%d.%d", "owner", "num_ships", "source_planet_id", "destination_planet_id",
                                            "total_trip_length", "turns_remaining").alias("piece"))
    turns = _joined(states.unionByName(flights).join(states.select("battle_id", "seq").distinct(), ["battle_id", "seq"], "left_semi"),
                    ["battle_id", "seq"], ["kind", "at"], "piece", ",", "text")
    return _joined(header, ["battle_id", "seq"], ["kind", "at"], "piece", ":", "text").unionByName(turns)


def render_replays(planets: DataFrame, fleets: DataFrame) -> DataFrame:
    """Replay string per game from snapshot tables (one turn per snapshot turn); the whole game
    is one string, so long games are better kept as ``render_replay_rows``."""
    rows = render_replay_rows(planets, fleets)
    header = rows.where("seq = 0").select("battle_id", F.col("text").alias("map_desc"))
    turns = _joined(rows.where("seq > 0"), ["battle_id"], ["seq"], "text", ":", "turns_desc")
    return header.join(turns, "battle_id").select("battle_id", F.concat_ws("|", "map_desc", "turns_desc").alias("description_for_display"))


def parse_console_log(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Classify console lines: result lines, bot failures, fixed-width battle rows.

    Output (kind, player, detail, line): kind in result / failure / battle / other.
    """
    v = F.col(text_col)
    fail_p = F.regexp_extract(v, FAILURE_LINE, 1)
    fail_e = F.regexp_extract(v, FAILURE_LINE, 2)
    battle = v.rlike(r"^\d+\s+\S")
    kind = (F.when(v.rlike(RESULT_LINE), "result").when(v.rlike(FAILURE_LINE), "failure")
            .when(battle, "battle").otherwise("other"))
    return lines.select(
        kind.alias("kind"),
        F.when(v.rlike(FAILURE_LINE), fail_p).alias("player"),
        F.when(v.rlike(RESULT_LINE), v).when(v.rlike(FAILURE_LINE), fail_e).alias("detail"),
        v.alias("line"))


def parse_battle_rows(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Fixed-width battle rows of the printed battle table.

    Player names may contain blanks, so they are cut at the column ends given
    by the header line (right-aligned columns end under their header).  The
    header is one line: its two positions are read on the driver.
    """
    v = F.col(text_col)
    hdr = lines.where(v.contains("player_1_name") & v.contains("player_2_name")).select(text_col).limit(1).collect()
    if not hdr:
        raise ValueError("no battle table header in the log")
    h = hdr[0][0]
    p1_end = h.index("player_1_name") + len("player_1_name")
    p2_end = h.index("player_2_name") + len("player_2_name")
    tail = r"^\s*([012])\s+(Player 1 Wins|Player 2 Wins|Tie)\s+(\d+)\s+(\d+)\s+(\d+)\s+(\S+)\s*$"
    rest = F.expr(f"substring(`{text_col}`, {p2_end + 1})")  # to the end of the line
    # only lines whose tail has the battle columns (other printed tables also
    # start with a number)
    rows = lines.where(v.rlike(r"^\d+\s") & (F.length(v) > p2_end) & rest.rlike(tail))
    # one match per line for all columns of the tail; only its last one may hold the separator
    fields = F.split(F.regexp_replace(rest, tail, "\u0001".join(f"${i}" for i in range(1, 7))), "\u0001", 6)
    head = F.substring(v, 1, p1_end)
    rows = rows.select(
        F.regexp_extract(v, r"^(\d+)", 1).cast("long").alias("battle_id"),
        F.trim(F.regexp_replace(head, r"^\d+", "")).alias("player_1_name"),
        F.trim(F.substring(v, p1_end + 1, p2_end - p1_end)).alias("player_2_name"), fields.alias("f"))
    g = lambda i: F.get("f", F.lit(i - 1))
    return rows.select(
        "battle_id", "player_1_name", "player_2_name",
        g(1).try_cast("int").alias("winner"), g(2).alias("finish_state"), g(3).try_cast("int").alias("player_1_score"),
        g(4).try_cast("int").alias("player_2_score"), g(5).try_cast("int").alias("turns"), g(6).alias("description_for_display"))
