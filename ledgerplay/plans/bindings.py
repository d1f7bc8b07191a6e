"""Views of the lending and game tables over the driver's test tables.

Each binding exists twice: as a DataFrame builder (what the engine runs) and as
SQL text (the independent check).  Both read only the given tables, so the work
grows with them.  The mapping follows SURVEY §1.6.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerplay.sources.tables import read_table

# --- fixed values of the bindings --------------------------------------------
TERM_MONTHS = 7          # l_linenumber runs 1..7 at every scale
RATE_LO, RATE_SPAN = 5, 26   # yearly rate in percent: 5 .. 30
PLAYER_MOD = 100         # second player id = l_partkey % 100
PLANETS_PER_GAME = 10    # planets: game_id = vec_id DIV 10 (a game has 10 planets at every scale)
GAMES = 50               # fleets fly in games 0..49 (embeddings has >= 500 rows at every scale)
TURNS = 6                # turns per game of the multi-turn views, whose games grow with embeddings
# -----------------------------------------------------------------------------


def offers(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority"])
    return o.select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("offer_key"),
        F.col("o_orderdate").alias("offer_date"),
        F.col("o_totalprice").alias("requested_amount"),
        (F.col("o_orderstatus") == "F").alias("offer_accepted"),
        F.col("o_orderpriority").alias("occupation"),
    )


OFFERS_SQL = """offers AS (SELECT o_custkey AS id, o_orderkey AS offer_key, o_orderdate AS offer_date,
  o_totalprice AS requested_amount, (o_orderstatus = 'F') AS offer_accepted, o_orderpriority AS occupation FROM orders)"""


def bureau(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    # nation and region are dimension tables of fixed size (25 / 5 rows)
    return (
        c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
        .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_acctbal").alias("credit_score"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("state"),
            F.col("r_name").alias("town"),
        )
    )


BUREAU_SQL = """bureau AS (SELECT c_custkey AS id, c_acctbal AS credit_score, c_mktsegment AS segment,
  n_name AS state, r_name AS town
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""


def payments(spark: SparkSession, d: str) -> DataFrame:
    """Long payment rows (loan_id, mob, paid); (loan_id, mob) repeats."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"])
    return li.select(
        F.col("l_orderkey").alias("loan_id"),
        F.col("l_linenumber").alias("mob"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("paid"),
    )


PAYMENTS_SQL = """payments AS (SELECT l_orderkey AS loan_id, l_linenumber AS mob,
  l_extendedprice * (1 - l_discount) AS paid FROM lineitem)"""


def loans(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"])
    return o.select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("id"),
        F.col("o_totalprice").alias("loan_amnt"),
        (F.lit(RATE_LO) + F.col("o_orderkey") % RATE_SPAN).cast("double").alias("int_rate"),
        F.lit(TERM_MONTHS).alias("term"),
        F.col("o_orderdate").alias("issue_date"),
        F.col("o_orderpriority").alias("occupation"),
        F.col("o_orderstatus").alias("status"),
    )


LOANS_SQL = f"""loans AS (SELECT o_orderkey AS loan_id, o_custkey AS id, o_totalprice AS loan_amnt,
  CAST({RATE_LO} + o_orderkey % {RATE_SPAN} AS DOUBLE) AS int_rate, {TERM_MONTHS} AS term,
  o_orderdate AS issue_date, o_orderpriority AS occupation, o_orderstatus AS status FROM orders)"""


def houses(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    return p.select(
        F.col("p_partkey").alias("Id"),
        F.col("p_retailprice").alias("SalePrice"),
        F.col("p_brand").alias("Neighborhood"),
        F.col("p_type").alias("BldgType"),
        F.col("p_name").alias("HouseStyle"),
        F.col("p_size").cast("double").alias("GrLivArea"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_size").cast("double")).alias("LotFrontage"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")).alias("Alley"),
        (F.col("p_partkey") % 12 + 1).cast("int").alias("MoSold"),
    )


HOUSES_SQL = """houses AS (SELECT p_partkey AS "Id", p_retailprice AS "SalePrice", p_brand AS "Neighborhood",
  p_type AS "BldgType", p_name AS "HouseStyle", CAST(p_size AS DOUBLE) AS "GrLivArea",
  CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS "LotFrontage",
  CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS "Alley",
  CAST(p_partkey % 12 + 1 AS INTEGER) AS "MoSold" FROM part)"""


def battles(spark: SparkSession, d: str) -> DataFrame:
    """One battle per line item; players are suppliers, scores from the line."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_discount", "l_extendedprice"])
    p1 = F.concat(F.lit("P"), F.col("l_suppkey").cast("string"))
    p2 = F.concat(F.lit("P"), (F.col("l_partkey") % PLAYER_MOD).cast("string"))
    s1 = F.col("l_quantity").cast("int")
    s2 = F.round(F.col("l_discount") * 500).cast("int")
    winner = F.when(s1 > s2, 1).when(s1 < s2, 2).otherwise(0)
    return (
        li.where(F.col("l_suppkey") != F.col("l_partkey") % PLAYER_MOD)
        .select(
            (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("battle_id"),
            p1.alias("player_1_name"),
            p2.alias("player_2_name"),
            winner.alias("winner"),
            F.when(winner == 1, "Player 1 Wins").when(winner == 2, "Player 2 Wins").otherwise("Tie").alias("finish_state"),
            s1.alias("player_1_score"),
            s2.alias("player_2_score"),
            (F.floor(F.col("l_extendedprice")) % 200 + 1).cast("int").alias("turns"),
        )
    )


BATTLES_SQL = f"""battles AS (SELECT l_orderkey * 16 + l_linenumber AS battle_id,
  'P' || CAST(l_suppkey AS VARCHAR) AS player_1_name,
  'P' || CAST(l_partkey % {PLAYER_MOD} AS VARCHAR) AS player_2_name,
  CASE WHEN CAST(l_quantity AS INTEGER) > CAST(round(l_discount * 500) AS INTEGER) THEN 1
       WHEN CAST(l_quantity AS INTEGER) < CAST(round(l_discount * 500) AS INTEGER) THEN 2 ELSE 0 END AS winner,
  CASE WHEN CAST(l_quantity AS INTEGER) > CAST(round(l_discount * 500) AS INTEGER) THEN 'Player 1 Wins'
       WHEN CAST(l_quantity AS INTEGER) < CAST(round(l_discount * 500) AS INTEGER) THEN 'Player 2 Wins' ELSE 'Tie' END AS finish_state,
  CAST(l_quantity AS INTEGER) AS player_1_score, CAST(round(l_discount * 500) AS INTEGER) AS player_2_score,
  CAST(floor(l_extendedprice) % 200 + 1 AS INTEGER) AS turns
  FROM lineitem WHERE l_suppkey <> l_partkey % {PLAYER_MOD})"""


def planets(spark: SparkSession, d: str) -> DataFrame:
    """Planet snapshots: games of 10 planets (vec_id DIV 10), turn 0; x, y from the vector."""
    e = read_table(spark, d, "embeddings", ["vec_id", "embedding", "label"])
    return e.select(
        F.floor(F.col("vec_id") / PLANETS_PER_GAME).cast("long").alias("game_id"),
        F.lit(0).alias("turn"),
        F.col("vec_id").alias("planet_id"),
        (F.col("label") % 3).alias("owner"),
        (F.abs(F.col("embedding")[2].cast("double")) * 1000).cast("int").alias("num_ships"),
        (F.abs(F.col("embedding")[3].cast("double")) * 20).cast("int").alias("growth_rate"),
        (F.col("embedding")[0].cast("double") * 100).alias("x"),
        (F.col("embedding")[1].cast("double") * 100).alias("y"),
    )


# DuckDB lists are 1-based.
PLANETS_SQL = f"""planets AS (SELECT CAST(vec_id // {PLANETS_PER_GAME} AS BIGINT) AS game_id, 0 AS turn, vec_id AS planet_id, label % 3 AS owner,
  CAST(trunc(abs(CAST(embedding[3] AS DOUBLE)) * 1000) AS INTEGER) AS num_ships,
  CAST(trunc(abs(CAST(embedding[4] AS DOUBLE)) * 20) AS INTEGER) AS growth_rate,
  CAST(embedding[1] AS DOUBLE) * 100 AS x, CAST(embedding[2] AS DOUBLE) * 100 AS y FROM embeddings)"""


def fleets(spark: SparkSession, d: str) -> DataFrame:
    """Fleets in flight: one per line item; source and target lie in the same game.

    Planet ids 10*g + k (k < 10) of game g < 50 exist at every scale.
    """
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
    g = F.col("l_orderkey") % GAMES
    return li.select(
        g.alias("game_id"),
        F.lit(0).alias("turn"),
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("fleet_id"),
        (F.col("l_suppkey") % 3).alias("owner"),
        F.col("l_quantity").cast("int").alias("num_ships"),
        (g * PLANETS_PER_GAME + F.col("l_suppkey") % 10).alias("source_planet_id"),
        (g * PLANETS_PER_GAME + F.col("l_partkey") % 10).alias("destination_planet_id"),
        (F.col("l_linenumber") + F.col("l_orderkey") % 3).cast("int").alias("total_trip_length"),
        (F.col("l_linenumber") - 1).cast("int").alias("turns_remaining"),
    )


FLEETS_SQL = f"""fleets AS (SELECT l_orderkey % {GAMES} AS game_id, 0 AS turn, l_orderkey * 16 + l_linenumber AS fleet_id,
  l_suppkey % 3 AS owner, CAST(l_quantity AS INTEGER) AS num_ships,
  (l_orderkey % {GAMES}) * {PLANETS_PER_GAME} + l_suppkey % 10 AS source_planet_id,
  (l_orderkey % {GAMES}) * {PLANETS_PER_GAME} + l_partkey % 10 AS destination_planet_id,
  CAST(l_linenumber + l_orderkey % 3 AS INTEGER) AS total_trip_length, CAST(l_linenumber - 1 AS INTEGER) AS turns_remaining
  FROM lineitem)"""


def planet_turns(spark: SparkSession, d: str) -> DataFrame:
    """Planet states over ``TURNS`` turns: owners change as turns go by, owned planets grow."""
    p = planets(spark, d).select("game_id", "planet_id", "owner", "num_ships", "growth_rate", "x", "y",
                                 F.explode(F.sequence(F.lit(0), F.lit(TURNS - 1))).alias("turn"))
    owner = ((F.col("owner") + F.floor((F.col("planet_id") + F.col("turn")) / 3)) % 3).cast("int")
    ships = F.col("num_ships") + F.when(owner != 0, F.col("growth_rate") * F.col("turn")).otherwise(0)
    return p.withColumns({"owner": owner, "num_ships": ships.cast("int")})


PLANET_TURNS_SQL = f"""planet_turns AS (SELECT game_id, CAST(t.range AS INTEGER) AS turn, planet_id,
  CAST((owner + (planet_id + t.range) // 3) % 3 AS INTEGER) AS owner, growth_rate, x, y,
  CAST(num_ships + CASE WHEN (owner + (planet_id + t.range) // 3) % 3 <> 0 THEN growth_rate * t.range ELSE 0 END AS INTEGER) AS num_ships FROM planets, range(0, {TURNS}) t)"""


def fleet_turns(spark: SparkSession, d: str) -> DataFrame:
    """Every fleet on each turn of its flight; the games are those of ``embeddings``, however many."""
    last = read_table(spark, d, "embeddings", ["vec_id"]).agg(F.max("vec_id")).first()[0]
    games = (last or 0) // PLANETS_PER_GAME + 1
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
    start, trip = F.col("l_linenumber") % 3, 1 + F.col("l_orderkey") % 4
    flight = li.withColumns({"game_id": F.col("l_orderkey") % games, "start": start.cast("int"), "trip": trip.cast("int")})
    flight = flight.withColumn("turn", F.explode(F.sequence(F.col("start"), F.least(F.col("start") + F.col("trip"), F.lit(TURNS)) - 1)))
    return flight.select(
        "game_id", "turn", (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("fleet_id"),
        (1 + F.col("l_suppkey") % 2).cast("int").alias("owner"), F.col("l_quantity").cast("int").alias("num_ships"),
        (F.col("l_suppkey") % PLANETS_PER_GAME).cast("int").alias("source_planet_id"),
        (F.col("l_partkey") % PLANETS_PER_GAME).cast("int").alias("destination_planet_id"),
        F.col("trip").alias("total_trip_length"), (F.col("trip") - (F.col("turn") - F.col("start"))).alias("turns_remaining"))


FLEET_TURNS_SQL = f"""fleet_turns AS (SELECT l_orderkey % (SELECT max(vec_id) // {PLANETS_PER_GAME} + 1 FROM embeddings) AS game_id, CAST(t.range AS INTEGER) AS turn,
  l_orderkey * 16 + l_linenumber AS fleet_id, CAST(1 + l_suppkey % 2 AS INTEGER) AS owner, CAST(l_quantity AS INTEGER) AS num_ships,
  CAST(l_suppkey % {PLANETS_PER_GAME} AS INTEGER) AS source_planet_id, CAST(l_partkey % {PLANETS_PER_GAME} AS INTEGER) AS destination_planet_id,
  CAST(1 + l_orderkey % 4 AS INTEGER) AS total_trip_length, CAST(1 + l_orderkey % 4 - (t.range - l_linenumber % 3) AS INTEGER) AS turns_remaining
  FROM lineitem, range(0, {TURNS}) t WHERE t.range >= l_linenumber % 3 AND t.range < l_linenumber % 3 + 1 + l_orderkey % 4)"""
