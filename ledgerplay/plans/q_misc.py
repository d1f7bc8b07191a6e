"""Joins, set operations, top-k and sources/sinks: J2-J5, J8, J11, J12, U1-U4,
T2, T3, T6, S1-S5, S8-S11, G31."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerplay.functions.formulas import pmt, pmt_sql, unit_hash, unit_hash_sql
from ledgerplay.operators import aggregates as G
from ledgerplay.operators import gamelog as GL
from ledgerplay.operators import joins as J
from ledgerplay.operators import windows as W
from ledgerplay.plans import bindings as B
from ledgerplay.plans.common import finish, r6
from ledgerplay.plans.q_clean import CORR_COLS, LI_NUM, TRAIN, houses
from ledgerplay.plans.q_game import SIDES_SQL
from ledgerplay.plans.registry import register, with_views
from ledgerplay.session import checkpoint_dir
from ledgerplay.sources import gamefiles as GF
from ledgerplay.sources import tables as S


def scratch(spark, tag: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), "ledgerplay-io", f"{tag}-{uuid.uuid4().hex}")


@register("j2_enrich_suffixed", with_views("offers", "bureau") +
          "SELECT o.offer_key, o.id, o.occupation, b.segment AS occupation_r FROM offers o LEFT JOIN bureau b ON o.id = b.id")
def j2_enrich_suffixed(spark, d):
    right = B.bureau(spark, d).select(F.col("id").alias("cust"), F.col("segment").alias("occupation"))
    left = B.offers(spark, d).select("offer_key", "id", "occupation")
    return J.enrich_suffixed(left, right, "id", "cust")


@register("j3_map_lookup", with_views("offers", extra="""te AS (SELECT coalesce(occupation, 'NA') AS k, avg(CAST(offer_accepted AS DOUBLE)) AS v FROM offers GROUP BY 1)""") +
          f"SELECT offer_key, {r6('te.v')} AS occupation_enc FROM offers LEFT JOIN te ON offers.occupation IS NOT DISTINCT FROM te.k")
def j3_map_lookup(spark, d):
    o = B.offers(spark, d)
    te = G.target_encode(o, "occupation", "offer_accepted")
    return finish(J.map_lookup(o, "occupation", te, "occupation", "occupation_te", "occupation_enc").select("offer_key", "occupation_enc"))


@register("j4_anti_rows", with_views("houses") + f'SELECT "Id" FROM houses WHERE NOT ({TRAIN})')
def j4_anti_rows(spark, d):
    h = houses(spark, d)
    return J.anti_rows(h, h.where(unit_hash("Id") < 0.75), "Id").select("Id")


@register("j5_semi_rows", with_views("bureau") + "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT id FROM bureau WHERE town = 'AMERICA')")
def j5_semi_rows(spark, d):
    o = S.read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    ids = B.bureau(spark, d).where(F.col("town") == "AMERICA").select(F.col("id").alias("o_custkey"))
    return J.semi_rows(o, ids, "o_custkey").select("o_orderkey")


RATES = list(range(5, 31))


@register("j8_scenario_grid", with_views("loans") + f"""SELECT CAST(r.range AS INTEGER) AS rate, count(*) AS n,
  {r6(f"sum({pmt_sql('CAST(r.range AS DOUBLE) / 1200.0', 'term', 'loan_amnt')})", 2)} AS total_pmt FROM loans, range(5, 31) r GROUP BY 1""")
def j8_scenario_grid(spark, d):
    g = J.scenario_grid(B.loans(spark, d), rate=RATES)
    g = g.withColumn("pmt", pmt("CAST(rate AS DOUBLE) / 1200.0", "term", "loan_amnt"))
    return finish(g.groupBy(F.col("rate").cast("int").alias("rate")).agg(F.count(F.lit(1)).alias("n"), F.sum("pmt").alias("total_pmt")), 2)


@register("j11_rate_lookup", with_views("loans") + f"""SELECT loan_id, {r6('(round(int_rate + (loan_id % 3 - 1) * 0.4) - (loan_id % 9)) / 100.0')} AS pred FROM loans""")
def j11_rate_lookup(spark, d):
    l = B.loans(spark, d)
    preds = l.select("loan_id", *[((F.lit(float(r)) - F.col("loan_id") % 9) / 100.0).alias(f"irr_{r}") for r in RATES])
    q = l.withColumn("rate_q", F.col("int_rate") + (F.col("loan_id") % 3 - 1) * 0.4)
    return finish(J.rate_lookup(q, preds, "loan_id", "rate_q").select("loan_id", "pred"))


@register("j12_same_ids", """WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer), b AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT count_if(b.k IS NULL) AS only_left, count_if(a.k IS NULL) AS only_right, count_if(a.k IS NOT NULL AND b.k IS NOT NULL) AS both
FROM a FULL OUTER JOIN b ON a.k = b.k""")
def j12_same_ids(spark, d):
    c = S.read_table(spark, d, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("k"))
    o = S.read_table(spark, d, "orders", ["o_custkey"]).select(F.col("o_custkey").alias("k"))
    return J.same_ids(c, o, "k")


@register("u1_union_all", with_views("offers", "bureau") + f"""SELECT id, offer_key, NULL::DOUBLE AS credit_score FROM offers WHERE offer_accepted
  UNION ALL SELECT id, NULL::BIGINT AS offer_key, {r6('credit_score')} AS credit_score FROM bureau""")
def u1_union_all(spark, d):
    a = B.offers(spark, d).where("offer_accepted").select("id", "offer_key")
    b = B.bureau(spark, d).select("id", "credit_score")
    return finish(W.union_all(a, b))


@register("u2_intersect", "SELECT c_custkey AS id FROM customer WHERE c_acctbal > 0 INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def u2_intersect(spark, d):
    a = S.read_table(spark, d, "customer", ["c_custkey", "c_acctbal"]).where("c_acctbal > 0").select(F.col("c_custkey").alias("id"))
    b = S.read_table(spark, d, "orders", ["o_custkey", "o_orderstatus"]).where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return W.intersect(a, b)


@register("u3_except", "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def u3_except(spark, d):
    a = S.read_table(spark, d, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("id"))
    b = S.read_table(spark, d, "orders", ["o_custkey", "o_orderstatus"]).where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return W.except_(a, b)


@register("u3_except_all", "SELECT o_custkey AS id FROM orders EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def u3_except_all(spark, d):
    o = S.read_table(spark, d, "orders", ["o_custkey", "o_orderstatus"])
    return W.except_(o.select(F.col("o_custkey").alias("id")), o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")), all_rows=True)


@register("u4_distinct", with_views("offers") + "SELECT DISTINCT id, occupation FROM offers")
def u4_distinct(spark, d):
    return W.distinct(B.offers(spark, d).select("id", "occupation"))


@register("t2_head_sample", with_views("offers") + f"""SELECT offer_key, id FROM offers ORDER BY {unit_hash_sql('offer_key')}, offer_key LIMIT 10""")
def t2_head_sample(spark, d):
    return W.head(B.offers(spark, d).select("offer_key", "id"), 10, key="offer_key")


@register("t3_top_features", with_views("houses") + "SELECT \"column\", corr, abs_corr FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {r6(f'corr("{c}", "SalePrice")')} AS corr, {r6(f'abs(corr("{c}", "SalePrice"))')} AS abs_corr FROM houses""" for c in CORR_COLS)
    + ') ORDER BY abs_corr DESC, "column" LIMIT 2')
def t3_top_features(spark, d):
    return finish(W.top_columns(G.corr_with(houses(spark, d), "SalePrice", CORR_COLS), "corr", 2))


@register("t6_all_targets_ranked", with_views("fleets", extra="""b AS (SELECT *, row_number() OVER (PARTITION BY game_id, turn, destination_planet_id
  ORDER BY num_ships DESC, fleet_id, source_planet_id) AS rn FROM fleets)""") + """SELECT game_id, turn, destination_planet_id, source_planet_id, num_ships,
  CAST(row_number() OVER (PARTITION BY game_id, turn ORDER BY num_ships DESC, destination_planet_id) AS INTEGER) AS target_rank FROM b WHERE rn = 1""")
def t6_all_targets_ranked(spark, d):
    f = B.fleets(spark, d).select("game_id", "turn", "destination_planet_id", "source_planet_id", "num_ships", "fleet_id")
    best = GL.best_target(f, ["game_id", "turn", "destination_planet_id"], "num_ships", ["fleet_id", "source_planet_id"]).drop("fleet_id")
    w = Window.partitionBy("game_id", "turn").orderBy(F.col("num_ships").desc(), "destination_planet_id")
    return best.withColumn("target_rank", F.row_number().over(w))


@register("s1_read_parquet", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def s1_read_parquet(spark, d):
    o = S.read_parquet(spark, S.table_path(d, "orders"), ["o_orderpriority", "o_orderstatus"])
    return o.where(F.col("o_orderstatus") == "F").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@register("s2_read_parquet_fraction", "SELECT count(*) AS n FROM lineitem")
def s2_read_parquet_fraction(spark, d):
    return S.read_parquet_fraction(spark, d, 1.0, "lineitem.parquet", ["l_orderkey"]).agg(F.count(F.lit(1)).alias("n"))


@register("s3_s4_csv_roundtrip", with_views("offers", "bureau") + f"""SELECT b.town, count(*) AS n, {r6('sum(o.requested_amount)', 2)} AS amount
  FROM offers o JOIN bureau b USING (id) WHERE b.town LIKE '%ERICA%' GROUP BY 1""")
def s3_s4_csv_roundtrip(spark, d):
    path = scratch(spark, "offers-csv")
    o = B.offers(spark, d).join(B.bureau(spark, d).select("id", "town"), "id")
    S.write_table(o.select("town", "offer_key", "requested_amount"), path, fmt="csv", partition_by=["town"])
    schema = "offer_key long, requested_amount double"
    back = S.read_csv_glob(spark, path, "town=*ERICA*", schema, match="path")
    back = back.withColumn("town", F.regexp_extract("source_file", "town=([^/]+)", 1))
    back = back.withColumn("town", F.expr("url_decode(town)"))
    return finish(back.groupBy("town").agg(F.count(F.lit(1)).alias("n"), F.sum("requested_amount").alias("amount")), 2)


@register("s5_read_by_feature_list", "SELECT " + ", ".join(LI_NUM) + " FROM lineitem")
def s5_read_by_feature_list(spark, d):
    li = S.read_table(spark, d, "lineitem", LI_NUM)
    feats = G.std_ranking(li, LI_NUM).where(F.col("std") > 0).select(F.col("column").alias("feature"))
    return finish(S.read_by_feature_list(li, feats))


ROUNDS_SQL = SIDES_SQL.replace("FROM battles", "FROM battles_r") + """,
st AS (SELECT CAST(battle_id % 3 AS INTEGER) AS round_id, player_name, count(*) AS battle_count, CAST(sum(CAST(won AS INTEGER)) AS BIGINT) AS won,
  CAST(sum(CAST(lost AS INTEGER)) AS BIGINT) AS lost, CAST(sum(CAST(tie AS INTEGER)) AS BIGINT) AS tie,
  CAST(sum(CAST(won AS INTEGER)) + 0.5 * sum(CAST(tie AS INTEGER)) AS DOUBLE) AS points FROM sides2 GROUP BY 1, 2)"""


@register("s9_s10_round_roundtrip", with_views("battles", extra="battles_r AS (SELECT * FROM battles),\n" + ROUNDS_SQL) +
          f"""SELECT round_id, player_name, battle_count, won, lost, tie, {r6('points')} AS points FROM st""")
def s9_s10_round_roundtrip(spark, d):
    """Standings of every round written partitioned by round, then each round
    read back through a partition filter."""
    path = scratch(spark, "standings")
    sd = GL.battle_sides(B.battles(spark, d)).withColumn("round_id", (F.col("battle_id") % 3).cast("int"))
    S.write_table(GL.standings_by(sd, ["round_id"]), path, partition_by=["round_id"])
    cols = ["player_name", "battle_count", "won", "lost", "tie", "points"]
    parts = [S.load_round(spark, path, r, cols).withColumn("round_id", F.lit(r)) for r in (0, 1, 2)]
    return finish(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@register("s11_export_selection", with_views("loans", extra="""scored AS (SELECT loans.*, c_acctbal AS score FROM loans JOIN customer ON id = c_custkey),
c AS (SELECT loan_id, sum(loan_amnt) OVER (ORDER BY score DESC, loan_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
  sum(loan_amnt) OVER () AS total FROM scored)""") + """SELECT CAST(d.x AS DOUBLE) AS discount, count(*) AS n FROM c, (VALUES (0.0), (0.02), (0.03)) d(x)
  WHERE coalesce(before, 0) < 0.5 * total GROUP BY 1""")
def s11_export_selection(spark, d):
    from ledgerplay.plans.q_payments import scored
    path = scratch(spark, "selection")
    top = W.top_by_volume(scored(spark, d), "score", "loan_amnt", 0.5, "loan_id").select("loan_id")
    sel = J.scenario_grid(top, discount=[0.0, 0.02, 0.03])
    S.export_selection(sel, path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("discount").cast("double").alias("discount")).agg(F.count(F.lit(1)).alias("n"))


LOG_LINES_SQL = """lines AS (SELECT finish_state AS value FROM battles
  UNION ALL SELECT 'Player ' || player_2_name || ' throw exception ValueError: no ships left' FROM battles WHERE player_2_score = 0)"""


def console_lines(spark, d):
    """Console text derived from the battle table: one result line per battle and
    a failure line when the second player ends with no ships."""
    b = B.battles(spark, d)
    res = b.select(F.col("finish_state").alias("value"))
    fail = b.where(F.col("player_2_score") == 0).select(
        F.concat(F.lit("Player "), F.col("player_2_name"), F.lit(" throw exception ValueError: no ships left")).alias("value"))
    return res.unionByName(fail)


@register("s8_g31_log_counts", with_views("battles", extra=LOG_LINES_SQL) + """SELECT CASE WHEN value IN ('Player 1 Wins', 'Player 2 Wins', 'Tie') THEN 'result' ELSE 'failure' END AS kind,
  CASE WHEN value LIKE 'Player % throw exception %' THEN regexp_extract(value, '^Player (.+?) throw exception (\\w+): (.*)$', 1) END AS player,
  CASE WHEN value LIKE 'Player % throw exception %' THEN regexp_extract(value, '^Player (.+?) throw exception (\\w+): (.*)$', 2) ELSE value END AS detail,
  count(*) AS n FROM lines GROUP BY ALL""")
def s8_g31_log_counts(spark, d):
    return GL.log_counts(GF.parse_console_log(console_lines(spark, d)))


@register("p1_where", with_views("offers") + f"SELECT offer_key, id, {r6('requested_amount')} AS requested_amount FROM offers WHERE offer_accepted AND requested_amount > 100000")
def p1_where(spark, d):
    from ledgerplay.operators import clean as P
    o = B.offers(spark, d)
    return finish(P.where(P.where(o, "offer_accepted"), F.col("requested_amount") > 100000).select("offer_key", "id", "requested_amount"))


@register("t1_sort", f"SELECT o_orderkey, {r6('o_totalprice')} AS o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def t1_sort(spark, d):
    o = S.read_table(spark, d, "orders", ["o_orderkey", "o_totalprice"])
    return finish(W.sort(o, F.col("o_totalprice").desc(), F.col("o_orderkey")))


@register("f2_annualize", with_views("loans") + f"""SELECT loan_id, {r6('pow(1.0 + int_rate / 1200.0, 12) - 1')} AS yearly,
  {r6('pow(1.0 + int_rate / 100.0, 1.0 / 12.0) - 1')} AS monthly FROM loans""")
def f2_annualize(spark, d):
    from ledgerplay.operators import cashflow as C
    from ledgerplay.functions.formulas import deannualize
    l = B.loans(spark, d)
    return finish(l.select("loan_id", C.annualize(F.col("int_rate") / 1200.0).alias("yearly"),
                           deannualize(F.col("int_rate") / 100.0).alias("monthly")))
