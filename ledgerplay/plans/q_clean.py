"""Cleaning, profiling and descriptive statistics (P*, G3-G17, G32, G39)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerplay.functions.formulas import unit_hash, unit_hash_sql
from ledgerplay.operators import aggregates as G
from ledgerplay.operators import clean as P
from ledgerplay.plans import bindings as B
from ledgerplay.plans.common import finish, r6
from ledgerplay.plans.registry import register, with_views
from ledgerplay.sources.tables import read_table

HOUSE_COLS = ["Id", "SalePrice", "Neighborhood", "BldgType", "HouseStyle", "GrLivArea", "LotFrontage", "Alley", "MoSold"]
NUM_HOUSE = ["Id", "SalePrice", "GrLivArea", "LotFrontage", "MoSold"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TRAIN = unit_hash_sql('"Id"') + " < 0.75"


def houses(spark, d):
    return B.houses(spark, d)


def train(spark, d):
    return houses(spark, d).where(unit_hash("Id") < 0.75)


def _q(c: str) -> str:
    return f'"{c}"'


@register("p8_null_profile", with_views("houses") + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count_if({_q(c)} IS NULL) AS missing, {r6(f'count_if({_q(c)} IS NULL) * 100.0 / count(*)', 2)} AS percent FROM houses"
    for c in HOUSE_COLS) + ") WHERE missing > 0")
def p8_null_profile(spark, d):
    return finish(P.null_profile(houses(spark, d)))


POOL_SQL = 'houses2 AS (SELECT houses.*, CASE WHEN p_size > 1000 THEN CAST(p_size AS DOUBLE) END AS "PoolArea" FROM houses JOIN part ON "Id" = p_partkey)'


def houses2(spark, d):
    p = read_table(spark, d, "part", ["p_partkey", "p_size"])
    return houses(spark, d).join(p, F.col("Id") == F.col("p_partkey")).withColumn(
        "PoolArea", F.when(F.col("p_size") > 1000, F.col("p_size").cast("double"))).drop("p_partkey", "p_size")


@register("p6_drop_all_null_columns", with_views("houses", extra=POOL_SQL) + "SELECT " + ", ".join(_q(c) for c in HOUSE_COLS) + " FROM houses2")
def p6_drop_all_null_columns(spark, d):
    return finish(P.drop_all_null_columns(houses2(spark, d)))


@register("p7_drop_sparse_columns", with_views("houses") + "SELECT " + ", ".join(_q(c) for c in HOUSE_COLS if c != "Alley") + " FROM houses")
def p7_drop_sparse_columns(spark, d):
    return finish(P.drop_sparse_columns(houses(spark, d), 0.15))


@register("p5_drop_null_rows", with_views("houses") + 'SELECT "Id" FROM houses WHERE "LotFrontage" IS NOT NULL AND "Alley" IS NOT NULL')
def p5_drop_null_rows(spark, d):
    return P.drop_null_rows(houses(spark, d), ["LotFrontage", "Alley"]).select("Id")


@register("p2_range_to_null", with_views("bureau") + f"SELECT id, {r6('CASE WHEN credit_score BETWEEN 0 AND 10000 THEN credit_score END')} AS credit_score FROM bureau")
def p2_range_to_null(spark, d):
    return finish(P.range_to_null(B.bureau(spark, d), "credit_score", 0, 10000).select("id", "credit_score"))


@register("p3_clip", with_views("offers") + f"SELECT offer_key, {r6('least(greatest(requested_amount, 50000), 400000)')} AS clipped FROM offers")
def p3_clip(spark, d):
    return finish(B.offers(spark, d).select("offer_key", P.clip("requested_amount", 50000, 400000).alias("clipped")))


@register("p4_coerce_numeric", """SELECT c_custkey, TRY_CAST(split_part(c_name, '#', 2) AS DOUBLE) AS num,
  TRY_CAST(c_mktsegment AS DOUBLE) AS bad FROM customer""")
def p4_coerce_numeric(spark, d):
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    c = c.select("c_custkey", F.split("c_name", "#")[1].alias("num"), F.col("c_mktsegment").alias("bad"))
    return finish(P.coerce_numeric(c, ["num", "bad"]))


@register("p4_coerce_timestamp", """SELECT event_id, TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts,
  TRY_CAST(event_type AS TIMESTAMP) AS bad FROM events""")
def p4_coerce_timestamp(spark, d):
    e = read_table(spark, d, "events", ["event_id", "ts", "event_type"])
    e = e.select("event_id", F.col("ts").cast("string").alias("ts"), F.col("event_type").alias("bad"))
    return P.coerce_timestamp(e, ["ts", "bad"]).withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "bad": F.col("bad").cast("timestamp_ntz")})


@register("p9_select_by_type", with_views("houses") + "SELECT " + ", ".join(_q(c) for c in NUM_HOUSE) + " FROM houses")
def p9_select_by_type(spark, d):
    return finish(P.select_by_type(houses(spark, d), "number"))


@register("p10_select_like", with_views("houses") + 'SELECT "SalePrice", "GrLivArea" FROM houses')
def p10_select_like(spark, d):
    return finish(P.select_like(houses(spark, d), "Price|Area"))


@register("p11_rename_columns", with_views("houses") + "SELECT " + ", ".join(f'{_q(c)} AS "h_{c}"' for c in HOUSE_COLS) + " FROM houses")
def p11_rename_columns(spark, d):
    return finish(P.rename_columns(houses(spark, d), prefix="h_"))


@register("p12_drop_columns", with_views("houses") + "SELECT " + ", ".join(_q(c) for c in HOUSE_COLS if c not in ("Id", "HouseStyle")) + " FROM houses")
def p12_drop_columns(spark, d):
    return finish(P.drop_columns(houses(spark, d), ["Id", "HouseStyle"]))


LOAN_STATUS_SQL = """paid_mob AS (SELECT loan_id, mob, sum(paid) AS paid FROM payments GROUP BY loan_id, mob),
last_mob AS (SELECT loan_id, max(mob) AS last_mob FROM paid_mob WHERE paid > 0 GROUP BY loan_id),
loan_status AS (SELECT loans.*, CASE WHEN coalesce(last_mob, 0) < term THEN coalesce(last_mob, 0) + 1 END AS co_mob
  FROM loans LEFT JOIN last_mob USING (loan_id))"""


def loan_status(spark, d):
    """Loans with co_mob = first month after the last paid one (NULL if paid to term)."""
    pays = B.payments(spark, d).groupBy("loan_id", "mob").agg(F.sum("paid").alias("paid"))
    last = pays.where(F.col("paid") > 0).groupBy("loan_id").agg(F.max("mob").alias("last_mob"))
    l = B.loans(spark, d).join(last, "loan_id", "left")
    lm = F.coalesce(F.col("last_mob"), F.lit(0))
    return l.withColumn("co_mob", F.when(lm < F.col("term"), lm + 1)).drop("last_mob")


@register("p13_target_from_null", with_views("loans", "payments", extra=LOAN_STATUS_SQL) + "SELECT loan_id, co_mob, co_mob IS NOT NULL AS target FROM loan_status")
def p13_target_from_null(spark, d):
    return P.target_from_null(loan_status(spark, d), "co_mob").select("loan_id", "co_mob", "target")


@register("p14_indicator", with_views("houses") + 'SELECT "Id", coalesce(CAST("LotFrontage" > 0 AS INTEGER), 0) AS "HasLot" FROM houses')
def p14_indicator(spark, d):
    return P.indicator(houses(spark, d), {"HasLot": "LotFrontage"}).select("Id", "HasLot")


@register("p15_cast_columns", with_views("houses") + 'SELECT "Id", CAST("MoSold" AS VARCHAR) AS "MoSold" FROM houses')
def p15_cast_columns(spark, d):
    return P.cast_columns(houses(spark, d), ["MoSold"]).select("Id", "MoSold")


@register("p16_fill_const", with_views("houses") + f"""SELECT "Id", {r6('coalesce("LotFrontage", 0.0)')} AS "LotFrontage", coalesce("Alley", 'NA') AS "Alley" FROM houses""")
def p16_fill_const(spark, d):
    return finish(P.fill_const(houses(spark, d), {"LotFrontage": 0.0, "Alley": "NA"}).select("Id", "LotFrontage", "Alley"))


@register("p17_fill_group_stat", with_views("houses", extra=f"""tr AS (SELECT * FROM houses WHERE {TRAIN}),
st AS (SELECT "Neighborhood", quantile_cont("LotFrontage", 0.5) AS fill FROM tr GROUP BY "Neighborhood")""") +
    f"""SELECT "Id", {r6('coalesce("LotFrontage", fill)')} AS "LotFrontage" FROM houses LEFT JOIN st USING ("Neighborhood")""")
def p17_fill_group_stat(spark, d):
    return finish(P.fill_group_stat(houses(spark, d), train(spark, d), "Neighborhood", "LotFrontage", "median").select("Id", "LotFrontage"))


@register("p18_fill_mode", with_views("houses", extra=f"""tr AS (SELECT * FROM houses WHERE {TRAIN}),
m AS (SELECT "Alley" AS fill FROM tr WHERE "Alley" IS NOT NULL GROUP BY "Alley" ORDER BY count(*) DESC, "Alley" LIMIT 1)""") +
    """SELECT "Id", coalesce("Alley", fill) AS "Alley" FROM houses, m""")
def p18_fill_mode(spark, d):
    return P.fill_mode(houses(spark, d), train(spark, d), ["Alley"]).select("Id", "Alley")


@register("p19_fill_mean", with_views("houses", extra=f"""m AS (SELECT avg("LotFrontage") AS fill FROM houses WHERE {TRAIN})""") +
    f"""SELECT "Id", {r6('coalesce("LotFrontage", fill)')} AS "LotFrontage" FROM houses, m""")
def p19_fill_mean(spark, d):
    return finish(P.fill_mean(houses(spark, d), train(spark, d), "LotFrontage").select("Id", "LotFrontage"))


@register("p20_drop_iqr_outliers", """WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
SELECT o_orderstatus, count(*) AS n_kept FROM orders, q WHERE o_totalprice <= q3 + 0.5 * (q3 - q1) GROUP BY o_orderstatus""")
def p20_drop_iqr_outliers(spark, d):
    o = read_table(spark, d, "orders", ["o_orderstatus", "o_totalprice"])
    return P.drop_iqr_outliers(o, "o_totalprice", k=0.5).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_kept"))


@register("p21_count_outliers", """WITH v AS (SELECT CASE WHEN l_extendedprice > 0 THEN ln(l_extendedprice) END AS x FROM lineitem),
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM v)
SELECT count_if(x < q1 - 1.5 * (q3 - q1)) AS n_low, count_if(x > q3 + 1.5 * (q3 - q1)) AS n_high FROM v, q""")
def p21_count_outliers(spark, d):
    return P.count_outliers(read_table(spark, d, "lineitem", ["l_extendedprice"]), "l_extendedprice")


@register("p22_low_variability", with_views("houses") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {_q(c)}) AS n_distinct FROM houses" for c in HOUSE_COLS))
def p22_low_variability(spark, d):
    return P.low_variability(houses(spark, d))


@register("p23_log_transform", with_views("houses") + f"""SELECT "Id", {r6('CASE WHEN "SalePrice" > 0 THEN log10("SalePrice") END')} AS "SalePrice" FROM houses""")
def p23_log_transform(spark, d):
    return finish(P.log_transform(houses(spark, d), "SalePrice", "10").select("Id", "SalePrice"))


@register("p24_prepare_loans", with_views("loans") + f"""SELECT loan_id, id, {r6('loan_amnt')} AS loan_amnt, {r6('int_rate')} AS int_rate, term
  FROM loans WHERE int_rate IS NOT NULL""")
def p24_prepare_loans(spark, d):
    return finish(P.prepare_loans(B.loans(spark, d), "int_rate", na_threshold=0.5))


@register("p25_tag_and_recombine", with_views("houses") + f"""SELECT "Id", CASE WHEN {TRAIN} THEN 'train' ELSE 'test' END AS "set",
  {r6('coalesce("LotFrontage", 0.0)')} AS "LotFrontage" FROM houses""")
def p25_tag_and_recombine(spark, d):
    h = houses(spark, d)
    tr, te = h.where(unit_hash("Id") < 0.75), h.where(~(unit_hash("Id") < 0.75))
    a, b = P.tag_and_recombine(tr, te, lambda df: P.fill_const(df, {"LotFrontage": 0.0}))
    out = a.withColumn("set", F.lit("train")).unionByName(b.withColumn("set", F.lit("test")))
    return finish(out.select("Id", "set", "LotFrontage"))


@register("p26_invalid_cashflow_rows", with_views("loans", "payments", extra=LOAN_STATUS_SQL + """,
j AS (SELECT p.loan_id, p.mob, p.paid, l.loan_amnt, l.co_mob,
  coalesce(sum(p.paid) OVER (PARTITION BY p.loan_id ORDER BY p.mob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS paid_before
  FROM paid_mob p JOIN loan_status l USING (loan_id))""") + """
SELECT loan_id, bool_or(paid < 0 OR (paid_before >= loan_amnt AND paid > 0) OR (co_mob IS NOT NULL AND mob > co_mob AND paid > 0)) AS invalid
FROM j GROUP BY loan_id""")
def p26_invalid_cashflow_rows(spark, d):
    pays = B.payments(spark, d).groupBy("loan_id", "mob").agg(F.sum("paid").alias("paid"))
    return P.invalid_cashflow_rows(loan_status(spark, d), pays)


@register("p28_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def p28_duplicate_keys(spark, d):
    return P.duplicate_keys(read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber"]), ["l_orderkey", "l_linenumber"])


@register("g3_value_shares", with_views("offers") + f"""SELECT occupation, count(*) AS n, {r6('count(*) / sum(count(*)) OVER ()')} AS share FROM offers GROUP BY occupation""")
def g3_value_shares(spark, d):
    return finish(G.value_shares(B.offers(spark, d), "occupation"))


@register("g4_distinct_count", with_views("offers") + "SELECT count(*) AS rows, count(DISTINCT id) AS distinct FROM offers")
def g4_distinct_count(spark, d):
    return G.distinct_count(B.offers(spark, d), "id")


DESC_COLS = ["SalePrice", "GrLivArea", "LotFrontage"]


@register("g5_describe", with_views("houses") + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {r6(f'count({_q(c)})')} AS count, {r6(f'avg({_q(c)})')} AS mean, {r6(f'stddev_samp({_q(c)})')} AS std,
  {r6(f'min({_q(c)})')} AS min, {r6(f'quantile_cont({_q(c)}, 0.25)')} AS q25, {r6(f'quantile_cont({_q(c)}, 0.5)')} AS q50,
  {r6(f'quantile_cont({_q(c)}, 0.75)')} AS q75, {r6(f'max({_q(c)})')} AS max FROM houses""" for c in DESC_COLS))
def g5_describe(spark, d):
    return finish(G.describe(houses(spark, d), DESC_COLS))


@register("g6_quantiles", " UNION ALL ".join(f"SELECT CAST({q} AS DOUBLE) AS q, " + r6(f"quantile_cont(o_totalprice, {q})") + " AS value FROM orders" for q in (0.1, 0.5, 0.9)))
def g6_quantiles(spark, d):
    return finish(G.quantiles(read_table(spark, d, "orders", ["o_totalprice"]), "o_totalprice", [0.1, 0.5, 0.9]))


@register("g7_group_stat", with_views("houses") + f"""SELECT "Neighborhood", {r6('quantile_cont("SalePrice", 0.5)')} AS median, count("SalePrice") AS n FROM houses GROUP BY 1""")
def g7_group_stat(spark, d):
    return finish(G.group_stat(houses(spark, d), "Neighborhood", "SalePrice", "median"))


@register("g8_target_encode", with_views("offers") + f"""SELECT coalesce(occupation, 'NA') AS occupation, {r6('avg(CAST(CAST(offer_accepted AS INTEGER) AS DOUBLE))')} AS occupation_te FROM offers GROUP BY 1""")
def g8_target_encode(spark, d):
    return finish(G.target_encode(B.offers(spark, d), "occupation", "offer_accepted"))


@register("g9_std_ranking", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {r6(f'stddev_samp({c})')} AS std FROM lineitem" for c in LI_NUM))
def g9_std_ranking(spark, d):
    return finish(G.std_ranking(read_table(spark, d, "lineitem", LI_NUM), LI_NUM))


CORR_COLS = ["GrLivArea", "LotFrontage", "MoSold"]


@register("g10_corr_with", with_views("houses") + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {r6(f'corr({_q(c)}, "SalePrice")')} AS corr, {r6(f'abs(corr({_q(c)}, "SalePrice"))')} AS abs_corr FROM houses""" for c in CORR_COLS))
def g10_corr_with(spark, d):
    return finish(G.corr_with(houses(spark, d), "SalePrice", CORR_COLS))


@register("g11_corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS corr FROM lineitem" for a in LI_NUM for b in LI_NUM if a != b))
def g11_corr_matrix(spark, d):
    return finish(G.corr_matrix(read_table(spark, d, "lineitem", LI_NUM), LI_NUM))


@register("g12_collinear_drop", "SELECT a AS \"column\", count_if(abs(c) > 0.5) AS n_high FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, corr({a}, {b}) AS c FROM lineitem" for a in LI_NUM for b in LI_NUM if a != b) + ") GROUP BY a")
def g12_collinear_drop(spark, d):
    return G.collinear_drop(read_table(spark, d, "lineitem", LI_NUM), LI_NUM, 0.5)


@register("g13_skewness_g1", with_views("houses") + f"""SELECT "BldgType", {r6('CASE WHEN count("SalePrice") > 2 THEN skewness("SalePrice") END')} AS skew,
  CAST(count("SalePrice") AS DOUBLE) AS n FROM houses GROUP BY 1""")
def g13_skewness_g1(spark, d):
    return finish(G.skewness_g1(houses(spark, d), "SalePrice", ["BldgType"]))


@register("g14_weighted_mean", f"SELECT l_returnflag, {r6('sum(l_discount * l_extendedprice) / nullif(sum(l_extendedprice), 0)')} AS weighted_mean FROM lineitem GROUP BY 1")
def g14_weighted_mean(spark, d):
    return finish(G.weighted_mean(read_table(spark, d, "lineitem", ["l_returnflag", "l_discount", "l_extendedprice"]),
                                  "l_discount", "l_extendedprice", ["l_returnflag"]))


HLO, HHI, HB = 0.0, 500000.0, 20


@register("g15_histogram", f"""WITH b AS (SELECT o_orderstatus, CAST(least(floor((o_totalprice - {HLO}) / {(HHI - HLO) / HB}), {HB - 1}) AS INTEGER) AS bin
  FROM orders WHERE o_totalprice >= {HLO} AND o_totalprice <= {HHI}),
c AS (SELECT o_orderstatus, bin, count(*) AS count FROM b GROUP BY 1, 2),
g AS (SELECT o_orderstatus, CAST(r.range AS INTEGER) AS bin FROM (SELECT DISTINCT o_orderstatus FROM c) k, range({HB}) r),
j AS (SELECT g.o_orderstatus, g.bin, coalesce(c.count, 0) AS count FROM g LEFT JOIN c USING (o_orderstatus, bin))
SELECT o_orderstatus, bin, count, {r6(f'{HLO} + bin * {(HHI - HLO) / HB}')} AS "left", {r6(f'{HLO} + (bin + 1) * {(HHI - HLO) / HB}')} AS "right",
  {r6(f'count / (sum(count) OVER (PARTITION BY o_orderstatus) * {(HHI - HLO) / HB})')} AS density FROM j""")
def g15_histogram(spark, d):
    o = read_table(spark, d, "orders", ["o_orderstatus", "o_totalprice"])
    return finish(G.histogram(o, "o_totalprice", HLO, HHI, HB, density=True, by=["o_orderstatus"]))


@register("g16_sqrt_bins", "SELECT CAST(greatest(1, floor(sqrt(count(DISTINCT p_size)))) AS INTEGER) AS n_bins FROM part")
def g16_sqrt_bins(spark, d):
    n = G.sqrt_bins(read_table(spark, d, "part", ["p_size"]), "p_size")
    return spark.range(1).select(F.lit(n).cast("int").alias("n_bins"))


@register("g17_box_stats", """WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS med,
  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
SELECT """ + f"""{r6('q1')} AS q1, {r6('med')} AS median, {r6('q3')} AS q3,
  {r6('min(CASE WHEN o_totalprice >= q1 - 1.5 * (q3 - q1) THEN o_totalprice END)')} AS whisker_low,
  {r6('max(CASE WHEN o_totalprice <= q3 + 1.5 * (q3 - q1) THEN o_totalprice END)')} AS whisker_high,
  count_if(o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM orders, q GROUP BY q1, med, q3""")
def g17_box_stats(spark, d):
    return finish(G.box_stats(read_table(spark, d, "orders", ["o_totalprice"]), "o_totalprice"))


@register("g32_date_span", 'SELECT o_orderstatus, min(o_orderdate) AS "first", max(o_orderdate) AS "last", count(*) AS n FROM orders GROUP BY 1')
def g32_date_span(spark, d):
    return G.date_span(read_table(spark, d, "orders", ["o_orderstatus", "o_orderdate"]), "o_orderdate", "o_orderstatus")


@register("g39_shape", with_views("houses") + f"SELECT count(*) AS rows, {len(HOUSE_COLS)} AS columns FROM houses")
def g39_shape(spark, d):
    return G.shape(houses(spark, d))
