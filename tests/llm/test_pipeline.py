"""The pipeline's stages one after the other, and the queries that have SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_stages_take_effect(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = docs
    kept = []
    for name, stage in P.STAGES[:-1]:
        seen = spark.createDataFrame(stage(spark, seen, SF_SMALL).toPandas(), docs.schema)
        assert seen.schema == docs.schema
        kept.append(seen.count())
    assert kept[0] < docs.count() and kept[1] <= kept[0] and kept[2] <= kept[1] and kept[3] > 0
    assert P.packed_tokens(spark, seen, SF_SMALL).count() > 0


def test_stages_keep_own_columns_nulls_and_empty_tables(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120)
    for name in ("size", "sources", "target", "copies", "taken", "source_size", "score", "th", "__copy"):
        docs = docs.withColumn(name, F.lit("mine"))
    odd = docs.limit(3).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    docs = spark.createDataFrame(docs.union(docs.limit(2)).union(odd).collect(), docs.schema)
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.count() > 0
        assert {r[0] for r in out.select(F.concat_ws(",", "size", "sources", "target", "copies", "taken", "source_size", "score", "th", "__copy")).distinct().collect()} == {",".join(["mine"] * 9)}
    for _, stage in P.STAGES[1:]:
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
    assert P.packed_tokens(spark, docs, SF_SMALL).count() > 0


@pytest.mark.parametrize("name", ["op3_line_dedup", "op7_near_duplicates", "op9_substring_dedup", "op10_top_k"])
def test_query_equals_its_sql(spark, name):
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(tuple(r) for r in df.select(cols).collect()) == sorted(cur.fetchall())
