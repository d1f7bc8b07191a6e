"""Corpus pipeline: quality -> near-dedup -> decontamination -> mixing -> token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes the
result of every stage as Parquet in the shared folder (``spark.checkpoint.dir``)
and hands it to the next one.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerplay.llm import decontaminate, mixing, near_dup, packing, quality
from ledgerplay.llm.queries import table, word_count
from ledgerplay.session import checkpoint_dir

DEDUP_SHINGLE = 5
DEDUP_SIMILAR = (80, 100)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents whose quality score is below the threshold go (a null text is scored as an empty one)."""
    model = quality.learn_model(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each near-duplicate group stays (5-word shingles, similarity 0.8):
    the smallest id, null ids last, then the least text hash; texts without words all stay."""
    return near_dup.unique_documents(docs, shingle=DEDUP_SHINGLE, similar=DEDUP_SIMILAR)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that hold a benchmark item, as it is or re-parameterised, go; each text
    is judged by itself, also where ids are null or repeated."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: each document as often as the mix takes it (weights 1, 2, 3 over the sources).

    A null text has size 0, a null source is a source of its own.  The whole row travels
    as one column, so columns named like those of the mix stay as they are."""
    sized = docs.select("doc_id", word_count().alias("size"), F.array("source").alias("sources"), F.struct(*docs.columns).alias("__row"))
    taken = mixing.mix(sized).where("copies > 0")
    return taken.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*")


def packed_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: packed id matrices, cumulative lengths and position resets."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", good_documents),
    ("near_dedup", distinct_documents),
    ("decontamination", clean_documents),
    ("mixing", mixed_documents),
    ("token_ids", packed_tokens),
]

ORACLE_SQL = None  # learned scores, hashes and token ids: compared with brute force in the tests


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last result is read from its Parquet table.

    The table of a stage is deleted when the next one is written."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = f"{folder}/{name}"
    return docs
