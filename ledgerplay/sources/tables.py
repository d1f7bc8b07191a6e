"""Parquet / CSV scans and sinks.

Scans always name their columns so that the Parquet reader prunes; filters are
left to Catalyst, which pushes them into the scan.
"""

from __future__ import annotations

import math
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table_path(d: str, name: str) -> str:
    return os.path.join(d, f"{name}.parquet")


def read_table(spark: SparkSession, d: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """S1 on the test layout: ``<dir>/<name>.parquet``."""
    return read_parquet(spark, table_path(d, name), columns)


def read_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan restricted to ``columns``."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def _list_files(spark: SparkSession, pattern: str) -> list[str]:
    """File listing through Hadoop's FileSystem (metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stats = fs.globStatus(hpath) or []
    return sorted(str(s.getPath().toString()) for s in stats if s.isFile())


def read_parquet_fraction(spark: SparkSession, path: str, frac: float = 1.0, pattern: str = "*.parquet",
                          columns: Sequence[str] | None = None) -> DataFrame:
    """The first ceil(frac*n) files (by name) of a one-level listing.

    A plain file when the listing is empty.  ``**`` is refused, as in the
    original helper.
    """
    if not 0 < frac <= 1:
        raise ValueError("frac must be in (0, 1]")
    if "**" in pattern or "**" in path:
        raise ValueError("recursive patterns are not supported")
    files = _list_files(spark, os.path.join(path, pattern))
    if not files:
        return read_parquet(spark, path, columns)
    k = math.ceil(frac * len(files))
    return read_parquet(spark, files[:k], columns)


def read_csv_glob(spark: SparkSession, directory: str, name_filter: str, schema: StructType | str,
                  header: bool = True, match: str = "file") -> DataFrame:
    """S3: all CSV files whose name matches a glob (e.g. ``*town*``), with lineage.

    ``match="file"`` filters file names inside ``directory`` (listing only);
    ``match="path"`` globs the path below ``directory`` (e.g. partition folders).
    """
    reader = spark.read.schema(schema).option("header", header)
    if match == "file":
        df = reader.option("pathGlobFilter", name_filter).csv(directory)
    else:
        df = reader.csv(os.path.join(directory, name_filter))
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """One CSV with a declared schema (never inferred)."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_by_feature_list(df: DataFrame, feature_list: DataFrame, name_col: str = "feature") -> DataFrame:
    """Project a table onto a column list that is itself a (small) table.

    The list defines columns, so it is collected; its size is checked.
    """
    names = [r[0] for r in feature_list.select(name_col).limit(100_001).collect()]
    if len(names) > 100_000:
        raise ValueError("feature list too long to define a projection")
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not in table: {missing}")
    return df.select(*names)


def load_round(spark: SparkSession, path: str, round_id: int, columns: Sequence[str] | None = None) -> DataFrame:
    """One round of a table partitioned by ``round_id`` (partition pruning)."""
    df = spark.read.parquet(path).where(F.col("round_id") == round_id)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    """Parquet or CSV sink, optionally partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def export_selection(df: DataFrame, path: str, id_col: str = "loan_id", key_cols: Sequence[str] = ("discount",)) -> None:
    """Ids of the chosen loans per key (e.g. discount), partitioned by it."""
    write_table(df.select(id_col, *key_cols), path, partition_by=list(key_cols))
