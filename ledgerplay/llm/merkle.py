"""Merkle dataset manifest: subtree exchange by superblock, proofs and their check.

Every row is a leaf, the SHA-256 of its fields, hashed where the row is read (texts
never move).  The leaves of a tree (a source) stand in order of their id; every 16
consecutive nodes become their hash until one is left (``FAN``), and the roots of
all trees, in order of the tree's name, are reduced likewise to the root.

A *superblock* holds the leaves below one node three levels up (4,096 leaves).  Up:
each round reduces superblocks to their top nodes, so a tree of any size, and a
corpus of any number of trees, needs log4096 rounds and no task sees more than one
superblock at once.  Down: each round cogroups the nodes of a superblock with the
siblings outside it on the way to the root (its *outer path*); the last one
cogroups the leaves and finishes local reduction, proof and folding together.

Places in a tree come from a range partitioning on (tree, id): the place in the
partition plus the offset of the partition, so one tree may span all tasks.

Defined results: a null field is ``-``; rows without id stand before all others of
their tree; rows with the same id stand in order of their leaf; a null tree name is
a tree of its own and stands first.  Repeated rows are leaves of their own.  An empty
table has no root and gives an empty result.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerplay.llm.common import workers_import_package
from ledgerplay.session import checkpoint_dir

FAN = 16
LEVELS = 3  # levels inside a superblock
BLOCK = FAN ** LEVELS
BROADCAST_OFFSETS = 200_000
HEX = 64  # characters of a digest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH_SCHEMA = "tree string, pos long, befores array<string>, afters array<string>"
PROOF_SCHEMA = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf_digest(fields: list[Column]) -> Column:
    """Hex SHA-256 of the fields, each ``-`` or byte count, colon, value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


class _Folder:
    """Tables of one run in the shared folder."""

    def __init__(self, spark):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/merkle-{uuid.uuid4().hex}"
        self.n = 0

    def store(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.path}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def place(rows: DataFrame, order: list[str], folder: _Folder) -> DataFrame:
    """``rows`` (tree, ...) with ``pos``, the place in their tree from 0, and ``n``, the tree's size."""
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = folder.store(ranged.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    parts = ranged.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n_part"))
    earlier = Window.partitionBy("tree").orderBy("part")  # per tree at most one row per partition
    before = F.coalesce(F.sum("n_part").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = folder.store(parts.select("tree", "part", F.sum("n_part").over(Window.partitionBy("tree")).alias("n"), (before - F.col("first")).alias("shift")))
    if offsets.count() <= BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)
    return ranged.join(offsets, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def local_levels(digests: list[str], n: int) -> list[str]:
    """Levels of a superblock as joined digests: up to the tree's root if the tree
    (of ``n`` nodes) is this superblock, else three levels up."""
    levels = ["".join(digests)]
    while len(levels[-1]) > HEX if n <= BLOCK else len(levels) <= LEVELS:
        low = levels[-1]
        levels.append("".join(_h(low[i:i + FAN * HEX]) for i in range(0, len(low), FAN * HEX)))
    return levels


def local_path(levels: list[str], i: int) -> tuple[list[str], list[str]]:
    """Siblings left and right of node ``i`` and of its ancestors inside the superblock."""
    befores, afters = [], []
    for level in levels[:-1]:
        run, at = i // FAN * FAN * HEX, i * HEX
        befores.append(level[run:at])
        afters.append(level[at + HEX:run + FAN * HEX])
        i //= FAN
    return befores, afters


def fold(digest: str, befores: list[str], afters: list[str]) -> str:
    for before, after in zip(befores, afters):
        digest = _h(before + digest + after)
    return digest


def _reduce(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("pos")
    n, pos = int(pdf["n"].iloc[0]), int(pdf["pos"].iloc[0])
    top = local_levels(pdf["digest"].tolist(), n)[-1]
    return pd.DataFrame({"tree": [pdf["tree"].iloc[0]], "pos": [pos // BLOCK], "n": [-(-n // BLOCK)], "digest": [top]})


def _block() -> Column:
    return F.expr(f"pos div {BLOCK}").alias("block")


def climb(nodes: DataFrame, folder: _Folder) -> list[DataFrame]:
    """``nodes`` (tree, pos, n, digest) and the tops of their superblocks, round by
    round, up to one node per tree."""
    rounds = [nodes]
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        tops = rounds[-1].select("tree", "pos", "n", "digest").groupBy("tree", _block()).applyInPandas(_reduce, "tree string, pos long, n long, digest string")
        rounds.append(folder.store(tops))
        largest = -(-largest // BLOCK)
    return rounds


def _paths(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("pos")
    levels = local_levels(nodes["digest"].tolist(), int(nodes["n"].iloc[0]))
    above = list(outer["befores"].iloc[0]), list(outer["afters"].iloc[0])
    found = [local_path(levels, i) for i in range(len(nodes))]
    return pd.DataFrame({"tree": nodes["tree"].to_numpy(), "pos": nodes["pos"].to_numpy(), "befores": [b + above[0] for b, _ in found], "afters": [a + above[1] for _, a in found]})


def descend(rounds: list[DataFrame], outer: DataFrame, folder: _Folder) -> DataFrame:
    """Outer paths (tree, pos, befores, afters) of the nodes of ``rounds[0]``, from the
    paths of the last round's nodes."""
    for nodes in reversed(rounds[:-1]):
        left = nodes.select("tree", "pos", "n", "digest").groupBy("tree", _block())
        outer = folder.store(left.cogroup(outer.groupBy("tree", F.col("pos").alias("block"))).applyInPandas(_paths, PATH_SCHEMA))
    return outer


def _finish(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    leaves = leaves.sort_values("pos")
    digests = leaves["digest"].tolist()
    levels = local_levels(digests, int(leaves["n"].iloc[0]))
    befores, afters = list(outer["befores"].iloc[0]), list(outer["afters"].iloc[0])
    above = "".join(b + a for b, a in zip(befores, afters))
    subroot, root = outer["subroot"].iloc[0], outer["root"].iloc[0]
    proofs, folded = [], []
    for i, (digest, tampered) in enumerate(zip(digests, leaves["tampered"])):
        before, after = local_path(levels, i)
        proofs.append(_h("".join(b + a for b, a in zip(before, after)) + above))
        folded.append(fold(fold(tampered or digest, before, after), befores, afters))
    return pd.DataFrame({"id": leaves["id"].to_numpy(), "leaf": digests, "subroot": subroot, "root": root, "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})


def prove(docs: DataFrame, tampered_text: Column | None = None, is_tampered: Column | None = None, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", tree_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: leaf, roots, digest of its proof, and the root
    folded from that proof for the row as found: with ``tampered_text`` in place of the
    text where ``is_tampered`` holds (a stand-in for a changed copy), else the row itself."""
    workers_import_package(docs.sparkSession)
    folder = _Folder(docs.sparkSession)
    tampered = F.lit(None).cast("string")
    if tampered_text is not None:
        tampered = F.when(is_tampered, leaf_digest([tampered_text if f == text_col else F.col(f) for f in fields]))
    leaves = docs.select(F.coalesce(F.concat(F.lit("s"), F.col(tree_col)), F.lit("-")).alias("tree"), F.col(id_col).cast("long").alias("doc_id"),
                         leaf_digest([F.col(f) for f in fields]).alias("digest"), tampered.alias("tampered"))
    leaves = place(folder.store(leaves), ["doc_id", "digest"], folder)  # stored first: cutting the ranges reads the digests, not the texts again
    rounds = climb(leaves, folder)
    subroots = rounds[-1].select("tree", F.col("digest").alias("subroot"))
    # the subroots are the nodes of one more tree, in order of the trees' names
    tops = place(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest")), ["name"], folder)
    tops = folder.store(tops)
    top_rounds = climb(tops, folder)
    root = top_rounds[-1].select("digest").first()
    none = F.array().cast("array<string>")
    paths = descend(top_rounds, top_rounds[-1].select("tree", "pos", none.alias("befores"), none.alias("afters")), folder)
    outer = tops.join(paths, ["tree", "pos"]).select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "befores", "afters")
    if len(rounds) > 1:  # paths of the tops of the leaves' superblocks
        outer = descend(rounds[1:], outer, folder)
    outer = outer.join(subroots, "tree").withColumn("root", F.lit(root and root[0]).cast("string"))
    rows = leaves.select("tree", "pos", "n", F.col("doc_id").cast("string").alias("id"), "digest", "tampered")
    proved = rows.groupBy("tree", _block()).cogroup(outer.groupBy("tree", F.col("pos").alias("block"))).applyInPandas(_finish, PROOF_SCHEMA)
    return proved.select(F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
