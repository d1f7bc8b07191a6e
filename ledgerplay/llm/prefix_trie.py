"""Conversation prefix trie: balanced parentheses per shard, shared spines merged.

A conversation is the sequence of its turns (role, text); a node of the trie is a
distinct sequence of first turns.  Texts become 128-bit digests where they are read
and are not moved.  The steps:

1. Conversations with the same sequence become one path with its number, its smallest
   id and the digest of its ids, so a group of copies of any size is one row.
2. Paths are range-partitioned in order into shards; a subtree is a run of paths, so a
   popular first turn spans many shards.
3. Each shard writes its trie as balanced parentheses.  A node's subtree ends at
   ``findclose`` of its opening parenthesis, found for all nodes at once in a pyramid
   of block minima of the excess (range min-max blocks).  Ranks of leaf pairs ``()``
   and cumulative arrays at both ends give leaves, members, children and savings.
4. Nodes that two shards share lie on the first or last path of a shard (a spine).
   Their sums are merged; every other node is final.  The border of two shards says
   which shard counts a shared node itself and which path end is no leaf.

A node's ids are hashed in ascending order, which is sequential by definition: ids are
sorted in range partitions, joined to chunks there, and one task streams the chunks
of a node, holding one at a time.

Defined results: a null role or text is empty; turns are ordered by turn, null first,
and rows of one turn by their digest, so repeated rows are repeated turns.  Rows without
conv_id belong to no conversation.  An empty table has no nodes.  Further columns are not read.  One
conversation's digests (20 bytes a turn) are held in one row.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerplay.llm.common import shuffle_partitions, workers_import_package
from ledgerplay.session import checkpoint_dir

HEAD_EVERY = 100  # conversations of one hundred share the head of their first one
MAX_HEAD = 6
SHARD_TURNS = 250_000  # turns of a shard: bounds a task's memory, not the input
CHUNK_IDS = 50_000
BROADCAST_ROWS = 200_000
DIGEST = 16

NODE_SCHEMA = ("spine boolean, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
               "weight long, once long, ends_sha256 string")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _turn_digest():
    """128 bits of (role, text); the length in front of the role separates the two."""
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)), 1, DIGEST)


def conversation_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, points): digests and code points of the turns of each conversation in order."""
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("conv_id", F.struct(F.col("turn").isNotNull().alias("known"), "turn", _turn_digest().alias("digest"), F.length("text").alias("points")).alias("t"))
    sorted_turns = F.array_sort(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(sorted_turns.alias("ts")).select("conv_id", F.col("ts.digest").alias("path"), F.col("ts.points").alias("points"))


def with_shared_heads(turns: DataFrame) -> DataFrame:
    """Paths in which conversation c begins with the first h turns of conversation
    c - c % 100, h = crc32(c) % 6, in place of its own first h turns."""
    paths = conversation_paths(turns)
    heads = paths.where(F.col("conv_id") % HEAD_EVERY == 0).select(F.col("conv_id").alias("head"), F.slice("path", 1, MAX_HEAD - 1).alias("head_path"), F.slice("points", 1, MAX_HEAD - 1).alias("head_points"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(MAX_HEAD)).cast("int")
    own = paths.withColumns({"head": F.col("conv_id") - F.col("conv_id") % HEAD_EVERY, "h": h}).join(heads, "head", "left")

    def joined(own_col: str, head_col: str):
        return F.concat(F.coalesce(F.slice(head_col, F.lit(1), F.col("h")), F.slice(own_col, 1, 0)), F.slice(own_col, F.col("h") + 1, F.greatest(F.size(own_col), F.lit(1))))
    return own.select("conv_id", joined("path", "head_path").alias("path"), joined("points", "head_points").alias("points"))


def _path_digest():
    return F.substring(F.unhex(F.sha2(F.coalesce(F.array_join(F.transform("path", F.hex), ""), F.lit("")), 256)), 1, DIGEST)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) -> (key, first id, ids of a run of one key as text)."""
    for batch in batches:
        keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out_key, out_first, out_text, i = [], [], [], 0
        while i < len(keys):
            j = i + 1
            while j < len(keys) and keys[j] == keys[i] and j - i < CHUNK_IDS:
                j += 1
            out_key.append(keys[i])
            out_first.append(ids[i])
            out_text.append(",".join(map(str, ids[i:j])))
            i = j
        yield pa.RecordBatch.from_arrays([pa.array(out_key, pa.binary()), pa.array(out_first, pa.int64()), pa.array(out_text, pa.string())], names=["key", "first", "ids"])


def _stream_sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by (key, first id) -> (key, SHA-256 of the joined ids)."""
    key, state = None, None
    for batch in batches:
        out = []
        for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if k != key:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string())], names=["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends_sha256"])


def id_digests(members: DataFrame) -> DataFrame:
    """(key, conv_id) -> (key, ends_sha256): SHA-256 of the ascending ids, comma-joined."""
    sorted_ids = members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = sorted_ids.mapInArrow(_chunks, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_stream_sha256, "key binary, ends_sha256 string")


def distinct_paths(convs: DataFrame) -> DataFrame:
    """(path, points, n_ends, conv_id, ends_sha256): one row per distinct sequence."""
    convs = convs.withColumn("key", _path_digest())
    same = convs.groupBy("key").agg(F.first("path").alias("path"), F.first("points").alias("points"), F.count("*").alias("n_ends"), F.min("conv_id").alias("conv_id"))
    return same.join(id_digests(convs), "key").drop("key")


# --- balanced parentheses ---------------------------------------------------

def parentheses(sizes: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Parentheses (+1 opens, -1 closes) of a trie of sorted paths: ``sizes`` nodes on
    each path without the root, ``shared`` of them common with the path before."""
    closes = np.append(np.append(0, sizes[:-1] - shared[1:]), sizes[-1] + 1)  # after the last path: its nodes and the root
    opens = np.append(sizes - shared, 0)
    opens[0] += 1  # the root
    return np.repeat(np.tile([-1, 1], len(opens)).astype(np.int8), np.column_stack([closes, opens]).ravel())


def find_close(bits: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Place of the closing parenthesis of every opening one: the first later place
    whose excess is below the one at the opening, by minima over blocks of 2^k places."""
    excess = np.cumsum(bits, dtype=np.int64)
    minima = [excess]
    while len(minima[-1]) > 1:
        low = minima[-1]
        if len(low) & 1:
            low = np.append(low, np.iinfo(np.int64).max)
        minima.append(np.minimum(low[0::2], low[1::2]))
    want, at = excess[opens], opens + 1
    height = np.full(len(opens), -1)  # level at which a block with a smaller excess is found
    for k, low in enumerate(minima):
        open_now = height < 0
        hit = open_now & (at < len(low))
        hit[hit] = low[at[hit]] < want[hit]
        height[hit] = k
        miss = open_now & ~hit
        at[miss] = (at[miss] + 1) >> 1  # the parent of an even block holds its sibling as well; behind an odd one the next parent begins
    for k in range(len(minima) - 1, 0, -1):
        down = height == k
        if down.any():
            left = at[down] * 2
            at[down] = left + (minima[k - 1][left] >= want[down])
            height[down] = k - 1
    return at


def _shared_lengths(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each path the number of first turns it shares with the path before it."""
    sizes = np.diff(offsets)
    limit = np.append(0, np.minimum(sizes[1:], sizes[:-1]))
    row = np.repeat(np.arange(len(sizes)), limit)
    step = np.arange(len(row)) - np.repeat(np.cumsum(limit) - limit, limit)
    differ = np.any(values[offsets[row] + step] != values[offsets[row - 1] + step], axis=1)
    shared = limit.copy()
    np.minimum.at(shared, row[differ], step[differ])
    return shared


def _spine_keys(path: np.ndarray) -> list[bytes]:
    """Digests of the first 0, 1, 2 ... turns of a path, each from the one before."""
    keys = [b"\0" * DIGEST]
    for turn in path:
        keys.append(hashlib.sha256(keys[-1] + turn.tobytes()).digest()[:DIGEST])
    return keys


def shard_nodes(path: pa.ListArray, points: pa.ListArray, n_ends: np.ndarray, conv_id: np.ndarray, ends: list[str], left: int, right: int) -> pa.RecordBatch:
    """Node rows of one shard.  ``left`` first turns of its first path are in the shard
    before, ``right`` first turns of its last path in the next one (-1: there is none)."""
    offsets = path.offsets.to_numpy().astype(np.int64)
    values = np.frombuffer(b"".join(path.flatten().to_pylist()), dtype=np.uint64).reshape(-1, DIGEST // 8)
    lens = points.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    sizes, shared = np.diff(offsets), _shared_lengths(values, offsets)
    bits = parentheses(sizes, shared)
    opens = np.flatnonzero(bits == 1)
    closes = find_close(bits, opens)
    depth = np.cumsum(bits, dtype=np.int64)[opens] - 1
    n = len(opens)
    # nodes are numbered in opening order, the root is 0; a path opens the nodes after those it shares
    opened = sizes - shared
    owner = np.repeat(np.arange(len(sizes)), opened)  # the path that opens a node (without the root)
    length = np.append(0, lens[offsets[owner] + depth[1:] - 1])
    end_node = np.cumsum(opened)  # sorted different paths end in the node they open last, the turnless one in the root
    ends_at = np.zeros(n, dtype=np.int64)
    ends_at[end_node] = n_ends
    last = np.cumsum(bits == 1)[closes]  # rank of opening parentheses: the subtree of node i is [i, last[i])
    number = np.arange(n)

    def subtree_sum(x: np.ndarray) -> np.ndarray:
        c = np.append(0, np.cumsum(x, dtype=np.int64))
        return c[last] - c[number]

    n_convs = subtree_sum(ends_at)
    least = _range_min(conv_id, np.searchsorted(end_node, number), np.searchsorted(end_node, last))
    parent = _parents(depth)
    on_left = number <= left  # the shard before has these too, and counts them
    pair = np.append((bits[:-1] == 1) & (bits[1:] == -1), False)[opens]
    if right == sizes[-1]:
        pair[end_node[-1]] = False  # the next shard goes on below the last path
    children = np.bincount(parent[1:][~on_left[1:]], minlength=n)
    on_right = _ancestors(parent, end_node[-1])[:right + 1]
    spine = on_left.copy()
    spine[on_right] = True
    keys: list[bytes | None] = [None] * n
    for nodes, row in ((number[:left + 1], 0), (on_right, len(sizes) - 1)):
        for i, key in zip(nodes, _spine_keys(values[offsets[row]:offsets[row] + max(0, len(nodes) - 1)])):
            keys[i] = key
    ends_text = np.full(n, EMPTY_SHA256, dtype=object)
    ends_text[end_node] = ends
    below_spine = np.append(False, spine[parent[1:]])
    known = np.append(False, ~spine[parent[1:]])
    columns = [pa.array(spine), pa.array(keys, pa.binary()), pa.array([keys[p] if b else None for p, b in zip(parent, below_spine)], pa.binary()),
               pa.array(least), pa.array(depth), pa.array(least[parent], pa.int64(), mask=~known), pa.array(n_convs), pa.array(children), pa.array(subtree_sum(pair)),
               pa.array(subtree_sum(n_convs * length)), pa.array(subtree_sum(np.where(on_left, 0, length))), pa.array(ends_text.tolist(), pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in NODE_SCHEMA.split(", ")])


def _range_min(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least of values[start:end] for every (non-empty) range, from minima over 2^k values."""
    tables = [values]
    while 2 << (len(tables) - 1) <= len(values):
        low, half = tables[-1], 1 << (len(tables) - 1)
        tables.append(np.minimum(low[:-half], low[half:]))
    out = np.empty(len(start), dtype=np.int64)
    level = np.floor(np.log2(np.maximum(1, end - start))).astype(int)
    for k, low in enumerate(tables):
        m = level == k
        out[m] = np.minimum(low[start[m]], low[end[m] - (1 << k)])
    return out


def _parents(depth: np.ndarray) -> np.ndarray:
    """Number of the last earlier node one level up (nodes in opening order)."""
    order = np.lexsort((np.arange(len(depth)), depth))
    by_depth, bounds = order, np.searchsorted(depth[order], np.arange(depth.max() + 2))
    parent = np.full(len(depth), -1)
    for d in range(1, depth.max() + 1):
        here, above = by_depth[bounds[d]:bounds[d + 1]], by_depth[bounds[d - 1]:bounds[d]]
        parent[here] = above[np.searchsorted(above, here) - 1]
    return parent


def _ancestors(parent: np.ndarray, node: int) -> np.ndarray:
    """The node's ancestors from the root, and itself."""
    out = []
    while node >= 0:
        out.append(node)
        node = parent[node]
    return np.array(out[::-1])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held).combine_chunks()
    shard = t.column("shard").to_numpy()
    cuts = np.append(np.flatnonzero(np.diff(shard, prepend=shard[0] - 1)), len(shard))
    for i, j in zip(cuts[:-1], cuts[1:]):
        s = t.slice(i, j - i).combine_chunks()
        col = lambda c: s.column(c).chunk(0)
        out = shard_nodes(col("path"), col("points"), col("n_ends").to_numpy(), col("conv_id").to_numpy(), col("ends_sha256").to_pylist(), s.column("left")[0].as_py(), s.column("right")[0].as_py())
        for a in range(0, out.num_rows, 20_000):
            yield out.slice(a, 20_000)


def _common_turns(a: str, b: str):
    """Number of first turns that two different paths share (-1 where one is null)."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(F.col(a).isNull() | F.col(b).isNull(), F.lit(-1)).otherwise(differs - 1).cast("int")


def trie_nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per trie node of ``convs`` (conv_id, path, points): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = convs.sparkSession
    workers_import_package(spark)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/prefix-trie-{uuid.uuid4().hex}"

    def store(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    paths = store(distinct_paths(store(convs, "convs")), "paths")
    turns = paths.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    n_shards = max(shuffle_partitions(convs) if turns > shard_turns else 1, -(-turns // shard_turns))
    shards = paths.repartitionByRange(n_shards, "path").sortWithinPartitions("path").withColumn("shard", F.spark_partition_id()).checkpoint(eager=True)
    borders = shards.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))  # at most one row per shard
    row = Window.orderBy("shard")
    borders = borders.select("shard", "low", "high", F.lag("high").over(row).alias("before"), F.lead("low").over(row).alias("after"))
    borders = borders.select("shard", _common_turns("before", "low").alias("left"), _common_turns("high", "after").alias("right"))
    nodes = store(shards.join(F.broadcast(borders), "shard").mapInArrow(_shards, NODE_SCHEMA), "nodes")
    spine = nodes.where("spine").groupBy("node").agg(*(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "weight", "once")), F.min("conv_id").alias("conv_id"),
                                                   F.max("depth").alias("depth"), F.max("parent").alias("parent"),
                                                   F.coalesce(F.max(F.when(F.col("ends_sha256") != EMPTY_SHA256, F.col("ends_sha256"))), F.lit(EMPTY_SHA256)).alias("ends_sha256"))
    spine = store(spine, "spine")
    small = spine.count() <= BROADCAST_ROWS
    shared = spine.select(F.col("node").alias("parent"), F.col("conv_id").alias("spine_conv"))
    every = nodes.where("NOT spine").drop("spine", "node").unionByName(spine.drop("node").withColumn("parent_conv_id", F.lit(None).cast("long")))
    out = every.join(F.broadcast(shared) if small else shared, "parent", "left")
    return out.select("conv_id", "depth", F.coalesce("parent_conv_id", "spine_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      (F.col("weight") - F.col("once")).alias("saved_tokens"), "ends_sha256")
