"""Removal of repeated passages with recurring-phrase automata.

A window is ``width`` consecutive words.  Every word is removed that lies in a
window whose word sequence also starts in a document with a smaller id.

1. Phrases.  Every document is winnowed: of each run of consecutive
   ``phrase``-word hashes that fills one window, the smallest is a fingerprint.
   Two equal windows choose the same phrase at the same place, so a phrase that
   recurs is in every recurring window.  Exact copies of a whole word sequence
   are settled by their digest and only their first document goes on.
2. Patterns.  The words of every recurring phrase are read from the first document
   that holds it.  Documents without a recurring phrase can lose nothing and are not
   moved; the others are dealt into shards of about ``shard_bytes`` of text.
3. Automata.  Each shard compiles the patterns of the recurring phrases of its
   documents into an Aho-Corasick automaton (pyahocorasick, over word numbers) and
   streams its documents through it; every occurrence of a phrase, at any place, names
   the windows around it.  Nothing else locates passages.
4. Passages.  Those windows are confirmed by 128-bit digests: the first document of
   each digest keeps it, all others lose the words it covers.

Counting first documents is a partial aggregation.  Digests with more than
1/``HOT_SHARE`` of all windows (fewer than ``HOT_SHARE`` of them, whatever the input)
are broadcast to the windows, the others meet them in a shuffle join, so a passage that
a third of all documents hold is neither gathered in one task nor paired.  Tables that
are read twice are Parquet files in the shared folder.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerplay.llm.common import (
    id_text, mix64, odd_constants, packed_texts, release_buffers, rolling, set_digest, shuffle_partitions, signed, to_signed, unpack_text, word_hashes, words_by_row,
)
from ledgerplay.session import checkpoint_dir

WIDTH = 50
PHRASE = 10
SHARD_BYTES = 4 << 20
ROW_GROUP = 16 << 20  # bytes a task holds while it writes a file
MARK_BYTES = 1 << 18  # text hashed at once: its arrays take some 40 times that, and workers keep about as much when idle
HOT_SHARE = 2000
CUT_ROWS = 256  # documents whose texts a task holds unpacked
BROADCAST_ROWS = 1_000_000  # counted ids (16 bytes each) that are broadcast to the text scan; beyond, texts move without that filter
_LANES = [int(x) for x in odd_constants(2, 9_001)]


def winnow(grams: np.ndarray, run: int) -> np.ndarray:
    """Positions of the (rightmost) minima of every ``run`` consecutive hashes."""
    n = len(grams) - run + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, run)
    found = []
    for a in range(0, n, 1 << 14):
        part = view[a:a + (1 << 14)]
        found.append(np.unique(a + np.arange(len(part)) + run - 1 - part[:, ::-1].argmin(axis=1)))
    return np.unique(np.concatenate(found))


def window_digests(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every window."""
    return rolling(words, width, _LANES[0]), rolling(mix64(words), width, _LANES[1])


def _sequence_digest(words: np.ndarray) -> tuple[int, int]:
    """128-bit digest of a whole word sequence."""
    with np.errstate(over="ignore"):
        place = mix64(np.arange(1, len(words) + 1, dtype=np.uint64)) * np.uint64(2) + np.uint64(1)
        x = words * place
    return to_signed(set_digest(x, 0) ^ len(words)), to_signed(set_digest(x, 1))


def joined_sha256(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> str:
    """SHA-256 of the words [start, end) of ``raw`` joined by one space."""
    if not len(starts):
        return hashlib.sha256(b"").hexdigest()
    return hashlib.sha256(b" ".join(raw[a:b] for a, b in zip(starts.tolist(), ends.tolist()))).hexdigest()


def _marks(width: int, phrase: int):
    def run(batches):
        for batch in batches:
            for i, j, h, s, e, bound, buf in words_by_row(batch.column(1), limit=MARK_BYTES):
                raw = buf.tobytes()
                cols: list[list] = [[], [], [], [], []]
                for a, b in zip(bound[:-1], bound[1:]):
                    w = h[a:b]
                    d1, d2 = _sequence_digest(w)
                    grams = rolling(w, phrase)
                    cols[0].append(int(b - a))
                    cols[1].append(d1)
                    cols[2].append(d2)
                    cols[3].append(signed(np.unique(grams[winnow(grams, width - phrase + 1)])))
                    cols[4].append(joined_sha256(raw, s[a:b], e[a:b]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.string())],
                    names=["doc_id", "th", "n_words", "d1", "d2", "phrases", "sha"])
        release_buffers()
    return run


def _automaton(patterns: list[tuple[int, ...]]):
    import ahocorasick

    a = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for p in patterns:
        a.add_word(p)
    a.make_automaton()
    return a


def _patterns(phrase: int):
    """(compressed text, phrases it is first for) -> (phrase, its words)."""
    def run(batches):
        for batch in (b.slice(i, CUT_ROWS) for b in batches for i in range(0, b.num_rows, CUT_ROWS)):
            found, words = [], []
            for packed, wanted in zip(batch.column(0).to_pylist(), batch.column(1)):
                w, _, _ = word_hashes(np.frombuffer(unpack_text(packed), dtype=np.uint8), np.zeros(1, np.int64))
                grams = rolling(w, phrase)
                want, order = np.unique(np.asarray(wanted.values, dtype=np.int64).view(np.uint64)), np.argsort(grams, kind="stable")
                at = order[np.searchsorted(grams, want, sorter=order)]
                found.append(signed(want))
                words += [signed(w[k:k + phrase]) for k in at.tolist()]
            if words:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(words, pa.list_(pa.int64()))], names=["phrase", "words"])
        release_buffers()
    return run


def _locate(width: int, phrase: int):
    """(documents of a shard, words of their recurring phrases) -> windows around every occurrence."""
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"doc_id": [], "th": [], "z": [], "starts": [], "w1": [], "w2": []}
        if len(right):
            patterns = [np.asarray(p, dtype=np.int64).view(np.uint64) for p in right["words"]]
            vocabulary = np.unique(np.concatenate(patterns))
            number = lambda w: np.where(vocabulary[(k := np.minimum(np.searchsorted(vocabulary, w), len(vocabulary) - 1))] == w, k + 1, 0)
            automaton = _automaton([tuple(number(p).tolist()) for p in patterns])
            for doc_id, th, packed in zip(left["doc_id"], left["th"], left["z"]):
                w, _, _ = word_hashes(np.frombuffer(unpack_text(packed), dtype=np.uint8), np.zeros(1, np.int64))
                if len(w) < width:
                    continue
                ends = np.array([x[0] for x in automaton.iter(tuple(number(w).tolist()))], dtype=np.int64)
                if not len(ends):
                    continue
                edge = np.zeros(len(w) + 1, dtype=np.int64)  # windows that hold the phrase [end - phrase + 1, end]
                np.add.at(edge, np.maximum(ends - width + 1, 0), 1)
                np.add.at(edge, np.minimum(ends - phrase + 2, len(w)), -1)
                starts = np.flatnonzero(np.cumsum(edge)[:len(w) - width + 1] > 0)
                d1, d2 = window_digests(w, width)
                out["doc_id"].append(doc_id)
                out["th"].append(th)
                out["z"].append(packed)
                out["starts"].append(starts.astype(np.int32))
                out["w1"].append(signed(d1[starts]))
                out["w2"].append(signed(d2[starts]))
        release_buffers()
        return pd.DataFrame(out)
    return run


def _cut(width: int):
    def run(batches):
        for batch in (b.slice(i, CUT_ROWS) for b in batches for i in range(0, b.num_rows, CUT_ROWS)):
            cols: list[list] = [[], [], []]
            for packed, hit in zip(batch.column(2).to_pylist(), batch.column(3)):
                raw = unpack_text(packed)
                w, s, e = word_hashes(np.frombuffer(raw, dtype=np.uint8), np.zeros(1, np.int64))
                edge = np.zeros(len(w) + 1, dtype=np.int64)
                at = np.asarray(hit.values, dtype=np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + width, -1)
                keep = np.cumsum(edge)[:len(w)] == 0
                cols[0].append(int(len(w) - keep.sum()))
                cols[1].append(joined_sha256(raw, s[keep], e[keep]))
                cols[2].append(b" ".join(raw[a:b] for a, b in zip(s[keep].tolist(), e[keep].tolist())).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                                             names=["doc_id", "th", "n_removed", "sha", "kept_text"])
        release_buffers()
    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, phrase: int = PHRASE, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept_text.

    ``kept_text`` is the words left, joined by one space, where words were
    removed, and null where none were (the text stays as it is).  Windows are
    judged on the input.  Texts with fewer than ``width`` words (also null and
    empty ones) lose nothing.  Rows with a null id are compared with nothing and
    stay whole.  Repeated rows of one id are the same document: none is smaller,
    so they stay unless a smaller id holds their windows.  An empty table gives
    an empty table.
    """
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/substring-dedup-{uuid.uuid4().hex}"

    def store(df: DataFrame, name: str) -> DataFrame:
        df.write.option("parquet.block.size", ROW_GROUP).parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    base = id_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    marks = store(base.mapInArrow(_marks(width, phrase), "doc_id long, th long, n_words long, d1 long, d2 long, phrases array<long>, sha string"), "marks")
    long_ = marks.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= width))
    first = long_.groupBy("d1", "d2").agg(F.min("doc_id").alias("first_id"))
    known = long_.select("doc_id", "th", "d1", "d2", "phrases").join(first, ["d1", "d2"])
    alone = known.where("doc_id = first_id").select("doc_id", "th", "phrases").dropDuplicates(["doc_id", "th"])
    each = alone.select("doc_id", "th", F.explode("phrases").alias("phrase"))
    # the first document of each recurring phrase, by (id, text)
    recurring = each.groupBy("phrase").agg(F.min(F.struct("doc_id", "th")).alias("o"), F.max("doc_id").alias("b")).where("o.doc_id < b").select("phrase", "o.doc_id", "o.th")
    recurring = store(recurring, "recurring")
    shards = max(shuffle_partitions(docs), 1 + int((base.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0) // shard_bytes))
    shard = F.pmod(F.xxhash64("doc_id", "th"), F.lit(shards)).alias("shard")
    held = store(each.join(recurring.select("phrase"), "phrase").select("doc_id", "th", "phrase", shard), "held")
    holders = held.select("doc_id", "th").distinct()
    texts = base.where(F.col("doc_id").isNotNull())
    if holders.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(holders), ["doc_id", "th"], "left_semi")
    owners = recurring.groupBy("doc_id", "th").agg(F.collect_list("phrase").alias("phrases"))  # at most a document's own phrases
    if recurring.count() <= BROADCAST_ROWS:
        owners = F.broadcast(owners)
    patterns = packed_texts(texts).join(owners, ["doc_id", "th"]).select("z", "phrases").mapInArrow(_patterns(phrase), "phrase long, words array<long>").dropDuplicates(["phrase"])
    needed = held.select("shard", "phrase").distinct().join(patterns, "phrase")  # a phrase at most once per shard
    left = packed_texts(texts).withColumn("shard", shard)
    if _repeats(marks):
        left = left.dropDuplicates(["doc_id", "th"])
    found = left.groupBy("shard").cogroup(needed.select("shard", "words").groupBy("shard")).applyInPandas(
        _locate(width, phrase), "doc_id long, th long, z binary, starts array<int>, w1 array<long>, w2 array<long>")
    found = store(found, "found")
    windows = found.select("doc_id", "th", F.explode(F.arrays_zip("starts", "w1", "w2")).alias("x")).select("doc_id", "th", "x.starts", "x.w1", "x.w2")
    owner = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("own"), F.max("doc_id").alias("other"), F.count("*").alias("c")).where("own < other").select("w1", "w2", "own", "c")
    owner = store(owner, "owner")
    many = (found.agg(F.sum(F.size("starts"))).first()[0] or 0) // HOT_SHARE
    hot, rest = F.broadcast(owner.where(F.col("c") > many)), owner.where(F.col("c") <= many)
    hits = windows.join(hot, ["w1", "w2"]).unionByName(windows.join(hot, ["w1", "w2"], "left_anti").join(rest, ["w1", "w2"]))
    hits = hits.where("doc_id > own").groupBy("doc_id", "th").agg(F.collect_list("starts").alias("hit"))  # windows of one document
    cut = found.select("doc_id", "th", "z").join(hits, ["doc_id", "th"]).select("doc_id", "th", "z", "hit") \
        .mapInArrow(_cut(width), "doc_id long, th long, n_removed long, sha string, kept_text string")
    copies = known.where("doc_id > first_id").select("doc_id", "th", F.lit(True).alias("copy")).dropDuplicates(["doc_id", "th"])
    out = (marks.select("doc_id", "th", "n_words", "sha").join(cut.withColumnRenamed("sha", "cut_sha"), ["doc_id", "th"], "left").join(copies, ["doc_id", "th"], "left"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("doc_id", "n_words",
                      F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                      F.when(F.col("copy"), empty).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
                      F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))


def _repeats(marks: DataFrame) -> bool:
    """Does any (id, text) occur twice?"""
    return bool(marks.groupBy("doc_id", "th").agg(F.count("*").alias("n")).where("n > 1").limit(1).count())
