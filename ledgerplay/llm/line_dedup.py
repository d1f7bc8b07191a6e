"""Removal of repeated runs of lines by winnowing.

A line's hash is that of its bytes without surrounding white space; blank lines
are no part of the sequence and always stay.  A run is ``run`` consecutive
(non-blank) lines.  A line is deleted if it lies in a run that also occurs at an
earlier place: in a document with a smaller id, or further up in the same one.

1. Winnowing: of every ``run`` consecutive line hashes the (rightmost) smallest is
   selected.  Equal runs select the same line at the same offset, so every
   repeated run is guaranteed a shared fingerprint; about 2 in run+1 lines are one.
2. Join: only fingerprints whose hash occurs more than once go on.
3. Extension: around a surviving fingerprint the match is extended both ways, line
   by line, over all runs that selected it (run-1 lines up and down); each
   extended run is confirmed by a 128-bit digest, whose earliest place owns it.
   Adjacent confirmed runs chain into maximal repeated passages of any length.
4. All places but the owner lose the covered lines.

``remove_repeated_content`` sets the guarantee by content instead: every repeated
run, down to a single line, whose trimmed lines hold ``min_bytes`` bytes together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerplay.llm.common import (
    id_text, materialize, mix64, odd_constants, packed_texts, powers, rolling, signed, text_buffer, unpack_text,
)
from ledgerplay.llm.common import _BYTE_CODE, _separators  # byte codes of the word hash

RUN = 3
MIN_BYTES = 40
HOT_SHARE = 1000  # runs with more than 1/1000 of all places are at most 1000 and are broadcast
_LANES = [int(x) for x in odd_constants(2, 7_007)]


def line_hashes(buf: np.ndarray, sizes: bool = False) -> tuple[np.ndarray, ...]:
    """Hash of every non-blank trimmed line, its line number, and the bounds (n, 2) of all lines;
    with ``sizes`` also the bytes of the trimmed lines."""
    cuts = np.flatnonzero(buf == 10)
    bounds = np.column_stack([np.r_[0, cuts + 1], np.r_[cuts, len(buf)]])
    solid = np.flatnonzero(~_separators(buf))
    lo, hi = np.searchsorted(solid, bounds[:, 0]), np.searchsorted(solid, bounds[:, 1])
    full = np.flatnonzero(hi > lo)
    s, e = solid[lo[full]] if len(full) else np.empty(0, np.int64), solid[hi[full] - 1] + 1 if len(full) else np.empty(0, np.int64)
    up, down = powers(len(buf) + 1)
    c = np.zeros(len(buf) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE_CODE[buf] * up[:len(buf)], dtype=np.uint64, out=c[1:])
        h = mix64((c[e] - c[s]) * down[s] + (e - s).astype(np.uint64))
    return (h, full, bounds, e - s) if sizes else (h, full, bounds)


def fingerprints(h: np.ndarray, run: int) -> list[tuple[int, int, int]]:
    """(fingerprint position, first and last run start that select it) of a line-hash sequence."""
    n = len(h) - run + 1
    if n <= 0:
        return []
    view = np.lib.stride_tricks.sliding_window_view(h, run)
    at = np.arange(n) + run - 1 - view[:, ::-1].argmin(axis=1)
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return [(int(at[a]), int(a), int(b) - 1) for a, b in zip(new, np.r_[new[1:], n])]


def _lines(batches):
    """-> doc_id, th, hashes of the non-blank lines."""
    for batch in batches:
        offsets, data = text_buffer(batch.column(1))
        found = [signed(line_hashes(data[a:b])[0]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "th", "lines"])


def _select(run: int):
    """-> fingerprints with the digests of the runs that selected them."""
    def work(batches):
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("fp", "doc_id", "th", "starts", "w1", "w2")}
            for doc_id, th, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                h = np.asarray(lines.values, dtype=np.int64).view(np.uint64)
                d1, d2 = signed(rolling(h, run, _LANES[0])), signed(rolling(mix64(h), run, _LANES[1]))
                for p, a, b in fingerprints(h, run):
                    out["fp"].append(int(signed(h[p:p + 1])[0]))
                    out["doc_id"].append(doc_id)
                    out["th"].append(th)
                    out["starts"].append(list(range(a, b + 1)))
                    out["w1"].append(d1[a:b + 1])
                    out["w2"].append(d2[a:b + 1])
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))
    return work


def _kept(raw: bytes, starts: np.ndarray | None, n: np.ndarray | int) -> tuple[int, int, str]:
    """Non-blank lines, removed lines and what stays of a text without the runs of ``n`` lines at ``starts``."""
    h, full, bounds = line_hashes(np.frombuffer(raw, dtype=np.uint8))
    drop = np.zeros(len(bounds), dtype=bool)
    if starts is not None:
        step = np.zeros(len(full) + 1, dtype=np.int64)
        np.add.at(step, starts, 1)
        np.add.at(step, starts + n, -1)
        drop[full[np.cumsum(step)[:-1] > 0]] = True
    return len(h), int(drop.sum()), b"\n".join(raw[a:b] for (a, b), d in zip(bounds.tolist(), drop.tolist()) if not d).decode()


def _kept_batch(batch: pa.RecordBatch, kept: list[tuple[int, int, str]]) -> pa.RecordBatch:
    n, gone, text = ([x[i] for x in kept] for i in range(3))
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(text, pa.string())],
                                      names=["doc_id", "n_lines", "n_removed", "kept_text"])


def _ints(hit) -> np.ndarray | None:
    return np.asarray(hit.values, dtype=np.int64) if hit.is_valid else None


def _apply(run: int):
    def work(batches):
        for batch in batches:
            yield _kept_batch(batch, [_kept(unpack_text(z), _ints(hit), run) for z, hit in zip(batch.column(2).to_pylist(), batch.column(3))])
    return work


def _apply_spans(batches):
    for batch in batches:
        yield _kept_batch(batch, [_kept(unpack_text(z), _ints(at), _ints(n)) for z, at, n in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4))])


def remove_repeated_lines(docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_lines (non-blank), n_removed, kept_text.

    Texts with fewer than ``run`` non-blank lines (also null and empty ones) lose
    nothing.  Rows with a null id are compared with nothing and stay whole.
    Repeated rows of one id are the same document at the same place: neither is
    earlier, so none loses lines to the other.  An empty table gives an empty table.
    """
    base = id_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    lines = materialize(base.where(F.col("doc_id").isNotNull()).mapInArrow(_lines, "doc_id long, th long, lines array<long>").where(F.size("lines") >= run))
    marks = lines.mapInArrow(_select(run), "fp long, doc_id long, th long, starts array<int>, w1 array<long>, w2 array<long>")
    often = marks.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp")
    runs = (marks.join(often, "fp").select("doc_id", "th", F.explode(F.arrays_zip("starts", "w1", "w2")).alias("x"))
            .select("doc_id", "th", F.col("x.starts").alias("at"), "x.w1", "x.w2"))
    runs = materialize(runs)
    place = F.struct("doc_id", "at")
    owner = runs.groupBy("w1", "w2").agg(F.min(place).alias("own"), F.max(place).alias("last")).where("own < last").select("w1", "w2", "own")
    later = runs.join(owner, ["w1", "w2"]).where(F.struct("doc_id", "at") > F.col("own"))
    hits = later.groupBy("doc_id", "th").agg(F.collect_set("at").alias("hit"))  # run starts of one document
    return packed_texts(base).join(hits, ["doc_id", "th"], "left").select("doc_id", "th", "z", "hit").mapInArrow(
        _apply(run), "doc_id long, n_lines long, n_removed long, kept_text string")


def spans(size: np.ndarray, min_bytes: int) -> np.ndarray:
    """(start, length) of the shortest run of ``min_bytes`` bytes from every line and to every line.

    A line of any repeated run of that size also lies in one of these inside it.
    """
    n = len(size)
    c = np.r_[0, np.cumsum(size)]
    i = np.arange(n)
    last = np.searchsorted(c, c[:-1] + min_bytes)  # first end that holds enough
    first = np.searchsorted(c, c[1:] - min_bytes, side="right") - 1  # last start that holds enough
    a, b = last <= n, first >= 0
    key = np.unique(np.r_[i[a] * (n + 1) + last[a] - i[a], first[b] * n + i[b] + 1])  # start * (n + 1) + length
    return np.column_stack([key // (n + 1), key % (n + 1)])


def _spans(min_bytes: int):
    """-> digests of the runs of a document that hold enough."""
    def work(batches):
        for batch in batches:
            offsets, data = text_buffer(batch.column(1))
            many, at, n, w1, w2 = [], [], [], [], []
            for x, y in zip(offsets[:-1], offsets[1:]):
                h, _full, _bounds, size = line_hashes(data[x:y], sizes=True)
                run = spans(size, min_bytes)
                start, k = run[:, 0], run[:, 1]
                many.append(len(run))
                at.append(start)
                n.append(k)
                with np.errstate(over="ignore"):
                    for lane, v, w in zip(_LANES, (h, mix64(h)), (w1, w2)):
                        up, down = powers(len(h) + 1, lane)
                        c = np.zeros(len(h) + 1, dtype=np.uint64)
                        np.cumsum(v * up[:len(h)], dtype=np.uint64, out=c[1:])
                        w.append(mix64((c[start + k] - c[start]) * down[start] + k.astype(np.uint64)))
            if many:
                row = pa.array(np.repeat(np.arange(len(many)), many))
                w1, w2 = (pa.array(signed(np.concatenate(w))) for w in (w1, w2))
                at, n = (pa.array(np.concatenate(v).astype(np.int32)) for v in (at, n))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(2).take(row), at, n, w1, w2], names=["doc_id", "th", "at", "n", "w1", "w2"])
    return work


def remove_repeated_content(docs: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Like ``remove_repeated_lines``, for all repeated runs of one or more lines that hold ``min_bytes`` bytes.

    Bytes are those of the trimmed lines, without line ends.  Null ids, repeated
    rows and empty tables as there.
    """
    base = id_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    runs = materialize(base.where(F.col("doc_id").isNotNull()).mapInArrow(_spans(min_bytes), "doc_id long, th long, at int, n int, w1 long, w2 long"))
    place = F.struct("doc_id", "at")
    owner = materialize(runs.groupBy("w1", "w2").agg(F.min(place).alias("own"), F.max(place).alias("last"), F.count("*").alias("places")).where("own < last").drop("last"))
    many = max(1, runs.count() // HOT_SHARE)
    hot, cold = owner.where(F.col("places") > many).drop("places"), owner.where(F.col("places") <= many).drop("places")
    # a run with many places never meets in one task: its places stay where they are
    common = runs.join(F.broadcast(hot), ["w1", "w2"], "left")
    later = (common.where(F.col("own").isNotNull()).unionByName(common.where(F.col("own").isNull()).drop("own").join(cold, ["w1", "w2"]))
             .where(F.struct("doc_id", "at") > F.col("own")))
    hits = later.groupBy("doc_id", "th").agg(F.collect_set(F.struct("at", "n")).alias("hit"))
    return packed_texts(base).join(hits, ["doc_id", "th"], "left").select("doc_id", "th", "z", F.transform("hit", lambda x: x["at"]).alias("at"), F.transform("hit", lambda x: x["n"]).alias("n")).mapInArrow(
        _apply_spans, "doc_id long, n_lines long, n_removed long, kept_text string")
