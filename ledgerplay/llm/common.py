"""Helpers of the training-data operators: UTF-8 buffers, word hashes, shared checkpoints.

Conventions shared by the operators
-----------------------------------
* Only the columns an operator needs are selected first, so further columns of
  the input (also ones named like an output column) never clash.
* A null text is an empty text.  Text work runs on the UTF-8 bytes of an Arrow
  batch in slices of bounded size; one document is at most one row.
* Intermediate tables that are read twice go to the folder named by
  ``spark.checkpoint.dir`` through ``checkpoint()``, so they outlive executors.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerplay.session import checkpoint_dir

SLICE_BYTES = 1 << 20  # text bytes hashed at once inside a task
_U = np.uint64


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver
    did (on a cluster it is installed, or shipped with ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: computed once, lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names."""
    workers_import_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def release_buffers() -> None:
    """Hand freed Arrow buffers back to the machine: an idle worker would keep them beside the next stage's JVM work."""
    pa.default_memory_pool().release_unused()


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = text_buffer(batch.column(1))
        for i, j in slices(offsets):
            z = [pack_text(data[a:b].tobytes()) for a, b in zip(offsets[i:j], offsets[i + 1:j + 1])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(z, pa.binary())], names=["doc_id", "th", "z"])
    release_buffers()


def packed_texts(base: DataFrame) -> DataFrame:
    """(doc_id, text, th) -> (doc_id, th, z): texts compressed before a shuffle that moves them all."""
    return base.select("doc_id", "text", "th").mapInArrow(_pack_texts, "doc_id long, th long, z binary")


def pack_text(raw: bytes) -> bytes:
    """Length and zstd frame of a text."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_text(z: bytes) -> bytes:
    n = int.from_bytes(z[:8], "little")
    return pa.decompress(z[8:], decompressed_size=n, codec="zstd", asbytes=True) if n else b""


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> _U(30)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


def odd_constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1)


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D  # odd, hence invertible modulo 2^64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (kept per process, grown on demand)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, base, dtype=np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            have = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if size <= 1 << 22:
            _POWERS[base] = have
    return have


def rolling(values: np.ndarray, width: int, base: int = _BASE) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values (empty if there are fewer)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    b = _U(base)
    with np.errstate(over="ignore"):
        if width <= 16:
            for j in range(width):
                out *= b
                out += values[j:j + n]
        else:
            up, down = powers(len(values) + 1, base)
            c = np.zeros(len(values) + 1, dtype=np.uint64)
            np.cumsum(values * up[:len(values)], dtype=np.uint64, out=c[1:])
            out = (c[width:] - c[:n]) * down[:n]
    return mix64(out)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    a = column.cast(pa.large_binary())
    _, off, data = a.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` text bytes (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def _separators(buf: np.ndarray) -> np.ndarray:
    """True at bytes 0x20 and 0x09-0x0D."""
    return (buf == 32) | ((buf >= 9) & (buf <= 13))


def _hash_piece(buf: np.ndarray, first: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = ~_separators(buf)
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    first = first[first < len(buf)]
    starts[first] = word[first]
    last = first[first > 0] - 1
    ends[last] = word[last]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    if lower:
        buf = np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)
    up, down = powers(len(buf) + 1)
    c = np.zeros(len(buf) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE_CODE[buf] * up[:len(buf)], dtype=np.uint64, out=c[1:])
        h = mix64((c[e] - c[s]) * down[s] + (e - s).astype(np.uint64))
    return h, s, e


def word_hashes(buf: np.ndarray, first: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word of ``buf``.

    ``first`` holds the (sorted) byte positions at which documents begin; words
    end there too.  Long buffers are worked in pieces cut at separators, so
    memory stays a small multiple of the text.
    """
    piece = 4 * SLICE_BYTES
    if len(buf) <= piece:
        return _hash_piece(buf, first, lower)
    found, at = [], 0
    while at < len(buf):
        end = min(len(buf), at + piece)
        while end < len(buf):  # move the cut behind a separator; a longer word makes a longer piece
            seps = np.flatnonzero(_separators(buf[max(at, end - SLICE_BYTES):end]))
            if len(seps):
                end = max(at, end - SLICE_BYTES) + int(seps[-1]) + 1
                break
            end = min(len(buf), end + SLICE_BYTES)
        h, s, e = _hash_piece(buf[at:end], first[(first >= at) & (first < end)] - at, lower)
        found.append((h, s + at, e + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found))


def words_by_row(column: pa.Array, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice of rows (of about ``limit`` text bytes): first row, end row, word hashes, word
    starts, word ends, word count bounds of the rows (length rows + 1), the slice's bytes."""
    offsets, data = text_buffer(column)
    for i, j in slices(offsets, limit):
        a, b = int(offsets[i]), int(offsets[j])
        buf, first = data[a:b], offsets[i:j + 1] - a
        if b > a:
            h, s, e = word_hashes(buf, np.unique(first[:-1]), lower)
        else:
            h, s, e = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        yield i, j, h, s, e, np.searchsorted(s, first), buf


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def set_digest(values: np.ndarray, lane: int) -> int:
    """Order-free 64-bit digest of a set of hashes; two lanes make 128 bits."""
    with np.errstate(over="ignore"):
        return int(mix64(values + _U((0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)[lane])).sum(dtype=np.uint64))


def to_signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x
