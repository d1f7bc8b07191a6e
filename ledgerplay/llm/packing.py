"""Token-id output: best-fit-decreasing packing with a segment-tree capacity search.

Documents become token ids followed by one end id.  A document longer than the
sequence length is split losslessly: all segments but the last are full.  Each
block of segments is packed best-fit-decreasing: longest segments first, each
into the open sequence with the least room that still holds it.  Room is a small
integer, so the open sequences are kept in one stack per amount of room and a
segment tree over the amounts finds the best stack in O(log length).

A packed sequence holds its ids padded to the full length, the cumulative
segment lengths (``cu_seqlens``) and the places where positions restart at 0
(``position_resets``, see ``position_ids``); ``segment_starts`` is the place of a
segment in its document, so the split is lossless.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerplay.llm.common import id_text, slices, text_buffer

SEQ_LEN = 2048
BLOCK_TOKENS = 2_000_000  # tokens packed at once: bounds a task's memory, not the input
PAD_ID = 0

PACKED_SCHEMA = ("bin_key string, n_tokens int, n_segments int, doc_ids array<bigint>, segment_nos array<int>, segment_starts array<bigint>, "
                 "cu_seqlens array<int>, position_resets array<int>, input_ids binary")


@functools.lru_cache(maxsize=4)
def load_encoder(name: str):
    """tiktoken encoder of a public rank file; its free next id ends a document."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    enc = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return enc, max(ranks.values()) + 1


class CapacityTree:
    """Segment tree over amounts of room 1..length: ``best(need)`` is the least
    room >= need that some open sequence has (0: none)."""

    def __init__(self, length: int):
        self.size = 1 << max(1, (length + 1).bit_length())
        self.full = bytearray(2 * self.size)  # node: does any leaf below hold an open sequence?
        self.stacks: list[list[int]] = [[] for _ in range(length + 1)]

    def push(self, room: int, sequence: int) -> None:
        self.stacks[room].append(sequence)
        i = room + self.size
        while i and not self.full[i]:
            self.full[i] = 1
            i >>= 1

    def best(self, need: int) -> int:
        i = need + self.size
        if self.full[i]:
            return need
        while i > 1:  # climb until a right sibling holds something, then go down leftmost
            if not i & 1 and self.full[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.full[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return 0

    def pop(self, room: int) -> int:
        sequence = self.stacks[room].pop()
        if not self.stacks[room]:
            i = room + self.size
            self.full[i] = 0
            i >>= 1
            while i and not (self.full[2 * i] or self.full[2 * i + 1]):
                self.full[i] = 0
                i >>= 1
        return sequence


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the segments of each packed sequence; ties go to the earlier segment."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    tree, bins = CapacityTree(capacity), []
    for i in order:
        need = lengths[i]
        room = tree.best(need)
        if room:
            b = tree.pop(room)
        else:
            b, room = len(bins), capacity
            bins.append([])
        bins[b].append(i)
        if room > need:
            tree.push(room - need, b)
    return bins


def id_type(end_id: int) -> str:
    """Little-endian id type of the written matrices: 16 bits if every id fits."""
    return "<u2" if end_id < 1 << 16 else "<u4"


def position_ids(cu_seqlens: list[int], seq_len: int) -> np.ndarray:
    """Positions of a packed sequence: they restart at every segment; padding is 0."""
    out = np.zeros(seq_len, dtype=np.int32)
    for a, b in zip(cu_seqlens[:-1], cu_seqlens[1:]):
        out[a:b] = np.arange(b - a)
    return out


def _pack_block(segments: list[tuple[int, int, int, np.ndarray]], seq_len: int, dtype: str) -> pa.RecordBatch:
    cols: dict[str, list] = {k: [] for k in ("key", "tok", "seg", "docs", "nos", "starts", "cu", "resets", "ids")}
    for members in best_fit_decreasing([len(s[3]) for s in segments], seq_len):
        parts = [segments[i] for i in members]
        ids = np.full(seq_len, PAD_ID, dtype=dtype)
        cu = [0]
        for _, _, _, x in parts:
            ids[cu[-1]:cu[-1] + len(x)] = x
            cu.append(cu[-1] + len(x))
        cols["key"].append(f"{parts[0][0]}:{parts[0][1]}")
        cols["tok"].append(cu[-1])
        cols["seg"].append(len(parts))
        cols["docs"].append([p[0] for p in parts])
        cols["nos"].append([p[1] for p in parts])
        cols["starts"].append([p[2] for p in parts])
        cols["cu"].append(cu)
        cols["resets"].append(cu[:-1])
        cols["ids"].append(ids.tobytes())
    types = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
    names = ["bin_key", "n_tokens", "n_segments", "doc_ids", "segment_nos", "segment_starts", "cu_seqlens", "position_resets", "input_ids"]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), types)], names=names)


def _encode(text: str, enc, piece: int = 1 << 20) -> np.ndarray:
    """Ids of a text; a very long one in pieces cut before a space that follows a
    letter and precedes one, where the pre-token pattern always starts anew."""
    if len(text) <= piece:
        return np.array(enc.encode_ordinary(text), dtype=np.uint32)
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + piece)
        while end < len(text) and not (text[end] == " " and text[end - 1].isalpha() and text[end + 1:end + 2].isalpha()):
            end += 1
        out.append(np.array(enc.encode_ordinary(text[at:end]), dtype=np.uint32))
        at = end
    return np.concatenate(out)


def _pack_batches(batches: Iterator[pa.RecordBatch], name: str, seq_len: int, block_tokens: int) -> Iterator[pa.RecordBatch]:
    enc, end_id = load_encoder(name)
    block: list[tuple[int, int, int, np.ndarray]] = []
    held = 0
    for batch in batches:
        offsets, _ = text_buffer(batch.column(1))
        ids = batch.column(0).to_pylist()
        for i, j in slices(offsets):
            for doc_id, text in zip(ids[i:j], batch.column(1).slice(i, j - i).to_pylist()):
                tokens = np.append(_encode(text, enc), np.uint32(end_id))
                for no, start in enumerate(range(0, len(tokens), seq_len)):
                    block.append((doc_id, no, start, tokens[start:start + seq_len]))
                    held += len(block[-1][3])
                    if held >= block_tokens:
                        yield _pack_block(block, seq_len, id_type(end_id))
                        block, held = [], 0
    if block:
        yield _pack_block(block, seq_len, id_type(end_id))


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.tiktoken", seq_len: int = SEQ_LEN, block_tokens: int = BLOCK_TOKENS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per packed sequence of ``seq_len`` ids (little-endian, padded; ``id_type``).

    Every row of the input is packed, also repeated rows and rows with a null id
    (null in ``doc_ids``).  A null or empty text is the end id alone.  An empty
    table gives no sequences.  Special strings inside texts are ordinary text.
    Blocks of ``block_tokens`` are packed where the scan reads them: no shuffle,
    bounded memory, at most one sequence per segment length is left part-filled.
    """
    def run(batches):
        return _pack_batches(batches, tokenizer, seq_len, block_tokens)

    return id_text(docs, id_col, text_col).mapInArrow(run, PACKED_SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed sequences as Parquet (id matrix rows, cu_seqlens, positions)."""
    packed.write.mode("overwrite").parquet(path)


def read_packed_rows(spark: SparkSession, path: str, id_bytes: int = 2) -> DataFrame:
    """Segments of a written table: doc_id, segment_no, segment_start and its ids
    (binary), for checking the round trip."""
    p = spark.read.parquet(path)
    seg = p.select("input_ids", F.posexplode(F.arrays_zip("doc_ids", "segment_nos", "segment_starts")).alias("i", "s"), "cu_seqlens")
    a, b = F.element_at("cu_seqlens", F.col("i") + 1), F.element_at("cu_seqlens", F.col("i") + 2)
    return seg.select("s.doc_ids", "s.segment_nos", "s.segment_starts", F.substring("input_ids", a * id_bytes + 1, (b - a) * id_bytes).alias("ids")) \
        .toDF("doc_id", "segment_no", "segment_start", "ids")
