"""Token counts of whole documents by overlap resynchronisation.

A document of at most ``chunk_chars`` characters is encoded at once.  A longer
one is encoded in overlapping chunks with offsets, and the chunks are spliced at
a stable common boundary.

Why the splice is exact.  The tokenizer first cuts out special strings, then
splits the rest into pre-tokens by a left-to-right pattern that looks ahead but
never back, and merges only inside a pre-token.  Suppose a chunk starts at a
true pre-token boundary.  Each of its pre-token boundaries that lies more than
``margin`` characters (the longest special string and one more) before its end
was decided by text the chunk holds, so it is a true boundary of the document.
The next chunk starts anywhere; but if it has a boundary at the same place, its
splitting from there on is that of the document.  So both chunks can be joined
there.  If the overlap holds no common boundary (one very long pre-token, such
as an unbroken run of letters), the chunk and the overlap are doubled and the
alignment is tried again, up to the rest of the document.

As nothing crosses a pre-token, the tokens of a short text are those of its pre-tokens, and the
library encodes each distinct pre-token once per worker (``MEMO`` of them are kept).  They are cut by
the byte-level pattern over the code points below ``PLAIN_END``, whose classes are listed one by
one; texts with other characters or with a special string are encoded whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerplay.llm.common import id_text, slices, text_buffer

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
OVER_LIMIT = 512  # tokens
BATCH_BYTES = 1 << 19  # text handed to the library at once
MEMO = 200_000  # pre-tokens whose counts a worker keeps
PLAIN_END = 0x250  # Latin letters: classes that no Unicode version changes


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(PLAIN_END) if unicodedata.category(chr(c))[0] == kind)


_SPACE = r"\t-\r \x85\xa0"  # White_Space below PLAIN_END
PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_class('L')}]+| ?[{_class('N')}]+| ?[^{_SPACE}{_class('L')}{_class('N')}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
NOT_PLAIN = re.compile(f"[^\\x00-\\u{PLAIN_END - 1:04x}]")


@functools.lru_cache(maxsize=4)
def load_tokenizer(name: str):
    """Tokenizer of a public .json file (a name known to ``public_tokenizers`` or a path)
    and the length of its longest special string."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    import public_tokenizers
    from tokenizers import Tokenizer

    path = name if os.path.sep in name else public_tokenizers.path(name)
    with open(path, encoding="utf-8") as f:
        cfg = json.load(f)
    kind = (cfg.get("pre_tokenizer") or {}).get("type")
    if kind != "ByteLevel" or cfg.get("normalizer") or cfg["pre_tokenizer"].get("add_prefix_space"):
        raise ValueError("the splice proof holds for byte-level pre-tokens without a normalizer or prefix space")
    cfg["post_processor"] = None  # adds nothing to a count; would trim the offsets
    cfg["truncation"] = cfg["padding"] = None
    longest = max([len(t["content"]) for t in cfg.get("added_tokens") or []], default=0)
    return Tokenizer.from_str(json.dumps(cfg)), longest


def _boundaries(enc) -> tuple[np.ndarray, np.ndarray]:
    """Pre-token starts of an encoding: character position and number of tokens before it."""
    words = np.array([-1 if w is None else w for w in enc.word_ids], dtype=np.int64)
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]) | (words[1:] < 0)])
    offsets = enc.offsets
    return np.array([offsets[i][0] for i in new], dtype=np.int64), new


def count_long(text: str, tokenizer, longest_special: int, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> tuple[int, int]:
    """(number of tokens, number of widenings) of one long text.

    Memory is that of one chunk's encoding, except inside a pre-token that is
    itself longer than a chunk.
    """
    margin = longest_special + 1
    total, widened, at, n = 0, 0, 0, len(text)
    # state: ``at`` is a true boundary; the left chunk starts there
    size, overlap = chunk_chars, max(overlap_chars, margin + 1)
    while True:
        end = min(n, at + size)
        left = tokenizer.encode(text[at:end], add_special_tokens=False)
        if end == n:
            return total + len(left.ids), widened
        lpos, ltok = _boundaries(left)
        lpos = lpos + at
        start = end - overlap
        right = tokenizer.encode(text[start:min(n, end + overlap)], add_special_tokens=False)
        rpos = _boundaries(right)[0] + start
        ok = (lpos > max(at, start)) & (lpos <= end - margin)
        common = np.intersect1d(lpos[ok], rpos)
        if len(common):
            cut = int(common[-1])
            total += int(ltok[np.searchsorted(lpos, cut)])
            at, size, overlap = cut, chunk_chars, max(overlap_chars, margin + 1)
        else:
            widened += 1
            size, overlap = size * 2, min(overlap * 2, size * 2 - 1)


@functools.lru_cache(maxsize=4)
def _memo(name: str) -> tuple[dict[str, int], re.Pattern | None]:
    """Known counts of pre-tokens, and the pattern of texts that must be encoded whole (None: all)."""
    cfg = json.loads(load_tokenizer(name)[0].to_str())
    if not cfg["pre_tokenizer"].get("use_regex", True):
        return {}, None
    special = [re.escape(t["content"]) for t in cfg.get("added_tokens") or []]
    return {}, re.compile("|".join([NOT_PLAIN.pattern, *special]))


def count_short(texts: list[str], name: str) -> list[int]:
    """Number of tokens of each text."""
    tok = load_tokenizer(name)[0]
    memo, whole = _memo(name)
    cut = [None if whole is None or whole.search(t) else PRE_TOKEN.findall(t) for t in texts]
    new = list(set().union(*[p for p in cut if p is not None]).difference(memo))
    if len(memo) + len(new) > MEMO:
        memo.clear()
        new = list(set().union(*[p for p in cut if p is not None]))
    memo.update(zip(new, map(len, tok.encode_batch_fast(new, add_special_tokens=False))))
    rest = iter(tok.encode_batch_fast([t for t, p in zip(texts, cut) if p is None], add_special_tokens=False))
    return [len(next(rest)) if p is None else sum(map(memo.__getitem__, p)) for p in cut]


def _count_batches(batches: Iterator[pa.RecordBatch], name: str, chunk_chars: int, overlap_chars: int) -> Iterator[pa.RecordBatch]:
    tok, special = load_tokenizer(name)
    for batch in batches:
        offsets, _ = text_buffer(batch.column(1))
        n_bytes = np.diff(offsets)
        counts = np.zeros(len(n_bytes), dtype=np.int64)
        widened = np.zeros(len(n_bytes), dtype=np.int64)
        for i, j in slices(offsets, BATCH_BYTES):
            texts = batch.column(1).slice(i, j - i).to_pylist()
            short = [k for k, t in enumerate(texts) if len(t) <= chunk_chars]
            for k, n in zip(short, count_short([texts[k] for k in short], name)):
                counts[i + k] = n
            for k, t in enumerate(texts):
                if len(t) > chunk_chars:
                    counts[i + k], widened[i + k] = count_long(t, tok, special, chunk_chars, overlap_chars)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes.astype(np.int64)), pa.array(counts), pa.array(widened)],
                                         names=["doc_id", "n_bytes", "n_tokens", "n_widened"])


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = OVER_LIMIT, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit, n_widened.

    A null text counts as empty (0 bytes, 0 tokens).  Repeated rows and null ids
    keep their own rows; an empty table gives an empty table.  No shuffle: the
    scan's partitions are encoded where they are read.
    """
    def run(batches):
        return _count_batches(batches, tokenizer, chunk_chars, overlap_chars)

    out = id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, n_widened long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_widened")
