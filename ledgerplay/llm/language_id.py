"""Language identification with a language-bitmask n-gram filter.

The model is one bit-sliced Bloom filter: ``SLOTS`` slots, each holding a bit per
language.  An n-gram sets its language's bit in ``HASHES`` slots; the AND of an
n-gram's slots is the set of all languages that contain it.  A document is decided
by the popcount of every language over its n-grams, corrected for the false
positives of that language's plane (hits = found + (n - found) * fp).

Which n-grams a language contains is learned from rates, not from mere presence,
so noise does not fill the filter as the corpus grows: an n-gram belongs to a
language if it is in at least ``MIN_RATE`` of its training documents and its rate
is at least ``MIN_SHARE`` of its best rate in any language.  At most
(n-grams per document) / ``MIN_RATE`` n-grams pass per language, whatever the
corpus size; the filter that is sent to the tasks has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerplay.llm.common import mix64, slices, text_buffer, workers_import_package

NGRAM = 5  # bytes of lower-cased UTF-8; whatever is no letter counts as a space
SLOTS = 1 << 20
HASHES = 2
MIN_RATE = 0.01
MIN_SHARE = 0.2
DOCS_PER_LANG = 4_000  # bound of the training sample per language (in expectation)
UNKNOWN = "und"


@dataclass
class LanguageFilter:
    langs: list[str]  # most frequent first: ties and documents without any hit go to the first
    planes: np.ndarray  # (words of 64 languages, SLOTS) bit masks
    false_positive: np.ndarray  # per language


def _letters(buf: np.ndarray) -> np.ndarray:
    low = buf | np.uint8(32)
    return ((low >= 97) & (low <= 122)) | (buf >= 128)


def _ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """n-grams (packed bytes) of all texts and the bounds of each text in them."""
    raw = [b" " + t.lower().encode() + b" " for t in texts]
    buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    clean = np.where(_letters(buf), buf, np.uint8(32)).astype(np.uint64)
    n = max(0, len(buf) - NGRAM + 1)
    gram = np.zeros(n, dtype=np.uint64)
    for j in range(NGRAM):
        gram |= clean[j:j + n] << np.uint64(8 * j)
    ok = (clean[NGRAM // 2:NGRAM // 2 + n] != 32)  # a letter in the middle: no runs of spaces
    for e in ends[:-1]:  # none across two texts
        ok[max(0, e - NGRAM + 1):e] = False
    keep = np.flatnonzero(ok)
    return gram[keep], np.searchsorted(keep, np.r_[0, ends])


def _slots(gram: np.ndarray) -> list[np.ndarray]:
    h = mix64(gram)
    return [((h >> np.uint64(20 * k)) % np.uint64(SLOTS)).astype(np.int64) for k in range(HASHES)]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang no, text) -> (lang no, n-gram, documents that hold it), summed per slice of rows."""
    for batch in batches:
        offsets, _ = text_buffer(batch.column(1))
        no = batch.column(0).to_numpy(zero_copy_only=False)
        for i, j in slices(offsets):
            gram, bound = _ngrams(batch.column(1).slice(i, j - i).to_pylist())
            each = [np.unique(gram[a:b]) for a, b in zip(bound[:-1], bound[1:])]
            for lang in np.unique(no[i:j]):
                found = [x for x, k in zip(each, no[i:j]) if k == lang]
                g, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), lang, np.int32)), pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["lang_no", "gram", "n"])


def _gram_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gram = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        lang = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for s in _slots(gram):
            yield pa.RecordBatch.from_arrays([pa.array(lang // 64), pa.array(s), pa.array(np.left_shift(np.int64(1), lang % 64))], names=["plane", "slot", "bits"])


def fit(train: DataFrame, docs_per_lang: int = DOCS_PER_LANG, text_col: str = "text", lang_col: str = "lang") -> LanguageFilter:
    """Learn the filter from rows with a non-null language and text.

    Per language about ``docs_per_lang`` documents are used whole (all, if there
    are fewer), chosen by a hash of their text.  No labelled row at all: a filter
    without languages, which answers ``und``.
    """
    workers_import_package(train.sparkSession)
    t = train.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = sorted(((r["lang"], r["n"]) for r in t.groupBy("lang").agg(F.count("*").alias("n")).collect()), key=lambda x: (-x[1], x[0]))
    langs = [x for x, _ in counts]
    words = max(1, -(-len(langs) // 64))
    planes = np.zeros((words, SLOTS), dtype=np.uint64)
    if not langs:
        return LanguageFilter([], planes, np.zeros(0))
    spark = train.sparkSession
    table = spark.createDataFrame([(x, i, min(1.0, docs_per_lang / n)) for i, (x, n) in enumerate(counts)], "lang string, lang_no int, share double")
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    sample = t.join(F.broadcast(table), "lang").where(share < F.col("share")).select("lang_no", "text")
    freq = sample.mapInArrow(_document_frequencies, "lang_no int, gram long, n long").groupBy("lang_no", "gram").agg(F.sum("n").alias("n"))
    used = {r["lang_no"]: r["n"] for r in sample.groupBy("lang_no").agg(F.count("*").alias("n")).collect()}
    sizes = F.create_map(*[F.lit(x) for i, n in used.items() for x in (i, float(n))]) if used else F.create_map(F.lit(0), F.lit(1.0))
    rate = freq.withColumn("rate", F.col("n") / F.element_at(sizes, F.col("lang_no"))).where(F.col("rate") >= MIN_RATE)
    best = rate.groupBy("gram").agg(F.max("rate").alias("best"))
    held = rate.join(best, "gram").where(F.col("rate") >= MIN_SHARE * F.col("best")).select("lang_no", "gram")
    bits = held.mapInArrow(_gram_slots, "plane long, slot long, bits long").groupBy("plane", "slot").agg(F.bit_or("bits").alias("bits")).toPandas()
    planes[bits["plane"].to_numpy(), bits["slot"].to_numpy()] = bits["bits"].to_numpy(np.int64).view(np.uint64)
    fill = np.array([np.count_nonzero(planes[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / SLOTS for i in range(len(langs))])
    return LanguageFilter(langs, planes, np.minimum(fill ** HASHES, 0.999))


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def score_texts(texts: list[str | None], model: LanguageFilter) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; the score is the winner's share of all corrected popcounts."""
    gram, bound = _ngrams([t or "" for t in texts])
    a, *more = _slots(gram)
    n = np.diff(bound)
    found = np.zeros((len(model.langs), len(texts)))
    for p, plane in enumerate(model.planes):
        mask = plane[a]
        for s in more:
            mask &= plane[s]
        for k in range(min(64, len(model.langs) - 64 * p)):
            hit = np.zeros(len(mask) + 1, dtype=np.int64)
            np.cumsum((mask >> np.uint64(k)) & np.uint64(1), out=hit[1:], dtype=np.int64)
            fp = model.false_positive[64 * p + k]
            found[64 * p + k] = np.maximum(0.0, (hit[bound[1:]] - hit[bound[:-1]] - n * fp) / (1.0 - fp))
    langs, score = [], np.zeros(len(texts))
    for i, t in enumerate(texts):
        if not model.langs or not t or not _has_letter(t):
            langs.append(UNKNOWN)
            continue
        best = int(np.argmax(found[:, i]))
        total = found[:, i].sum()
        score[i] = found[best, i] / total if total > 0 else 0.0
        langs.append(model.langs[best])
    return langs, score


def predict(docs: DataFrame, model: LanguageFilter, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` with lang_pred and score, one row per input row.

    A null text or one without a letter is ``und`` with score 0.  A text with
    letters but no known n-gram gets the most frequent learned language, score 0;
    equal popcounts go to the more frequent language.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: SLOTS * 8 bytes per 64 languages
    workers_import_package(docs.sparkSession)
    base = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            offsets, _ = text_buffer(text)
            for i, j in slices(offsets):
                langs, score = score_texts(text.slice(i, j - i).to_pylist(), sent.value)
                kept = [batch.column(c).slice(i, j - i) for c in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(langs, pa.string()), pa.array(score)], names=[*batch.schema.names[:-1], "lang_pred", "score"])

    return base.mapInArrow(run, f"{fields}, lang_pred string, score double")
