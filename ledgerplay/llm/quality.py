"""Quality classifier: random Fourier features over document statistics.

1. ``document_statistics`` turns every whole text into ``len(STATISTICS)`` numbers.
2. ``fit`` standardises them, maps them to ``N_FEATURES`` random Fourier features
   (which approximate a Gaussian kernel of width ``WIDTH``), sums the normal
   equations per partition, adds the partitions and solves the ridge system.
3. Held-back training rows calibrate the ridge score: counts per score bin, then
   isotonic regression (pool adjacent violators) over the bins.

The training sample is bounded (``MAX_LABELLED`` rows in expectation, chosen by a
hash); everything else covers all rows.  What reaches the driver has a fixed size:
one (features x features) matrix per partition of the sample and the score bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerplay.llm.common import materialize, text_buffer, words_by_row, workers_import_package

STATISTICS = ("log_bytes", "log_words", "word_length", "upper", "title_words", "digit", "punctuation", "symbol", "exclamation", "bar",
              "newline", "repeated_neighbour", "distinct_words", "long_words", "short_words")
N_FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-3  # per training row
CLIP = 5.0
MAX_LABELLED = 40_000
SUM_PARTITIONS = 8
CALIBRATION_SHARE = 0.2
BINS = 1_000
THRESHOLD = 0.3
SEED = 20_240


def _byte_classes() -> np.ndarray:
    """Class of each byte: bits upper, letter, digit, punctuation, symbol, !, |, newline."""
    c = np.zeros(256, dtype=np.uint8)
    c[65:91] = 1 | 2
    c[97:123] = 2
    c[128:] = 2
    c[48:58] = 4
    for b in b".,;:?'\"-()":
        c[b] = 8
    for b in range(33, 127):
        if not chr(b).isalnum() and not c[b]:
            c[b] = 16
    c[ord("!")] = 32
    c[ord("|")] = 64
    c[10] = 128
    return c


_CLASS = _byte_classes()


def _statistics(column: pa.Array) -> np.ndarray:
    """(rows, statistics); shares are square-rooted so that rare signs still show."""
    out = []
    for i, j, h, s, e, bound, buf in words_by_row(column):
        offs = _row_offsets(column, i, j)
        cls = _CLASS[buf]

        def per_row(flags: np.ndarray) -> np.ndarray:
            c = np.zeros(len(flags) + 1, dtype=np.int64)
            np.cumsum(flags, out=c[1:])
            return c

        size = np.diff(offs).astype(float)
        n = np.diff(bound).astype(float)
        safe, words = np.maximum(size, 1), np.maximum(n, 1)
        by_byte = lambda bit: np.diff(per_row((cls & bit) != 0)[offs])
        by_word = lambda flags: np.diff(per_row(flags)[bound])
        length = e - s
        same = np.zeros(len(h), dtype=bool)
        same[1:] = h[1:] == h[:-1]
        same[bound[:-1][bound[:-1] < len(h)]] = False
        title = (cls[s] & 1).astype(bool) if len(s) else np.zeros(0, bool)
        distinct = np.array([len(np.unique(h[a:b])) for a, b in zip(bound[:-1], bound[1:])], dtype=float)
        letters = np.maximum(by_byte(2), 1)
        share = [by_byte(1) / letters, by_word(title) / words, by_byte(4) / safe, by_byte(8) / safe, by_byte(16) / safe, by_byte(32) / safe, by_byte(64) / safe,
                 by_byte(128) / words, by_word(same) / words, distinct / words, by_word(length > 12) / words, by_word(length <= 2) / words]
        mean = np.diff(per_row(length)[bound]) / words
        out.append(np.column_stack([np.log1p(size), np.log1p(n), np.minimum(mean, 50.0), *[np.sqrt(np.minimum(x, 1.0)) for x in share]]))
    return np.concatenate(out) if out else np.zeros((0, len(STATISTICS)))


def _row_offsets(column: pa.Array, i: int, j: int) -> np.ndarray:
    offsets, _ = text_buffer(column)
    return offsets[i:j + 1] - offsets[i]


def document_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``stats`` (array<double>), one row per input row; null and empty texts give the statistics of an empty text."""
    workers_import_package(docs.sparkSession)
    base = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _statistics(batch.column(batch.num_columns - 1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(STATISTICS), dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], flat], names=[*batch.schema.names[:-1], "stats"])

    return base.mapInArrow(run, f"{fields}, stats array<double>")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots_x: np.ndarray
    knots_y: np.ndarray
    width: float = WIDTH

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.mean, self.scale, self.width) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots_x, self.knots_y), 0.0, 1.0)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray, width: float = WIDTH) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0.0, 1.0 / width, (stats.shape[1], N_FEATURES))
    b = rng.uniform(0.0, 2.0 * np.pi, N_FEATURES)
    x = np.clip((stats - mean) / scale, -CLIP, CLIP)
    return np.column_stack([np.sqrt(2.0 / N_FEATURES) * np.cos(x @ w + b), np.ones(len(x))])


def isotonic(x: np.ndarray, total: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points in ascending ``x``: block centres and block means."""
    blocks: list[list[float]] = []  # weight, positives, weighted x
    for xi, n, p in zip(x, total, positive):
        blocks.append([float(n), float(p), float(n * xi)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, p2, s2 = blocks.pop()
            blocks[-1][0] += n2
            blocks[-1][1] += p2
            blocks[-1][2] += s2
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    col = batch.column(batch.schema.names.index(name))
    return np.asarray(col.flatten()).reshape(len(col), -1)


def fit(labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> QualityModel:
    """Learn from rows (stats, label 0/1, pick) where ``pick`` is a long that spreads the rows.

    Rows with a null label are left out.  Without any row the score is 0.5
    everywhere; with one class only it is that class's smoothed rate.
    """
    workers_import_package(labelled.sparkSession)
    rows = labelled.where("label IS NOT NULL")
    n_all = rows.count()
    d = len(STATISTICS)
    if not n_all:
        return QualityModel(np.zeros(d), np.ones(d), np.zeros(N_FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    unit = lambda seed: F.pmod(F.xxhash64("pick", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    sample = materialize(rows.where(unit(1) < min(1.0, max_labelled / n_all)).select("stats", F.col("label").cast("double").alias("label"),
                                                                                      (unit(2) < CALIBRATION_SHARE).alias("held")).coalesce(SUM_PARTITIONS))

    def moments(batches):
        for batch in batches:
            x = _matrix(batch, "stats")
            s = np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(s), dtype=np.int32)), pa.array(s)], names=["i", "v"])

    sums = {r["i"]: r["v"] for r in sample.mapInArrow(moments, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    if not sums:
        return QualityModel(np.zeros(d), np.ones(d), np.zeros(N_FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    n = sums[0]
    mean = np.array([sums[1 + k] / n for k in range(d)])
    scale = np.sqrt(np.maximum(np.array([sums[1 + d + k] / n for k in range(d)]) - mean ** 2, 0.0))
    scale[scale < 1e-9] = 1.0
    size = N_FEATURES + 1

    def normal_equations(batches):
        zz, zy, m = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            y = np.asarray(batch.column(batch.schema.names.index("label")))
            z = fourier(_matrix(batch, "stats"), mean, scale)
            zz += z.T @ z
            zy += z.T @ (y - 0.5)
            m += len(y)
        if m:
            yield pa.RecordBatch.from_arrays([pa.array([m]), pa.array([zz.tobytes()]), pa.array([zy.tobytes()])], names=["n", "zz", "zy"])

    parts = sample.where("NOT held").mapInArrow(normal_equations, "n long, zz binary, zy binary").collect()  # SUM_PARTITIONS rows
    if not parts:  # too few rows to hold some back
        parts = sample.mapInArrow(normal_equations, "n long, zz binary, zy binary").collect()
    zz = sum(np.frombuffer(p["zz"]).reshape(size, size) for p in parts)
    zy = sum(np.frombuffer(p["zy"]) for p in parts)
    weights = np.linalg.solve(zz + RIDGE * sum(p["n"] for p in parts) * np.eye(size) / N_FEATURES, zy)
    model = QualityModel(mean, scale, weights, np.zeros(1), np.full(1, 0.5))

    def bins(batches):
        for batch in batches:
            y = np.asarray(batch.column(batch.schema.names.index("label")))
            k = np.round(model.raw(_matrix(batch, "stats")) * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.ones(len(k))), pa.array(y)], names=["k", "n", "p"])

    def counted(part: DataFrame) -> list:
        return part.mapInArrow(bins, "k long, n double, p double").groupBy("k").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).orderBy("k").collect()

    found = counted(sample.where("held")) or counted(sample)
    x, y = isotonic(np.array([r["k"] / BINS for r in found]), np.array([r["n"] for r in found]), np.array([r["p"] for r in found]))
    total, good = sum(r["n"] for r in found), sum(r["p"] for r in found)
    if len(x) == 1:
        y = np.array([(good + 1.0) / (total + 2.0)])
    model.knots_x, model.knots_y = x, y
    return model


def predict(stats: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``stats`` with score (0 to 1, higher is better) and predicted (1 if score >= threshold) in place of the statistics."""
    sent = stats.sparkSession.sparkContext.broadcast(model)  # fixed size
    kept = [c for c in stats.columns if c != "stats"]
    workers_import_package(stats.sparkSession)
    base = stats.select(*kept, "stats")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            s = sent.value.score(_matrix(batch, "stats")) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*batch.schema.names[:-1], "score", "predicted"])

    return base.mapInArrow(run, f"{fields}, score double, predicted int")


def learn_model(docs: DataFrame, labels: DataFrame, learn=None, label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> QualityModel:
    """Fit on the documents that ``labels`` names (and ``learn`` admits); only narrow rows are joined."""
    known = labels.select("doc_id", F.col(label_col).alias("label")).where("doc_id IS NOT NULL")
    known = (known if learn is None else known.where(learn)).distinct()
    stats = document_statistics(docs)
    return fit(materialize(stats.join(known, "doc_id").select("stats", "label", F.col("doc_id").alias("pick"))), max_labelled)


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, columns as they were; no shuffle."""
    workers_import_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            good = sent.value.score(_statistics(batch.column(at))) >= threshold if batch.num_rows else np.zeros(0, bool)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, learn, label_col: str = "quality", threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Score every document: doc_id, score, predicted.

    ``labels`` has doc_id and ``label_col`` (0/1); ``learn`` is a condition on
    doc_id that names the rows which may be learned from.  Documents keep one row
    per input row (also with null or repeated ids); a repeated label row counts
    once per distinct label.  The statistics are computed once for all documents;
    only (doc_id, statistics) is joined with the labels, never the text.
    """
    stats = materialize(document_statistics(docs))
    known = labels.select("doc_id", F.col(label_col).alias("label")).where("doc_id IS NOT NULL").where(learn).distinct()
    rows = materialize(stats.join(known, "doc_id").select("stats", "label", F.col("doc_id").alias("pick")))
    return predict(stats, fit(rows, max_labelled), threshold)
