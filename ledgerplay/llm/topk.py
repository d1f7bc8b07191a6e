"""Exact top-k inner-product search over a pivot-distance index.

Index: every vector is keyed by its nearest pivot and its distance to it; the
distances of a pivot are cut into annuli, and (pivot, annulus) is a cell with its
inner and outer radius and its largest norm.  Search: inner product and distance
are tied by  2<q,x> = |q|^2 + |x|^2 - |q-x|^2,  and the triangle inequality bounds
|q-x| from below by the gap between d(q, pivot) and the annulus.  So a cell can be
left out for a query once its bound lies below the query's k-th best score.

The cells with the best bounds are searched first, which gives a k-th best score to
begin with, then all cells that this score does not exclude; the k-th best score
rises while a task goes on.  Cells that follow one another make a slice (a large
cell makes several), queries of neighbouring cells a block.  A task holds the
queries of one block and reads the vectors of one slice as a stream, so its memory
is a block and a batch whatever the data, and a query is sent once to a slice, not
once to each of its cells.  The result is exact; pruning only saves work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerplay.llm.common import materialize, mix64, release_buffers, text_buffer, workers_import_package

PIVOTS = (16, 1_024)  # fewest and most; between them an eighth of the root of the number of vectors
ANNULI = 4
PIVOT_SAMPLE = 4_096  # rows from which pivots and cut points are chosen (in expectation, 8 per pivot at least); every row is indexed
FIRST_CELLS = (2, 64)  # cells searched before the k-th best score is first used: at least, and one of how many
SLICE_ROWS = 1 << 19  # vectors of a task, about
BLOCK_BYTES = 256 << 20  # a task's queries with their best rows
RESULT_BYTES = 128  # of one of these rows while they are sorted
TASK_PAIRS = 1 << 24  # least work of a task, as long as there are more tasks than cores
SEGMENT_ROWS = 2_048  # vectors multiplied at once (neighbouring cells together)
TILE = 1 << 19  # products held at once
NUMBERS_HELD = 1 << 20  # numbers of a table of distances or bounds
NO_SCORE = np.iinfo(np.int64).min


def _parse(batch: pa.RecordBatch, scale: float) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Ids, lengths and the floor(scale * component) of the rows that take part, one after the other."""
    lists = batch.column(1)
    rows = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
    lists = lists.take(pa.array(rows))
    off = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.slice(off[0], off[-1] - off[0]).to_numpy(zero_copy_only=False).astype(np.float64)  # a null is nan
    off -= off[0]
    sizes, fine = np.diff(off), np.isfinite(values)
    if not fine.all():
        n_bad = np.concatenate([[0], np.cumsum(~fine)])
        good = n_bad[off[1:]] == n_bad[off[:-1]]
        values, rows, sizes = values[np.repeat(good, sizes)], rows[good], sizes[good]
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(values * scale)
        v = np.where(x >= 2.0 ** 63, np.iinfo(np.int64).max, np.where(x < -(2.0 ** 63), NO_SCORE, x.astype(np.int64)))
    return batch.column(0).take(pa.array(rows)), sizes, v


def _padded(flat: np.ndarray, sizes: np.ndarray, dim: int) -> np.ndarray:
    """Matrix of the rows, padded with zeros."""
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), dtype=flat.dtype)
    out[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return out


def _unpacked(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    """Matrix of packed vectors."""
    off, data = text_buffer(column)
    kind = np.dtype(kind)
    flat = np.frombuffer(data[off[0]:off[-1]].tobytes(), dtype=kind)
    return _padded(flat, np.diff(off) // kind.itemsize, dim)


def _norm2(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.float64) ** 2).sum(1)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids (0 for a null one) and whether they are null."""
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)


def pivot_count(n: int) -> int:
    """Pivots for ``n`` vectors."""
    return min(PIVOTS[1], max(PIVOTS[0], math.isqrt(n) // 8))


def _exact_kind(most: float) -> type:
    """Type in which inner products are exact; ``most``: largest product of two norms, which no partial sum exceeds."""
    return np.float32 if most < 0.99 * 2.0 ** 24 else np.float64 if most < 0.99 * 2.0 ** 53 else np.int64


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    xf, pf = x.astype(np.float64), pivots.astype(np.float64)
    return np.sqrt(np.maximum((xf ** 2).sum(1)[:, None] + (pf ** 2).sum(1)[None, :] - 2.0 * (xf @ pf.T), 0.0))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal: each pivot is the sampled vector farthest from those before."""
    if not len(sample):
        return sample
    picked = [0]
    gap = _distances(sample, sample[:1])[:, 0]
    while len(picked) < min(n, len(sample)) and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, _distances(sample, sample[picked[-1:]])[:, 0])
    return sample[picked]


def deal_out(n_vectors: int, n_queries: int, query_bytes: int, cores: int) -> tuple[int, int]:
    """Blocks of queries and slices of vectors: a task for each pair of them.  More blocks send
    more copies of the vectors, more slices more results; queries are fewer, so slices are more."""
    tasks = 1 + min(4 * cores, n_vectors * n_queries // TASK_PAIRS)
    blocks = max(-(-n_queries * query_bytes // BLOCK_BYTES), math.isqrt(tasks // 3), 1)
    return blocks, max(-(-tasks // blocks), -(-n_vectors // SLICE_ROWS))


def slices_of(n: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slices of about ``rows`` vectors from cells that hold ``n``: of each cell its first slice and
    in how many it is, of each slice its first cell and the one behind its last."""
    first, parts, low, high, held = [], [], [], [], 0
    for c, m in enumerate(n.tolist()):
        if not low or held + m > rows:
            parts.append(max(1, round(m / rows)))
            first.append(len(low))
            low += [c] * parts[-1]
            high += [c + 1] * parts[-1]
            held = m if parts[-1] == 1 else rows  # a cell in several slices has them for itself
        else:
            first.append(len(low) - 1)
            parts.append(1)
            high[-1], held = c + 1, held + m
    return np.array(first), np.array(parts), np.array(low), np.array(high)


@dataclass
class Cells:
    """Cells that hold vectors, in their order: number, radii and largest squared norm."""

    pivots: np.ndarray
    cell: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    norm2: np.ndarray

    def bounds(self, q: np.ndarray, q2: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Upper bound of the score of each query (squared norm q2) in each cell of the positions ``at`` (a little raised against rounding)."""
        pivot, column = np.unique(self.cell[at] // ANNULI, return_inverse=True)
        p, norm2, q2 = self.pivots[pivot], self.norm2[at][None, :], q2[:, None]
        p2 = _norm2(p)[None, :]
        kind = np.float32 if _exact_kind(math.sqrt(q2.max(initial=0.0) * p2.max())) is np.float32 else np.float64
        d = np.sqrt(np.maximum(q2 + p2 - 2.0 * (q.astype(kind) @ p.astype(kind).T).astype(np.float64), 0.0))
        d, p2 = d[:, column], p2[:, column]
        gap = np.maximum(d - self.outer[at], self.inner[at] - d)
        gap -= 1e-6 * (np.sqrt(q2) + (np.sqrt(norm2) + np.sqrt(p2)))  # a distance is a difference of squares
        by_gap = (q2 + norm2 - np.maximum(gap, 0.0) ** 2) / 2.0
        return np.minimum(by_gap, np.sqrt(q2 * norm2)) + 1e-9 * (q2 + norm2) + 1e-6


class Block:
    """Queries of a task and the best rows each has met so far.

    ``asked`` has query_id, packed vector, qh, and: floor, the least bound of cells to be searched;
    least and least_id, the k-th best row known (null least: none)."""

    def __init__(self, asked: list[list[pa.Array]], cells: Cells, k: int, dim: int, kind: str):
        ids, v, self.qh, floor, least, least_id = (pa.concat_arrays(c) for c in zip(*asked))
        self.cells, self.k, self.dim, self.kind = cells, k, dim, kind
        self.ids, self.no_id = _ids(ids)
        self.query_id = ids
        self.q = _unpacked(v, dim, kind)
        self.norm2 = np.concatenate([_norm2(self.q[i:i + 4096]) for i in range(0, len(self.q), 4096)])
        self.floor = floor.to_numpy(zero_copy_only=False)
        # a row counts from here on if its score is above ``least``, or equal and its id not behind ``last``
        self.least = least.fill_null(NO_SCORE).to_numpy(zero_copy_only=False).copy()
        self.last, self.last_null = (x.copy() for x in _ids(least_id))
        self.kept: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def feed(self, cell: np.ndarray, ids: np.ndarray, no_id: np.ndarray, x: np.ndarray) -> None:
        """Vectors in the order of their cells."""
        starts = np.flatnonzero(np.diff(cell, prepend=-1))
        a = 0
        while a < len(cell):
            # whole cells up to SEGMENT_ROWS, or a part of a larger one
            fit = starts[(starts > a) & (starts <= a + SEGMENT_ROWS)]
            b = len(cell) if len(cell) <= a + SEGMENT_ROWS else int(fit[-1]) if len(fit) else a + SEGMENT_ROWS
            self._search(np.searchsorted(self.cells.cell, np.unique(cell[a:b])), ids[a:b], no_id[a:b], x[a:b])
            a = b

    def _search(self, at: np.ndarray, ids: np.ndarray, no_id: np.ndarray, x: np.ndarray) -> None:
        order = np.lexsort((ids, no_id))  # among equal scores, the rows in front stay
        ids, no_id, x = ids[order], no_id[order], x[order]
        step = max(1, min(4096, NUMBERS_HELD // max(len(at), self.dim)))
        asking = []
        for i in range(0, len(self.q), step):
            part = slice(i, i + step)
            best = self.cells.bounds(self.q[part], self.norm2[part], at).max(1)
            asking.append(i + np.flatnonzero((best >= self.floor[part]) & (best >= self.least[part])))
        asking = np.concatenate(asking)
        if not len(asking):
            return
        kind = _exact_kind(math.sqrt(float(_norm2(x).max()) * float(self.norm2[asking].max())))
        xt = x.astype(kind).T
        step = max(1, TILE // max(len(x), self.dim))
        for i in range(0, len(asking), step):
            rows = asking[i:i + step]
            self._take(rows, self.q[rows].astype(kind) @ xt, ids, no_id)

    def _take(self, rows: np.ndarray, s: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        least = self.least[rows]
        fresh = np.flatnonzero(least == NO_SCORE)
        if len(fresh) and len(ids) > self.k:  # the k-th best of these rows, own id left out
            none = -np.inf if s.dtype.kind == "f" else NO_SCORE
            own = (ids[None, :] == self.ids[rows[fresh], None]) & (no_id[None, :] == self.no_id[rows[fresh], None])
            kth = np.partition(np.where(own, none, s[fresh]), len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            found = kth > none
            least[fresh[found]] = self.least[rows[fresh[found]]] = kth[found].astype(np.int64)
        found = np.flatnonzero(s >= (least if s.dtype.kind == "i" else least.astype(s.dtype))[:, None])
        r, c = np.divmod(found, len(ids))
        score = s.ravel()[found].astype(np.int64)
        at, null, q = ids[c], no_id[c], rows[r]
        ok = ((at != self.ids[q]) | (null != self.no_id[q])) & (
            (score > least[r]) | self.last_null[q] | (~null & (at <= self.last[q])))
        if not ok.all():
            q, score, at, null = q[ok], score[ok], at[ok], null[ok]
        if len(q) > 4 * self.k * len(rows):  # many equal scores
            q, score, at, null = self._best(q, score, at, null)
        if len(q):
            self.kept.append((q, score, at, null))
            self.waiting += len(q)
            if self.waiting > max(1 << 16, self.k * len(self.q) // 2):
                self._settle()

    def _best(self, q, score, at, null) -> tuple[np.ndarray, ...]:
        """The k best of each query; a query that has so many counts better rows only from here on."""
        order = np.lexsort((at, null, ~score, q) if null.any() else (at, ~score, q))
        q = q[order]
        starts = np.flatnonzero(np.diff(q, prepend=-1))
        place = np.arange(len(q)) - np.repeat(starts, np.diff(starts, append=len(q)))
        order, q = order[place < self.k], q[place < self.k]
        full = order[place[place < self.k] == self.k - 1]
        of = q[place[place < self.k] == self.k - 1]
        better = (score[full] > self.least[of]) | ((score[full] == self.least[of]) & (self.last_null[of] | (~null[full] & (at[full] < self.last[of]))))
        full, of = full[better], of[better]
        self.least[of], self.last[of], self.last_null[of] = score[full], at[full], null[full]
        return q, score[order], at[order], null[order]

    def _settle(self) -> None:
        if self.kept:
            self.kept = [self._best(*(np.concatenate(c) for c in zip(*self.kept)))]
        self.waiting = 0

    def results(self) -> Iterator[pa.RecordBatch]:
        self._settle()
        for q, score, at, null in self.kept:
            for i in range(0, len(q), 1 << 15):
                part = slice(i, i + (1 << 15))
                who = pa.array(q[part])
                yield pa.RecordBatch.from_arrays([self.query_id.take(who), self.qh.take(who), pa.array(at[part], mask=null[part]), pa.array(score[part])],
                                                 names=["query_id", "qh", "vec_id", "score"])


def _runs(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that agree in all columns."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    cuts = [*np.flatnonzero(new).tolist(), len(new)]
    yield from zip(cuts[:-1], cuts[1:])


def searched(batches: Iterator[pa.RecordBatch], cells: Cells, k: int, dim: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Best rows of each query.  Rows (task, is_vector, cell, id, v, ask) come in this order: of each task its queries, then its vectors by cell."""
    task, asked, block = None, [], None
    for batch in batches:
        at, is_vector = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for i, j in _runs(at, is_vector):
            part = batch.slice(i, j - i)
            if at[i] != task:
                if block is not None:
                    yield from block.results()
                task, asked, block = at[i], [], None
            if not is_vector[i]:
                asked.append([part.column(3), part.column(4), *part.column(5).flatten()])
            elif asked or block is not None:
                if block is None:
                    block, asked = Block(asked, cells, k, dim, kind), []
                block.feed(part.column(2).to_numpy(zero_copy_only=False), *_ids(part.column(3)), _unpacked(part.column(4), dim, kind))
    if block is not None:
        yield from block.results()
    release_buffers()


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of each query's ``k`` best candidates.

    A vector becomes floor(scale * component) per component; ``is_query`` is a
    condition on ``vec_id``.  Candidates are all rows with another vec_id.  Equal
    scores go to the smaller vec_id (null last).  Vectors that are null or hold a
    null or non-finite component take no part; vectors of unequal length are
    compared as if padded with zeros.  Scores are exact below 2^63.  A repeated
    row is a candidate of its own; equal query rows (id and vector) are one query, and
    rows of one id with different vectors are queries of their own.  An empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    workers_import_package(spark)
    schema = "query_id long, rank int, vec_id long, score long"
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("e"))

    def sizes(batches):
        for batch in batches:
            _, lengths, v = _parse(batch, scale)
            yield pa.RecordBatch.from_pydict({"n": [len(lengths)], "dim": [int(lengths.max(initial=0))], "low": [int(v.min(initial=0))], "high": [int(v.max(initial=0))]})

    size = base.mapInArrow(sizes, "n long, dim long, low long, high long").agg(F.sum("n").alias("n"), F.max("dim").alias("dim"), F.min("low").alias("low"), F.max("high").alias("high")).first()
    n_all, dim = size["n"] or 0, max(1, size["dim"] or 1)
    if not n_all:
        return spark.createDataFrame([], schema)
    kind = next(t for t in ("int8", "int16", "int32", "int64") if np.iinfo(t).min <= size["low"] and size["high"] <= np.iinfo(t).max)

    n_pivots = pivot_count(n_all)
    share = min(1.0, max(PIVOT_SAMPLE, 8 * n_pivots) / n_all)

    def sampled(batches):
        for no, batch in enumerate(batches):
            ids, lengths, v = _parse(batch, scale)
            x = _padded(v, lengths, dim)
            with np.errstate(over="ignore"):
                h = mix64(mix64(_ids(ids)[0].astype(np.uint64)) + (x.astype(np.uint64) * mix64(np.arange(1, dim + 1, dtype=np.uint64))[None, :]).sum(1, dtype=np.uint64))
            take = (h >> np.uint64(34)).astype(np.float64) < share * 2.0 ** 30
            take[:1] |= no == 0
            yield pa.RecordBatch.from_pydict({"v": pa.array([y.tobytes() for y in x[take].astype(kind)], pa.binary())})

    picked = base.mapInArrow(sampled, "v binary").orderBy("v").collect()
    sample = np.stack([np.frombuffer(r["v"], dtype=kind) for r in picked]).astype(np.int64)
    pivots = choose_pivots(sample, n_pivots)
    gaps = _distances(sample, pivots)
    home = gaps.argmin(1)
    levels = np.arange(1, ANNULI) / ANNULI
    cuts = np.array([np.quantile(gaps[home == p, p], levels) if (home == p).any() else np.zeros(ANNULI - 1) for p in range(len(pivots))])

    def key(batches):
        done = 0
        for batch in batches:
            ids, lengths, v = _parse(batch, scale)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            packed = v.astype(kind)
            step = max(1, NUMBERS_HELD // max(dim, len(pivots)))
            for i in range(0, len(lengths), step):
                j = min(len(lengths), i + step)
                x = _padded(v[ends[i]:ends[j]], lengths[i:j], dim)
                d = _distances(x, pivots)
                p = d.argmin(1)
                r = d[np.arange(len(x)), p]
                a = (cuts[p] <= r[:, None]).sum(1)
                deal = (mix64(np.arange(done, done + len(x), dtype=np.uint64)) >> np.uint64(33)).astype(np.int32)
                done += len(x)
                off = ((ends[i:j + 1] - ends[i]) * packed.itemsize).astype(np.int32)
                binary = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(packed[ends[i]:ends[j]].tobytes())])
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), binary, pa.array((p * ANNULI + a).astype(np.int32)), pa.array(r), pa.array(_norm2(x)), pa.array(deal)],
                                                 names=["vec_id", "v", "cell", "r", "norm2", "deal"])
        release_buffers()

    index = materialize(base.mapInArrow(key, "vec_id long, v binary, cell int, r double, norm2 double, deal int"))
    found = index.groupBy("cell").agg(F.count("*").alias("n"), F.min("r").alias("inner"), F.max("r").alias("outer"), F.max("norm2").alias("norm2")).orderBy("cell").toPandas()  # n_pivots * ANNULI rows
    cells = Cells(pivots, *(found[c].to_numpy() for c in ("cell", "inner", "outer", "norm2")))

    queries = materialize(index.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv"), F.xxhash64("v").alias("qh"), "cell").dropDuplicates(["query_id", "qv"]))
    asking = queries.groupBy("cell").agg(F.count("*").alias("n")).orderBy("cell").collect()  # as many rows at most
    n_asked = sum(r["n"] for r in asking)
    if not n_asked:
        return spark.createDataFrame([], schema)
    n_blocks, n_slices = deal_out(n_all, n_asked, dim * np.dtype(kind).itemsize + k * RESULT_BYTES, spark.sparkContext.defaultParallelism)
    first_slice, parts, low, high = slices_of(found["n"].to_numpy(), -(-n_all // n_slices))
    n_slices = len(low)

    # queries of neighbouring cells share a block
    before, starts = 0, []
    for r in asking:
        starts.append((r["cell"], before, r["n"]))
        before += r["n"]
    starts = F.broadcast(spark.createDataFrame(starts, "cell int, before long, n long"))
    place = F.col("before") + F.pmod(F.xxhash64("query_id", "qh"), F.col("n"))
    queries = queries.join(starts, "cell").select("query_id", "qv", "qh", F.floor(place * n_blocks / n_asked).cast("int").alias("block"))
    where = F.broadcast(spark.createDataFrame([(int(c), int(f), int(p)) for c, f, p in zip(cells.cell, first_slice, parts)], "cell int, first_slice int, parts int"))
    n_first = min(len(cells.cell), max(FIRST_CELLS[0], len(cells.cell) // FIRST_CELLS[1]))
    every = np.arange(len(cells.cell))
    begins, of_range = np.unique(low, return_inverse=True)

    def wanted(batch: pa.RecordBatch, first: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Queries and slices that may hold a row for them, and the floor of the queries."""
        least = batch.column(4).cast(pa.float64()).fill_null(-math.inf).to_numpy(zero_copy_only=False)
        q = _unpacked(batch.column(1), dim, kind)
        step = max(1, NUMBERS_HELD // max(dim, len(every), n_slices))
        for i in range(0, len(q), step):
            b = cells.bounds(q[i:i + step], _norm2(q[i:i + step]), every)
            floor = np.partition(b, len(every) - n_first, axis=1)[:, len(every) - n_first] if first else least[i:i + step]
            r, s = np.nonzero((np.maximum.reduceat(b, begins, axis=1) >= floor[:, None])[:, of_range])
            yield i + r, s, floor[r]

    def search(asked: DataFrame, first: bool) -> DataFrame:
        """Best rows of every query in the cells that are searched, for each slice."""
        def tasks(batches):
            for batch in batches:
                block = batch.column(3).to_numpy(zero_copy_only=False)
                seen = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.unique(s.astype(np.int64) * n_blocks + block[r]) for r, s, _ in wanted(batch, first))]))
                yield pa.RecordBatch.from_pydict({"task": pa.array(seen, pa.int64())})

        def sent(batches):
            for batch in batches:
                block = batch.column(3).to_numpy(zero_copy_only=False)
                for rows, s, floors in wanted(batch, first):
                    for i in range(0, len(rows), 1 << 14):
                        r = pa.array(rows[i:i + (1 << 14)])
                        task = np.searchsorted(pairs, s[i:i + (1 << 14)].astype(np.int64) * n_blocks + block[rows[i:i + (1 << 14)]]).astype(np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array(task), batch.column(0).take(r), batch.column(1).take(r), batch.column(2).take(r), pa.array(floors[i:i + (1 << 14)]),
                                                          batch.column(4).take(r), batch.column(5).take(r)], names=["task", "query_id", "qv", "qh", "floor", "least", "least_id"])

        columns = asked.select("query_id", "qv", "qh", "block", "least", "least_id")
        pairs = np.array(sorted(r["task"] for r in columns.mapInArrow(tasks, "task long").distinct().collect()), dtype=np.int64)  # a number for each task
        of_slice = {int(s): np.flatnonzero(pairs // n_blocks == s).tolist() for s in np.unique(pairs // n_blocks)}
        blocks = F.broadcast(spark.createDataFrame(list(of_slice.items()), "slice int, tasks array<int>"))
        right = columns.mapInArrow(sent, "task int, query_id long, qv binary, qh long, floor double, least long, least_id long")
        right = right.select("task", F.lit(False).alias("is_vector"), F.lit(0).alias("cell"), F.col("query_id").alias("id"), F.col("qv").alias("v"), F.struct("qh", "floor", "least", "least_id").alias("ask"))
        left = index.join(where, "cell").withColumn("slice", F.col("first_slice") + F.pmod("deal", "parts")).join(blocks, "slice")
        left = left.select(F.explode("tasks").alias("task"), F.lit(True).alias("is_vector"), "cell", F.col("vec_id").alias("id"), "v", F.lit(None).cast(right.schema["ask"].dataType).alias("ask"))
        rows = right.unionByName(left).repartitionById(len(pairs), "task").sortWithinPartitions("task", "is_vector", "cell")  # one task each
        return rows.mapInArrow(lambda batches: searched(batches, cells, k, dim, kind), "query_id long, qh long, vec_id long, score long")

    best = Window.partitionBy("query_id", "qh").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    # dealt by query before they are ranked: a task's rows are best ones already, sorting them where they are made takes memory in vain
    top = lambda found: found.repartition("query_id", "qh").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    nothing = F.lit(None).cast("long")
    start = top(search(queries.withColumns({"least": nothing, "least_id": nothing}), True))
    kth = start.where(F.col("rank") == k).select("query_id", "qh", F.col("score").alias("least"), F.col("vec_id").alias("least_id"))
    asked = materialize(queries.join(kth, ["query_id", "qh"], "left"))
    return top(search(asked, False)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
