"""Near-duplicate groups by MinHash with tensored banding.

A document is the set of its word shingles.  Two small collections A and B of
``halves`` half-keys (``rows`` minhashes each) are computed per set; every pair
(A_i, B_j) is the key of one table.  So ``2 * halves * rows`` minhashes give
``halves^2`` tables, about the square root of what separate bands would need.
With 16 halves of 3 rows a pair at the threshold 0.85 meets in a table with
probability 1 - 5e-7 (5-word sets at 0.8: 1 - 2e-5; more halves raise it).

1. Equal sets are one class (by a 128-bit digest); the rest works on classes.
2. A half-key that only one class has cannot be part of a shared table key, so
   keys are paired only from half-keys that at least two classes share.
3. Every class is compared, on the full sets, with the first leader of its tables
   (a table's leader is its class that shares most tables); a group of thousands of
   copies of one text costs one comparison per member.
4. Tables whose members are then not all one group go on: members that cannot be
   linked to any other (too many shingles that no other open class has; an exact
   bound) leave, the rest falls into families of tables that share members, and a
   family's blocks are compared with each other.  No pair of a table is left out.
5. Groups are found by label propagation over the confirmed links (min label per
   neighbourhood and pointer jumping), in DataFrames only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerplay.llm.common import (
    id_text, materialize, mix64, odd_constants, packed_texts, rolling, set_digest, signed, to_signed, unpack_text, word_hashes, words_by_row,
)

SHINGLE = 3
SIMILAR = (85, 100)  # linked if SIMILAR[1] * intersection >= SIMILAR[0] * union
HALVES = 16
ROWS = 3
ROWS_PER_PARTITION = 50_000  # rows of keys, links and labels per partition (no texts)
BROADCAST_ROWS = 100_000  # tables of a few numbers per class are broadcast up to this count, else shuffled
BLOCK = 256  # members of an unresolved family that a task compares at once with as many others


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; the whole sequence if it is shorter, nothing without words."""
    if not len(words):
        return words
    return np.unique(rolling(words, min(width, len(words))) + np.uint64(min(width, len(words))))


def _signatures(width: int, halves: int, rows: int):
    factors = odd_constants(2 * halves * rows, 4_242)

    def run(batches):
        for batch in batches:
            for i, j, h, _, _, bound, _ in words_by_row(batch.column(1), lower=True):
                sets = [shingles(h[a:b], width) for a, b in zip(bound[:-1], bound[1:])]
                sizes = np.array([len(x) for x in sets], dtype=np.int64)
                d1 = [to_signed(set_digest(x, 0)) for x in sets]
                d2 = [to_signed(set_digest(x, 1)) for x in sets]
                keys = np.zeros((len(sets), 2 * halves), dtype=np.uint64)
                full = np.flatnonzero(sizes)
                if len(full):
                    flat = np.concatenate([sets[k] for k in full])
                    starts = np.r_[0, np.cumsum(sizes[full])[:-1]]
                    with np.errstate(over="ignore"):
                        for f, factor in enumerate(factors):
                            low = np.minimum.reduceat(flat * factor, starts)
                            keys[full, f // rows] = mix64(keys[full, f // rows] + low)
                        keys += np.arange(2 * halves, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # each half has its own keys
                        keys = mix64(keys.ravel()).reshape(keys.shape)
                        keys &= ~np.uint64(1)  # the last bit names the collection
                        keys[:, halves:] |= np.uint64(1)
                flat_keys = pa.array(signed(keys.ravel()))
                bounds = pa.array(np.arange(0, keys.size + 1, 2 * halves, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(sizes), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                                                  pa.ListArray.from_arrays(bounds, flat_keys)], names=["doc_id", "th", "n", "d1", "d2", "keys"])
    return run


def _verify(width: int, similar: tuple[int, int]):
    """Rows (a, b, text of a, text of b) -> confirmed (a, b); the sets of one leader are made once per run of rows."""
    def sets_of(packed: list[bytes]) -> list[np.ndarray]:
        out = []
        for z in packed:
            h, _, _ = word_hashes(np.frombuffer(unpack_text(z), dtype=np.uint8), np.zeros(1, np.int64), lower=True)
            out.append(shingles(h, width))
        return out

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # bounded text at once
                part = batch.slice(at, 64)
                leaders, packed = part.column(0).to_pylist(), part.column(2)
                lead, ok = (None, None), []
                for k, (a, s) in enumerate(zip(leaders, sets_of(part.column(3).to_pylist()))):
                    if lead[0] != a:
                        lead = (a, sets_of([packed[k].as_py()])[0])
                    both = len(np.intersect1d(lead[1], s, assume_unique=True))
                    ok.append(similar[1] * both >= similar[0] * (len(lead[1]) + len(s) - both))
                keep = pa.array(np.flatnonzero(ok))
                yield pa.RecordBatch.from_arrays([part.column(0).take(keep), part.column(1).take(keep)], names=["a", "b"])
    return run


def _parts(rows: int) -> int:
    """Few rows in many partitions would make more files than data."""
    return 1 + rows // ROWS_PER_PARTITION


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A counted table of a few numbers per row: broadcast if it is small, else left to a shuffle join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Smallest reachable label per node: ``labels`` (node, label), ``links`` (a, b) between labels.

    Each step takes the least label in a label's neighbourhood and jumps one
    pointer further; it ends when nothing changes.  Only "did anything change"
    reaches the driver.
    """
    edges = materialize(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    n = edges.count()
    if not n:
        return labels
    parts = _parts(n)
    edges = edges.coalesce(parts)
    root = materialize(edges.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("p")).coalesce(parts))
    changed = True
    while changed:
        heard = edges.join(root.withColumnRenamed("v", "b"), "b").select(F.col("a").alias("v"), "p", F.lit(None).cast("long").alias("old")).coalesce(parts)
        step = heard.union(root.select("v", "p", F.col("p").alias("old"))).groupBy("v").agg(F.min("p").alias("q"), F.max("old").alias("old")).coalesce(parts)
        far = step.select(F.col("v").alias("q"), F.col("q").alias("far"))
        after = materialize(step.join(far, "q").select("v", F.least("q", "far").alias("p"), "old").coalesce(parts))
        changed = not after.where("p <> old").isEmpty()
        root = after.select("v", "p")
    return labels.join(_small(root.withColumnRenamed("v", "label"), n), "label", "left").select("node", F.coalesce("p", "label").alias("label"))


def families(members: DataFrame, n_nodes: int) -> DataFrame:
    """(node, family) of ``members`` (t, node): nodes are one family if a chain of common tables joins them.

    Contraction: every label merges into the least label of its tables, chains of merges
    are followed to their end, and tables whose members agree are done.  A round has
    one row per (table, label), never one per pair of nodes, and at most one merge
    per label; labels of a family at least halve, so there are few rounds.
    """
    parts = _parts(n_nodes)
    pairs = members.select("t", F.col("node").alias("label"))
    labels = materialize(members.select("node").distinct().withColumn("family", F.col("node")).coalesce(parts))
    while True:
        mixed = pairs.groupBy("t").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("t", "low")
        pairs = materialize(pairs.join(mixed, "t"))
        merge = materialize(pairs.groupBy("label").agg(F.min("low").alias("into")).coalesce(parts))
        if merge.isEmpty():
            return labels
        moving = True
        while moving:
            ahead = merge.select(F.col("label").alias("into"), F.col("into").alias("end"))
            after = materialize(merge.join(_small(ahead, n_nodes), "into").select("label", F.col("end").alias("into"), (F.col("end") < F.col("into")).alias("moved")).coalesce(parts))
            moving = not after.where("moved").isEmpty()
            merge = after.select("label", "into")
        small = _small(merge.withColumnsRenamed({"label": "family", "into": "merged"}), n_nodes)
        labels = materialize(labels.join(small, "family", "left").select("node", F.coalesce("merged", "family").alias("family")).coalesce(parts))
        pairs = pairs.select("t", "label").join(_small(merge, n_nodes), "label").select("t", F.col("into").alias("label")).distinct()
        pairs = materialize(pairs)
        pairs = pairs.coalesce(_parts(pairs.count()))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similar: tuple[int, int] = SIMILAR, halves: int = HALVES, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, n_links, group, th
    (a group number, null without a set, and the text's hash).

    ``component_id`` is the smallest doc_id reachable over links (the own one
    included), ``kept`` is doc_id = component_id, ``n_links`` the confirmed links
    of the document's class and 0 without any.  Sets are made of lower-cased
    (A-Z) words; a text with fewer words than a shingle is one shingle; texts
    without words (null, empty, blank) have no set and stay alone.  Repeated rows
    are equal sets.  A null id takes part with its text, but never names a group
    unless no other id is in it (then component_id is null and kept is null).  An
    empty table gives an empty table.
    """
    base = id_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    marks = materialize(base.mapInArrow(_signatures(shingle, halves, rows), "doc_id long, th long, n long, d1 long, d2 long, keys array<long>"))
    classes = (marks.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "th")).alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = materialize(classes)  # from here on node is fixed
    n_classes = classes.count()
    key_parts = _parts(2 * halves * n_classes)
    each = classes.coalesce(key_parts).select("node", F.explode("keys").alias("key"))
    classes = classes.coalesce(_parts(n_classes))
    often = each.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    own = each.join(often, "key").coalesce(key_parts).groupBy("node").agg(F.collect_list("key").alias("k")).coalesce(key_parts)  # at most 2 * halves per class
    side = lambda which: F.filter("k", lambda x: x.bitwiseAND(F.lit(1)) == which)
    paired = (own.select("node", side(0).alias("ka"), side(1).alias("kb"))
              .select("node", F.explode("ka").alias("ka"), "kb").select("node", "ka", F.explode("kb").alias("kb")))
    member = paired.select("node", F.xxhash64("ka", "kb").alias("t"))
    sized = member.groupBy("t").agg(F.count("*").alias("c")).where("c > 1")
    tables = materialize(member.join(sized, "t").select("t", "node", "c"))
    table_parts = _parts(tables.count())
    tables = tables.coalesce(table_parts)
    # classes that share most tables lead first: the original of a family of variants has the most
    weight = tables.groupBy("node").agg(F.sum("c").alias("weight")).coalesce(_parts(n_classes))
    turns = weight.join(classes.select("node", "n", "rep"), "node").select("node", F.struct((-F.col("weight")).alias("w"), F.col("node").alias("node"), "n").alias("turn"), "rep")
    turns = materialize(turns.coalesce(_parts(n_classes)))
    n_turns = turns.count()
    turns = turns.coalesce(_parts(n_turns))
    texts = materialize(_texts(base, turns, n_turns))
    labels = turns.select("node", F.col("node").alias("label"))
    low, high = similar

    # every class against the first leader of its tables
    open_ = tables.select("t", "node").join(_small(turns.select("node", "turn"), n_turns), "node")
    lead = open_.groupBy("t").agg(F.min("turn").alias("lt"))
    best = tables.select("t", "node").join(lead, "t").coalesce(table_parts).groupBy("node").agg(F.min("lt").alias("lt"))
    pairs = (best.join(_small(turns.select("node", "turn.n"), n_turns), "node").where(F.col("node") != F.col("lt.node"))
             .where(F.least("n", "lt.n") * high >= F.greatest("n", "lt.n") * low)  # else the sizes rule a link out
             .select(F.col("lt.node").alias("a"), F.col("node").alias("b")))
    ready = (pairs.join(texts.select(F.col("node").alias("b"), F.col("z").alias("tb")), "b")
             .join(texts.select(F.col("node").alias("a"), F.col("z").alias("ta")), "a"))
    links = materialize(ready.select("a", "b", "ta", "tb").mapInArrow(_verify(shingle, similar), "a long, b long"))
    links = links.coalesce(_parts(n_turns))
    labels = materialize(components(links, labels))

    # tables whose members are not all one group: what can still be linked, in families
    numbered = labels.join(_small(turns.select("node", "turn.n"), n_turns), "node")
    open_ = tables.select("t", "node").join(_small(numbered, n_turns), "node")
    mixed = open_.groupBy("t").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("t")
    open_ = materialize(open_.join(mixed, "t"))
    if not open_.isEmpty():
        open_ = open_.coalesce(_parts(open_.count()))
        alone = _alone(texts.join(_small(open_.select("node").distinct(), n_turns), "node", "left_semi"), shingle)
        alone = _small(materialize(alone.coalesce(_parts(n_turns))), n_turns)
        open_ = materialize(_possible(open_, alone, similar))
        open_ = open_.coalesce(_parts(open_.count()))
        left = materialize(open_.select("node", "label", "n", "r").distinct().coalesce(_parts(n_turns)))
        family = _small(families(open_.select("t", "node"), n_turns), n_turns)
        more = materialize(_within_families(left.join(family, "node").join(texts, "node"), shingle, similar))
        more = more.coalesce(_parts(n_turns))
        links = links.union(more)
        at = _small(labels.withColumnRenamed("node", "a").withColumnRenamed("label", "la"), n_turns)
        bt = _small(labels.withColumnRenamed("node", "b").withColumnRenamed("label", "lb"), n_turns)
        labels = materialize(components(more.join(at, "a").join(bt, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")), labels))
    spread = classes.select("node", "first_id", "d1", "d2").join(_small(labels, n_turns), "node", "left").withColumn("label", F.coalesce("label", "node")).coalesce(_parts(n_classes))
    ids = spread.groupBy("label").agg(F.min("first_id").alias("component_id"))
    links = links.distinct().coalesce(_parts(n_turns))
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node")))
    ends = ends.groupBy("node").agg(F.count("*").alias("n_links")).coalesce(_parts(n_turns))
    spread = spread.join(_small(ends, n_turns), "node", "left")
    known = spread.join(ids, "label").select("d1", "d2", F.col("label").alias("group"), "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = marks.select("doc_id", "th", "n", "d1", "d2").join(known, ["d1", "d2"], "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), (F.col("doc_id") == own).alias("kept"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      F.when(F.col("n") > 0, F.col("group")).alias("group"), "th")


def unique_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, columns as they were.

    The row with the smallest id stays (null ids last; among rows of one id the
    least text hash); of fully repeated rows one stays.  Documents without words
    belong to no group and all stay.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("th").alias("th"))
    best = found.where("group IS NOT NULL").groupBy("group").agg(F.min(order).alias("o")).select(F.col("o.id").alias("__id"), F.col("o.th").alias("__th"))
    th = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    words = F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    tagged = docs.withColumn("__text_hash", th)
    stay = tagged.where(words).join(best, tagged[id_col].cast("long").eqNullSafe(best["__id"]) & (tagged["__text_hash"] == best["__th"]), "left_semi")
    stay = stay.dropDuplicates([id_col, "__text_hash"])
    return stay.unionByName(tagged.where(~words)).drop("__text_hash")


def _alone(texts: DataFrame, width: int) -> DataFrame:
    """(node, alone): how many shingles of a class no other class of ``texts`` has."""
    def run(batches):
        for batch in batches:
            for node, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h, _, _ = word_hashes(np.frombuffer(unpack_text(z), dtype=np.uint8), np.zeros(1, np.int64), lower=True)
                x = signed(shingles(h, width))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(np.full(len(x), node))], names=["s", "node"])

    each = texts.select("node", "z").mapInArrow(run, "s long, node long")
    return each.groupBy("s").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last").groupBy("node").agg(F.count("*").alias("alone"))


def _possible(open_: DataFrame, alone: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Table members that can still be linked to some member of their table.

    Shingles that no other open class has are in no intersection, so two sets of
    n and m shingles with r and q others meet in at most min(r, q).  For each
    table the greatest r of every set size is enough to test a member against all
    others; a member that fails for every size has no partner there.  This is
    exact: it only drops pairs whose similarity cannot reach the threshold.
    """
    low, high = similar
    own = open_.join(alone, "node", "left").withColumn("r", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone")
    sizes = own.groupBy("t", F.col("n").alias("m")).agg(F.max("r").alias("q")).groupBy("t").agg(F.collect_list(F.struct("m", "q")).alias("others"))  # distinct set sizes of a table
    both = lambda o: F.least(F.col("r"), o["q"])
    meets = F.exists("others", lambda o: both(o) * high >= (F.col("n") + o["m"] - both(o)) * low)
    return own.join(sizes, "t").where(meets).select("t", "node", "label", "n", "r")


def _within_families(members: DataFrame, width: int, similar: tuple[int, int]) -> DataFrame:
    """Links (a, b) between members (node, label, n, r, family, z) of unequal labels.

    A family is dealt into blocks of about ``BLOCK`` members; a task compares two
    blocks, skipping pairs that are already in one group or that their sizes and
    unshared shingles rule out.  Pairs are never rows; only links are.
    """
    low, high = similar

    def compare(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node").reset_index(drop=True)
        _, i, j = key
        sets = [shingles(word_hashes(np.frombuffer(unpack_text(z), dtype=np.uint8), np.zeros(1, np.int64), lower=True)[0], width) for z in pdf["z"]]
        n, r, block, node = (pdf[c].to_numpy() for c in ("n", "r", "b", "node"))
        group = pdf["label"].to_numpy().copy()
        found = []
        for x in range(len(pdf)):
            both = np.minimum(r[x], r[x + 1:])
            ok = (both * high >= (n[x] + n[x + 1:] - both) * low) & (group[x + 1:] != group[x])
            if i != j:
                ok &= block[x + 1:] != block[x]
            for y in x + 1 + np.flatnonzero(ok):
                if group[x] != group[y]:
                    m = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if m * high >= (len(sets[x]) + len(sets[y]) - m) * low:
                        found.append((node[x], node[y]))
                        group[group == group[y]] = group[x]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    size = members.groupBy("family").agg(F.count("*").alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    dealt = (members.join(size.select("family", F.ceil(F.col("m") / BLOCK).cast("long").alias("blocks")), "family")
             .withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("family", F.least("b", "k").alias("i"), F.greatest("b", "k").alias("j"), "b", "node", "label", "n", "r", "z"))
    return dealt.groupBy("family", "i", "j").applyInPandas(compare, "a long, b long")


def _texts(base: DataFrame, classes: DataFrame, n_classes: int) -> DataFrame:
    """One packed text per class: that of its representative row."""
    rep = classes.select("node", F.col("rep.doc_id").alias("rid"), F.col("rep.th").alias("rth"))
    packed = packed_texts(base.where("text <> ''"))
    rep = _small(rep, n_classes)
    found = packed.join(rep, (packed["th"] == rep["rth"]) & packed["doc_id"].eqNullSafe(rep["rid"]))
    return found.select("node", "z").dropDuplicates(["node"])
