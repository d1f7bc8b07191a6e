"""Exact dedup: extendible-hash index on shared files, DataFrame functions only.

Texts are equal when they agree after every character of ``[\\x20\\x09-\\x0D]`` is
deleted.  The index is built in these steps:

1. Every row becomes a record (64-bit key of the normalised text, id, code points,
   digest) in a file of the shared folder; texts are not moved.
2. Records of one key are summed up to one entry.  The directory starts with as
   many top bits of the key as the number of entries asks for; a bucket that holds
   more than ``capacity`` entries is split by one more bit and the directory
   doubles, until no bucket is overfull.  Buckets still overfull after
   ``MAX_DOUBLINGS`` (keys that agree in most bits) keep longer pages.
3. Keys that several rows share are checked byte by byte: their texts are grouped
   by (key, bytes), pre-aggregated where they are read, so a group of copies of any
   size moves one text per task.  Different texts under one key are chained.
4. Owner tasks take ranges of keys (a bucket is such a range), put the texts of a
   key into a chain in byte order and write the pages of their range.
5. Every row looks its page up: by key where the bytes showed one text, by key and
   the digest of a link where a chain is longer.

Entries of keys with more than 1/``HOT_SHARE`` of all rows (fewer than ``HOT_SHARE``
of them, whatever the input) are broadcast; all other keys meet in a shuffle join.

Defined results: a null text is empty, and empty texts are equal to each other and
to texts of white space only.  Of equal texts the row with the most code points
stays, then the smallest id (a null id is the largest); of rows that agree in these
too, one.  Repeated rows are rows of their own in ``group_size``.  An empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerplay.session import checkpoint_dir

# --- fixed values -----------------------------------------------------------
WHITE = " \t\n\x0b\x0c\r"
# ----------------------------------------------------------------------------

CAPACITY = 1 << 16  # entries of a bucket
MAX_DOUBLINGS = 8  # doublings of the directory beyond its first size
HOT_SHARE = 1000
BROADCAST_KEYS = 1_000_000  # shared keys (8 bytes each) that are broadcast to the text scan; more are joined by shuffle
BROADCAST_BITS = 17  # a directory of at most 2^17 slots is broadcast


@dataclass
class Index:
    """Shared files of the index.

    records (seq, doc_id, n_points, key, digest): one per document row;
    directory (slot, bucket, depth): at most 2^bits slots; pages (bucket, key, link,
    links, group_size, keep_id, keep_seq, digest, norm): one per text that several rows
    share, or whose key another text has too.
    """

    records: DataFrame
    directory: DataFrame
    pages: DataFrame
    bits: int


def _norm() -> Column:
    return F.translate(F.coalesce(F.col("text"), F.lit("")), WHITE, "")


def _key(norm: Column, hash_bits: int) -> Column:
    key = F.xxhash64(norm)
    return key if hash_bits >= 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - hash_bits), 64 - hash_bits)


def _slot(bits: int) -> Column:
    return F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def build_directory(entries: DataFrame, capacity: int, hash_bits: int = 64) -> tuple[DataFrame, int]:
    """Directory (slot, bucket, depth) over the distinct keys of ``entries`` and its bits.

    Bucket ``b`` of depth ``d`` holds the keys whose first ``d`` bits are ``b``; it stands in
    all 2^(bits - d) slots that begin with these bits.  Slots without keys are left out.
    """
    n = entries.count()
    bits = min(hash_bits, max(0, math.ceil(math.log2(n / capacity)))) if n else 0
    deepest = min(hash_bits, bits + MAX_DOUBLINGS, 62)
    settled, open_keys = [], entries.select("key")
    while True:
        counts = open_keys.groupBy(_slot(bits).alias("bucket")).agg(F.count("*").alias("n"))
        counts = counts.select("bucket", F.lit(bits).alias("depth"), "n").checkpoint(eager=True)
        full = counts.where(F.col("n") > capacity)
        n_full = full.count() if bits < deepest else 0
        if not n_full:
            settled.append(counts)
            break
        settled.append(counts.where(F.col("n") <= capacity))
        open_keys = open_keys.join(_broadcast_if(full.select("bucket"), n_full <= 1 << BROADCAST_BITS), _slot(bits) == F.col("bucket"), "left_semi")
        bits += 1
    slots = []
    for level in settled:
        wide = F.pow(F.lit(2), F.lit(bits) - F.col("depth")).cast("long")
        first = F.col("bucket") * wide
        slots.append(level.select(F.explode(F.sequence(first, first + wide - 1)).alias("slot"), "bucket", "depth"))
    directory = slots[0]
    for more in slots[1:]:
        directory = directory.unionByName(more)
    return directory.checkpoint(eager=True), bits


def _stays() -> Column:
    """Largest for the row that stays; ~x turns the order of x round without overflow."""
    return F.max(F.struct("n_points", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("id"), F.bitwise_not("seq").alias("seq"))).alias("stays")


def build_index(docs: DataFrame, capacity: int = CAPACITY, hash_bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Records, directory and pages of ``docs`` in a folder below ``spark.checkpoint.dir``.

    ``hash_bits`` below 64 makes weak keys with long chains (for tests)."""
    folder = f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/exact-dedup-{uuid.uuid4().hex}"
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = base.select("doc_id", F.length("text").cast("long").alias("n_points"), _norm().alias("norm")).withColumn("key", _key(F.col("norm"), hash_bits))
    records = texts.select(F.monotonically_increasing_id().alias("seq"), "doc_id", "n_points", "key", F.unhex(F.sha2("norm", 256)).alias("digest"))
    records = _stored(records, f"{folder}/records")
    entries = _stored(records.groupBy("key").agg(F.count("*").alias("group_size"), _stays()), f"{folder}/entries")
    directory, bits = build_directory(entries, capacity, hash_bits)
    shared = entries.where("group_size > 1")
    n_shared = shared.count()
    # texts of shared keys only; equal bytes under one key collapse before they move
    copies = texts.select("key", "norm").join(_broadcast_if(shared.select("key"), n_shared <= BROADCAST_KEYS), "key", "left_semi")
    links = copies.groupBy("key", "norm").agg(F.count("*").alias("n_bytes_equal")).withColumn("slot", _slot(bits))
    links = links.join(_broadcast_if(directory, bits <= BROADCAST_BITS), "slot")
    # owner tasks take a range of keys, and with it whole buckets or parts of one; a chain stands in byte order
    chain = Window.partitionBy("key")
    owned = links.repartitionByRange("key").select("bucket", "key", (F.row_number().over(chain.orderBy("norm")) - 1).alias("link"),
                                                   F.count("*").over(chain).alias("links"), F.unhex(F.sha2("norm", 256)).alias("digest"), "norm")
    owned = _stored(owned, f"{folder}/links")
    pages = owned.where("links = 1").join(shared, "key")
    chained = owned.where("links > 1")
    if chained.limit(1).count():  # different texts under one key: each link has its own sums
        parts = records.join(chained.select("key").distinct(), "key", "left_semi").groupBy("key", "digest").agg(F.count("*").alias("group_size"), _stays())
        pages = pages.unionByName(chained.join(parts, ["key", "digest"]), allowMissingColumns=True)
    pages = pages.select("bucket", "key", "link", "links", "group_size", F.bitwise_not("stays.id").alias("keep_id"), F.bitwise_not("stays.seq").alias("keep_seq"), "digest", "norm")
    return Index(records, directory, _stored(pages, f"{folder}/pages"), bits)


def _look_up(records: DataFrame, pages: DataFrame, on: list[str], n_rows: int) -> DataFrame:
    """Page columns of every record (null: no page); pages of very large groups are broadcast."""
    hot = F.broadcast(pages.where(F.col("group_size") * HOT_SHARE > n_rows))
    rest = pages.where(F.col("group_size") * HOT_SHARE <= n_rows)
    return records.join(hot, on).unionByName(records.join(hot, on, "left_anti").join(rest, on, "left"))


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, hash_bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (id of the row that stays), group_size, kept,
    text_sha256 (normalised text), n_points, and bucket and link (null: the text stands alone)."""
    index = build_index(docs, capacity, hash_bits, id_col, text_col)
    n_rows = index.records.count()
    page = ["bucket", "link", "group_size", "keep_id", "keep_seq"]
    found = _look_up(index.records, index.pages.where("links = 1").select("key", *page), ["key"], n_rows)
    chained = index.pages.where("links > 1").select("key", "digest", *page)
    if chained.limit(1).count():
        keys = chained.select("key").distinct()
        alone = found.join(keys, "key", "left_anti")
        found = alone.unionByName(_look_up(index.records.join(keys, "key", "left_semi"), chained, ["key", "digest"], n_rows))
    own = F.col("keep_seq").isNull()
    return found.select("doc_id", F.when(own, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                        F.coalesce(F.col("keep_seq") == F.col("seq"), F.lit(True)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "n_points", "bucket", "link")
