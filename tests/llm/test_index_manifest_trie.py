"""Exact dedup, Merkle manifest and prefix trie against plain Python."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


# --- exact dedup --------------------------------------------------------------

DOC_SCHEMA = "doc_id long, text string, key string, slot int, seq long"


def doc_rows():
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["a b", "ab", " a\tb\n", "a b", "", None, "  ", "Ab", "x" * 4000, "é " * 3])) for i in range(300)]
    rows += [(1000 + i, "only %d" % i) for i in range(200)] + [(None, "a  b   "), (None, "nobody's"), (5, "ab" + " " * 9), (5, "ab" + " " * 9), (-2 ** 62, "ab" + " " * 9)]
    return [(*r, "clash", 1, 2) for r in rows]


def dedup_brute(rows):
    groups = {}
    for i, r in enumerate(rows):
        text = r[1] or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), r[0] is None, r[0] or 0, i, r[0]))
    out = []
    for norm, members in groups.items():
        stays = min(members)
        out += [(m[4], stays[4], len(members), m[:3] == stays[:3], sha(norm)) for m in members]
    return out


@pytest.mark.parametrize("capacity,bits", [(1 << 16, 64), (20, 64), (10, 4), (1 << 16, 0)])
def test_exact_duplicates_equal_brute_force(spark, capacity, bits):
    from ledgerplay.llm import exact_dedup as E
    rows = doc_rows()
    found = E.exact_duplicates(spark.createDataFrame(rows, DOC_SCHEMA).repartition(5), capacity, bits or 1)
    got = [tuple(r)[:5] for r in found.collect()]
    want = dedup_brute(rows)
    assert ordered([g[:3] + g[4:] for g in got]) == ordered([w[:3] + w[4:] for w in want])
    assert sum(g[3] for g in got) == len({w[4] for w in want})  # one row of each text, also among equal rows
    assert all(any(w[:3] == g[:3] and w[3] for w in want) for g in got if g[3])


def test_directory_doubles_until_buckets_fit(spark):
    from ledgerplay.llm import exact_dedup as E
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    directory, bits = E.build_directory(keys, 100)
    slots = directory.orderBy("slot").collect()
    assert len(slots) == 1 << bits and [s["slot"] for s in slots] == list(range(1 << bits))
    counts = keys.groupBy(F.shiftrightunsigned("key", 64 - bits).alias("slot")).count().collect()
    per_bucket = {}
    where = {s["slot"]: (s["depth"], s["bucket"]) for s in slots}
    for c in counts:
        per_bucket[where[c["slot"]]] = per_bucket.get(where[c["slot"]], 0) + c["count"]
    assert max(per_bucket.values()) <= 100 and sum(per_bucket.values()) == 5000
    alike = spark.range(300).select(F.col("id").alias("key"))  # all leading bits equal: pages grow, the directory does not
    assert E.build_directory(alike, 100)[1] <= 2 + E.MAX_DOUBLINGS
    assert E.exact_duplicates(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def test_no_python_in_exact_dedup(spark):
    from ledgerplay.llm import exact_dedup as E
    plan = E.exact_duplicates(spark.createDataFrame(doc_rows(), DOC_SCHEMA))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# --- Merkle manifest ----------------------------------------------------------

MERKLE_SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos string, digest int"


def merkle_rows():
    rows = [(i if i % 97 else None, None if i % 9 == 0 else "a" if i % 3 else "é%d" % (i % 40), None if i % 5 == 0 else "en", i % 7 or None, None if i % 11 == 0 else "Text %d" % (i % 50)) for i in range(9000)]
    return [(*r, "clash", "clash", 0) for r in rows + rows[:5] + [(2 ** 60 + 1, "a", "", 0, ""), (2 ** 60 + 2, "b", None, 1, "ß" * 3000)]]


def merkle_brute(rows):
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)))

    def build(ds):
        levels = [ds]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            s = i // 16 * 16
            out.append(("".join(level[s:i]), "".join(level[i + 1:s + 16])))
            i //= 16
        return out

    trees = {}
    for r in rows:
        low = None if r[4] is None else re.sub("[A-Z]", lambda m: m[0].lower(), r[4])
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        trees.setdefault(r[1], []).append((r[0], leaf(r, r[4]), leaf(r, low) if tampered else None))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    leaves = {k: sorted(trees[k], key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for k in names}
    levels = {k: build([x[1] for x in leaves[k]]) for k in names}
    top = build([levels[k][-1][0] for k in names])
    out = []
    for j, k in enumerate(names):
        above = path(top, j)
        for i, (doc_id, digest, tampered) in enumerate(leaves[k]):
            steps = path(levels[k], i) + above
            node = tampered or digest
            for before, after in steps:
                node = sha(before + node + after)
            out.append((doc_id, digest, levels[k][-1][0], top[-1][0], sha("".join(b + a for b, a in steps)), node, node == top[-1][0]))
    return out


@pytest.mark.parametrize("n", [None, 1, 17, 0])
def test_merkle_equals_brute_force(spark, n):
    from ledgerplay.llm import merkle as M
    from ledgerplay.llm.queries import LOWER, UPPER, crc_mod
    rows = merkle_rows()[:n]
    docs = spark.createDataFrame(rows, MERKLE_SCHEMA).repartition(5)
    got = [tuple(r) for r in M.prove(docs, F.translate("text", UPPER, LOWER), crc_mod(5) == 0).collect()]
    assert ordered(got) == (ordered(merkle_brute(rows)) if rows else [])


def test_merkle_without_tampering_verifies(spark):
    from ledgerplay.llm import merkle as M
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert M.prove(docs).where("verified").count() == docs.count()


# --- prefix trie --------------------------------------------------------------

TURN_SCHEMA = "conv_id long, turn long, role string, text string, path string, key int, head long"


def turn_rows():
    rnd = random.Random(3)
    rows = []
    for c in [*range(250), -7, -130, 10 ** 15 + 1]:
        for t in range(rnd.randrange(1, 9)):
            rows.append((c, None if rnd.random() < .05 else t, rnd.choice(["u", "a", None]), rnd.choice(["", "x", "yy", None, "é" * 3])))
    rows += rows[:20] + [(None, 0, "u", "x"), (900, 0, "", "u"), (901, 0, "u", "")]
    rows += [(500 + i, t, "u", "h%d" % t) for i in range(90) for t in range(4)] + [(700, t, "u", "z%d" % (t % 2)) for t in range(300)]
    return [(*r, "clash", 0, 0) for r in rows]


def rebuilt(rows):
    conv = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            conv.setdefault(c, []).append((t is not None, t or 0, digest, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in conv.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:])
    return out


def trie_brute(rows):
    convs = rebuilt(rows)
    nodes, children = {}, {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            nodes.setdefault(v[:d], []).append(c)
    for p in nodes:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        own = (len(members) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += own
    out = []
    for p, members in nodes.items():
        ends = sorted(c for c in members if len(convs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children.get(p, 0), leaves[p], saved[p], sha(",".join(map(str, ends)))))
    return out


@pytest.mark.parametrize("shard_turns", [250_000, 60, 7])
def test_trie_equals_brute_force(spark, shard_turns):
    from ledgerplay.llm import prefix_trie as P
    rows = turn_rows()
    found = P.trie_nodes(P.with_shared_heads(spark.createDataFrame(rows, TURN_SCHEMA).repartition(3)), shard_turns)
    assert ordered(tuple(r) for r in found.collect()) == ordered(trie_brute(rows))


def test_trie_of_nothing_and_of_one(spark):
    from ledgerplay.llm import prefix_trie as P
    for rows in ([], [(7, None, None, None, "", 0, 0)]):
        found = P.trie_nodes(P.with_shared_heads(spark.createDataFrame(rows, TURN_SCHEMA)))
        assert ordered(tuple(r) for r in found.collect()) == ordered(trie_brute(rows))


def test_find_close_equals_a_stack():
    from ledgerplay.llm import prefix_trie as P
    rnd = random.Random(2)
    for n in (1, 2, 3, 50, 400):
        bits, depth = [1], 1
        opened = 1
        while depth:
            up = opened < n and (depth == 1 or rnd.random() < .5)
            bits.append(1 if up else -1)
            depth += bits[-1]
            opened += up
            if depth == 0 and opened < n:
                break
        bits, stack, want = np.array(bits, np.int8), [], {}
        for i, b in enumerate(bits):
            if b == 1:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(bits == 1)
        assert P.find_close(bits, opens).tolist() == [want[i] for i in opens]


def test_id_digest_streams_over_chunks(spark, monkeypatch):
    from ledgerplay.llm import prefix_trie as P
    monkeypatch.setattr(P, "CHUNK_IDS", 7)
    members = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(1).cast("string").cast("binary").alias("key"), F.col("id").alias("conv_id"))
    want = {}
    for r in members.collect():
        want.setdefault(bytes(r["key"]), []).append(r["conv_id"])
    got = {bytes(r["key"]): r["ends_sha256"] for r in P.id_digests(members).collect()}
    assert got == {k: sha(",".join(map(str, sorted(v)))) for k, v in want.items()}


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_merkle_manifest", "op13_prefix_trie"])
def test_new_query_equals_its_sql(spark, name):
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert ordered(tuple(r) for r in df.select(cols).collect()) == ordered(cur.fetchall())
