"""Training-data operators against brute force, on hand-made and given documents.

The hand-made table holds nulls in every column, empty and long texts, ties,
repeated rows and columns whose names clash with the operators' own.
"""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def low(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    vocab = ["w%d" % i for i in range(400)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    base, passage = text(300), text(60)
    near = base.split()
    near[17], near[200] = "changed", "twice"
    docs = [base, " ".join(near), base.upper(), passage + " " + text(40), text(30) + "\n" + passage + " " + text(20), "", None, "one", "one two", "One Two", "   \n ",
            "a\nb\nc\nd\n\nx", "q\na\n  b \nc\nd\nz", "same\n" * 8, "é 字 <|endoftext|> don't   stop", text(3000), "x" * 5000]
    out = [(i + 10, t, "en" if i % 3 else None, None if i == 4 else "s%d" % (i % 4)) for i, t in enumerate(docs)]
    return out + [out[0], (None, base, None, None), (99, passage, "en", "s1")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    return df.withColumns({"n_words": F.lit("clash"), "th": F.lit(1), "size_": F.lit(2), "label": F.lit(None).cast("int"), "key": F.lit("k"), "w1": F.lit(0)})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def distinct(rows):
    return {r[0]: (r[1] or "") for r in rows if r[0] is not None}


def test_token_counts_equal_the_library(spark, docs, rows, empty):
    from ledgerplay.llm import token_counts as T
    tok, special = T.load_tokenizer("byte_bpe_50k.json")
    want = sorted((r[0] or -1, len((r[1] or "").encode()), len(tok.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    for chunk, overlap in ((16_384, 256), (64, 20)):
        got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in T.count_tokens(docs, chunk_chars=chunk, overlap_chars=overlap).collect())
        assert got == want
    assert T.count_tokens(empty).count() == 0


def test_splice_widens_until_it_aligns():
    from ledgerplay.llm import token_counts as T
    tok, special = T.load_tokenizer("byte_bpe_50k.json")
    rnd = random.Random(3)
    parts = ["a", "b", "é", " ", "  ", "\n", "1", "'s", "<|endoftext|>", "<|end", "!", "字", "👩‍👩‍👧"]
    widened = 0
    for text in ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 400))) for _ in range(60)] + ["x" * 300, " " * 200, "<|endoftext|>" * 20]:
        for chunk, overlap in ((20, 4), (64, 20)):
            n, w = T.count_long(text, tok, special, chunk, overlap)
            assert n == len(tok.encode(text, add_special_tokens=False).ids)
            widened += w
    assert widened


def test_language_id_on_held_out_documents(spark, docs, empty):
    from ledgerplay.llm import language_id as L
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    model = L.fit(d.where(~held))
    ok = L.predict(d, model, keep=("doc_id", "lang")).where(held).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert ok[0] >= 0.95 and 0 <= ok[1] <= ok[2] <= 1
    got = {r["doc_id"]: r for r in L.predict(docs, model).collect()}
    assert got[15]["lang_pred"] == got[16]["lang_pred"] == got[20]["lang_pred"] == "und"
    assert L.predict(empty, model).count() == 0
    assert {r["lang_pred"] for r in L.predict(docs, L.fit(empty)).collect()} == {"und"}


def test_line_dedup_equals_brute_force(docs, rows, empty):
    from ledgerplay.llm import line_dedup as L
    blank = " \t\n\r\x0b\x0c"
    lines = {i: [(k, x.strip(blank)) for k, x in enumerate(t.split("\n")) if x.strip(blank)] for i, t in distinct(rows).items()}
    first = {}
    for i in sorted(lines):
        for a in range(len(lines[i]) - 2):
            first.setdefault(tuple(x for _, x in lines[i][a:a + 3]), (i, a))
    got = {r["doc_id"]: r for r in L.remove_repeated_lines(docs).collect()}
    assert L.remove_repeated_lines(docs).count() == len(rows)
    for i, t in distinct(rows).items():
        gone = {ln[0] for a in range(len(lines[i]) - 2) if first[tuple(x for _, x in lines[i][a:a + 3])] != (i, a) for ln in lines[i][a:a + 3]}
        assert (got[i]["n_lines"], got[i]["n_removed"]) == (len(lines[i]), len(gone)), i
        assert got[i]["kept_text"] == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
    assert got[22]["n_removed"] == 4 and got[23]["n_removed"] == 7
    assert L.remove_repeated_lines(empty).count() == 0


def test_packing_round_trip_and_fit(spark, docs, rows, empty, tmp_path):
    from ledgerplay.llm import packing as P
    enc, end = P.load_encoder("byte_bpe_50k.tiktoken")
    packed = P.pack_documents(docs, seq_len=64, block_tokens=2_000)
    P.write_packed(packed, str(tmp_path / "p"))
    parts = P.read_packed_rows(spark, str(tmp_path / "p")).collect()
    whole = {}
    for r in parts:
        whole.setdefault(r["doc_id"], {}).setdefault((r["segment_no"], r["segment_start"]), []).append(np.frombuffer(r["ids"], "<u2"))
    for i, t in distinct(rows).items():
        got = np.concatenate([v[0] for _, v in sorted(whole[i].items())]).tolist()
        assert got == enc.encode_ordinary(t) + [end]
    assert all(r["cu_seqlens"][-1] == r["n_tokens"] <= 64 and r["position_resets"] == r["cu_seqlens"][:-1] for r in packed.collect())
    assert P.position_ids([0, 3, 5], 8).tolist() == [0, 1, 2, 0, 1, 0, 0, 0]
    assert P.pack_documents(empty).count() == 0


def test_best_fit_decreasing_against_a_plain_search():
    from ledgerplay.llm.packing import best_fit_decreasing
    rnd = random.Random(1)
    for _ in range(60):
        lengths = [rnd.randint(1, 40) for _ in range(rnd.randint(0, 80))]
        room = []
        for n in sorted(lengths, reverse=True):
            fit = [k for k in range(len(room)) if room[k] >= n]
            k = min(fit, key=lambda k: room[k]) if fit else len(room)
            room[k:k + 1] = [(room[k] if fit else 40) - n]
        bins = best_fit_decreasing(lengths, 40)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert sorted(40 - sum(lengths[i] for i in b) for b in bins) == sorted(room)


def test_quality_ranks_held_out_labels(spark, docs, empty):
    from ledgerplay.llm import quality as Q
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    crc = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    x = Q.quality_scores(d, labels, crc != 0).join(labels, "doc_id").where(crc == 0).select("score", "quality", "predicted").toPandas()
    good, bad = x[x.quality == 1].score.to_numpy(), x[x.quality == 0].score.to_numpy()
    auc = ((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :])).mean()
    assert auc > 0.95 and x.score.between(0, 1).all() and ((x.score >= 0.3) == (x.predicted == 1)).all()
    got = Q.quality_scores(docs, labels.limit(0), crc != 0).collect()
    assert len(got) == docs.count() and {r["score"] for r in got} == {0.5}
    one = labels.limit(3).withColumn("quality", F.lit(1))
    assert all(0.3 <= r["score"] <= 1 for r in Q.quality_scores(d, one, F.lit(True)).collect())
    assert Q.quality_scores(empty, labels, crc != 0).count() == 0
    x, y = Q.isotonic(np.arange(6.0), np.ones(6), np.array([0, 1, 0, 1, 1, 0]))
    assert np.allclose(y, [0, 0.5, 2 / 3]) and np.allclose(x, [0, 1.5, 4])


def test_decontamination_templates(spark, docs, empty):
    from ledgerplay.llm import decontaminate as C
    item = "A farmer sells 12 kg of apples to Anna for 3 dollars each and then Anna gives 12 kg to her brother before the market closes"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short item, four words")], "item_id long, text string").withColumn("doc_id", F.lit(0))
    new = item.replace("12 kg", "55 miles").replace("Anna", "Petra Novak").replace("3 dollars", "9 cents")
    broken = item.replace("12 kg", "55 kg", 1)  # the same value replaced once only
    d = spark.createDataFrame([(1, "Before it. " + item + " after"), (2, new), (3, broken), (4, "nothing of that kind is here at all, no item"), (5, None), (6, ""), (None, new), (7, new), (7, new),
                               (8, "He said it. Short item (four) words!")], "doc_id long, text string").withColumn("key", F.lit(1))
    got = {(r["doc_id"], r["item_id"], r["same_values"]) for r in C.contaminated(d, bench).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (None, 1, False), (7, 1, False), (8, 4, True)}  # 3: one edited number hides nothing
    assert sorted(r["doc_id"] for r in C.drop_contaminated(d, bench).collect()) == [4, 5, 6]
    assert C.contaminated(empty, bench).count() == 0 and C.contaminated(d, bench.limit(0)).count() == 0


def components_by_hand(texts, k, lo, hi):
    sets = {}
    for i, t in texts.items():
        w = [low(x) for x in WORDS.findall(t)]
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and hi * both >= lo * len(sets[a] | sets[b]):
                x, y = sorted((root[a], root[b]))
                root = {i: x if r == y else r for i, r in root.items()}
    return sets, root


def test_near_duplicates_equal_brute_force(docs, rows, empty):
    from ledgerplay.llm import near_dup as N
    sets, root = components_by_hand(distinct(rows), 3, 85, 100)
    got = N.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), root[r["doc_id"]], root[r["doc_id"]] == r["doc_id"])
        else:
            assert r["component_id"] == 10
    stay = sorted(r["doc_id"] for r in N.unique_documents(docs).collect())
    assert stay == sorted({r for i, r in root.items()})
    assert N.near_duplicates(empty).count() == 0


def test_near_duplicate_families_of_variants(spark):
    """Variants that are linked only through others, and variants just below the threshold."""
    from ledgerplay.llm import near_dup as N
    rnd = random.Random(9)
    base = ["b%d" % i for i in range(200)]
    texts = {}
    for i in range(90):
        w = list(base)
        for j in rnd.sample(range(200), rnd.choice([0, 1, 2, 3, 5, 6, 8])):
            w[j] = "v%d_%d" % (i, j)
        texts[i] = " ".join(w)
    for i in range(90, 120):  # a chain: each is near the next one only
        texts[i] = " ".join("c%d" % j for j in range((i - 90) * 8, (i - 90) * 8 + 160))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    _, root = components_by_hand(texts, 3, 85, 100)
    assert {r["doc_id"]: r["component_id"] for r in N.near_duplicates(df).collect()} == root
    assert len(set(root.values())) > 5


def test_mixture_meets_its_targets(spark, docs, rows, empty):
    from ledgerplay.llm import mixing as M
    rnd = random.Random(2)
    data = [(i, rnd.randint(0, 300), ["a", "b", "c", None][min(3, int(rnd.random() ** 2 * 4))]) for i in range(400)] + [(None, 50, "a"), (3, 10, "a"), (3, 10, "a")]
    df = spark.createDataFrame(data, "doc_id long, size long, source string").select("doc_id", "size", F.array("source").alias("sources")).withColumn("target", F.lit("clash"))
    got = M.mix(df).toPandas()
    size = {}
    for _, n, s in data:
        size[s] = size.get(s, 0) + n
    want = M.source_targets(size, {"a": 1, "b": 2, "c": 3, None: 1})
    assert abs(sum(want.values()) - sum(size.values())) < 1e-6 and all(want[s] <= 3 * size[s] + 1e-9 for s in size)
    for s in size:
        own = got[[x[0] == s for x in got.sources]]
        assert abs(own.taken.sum() - want[s]) <= 30 and own.target.iloc[0] == want[s] and own.source_size.iloc[0] == size[s]
    assert (got.taken <= 3 * got["size"]).all() and len(got) == len(data)
    again = M.mix(df.repartition(7)).toPandas()
    order = ["doc_id", "size", "taken"]
    assert got[order].sort_values(order).reset_index(drop=True).equals(again[order].sort_values(order).reset_index(drop=True))
    assert M.mix(empty.select("doc_id", F.lit(1).alias("size"), F.array("source").alias("sources"))).count() == 0


def test_min_cost_flow_spreads_repetitions():
    from ledgerplay.llm.mixing import min_cost_flow, source_targets
    flow = min_cost_flow({"x": 10, "xy": 10, "y": 10}, {"x": ["x"], "xy": ["x", "y"], "y": ["y"]}, {"x": 25, "y": 20})
    assert sum(flow.values()) == 45 and max(flow.values()) <= 20
    assert min_cost_flow({"x": 5}, {"x": ["x"]}, {"x": 100}) == {"x": 15}
    assert source_targets({"a": 1, "b": 99}, {"a": 3, "b": 1}) == {"a": 3.0, "b": 97.0}


def test_substring_dedup_equals_brute_force(docs, rows, empty):
    from ledgerplay.llm import substring_dedup as S
    words = {i: WORDS.findall(t) for i, t in distinct(rows).items()}
    first = {}
    for i in sorted(words):
        for a in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][a:a + 50]), i)
    got = S.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        w = words[r["doc_id"] or 10]
        gone = {j for a in range(len(w) - 49) if first[tuple(w[a:a + 50])] < (r["doc_id"] or 0) for j in range(a, a + 50)}
        text = " ".join(x for j, x in enumerate(w) if j not in gone)
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(w), len(gone), hashlib.sha256(text.encode()).hexdigest()), r["doc_id"]
    assert any(r["n_removed"] for r in got)
    assert S.remove_repeats(empty).count() == 0


def test_winnowing_guarantee():
    from ledgerplay.llm.substring_dedup import winnow
    rnd = np.random.default_rng(1)
    for n in (0, 3, 9, 10, 200):
        g = rnd.integers(0, 20, n).astype(np.uint64)
        at = winnow(g, 9)
        assert all(((at >= a) & (at < a + 9)).any() for a in range(n - 8))


def test_top_k_equals_brute_force(spark):
    from ledgerplay.llm import topk as K
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.normal(size=8).round(1).tolist()) for i in range(300)]
    rows += [(300, None), (301, [None] * 8), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (304, [1.0, 2.0]), (305, []), (320, [0.5] * 8), (None, [0.5] * 8)] + [(i, [1.0] * 8) for i in range(306, 319)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"score": F.lit("x"), "cell": F.lit(1)}).repartition(4)
    ok = [(i, np.floor(np.pad(np.array(v, float), (0, 8 - len(v))) * 64).astype(int)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in ok:
        if q is not None and q % 20 == 0:
            best = sorted(((-int(v @ x), i is None, i) for i, x in ok if i != q), key=lambda t: (t[0], t[1], t[2] or 0))[:20]
            want += [(q, k + 1, i, -s) for k, (s, _, i) in enumerate(best)]
    key = lambda t: (t[0], t[1])
    assert sorted((tuple(r) for r in K.top_k(df, F.col("vec_id") % 20 == 0).collect()), key=key) == sorted(want, key=key)
    assert K.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert K.top_k(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_repeated_queries_and_candidates(spark):
    from ledgerplay.llm import topk as K
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=3 if i % 4 else 2)]) for i in range(1, 60)]
    asked = (20, [0.5, -0.25, 1.0])
    rows = [r for r in rows if r[0] not in (20, 40)] + [asked, asked, (20, [-1.0, 0.0, 0.0]), (7, [2.0, 2.0, 2.0]), (7, [2.0, 2.0, 2.0])]
    got = K.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=5).collect()
    cells = lambda v: [int(np.floor(64 * x)) for x in v] + [0] * (3 - len(v))
    want = []
    for vector in (asked[1], [-1.0, 0.0, 0.0]):  # equal rows are one query, other vectors of the id are their own
        scored = sorted((-sum(a * b for a, b in zip(cells(vector), cells(v))), i) for i, v in rows if i != 20)
        want += [(20, rank + 1, i, -score) for rank, (score, i) in enumerate(scored[:5])]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_top_k_pivots_grow_with_the_table():
    from ledgerplay.llm import topk as K
    assert [K.pivot_count(n) for n in (1, 10_000, 1_000_000, 10 ** 12)] == [16, 16, 125, 1024]


def top_k_by_hand(rows, asked, k):
    """(query_id, rank, vec_id, score) over (id, integer vector) rows; Python integers."""
    out = []
    for q, v in asked:
        best = sorted(((-sum(a * b for a, b in zip(v, x)), i is None, i or 0) for i, x in rows if i != q))[:k]
        out += [(q, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(best)]
    return out


def test_top_k_stores_no_row_for_each_query_and_cell(spark, monkeypatch):
    """Queries times cells, each row with a copy of its query: a worker's batch of them took over 1 GB at 600,000 vectors."""
    from ledgerplay.llm import topk as K
    n, dim = 6_000, 64
    x = np.random.default_rng(5).normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)
    stored, materialize = [], K.materialize

    def counted(table):
        table = materialize(table)
        stored.append(table.count())
        return table

    monkeypatch.setattr(K, "materialize", counted)
    got = {tuple(r) for r in K.top_k(df, F.col("vec_id") % 20 == 0).collect()}
    v = np.floor(x * 64).astype(np.int64)
    assert len(got) == 300 * 20
    for q in range(0, n, 400):
        s = v @ v[q]
        best = sorted((-int(s[i]), i) for i in range(n) if i != q)[:20]
        assert {(q, rank + 1, i, -y) for rank, (y, i) in enumerate(best)} <= got
    assert max(stored) == n  # the index; the queries are 300, their cells 64


def test_top_k_in_many_slices_and_blocks(spark, monkeypatch):
    """Cells in several slices, slices of several cells, blocks of few queries, and ties across all of them."""
    from ledgerplay.llm import topk as K
    monkeypatch.setattr(K, "SLICE_ROWS", 40)
    monkeypatch.setattr(K, "BLOCK_BYTES", 4 * 7 * K.RESULT_BYTES)
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-3, 4, 4).tolist()) for i in range(240)] + [(300 + i, [2, 2, 2, 2]) for i in range(150)] + [(None, [2, 2, 2, 2])] * 3 + [(451, [2, 2, 2, 2])] * 9
    df = spark.createDataFrame([(i, [x / 64 for x in v]) for i, v in rows], "vec_id long, embedding array<double>").repartition(5)
    got = sorted(tuple(r) for r in K.top_k(df, F.col("vec_id") % 10 == 0, k=7).collect())
    assert got == sorted(top_k_by_hand(rows, [r for r in rows if r[0] is not None and r[0] % 10 == 0], 7))


@pytest.mark.parametrize("size", [40, 10 ** 6, 10 ** 9])
def test_top_k_stream_equals_brute_force(size):
    """Products in floats of 24 and 53 bits and in 64-bit integers; batches cut anywhere; null and repeated ids, ties."""
    import pyarrow as pa
    from ledgerplay.llm import topk as K
    rng = np.random.default_rng(size)
    dim, k = 5, 6
    x = rng.integers(-size, size + 1, (900, dim))
    x[::7] = x[0]
    ids = [None if i % 50 == 3 else int(i) // 2 for i in rng.permutation(900)]
    pivots = x[:3]
    d = K._distances(x, pivots)
    cell, r = d.argmin(1) * K.ANNULI, d.min(1)
    cell += (r > np.median(r)).astype(int)
    order = np.argsort(cell, kind="stable")
    names = np.unique(cell)
    cells = K.Cells(pivots, names, *(np.array([f(y[cell == c]) for c in names]) for y, f in ((r, np.min), (r, np.max), (K._norm2(x), np.max))))
    asked = list(range(0, 900, 9))
    ask = pa.struct([("qh", pa.int64()), ("floor", pa.float64()), ("least", pa.int64()), ("least_id", pa.int64())])
    rows = [(t, False, 0, ids[i], x[i].tobytes(), {"qh": i, "floor": -np.inf, "least": None, "least_id": None}) for t in (1, 2) for i in asked if i % 2 == t - 1]
    rows += [(t, True, int(cell[i]), ids[i], x[i].tobytes(), None) for t in (1, 2) for i in order]
    rows.sort(key=lambda y: y[:2])
    kinds = [pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.binary(), ask]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:a + 130]), kinds)], names=list("abcdef")) for a in range(0, len(rows), 130)]
    got = [tuple(y.values()) for b in K.searched(iter(batches), cells, k, dim, "int64") for y in b.to_pylist()]
    plain = [(i, v.tolist()) for i, v in zip(ids, x)]
    want = [(ids[i], i, v, s) for i in asked for _, _, v, s in top_k_by_hand(plain, [(ids[i], x[i].tolist())], k)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_top_k_slices_hold_every_cell_once():
    from ledgerplay.llm import topk as K
    rng = np.random.default_rng(2)
    for n, rows in (([5], 2), ([1] * 50, 7), (rng.integers(1, 100, 200).tolist(), 60), ([1, 1, 900, 1, 2, 40], 50)):
        first, parts, low, high = K.slices_of(np.array(n), rows)
        held = [sorted(c for c in range(len(n)) if first[c] <= s < first[c] + parts[c]) for s in range(len(low))]
        assert held == [list(range(a, b)) for a, b in zip(low, high)]
        assert sorted({c for h in held for c in h}) == list(range(len(n))) and all(parts[h[0]] > 1 or sum(n[c] for c in h) <= 1.5 * rows for h in held)
    blocks, slices = K.deal_out(15_000_000, 750_000, 64 + 20 * K.RESULT_BYTES, 6)
    assert 750_000 / blocks * (64 + 20 * K.RESULT_BYTES) <= K.BLOCK_BYTES and 15_000_000 / slices <= K.SLICE_ROWS
    assert K.deal_out(1, 1, 64, 8)[0] == 1


def test_marks_hash_texts_in_small_slices():
    """A worker's arrays take some 40 times the text hashed at once; a batch of many texts must not be one slice."""
    import pyarrow as pa
    from ledgerplay.llm import substring_dedup as S
    texts = [f"word{i} " * 400 for i in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(texts), pa.array([0] * 400, pa.int64())], names=["doc_id", "text", "th"])
    out = list(S._marks(50, 10)([batch]))
    assert sum(map(len, texts)) > 1 << 20 and max(sum(len(texts[i]) for i in b.column(0).to_pylist()) for b in out) <= 1 << 18
    assert [i for b in out for i in b.column(0).to_pylist()] == list(range(400)) and all(n == 400 for b in out for n in b.column(2).to_pylist())


def test_pre_tokens_are_cut_as_the_library_cuts_them(monkeypatch):
    from ledgerplay.llm import token_counts as C
    name = "byte_bpe_50k.json"
    tok, _ = C.load_tokenizer(name)
    chars = [chr(c) for c in range(C.PLAIN_END)]
    texts = [x for c in chars for x in (f"a{c}b", f" {c}{c}'s 1{c}2", f"{c} {c}  x", f"!{c}\n {c}", f"'ll{c}\t{c}'d ")]
    for x in texts:
        assert [len(p) for p in C.PRE_TOKEN.findall(x)] == [b - a for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(x)], x
    texts += ["", "   ", "x<|endoftext|>y", "<|endoftext|", "你好 12   z", "caf́e \U0001f600‍", "don't we've  I'LL", "'" * 9, " \u0085 \x1c\x1f x"] + ["word" + c for c in chars]
    want = [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert C.count_short(texts, name) == want
    monkeypatch.setattr(C, "MEMO", 5)  # forgotten pre-tokens are encoded again
    assert [n for x in texts[-700:] for n in C.count_short([x], name)] == want[-700:]
    assert len(C._memo(name)[0]) <= 5
