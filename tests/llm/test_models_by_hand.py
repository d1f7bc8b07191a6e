"""Language filter, quality scores and the mixing flow against plain models of the same rules."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def grams_by_hand(text):
    raw = b" " + text.lower().encode() + b" "
    clean = bytes(b if 97 <= (b | 32) <= 122 or b >= 128 else 32 for b in raw)
    return [clean[i:i + 5] for i in range(len(clean) - 4) if clean[i + 2] != 32]


def test_language_filter_equals_plain_sets(spark):
    """Python sets of n-grams in place of the Bloom filter: same winners, nearly the same shares."""
    from ledgerplay.llm import language_id as L
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").where("text IS NOT NULL")
    rows = docs.collect()
    train = [r for r in rows if r["lang"] is not None and r["doc_id"] % 3 != 1]
    docs_of, freq = {}, {}
    for r in train:
        docs_of[r["lang"]] = docs_of.get(r["lang"], 0) + 1
        for g in set(grams_by_hand(r["text"])):
            freq[g, r["lang"]] = freq.get((g, r["lang"]), 0) + 1
    langs = sorted(docs_of, key=lambda x: (-docs_of[x], x))
    rate = {k: n / docs_of[k[1]] for k, n in freq.items()}
    best = {}
    for (g, _), x in rate.items():
        best[g] = max(best.get(g, 0.0), x)
    held = {x: {g for (g, y), v in rate.items() if y == x and v >= L.MIN_RATE and v >= L.MIN_SHARE * best[g]} for x in langs}
    model = L.fit(docs.where("doc_id % 3 <> 1"))
    assert model.langs == langs
    same, apart = 0, []
    for r in L.predict(docs, model, keep=("doc_id", "text")).collect():
        grams = grams_by_hand(r["text"])
        hits = [sum(g in held[x] for g in grams) for x in langs]
        if not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        same += r["lang_pred"] == langs[int(np.argmax(hits))]
        apart.append(abs(r["score"] - (max(hits) / sum(hits) if sum(hits) else 0.0)))
    assert same >= 0.99 * len(apart) and np.mean(apart) < 0.02


def pav_by_hand(x, n, p):
    """Isotonic means by the max-min formula."""
    return np.array([max(min(p[a:b + 1].sum() / n[a:b + 1].sum() for b in range(i, len(x))) for a in range(i + 1)) for i in range(len(x))])


def test_quality_scores_equal_a_plain_fit(spark):
    """All rows in one numpy matrix: ridge by stacked least squares, calibration by the max-min formula."""
    from ledgerplay.llm import quality as Q
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    learn = F.col("doc_id") % 5 != 0
    got = Q.quality_scores(docs, labels, learn).toPandas().set_index("doc_id").score.sort_index()
    unit = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30)) / float(1 << 30)
    every = Q.document_statistics(docs).toPandas().set_index("doc_id").stats
    known = labels.where(learn).where("quality IS NOT NULL").select("doc_id", "quality", (unit < Q.CALIBRATION_SHARE).alias("held")).distinct().toPandas()
    known = known[known.doc_id.isin(every.index)]
    x, y, held = np.array([every[i] for i in known.doc_id]), known.quality.to_numpy(float), known.held.to_numpy(bool)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z, size = Q.fourier(x, mean, scale), Q.N_FEATURES + 1
    fit_z, fit_y = z[~held], y[~held] - 0.5
    ridge = np.sqrt(Q.RIDGE * len(fit_z) / Q.N_FEATURES) * np.eye(size)
    weights = np.linalg.lstsq(np.vstack([fit_z, ridge]), np.r_[fit_y, np.zeros(size)], rcond=None)[0]
    assert held.any()
    bins = np.round(z[held] @ weights * Q.BINS)
    k = np.unique(bins)
    n, p = np.array([(bins == b).sum() for b in k], float), np.array([y[held][bins == b].sum() for b in k])
    level = pav_by_hand(k, n, p)
    blocks = [np.flatnonzero(level == v) for v in np.unique(level)]
    knots_x, knots_y = np.array([(k[b] * n[b]).sum() / n[b].sum() / Q.BINS for b in blocks]), np.unique(level)
    raw = Q.fourier(np.array(every.sort_index().tolist()), mean, scale) @ weights
    want = np.clip(np.interp(raw, knots_x, knots_y), 0, 1) if len(knots_x) > 1 else np.full(len(raw), (p.sum() + 1) / (n.sum() + 2))
    assert (np.abs(got.to_numpy() - want) < 1e-3).mean() >= 0.99


def flow_by_hand(capacity, members, quota, repeat):
    """Greatest flow and its least cost by trying every use of the patterns (Hall's condition for the quotas)."""
    patterns, best = sorted(capacity), None
    subsets = [c for n in range(1, len(patterns) + 1) for c in itertools.combinations(patterns, n)]
    for used in itertools.product(*[range(repeat * capacity[p] + 1) for p in patterns]):
        use = dict(zip(patterns, used))
        if all(sum(use[p] for p in c) <= sum(quota[s] for s in {s for p in c for s in members[p]}) for c in subsets):
            cost = sum((2 * r - 1) * min(capacity[p], max(0, use[p] - (r - 1) * capacity[p])) for p in patterns for r in range(1, repeat + 1))
            best = min(best or (0, 0), (-sum(used), cost))
    return best


def test_min_cost_flow_against_every_use():
    from ledgerplay.llm.mixing import min_cost_flow
    rnd = random.Random(8)
    for _ in range(60):
        sources = ["a", "b", "c"][:rnd.randint(1, 3)]
        sets = [c for n in range(1, len(sources) + 1) for c in itertools.combinations(sources, n)]
        members = {"".join(c): list(c) for c in rnd.sample(sets, min(len(sets), rnd.randint(1, 3)))}
        capacity = {p: rnd.randint(0, 4) for p in members}
        quota = {s: rnd.randint(0, 9) for s in sources}
        flow = min_cost_flow(capacity, members, quota, 3)
        cost = sum((2 * r - 1) * min(n, max(0, flow[p] - (r - 1) * n)) for p, n in capacity.items() for r in (1, 2, 3))
        assert (-sum(flow.values()), cost) == flow_by_hand(capacity, members, quota, 3)


def test_mixture_of_any_number_of_sources(spark, monkeypatch):
    """Sources that overlap nothing need no network; tables beyond the broadcast bound give the same rows."""
    from ledgerplay.llm import mixing as M
    rnd = random.Random(6)
    data = [(i, rnd.randint(0, 90), ["s%d" % min(40, int(rnd.random() ** 3 * 60))]) for i in range(1500)] + [(None, 7, None), (1, 5, []), (2, 0, ["only"])]
    df = spark.createDataFrame(data, "doc_id long, size long, sources array<string>")
    got = M.mix(df, max_patterns=2).toPandas()
    size = {}
    for _, n, s in data:
        size[(s or [None])[0]] = size.get((s or [None])[0], 0) + n
    names = sorted(size, key=lambda s: (s is None, s or ""))
    want = M.source_targets(size, {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)})
    first = [(s[0] if s is not None and len(s) else None) for s in got.sources]
    for s in size:
        own = got[[x == s for x in first]]
        assert own.target.iloc[0] == want[s] and own.source_size.iloc[0] == size[s] and abs(own.taken.sum() - want[s]) <= 45
    monkeypatch.setattr(M, "BROADCAST_PATTERNS", 5)
    monkeypatch.setattr(M, "HOT_SHARE", 20)
    order = ["doc_id", "size", "taken"]
    again = M.mix(df.repartition(5)).toPandas()
    assert got[order].sort_values(order).reset_index(drop=True).equals(again[order].sort_values(order).reset_index(drop=True))


def test_mixture_of_overlapping_sources(spark):
    from ledgerplay.llm import mixing as M
    rnd = random.Random(7)
    kinds = [["a"], ["b"], ["a", "b"], ["c"], ["b", "d"], ["e"]]
    data = [(i, rnd.randint(1, 60), rnd.choice(kinds)) for i in range(900)]
    df = spark.createDataFrame(data, "doc_id long, size long, sources array<string>")
    weights = {"a": 2, "b": 1, "c": 5, "d": 1, "e": 3}
    got = M.mix(df, weights).toPandas()
    capacity, sizes = {}, {}
    for _, n, s in data:
        capacity[tuple(s)] = capacity.get(tuple(s), 0) + n
        for x in s:
            sizes[x] = sizes.get(x, 0) + n
    scale = sum(capacity.values()) / sum(sizes.values())
    target = {s: t * scale for s, t in M.source_targets(sizes, weights).items()}
    flow = M.min_cost_flow(capacity, {p: list(p) for p in capacity}, {s: round(target[s]) for s in sorted(target)})
    taken = {}
    for s, n in zip(got.sources, got.taken):
        taken[tuple(s)] = taken.get(tuple(s), 0) + n
    assert abs(sum(taken.values()) - sum(flow.values())) <= 30 * len(flow)
    assert all(abs(taken[p] - flow[p]) <= 30 for p in flow if p in (("c",), ("e",)))
    assert (got.taken <= 3 * got["size"]).all()
    with pytest.raises(ValueError):
        M.mix(df, weights, max_patterns=3)
    with pytest.raises(ValueError):
        M.mix(df, {"a": 1})
