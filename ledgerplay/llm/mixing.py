"""Mixing overlapping sources to target weights by a min-cost flow.

1. Documents are summed by membership pattern (the set of sources they are in).
2. Every source gets a target: its share of all tokens by weight, at most
   ``max_repeat`` times its size; what is cut off goes to the others by weight.
3. Token capacity flows from patterns to source quotas: the r-th repetition of a
   pattern costs 2r-1 per token (convex), so the flow of least cost repeats as
   evenly as the quotas allow.  The network has a node per pattern and source,
   never per document, and holds only sources that share documents with others: a
   source of its own is one arc, whose flow is the lesser of quota and capacity, so it
   is a column expression and any number of such sources will do.
4. A pattern's flow is met by whole passes over all its documents and a seeded
   choice for the rest: documents in hash order up to the quota, then (twice) those
   that still fit in hash order, and one further document whose size comes closest
   to what is then missing.

Running sums over a pattern go through hash buckets, ``LEVELS`` times: a bucket's
total first, then the buckets inside the one in which the quota ends, and at last the
rows of one part in 2^24 of the pattern, so no task holds a pattern.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerplay.llm.common import materialize, workers_import_package
from ledgerplay.operators.prefix import prefix_agg

MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
SEED = 17
FILL_ROUNDS = 3
POSITION_BITS = 62
BUCKET_BITS = 12  # 4096 buckets in hash order per level
LEVELS = 2
MAX_PATTERNS = 20_000  # patterns of sources that overlap go to the driver's flow network; more raise an error
BROADCAST_PATTERNS = 20_000  # tables of a row per pattern are broadcast up to this count
HOT_SHARE = 1000  # patterns with more than 1/1000 of all documents are at most 1000


def source_targets(sizes: dict, weights: dict, max_repeat: int = MAX_REPEAT) -> dict:
    """Target per source: shares of the total by weight, capped at max_repeat * size,
    the excess reshared by weight among the sources below their cap."""
    total = float(sum(sizes.values()))
    fixed: dict = {}
    open_ = [s for s in sizes]
    while open_:
        left = total - sum(fixed.values())
        weight = float(sum(weights[s] for s in open_))
        over = [s for s in open_ if left * weights[s] / weight > max_repeat * sizes[s]]
        if not over:
            return fixed | {s: left * weights[s] / weight for s in open_}
        fixed |= {s: float(max_repeat * sizes[s]) for s in over}
        open_ = [s for s in open_ if s not in fixed]
    return fixed


def min_cost_flow(capacity: dict, members: dict, quota: dict, max_repeat: int = MAX_REPEAT) -> dict:
    """Tokens taken from each pattern: a maximal flow of least cost.

    ``capacity``: pattern -> tokens of one pass; ``members``: pattern -> its sources;
    ``quota``: source -> tokens wanted.  Successive shortest paths with potentials
    over integer capacities.
    """
    node = {("start",): 0, ("end",): 1}
    for p in capacity:
        node[("p", p)] = len(node)
    for s in quota:
        node[("s", s)] = len(node)
    graph: list[list[list]] = [[] for _ in node]

    def arc(a: int, b: int, cap: int, cost: int) -> None:
        graph[a].append([b, cap, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p, cap in capacity.items():
        for r in range(1, max_repeat + 1):
            arc(0, node[("p", p)], cap, 2 * r - 1)
        for s in members[p]:
            arc(node[("p", p)], node[("s", s)], max_repeat * cap, 0)
    for s, want in quota.items():
        arc(node[("s", s)], 1, want, 0)
    potential = [0] * len(node)
    while True:
        dist, via = [None] * len(node), [None] * len(node)
        dist[0] = 0
        queue = [(0, 0)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > dist[a]:
                continue
            for k, (b, cap, cost, _) in enumerate(graph[a]):
                nd = d + cost + potential[a] - potential[b]
                if cap > 0 and (dist[b] is None or nd < dist[b]):
                    dist[b], via[b] = nd, (a, k)
                    heapq.heappush(queue, (nd, b))
        if dist[1] is None:
            break
        far = max(d for d in dist if d is not None)
        potential = [p + (far if d is None else d) for p, d in zip(potential, dist)]
        push, b = None, 1
        while b:
            a, k = via[b]
            push = graph[a][k][1] if push is None else min(push, graph[a][k][1])
            b = a
        b = 1
        while b:
            a, k = via[b]
            graph[a][k][1] -= push
            graph[b][graph[a][k][3]][1] += push
            b = a
    used = dict.fromkeys(capacity, 0)
    pattern_at = {node[("p", p)]: p for p in capacity}
    for b, left, _, _ in graph[0]:
        used[pattern_at[b]] += capacity[pattern_at[b]] - left
    return used


def mix(docs: DataFrame, weights: Sequence[int] | dict = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED, max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """Mix documents (doc_id, size, sources array<string>, any further columns).

    Returns the input with source_size and target (of the first source of the
    document's sorted pattern), copies (times the document is taken) and taken
    (size * copies).  ``weights``: by source, or a cycle over the sources in code
    point order with null last.  A null or empty ``sources`` is the null source.
    Documents of size 0 fill no quota: they get the passes of their pattern.
    Ids may be null or repeated: equal rows (id and size) are taken alike.  An
    empty table gives an empty table.  Reruns agree: only hashes decide.
    """
    workers_import_package(docs.sparkSession)
    sources = F.when(F.coalesce(F.size("sources"), F.lit(0)) > 0, F.array_sort(F.array_distinct("sources"))).otherwise(F.array(F.lit(None).cast("string")))
    own = docs.withColumns({"__pattern": F.to_json(sources), "__size": F.coalesce(F.col("size"), F.lit(0)).cast("long"),
                            "__pos": F.xxhash64(F.lit(seed), "doc_id", "size").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))})
    narrow = materialize(own.select("__pattern", "__size", "__pos", "doc_id"))
    caps = narrow.groupBy("__pattern").agg(F.sum("__size").alias("__n"), F.count("*").alias("__docs"))
    caps = materialize(caps.withColumn("__members", F.from_json("__pattern", "array<string>")))
    flows = materialize(_pattern_flows(caps, weights, max_repeat, max_patterns))
    n_patterns = flows.count()
    plan = _choose_rest(narrow, flows, n_patterns)
    # columns of the input that carry these names give way to the mix's own
    own = own.drop(*[c for c in ("source_size", "target", "copies", "taken") if c in own.columns])
    extra = _in_cuts() | (F.col("__near").isNotNull() & (F.col("__pos") == F.col("__near.pos")) & F.col("doc_id").eqNullSafe(F.col("__near.id")))
    out = _meet(own, plan, n_patterns).withColumn("copies", F.col("__passes") + extra.cast("int")).withColumn("taken", F.col("__size") * F.col("copies"))
    kept = [c for c in docs.columns if c not in ("source_size", "target", "copies", "taken")]
    return out.select(*kept, "source_size", "target", "copies", "taken")


def _meet(rows: DataFrame, table: DataFrame, n_patterns: int) -> DataFrame:
    """``rows`` with the columns of their pattern in ``table`` (a row per pattern, with ``__hot``).

    A small table is broadcast.  Beyond, its hot patterns are (at most ``HOT_SHARE``), so
    their rows stay where they are, and only rows of the others move to their pattern."""
    if n_patterns <= BROADCAST_PATTERNS:
        return rows.join(F.broadcast(table), "__pattern")
    hot, cold = table.where("__hot"), table.where("NOT __hot")
    return rows.join(F.broadcast(hot), "__pattern").unionByName(rows.join(F.broadcast(hot.select("__pattern")), "__pattern", "left_anti").join(cold, "__pattern"))


def _source_targets(sizes: DataFrame, weights: Sequence[int] | dict, max_repeat: int) -> DataFrame:
    """(source, source_size, shared) with weight and target, by the rule of ``source_targets`` on a
    table: each round fixes the sources above their cap and sums the others in one aggregate."""
    spark = sizes.sparkSession
    if isinstance(weights, dict):
        given = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "__name string, __weight double")
        known = sizes.join(F.broadcast(given), sizes["__source"].eqNullSafe(given["__name"]), "left").drop("__name")
        if not known.where("__weight IS NULL").isEmpty():
            raise ValueError("a source has no weight")
    else:
        place = prefix_agg(sizes.withColumn("__one", F.lit(1.0)), "__source", ["__one"], inclusive=False)  # nulls last
        cycle = F.array(*[F.lit(float(w)) for w in weights])
        known = place.withColumn("__weight", F.get(cycle, F.pmod(F.col("__one_cum").cast("long"), F.lit(len(weights))).cast("int"))).drop("__one", "__one_cum")
    known = materialize(known)
    top = max_repeat * F.col("source_size").cast("double")
    total, over = known.agg(F.sum("source_size")).first()[0] or 0, F.lit(False)
    while True:
        r = known.agg(F.sum(F.when(over, top).otherwise(0.0)).alias("full"), F.sum(F.when(~over, F.col("__weight"))).alias("open")).first()
        share = F.lit(float(total - (r["full"] or 0.0))) * F.col("__weight") / F.lit(r["open"] or 1.0)
        target = F.when(over, top).otherwise(share)
        if known.where(~over & (share > top)).isEmpty():
            break
        known, over = materialize(known.withColumn("__over", over | (share > top))), F.col("__over")
    return known.withColumn("target", target).drop("__over")


def _pattern_flows(caps: DataFrame, weights: Sequence[int] | dict, max_repeat: int, max_patterns: int) -> DataFrame:
    """One row per pattern: source_size and target of its first source, __passes over all its
    documents, __rest tokens beyond them, __hot."""
    spark = caps.sparkSession
    each = caps.select("__n", F.explode("__members").alias("__source"), (F.size("__members") > 1).alias("__overlaps"))
    known = _source_targets(materialize(each.groupBy("__source").agg(F.sum("__n").alias("source_size"), F.max("__overlaps").alias("__shared"))), weights, max_repeat)
    whole = caps.agg(F.sum("__n").alias("n"), F.sum("__docs").alias("docs")).first()
    counted = known.agg(F.sum("source_size")).first()[0] or 0
    if counted > (whole["n"] or 0):  # sources that overlap count a token once
        known = known.withColumn("target", F.col("target") * F.lit(float(whole["n"])) / F.lit(float(counted)))
    known = materialize(known.withColumn("__quota", F.bround("target", 0).cast("long")))
    first = F.element_at("__members", 1)
    table = caps.join(known, first.eqNullSafe(known["__source"])).withColumn("__flow", F.least(F.col("__quota"), max_repeat * F.col("__n")))
    shared = known.where("__shared").select("__source", "__quota")
    if not shared.isEmpty():
        touched = caps.select("__pattern", "__n", F.explode("__members").alias("__at")).join(shared, F.col("__at").eqNullSafe(F.col("__source")), "left_semi").select("__pattern", "__n").distinct()
        found = touched.limit(max_patterns + 1).collect()
        if len(found) > max_patterns:
            raise ValueError(f"more than {max_patterns} membership patterns of overlapping sources: merge rare sources first or raise max_patterns")
        capacity = {r["__pattern"]: int(r["__n"]) for r in sorted(found)}
        members = {p: json.loads(p) for p in capacity}
        quota = {r["__source"]: int(r["__quota"]) for r in shared.collect()}  # at most one per member of those patterns
        flow = min_cost_flow(capacity, members, {s: quota[s] for s in sorted(quota, key=lambda s: (s is None, s or ""))}, max_repeat)
        network = spark.createDataFrame(list(flow.items()), "__pattern string, __routed long")  # max_patterns rows
        table = table.join(F.broadcast(network), "__pattern", "left").withColumn("__flow", F.coalesce("__routed", "__flow"))
    passes = F.when(F.col("__n") > 0, F.least(F.lit(max_repeat), F.expr("__flow div __n"))).otherwise(0).cast("int")
    table = table.withColumn("__passes", passes)
    return table.select("__pattern", "source_size", "target", "__passes", (F.col("__flow") - F.col("__n") * F.col("__passes")).alias("__rest"),
                        (F.col("__docs") * HOT_SHARE > F.lit(whole["docs"] or 0)).alias("__hot"))


def _in_cuts():
    return F.exists("__cuts", lambda c: (F.col("__size") <= c["cap"]) & (F.col("__pos") <= c["upto"]))


def _choose_rest(narrow: DataFrame, flows: DataFrame, n_patterns: int) -> DataFrame:
    """``flows`` with how each pattern meets what whole passes leave: __cuts, ``FILL_ROUNDS``
    of them (documents up to ``cap`` tokens at hash positions up to ``upto``; the first cut has
    no cap), and __near, one further document nearest to what is then missing."""
    state = flows.withColumns({"__missing": F.col("__rest"), "__cuts": F.expr("CAST(array() AS array<struct<cap: bigint, upto: bigint>>)")})

    def left() -> DataFrame:
        open_ = state.where("__missing > 0").select("__pattern", "__hot", "__missing", "__cuts")
        return _meet(narrow, open_, n_patterns).where(~_in_cuts()).where("__size > 0").select("__pattern", "__hot", "__missing", "__size", "__pos", "doc_id")

    for fill in range(FILL_ROUNDS):
        if state.where("__missing > 0").isEmpty():
            break
        cut = _cut(left().where("__size <= __missing") if fill else left(), n_patterns)
        cap = F.col("__missing") if fill else F.lit(1 << 62)
        taken = F.coalesce("__taken", F.lit(0))
        state = materialize(state.join(cut, "__pattern", "left").withColumns({
            "__cuts": F.when(taken > 0, F.concat("__cuts", F.array(F.struct(cap.cast("long").alias("cap"), F.col("__upto").alias("upto"))))).otherwise(F.col("__cuts")),
            "__missing": F.col("__missing") - taken}).drop("__taken", "__upto"))
    gap = F.struct(F.abs(F.col("__size") - F.col("__missing")).alias("d"), F.col("__pos").alias("pos"), F.col("doc_id").alias("id"))
    best = left().where("abs(__size - __missing) < __missing").groupBy("__pattern").agg(F.min(gap).alias("g")).select("__pattern", F.struct("g.pos", "g.id").alias("__near"))
    return materialize(state.join(best, "__pattern", "left").drop("__missing", "__rest"))


def _cut(open_: DataFrame, n_patterns: int) -> DataFrame:
    """(__pattern, __taken, __upto): how far in hash order the documents of a pattern fit into what
    it misses.  Bucket totals first, then those inside the bucket in which the sum ends."""
    at, ends = open_.withColumn("__before", F.lit(0).cast("long")), None
    for level in range(1, LEVELS + 1):
        shift = POSITION_BITS - BUCKET_BITS * level
        sums = at.groupBy("__pattern", "__hot", "__missing", "__before", F.shiftright("__pos", shift).alias("__bucket")).agg(F.sum("__size").alias("n"))
        order = Window.partitionBy("__pattern").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most 4096 rows
        run = materialize(sums.withColumn("__after", F.col("__before") + F.sum("n").over(order)))
        if ends is None:
            fits = run.groupBy("__pattern").agg(F.max("__after").alias("__taken"), F.max("__missing").alias("m")).where("__taken <= m").select(
                "__pattern", "__taken", F.lit(1 << 62).alias("__upto"))
        last = run.where("__after - n <= __missing AND __after > __missing")
        ends = last.select("__pattern", "__hot", F.col("__bucket").alias("__in"), (F.col("__after") - F.col("n")).alias("__before"))
        at = _meet(at.drop("__before", "__hot"), ends, n_patterns).where(F.shiftright("__pos", shift) == F.col("__in")).drop("__in")
    order = Window.partitionBy("__pattern").orderBy("__pos", "doc_id", "__size").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (at.withColumn("__sum", F.col("__before") + F.sum("__size").over(order)).where("__sum <= __missing")
              .groupBy("__pattern").agg(F.max("__sum").alias("s"), F.max("__pos").alias("p")))
    ended = ends.join(inside, "__pattern", "left").select("__pattern", F.coalesce("s", "__before").alias("__taken"),
                                                          F.coalesce("p", F.shiftleft("__in", POSITION_BITS - BUCKET_BITS * LEVELS) - 1).alias("__upto"))
    return fits.unionByName(ended)
