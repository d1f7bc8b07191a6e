"""Game-log analytics.

Snapshot tables are keyed by (game_id, turn, ...).  Every operator is an
aggregate or an equi-join on the snapshot key; no operator forms all pairs of
planets or players.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerplay.operators.prefix import prefix_agg

SNAP = ["game_id", "turn"]


def battle_sides(battles: DataFrame) -> DataFrame:
    """One row per (battle, player) from both players in one scan."""
    s1 = F.struct(F.col("player_1_name").alias("player_name"), F.col("player_2_name").alias("enemy_name"),
                  F.col("player_1_score").alias("player_score"), F.col("player_2_score").alias("enemy_score"),
                  F.lit(1).alias("player_number"))
    s2 = F.struct(F.col("player_2_name").alias("player_name"), F.col("player_1_name").alias("enemy_name"),
                  F.col("player_2_score").alias("player_score"), F.col("player_1_score").alias("enemy_score"),
                  F.lit(2).alias("player_number"))
    sides = battles.select("battle_id", "winner", "finish_state", "turns", F.explode(F.array(s1, s2)).alias("s"))
    sides = sides.select("battle_id", "s.*", "winner", "finish_state", "turns")
    return sides.withColumns({
        "won": F.col("player_number") == F.col("winner"),
        "tie": F.col("winner") == 0,
    }).withColumn("lost", ~F.col("won") & ~F.col("tie"))


def standings(sides: DataFrame) -> DataFrame:
    """Per player counts, points = won + tie/2, totals, means, wipe-outs, wins per side.

    One aggregate; partial aggregation map-side keeps a dominant player cheap.
    """
    return standings_by(sides, [])


def standings_by(sides: DataFrame, by: Sequence[str]) -> DataFrame:
    """G25 per extra key (e.g. round_id): all rounds in one aggregate."""
    i = lambda c: F.col(c).cast("int")
    return sides.groupBy(*by, "player_name").agg(
        F.count(F.lit(1)).alias("battle_count"),
        F.sum(i("won")).cast("long").alias("won"), F.sum(i("lost")).cast("long").alias("lost"),
        F.sum(i("tie")).cast("long").alias("tie"),
        (F.sum(i("won")) + 0.5 * F.sum(i("tie"))).cast("double").alias("points"),
        F.sum("player_score").cast("long").alias("total_score"),
        F.sum("enemy_score").cast("long").alias("total_enemy_score"),
        F.avg("player_score").alias("mean_score"), F.avg("enemy_score").alias("mean_enemy_score"),
        F.count_if(F.col("enemy_score") == 0).alias("killed_all_enemy_units"),
        F.count_if(F.col("player_score") == 0).alias("all_units_died"),
        F.count_if((F.col("player_number") == 1) & F.col("won")).alias("wins_as_player_1"),
        F.count_if((F.col("player_number") == 2) & F.col("won")).alias("wins_as_player_2"),
    )


def rank_standings(st: DataFrame, tie: str = "player_name") -> DataFrame:
    """Rank 1..n by points (descending), ties broken by ``tie``.

    Running count over ranges of (points, tie): any number of players.
    """
    ranked = prefix_agg(st.withColumn("__one", F.lit(1)), "points", ["__one"], desc=True, tie_cols=[tie])
    return ranked.withColumn("rank", F.col("__one_cum").cast("int")).drop("__one", "__one_cum")


def head_to_head(sides: DataFrame, player: str) -> DataFrame:
    """One player against each opponent."""
    s = sides.where(F.col("player_name") == player)
    return s.groupBy("enemy_name").agg(
        F.count(F.lit(1)).alias("battles"), F.count_if("won").alias("won"), F.count_if("lost").alias("lost"),
        F.count_if("tie").alias("tie"), F.avg("player_score").alias("mean_score"), F.avg("enemy_score").alias("mean_enemy_score"))


def ships_by_owner(planets: DataFrame, fleets: DataFrame) -> DataFrame:
    """Total ships per (snapshot, owner): planets plus fleets."""
    u = planets.select(*SNAP, "owner", "num_ships").unionByName(fleets.select(*SNAP, "owner", "num_ships"))
    return u.groupBy(*SNAP, "owner").agg(F.sum("num_ships").cast("long").alias("ships"))


def inflight_by_target(fleets: DataFrame, me: int = 1) -> DataFrame:
    """Per target planet: own and enemy ships in flight, net, first arrival."""
    own = F.col("owner") == me
    return fleets.groupBy(*SNAP, F.col("destination_planet_id").alias("planet_id")).agg(
        F.sum(F.when(own, F.col("num_ships")).otherwise(0)).cast("long").alias("own_incoming"),
        F.sum(F.when(~own, F.col("num_ships")).otherwise(0)).cast("long").alias("enemy_incoming"),
        F.min("turns_remaining").alias("first_arrival"),
    ).withColumn("net_incoming", F.col("own_incoming") - F.col("enemy_incoming"))


def score_density(planets: DataFrame, fleets: DataFrame, me: int = 1) -> DataFrame:
    """Per planet |growth / d| with d = ships adjusted by ships in flight to it
    (own planet: + own - enemy; other: - own + enemy), d = 0 -> 1, times 4 for
    own and neutral planets.  Per target only: G28 joined on the snapshot key,
    no planet pairs.  ``density_rank`` orders ascending per snapshot."""
    inc = inflight_by_target(fleets, me).select(*SNAP, "planet_id", "own_incoming", "enemy_incoming")
    j = planets.join(inc, [*SNAP, "planet_id"], "left").fillna({"own_incoming": 0, "enemy_incoming": 0})
    adj = F.when(F.col("owner") == me, F.col("own_incoming") - F.col("enemy_incoming")).otherwise(
        F.col("enemy_incoming") - F.col("own_incoming"))
    d = F.col("num_ships") + adj
    d = F.when(d == 0, F.lit(1)).otherwise(d)
    d = F.when(F.col("owner").isin(0, me), d * 4).otherwise(d)
    out = j.withColumn("score", F.abs(F.col("growth_rate") / d.cast("double")))
    w = Window.partitionBy(*SNAP).orderBy("score", "planet_id")
    return out.withColumn("density_rank", F.row_number().over(w)).select(*SNAP, "planet_id", "score", "density_rank")


def contest_resolve(planets: DataFrame, fleets: DataFrame, arriving_only: bool = True) -> DataFrame:
    """Resolve arrivals per (snapshot, planet) by the engine's rule.

    Forces per owner (0, 1, 2; the planet's garrison counts for its owner) are
    summed; the largest force wins and keeps max - next lower force; on a tie
    for the largest, the planet keeps its owner with 0 ships.  Planets without
    arriving fleets are unchanged and not returned.
    """
    f = fleets.where(F.col("turns_remaining") == 0) if arriving_only else fleets
    arr = f.select(*SNAP, F.col("destination_planet_id").alias("planet_id"), "owner", "num_ships")
    targets = arr.select(*SNAP, "planet_id").distinct()
    gar = planets.join(targets, [*SNAP, "planet_id"], "left_semi").select(*SNAP, "planet_id", "owner", "num_ships")
    forces = gar.unionByName(arr).groupBy(*SNAP, "planet_id", "owner").agg(F.sum("num_ships").alias("force"))
    per = forces.groupBy(*SNAP, "planet_id").agg(F.collect_list(F.struct("owner", "force")).alias("f"))
    # at most three owners per planet: the list is bounded
    mx = F.array_max(F.transform("f", lambda s: s["force"]))
    n_max = F.size(F.filter("f", lambda s: s["force"] == mx))
    second = F.coalesce(F.array_max(F.transform(F.filter("f", lambda s: s["force"] < mx), lambda s: s["force"])), F.lit(0))
    top_owner = F.element_at(F.filter("f", lambda s: s["force"] == mx), 1)["owner"]
    res = per.join(planets.select(*SNAP, "planet_id", F.col("owner").alias("old_owner")), [*SNAP, "planet_id"], "left")
    # an absent owner has force 0; a 0 max ties with absent owners
    absent_zero = F.size("f") < 3
    tie = (n_max > 1) | ((mx == 0) & absent_zero)
    second = F.when(absent_zero, F.greatest(second, F.lit(0))).otherwise(second)
    return res.select(
        *SNAP, "planet_id",
        F.when(tie, F.col("old_owner")).otherwise(top_owner).alias("owner"),
        F.when(tie, F.lit(0)).otherwise(mx - second).cast("long").alias("num_ships"),
    )


def centroid(planets: DataFrame, me: int = 1) -> DataFrame:
    """Mean (x, y) of own planets per snapshot."""
    return planets.where(F.col("owner") == me).groupBy(*SNAP).agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"),
                                                                   F.count(F.lit(1)).alias("n_planets"))


def nearest_to_centroid(planets: DataFrame, me: int = 1) -> DataFrame:
    """Own planet closest to the own centroid (ties: smaller id).

    Linear: one aggregate for the centroid, an equi-join on the snapshot key,
    then ``min_by`` - no pairs of planets are formed.
    """
    c = centroid(planets, me)
    own = planets.where(F.col("owner") == me).join(c, SNAP, "inner")
    d2 = (F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2
    return own.groupBy(*SNAP).agg(F.min_by("planet_id", F.struct(d2, F.col("planet_id"))).alias("planet_id"))


def log_counts(events: DataFrame) -> DataFrame:
    """Counts by (kind, player, detail) of parsed console-log lines."""
    return events.groupBy("kind", "player", "detail").agg(F.count(F.lit(1)).alias("n"))


def turn_series(planets: DataFrame, fleets: DataFrame) -> DataFrame:
    """Per game and turn: ships of players 1 and 2, leader, lead changes so far,
    and the first turn at which a player has no ships."""
    s = ships_by_owner(planets, fleets)
    wide = s.groupBy(*SNAP).agg(
        F.sum(F.when(F.col("owner") == 1, F.col("ships")).otherwise(0)).alias("ships_1"),
        F.sum(F.when(F.col("owner") == 2, F.col("ships")).otherwise(0)).alias("ships_2"))
    leader = F.when(F.col("ships_1") > F.col("ships_2"), 1).when(F.col("ships_1") < F.col("ships_2"), 2).otherwise(0)
    w = Window.partitionBy("game_id").orderBy("turn")
    wide = wide.withColumn("leader", leader)
    prev = F.lag("leader").over(w)
    wide = wide.withColumn("__chg", F.when(prev.isNotNull() & (prev != F.col("leader")), 1).otherwise(0))
    wide = wide.withColumn("lead_changes", F.sum("__chg").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__chg")
    dead = F.when((F.col("ships_1") == 0) | (F.col("ships_2") == 0), F.col("turn"))
    return wide.withColumn("first_wipeout_turn", F.min(dead).over(Window.partitionBy("game_id")))


def leader_spans(series: DataFrame, game: str = "game_id") -> DataFrame:
    """Maximal runs of turns with one leader: (game, span, leader, first_turn, last_turn, turns).

    A change of leader, or a missing turn, starts a new span; spans count from 0.
    The window is one game long, and a game has a bounded number of turns.
    """
    w = Window.partitionBy(game).orderBy("turn")
    cut = ~((F.lag("leader").over(w) == F.col("leader")) & (F.lag("turn").over(w) + 1 == F.col("turn")))
    marked = series.select(game, "turn", "leader", F.coalesce(cut, F.lit(False)).cast("int").alias("__cut"))
    spans = marked.withColumn("span", F.sum("__cut").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy(game, "span", "leader").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count(F.lit(1)).alias("turns"))


def new_threats(fleets: DataFrame, planets: DataFrame, me: int = 1) -> DataFrame:
    """Enemy fleets launched this turn (total = remaining + 1) at own planets."""
    own = planets.where(F.col("owner") == me).select(*SNAP, F.col("planet_id").alias("destination_planet_id"))
    f = fleets.where((F.col("owner") != me) & (F.col("owner") != 0) &
                     (F.col("total_trip_length") == F.col("turns_remaining") + 1))
    return f.join(own, [*SNAP, "destination_planet_id"], "left_semi")


def exclude_targeted(planets: DataFrame, fleets: DataFrame, me: int = 1) -> DataFrame:
    """Planets that no own fleet is heading to."""
    t = fleets.where(F.col("owner") == me).select(*SNAP, F.col("destination_planet_id").alias("planet_id"))
    return planets.join(t, [*SNAP, "planet_id"], "left_anti")


def best_target(scored: DataFrame, group: Sequence[str], score: str, item: str | Sequence[str], n: int = 1,
                highest: bool = True) -> DataFrame:
    """Per group the row with the n-th best score (ties: smaller items).

    ``max_by`` is a partial aggregate (safe for a hot group); for n > 1 the
    better rows are removed by anti joins first (n is small).
    """
    items = [item] if isinstance(item, str) else list(item)
    key = F.struct(F.col(score) if highest else -F.col(score), *[-F.col(i) for i in items])
    payload = F.struct(*[c for c in scored.columns if c not in group])
    rest = scored
    for _ in range(n - 1):
        # drop the current best of every group (an anti join on group + items),
        # then take the best of what is left: n small aggregates, skew-safe
        top = rest.groupBy(*group).agg(F.max_by(payload, key).alias("__b")).select(*group, *[F.col(f"__b.{i}").alias(i) for i in items])
        rest = rest.join(top, [*group, *items], "left_anti")
    return rest.groupBy(*group).agg(F.max_by(payload, key).alias("__b")).select(*group, "__b.*")


def greedy_fill(supply: DataFrame, group: Sequence[str], order: str, avail: str, need: Column | str) -> DataFrame:
    """Suppliers in order each give min(remaining need, available).

    give = greatest(0, least(avail, need - sum(avail) of earlier suppliers)).
    """
    nd = F.col(need) if isinstance(need, str) else need
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(avail).over(w), F.lit(0))
    return supply.withColumn("give", F.greatest(F.lit(0), F.least(F.col(avail), nd - before)))


def validate_orders(orders: DataFrame, planets: DataFrame, order: Sequence[str] = ("order_seq",)) -> DataFrame:
    """Rule checks of (snapshot, player, source, destination, ships) orders.

    Reason is the first failing rule: unknown source / destination, same
    planet, not the owner, ships <= 0, not enough ships (running total of the
    player's orders from one source, in order sequence).
    """
    p = planets.select(*SNAP, "planet_id", "owner", "num_ships")
    src = p.select(*SNAP, F.col("planet_id").alias("source_planet_id"), F.col("owner").alias("src_owner"),
                   F.col("num_ships").alias("src_ships"))
    dst = p.select(*SNAP, F.col("planet_id").alias("destination_planet_id"), F.lit(True).alias("dst_ok"))
    j = orders.join(src, [*SNAP, "source_planet_id"], "left").join(dst, [*SNAP, "destination_planet_id"], "left")
    # running ships sent per source in order sequence: by ranges of
    # (snapshot, source, sequence), so one busy source is not sorted in one task
    j = prefix_agg(j.withColumn("__ns", F.col("num_ships").cast("double")), order[0], ["__ns"],
                   tie_cols=list(order[1:]), by=[*SNAP, "source_planet_id"])
    j = j.withColumn("__sent", F.col("__ns_cum")).drop("__ns", "__ns_cum")
    reason = (F.when(F.col("src_owner").isNull(), "unknown source")
              .when(F.col("dst_ok").isNull(), "unknown destination")
              .when(F.col("source_planet_id") == F.col("destination_planet_id"), "same planet")
              .when(F.col("src_owner") != F.col("player"), "not owner")
              .when(F.col("num_ships") <= 0, "no ships")
              .when(F.col("__sent") > F.col("src_ships"), "not enough ships"))
    return j.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull()).drop(
        "src_owner", "src_ships", "dst_ok", "__sent")


def arrival_projection(planets: DataFrame, fleets: DataFrame) -> DataFrame:
    """Each planet's owner and ships after all fleets in flight have arrived.

    Fleets are summed per (snapshot, target, arrival turn, owner) - bounded by
    trip length x 3 owners - then folded in arrival order with ``aggregate``:
    growth for the elapsed turns (non-neutral owners), then the engine's
    contest rule.
    """
    f = fleets.groupBy(*SNAP, F.col("destination_planet_id").alias("planet_id"), "turns_remaining").agg(
        F.sum(F.when(F.col("owner") == 0, F.col("num_ships")).otherwise(0)).alias("f0"),
        F.sum(F.when(F.col("owner") == 1, F.col("num_ships")).otherwise(0)).alias("f1"),
        F.sum(F.when(F.col("owner") == 2, F.col("num_ships")).otherwise(0)).alias("f2"))
    arr = f.groupBy(*SNAP, "planet_id").agg(F.array_sort(F.collect_list(F.struct("turns_remaining", "f0", "f1", "f2"))).alias("arr"))
    j = planets.join(arr, [*SNAP, "planet_id"], "left")
    init = F.struct(F.col("owner").cast("int").alias("o"), F.col("num_ships").cast("long").alias("s"),
                    F.lit(0).cast("int").alias("t"))

    def step(acc, a):
        grown = acc["s"] + F.when(acc["o"] != 0, F.col("growth_rate") * (a["turns_remaining"] - acc["t"])).otherwise(0)
        g0 = F.when(acc["o"] == 0, grown).otherwise(0) + a["f0"]
        g1 = F.when(acc["o"] == 1, grown).otherwise(0) + a["f1"]
        g2 = F.when(acc["o"] == 2, grown).otherwise(0) + a["f2"]
        mx = F.greatest(g0, g1, g2)
        nmax = (g0 == mx).cast("int") + (g1 == mx).cast("int") + (g2 == mx).cast("int")
        second = F.greatest(F.when(g0 < mx, g0), F.when(g1 < mx, g1), F.when(g2 < mx, g2))
        winner = F.when(g0 == mx, 0).when(g1 == mx, 1).otherwise(2)
        return F.struct(
            F.when(nmax > 1, acc["o"]).otherwise(winner).cast("int").alias("o"),
            F.when(nmax > 1, F.lit(0)).otherwise(mx - F.coalesce(second, F.lit(0))).cast("long").alias("s"),
            a["turns_remaining"].cast("int").alias("t"))

    folded = F.aggregate(F.coalesce("arr", F.array().cast(arr.schema["arr"].dataType)), init, step)
    return j.select(*SNAP, "planet_id", folded["o"].alias("final_owner"), folded["s"].alias("final_ships"),
                    folded["t"].alias("last_arrival"))


# --- target scoring from one acting source per snapshot (re-aimed B1-B5, B7, J10) ---

def acting_source(planets: DataFrame, me: int = 1) -> DataFrame:
    """The snapshot's strongest own planet (ties: smaller id): one row per snapshot."""
    own = planets.where(F.col("owner") == me)
    key = F.struct(F.col("num_ships"), -F.col("planet_id"))
    b = own.groupBy(*SNAP).agg(F.max_by(F.struct("planet_id", "num_ships", "growth_rate", "x", "y"), key).alias("s"))
    return b.select(*SNAP, F.col("s.planet_id").alias("src_id"), F.col("s.num_ships").alias("src_ships"),
                    F.col("s.growth_rate").alias("src_growth"), F.col("s.x").alias("src_x"), F.col("s.y").alias("src_y"))


def score_targets(planets: DataFrame, fleets: DataFrame, kind: str, me: int = 1, enemy: int = 2,
                  turns_left: int = 100) -> DataFrame:
    """Score every target planet of a snapshot from the acting source.

    The bots score (source, target) pairs; here the source is the one that acts
    (the strongest own planet), so each target meets one source row through an
    equi-join on the snapshot key - linear in the planets, no pairs.
    dist = ceil(Euclidean distance).  Kinds:
    linear  growth - required - 10 dist, required = ships (+ growth*dist for enemy)
    cost    ships (+ growth*dist for enemy); affordable = cost < source ships
    yield   growth*(1 + 4*[enemy]) / max(dist*total, 1), total = ships + owner*growth*dist/2
    mix     foreign + 4/dist + 2(g_t - g_s)/max(g_s, g_t, 1) + 1 - (ships + dist*g_t)/source ships
    payoff  growth*(turns_left - dist) - ships - net enemy ships in flight (neutral: no dist term;
            own planet: negated)
    match   ships + 4 dist - 3 growth; affordable = value < source ships
    """
    src = acting_source(planets, me)
    t = planets.join(src, SNAP, "inner").where(F.col("planet_id") != F.col("src_id"))
    dist = F.ceil(F.sqrt((F.col("x") - F.col("src_x")) ** 2 + (F.col("y") - F.col("src_y")) ** 2)).cast("double")
    t = t.withColumn("dist", dist)
    g, n, o, dd = F.col("growth_rate").cast("double"), F.col("num_ships").cast("double"), F.col("owner"), F.col("dist")
    is_enemy = o == enemy
    affordable = F.lit(True)
    if kind == "linear":
        req = F.when(is_enemy, g * dd + n).otherwise(n)
        score = g - req - 10.0 * dd
    elif kind == "cost":
        score = F.when(is_enemy, n + g * dd).otherwise(n)
        affordable = score < F.col("src_ships")
    elif kind == "yield":
        total = n + o.cast("double") * 0.5 * g * dd
        score = g * (1 + 4 * is_enemy.cast("double")) / F.greatest(dd * total, F.lit(1.0))
        affordable = total < F.col("src_ships")
    elif kind == "mix":
        gs = F.col("src_growth").cast("double")
        foreign = F.when(o == 0, 1.0).otherwise(2.0)
        ok = (F.col("src_ships") != 0) & (dd != 0)
        score = F.when(ok, foreign + F.lit(4.0) / F.when(ok, dd) + 2.0 * (g - gs) / F.greatest(gs, g, F.lit(1.0))
                       + (1.0 - (n + dd * g) / F.when(ok, F.col("src_ships").cast("double"))))
        affordable = F.col("src_ships") > 0
    elif kind == "payoff":
        inc = inflight_by_target(fleets, me).select(*SNAP, "planet_id", "net_incoming")
        t = t.join(inc, [*SNAP, "planet_id"], "left").fillna({"net_incoming": 0})
        enemy_net = -F.col("net_incoming").cast("double")
        base = F.when(o == 0, g * turns_left - n - enemy_net).otherwise(g * (turns_left - dd) - n - enemy_net)
        score = F.when(o == me, -base).otherwise(base)
    elif kind == "match":
        score = n + 4.0 * dd - 3.0 * g
        affordable = score < F.col("src_ships")
    else:
        raise ValueError(kind)
    return t.select(*SNAP, F.col("src_id").alias("source_planet_id"), "planet_id", "owner", "dist",
                    score.alias("score"), affordable.alias("affordable"))


def nearest_to_anchor(planets: DataFrame, anchor: DataFrame, k: int = 1, owner_in: Sequence[int] = (2,)) -> DataFrame:
    """J10 (re-aimed): the k planets of the given owners nearest to one anchor point
    per snapshot (e.g. the own centroid or the acting source); ties: smaller id.

    ``anchor`` has one row per snapshot (ax, ay); each planet meets one anchor
    row, and the k nearest are taken by repeated ``min_by`` (k small).
    """
    c = planets.where(F.col("owner").isin(*owner_in)).join(anchor, SNAP, "inner")
    c = c.withColumn("dist", F.sqrt((F.col("x") - F.col("ax")) ** 2 + (F.col("y") - F.col("ay")) ** 2))
    out = None
    rest = c
    for i in range(1, k + 1):
        b = rest.groupBy(*SNAP).agg(F.min_by(F.struct("planet_id", "dist"), F.struct("dist", "planet_id")).alias("b")).select(
            *SNAP, F.col("b.planet_id").alias("planet_id"), F.col("b.dist").alias("dist"), F.lit(i).alias("k"))
        out = b if out is None else out.unionByName(b)
        rest = rest.join(b.select(*SNAP, "planet_id"), [*SNAP, "planet_id"], "left_anti")
    return out


def intercept_join(planets: DataFrame, fleets: DataFrame, me: int = 1) -> DataFrame:
    """J15 (re-aimed): enemy fleets whose target the acting source can reach just
    after them (distance == turns_remaining + 1) or before them (distance <
    turns_remaining).  Each fleet meets its target's coordinates and the one
    acting source of its snapshot through equi-joins - no planet pairs."""
    src = acting_source(planets, me)
    tgt = planets.select(*SNAP, F.col("planet_id").alias("destination_planet_id"), F.col("x").alias("tx"), F.col("y").alias("ty"))
    f = fleets.where((F.col("owner") != me) & (F.col("owner") != 0)).join(tgt, [*SNAP, "destination_planet_id"], "inner")
    f = f.join(src, SNAP, "inner")
    dist = F.ceil(F.sqrt((F.col("tx") - F.col("src_x")) ** 2 + (F.col("ty") - F.col("src_y")) ** 2))
    f = f.withColumn("dist", dist.cast("long"))
    return f.select(*SNAP, "fleet_id", "destination_planet_id", F.col("src_id").alias("source_planet_id"), "dist",
                    "turns_remaining", (F.col("dist") == F.col("turns_remaining") + 1).alias("just_after"),
                    (F.col("dist") < F.col("turns_remaining")).alias("before"))


def distance_from_source(planets: DataFrame, me: int = 1) -> DataFrame:
    """J9 (re-aimed): distance of every planet to the acting source of its
    snapshot - plain, ceiling and floor forms - one source row per snapshot."""
    src = acting_source(planets, me)
    t = planets.join(src, SNAP, "inner")
    dist = F.sqrt((F.col("x") - F.col("src_x")) ** 2 + (F.col("y") - F.col("src_y")) ** 2)
    return t.select(*SNAP, F.col("src_id").alias("source_planet_id"), "planet_id", dist.alias("dist"),
                    F.ceil(dist).alias("dist_ceil"), F.floor(dist).alias("dist_floor"))
