"""Benchmark decontamination by template canonicalisation (DataFrame functions only).

Numbers (with their units) and names become typed slots, everything else lower-case
words, so a question with other numbers, names or units has the same template:

* number: digits with inner ``. , : /`` and an optional unit of ``UNITS``, one slot;
* name: a capitalised word run inside a sentence, i.e. after a lower-case letter,
  an optional ``, ; :`` and one space; in a second view every capitalised word run,
  also at the start of a sentence, after a line break, number or quote;
* tokens: slots, and runs of letters or digits; all punctuation is dropped, and any
  white space is one space.

Each view has windows of its own.  An item without a usable window in either one
gets a third view, in which numbers and signs of arithmetic are plain words.

Windows of ``window`` template tokens of the benchmark are hash-joined with those
of every document.  Matches on neighbouring diagonals (document place minus item
place, at most ``shift`` apart; 2 * shift - 1 in one band at most) are an alignment,
so inserted, dropped or split tokens do not part it; a window counts once, on the
diagonal with most hits.  An alignment counts if it covers at least ``coverage`` of
the item's windows, or if ``passage`` consecutive tokens match on one diagonal, and
if its slots are consistent: inside the windows that hit, at least half of the slots have
the most frequent replacement of their value (one value may stand for two quantities, and
one edited number does not hide a question).  Windows with fewer than ``literals`` plain words are too general and are not used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerplay.llm.common import materialize

WINDOW = 8
LITERALS = 3
COVERAGE = 0.5
SHIFT = 8
PASSAGE = 13
BROADCAST_DOCS = 500_000  # documents with an alignment (three numbers each) up to which they are broadcast to the scan of the texts
BROADCAST_WINDOWS = 200_000  # benchmark windows up to which the hash join may broadcast; beyond, both sides shuffle

# --- fixed values -----------------------------------------------------------
# Units that may follow a number:
UNITS = ("km", "cm", "mm", "kg", "mg", "ml", "m", "g", "l", "s", "h", "min", "hours", "hour", "minutes", "seconds", "days", "day", "weeks", "years",
         "meters", "metres", "miles", "feet", "inches", "liters", "litres", "grams", "pounds", "dollars", "euros", "cents", "percent")
NUMBER = r"([0-9]+(?:[.,:/][0-9]+)*)(?: ?(%|(?:" + "|".join(UNITS) + r")\b))?"
NAME = r"(\p{Ll}[,;:]? )(\p{Lu}\p{L}*(?: \p{Lu}\p{L}*)*)"
ANY_NAME = r"(?<![\p{L}\p{N}])\p{Lu}\p{L}*(?: \p{Lu}\p{L}*)*"
SPACE = r"[\s\p{Z}]+"
TOKEN = r"\x01[^\x03]*\x03|[\p{L}\p{N}]+"
EXACT_TOKEN = r"[\p{L}\p{N}]+|[-+*/=<>^%]"
INNER, ALL, EXACT = 0, 1, 2  # views: names inside sentences, all names, no slots
# ----------------------------------------------------------------------------


def spaced(text: Column) -> Column:
    """The text with every white space as one blank and without the slot marks."""
    return F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "\x01\x03", "  "), SPACE, " ")


def template(s: Column, values: bool, view: int = INNER) -> Column:
    """Template tokens of a ``spaced`` text in a view; slots are ``\\x01n..\\x03`` (number with
    unit) and ``\\x01p..\\x03`` (name), with their values inside if ``values``."""
    if view == EXACT:
        return F.regexp_extract_all(F.lower(s), F.lit(EXACT_TOKEN), F.lit(0))
    if view == ALL:
        s = F.regexp_replace(s, ANY_NAME, "\x01p" + ("$0" if values else "") + "\x03")
    else:
        s = F.regexp_replace(s, NAME, "$1\x01p" + ("$2" if values else "") + "\x03")
    s = F.regexp_replace(s, NUMBER, "\x01n" + ("$1 $2" if values else "") + "\x03")
    return F.regexp_extract_all(F.lower(s), F.lit(TOKEN), F.lit(0))


def _windows(rows: DataFrame, keep: list[str], sizes: list[int], literals: int) -> DataFrame:
    """``keep``, at, len, key: the windows of each of ``sizes`` tokens of the column ``t`` (of a ``view``) with enough plain words."""
    slot = lambda x: x.startswith("\x01")
    rows = rows.select(*dict.fromkeys([*keep, "view"]), F.transform("t", lambda x: F.xxhash64(x)).alias("h"), F.transform("t", lambda x: F.when(slot(x), 0).otherwise(1)).alias("plain"))
    # outer: no filter is inferred that would tokenise every text a second time
    at = rows.select("*", F.explode_outer(F.when(F.size("h") >= sizes[0], F.sequence(F.lit(1), F.size("h") - sizes[0] + 1))).alias("at")).where("at IS NOT NULL")
    words = lambda n: F.size(F.array_remove(F.slice("plain", F.col("at"), n), 0)) >= min(literals, n)
    keys = [F.when((F.col("at") + n - 1 <= F.size("h")) & words(n), F.struct(F.lit(n).alias("len"), F.xxhash64(F.slice("h", F.col("at"), n), F.lit(n), F.col("view")).alias("key"))) for n in sizes]
    found = at.select(*keep, "at", (F.explode_outer(F.array(*keys)) if len(keys) > 1 else keys[0]).alias("x")).where("x IS NOT NULL")
    return found.select(*keep, "at", "x.len", "x.key")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS, coverage: float = COVERAGE,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 shift: int = SHIFT, passage: int = PASSAGE) -> DataFrame:
    """One row per contaminated document and benchmark item.

    doc_id, item_id, n_windows (of the item), n_hit (of them in the document, on
    the best consistent alignment, of the first view if it has one), coverage, n_slots (values compared), same_values
    (the slots hold the item's own values).

    Items with fewer than ``window`` tokens are one window; items without a usable
    window in the views with slots are matched with their own numbers if they have
    ``literals`` tokens, else they match nothing.  Null texts and empty tables match nothing.  Items are
    judged by (id, text), also with a null id, and an id gives its best row.
    Documents are judged by (id, text), also with a null id, and an id gives its best
    row per item; repeated rows change nothing.
    """
    best = _judged(docs, benchmark, window, literals, coverage, id_col, text_col, item_col, item_text, shift, passage)
    best = best.groupBy("doc_id", "item_id").agg(F.max("b").alias("b"))
    return best.select("doc_id", "item_id", F.col("b.n_windows").cast("long").alias("n_windows"), F.col("b.n_hit").cast("long").alias("n_hit"),
                       (F.col("b.n_hit") / F.col("b.n_windows")).alias("coverage"), F.col("b.n_slots").cast("long").alias("n_slots"), F.col("b.same").alias("same_values"))


def _judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", shift: int = SHIFT, passage: int = PASSAGE) -> DataFrame:
    """(doc_id, th, item_id, b): the best alignment of each contaminated text (th: its hash) and item."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).where("text IS NOT NULL").distinct().withColumn("s", spaced(F.col("text")))
    views = F.array(*[F.struct(F.lit(k).alias("view"), template(F.col("s"), False, k).alias("t"), template(F.col("s"), True, k).alias("v")) for k in (INNER, ALL, EXACT)])
    item_tokens = materialize(items.select("item_id", F.xxhash64(F.col("item_id").isNull(), "item_id", "text").alias("base"), F.explode(views).alias("x"))
                              .select("item_id", "base", F.xxhash64("base", "x.view").alias("item"), "x.*")
                              .withColumn("len", F.least(F.size("t"), F.lit(window)))
                              .where((F.col("len") > 0) & ((F.col("view") != EXACT) | (F.col("len") >= literals))))
    lengths: dict[int, list[int]] = {}  # of each view, 1..window
    for r in sorted(item_tokens.select("view", "len").distinct().collect()):
        lengths.setdefault(r["view"], []).append(r["len"])
    schema = "doc_id long, th long, item_id long, b struct<inner: boolean, n_hit: long, n_windows: long, n_slots: int, same: boolean>"
    if not lengths:
        return docs.sparkSession.createDataFrame([], schema)
    each = [_windows(item_tokens.where((F.col("len") == size) & (F.col("view") == view)), ["base", "item", "view"], [size], literals)
            for view, sizes in lengths.items() for size in sizes]
    item_windows = materialize(reduce(DataFrame.union, each).withColumnRenamed("at", "item_at"))
    slotted = item_windows.where(F.col("view") != EXACT).select("base").distinct()
    exact = item_windows.where(F.col("view") == EXACT).join(slotted, "base", "left_anti").select(item_windows.columns)
    item_windows = materialize(item_windows.where(F.col("view") != EXACT).union(exact).drop("base"))
    used = {r["view"]: sorted(r["sizes"]) for r in item_windows.groupBy("view").agg(F.collect_set("len").alias("sizes")).collect()}
    if not used:
        return docs.sparkSession.createDataFrame([], schema)
    item_windows = item_windows.drop("view")
    n_windows = item_windows.groupBy("item").agg(F.count("*").alias("n_windows"))
    small = item_windows.count() <= BROADCAST_WINDOWS

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = own.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("th"), spaced(F.col("text")).alias("s"))
    # one scan: every view starts from the same spaced text; windows of a size that only another view uses match nothing
    seen = texts.select("doc_id", "th", F.explode(F.array(*[F.struct(F.lit(view).alias("view"), template(F.col("s"), False, view).alias("t")) for view in used])).alias("x"))
    every_size = sorted({n for sizes in used.values() for n in sizes})
    each = _windows(seen.select("doc_id", "th", "x.view", "x.t"), ["doc_id", "th"], every_size, literals).select("doc_id", "th", "at", "key")
    hits = each.join(F.broadcast(item_windows) if small else item_windows, "key").select("doc_id", "th", "item", "len", "item_at", (F.col("at") - F.col("item_at")).alias("shift"))
    diagonals = hits.groupBy("doc_id", "th", "item", "len", "shift").agg(F.sort_array(F.collect_set("item_at")).alias("ats"))
    # longest stretch of matching tokens: windows that overlap or touch
    grow = lambda a, x: F.struct(F.when(x <= a["last"] + F.col("len"), a["from"]).otherwise(x).alias("from"), x.alias("last"))
    stretch = lambda a, x: F.struct(grow(a, x)["from"].alias("from"), x.alias("last"), F.greatest(a["most"], x - grow(a, x)["from"] + F.col("len")).alias("most"))
    first = F.struct(F.get("ats", F.lit(0)).alias("from"), F.get("ats", F.lit(0)).alias("last"), F.lit(0).alias("most"))
    band = F.floor(F.col("shift") / F.lit(shift))
    pieces = (diagonals.withColumn("tokens", F.aggregate("ats", first, stretch)["most"])
              .withColumn("band", F.explode(F.array(band, band + 1)))
              .groupBy("doc_id", "th", "item", "len", "band").agg(F.max("tokens").alias("tokens"), F.array_sort(F.collect_list(F.struct((-F.size("ats")).alias("n"), "shift", "ats"))).alias("pieces")))
    new = lambda a, p: F.array_except(p["ats"], F.transform(a, lambda x: x["at"]))
    placed = F.aggregate("pieces", F.expr("CAST(array() AS array<struct<at: int, shift: int>>)"),
                         lambda a, p: F.concat(a, F.transform(new(a, p), lambda x: F.struct(x.alias("at"), p["shift"].alias("shift")))))
    aligned = (pieces.withColumn("n_hit", F.size(F.array_distinct(F.flatten(F.transform("pieces", lambda p: p["ats"]))))).join(n_windows, "item")
               .where((F.col("n_hit") >= F.ceil(F.lit(coverage) * F.col("n_windows"))) | (F.col("tokens") >= passage))
               .select("doc_id", "th", "item", "len", "n_windows", "n_hit", placed.alias("placed")))
    aligned = materialize(aligned)

    # slots of the windows that hit, item value against document value
    named = aligned.join(item_tokens.select("item", "view"), "item").select("doc_id", "th", "view").distinct().groupBy("doc_id", "th").agg(F.collect_set("view").alias("wanted"))
    named = materialize(named.withColumnsRenamed({"doc_id": "__id", "th": "__th"}))
    few = named.count() <= BROADCAST_DOCS  # counted; beyond, the texts meet them in a shuffle join
    found = own.withColumn("th", F.xxhash64("text")).join(F.broadcast(named) if few else named, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")))
    values = F.array(*[F.when(F.array_contains("wanted", view), F.struct(F.lit(view).alias("view"), template(F.col("s"), True, view).alias("dv"))) for view in used])
    valued = found.select("doc_id", "th", "wanted", spaced(F.col("text")).alias("s")).select("doc_id", "th", F.explode(F.array_compact(values)).alias("x")).select("doc_id", "th", "x.*")
    a, d = aligned.alias("a"), valued.alias("d")
    both = (a.join(item_tokens.select("item", "item_id", "view", "v").alias("i"), F.col("a.item") == F.col("i.item"))
            .join(d, F.col("a.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("a.th") == F.col("d.th")) & (F.col("i.view") == F.col("d.view"))))
    places = F.array_distinct(F.flatten(F.transform("placed", lambda w: F.transform(
        F.sequence(w["at"], w["at"] + F.col("len") - 1), lambda k: F.struct(k.alias("at"), w["shift"].alias("shift"))))))
    # pairs are matched where both sides have the same type of slot at the same place
    pairs = F.filter(F.transform(places, lambda k: F.struct(F.get("v", k["at"] - 1).alias("x"), F.get("dv", k["at"] + k["shift"] - 1).alias("y"))),
                     lambda p: p["x"].startswith("\x01") & (F.substring(p["x"], 1, 2) == F.substring(p["y"], 1, 2)))
    judged = both.select("a.doc_id", "a.th", "i.item_id", (F.col("i.view") == INNER).alias("inner"), "n_windows", "n_hit", F.array_distinct(pairs).alias("p"), pairs.alias("all"))
    # slots per distinct pair, and of them the most per item value
    counted = judged.withColumn("c", F.transform("p", lambda q: F.struct(q["x"].alias("x"), F.size(F.filter("all", lambda r: r == q)).alias("n"))))
    most = F.transform(F.array_distinct(F.transform("p", lambda q: q["x"])), lambda x: F.array_max(F.transform(F.filter("c", lambda q: q["x"] == x), lambda q: q["n"])))
    # judged inside the aggregate: as a filter the condition would be moved below and all slots compared anew for each use
    ok = 2 * F.aggregate(most, F.lit(0), lambda n, k: n + k) >= F.size("all")
    b = F.struct("inner", F.col("n_hit").cast("long").alias("n_hit"), F.col("n_windows").alias("n_windows"), F.size("p").alias("n_slots"), F.forall("p", lambda p: p["x"] == p["y"]).alias("same"))
    return counted.groupBy("doc_id", "th", "item_id").agg(F.max(F.when(ok, b)).alias("b")).where("b IS NOT NULL")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; columns as they were."""
    found = _judged(docs, benchmark, id_col=id_col, text_col=text_col, **options).select(F.col("doc_id").alias("__found"), F.col("th").alias("__found_text")).distinct()
    return docs.join(found, docs[id_col].eqNullSafe(found["__found"]) & (F.xxhash64(docs[text_col]) == found["__found_text"]), "left_anti")
