"""Registered queries of the training-data operators and their SQL.

Every query applies its operator with production parameters to its whole table.
Where SQL cannot express the operator the tests compare it with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerplay.llm import decontaminate, exact_dedup, language_id, line_dedup, merkle, mixing, near_dup, packing, prefix_trie, quality, substring_dedup, token_counts, topk

# --- fixed values -----------------------------------------------------------
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKENIZER = "byte_bpe_50k.json"
# ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(m: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(m))


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), TOKENIZER).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(F.coalesce(crc_mod(3) != 1, F.lit(False))))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(crc_mod(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_line_dedup_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_repeated_content(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_mod(5) != 0)
    return found.select("doc_id", F.coalesce(crc_mod(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", word_count().alias("size"), F.array("source").alias("sources"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(table(spark, sf_dir, "documents"), F.translate("text", UPPER, LOWER), crc_mod(5) == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.with_shared_heads(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie_nodes(turns).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


OP3_SQL = """
WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT doc_id, generate_subscripts(ls, 1) AS no, unnest(ls) AS l FROM raw),
full_line AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS pos FROM
  (SELECT doc_id, no, trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM line) WHERE k <> ''),
run AS (SELECT * FROM (SELECT doc_id, pos, k AS k1, lead(k, 1) OVER w AS k2, lead(k, 2) OVER w AS k3 FROM full_line
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) WHERE k3 IS NOT NULL),
ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY k1, k2, k3 ORDER BY doc_id, pos) AS r FROM run),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM ranked WHERE r > 1),
gone_line AS (SELECT f.doc_id, f.no FROM full_line f JOIN gone USING (doc_id, pos)),
kept AS (SELECT doc_id, string_agg(l, chr(10) ORDER BY no) AS t FROM line ANTI JOIN gone_line USING (doc_id, no) GROUP BY doc_id)
SELECT raw.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM raw LEFT JOIN (SELECT doc_id, count(*) AS n FROM full_line GROUP BY doc_id) n USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone_line GROUP BY doc_id) g USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# every run of lines of a document that holds 40 bytes, without any choice among them
OP3_CONTENT_SQL = """
WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT doc_id, generate_subscripts(ls, 1) AS no, unnest(ls) AS l FROM raw),
full_line AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS pos FROM
  (SELECT doc_id, no, trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM line) WHERE k <> ''),
seq AS (SELECT doc_id, list(k ORDER BY pos) AS ks, list(strlen(k) ORDER BY pos) AS bs FROM full_line GROUP BY doc_id),
pos AS (SELECT *, unnest(range(1, len(ks) + 1)) AS a FROM seq),
run AS (SELECT doc_id, a, z, ks[a:z] AS key FROM (SELECT *, unnest(range(a, len(ks) + 1)) AS z FROM pos) WHERE list_sum(bs[a:z]) >= 40),
ranked AS (SELECT doc_id, a, z, row_number() OVER (PARTITION BY key ORDER BY doc_id, a) AS r FROM run),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, z + 1)) AS pos FROM ranked WHERE r > 1),
gone_line AS (SELECT f.doc_id, f.no FROM full_line f JOIN gone USING (doc_id, pos)),
kept AS (SELECT doc_id, string_agg(l, chr(10) ORDER BY no) AS t FROM line ANTI JOIN gone_line USING (doc_id, no) GROUP BY doc_id)
SELECT raw.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM raw LEFT JOIN (SELECT doc_id, count(*) AS n FROM full_line GROUP BY doc_id) n USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone_line GROUP BY doc_id) g USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP7_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
  ELSE [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)] END) AS sh FROM w),
x AS (SELECT doc_id, unnest(sh) AS t, len(sh) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2
  HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.m, s.doc_id)) AS component_id, s.doc_id = least(s.doc_id, coalesce(m.m, s.doc_id)) AS kept
FROM s LEFT JOIN m USING (doc_id)
"""

OP9_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, array_to_string(ws[s:s + 49], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM w WHERE len(ws) >= 50)),
f AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
hit AS (SELECT doc_id, s FROM win JOIN f USING (k) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM hit),
word AS (SELECT doc_id, generate_subscripts(ws, 1) AS p, unnest(ws) AS x FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP10_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
q AS (SELECT DISTINCT vec_id AS query_id, e AS qe FROM v WHERE vec_id % 20 = 0),
p AS (SELECT query_id, qe, c.vec_id, CAST(list_dot_product(qe, c.e) AS BIGINT) AS score FROM q JOIN v c ON c.vec_id <> query_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id, qe ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
"""

OP11_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n_points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT norm, first(doc_id ORDER BY n_points DESC, doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN k USING (norm)
"""


def _crc32_sql(number: str) -> str:
    """CRC-32 of the decimal text of ``number``: bytes folded in, eight shifts each."""
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    byte = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {byte}), 4294967295)"


def _merkle_sql(levels: int = 5) -> str:
    """Level by level with window and list functions, ``levels`` levels per tree (16^levels leaves)."""
    def leaf(text: str) -> str:
        part = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
        return "sha256(" + " || ".join(part.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, base: str) -> list[str]:
        # {name}0(tree, pos, d) ... : one table per level; {name}l{k}: every node with its siblings
        out = [f"{name}0 AS ({base})"]
        for k in range(levels):
            low = f"{name}{k}"
            out.append(f"{low}s AS (SELECT tree, pos, d, count(*) OVER (PARTITION BY tree) AS n, list(d) OVER (PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run FROM {low})")
            out.append(f"{low}p AS (SELECT tree, pos, CASE WHEN n > 1 THEN array_to_string(run[1:pos % 16], '') END AS b, CASE WHEN n > 1 THEN array_to_string(run[pos % 16 + 2:], '') END AS a FROM {low}s)")
            out.append(f"{name}{k + 1} AS (SELECT tree, pos // 16 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(array_to_string(any_value(run), '')) ELSE any_value(d) END AS d FROM {low}s GROUP BY tree, pos // 16)")
        return out

    def path(node: str, name: str, pos: str, tree_key: str, n: int) -> str:
        return " ".join(f"LEFT JOIN {name}{k}p {node}{k} ON {node}{k}.tree IS NOT DISTINCT FROM {tree_key} AND {node}{k}.pos = {pos} // {16 ** k}" for k in range(n))

    changed = f"translate(text, '{UPPER}', '{LOWER}')"
    ctes = [f"leaf AS (SELECT doc_id, coalesce('s' || source, '-') AS tree, {leaf('text')} AS d, CASE WHEN {_crc32_sql('doc_id')} % 5 = 0 THEN {leaf(changed)} END AS t FROM documents)",
            "leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS pos FROM leaf)"]
    ctes += tree("x", "SELECT tree, pos, d FROM leaves")
    ctes += [f"subs AS (SELECT tree AS name, d, row_number() OVER (ORDER BY tree) - 1 AS pos FROM x{levels})"]
    ctes += tree("y", "SELECT '' AS tree, pos, d FROM subs")
    steps = [f"i{k}" for k in range(levels)] + [f"o{k}" for k in range(levels)]
    ctes.append("paths AS (SELECT l.doc_id, l.d AS leaf, l.t, s.d AS subroot, " + ", ".join(f"{s}.b AS {s}b, {s}.a AS {s}a" for s in steps)
                + " FROM leaves l JOIN subs s ON s.name = l.tree " + path("i", "x", "l.pos", "l.tree", levels) + " " + path("o", "y", "s.pos", "''", levels) + ")")
    at = "coalesce(t, leaf)"
    for k, s in enumerate(steps):
        ctes.append(f"f{k} AS (SELECT *, CASE WHEN {s}b IS NULL THEN {at} ELSE sha256({s}b || {at} || {s}a) END AS v{k} FROM {'paths' if k == 0 else f'f{k - 1}'})")
        at = f"v{k}"
    proof = " || ".join(f"coalesce({s}b || {s}a, '')" for s in steps)
    return ("WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, r.d AS root, sha256({proof}) AS proof_sha256, {at} AS folded_root, {at} = r.d AS verified"
            + f" FROM f{len(steps) - 1}, y{levels} r")


OP13_SQL = f"""
WITH turns AS (SELECT conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS e, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32)) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(e ORDER BY p) AS es, {_crc32_sql('conv_id')} % 6 AS h FROM turns GROUP BY conv_id),
conv AS (SELECT c.conv_id, list_concat(coalesce(b.es[1:c.h], []), c.es[c.h + 1:]) AS es FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
step AS (SELECT conv_id, es, unnest(range(0, len(es) + 1)) AS depth FROM conv),
node AS (SELECT es[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(es) = depth), '')) AS ends_sha256 FROM step GROUP BY 1, 2),
child AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.path[n.depth].t) END AS saved FROM node n LEFT JOIN child c USING (path)),
up AS (SELECT path[1:k] AS path, n_children, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM full_node)),
total AS (SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_node n JOIN total t USING (path) LEFT JOIN node p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_token_counts": (op1_token_counts, None),
    "op2_language_id": (op2_language_id, None),
    "op3_line_dedup": (op3_line_dedup, OP3_SQL),
    "op3_line_dedup_by_content": (op3_line_dedup_by_content, OP3_CONTENT_SQL),
    "op4_packed_sequences": (op4_packed_sequences, None),
    "op5_quality": (op5_quality, None),
    "op6_decontamination": (op6_decontamination, None),
    "op7_near_duplicates": (op7_near_duplicates, OP7_SQL),
    "op8_mixture": (op8_mixture, None),
    "op9_substring_dedup": (op9_substring_dedup, OP9_SQL),
    "op10_top_k": (op10_top_k, OP10_SQL),
    "op11_exact_dedup": (op11_exact_dedup, OP11_SQL),
    "op12_merkle_manifest": (op12_merkle_manifest, _merkle_sql()),
    "op13_prefix_trie": (op13_prefix_trie, OP13_SQL),
}
