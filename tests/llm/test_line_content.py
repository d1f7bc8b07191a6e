"""Line removal by content, against brute force over all runs and against its SQL."""

import random

import duckdb

from tests.conftest import SF_SMALL

BLANK = " \t\n\r\x0b\x0c"
NOTICE = "All rights reserved by the publishers of this page"  # 40 bytes or more


def removed_by_hand(texts, least):
    lines = {i: [x.strip(BLANK) for x in t.split("\n") if x.strip(BLANK)] for i, t in texts.items()}
    seen, gone = set(), {i: set() for i in texts}
    for i in sorted(lines):
        for a in range(len(lines[i])):
            for z in range(a + 1, len(lines[i]) + 1):
                run = tuple(lines[i][a:z])
                if sum(len(x.encode()) for x in run) >= least:
                    if run in seen:
                        gone[i] |= set(range(a, z))
                    seen.add(run)
    return {i: len(g) for i, g in gone.items()}


def test_content_rule_equals_brute_force(spark):
    from ledgerplay.llm import line_dedup as L
    rnd = random.Random(8)
    vocab = ["a", "bb", "  ccc ", "é" * 9, "x" * 12, "y" * 25, "z" * 41, "", " \t"]
    texts = {i: "\n".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 12))) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()) + [(None, texts[3]), (100, None), (7, texts[7])], "doc_id long, text string").repartition(3)
    for least in (1, 20, 40):
        got = L.remove_repeated_content(df, least).collect()
        assert len(got) == 63
        want = removed_by_hand(texts, least) | {None: 0, 100: 0}
        assert {r["doc_id"]: r["n_removed"] for r in got} == want
    assert L.remove_repeated_content(df.limit(0)).count() == 0


def test_one_line_between_different_neighbours_goes(spark):
    from ledgerplay.llm import line_dedup as L
    texts = [(1, f"one\n{NOTICE}\ntwo"), (2, f"three\n  {NOTICE}\nfour"), (3, NOTICE)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r["doc_id"]: r["kept_text"] for r in L.remove_repeated_content(df).collect()} == {1: texts[0][1], 2: "three\nfour", 3: ""}


def test_query_equals_its_sql(spark):
    import __spark_entry__ as E
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    df = E.queries()["op3_line_dedup_by_content"](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()["op3_line_dedup_by_content"])
    cols = [c[0] for c in cur.description]
    assert sorted(tuple(r) for r in df.select(cols).collect()) == sorted(cur.fetchall())
