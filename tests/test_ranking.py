"""Retrieval and lineage."""

from __future__ import annotations

import math

from attesta.functions.text import identifiers
from attesta.operators import lineage as L
from attesta.operators import retrieval as R


def claims(spark, rows):
    return spark.createDataFrame([(i, k, c, p) for p, (i, k, c) in enumerate(rows)], "id long, type string, content string, pos int")


def test_under_cap_and_code(spark):
    own = claims(spark, [(3, "fact", "a"), (1, "fact", "b"), (2, "code", "c")])
    assert [r["id"] for r in R.select_claims(own, "q", 10).orderBy("place").collect()] == [3, 1, 2]
    assert 2 in {r["id"] for r in R.select_claims(own, "zzz", 2).collect()}
    codes = claims(spark, [(i, "code", "x") for i in range(5)])
    assert [r["id"] for r in R.select_claims(codes, "x", 2).orderBy("place").collect()] == [4, 3]


def test_bm25_choice(spark):
    own = claims(spark, [(1, "fact", "attention uses queries"), (2, "fact", "bread is baked"), (3, "fact", "query key value attention"), (4, "fact", "gnomes live here")])
    assert {r["id"] for r in R.select_claims(own, "Attention", 2).collect()} == {1, 3}


def test_bm25_formula(spark):
    docs = {1: "a b a", 2: "b c", 3: "d", 4: ""}
    df = spark.createDataFrame(list(docs.items()), "id long, content string")
    got = {r["id"]: r["score"] for r in R.bm25(df, "a b b z").collect()}
    n, avg = 4, (3 + 2 + 1 + 0) / 4
    want = {}
    for i, t in docs.items():
        words = t.split()
        for q in "a b b z".split():
            df_q = sum(q in x.split() for x in docs.values())
            if q in words:
                idf = math.log((n - df_q + 0.5) / (df_q + 0.5) + 1)
                tf = words.count(q)
                want[i] = want.get(i, 0) + idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(words) / avg))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert R.bm25(df, "!!").count() == 0


def test_first_terms(spark):
    terms = spark.createDataFrame([(1, "GPU"), (2, "gpu"), (3, "Adam"), (4, "x")], "pos long, term string")
    assert [r["term"] for r in R.first_terms(terms, 2).collect()] == ["GPU", "Adam"]


def test_supersession(spark):
    schema = "id long, type string, content string, video_id string, ts_start double, embedding array<double>"
    rows = [
        (1, "code", "def attn(q, k): return q", "vidA", 0.0, [1.0, 0.0]),
        (2, "code", "def attn(q, k): return k", "vidB", 0.0, [1.0, 0.0]),
        (3, "fact", "x", "vidA", 1.0, [0.0, 1.0]),
        (4, "fact", "y", "vidB", 1.0, [0.1, 0.995]),
        (5, "fact", "z", "vidC", 1.0, [0.0, 1.0]),
        (6, "fact", "same video", "vidA", 2.0, [0.0, 1.0]),
        (7, "fact", "no vector", "vidB", 2.0, None),
    ]
    own = spark.createDataFrame(rows, schema)
    ranks = spark.createDataFrame([("vidA", 0), ("vidB", 1), ("vidC", 2)], "video_id string, rank int")
    links = L.links(own, ranks)
    assert {(r["older_id"], r["newer_id"]) for r in links.collect()} == {(1, 2), (3, 4), (3, 5), (4, 5), (6, 4), (6, 5)}
    applied = {r["older_id"]: (r["superseded_by"], r["n_links"]) for r in L.apply(links, own).collect()}
    assert applied == {1: (2, 1), 3: (5, 2), 4: (5, 1), 6: (5, 2)}
    assert {r["id"] for r in L.current(own, L.apply(links, own)).collect()} == {2, 5, 7}
    chapters = spark.createDataFrame([("c", [5, 3, 5, 2]), ("d", []), ("e", [3])], "chapter_id string, claim_ids array<long>")
    assert {r["chapter_id"]: r["claim_ids"] for r in L.prune_outline(chapters, L.apply(links, own)).collect()} == {"c": [5, 5, 2], "d": [], "e": []}


def test_identifiers(spark):
    assert spark.range(1).select(identifiers(__import__("pyspark.sql.functions", fromlist=["lit"]).lit("Foo_1 é 2x")).alias("t")).first()["t"] == ["foo_1", "x"]
