"""Table functions, the SQLite source, stores in place, running totals and settings."""

from __future__ import annotations

import os
import random
import sqlite3
from contextlib import closing
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.functions import tables as TF
from attesta.functions import text as T
from attesta.operators import budget as B
from attesta.operators import lineage as L
from attesta.operators import retrieval as R
from attesta.operators import stages as ST
from attesta.sources import files, sqlite, store

PIECES = ["It is one.", " AB", "x", "[c1, c2]", "\x01C", "\x01", "\x02", "\x02\x03", "\x04", "\x00", "\n", "\n\n", "```py\n", "\n```\n", "$$a\x01b$$", "[FIGURE: \x01]", "# H\n", "[GAP: x]", "was", "3.5", "\x1c", "\x0b", "é", " "]


def made_texts(n: int) -> list[str]:
    rng = random.Random(4)
    return ["".join(rng.choices(PIECES, k=rng.randint(1, 25))) for _ in range(n)] + ["", "It is one. \x01Cand two are here.\n\nIt was three."]


def test_no_character_is_lost_in_sentences(spark):
    """Inner marks in a text: as many sentences, of the same kinds and with the same text, as with a harmless character in their place."""
    texts = made_texts(400)
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    plain = F.translate("t", "\x01\x02", "")
    for r in rows.select("t", T.typed_sentences(F.col("t")).alias("x"), T.typed_sentences(plain).alias("y"), T.normalise_headings(F.col("t")).alias("h"), T.normalise_headings(plain).alias("g")).collect():
        back = str.maketrans("", "\x01\x02")
        assert [(s["type"], s["text"]) for s in r["x"]] == [(s["type"], s["text"].translate(back)) for s in r["y"]]
        assert r["h"] == r["g"].translate(back)


def test_table_functions_equal_the_expressions(spark):
    TF.register(spark)
    texts = made_texts(400)
    rows = spark.createDataFrame([*enumerate(texts), (9999, None)], "id int, t string")
    want = {(r["id"], r["index"]): (r["s"]["type"], r["s"]["text"]) for r in rows.select("id", F.posexplode(T.typed_sentences(F.col("t"))).alias("index", "s")).collect()}
    got = spark.sql("SELECT id, s.* FROM {rows} r, LATERAL text_sentences(r.t) s", rows=rows).collect()
    assert {(r["id"], r["index"]): (r["type"], r["text"]) for r in got} == want
    assert {i for r in got for i in r["cited_claim_ids"]} == {1, 2}
    parts = rows.select("id", F.posexplode(F.array("t", F.lit("End."), "t")).alias("p", "t"))
    whole = {}
    for r in spark.sql("SELECT * FROM part_sentences(TABLE({parts}) PARTITION BY id ORDER BY p)", parts=parts).collect():
        whole.setdefault(r["id"], {})[r["index"]] = r["text"]
    for i, found in whole.items():
        once = [want[k][1] for k in sorted(k for k in want if k[0] == i)]
        assert [found[j] for j in range(len(found))] == [*once, "End.", *once]


def test_sqlite_is_read_in_ranges(spark, tmp_path):
    sqlite.register(spark)
    path = tmp_path / "s.sqlite"
    with closing(sqlite3.connect(path)) as c:
        c.execute('CREATE TABLE "my claims" (id INTEGER PRIMARY KEY, name VARCHAR(10), score REAL, raw BLOB)')
        c.executemany('INSERT INTO "my claims" VALUES (?, ?, ?, ?)', [(i, f"n{i}" if i % 3 else None, i / 2 if i % 2 else i, bytes([i % 256])) for i in range(1, 101)])
        c.commit()
    read = lambda: spark.read.format("sqlite").option("path", str(path)).option("table", "my claims").option("rows", 30).load()
    df = read()
    assert df.rdd.getNumPartitions() == 4 and dict(df.dtypes) == {"id": "bigint", "name": "string", "score": "double", "raw": "binary"}
    assert sorted((r["id"], r["name"], r["score"], bytes(r["raw"])) for r in df.collect()) == [(i, f"n{i}" if i % 3 else None, i / 2 if i % 2 else float(i), bytes([i % 256])) for i in range(1, 101)]
    assert [r["id"] for r in read().where("name = 'n50'").collect()] == [50] and read().where("id = 7 AND score > 3").count() == 1
    out = str(tmp_path / "out")
    df.repartition(3).write.format("sqlite").option("path", out).option("table", "t").mode("append").save()
    df.limit(5).coalesce(1).write.format("sqlite").option("path", out).option("table", "t").mode("append").save()
    again = spark.read.format("sqlite").option("path", out).option("table", "t").load()
    assert again.count() == 105 and again.distinct().count() == 100 and len(os.listdir(out)) == 4
    df.limit(2).write.format("sqlite").option("path", out).option("table", "t").mode("overwrite").save()
    assert spark.read.format("sqlite").option("path", out).option("table", "t").load().count() == 2


def test_bucketed_tables_join_without_an_exchange(spark):
    a = store.save_bucketed(spark.range(1000).withColumnRenamed("id", "k").withColumn("x", F.col("k") * 2), "bucketed_a", "k", 4)
    b = store.save_bucketed(spark.range(0, 1000, 3).withColumnRenamed("id", "k").withColumn("y", F.col("k")), "bucketed_b", "k", 4)
    joined = a.hint("merge").join(b, "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and joined.count() == 334
    spark.sql("DROP TABLE bucketed_a"), spark.sql("DROP TABLE bucketed_b")


def test_upsert_touches_its_own_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "c string, i long, j long, v string")
    store.write_partitions(make([(c, i, i if i % 2 else None, "old") for c in "abc" for i in range(6)]), path, "c")
    listed = lambda c: sorted((f, os.stat(f"{path}/c={c}/{f}").st_mtime_ns) for f in os.listdir(f"{path}/c={c}"))
    before = {c: listed(c) for c in "abc"}
    for _ in range(2):
        store.upsert(spark, path, make([("b", 1, 1, "new"), ("b", 2, None, "new"), ("b", 9, None, "new")]), ["c", "i", "j"], "c")
    assert listed("a") == before["a"] and listed("c") == before["c"] and listed("b") != before["b"]
    got = {(r["i"], r["j"]): r["v"] for r in spark.read.parquet(path).where("c = 'b'").collect()}
    assert got == {(0, None): "old", (1, 1): "new", (2, None): "new", (3, 3): "old", (4, None): "old", (5, 5): "old", (9, None): "new"}
    store.set_columns(spark, path, spark.createDataFrame([("c", 5, "set"), ("c", 77, "no")], "c string, i long, v string"), "i", "c")
    assert listed("a") == before["a"] and [(r["i"], r["v"]) for r in spark.read.parquet(path).where("c = 'c'").orderBy("i").collect()][-2:] == [(4, "old"), (5, "set")]


@pytest.mark.parametrize("partitions", (1, 7, 64))
def test_admission_does_not_depend_on_partitions(spark, partitions):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    rng = random.Random(5)
    rows = [(i, "x" * rng.randint(0, 300)) for i in range(300)]
    asked, log = ST.ask_within_budget(own.createDataFrame(rows, "id int, prompt string").repartition(partitions), "prompt", lambda: lambda p: "yes", own.createDataFrame([("s", 0.001)], "stage string, usd double"), "t", 3.3, 0.03)
    total, want = Decimal("0.001"), {}
    for i, p in rows:
        cost = Decimal(max(1, int(len(p) / 3.5))) * Decimal("3.3") / 10**6
        total += cost
        want[i] = total <= Decimal("0.03")
    assert {r["id"]: r["answer"] == "yes" for r in asked.collect()} == want and 0 < sum(want.values()) < 300
    amounts = own.createDataFrame([(i, rng.randint(0, 9)) for i in range(500)], "id int, x long")
    before = {r["id"]: r["spent"] for r in B.running_total(amounts, ["id"], "x").collect()}
    total = 0
    for i, x in sorted((r["id"], r["x"]) for r in amounts.collect()):
        assert before[i] == total
        total += x
    assert B.running_total(amounts.limit(0), ["id"], "x").count() == 0


def test_selection_does_not_depend_on_partitions(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["fact", "code", "fact", "idea"]), " ".join(rng.choices(["gpu", "warp", "cache", "is", "fast"], k=rng.randint(1, 30))), i) for i in range(300)]
    found = []
    for n in (1, 4, 7):
        own = spark.newSession()
        own.conf.set("spark.sql.shuffle.partitions", str(n))
        claims = own.createDataFrame(rows, "id long, type string, content string, pos long").repartition(n)
        found.append([tuple((r["place"], r["id"]) for r in R.select_claims(claims, "gpu cache gpu", cap).orderBy("place").collect()) for cap in (10, 120, 150, 1000)])
        assert [len(x) for x in found[-1]] == [10, 120, 150, 300] and all([p for p, _ in x] == list(range(1, len(x) + 1)) for x in found[-1])
    assert found[0] == found[1] == found[2]


def test_near_vectors_skip_tiles(spark):
    """Clustered vectors: the same pairs as all against all, from less than half of the pairs of tiles."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(8, 16))
    x = centres[rng.integers(0, 8, 900)] + rng.normal(size=(900, 16)) * 0.15
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, "code" if i % 3 else "fact", f"v{i % 5}", i % 5, v.tolist()) for i, v in enumerate(x)] + [(1000, "fact", "v0", 0, None), (1001, None, "v1", 1, x[0].tolist()), (1002, "fact", "v3", 3, [0.0] * 16)]
    df = spark.createDataFrame(rows, "id long, type string, video_id string, rank int, embedding array<double>")
    for least, other in (({"code": 0.8}, 0.95), ({}, -0.2)):
        got = {(r["older_id"], r["newer_id"]): r["similarity"] for r in L.near_vectors(df, least, other, tile=32).collect()}
        plain = [(i, t, v, k, np.zeros(16) if e is None else np.array(e)) for i, t, v, k, e in rows if t]
        want = {(a[0], b[0]): float(a[4] @ b[4]) for a in plain for b in plain if a[1] == b[1] and a[3] < b[3] and a[4] @ b[4] >= least.get(a[1], other)}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    own = df.where("type IS NOT NULL")
    pivots = L.pivots_of(own, 32)
    pairs = L.cell_pairs(L.cell_bounds(L.celled(own, pivots), pivots), {"code": 0.8}, 0.95, 32).collect()
    kept = sum(r["_tiles"] * w["tiles"] for r in pairs for w in r["_with"])
    per_type = {}
    for r in pairs:
        per_type[r["type"]] = per_type.get(r["type"], 0) + r["_tiles"]
    assert kept < 0.5 * sum(n * n for n in per_type.values())


def test_successors(spark):
    """The same claims, successors and counts as from all links; the links go through no shuffle once tiles are made."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    words = [f"t{i}" for i in range(40)]
    rows = [(i, "code" if i % 3 else "fact", " ".join(rng.choice(words, rng.integers(0, 12))), f"v{i % 7}", float(i % 11), v.tolist() if i % 50 else None) for i, v in enumerate(x)]
    claims = spark.createDataFrame(rows, "id long, type string, content string, video_id string, ts_start double, embedding array<double>").repartition(3)
    ranks = spark.createDataFrame([(f"v{i}", i // 2) for i in range(6)], "video_id string, rank int")
    links = L.links(claims, ranks, 0.5, 0.2, 0.3)
    assert "CartesianProduct" in (plan := links._jdf.queryExecution().executedPlan().toString()) and "Exchange" not in plan
    rank, want = {f"v{i}": i // 2 for i in range(6)}, {}
    for i, t, c, v, at, e in rows:
        for j, u, d, w, _, f in rows:
            if t == u and v != w and rank.get(v, 0) < rank.get(w, 0):
                s = float(np.dot(e, f)) if e and f else 0.0
                a, b = set(c.split()), set(d.split())
                if s >= 0.5 if t == "fact" else s >= 0.3 and a and b and len(a & b) / len(a | b) >= 0.2:
                    want[i, j] = s
    got = {(r["older_id"], r["newer_id"]): r["similarity"] for r in links.collect()}
    assert len(want) > 500 and set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    applied = {(r["older_id"], r["superseded_by"], r["n_links"]) for r in L.apply(links, claims).collect()}
    for tile in (2048, 32):
        assert {(r["older_id"], r["superseded_by"], r["n_links"]) for r in L.successors(claims, ranks, 0.5, 0.2, 0.3, tile).collect()} == applied


def test_alike_sets(spark):
    rng = random.Random(8)
    base = [rng.sample(range(60), rng.randint(1, 25)) for _ in range(60)]
    rows = [(i, rng.choice("ab"), [f"e{v}" for v in (b if rng.random() < 0.5 else b[: max(1, len(b) - 2)] + [99])]) for i, b in enumerate(base * 3)] + [(999, "a", []), (1000, "a", None)]
    df = spark.createDataFrame(rows, "id long, g string, s array<string>")
    for least in (0.5, 0.75, 1.0):
        want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and a[2] and b[2] and len({*a[2]} & {*b[2]}) / len({*a[2]} | {*b[2]}) >= least}
        assert {(r["a"], r["b"]) for r in L.alike_sets(df, "id", "g", "s", least).collect()} == want


def test_alike_sets_compare_equal_sets_once(spark, monkeypatch):
    """40 copies of each of 30 sets: all pairs are found, but only those of different sets go through the comparison."""
    staged, seen = L.staged, {}

    def counting(df, name):
        out = staged(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(L, "staged", counting)
    base = [[f"e{k}" for k in range(100 * (i // 2), 100 * (i // 2) + 20 + i % 2)] for i in range(30)]
    rows = [(i, "g", list(reversed(b)) if i % 3 else b) for i, b in enumerate(base * 40)]
    got = {(r["a"], r["b"]) for r in L.alike_sets(spark.createDataFrame(rows, "id long, g string, s array<string>"), "id", "g", "s", 0.75).collect()}
    assert got == {(a, b) for a in range(1200) for b in range(a + 1, 1200) if a % 30 // 2 == b % 30 // 2}
    assert seen["alike-coded"] == 30 and seen["alike-pairs"] == 15


def test_alike_sets_read_their_rows_once(spark, tmp_path):
    spark.createDataFrame([(1, "g", "a b c"), (2, "g", "a b c d")], "id long, g string, t string").write.parquet(str(tmp_path / "once"))
    rows = spark.read.parquet(str(tmp_path / "once")).select("id", "g", F.split("t", " ").alias("s"))
    found = L.alike_sets(rows, "id", "g", "s", 0.75)
    assert "once" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 1


YAML = """---
# comment
budget_usd:
  per_chapter_max: 5.00   # each
  total_max: 150
canonical_refs:
  - id: raschka
    title: "Build # a Model (From \\"Scratch\\")"
    year: 2024
  - id: second
    tags:
    - a
    - 'it''s'
    nested:
      deep: 'x: y'
    last: end#no
plain:
- https://v/1#t
- "two words"   # said
-
  key: in item
'quoted key': v
empty:
url: http://a/b:c
"""


def test_settings(spark, tmp_path):
    (tmp_path / "p.yaml").write_text(YAML)
    got = {r["name"]: r["value"] for r in files.yaml_settings(spark, str(tmp_path / "p.yaml")).collect()}
    assert got == {
        "budget_usd.per_chapter_max": "5.00", "budget_usd.total_max": "150", "canonical_refs.0.id": "raschka", "canonical_refs.0.title": 'Build # a Model (From "Scratch")', "canonical_refs.0.year": "2024",
        "canonical_refs.1.id": "second", "canonical_refs.1.tags.0": "a", "canonical_refs.1.tags.1": "it's", "canonical_refs.1.nested.deep": "x: y", "canonical_refs.1.last": "end#no",
        "plain.0": "https://v/1#t", "plain.1": "two words", "plain.2.key": "in item", "quoted key": "v", "url": "http://a/b:c",
    }
