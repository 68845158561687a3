"""What the queries on supersession shuffle."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from attesta.operators import lineage as L
from attesta.plans import registry, similarity


def shuffled(spark) -> int:
    """Bytes that this session has written to shuffles so far."""
    store = spark.sparkContext._jsc.sc()
    store.listenerBus().waitUntilEmpty(30_000)
    return store.statusStore().executorList(False).apply(0).totalShuffleWrite()


@pytest.mark.parametrize("name", ["superseded_ids", "outline_pruned", "supersession_links"])
def test_texts_stay(spark, name, tmp_path):
    """No join shuffles the texts, at sizes where no table is broadcast by itself."""
    pick = random.Random(3)
    texts = [f"{pick.getrandbits(1 << 16):x}" for _ in range(200)]
    spark.createDataFrame([(i, t, "en", f"s{i % 5}") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, [pick.gauss(0, 1) for _ in range(8)], i % 10) for i in range(0, 200, 3)], "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        at = shuffled(spark)
        registry.QUERIES[name](spark, str(tmp_path)).write.format("noop").mode("overwrite").save()
        used = shuffled(spark) - at
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert used < sum(map(len, texts)) / 4


def test_same_claims(spark, tmp_path):
    """The claims that are compared are those of the table, with repeated ids, null labels and null texts; only the texts of code are there."""
    docs = [(1, "a b", "s"), (1, "c", "t"), (2, None, "s"), (3, "d", None), (4, "e", "s"), (5, "no vector", "s"), (None, "f", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents")
    vectors = [(1, [1.0], 0), (1, [2.0], 3), (2, [3.0], 0), (3, [4.0], None), (4, None, 0), (None, [5.0], 0)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings")
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    want = similarity.claims(read).withColumn("content", F.when(F.col("type") == "code", F.col("content")))
    assert sorted(map(str, similarity.compared(read).collect())) == sorted(map(str, want.collect()))


def test_alike_sets_shuffle_elements_once(spark):
    """What is shuffled grows with the elements, not with the rows and pairs of a join: 8 bytes each and what sets and words need."""
    pick = random.Random(5)
    words = [f"w{k}" for k in range(3000)]
    rows = [(i, "g", pick.sample(words, 250)) for i in range(1200)]
    rows += [(2000 + i, "g", s[:-5] + ["x"]) for i, _, s in rows[:100]]
    spark.createDataFrame(rows, "id long, g string, s array<string>").write.mode("overwrite").saveAsTable("alike_rows")
    at = shuffled(spark)
    found = L.alike_sets(spark.table("alike_rows"), "id", "g", "s", 0.75)
    assert {(r["a"], r["b"]) for r in found.collect()} == {(i, 2000 + i) for i in range(100)}
    assert shuffled(spark) - at < 9 * sum(len(s) for _, _, s in rows)
    spark.sql("DROP TABLE alike_rows")


def test_alike_sets_in_tiles(spark):
    """Groups of many tiles, of one, and none; a null group has no pairs."""
    pick = random.Random(6)
    base = [pick.sample(range(80), pick.randint(1, 30)) for _ in range(70)]
    rows = [(i, pick.choice(["a", "a", "a", "b", None]), [f"e{v}" for v in (b if pick.random() < 0.4 else b[: max(1, len(b) - pick.randint(1, 4))] + [90 + i % 3])]) for i, b in enumerate(base * 4)]
    df = spark.createDataFrame(rows, "id long, g string, s array<string>").coalesce(2)
    for least in (0.6, 0.75, 1.0):
        want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] and a[1] == b[1] and len({*a[2]} & {*b[2]}) / len({*a[2]} | {*b[2]}) >= least}
        got = [(r["a"], r["b"]) for r in L.alike_sets(df, "id", "g", "s", least, 300).collect()]
        assert len(want) > 20 and sorted(got) == sorted(want)
