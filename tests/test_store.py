"""The claim store and its loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import claims as C
from attesta.operators import reports as R
from attesta.sources.tables import CLAIMS


def store(spark, rows):
    full = [(i, k, c, v, t, t + 10, [], 0.9, "abc", None) for i, k, c, v, t in rows]
    return spark.createDataFrame(full, CLAIMS)


def test_insert_and_get(spark):
    empty = store(spark, [])
    new = store(spark, [(None, "fact", "foo", "vid1", 0.0), (None, "fact", "bar", "vid1", 5.0)])
    got = C.add(empty, new, ["video_id", "ts_start"])
    assert [r["content"] for r in got.orderBy("id").collect()] == ["foo", "bar"]
    assert C.by_id(got, 1).first()["content"] == "foo"
    again = C.add(got, new, ["video_id", "ts_start"])
    assert sorted(r["id"] for r in again.collect()) == [1, 2, 3, 4]


def test_request_order(spark):
    own = store(spark, [(1, "fact", "a", "v", 0.0), (2, "fact", "b", "v", 1.0), (3, "fact", "c", "v", 2.0)])
    request = spark.createDataFrame([(0, 3), (1, 1), (2, 77)], "pos int, id long")
    assert [r["content"] for r in C.in_request_order(own, request).collect()] == ["c", "a"]


def test_by_video_and_assignment(spark):
    own = store(spark, [(1, "fact", "a", "vid1", 5.0), (2, "fact", "b", "vid2", 1.0), (3, "fact", "c", "vid1", 2.0)])
    assert [r["content"] for r in C.by_video(own, "vid1").collect()] == ["c", "a"]
    given = spark.createDataFrame([("ch", 1), ("ch", 3), ("ch", 3), ("x", 2)], "chapter_id string, claim_id long")
    once = C.insert_or_ignore(given.limit(0), given, ["chapter_id", "claim_id"])
    assert [r["content"] for r in C.for_chapter(own, once, "ch").collect()] == ["c", "a"]


def test_citations_round_trip(spark):
    schema = "chapter_id string, index int, text string, type string, cited_claim_ids array<string>, status string, reason string"
    rows = spark.createDataFrame([("c1", 0, "s0", "factual", ["c1", "C2]"], "grounded", ""), ("c1", 1, "s1", "factual", [], "unsupported", ""), ("c1", 2, "s2", "narrative", None, "narrative_ok", "")], schema)
    cites = C.citation_rows(rows)
    assert cites.count() == 4
    assert {(r["status"], r["n"]) for r in R.status_counts(cites).collect()} == {("grounded", 1), ("unsupported", 1), ("narrative_ok", 1)}
    assert {r["status"]: r["n"] for r in R.chapter_counts(cites).collect()} == {"grounded": 1, "unsupported": 1, "narrative_ok": 1}
    one = {r["sentence_index"]: r["claim_ids"] for r in R.one_row_per_sentence(cites).collect()}
    assert one == {0: [1, 2], 1: [], 2: []}
    # a repeated load replaces, null claims included
    loads = cites.withColumn("load", F.lit(1)).union(cites.withColumn("load", F.lit(2)))
    assert C.insert_or_replace(loads, ["chapter_id", "sentence_index", "claim_id"], "load").count() == 4


def test_defaults_and_confidence(spark):
    schema = "video_id string, content string, type string, confidence double, ts_start double, ts_end double, frame_ids array<string>, segment_start double, segment_end double"
    rows = spark.createDataFrame([("v", " a ", None, None, None, None, None, 1.0, 2.0), ("v", "b", "code", 0.6, 0.0, 3.0, ["f"], 1.0, 2.0)], schema)
    a, b = C.with_defaults(rows).orderBy("content").collect()
    assert (a["content"], a["type"], a["confidence"], a["ts_start"], a["ts_end"], a["frame_ids"]) == ("a", "fact", 1.0, 1.0, 2.0, [])
    assert b["ts_start"] == 0.0
    assert [r["content"] for r in C.confident(rows).collect()] == [" a "]


def test_numbering_over_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    got = C.number(df, ["x"]).collect()
    assert all(r["x"] + 1 == r["_n"] for r in got)


def test_numbering_loses_no_row(spark):
    """Wide rows in small partitions: ranges are coalesced differently with and without the wide column, numbers stay 1 to n."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("x"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("wide"))
        got = C.number(df, ["x"]).select("x", "_n").collect()
        assert sorted(r["_n"] for r in got) == list(range(1, 20_001))
        assert [r["_n"] for r in sorted(got, key=lambda r: r["x"])] == list(range(1, 20_001))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_extra(spark):
    rows = spark.createDataFrame([(1, {"b": "1", "a": '"x"'}), (2, None), (3, {"k": "true"})], "id long, extra map<string,string>")
    new = spark.createDataFrame([(1, {"b": "2"}), (2, {'q"': "[1]"})], "id long, extra map<string,string>")
    got = {r["id"]: r["j"] for r in C.merge_extra(rows, new).select("id", C.extra_json(F.col("extra")).alias("j")).collect()}
    assert got == {1: '{"a":"x","b":2}', 2: '{"q\\"":[1]}', 3: '{"k":true}'}


def test_lookup(spark):
    r = C.lookup(store(spark, [(1, "fact", "a", "vid", 125.9)])).first()
    assert r["starts"] == "2m5s" and r["url"].endswith("v=vid&t=125s")
