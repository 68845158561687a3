"""Folds, windows, alignment and budgets against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from attesta.operators import alignment as A
from attesta.operators import budget as B
from attesta.operators import sequence as S


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [(k, i, rng.randint(1, 9), rng.random(), rng.getrandbits(8)) for k in "abc" for i in range(rng.choice((0, 1, 40, 90)) + 30)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, i int, d int, density double, bits long").repartition(5)


def test_resetting_windows(df, rows):
    want, state = {}, {}
    for k, i, d, *_ in rows:
        total, n = state.get(k, (0, 0))
        want[k, i] = n
        state[k] = (0, n + 1) if total + d >= 30 else (total + d, n)
    got = {(r["k"], r["i"]): r["window_no"] for r in S.resetting_windows(df, ["k"], ["i"], "d", 30).collect()}
    assert got == want


def test_greedy_frames(df, rows):
    want, state = {}, {}
    for k, i, _, density, bits in rows:
        last, kept = state.get(k, (None, []))
        if density < 0.2:
            v = "density"
        elif last is not None and i - last < 2:
            v = "spacing"
        elif any(bin(bits ^ b).count("1") <= 1 for b in kept):
            v = "hamming"
        else:
            v, last, kept = "kept", i, [*kept, bits]
        state[k] = (last, kept)
        want[k, i] = v
    got = {(r["k"], r["i"]): r["verdict"] for r in S.greedy_frames(df, ["k"], ["i"], "i", "density", "bits", 0.2, 2, 1).collect()}
    assert got == want and set(want.values()) == {"density", "spacing", "hamming", "kept"}


def test_downsample(spark):
    for n, cap in ((10, 4), (7, 7), (5, 9), (400, 150)):
        got = {r["id"] for r in S.downsample(spark.range(n).withColumn("k", F.lit(1)), ["k"], ["id"], cap).collect()}
        assert got == (set(range(n)) if n <= cap else {int(i * (n / cap)) for i in range(cap)})


def test_boundaries_and_merge(spark):
    pieces = spark.createDataFrame([("v", i, w) for i, w in enumerate((50, 300, 20, 20, 250, 10))], "k string, piece int, words int")
    assert [r["group_no"] for r in S.merge_small(pieces, ["k"], 200).orderBy("piece").collect()] == [0, 1, 1, 1, 2, 2]
    vectors = spark.createDataFrame([("v", 0, [1.0, 0.0]), ("v", 1, [1.0, 0.0]), ("v", 2, [0.0, 1.0]), ("v", 3, None)], "k string, i int, e array<double>")
    got = S.boundaries(S.with_lag_similarity(vectors, ["k"], ["i"], "e"), ["k"], ["i"]).orderBy("i").collect()
    assert [r["piece"] for r in got] == [0, 0, 1, 1]


def test_video_rank(spark):
    v = spark.createDataFrame([("b", "20240101"), ("a", "20240101"), ("z", None)], "video_id string, upload_date string")
    assert {r["video_id"]: r["rank"] for r in S.video_rank(v).collect()} == {"z": 0, "a": 1, "b": 2}


def test_frames_in_segments(spark):
    segments = spark.createDataFrame([("v", 0, 0.0, 10.0), ("v", 1, 10.0, 20.0), ("v", 2, 100.0, 130.0), ("w", 0, 0.0, 5.0)], "video_id string, segment_id int, ts_start double, ts_end double")
    frames = spark.createDataFrame([("v", "f1", 10.0), ("v", "f2", 3.0), ("v", "f3", 50.0), ("v", "f4", 129.0), ("w", "g", 9.0)], "video_id string, frame_id string, timestamp_sec double")
    vision = spark.createDataFrame([("f1", False), ("f2", True), ("f4", None)], "frame_id string, skip boolean")
    for size in (1.0, 7.0, 1000.0):
        got = {(r["video_id"], r["segment_id"]): (r["frame_ids"], r["visual_ids"]) for r in A.align_frames(segments, frames, vision, size).collect()}
        assert got == {("v", 0): (["f2", "f1"], ["f1"]), ("v", 1): (["f1"], ["f1"]), ("v", 2): (["f4"], ["f4"]), ("w", 0): ([], [])}
    totals = {r["video_id"]: (r["frames_total"], r["frames_with_content"]) for r in A.frame_totals(A.align_frames(segments, frames, vision)).collect()}
    assert totals == {"v": (4, 3), "w": (0, 0)}


def test_chapters(spark):
    chapters = spark.createDataFrame([("v", 0, "a", 0.0, 10.0), ("v", 1, "b", 10.0, 20.0), ("v", 2, "c", 20.0, 40.0)], "video_id string, chapter_pos int, title string, start_time double, end_time double")
    segments = spark.createDataFrame([("v", 0, 1.0, 5.0), ("v", 1, 8.0, 12.0), ("v", 2, 25.0, 40.0)], "video_id string, segment_id int, ts_start double, ts_end double")
    got = {r["segment_id"]: r["topic_id"] for r in A.chapters_of_segments(segments, chapters, 10.0).collect()}
    assert got == {0: "v_000", 2: "v_001"}


def test_ordinals(spark):
    files = spark.createDataFrame([("v", "a.jpg"), ("v", "b.jpg"), ("v", "c.jpg")], "video_id string, file string")
    stamps = spark.createDataFrame([("v", 1, 0.5), ("v", 2, 7.5)], "video_id string, frame_no int, pts_time double")
    assert [r["timestamp_sec"] for r in A.ordinal_timestamps(files, stamps).orderBy("file").collect()] == [0.5, 7.5, 2.0]


def log(spark, rows):
    return spark.createDataFrame(rows, "stage string, usd double")


def test_budget(spark):
    assert B.check(log(spark, [("a", 1.5), ("b", 0.75)]), 0.0, 10.0).first()["total"] == 2.25
    assert not B.check(log(spark, [("a", 4.0)]), 2.0, 5.0).first()["accepted"]
    assert not B.check(log(spark, [("chapter:intro", 1.5)]), 1.0, 100.0, "intro", 2.0).first()["accepted"]
    assert B.check(log(spark, [("a", 5.0)]), 1.0, 100.0).first()["accepted"]
    assert B.check(log(spark, []), 1.0, 1.0).first()["accepted"]


def test_admission(spark):
    rows = spark.createDataFrame([("k", i, x) for i, x in enumerate((4, 3, 9, 2, 2))], "k string, i int, x int")
    assert [r["accepted"] for r in B.admit(rows, ["k"], ["i"], "x", 9).orderBy("i").collect()] == [True, True, False, True, False]
    assert [r["rejected"] for r in B.running(rows, ["k"], ["i"], "x", 9).orderBy("i").collect()] == [False, False, True, True, True]


def test_empty(spark):
    none = spark.createDataFrame([], "k string, i int, d int, density double, bits long")
    assert S.resetting_windows(none, ["k"], ["i"], "d", 30).count() == 0
    assert S.greedy_frames(none, ["k"], ["i"], "i", "density", "bits").count() == 0
