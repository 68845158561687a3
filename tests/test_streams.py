"""Streams with state: runs that go on from a checkpoint, repeated batches, timers; and the index of hashes they use."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.functions.nearhash import NearHashes
from attesta.operators import budget as B
from attesta.operators import sequence as S
from attesta.streaming import events as E
from attesta.streaming import stateful as T


def near(a: int, b: int) -> int:
    return (int(a) ^ int(b)).bit_count()


@pytest.mark.parametrize("distance", (0, 1, 6, 14, 20))
def test_near_hashes(distance):
    rng = np.random.default_rng(distance)
    index, known = NearHashes(distance), []
    for _ in range(6):
        new = rng.integers(0, 1 << 63, 700, dtype=np.uint64)
        asked = np.concatenate([new[:100], *(np.array(known[:200], np.uint64) ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, n, replace=False))) for n in (distance, distance + 1) if known)])
        got = index.near(asked)
        brute = np.zeros(len(asked), bool)
        for at in range(0, len(known), 512):
            brute |= (np.bitwise_count(asked[:, None] ^ np.array(known[at : at + 512], np.uint64)) <= distance).any(1)
        assert (got == brute).all()
        index.add(new)
        known += new.tolist()
    assert len(index) == len(known)


def test_few_candidates_among_very_many():
    """A hundred thousand kept hashes: a frame meets a small share of them."""
    rng = np.random.default_rng(1)
    index = NearHashes(6)
    state = S.KeptFrames(0.0, 0.0, 6)
    state.index = index
    n = 100_000
    verdicts, added = state.judge(np.arange(n, dtype=float), np.ones(n), rng.integers(-(1 << 63), 1 << 63, n))
    assert verdicts.count("kept") == len(added) > 0.999 * n
    assert index.compared < n * n / 500


def frames(spark, n: int = 400):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), i, float(i) + rng.random() / 2, rng.random(), rng.getrandbits(9)) for i in range(n)]
    return spark.createDataFrame(rows, "k string, id int, t double, density double, bits long")


def test_stream_of_frames_is_the_batch(spark, tmp_path):
    own = T.session(spark, 3)
    rows = frames(spark)
    want = {(r["k"], r["id"]): r["verdict"] for r in S.greedy_frames(rows, ["k"], ["t", "id"], "t", "density", "bits", 0.2, 1.5, 1).collect()}
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    for low, high in ((0, 90), (90, 91), (91, 300), (300, 400)):
        rows.where(f"id >= {low} AND id < {high}").repartition(3).write.mode("append").parquet(path)
        E.run_available(T.frames(E.read(own, path, rows.schema), "k", "id", "t", "density", "bits", 0.2, 1.5, 1), out, checkpoint)
        assert spark.read.parquet(out).count() == high  # each frame once
    E.run_available(T.frames(E.read(own, path, rows.schema), "k", "id", "t", "density", "bits", 0.2, 1.5, 1), out, checkpoint)
    got = {(r["k"], r["id"]): r["verdict"] for r in spark.read.parquet(out).collect()}
    assert got == want and set(got.values()) == {"density", "spacing", "hamming", "kept"}


def test_guard_goes_on_where_it_stopped(spark, tmp_path):
    """Stopped after some files and run again: nothing is spent twice, and what was spent is remembered."""
    own = T.session(spark, 3)
    rows = spark.createDataFrame([(k, i, x) for k, seed in (("a", 1), ("b", 2)) for i, x in enumerate(random.Random(seed).choices(range(1, 30), k=60))], "k string, id int, x long")
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    guard = lambda: T.guard(E.read(own, path, rows.schema, files_per_batch=1), "k", "id", ["id"], "x", 200)
    for part in range(4):
        rows.where(f"id DIV 15 = {part}").coalesce(1).write.mode("append").parquet(path)
        if part % 2:
            E.run_available(guard(), out, checkpoint)
    got = spark.read.parquet(out)
    want = {(r["k"], r["id"]): r["accepted"] for r in B.admit(rows, ["k"], ["id"], "x", 200).collect()}
    assert {(r["k"], r["id"]): r["accepted"] for r in got.collect()} == want and got.count() == 120
    totals = got.where("accepted").join(rows, ["k", "id"]).groupBy("k").agg(F.sum("x").alias("s"), F.max("spent").alias("m")).collect()
    assert all(r["s"] == r["m"] <= 200 for r in totals)


def test_windows_by_event_time(spark, tmp_path):
    own = T.session(spark, 3)
    rng = random.Random(3)
    rows = [(rng.choice("ab"), i, 1_700_000_000 + 60 * i, rng.randint(1, 9)) for i in range(200)] + [("end", -1, 1_800_000_000, 0)]
    df = spark.createDataFrame(rows, "k string, id int, s long, d long").select("k", "id", F.timestamp_seconds("s").alias("ts"), "d")
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    order = sorted(range(200), key=lambda i: i + rng.randint(0, 25)) + [-1]  # up to 25 minutes late
    for at in range(0, 201, 70):
        ids = order[at : at + 70]
        df.where(F.col("id").isin(ids)).write.mode("append").parquet(path)
        E.run_available(T.windows(E.read(own, path, df.schema), "k", "id", "ts", "d", 30, "30 minutes"), out, checkpoint)
    got = {(r["k"], r["id"]): (r["window_no"], r["closes"]) for r in spark.read.parquet(out).collect()}
    want = S.resetting_windows(df.where("k <> 'end'"), ["k"], ["ts", "id"], "d", 30).collect()
    assert {i: n for i, (n, _) in got.items()} == {(r["k"], r["id"]): r["window_no"] for r in want}
    closing = {}
    for r in want:
        closing.setdefault((r["k"], r["window_no"]), []).append(r["id"])
    last = {k: max(v[1] for v in closing if v[0] == k) for k in "ab"}
    assert {i for i, (_, c) in got.items() if c} >= {(k, max(ids)) for (k, n), ids in closing.items() if n < last[k]}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    write = T.only_new(["k"], ["i"])
    make = lambda rows: spark.createDataFrame(rows, "k string, i int, v string")
    first, second = make([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), (None, 1, "n")]), make([("b", 1, "w"), ("c", 1, "u")])
    read = lambda: sorted((r["k"] or "", r["i"], r["v"]) for r in spark.read.schema(first.schema).parquet(table).collect())
    write(first, table, 0)
    write(second, table, 1)
    assert read() == [("", 1, "n"), ("a", 1, "y"), ("b", 5, "z"), ("c", 1, "u")]
    for batch, number in ((second, 1), (first, 0), (second, 1)):
        write(batch, table, number)
    assert read() == [("", 1, "n"), ("a", 1, "y"), ("b", 5, "z"), ("c", 1, "u")]
    versions = str(tmp_path / "v")
    for number, rows in enumerate(([("a", 1, "x"), (None, 1, "n")], [("a", 2, "y")], [(None, 3, "m")])):
        for _ in range(2):
            T.all_versions(make(rows), versions, number)
    assert sorted((r["k"] or "", r["i"], r["v"]) for r in T.newest(spark, versions, "k string, i int, v string", ["k"]).collect()) == [("", 3, "m"), ("a", 2, "y")]
