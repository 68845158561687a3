"""Near-duplicates of vectors and texts, repeated passages, components: against brute force."""

from __future__ import annotations

import itertools
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from attesta.llm import components, embedding_dedup, simhash, substring_dedup


class Sets:
    def __init__(self, items):
        self.p = {i: i for i in items}

    def find(self, x):
        while self.p[x] != x:
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.p[max(a, b)] = min(a, b)


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 60)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (None, 3)]
    rng.shuffle(links)
    got = {r["node"]: r["component"] for r in components.connected(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    sets = Sets({x for l in links for x in l if x is not None})
    for a, b in links:
        if a is not None:
            sets.join(a, b)
    linked = {x for a, b in links if a is not None and a != b for x in (a, b)}
    assert got == {x: sets.find(x) for x in linked}
    assert components.connected(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def brute_vectors(rows, threshold=0.93):
    good = [(i, np.array(v, float), l) for i, v, l in rows if i is not None and v is not None and l is not None and len(v) and None not in v and np.isfinite(v).all() and any(v)]
    sets, n = Sets({i for i, *_ in good}), {i: 0 for i, *_ in good}
    for (i, x, l), (j, y, m) in itertools.combinations(good, 2):
        if l == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
            n[i] += 1
            n[j] += 1
            sets.join(i, j)
    return {i: (n.get(i, 0), sets.find(i) if i in n else i) for i, *_ in rows if i is not None}


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * rng.choice([0, 0.05, 0.2, 0.4])).tolist(), int(i % 12 % 3)) for i in range(300)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(40)]
    odd = [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] + [1.0] * 15, 0), (2003, rows[0][1], None), (2004, [None] + [1.0] * 15, 0), (2005, rows[0][1][:8], 0), (2006, [], 0), (2007, [float("inf")] * 16, 1), (2008, [x * 1e30 for x in rows[0][1]], 0)]
    rows += odd
    df = spark.createDataFrame([(i, v, l, 1) for i, v, l in rows], "vec_id long, embedding array<double>, label int, n_links int").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.components(spark, df, tile=32).collect()}
    assert got == brute_vectors(rows)
    assert {i: got[i] for i, *_ in odd if i != 2008} == {i: (0, i) for i, *_ in odd if i != 2008}


def test_embeddings_empty_and_null_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 0), (5, [1.0, 0.0], 0), (5, [1.0, 0.0], 0)], "vec_id long, embedding array<float>, label int")
    got = sorted(((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.components(spark, df).collect()), key=str)
    assert got == [(-1, 0, None, False), (5, 1, 5, True), (5, 1, 5, True)]
    assert embedding_dedup.components(spark, df.limit(0)).count() == 0


def test_error_bound():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, n, e = embedding_dedup.quantise(x)
    product = (q.astype(float) @ q.astype(float).T) * s[:, None] * s
    assert (np.abs(product - x @ x.T) <= n[:, None] * e + e[:, None] + 1e-12).all()


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_fingerprints():
    rng = random.Random(4)
    for _ in range(100):
        t = "".join(rng.choice("AbC é\t\n\xa0 ") for _ in range(rng.randrange(80)))
        assert simhash.fingerprint(t) == brute_fingerprint(t)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("bucket", [4096, 20])
def test_fingerprint_links(spark, bucket):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(4)] + [(1 << 64) - 1, 0]
    values = set()
    while len(values) < 160:
        x = rng.choice(base)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        values.add(x)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(spark, spark.createDataFrame([(v,) for v in signed], "fp long"), bucket=bucket)
    sets, want = Sets(signed), Sets(signed)
    for r in links.collect():
        assert bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") <= 64
        sets.join(r["a"], r["b"])
    for a, b in itertools.combinations(signed, 2):
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2:
            want.join(a, b)
    assert {v: sets.find(v) for v in signed} == {v: want.find(v) for v in signed}


def test_trie_join_gives_pairs():
    rng = np.random.default_rng(6)
    for _ in range(30):
        v = np.unique((rng.integers(0, 4, 40) << 62 | 1 << rng.integers(0, 8, 40)).astype(np.uint64))
        i, j = simhash.trie_join(v, np.array([0, len(v)]), 2, frontier=16)
        got = sorted((min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist()))
        assert got == [(a, b) for a, b in itertools.combinations(range(len(v)), 2) if bin(int(v[a] ^ v[b])).count("1") <= 2]
    wide = rng.integers(0, 4, (60, 3)).astype(np.uint64)
    wide = np.unique(wide, axis=0)
    i, j = simhash.trie_join(wide, np.array([0, 20, len(wide)]), 3)
    bits = lambda a, b: sum(bin(int(x)).count("1") for x in wide[a] ^ wide[b])
    assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a, b in itertools.combinations(range(len(wide)), 2) if (a < 20) == (b < 20) and bits(a, b) <= 3]


def test_dense_fingerprints_take_bounded_memory():
    """8,192 near copies in one bucket: all become one component, and the walk holds a few MB."""
    rng = np.random.default_rng(7)
    values = {0}
    while len(values) < 8192:
        values.add(int(np.bitwise_xor.reduce(np.uint64(1) << rng.choice(64, rng.integers(1, 5), replace=False).astype(np.uint64))))
    keys = pa.array(np.zeros(len(values), np.int64))
    fps = pa.array(np.array(sorted(values), np.uint64).view(np.int64))
    tracemalloc.start()
    out = list(simhash.bucket_links(iter([pa.RecordBatch.from_arrays([keys, fps], ["key", "fp"])]), 2))
    assert tracemalloc.get_traced_memory()[1] < 64 << 20
    tracemalloc.stop()
    sets = Sets(values)
    for a, b in zip(*(np.concatenate([b.column(k).to_numpy() for b in out]).view(np.uint64).tolist() for k in (0, 1))):
        sets.join(a, b)
    assert len({sets.find(v) for v in values}) == 1


def shingles(text, k=5):
    words = text.lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


@pytest.mark.parametrize("bucket", [2048, 16])
def test_near_copies(spark, bucket):
    """Five-word shingles: pairs of a Jaccard similarity of 0.8 or more, by brute force, share a component; unlike texts do not."""
    rng = random.Random(17)
    rows, base = [], {}
    for g in range(60):
        text = prose(rng, rng.randrange(80, 400))
        for _ in range(40 if g == 5 else rng.choice([1, 2, 2, 3])):
            own = [w if rng.random() > 0.012 else "edit" + str(rng.randrange(10**6)) for w in text]
            base[len(rows)] = g
            rows.append((len(rows), " ".join(own)))
    extra = [(10_000, rows[3][1].upper()), (10_001, None), (10_002, ""), (10_003, "two words"), (10_004, "two  WORDS"), (None, rows[3][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows + extra], "doc_id long, text string, component_id int").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(spark, df, bucket=bucket).collect()}
    assert len(got) == len(rows) + len(extra)
    sets = [shingles(t) for _, t in rows]
    near = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if base[a] == base[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(near) > 60 and np.mean([got[a] == got[b] for a, b in near]) >= 0.95
    assert all(base[got[i]] == base[i] for i in base)
    assert got[10_000] == got[3] == got[None] and got[10_001] == got[10_002] == 10_001 and got[10_003] == got[10_004] == 10_003
    assert simhash.near_copies(spark, df.limit(0)).count() == 0
    alone = df.where("doc_id IN (10001, 10003)")
    assert sorted(r["component_id"] for r in simhash.near_copies(spark, alone).collect()) == [10_001, 10_003]


def test_simhash_components(spark):
    rows = [(3, "a b c d"), (1, "A B\tC d"), (2, None), (7, ""), (5, "quite another text about other things"), (None, "a b c d"), (9, " ")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, fingerprint string")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.components(spark, df).collect()}
    assert {i: got[i][0] for i, _ in rows} == {i: f"{brute_fingerprint(t):016x}" for i, t in rows}
    assert {i: got[i][1] for i, _ in rows} == {3: 1, 1: 1, 2: 2, 7: 2, 9: 2, 5: 5, None: 1}
    assert simhash.components(spark, df.limit(0)).count() == 0


def prose(rng, n):
    return [rng.choice("abcdefghijklmnop") + rng.choice("aeiou") + rng.choice("lmnrst") + str(rng.randrange(300)) for _ in range(n)]


def test_passages(spark):
    rng = random.Random(8)
    passage = prose(rng, 70)
    fuzzy = [w if i % 15 else "edited" for i, w in enumerate(passage)]
    a = " ".join(prose(rng, 100) + passage + prose(rng, 50))
    b = "Été \n" + " ".join(prose(rng, 30) + passage + prose(rng, 200))
    c = " ".join(prose(rng, 20) + fuzzy + prose(rng, 20))
    clean = " ".join(prose(rng, 400))
    short = " ".join(prose(rng, 50) + passage[:20] + prose(rng, 50))
    rows = [(1, a), (2, b), (3, c), (4, clean), (5, short), (6, None), (7, ""), (8, a), (9, "one"), (None, a), (10, a.upper())]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start int")
    texts = dict(rows)
    got = substring_dedup.passages(spark, df).collect()
    assert {r["doc_id"] for r in got} == {2, 3, 8, 10} and all(r["source_id"] < r["doc_id"] for r in got)
    by = {r["doc_id"]: r for r in got if r["source_id"] == 1}
    assert b[by[2]["start"] : by[2]["end"]] == " ".join(passage) == a[by[2]["source_start"] : by[2]["source_end"]]
    assert by[2]["n_words"] == by[2]["equal_words"] == 70
    assert by[3]["n_words"] >= 60 and by[3]["identity"] >= 0.9
    assert (by[8]["start"], by[8]["end"]) == (0, len(a)) and (by[10]["start"], by[10]["end"]) == (0, len(a))
    kept = {r["doc_id"]: r["text"] for r in substring_dedup.without_passages(spark, df).collect()}
    assert set(kept) == {1, 2, 3, 4, 5, 6, 7, 9, None} and kept[4] == clean and kept[1] == a and kept[5] == short
    assert kept[2] == b.replace(" ".join(passage), "") and passage[20] not in kept[3]
    assert texts[6] is None and kept[6] is None
    assert substring_dedup.passages(spark, df.limit(0)).count() == 0


def test_chains_are_best():
    """The Fenwick tree finds the score of the plain quadratic recurrence."""
    rng = random.Random(9)
    for _ in range(50):
        pts = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(rng.randrange(1, 25))})
        x, y = np.array([p[0] for p in pts]), np.array([p[1] for p in pts])
        score = []
        for i, (a, b) in enumerate(pts):
            best = max((score[j] - 0.02 * (a - pts[j][0] + b - pts[j][1]) for j in range(i) if pts[j][0] < a and pts[j][1] < b), default=0)
            score.append(5 + max(0, best))
        chain = substring_dedup.chains(x, y, 5, 0.02, 10**6)[0]
        own = 5 * len(chain) - 0.02 * sum(x[j] - x[i] + y[j] - y[i] for i, j in zip(chain, chain[1:]))
        assert abs(own - max(score)) < 1e-9
        assert sorted(i for c in substring_dedup.chains(x, y) for i in c) == list(range(len(pts)))


@pytest.mark.parametrize("between", [100, 500])
def test_two_passages_of_one_pair(spark, between):
    rng = random.Random(10 + between)
    first, second = prose(rng, 50), prose(rng, 50)
    texts = {i: " ".join(prose(rng, 20) + first + prose(rng, between) + second + prose(rng, 20)) for i in (1, 2)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = sorted((r["doc_id"], texts[2][r["start"] : r["end"]], texts[1][r["source_start"] : r["source_end"]]) for r in substring_dedup.passages(spark, df).collect())
    assert got == sorted((2, " ".join(p), " ".join(p)) for p in (first, second))


def test_chains_within_the_gap():
    """A best predecessor that is too far away does not hide a nearer one: scores against brute force."""
    rng = np.random.default_rng(12)
    for _ in range(20):
        pts = np.unique(rng.integers(0, 120, (60, 2)), axis=0)
        x, y = pts[:, 0], pts[:, 1]
        score = np.zeros(len(x))
        for i in range(len(x)):  # rows of np.unique are in order of x
            ok = (x < x[i]) & (y < y[i]) & (x[i] - x <= 9) & (y[i] - y <= 9)
            score[i] = 5 + max(0, *(score[ok] - 0.02 * (x[i] - x[ok] + y[i] - y[ok])), 0)
        chain = substring_dedup.chains(x, y, 5, 0.02, 9)[0]
        got = sum(5 - (0.02 * float(x[j] - x[i] + y[j] - y[i]) if i >= 0 else 0) for i, j in zip([-1, *chain], chain))
        assert got == pytest.approx(score.max())


@pytest.mark.parametrize("period", [1, 2, 5, 12])
def test_periodic_text(spark, period):
    rng = random.Random(14)
    line = prose(rng, period)
    head, tail = prose(rng, 12), prose(rng, 12)
    n = 400 // period
    texts = {1: line * n, 2: line * n, 3: prose(rng, 30) + line * (n // 2) + prose(rng, 30), 4: head + line * 60 + tail, 5: prose(rng, 9) + head + line * 60 + tail}
    texts = {i: " ".join(t) for i, t in texts.items()}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = substring_dedup.passages(spark, df).collect()
    assert (2, 0, len(texts[2])) in {(r["doc_id"], r["start"], r["end"]) for r in got}
    repeat = " ".join(line * (n // 2))
    at = texts[3].index(repeat)
    assert any(r["doc_id"] == 3 and r["start"] <= at and r["end"] >= at + len(repeat) for r in got)
    cut = {r["doc_id"]: r["text"] for r in substring_dedup.without_passages(spark, df).collect()}
    assert 2 not in cut and not any(w in (cut[3] + cut[5]).split() for w in line)


def test_fragments_in_earlier_documents(spark):
    """A passage is found though earlier documents hold its seeds, each in a part too short for a passage."""
    rng = random.Random(16)
    for a, b in ((25, 25), (39, 30), (32, 38)):
        passage = prose(rng, 50)
        texts = {1: prose(rng, 40) + passage[:a] + prose(rng, 40), 2: prose(rng, 40) + passage[-b:] + prose(rng, 40)}
        texts |= {i: prose(rng, 10 * i) + passage + prose(rng, 40) for i in (3, 4, 5)}
        texts = {i: " ".join(t) for i, t in texts.items()}
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = sorted((r["doc_id"], r["source_id"], texts[r["doc_id"]][r["start"] : r["end"]]) for r in substring_dedup.passages(spark, df).collect())
        assert got == [(4, 3, " ".join(passage)), (5, 3, " ".join(passage))]


@pytest.mark.parametrize("size", [42, 48, 50, 60])
def test_overlapping_fragments_in_earlier_documents(spark, size):
    """Fragments under 40 words that overlap hold every seed and span of a passage: its later copies are found all the same."""
    rng = random.Random(size)
    rows, want = [], {}
    for case in range(20):
        passage, n = prose(rng, size), 4 * case
        a = rng.randrange(size - 39 + 8, 40)
        parts = [passage[:a], passage[-rng.randrange(size - a + 6, 40) :], passage, passage]
        rows += [(n + i, " ".join(prose(rng, 30) + p + prose(rng, 30))) for i, p in enumerate(parts)]
        want[n + 3] = (n + 2, " ".join(passage))
    texts = dict(rows)
    got = substring_dedup.passages(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["source_id"], texts[r["doc_id"]][r["start"] : r["end"]]) for r in got} == want


@pytest.mark.parametrize("seed", range(3))
def test_no_equal_stretch_is_lost(spark, seed):
    """Against brute force: every 40 words that an earlier document holds lie within a passage, on texts cut from few pieces."""
    rng = random.Random(100 + seed)
    pool = prose(rng, 500)
    rows = []
    for n in range(60):
        words = []
        for _ in range(rng.randrange(1, 8)):
            at = rng.randrange(450)
            words += pool[at : at + rng.choice([5, 15, 30, 39, 40, 41, 55, 90])] + prose(rng, rng.choice([0, 1, 2, 20]))
        rows.append((n, rng.choice([" ", "  ", "\n"]).join(words)))
    rows += [(60, None), (61, ""), (62, "x " * 39), (63, rows[5][1])]
    seen, want = {}, []
    for n, text in rows:
        found = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^ \t-\r]+", text or "")]
        windows = [(found[i][0], found[i + 39][1], tuple(w for _, _, w in found[i : i + 40])) for i in range(len(found) - 39)]
        want += [(n, s, e) for s, e, w in windows if seen.get(w, n) < n]
        for *_, w in windows:
            seen.setdefault(w, n)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(1)).withColumn("anchor", F.lit(1))
    got = substring_dedup.passages(spark, df).collect()
    assert len(want) > 1000
    assert not [w for w in want if not any(r["doc_id"] == w[0] and r["start"] <= w[1] and r["end"] >= w[2] for r in got)]
    assert all(r["identity"] >= 0.8 and r["n_words"] >= 40 and r["source_id"] < r["doc_id"] for r in got)


def test_cells():
    """Each window of a text is in a cell; cells that texts share whole are equal."""
    rng = np.random.default_rng(5)
    words = rng.integers(0, 2**63, 400).astype(np.uint64)
    first, last, anchor, cell = substring_dedup.cut_cells(words, 40)
    assert first[0] == 0 and last[-1] == 400 and (last[:-1] - 39 == first[1:]).all()
    again = substring_dedup.cut_cells(np.concatenate([words[300:], words]), 40)
    assert set(cell[1:]) <= set(again[3]) and set(anchor) <= set(again[2])  # the first has more windows before it now
    assert all(len(c) == 0 for c in substring_dedup.cut_cells(words[:39], 40))
    assert len(substring_dedup.cut_cells(np.resize(words[:3], 500), 40)[0]) <= 4  # a cycle has few different cells


def edited(rng, passage, rate):
    """The passage with words changed, left out or put in, and where its first and last equal words lie in either version."""
    out, equal = [], []
    for i, w in enumerate(passage):
        kind = rng.random() / rate
        if kind < 0.15:
            continue
        if kind < 0.3:
            out.append("new" + str(rng.randrange(10**6)))
        if 0.3 <= kind < 1:
            out.append("new" + str(rng.randrange(10**6)))
        else:
            equal.append((i, len(out)))
            out.append(w)
    return out, equal


def test_recall_of_fuzzy_passages(spark):
    """Passages of 40 to 100 words between their first and last equal words, with an identity down to 0.8: at least 0.9 are found."""
    rng = random.Random(18)
    rows, want = [], {}
    while len(want) < 300:
        passage = prose(rng, rng.randrange(40, 106))
        copy, equal = edited(rng, passage, rng.choice([0.05, 0.1, 0.15, 0.2]))
        long = [max(e[k] for e in equal) - min(e[k] for e in equal) + 1 for k in (0, 1)]
        if min(long) < 40 or max(long) > 100 or len(equal) < 0.8 * max(long):
            continue
        n = len(rows)
        rows += [(n, " ".join(prose(rng, 60) + passage + prose(rng, 60))), (n + 1, " ".join(prose(rng, 30) + copy + prose(rng, 90)))]
        want[n + 1] = n
    got = substring_dedup.passages(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(want.get(r["doc_id"]) == r["source_id"] for r in got)
    assert len({r["doc_id"] for r in got}) >= 0.9 * len(want)
    assert all(r["identity"] >= 0.8 and r["n_words"] >= 40 for r in got)


def test_extension_beyond_the_margin(spark):
    """A long passage of which the chain to its source has only the beginning: the rest was seen earlier, in fragments."""
    rng = random.Random(19)
    passage = prose(rng, 900)
    texts = {1: " ".join(w for i in range(0, 900, 30) for w in passage[100 + i : 100 + i + 8] + prose(rng, 8))}
    texts |= {i: " ".join(prose(rng, 20) + passage + prose(rng, 20)) for i in (2, 3)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for margin in (64, 1024):
        got = [r for r in substring_dedup.passages(spark, df, margin=margin).collect() if (r["doc_id"], r["source_id"]) == (3, 2)]
        assert {texts[3][r["start"] : r["end"]] for r in got} == {" ".join(passage)}


def test_long_text(spark):
    rng = random.Random(20)
    long = " ".join(prose(rng, 60_000))
    df = spark.createDataFrame([(1, long), (2, "x " + long)], "doc_id long, text string")
    got = substring_dedup.passages(spark, df).collect()
    assert [(r["doc_id"], r["start"], r["end"], r["n_words"]) for r in got] == [(2, 2, len(long) + 2, 60_000)]


@pytest.mark.parametrize("rows", (1 << 20, 1 << 24, 1 << 30))
def test_near_copies_are_verified_at_any_size(spark, monkeypatch, rows):
    """With the blocks of tables of three sizes: nothing below 0.8 is a near copy, and of pairs at 0.8 or more nine in ten are, of those from 0.85 all."""
    rng = random.Random(11)
    sets = lambda words: {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    texts, alike = [], []
    for _ in range(350):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        other = list(words)
        for _ in range(rng.randint(1, 11)):
            other[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        texts += [" ".join(words), " ".join(other)]
        a, b = sets(words), sets(other)
        alike.append(len(a & b) / len(a | b))
    real = simhash.block_size
    monkeypatch.setattr(simhash, "block_size", lambda n: real(rows))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(spark, df).collect()}
    linked = [got[2 * p + 1] == 2 * p for p in range(350)]
    assert not any(x for x, j in zip(linked, alike) if j < 0.8)
    near, sure = [x for x, j in zip(linked, alike) if j >= 0.8], [x for x, j in zip(linked, alike) if j >= 0.85]
    assert len(near) > 120 and sum(near) >= 0.9 * len(near) and sum(sure) >= 0.99 * len(sure)


def test_open_links_leave_no_pair_unsaid():
    """A bucket of texts that are near but not near enough: all its pairs become candidates, or a row says that some are left."""
    rng = np.random.default_rng(5)
    center, fps = rng.integers(0, 2, 256), set()
    while len(fps) < 64:
        own = center.copy()
        own[rng.choice(256, rng.integers(15, 26), replace=False)] ^= 1
        fps.add(np.packbits(own).tobytes())
    fps = sorted(fps)
    n, whole, links = len(fps), b"\xff" * 32, {}
    near = {(a, b) for a, b in itertools.combinations(fps, 2) if (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count() <= 48}
    for name, few, comps in (("all", 1 << 20, fps), ("capped", 2, fps), ("known", 1 << 20, [fps[0]] * (n // 2) + fps[n // 2 :])):
        columns = [pa.array(np.zeros(n, np.int64)), pa.array(fps, pa.binary()), pa.array(comps, pa.binary()), pa.array([whole] * n, pa.binary()), pa.array(np.zeros(n, np.int64))]
        rows = [r for b in simhash.open_links(iter([pa.RecordBatch.from_arrays(columns, ["key", "fp", "component", "turned", "root"])]), (48,), few, 20) for r in b.to_pylist()]
        links[name] = [(r["a"], r["b"]) for r in rows if r["a"] is not None], any(r["a"] is None for r in rows)
    assert len(near) > 1000 and sorted(links["all"][0]) == sorted(near) and not links["all"][1]
    assert set(links["capped"][0]) < near and links["capped"][1]
    assert set(links["known"][0]) == {(a, b) for a, b in near if b >= fps[n // 2]} and not links["known"][1]


def test_a_pair_is_met_once():
    """Of the buckets that two fingerprints share, one is the first."""
    rng = np.random.default_rng(6)
    place = lambda ones: sum(1 << i for i in np.flatnonzero(ones).tolist())
    words = lambda ones: np.packbits(ones).view(">u8").astype(np.uint64)[None]
    met = 0
    for _ in range(60):
        a = rng.integers(0, 2, 256).astype(np.uint8)
        b = a.copy()
        b[rng.choice(256, 8, replace=False)] ^= 1
        masks, keys = [], []
        for x in (a, b):
            mask, own = np.zeros(256, np.uint8), set()
            for k in range(12):
                turned = 20 * k + rng.choice(20, 2, replace=False)
                mask[turned] = 1
                for flips in ((0, 0), (0, 1), (1, 0), (1, 1)):
                    y = x.copy()
                    y[turned] ^= np.array(flips, np.uint8)
                    own.add(place(y[20 * k : 20 * k + 20]) | k << 20)
            masks.append(mask)
            keys.append(own)
        shared = sorted(keys[0] & keys[1])
        first = [simhash.first_met(words(a), words(b), words(masks[0]), words(masks[1]), np.array([k]), 20)[0] for k in shared]
        assert sum(first) == min(1, len(shared))
        met += len(shared) > 1
    assert met > 30
