"""Suffix-array family, whitening and divergence against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from attesta.llm import divergence as D
from attesta.llm import suffix_family as S
from attesta.llm import whitening as W


def windows(texts: list[bytes], length: int = 200) -> list[tuple]:
    """n_bytes, n_removed, n_spans, kept_sha256 of each text, by looking up every window."""
    count = Counter(hashlib.blake2b(t[i : i + length], digest_size=16).digest() for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[hashlib.blake2b(t[i : i + length], digest_size=16).digest()] > 1:
                gone[i : i + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(n))


def removed(spark, texts: list[str | None], **extra) -> list[tuple]:
    rows = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(texts)], "doc_id long, text string, k1 int, anchor string, n_bytes int").repartition(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in S.without_repeats(spark, rows).collect()}
    return [got[i] for i in range(len(texts))]


def same(spark, texts: list[str | None]) -> None:
    want = windows([(t or "").encode() for t in texts])
    got = removed(spark, texts)
    assert [i for i in range(len(texts)) if got[i] != want[i]] == []


def test_repeats_of_all_lengths(spark):
    rng = random.Random(3)
    passage = words(rng, 200)
    texts = [words(rng, 60) + passage[at : at + n] + words(rng, 60) for n in (150, 198, 199, 200, 201, 230, 320, 600) for at in (0, 7, 300)]
    texts += [None, "", "short", passage[:200], passage[1:201], passage[:199], words(rng, 100)]
    texts += [texts[0], texts[3], texts[3], "a" * 199, "a" * 200, "a" * 201, "a" * 900, "ab" * 300, "ba" * 250, "é" * 100, "é" * 350, "xyz" * 80 + "a" * 50]
    texts += [passage[:400].replace(" ", "\x00"), passage[:400].replace(" ", "\x00") + "\x00" * 300, words(rng, 5) * 60]
    same(spark, texts)


def test_passage_in_very_many_texts(spark):
    """More different cells at its edges than one task compares: its windows are dealt one by one."""
    rng = random.Random(4)
    passage, edge = words(rng, 80), words(rng, 90)
    texts = [words(rng, 25) + passage + words(rng, 25) for _ in range(S.CONTEXTS + 60)]
    texts += [words(rng, 25) + edge[:199] + chr(97 + i % 26) + words(rng, 25) for i in range(S.CONTEXTS + 60)]
    same(spark, texts)


def test_very_long_text(spark, monkeypatch):
    rng = random.Random(5)
    base = words(rng, 3000)
    long = "".join(base[(at := rng.randrange(len(base) - 400)) : at + 400] + words(rng, 40) for _ in range(2200))
    texts = [long, base, "z" * (S.STRETCH + 5000)]
    assert len(long) > S.STRETCH
    same(spark, texts)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.without_repeats(spark, none).count() == 0


def test_ids_may_be_null_or_repeat(spark):
    t = words(random.Random(6), 200)
    rows = spark.createDataFrame([(None, t), (1, t), (1, words(random.Random(7), 100))], "doc_id long, text string")
    got = sorted((r["n_bytes"], r["n_removed"]) for r in S.without_repeats(spark, rows).collect())
    n = len(t.encode())
    assert sorted([(n, n), (n, n), (len(words(random.Random(7), 100).encode()), 0)]) == got


@pytest.mark.parametrize("batch", (1, 2, 3, 50))
def test_levels_of_the_family(batch):
    """Any batches give the same windows; levels grow geometrically, and a suffix is in one level."""
    rng = random.Random(batch)
    source = bytes(rng.choice(b"ab") for _ in range(60))
    texts = [source[(at := rng.randrange(30)) : at + rng.randint(12, 30)] for _ in range(50)]
    anchors = [np.uint64(len(t) % 3) for t in texts]
    family = S.Family(8)
    for at in range(0, 50, batch):
        family.add(np.array(anchors[at : at + batch], np.uint64), texts[at : at + batch])
        sizes = [x.size for x in family.levels]
        assert all(a > b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == min(50, at + batch)
        assert len(sizes) <= 1 + int(np.log2(1 + at / batch)) + 1
    for x in family.levels:
        keys = [(int(a), x.text[p : p + 8].tobytes()) for a, p in zip(x.anchor, x.at)]
        assert keys == sorted(keys)
    count = Counter((int(a), t[i : i + 8]) for a, t in zip(anchors, texts) for i in range(len(t) - 7))
    want = {c: [i for i in range(len(t) - 7) if count[int(anchors[c]), t[i : i + 8]] > 1] for c, t in enumerate(texts)}
    got = {c: [i for a, b in zip(r[::2], r[1::2]) for i in range(a, b + 1)] for c, r in family.repeated()}
    assert got == {c: w for c, w in want.items() if w}


# --- whitening


def plain(vectors: np.ndarray) -> tuple:
    x = np.floor(64 * vectors).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    v = (fit - s / n).T @ (fit - s / n) / n
    e, u = np.linalg.eigh(v)
    return x, n, s, e[::-1], u[:, ::-1]


def test_whitening(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(700, 20)) * np.linspace(1, 3, 20)
    vectors[500:600] = vectors[7]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)] + [(i, v.tolist(), "y") for i, v in enumerate(vectors[:9])]
    bad = [(-1, None, "b"), (-2, [None] * 20, "b"), (-3, [float("nan")] * 20, "b"), (-4, [float("inf")] + [0.0] * 19, "b"), (-5, [], "b"), (-6, [1.0, 2.0], "b"), (-7, [1e300] * 20, "b")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, code string").repartition(13)
    got = W.whiten(spark, df).toPandas()
    x, n, s, e, u = plain(vectors)
    assert len(got) == 709 * 16 and set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    one = got.drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component")
    want = (x - s / n) @ u[:, :16] / np.sqrt(e[:16])
    mine = one["whitened"].loc[range(700)].to_numpy().astype(float)
    assert np.abs(mine * np.sign((mine * want).sum(0)) - want).max() < 1e-9
    assert [int(v) for v in one["deviation"][1].loc[range(700)]] == [int(v) for v in ((n * x - s) ** 2).sum(1)]
    assert np.abs(one["explained"].iloc[0].to_numpy().astype(float) - e[:16] / e.sum()).max() < 1e-12


def test_merging_loses_nothing():
    rng = np.random.default_rng(2)
    x = rng.integers(-500, 500, (300, 12)).astype(np.int64) + np.arange(12) * 10**7
    parts = [W.summarised(p) for p in np.split(x, [1, 5, 40, 200])]
    left = parts[0]
    for p in parts[1:]:
        left = W.merged(left, p)
    right = W.merged(W.merged(parts[4], parts[1]), W.merged(parts[3], W.merged(parts[0], parts[2])))
    c = x - x.mean(0)
    for s in (left, right):
        assert s.n == 300 and s.sums == [int(v) for v in x.sum(0)]
        assert np.abs(s.rows.T @ s.rows - c.T @ c).max() < 1e-6 * np.abs(c.T @ c).max()


def test_whitening_of_few_or_flat_vectors(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert W.whiten(spark, make([])).count() == 0 and W.whiten(spark, make([(1, None), (2, [])])).count() == 0
    got = W.whiten(spark, make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(got) == 4 and all(r["whitened"] is None and r["deviation"] == 0 and r["n"] == 1 and r["identity_error"] == 0 for r in got)
    got = {(r["vec_id"], r["component"]): r for r in W.whiten(spark, make([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (None, [3.0, 2.0])])).collect()}
    assert len(got) == 6 and abs(abs(got[1, 1]["whitened"]) - 1) < 1e-12 and got[1, 2]["whitened"] is None and got[None, 1]["n"] == 2


def test_deviations_stay_exact():
    big = W.Model(10**12, [7 * 10**24, -(10**20)], np.eye(2), np.ones(2), np.ones(2))
    x = np.array([[2**40, -5], [3, 9]], np.int64)
    assert big.deviations(x) == [(10**12 * 2**40 - 7 * 10**24) ** 2 + (-5 * 10**12 + 10**20) ** 2, (3 * 10**12 - 7 * 10**24) ** 2 + (9 * 10**12 + 10**20) ** 2]


# --- divergence


def audited(rows: list[tuple], least: int, most: int) -> set[tuple]:
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        own = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        groups[lang or ""].add(source or "")
        counts[lang or "", source or ""].update(own)
        docs[lang or ""].update(set(own))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (total[s] + 5 * len(kept)) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (sum(counts[lang, s][t] for s in sources) + 5) // (sum(total.values()) + 5 * len(kept)) for t in kept}
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            more = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:most]
            for part, found in (("pair", pairs), ("term", more)):
                out |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)}
    return out


@pytest.mark.parametrize("block, pairs", ((128, 1 << 20), (2, 7)))
def test_divergence(spark, monkeypatch, block, pairs):
    rng = random.Random(8)
    pool = ["Zeta", "été", "ÉTÉ", "Straße", "a", "b", "Ab", "aB", "x\u0085y", " ", "日本", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = [(rng.choice([" ", "1", "_", "\x7f", "\n"]).join(rng.choices(pool, weights=range(len(pool), 0, -1), k=rng.randint(0, 40))), rng.choice(["en", "fr", None, "de"]), rng.choice(["s", "t", "u", "é", "", None, "v"])) for _ in range(400)]
    rows += [(None, "en", "empty"), ("zz", "solo", "only"), (None, "none", "x"), ("a b", "none", "y"), ("!", "none", "z")] + [("a Ab été", "en", "s")] * 30
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, source string, c int, place int").repartition(7)
    tallied = D.tallied
    monkeypatch.setattr(D, "tallied", lambda kept: tallied(kept, pairs))
    got = D.audit(spark, df, 10, 8, block).collect()
    want = audited(rows, 10, 8)
    assert len(got) == len(want) and {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got} == want


def test_divergence_of_nothing(spark):
    assert D.audit(spark, spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_shares_are_exact(spark):
    rows = [(c, n, v) for c in (0, 1, 10**12, 10**17) for n in (0, 10**18) for v in (1, 7, 10**9)]
    df = spark.createDataFrame(rows, "c long, n long, v long").where("n >= c")
    for r in df.withColumn("p", D.share("c", "n", "v")).collect():
        assert r["p"] == 1 + 10**9 * (r["c"] + 5) // (r["n"] + 5 * r["v"])
