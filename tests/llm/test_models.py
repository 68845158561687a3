"""Scores: context mixing and the convolutional classifier; archives; the pipeline."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attesta.llm import conv_quality, queries, simhash, warc
from attesta.llm import context_mixing as M
from attesta.llm.common import shared_dir
from tests.llm.test_pairs import shingles

SF = "/root/testdata/sf0.001"


def test_base_scores(spark):
    rows = [(i, t) for i, t in enumerate(["a b a", "A c", None, "", "b\tzz \xa0 é", "a b a", "new words here"] * 4)] + [(None, "a b")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_tokens int").repartition(3)
    got = M.score(spark, df).collect()
    assert len(got) == len(rows)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = collections.Counter(w for i, t in rows if not out(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    texts = dict(rows)
    for r in got:
        w = words(texts[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out(r["doc_id"]), len(w), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        assert r["score"] < 0 and r["bits_per_byte"] > 0
    assert M.score(spark, df.limit(0)).count() == 0


def test_scores_do_not_depend_on_the_layout(spark):
    df = queries.table(spark, SF, "documents").select("doc_id", "text")
    one, seven = ({r["doc_id"]: (r["score"], r["base_score"], r["n_known"]) for r in M.score(spark, df.repartition(n, "text")).collect()} for n in (1, 7))
    assert one.keys() == seven.keys()
    assert all(one[i] == pytest.approx(seven[i], rel=1e-9) for i in one)


def test_mixing_is_a_distribution():
    """Over all continuations of a word's beginning, the spelled probabilities sum to one."""
    rng = np.random.default_rng(0)
    mixer = M.Mixer(rng.integers(0, 5, (M.SLOTS, 2)).astype(np.int32))
    mixer.prepare()
    raw = np.arange(256, dtype=np.uint8)
    slots, bits = M.bit_slots(raw, np.ones(256, np.int64))
    z = sum(mixer.odds[slots[p]] * mixer.fine[mixer.gates[slots[-1] - M._BASES[-2]]][..., p] for p in range(M.PREDICTORS))
    z = np.where(bits == 1, -np.clip(z, -20, 20), np.clip(z, -20, 20))
    assert np.exp(-np.logaddexp(0, z).sum(1)).sum() == pytest.approx(1, abs=1e-4)


def test_mixing_rates_span_new_and_repeated_words():
    """New words cost hardly more than their spelling, and a word over and over hardly more than half a bit of its cache's share."""
    n = 400
    new = M.refined(np.full(n, -9.0), np.zeros(n), [np.arange(n)])[0]
    assert new > n * (-9.0 + math.log(0.98 * 0.999)) - math.log(30) - 1e-3
    same = M.refined(np.full(1, -40.0), np.zeros(1), [np.zeros(n, np.int64)])[0]
    assert same > -41 + (n - 1) * math.log(0.5) - math.log(30)


def test_contexts():
    """Slots depend on the word so far only."""
    a, _ = M.bit_slots(*M._spell([b"other", b"hello", M.END]))
    b, _ = M.bit_slots(*M._spell([b"hello"]))
    assert (a[:, 6:12] == b).all()


def test_better_than_counts_with_plain_spelling(spark):
    """Held-out texts against the smoothed counts, whose unseen words are spelled at eight bits a byte.

    The base score of the contract spells nothing, so it is no probability of a text: on so few training texts the
    model's total is below it (README).
    """
    df = queries.table(spark, SF, "documents")
    got = M.score(spark, df).where("held_out").collect()
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    c = collections.Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in M.tokens(t))
    spelled = sum(8 * math.log10(2) * len(w) for r in got for w in M.tokens(texts[r["doc_id"]]) if w not in c)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) - spelled


def test_training_reads_running_text(spark):
    """Of two corpora with the same words in other orders, the one in which words follow each other as in a held-out text gives it the higher score."""
    ids = {out: [i for i in range(400) if (zlib.crc32(str(i).encode()) % 7 == 2) == out] for out in (False, True)}
    text = lambda shift, start: " ".join(f"key{k % 20} value{(k + shift) % 20}" for k in range(start, start + 10))
    totals = []
    for shift in (0, 7):
        rows = [(i, text(shift, n)) for n, i in enumerate(ids[False][:200])] + [(i, text(0, n)) for n, i in enumerate(ids[True][:20])]
        got = M.score(spark, spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
        totals.append((sum(r["score"] for r in got), sum(r["base_score"] for r in got)))
    assert totals[0][1] == pytest.approx(totals[1][1])
    assert totals[0][0] > totals[1][0] + 1


def test_spelling_after_a_word_is_a_distribution():
    """Words of one byte after one and the same word, each with its closing space: their probabilities are those of the bytes, of a space after each."""
    rng = np.random.default_rng(0)
    counts, across = rng.integers(0, 5, (M.SLOTS, 2)).astype(np.int32), rng.integers(0, 3, (1 << M.ACROSS_BITS, 2)).astype(np.int32)
    mixer = M.Mixer(counts, None, across, rng.random((M.GATES, 2)))
    mixer.prepare()
    letters = [bytes([b]) for b in range(256) if b not in b" \t\n\x0b\x0c\r"]
    text = M.Running([[w, b"same", a, M.END] for w in letters for a in letters[:3]])
    costs = mixer.costs(text).reshape(-1, 4)
    # the same word after the same word costs the same wherever it stands
    assert all(len(set(costs[i::3, 2])) == 1 for i in range(3))
    firsts = M.Running([[w, M.END] for w in letters])
    assert 0 < np.exp(mixer.costs(firsts).reshape(-1, 2)[:, 0]).sum() <= 1


def test_running_texts_from_a_column():
    """A column of texts, cut into words at once, is what tokens() makes of each, null and odd ones included."""
    texts = ["A b a", None, "", " \t", " \xc9\x0b a  \xa0\x1c", "x" * 300 + " \x00B\nend\n", "b a"]
    column, lists = M.Running(pa.array(["left out", *texts], pa.string()).slice(1)), M.Running([M.tokens(t) for t in texts])
    assert column.sizes.tolist() == lists.sizes.tolist() == [len(M.tokens(t)) for t in texts]
    words = [M.END, *column.words.to_pylist()]
    assert [words[i] for i in column.ids] == [w for t in texts for w in M.tokens(t)]
    assert all((a == b).all() for a, b in ((column.ids, lists.ids), (column.before, lists.before), (column.raw, lists.raw), (column.lengths, lists.lengths)))
    assert len(M.Running(pa.array([None], pa.string())).words) == 0


def test_spelling_equals_a_plain_one():
    """The costs of words, whose beginnings and pairs are computed once, against a plain computation for each word and bit."""
    rng = np.random.default_rng(1)
    counts, across = rng.integers(0, 5, (M.SLOTS, 2)).astype(np.int32), rng.integers(0, 3, (1 << M.ACROSS_BITS, 2)).astype(np.int32)
    mixer = M.Mixer(counts, rng.random((M.GATES, M.PREDICTORS)), across, rng.random((M.GATES, 2)))
    mixer.prepare()
    texts = ["The then there them", "then the the then there", None, "a there"]
    text = M.Running(pa.array(texts, pa.string()))
    got, at = mixer.costs(text), 0
    gate = lambda total: min(int(math.log2(total + 1)), M.GATES - 1)
    odds = lambda c: math.log((c[1] + 0.4) / (c[0] + 0.4))
    for t in texts:
        before = 0
        for w in M.tokens(t):
            raw, lengths = M._spell([w])
            slots, bits = M.bit_slots(raw, lengths)
            own = int(text.ids[at])
            *_, over = next(text.bits(np.array([before]), np.array([own]), M._NODES))
            cost = 0.0
            for i, k in np.ndindex(bits.shape):
                g = gate(counts[slots[-1, i, k]].sum())
                z = np.clip(sum(odds(counts[slots[p, i, k]]) * mixer.weights[g, p] for p in range(M.PREDICTORS)), -20, 20)
                h = gate(across[over[i, k]].sum())
                z = np.clip(z * mixer.outer[h, 0] + odds(across[over[i, k]]) * mixer.outer[h, 1], -20, 20)
                cost -= np.logaddexp(0, -z if bits[i, k] else z)
            assert got[at] == pytest.approx(cost, rel=1e-5)
            before, at = own, at + 1
    assert at == len(got)


def test_conv_scores(spark):
    docs, labels = queries.table(spark, "/root/testdata/sf0.01", "documents"), queries.table(spark, "/root/testdata/sf0.01", "labels")
    network = conv_quality.fit(docs, labels)
    got = conv_quality.score(docs, network).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) >= 0.9
    good = [r["score"] for r in got if r["quality"] == 1]
    bad = [r["score"] for r in got if r["quality"] == 0]
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.95
    odd = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (2, "", "c"), (None, "x" * 300_000, "c")], "doc_id long, text string, score string")
    rows = conv_quality.score(odd, network).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows) and not [r for r in rows if r["doc_id"] is None][0]["held_out"]
    assert conv_quality.score(odd.limit(0), network).count() == 0


def test_conv_blocks_equal_whole(monkeypatch):
    rng = np.random.default_rng(1)
    n = conv_quality.Network(rng.normal(size=(8, 256, 12)).astype(np.float32), rng.normal(size=12).astype(np.float32), rng.normal(size=24), 0.1)
    text = "".join(map(chr, rng.integers(32, 300, 5000)))
    whole = n.score(text, n.tables())
    raw = conv_quality.as_bytes(text)
    k = (len(raw) - 8) // 2 + 1
    a = sum(n.kernel[j][raw[j : j + 2 * k : 2]] for j in range(8)) + n.bias
    pooled = np.array([np.maximum(a[s : s + 128].max(0), 0) for s in range(0, k, 128)])
    z = np.concatenate([pooled.mean(0), pooled.max(0)]) @ n.out + 0.1
    assert whole == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-4)
    monkeypatch.setattr(conv_quality, "BLOCK", 256)
    assert n.score(text, n.tables()) == pytest.approx(whole, rel=1e-5)


def test_unlabelled(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    network = conv_quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert conv_quality.score(docs, network).first()["score"] == pytest.approx(0.5)


def test_warc(spark):
    big, other = "x" * 150, "é\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(5, "http://a/5", big), (2, "http://a/2", big), (9, "http://a/9\r\nX: y", big), (1, "http://a/1", "small"), (3, "http://a/3", "small"), (4, None, None), (6, "http://a/6", other), (7, "http://a/7", other), (7, "http://a/7", other), (2, "http://b/2", big), (None, "http://a/n", big)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    path = f"{shared_dir(spark)}/test-warc-{uuid.uuid4().hex}"
    warc.write(spark, df, path, bytes_per_file=1000)
    records = warc.read(spark, path)
    assert records.count() == records.select("record_id").distinct().count() == 3 * len(rows)
    got, named = [], {}
    for r in warc.assemble(records).collect():
        page, main = r["metadata"]["facts"].get("page-id"), r["main"]
        named[main["record_id"]] = int(page) if page else None
        got.append((int(page) if page else None, main["type"], main["http_length"], main["declared_digest"][7:], main["refers_to"], None if main["payload"] is None else bytes(main["payload"]).decode()))
        assert r["request"]["concurrent_to"] == main["record_id"] == r["metadata"]["concurrent_to"]
        if main["payload"] is not None:
            assert main["payload_digest"] == hashlib.sha256(bytes(main["payload"])).hexdigest() == main["declared_digest"][7:]
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    n = len(other.encode())
    again = lambda p, of, text: (p, "revisit", len(text.encode()), sha(text), of, None)
    new = lambda p, text: (p, "response", len((text or "").encode()), sha(text), None, text or "")
    want = [new(2, big), again(2, 2, big), again(5, 2, big), again(9, 2, big), again(None, 2, big), new(1, "small"), new(3, "small"), new(4, None), new(6, other), again(7, 6, other), again(7, 6, other)]
    assert sorted([(*g[:4], named.get(g[4]), g[5]) for g in got], key=str) == sorted(want, key=str)
    assert n > 100 and all((g[4] is None) == (g[1] == "response") for g in got)
    pages = warc.assemble(records).select(F.col("metadata.facts")["page-id"].cast("long").alias("page_id"), F.col("main.record_id").alias("record_id"), F.col("main.refers_to").alias("refers_to_record"))
    assert sorted(((r["page_id"], r["refers_to"]) for r in warc.with_referred(spark, pages).collect()), key=str) == sorted(((w[0], w[4]) for w in want), key=str)
    warc.write(spark, df.limit(0), path + "-none")
    assert warc.assemble(warc.read(spark, path + "-none")).count() == 0


def test_plain_archive(spark, tmp_path):
    """Archives of other writers: several records, none of them compressed."""
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nbody"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    (tmp_path / "a.warc").write_bytes(record + b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    got = warc.assemble(warc.read(spark, str(tmp_path))).orderBy("capture_id").collect()
    assert bytes(got[0]["main"]["payload"]) == b"body" and got[0]["request"] is None and got[1]["main"] is None


def test_archives_cut_off(spark, tmp_path):
    """An archive that ends within a record raises, packed or plain."""
    import gzip

    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"body\r\n\r\n" * 50
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    for name, data in (("a.warc.gz", gzip.compress(record) + gzip.compress(record)), ("b.warc", record * 2)):
        (tmp_path / name).mkdir()
        (tmp_path / name / name).write_bytes(data)
        assert [bytes(r["payload"]) for r in warc.read(spark, str(tmp_path / name)).collect()] == [block[19:]] * 2
    (tmp_path / "a.warc.gz" / "a.warc.gz").write_bytes(gzip.compress(record + record[:-40]))
    (tmp_path / "b.warc" / "b.warc").write_bytes(record + record[:-40])
    for name in ("a.warc.gz", "b.warc"):
        with pytest.raises(Exception, match="ends within a record"):
            warc.read(spark, str(tmp_path / name)).collect()


def test_pipeline(spark):
    """Each stage against what it must do to its own input."""
    docs = queries.table(spark, SF, "documents")
    sizes = []
    for name, step in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = step(spark, docs, SF)
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
            out = spark.createDataFrame(out.collect(), out.schema)
        after = {r["doc_id"]: r for r in out.collect()}
        assert set(after) <= set(before)
        if name == "SimHash near-dedup":
            comp = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(spark, docs).collect()}
            assert set(after) == set(comp.values())
            # by brute force over five-word shingles: of two alike one goes, and what goes is like something
            sets = {i: shingles(t or "") for i, t in before.items()}
            like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] & sets[b]}
            close = [p for p, x in like.items() if x >= 0.8]
            assert close and sum(comp[a] == comp[b] for a, b in close) >= 0.95 * len(close)
            assert all(max(x for p, x in like.items() if i in p) >= 0.6 for i in set(before) - set(after))
        if name == "PII":
            assert not any(re.search(r"@mail\d", r["text"]) for r in after.values())
        if name == "packing":
            assert set(after) == set(before)
        sizes.append((len(before), len(after)))
        docs = out
    assert sizes[0][1] < sizes[0][0] and sizes[0][1] > 0.75 * sizes[0][0]


def test_stages_on_odd_rows(spark):
    """Nulls in any column, empty and repeated rows, further and clashing columns, an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _score double, _spans string, component_id long"
    rows = [(None, None, None, None, None, 1.0, "x", 1), (1, None, "en", "s", 0, 1.0, "x", 1), (2, "", None, None, 0, None, None, None), (3, "some words here", "en", None, 15, 1.0, "x", 1), (3, "some words here", "en", None, 15, 1.0, "x", 1), (None, "mail a@b.cc", "en", "s", 11, 1.0, "x", 1)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, docs, SF)
            got = out.collect()
            assert name == "packing" or out.columns == corpus_pipeline.COLUMNS
            assert some or not got
            if name == "SimHash near-dedup":
                assert sorted(str(r["doc_id"]) for r in got) == sorted(["None", "None", "1", "3", "3"] if some else [])
            if name in ("substring dedup", "PII"):
                assert len(got) == len(some)
            if name == "packing":
                assert sum(r["length"] for r in got) >= len(some)


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_refinement_equals_a_plain_one():
    """Word by word: the mixture of spelling, training frequency and what the document has had so far, over all pairs of rates."""
    rng = np.random.default_rng(4)
    n = 30
    spelled, frequency = rng.uniform(-40, -3, n), np.where(rng.random(n) < 0.5, rng.random(n) / 10, 0)
    lists = [rng.integers(0, n, k) for k in (1, 7, 60, 200)]
    for ids, got in zip(lists, M.refined(spelled, frequency, lists)):
        totals = []
        for m in M.WORD_RATES:
            for c in M.CACHE_RATES:
                total, had, pairs = 0.0, collections.Counter(), collections.Counter()
                for i, w in enumerate(ids.tolist()):
                    known = (1 - m) * math.exp(spelled[w]) + m * frequency[w]
                    if i:
                        last, own = int(ids[i - 1]), had[w] / i
                        turns = had[last] - 1
                        if turns:
                            own += turns / (turns + 1) * (pairs[last, w] / turns - own)
                        known += c * (own - known)
                        pairs[last, w] += 1
                    had[w] += 1
                    total += math.log(known)
                totals.append(total)
        top = max(totals)
        assert got == pytest.approx(top + math.log(sum(math.exp(t - top) for t in totals) / len(totals)), rel=1e-4)
