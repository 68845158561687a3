"""BPE against the tokenizers library, packing against its contract."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from attesta.llm import bpe, packing, queries

WORDS, BYTES = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
ODD = [None, "", " \n\t", "a" * 3000, "the cat <|endoftext|> sat<|startoftext|>", "ΣΑΣ été ÉTÉ é ﬁ İ", "it's 123 한국어 \U0001f600!!", "x\x1cy\x85z\xa0w", "same", "same"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def own():
    return bpe.ForcedBoundaryBPE(WORDS)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("ab'st dé É́Σ\x1c\x85 12<|>"), st.characters(exclude_categories=("Cs",))), max_size=60))
def test_equals_library(own, library, text):
    ids = np.frombuffer(own.encode(text), "<u4").tolist()
    assert ids == library[0].encode(text, add_special_tokens=False).ids
    assert own.decode(own.encode(text)) == library[0].decode(ids, skip_special_tokens=False)


def test_cuts_are_certain(own):
    """No vocabulary token has a forced boundary inside."""
    tokens = random.Random(1).sample(sorted(own.vocab), 2000)
    assert all(len(own.cut(list(own._split(t)))) == 1 for t in tokens if len(own._split(t)) > 1)
    assert any(len(own.cut(list(map(own.symbols.get, w.encode())))) > 1 for w in ("한국", "été", "xÿz"))


def test_long_fragments(own, library):
    for text in ("ab" * 2000, "the" * 500, "é" * 700, "1" * 300):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library[0].encode(text, add_special_tokens=False).ids


def docs(spark, texts):
    rows = [(i if i != 3 else None, t, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, start int").repartition(2)


def test_encode_decode(spark, library):
    df = docs(spark, ODD)
    got = bpe.encode_decode(df, WORDS).collect()
    assert len(got) == len(ODD)
    for r in got:
        text = ODD[r["doc_id"] if r["doc_id"] is not None else 3] or ""
        ids = library[0].encode(text, add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids"] == ids
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library[0].decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_decode(df.limit(0), WORDS).count() == 0


def check_pieces(pieces, want, length=2048):
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, rows in by_doc.items():
        ids, at = want[doc], 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = ids[at : at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
    return by_doc, by_sequence


def test_packing(spark, library):
    texts = [t for i, t in enumerate(ODD) if i != 3] + ["long words " * 5000, "tiny"]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, offset int").repartition(2)
    got = queries.packed(df).collect()
    want = {i: library[1].encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    by_doc, by_sequence = check_pieces(got, want)
    assert set(by_doc) == set(want)
    for rows in by_sequence.values():  # no padding: full, or a power of two
        n = sum(r["length"] for r in rows)
        assert n == 2048 or n & (n - 1) == 0
    assert queries.packed(df.limit(0)).count() == 0


def test_limits_on_segments_and_loss(spark, library):
    rng = random.Random(3)
    texts = ["word " * rng.choice((1, 3, 40, 700)) for _ in range(300)]
    df = spark.createDataFrame([(i, t, rng.choice((None, 0, 20))) for i, t in enumerate(texts)], "doc_id long, text string, prompt int").coalesce(1)
    got = packing.pack(df, BYTES, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, loss_share_col="prompt", max_segments=6, max_loss=1500).collect()
    want = {i: library[1].encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    prompts = {r["doc_id"]: r["prompt"] or 0 for r in df.collect()}
    _, by_sequence = check_pieces(got, want)
    for rows in by_sequence.values():
        assert len(rows) <= 6 and sum(r["loss_tokens"] for r in rows) <= 1500
    for r in got:
        assert r["loss_tokens"] == sum(i >= prompts[r["doc_id"]] for i in range(r["start"], r["start"] + r["length"]))


def test_window_bounds_what_is_held():
    packer = packing.VectorPacker(100, 10, 100, 8)
    for i in range(200):
        packer.add(i, 1 + i * 37 % 250)
        assert len(packer.waiting) <= 8
    packer.finish()
    assert sum(n for *_, n, _, _ in ((e, s, n, q, o) for e, s, n, q, o in packer.take())) == sum(1 + i * 37 % 250 for i in range(200))


def test_column_names_survive(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string").withColumn("ids_sha256", F.lit("clash"))
    assert bpe.encode_decode(df, WORDS).columns.count("ids_sha256") == 1


def test_long_white_space():
    """Runs of white space, letters and marks of any length: ids as of the library."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = packing.tokenizer(path, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    library = Tokenizer.from_file(path)
    for text in (" " * 300_000 + "a", " " * 255 + "a", "a b" + " \n" * 200 + "c", "x" * 50_000, "!" * 50_000, "\n" * 255 + " " * 200 + "b<|endoftext|>" + "\t" * 900):
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
