"""Rows that go to Python at a time."""

from __future__ import annotations

import pyarrow as pa
import pytest

import corpus_pipeline
from attesta.llm import common, simhash

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_few_long_rows(spark, monkeypatch):
    """Where a row holds a text or hashes of texts, no batch has the default of 10000 rows."""
    seen = {}

    def stage(spark, df, name):
        seen[name] = int(spark.conf.get(ROWS))
        return common.stage(spark, df, name)

    monkeypatch.setattr(simhash, "stage", stage)
    before = spark.conf.get(ROWS)
    words = [f"w{i}" for i in range(100)]
    docs = spark.createDataFrame([(i, " ".join(words[:60] + [f"x{i}"] + words[60:])) for i in range(3)], "doc_id long, text string")
    assert {r["component_id"] for r in simhash.near_copies(spark, docs).collect()} == {0}
    assert all(seen[name] <= 1000 for name in ("simhash-copies", "simhash-codes", "simhash-alike"))
    assert spark.conf.get(ROWS) == before


def test_batches_of(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    before = spark.conf.get(ROWS)
    with pytest.raises(ValueError), common.batches_of(spark, 7):
        assert max(r["n"] for r in spark.range(100).mapInArrow(sizes, "n long").collect()) == 7
        raise ValueError
    assert spark.conf.get(ROWS) == before


def test_stages_bound_the_bytes(spark):
    """A stage's result runs after the stage has returned, and its long texts still go to Python some at a time."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        text = "word " * 100_000
        docs = spark.createDataFrame([(i, text, "en", "s", len(text)) for i in range(24)], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
        rows = corpus_pipeline.personal_data(spark, docs, "").mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r["n"] for r in rows) == 24
        assert max(r["bytes"] for r in rows) < common.BATCH_BYTES + len(text)
        spark.conf.set(key, "1m")
        common.bounded_batches(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)
