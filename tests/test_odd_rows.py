"""Queries on rows that the test tables lack, against their SQL."""

from __future__ import annotations

import duckdb

from attesta.plans import registry
from tests.compare import check


def test_segment_payloads(spark, tmp_path):
    """Empty and null texts, null sources and languages, ids beyond what a double holds."""
    docs = [(1, "", "en", "s"), (2, None, "en", "s"), (3, "a", None, "s"), (4, "a", "", ""), (5, "a", "en", None), (None, "a", "en", "s"), (6, "\U0001f600e\u0301" * 400, "en", "s"), (-7, " \n\r\n", "en", "s")]
    docs += [(n, "a", "en", "s") for n in (10**7, 2**53 + 1, 123456789012345677, 2**63 - 6)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    # as text: pandas makes doubles of ids beside a null
    mine = registry.QUERIES["segment_payloads"](spark, str(tmp_path)).selectExpr("CAST(doc_id AS string) AS doc_id", "payload")
    check(mine, f"SELECT doc_id::VARCHAR AS doc_id, payload FROM ({registry.ORACLE['segment_payloads']})", c)
