"""The queries of the corpus operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import bpe, context_mixing, conv_quality, divergence, embedding_dedup, line_rules, packing, pii, simhash, substring_dedup, suffix_family, warc, whitening
from attesta.llm.common import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.components(spark, table(spark, sf_dir, "embeddings"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(spark, table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    found = warc.assemble(warc.read(spark, path, payload=False)).where("main IS NOT NULL")
    pages = found.select(
        F.col("metadata.facts")["page-id"].cast("long").alias("page_id"),
        F.coalesce("main.payload_bytes", "main.http_length").alias("payload_bytes"),
        F.coalesce("main.payload_digest", F.substring_index("main.declared_digest", ":", -1)).alias("payload_digest"),
        F.col("main.type").alias("record_type"),
        F.col("main.record_id").alias("record_id"),
        F.col("main.refers_to").alias("refers_to_record"),
    )
    return warc.with_referred(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False, with_text=False)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(spark, table(spark, sf_dir, "documents"))


def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(spark, table(spark, sf_dir, "documents"))


def op9_conv_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return conv_quality.score(docs, conv_quality.fit(docs, table(spark, sf_dir, "labels")))


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op11_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_family.without_repeats(spark, table(spark, sf_dir, "documents"))


def op12_svd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(spark, table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_warc": op3_warc,
    "op4_line_crf": op4_line_crf,
    "op5_pii": op5_pii,
    "op6_bpe": op6_bpe,
    "op7_simhash": op7_simhash,
    "op8_context_mixing": op8_context_mixing,
    "op9_conv_quality": op9_conv_quality,
    "op10_packing": op10_packing,
    "op11_suffix_family": op11_suffix_family,
    "op12_svd_whitening": op12_svd_whitening,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op3_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS f FROM p)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
          CASE WHEN payload_bytes >= 100 AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN payload_bytes >= 100 AND f <> page_id THEN f END AS refers_to FROM q""",
    "op13_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        kept AS (SELECT lang, term FROM d GROUP BY ALL HAVING count(DISTINCT i) >= 30),
        g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
        c AS (SELECT lang, source, term, count(*) AS c FROM d SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        cells AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        p AS (SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM cells JOIN v USING (lang)),
        q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang) + 5 * v) AS q FROM (SELECT lang, term, sum(c) AS c FROM cells GROUP BY ALL) JOIN v USING (lang)),
        pv AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
        pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN pv ON pv.lang = x.lang AND pv.source = x.source AND pv.item = y.source),
        t AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM t) QUALIFY part = 'pair' OR rank <= 50""",
}
