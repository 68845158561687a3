"""Queries on table functions, stores that are kept in place, the SQLite source, and admission to a budget."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from attesta.functions import tables as TF
from attesta.operators import stages as ST
from attesta.plans.grounding import SENTENCES_SQL
from attesta.plans.registry import ORACLE, query
from attesta.sources import sqlite, store
from attesta.sources.tables import new_path


@query(ORACLE["sentence_table"])
def sentences_lateral(read, spark):
    """The sentence table from SQL text: a table function called for each row."""
    TF.register(spark)
    documents = read("documents")
    return spark.sql("SELECT d.doc_id, s.index, s.type, md5(s.text) AS text_md5 FROM {documents} d, LATERAL text_sentences(d.text) s", documents=documents)


@query("WITH " + SENTENCES_SQL + """, n AS (SELECT d.doc_id, count(t.pos) AS n FROM documents d LEFT JOIN typed t USING (doc_id) GROUP BY d.doc_id)
    SELECT doc_id, pos::INT AS index, type, md5(s) AS text_md5 FROM typed UNION ALL SELECT doc_id, n::INT, 'factual', md5('Part two is ' || doc_id || '.') FROM n UNION ALL SELECT doc_id, (n + 1)::INT, 'narrative', md5('and so on') FROM n""")
def sentences_by_part(read, spark):
    """Texts in two parts, given as a partitioned table: sentences are numbered through."""
    TF.register(spark)
    d = read("documents")
    parts = d.select("doc_id", F.posexplode(F.array("text", F.concat(F.lit("Part two is "), "doc_id", F.lit(".\n\nand so on")))).alias("part", "text"))
    return spark.sql('SELECT doc_id, `index`, type, md5(text) AS text_md5 FROM part_sentences(TABLE({parts}) PARTITION BY doc_id ORDER BY part)', parts=parts)


@query("SELECT doc_id AS id, source AS video_id, doc_id / 2.0::DOUBLE AS ts_start, text AS content FROM documents")
def claims_from_sqlite(read, spark):
    """Claims written as SQLite files, one for each task, and read in ranges of their rowids."""
    sqlite.register(spark)
    path = new_path(spark, "sqlite")
    rows = read("documents").select(F.col("doc_id").alias("id"), F.col("source").alias("video_id"), (F.col("doc_id") / F.lit(2.0)).alias("ts_start"), F.col("text").alias("content"))
    rows.write.format("sqlite").option("path", path).option("table", "claims").mode("append").save()
    return spark.read.format("sqlite").option("path", path).option("table", "claims").option("rows", 500).load()


def bucketed(read, spark):
    """Claims and their assignments as tables in buckets of the claim's id."""
    name = uuid.uuid4().hex
    claims = read("documents").select(F.col("doc_id").alias("claim_id"), F.col("source").alias("video_id"), F.length("text").cast("long").alias("n_chars"))
    assigned = read("labels").where("quality = 1").select(F.col("doc_id").alias("claim_id"), F.lit("good").alias("chapter_id"))
    return store.save_bucketed(claims, f"claims_{name}", "claim_id", 8), store.save_bucketed(assigned, f"assigned_{name}", "claim_id", 8)


@query("SELECT claim_id, video_id, n_chars, 'good' AS chapter_id FROM (SELECT doc_id AS claim_id, source AS video_id, length(text) AS n_chars FROM documents) JOIN labels ON doc_id = claim_id WHERE quality = 1")
def claims_joined_in_buckets(read, spark):
    claims, assigned = bucketed(read, spark)
    return claims.hint("merge").join(assigned, "claim_id").select("claim_id", "video_id", "n_chars", "chapter_id")


@query("""SELECT lang AS chapter_id, doc_id AS sentence_index, doc_id AS claim_id, CASE WHEN lang IN ('en', 'fr') AND doc_id % 3 = 0 THEN 'grounded' ELSE 'unsupported' END AS status FROM documents
    UNION ALL SELECT lang, doc_id, NULL, 'narrative_ok' FROM documents WHERE lang IN ('en', 'fr') AND doc_id % 7 = 0""")
def citations_upserted_in_place(read, spark):
    """A second load replaces rows of two chapters and adds some that cite nothing, twice: the chapters it does not touch are not written again."""
    path = new_path(spark, "citations")
    d = read("documents").select(F.col("lang").alias("chapter_id"), F.col("doc_id").alias("sentence_index"))
    store.write_partitions(d.withColumn("claim_id", F.col("sentence_index")).withColumn("status", F.lit("unsupported")), path, "chapter_id")
    own = d.where("chapter_id IN ('en', 'fr')")
    new = own.where("sentence_index % 3 = 0").withColumn("claim_id", F.col("sentence_index")).withColumn("status", F.lit("grounded"))
    new = new.unionByName(own.where("sentence_index % 7 = 0").withColumn("claim_id", F.lit(None).cast("bigint")).withColumn("status", F.lit("narrative_ok")))
    for _ in range(2):
        store.upsert(spark, path, new, ["chapter_id", "sentence_index", "claim_id"], "chapter_id")
    return spark.read.schema(new.schema).parquet(path)


@query("SELECT d.doc_id AS id, lang, CASE WHEN l.quality = 0 THEN '{\"superseded_by\":' || (d.doc_id + 1) || '}' END AS extra FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def extra_set_in_place(read, spark):
    """The column extra of the claims that the labels name, set in a store partitioned by language."""
    path = new_path(spark, "extras")
    d = read("documents").select(F.col("doc_id").alias("id"), "lang")
    store.write_partitions(d.withColumn("extra", F.lit(None).cast("string")), path, "lang")
    named = d.join(read("labels").where("quality = 0").select(F.col("doc_id").alias("id")), "id")
    store.set_columns(spark, path, named.withColumn("extra", F.concat(F.lit('{"superseded_by":'), F.col("id") + 1, F.lit("}"))), "id", "lang")
    return spark.read.schema("id bigint, extra string, lang string").parquet(path)


def asked(read, price: float = 10.0, ceiling: float = 5.0):
    """Every document as a prompt of a model that tells its length, within what is left of a budget."""
    rows = read("documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("prompt"))
    log = read("region").select(F.lit("draft").alias("stage"), (F.col("r_regionkey") / 10.0).alias("usd"))
    return ST.ask_within_budget(rows, "prompt", lambda: lambda p: str(len(p)), log, "claims", price, ceiling)


ASKED_SQL = """t AS (SELECT doc_id AS id, length(coalesce(text, '')) AS n, greatest(1, floor(length(coalesce(text, '')) / 3.5))::BIGINT AS tokens FROM documents),
    r AS (SELECT *, (SELECT sum((r_regionkey * 100000)::BIGINT) FROM region) + 10 * sum(tokens) OVER (ORDER BY id) <= 5000000 AS fits FROM t)"""


@query("WITH " + ASKED_SQL + " SELECT id, CASE WHEN fits THEN n::VARCHAR END AS answer, CASE WHEN NOT fits THEN 'budget exceeded' END AS error FROM r")
def asked_within_budget(read, spark):
    return asked(read)[0].select("id", "answer", "error")


@query("WITH " + ASKED_SQL + " SELECT 'claims' AS stage, count(*) AS n, round(sum(tokens) * 10 / 1e6, 6) AS usd FROM r WHERE fits UNION ALL SELECT 'draft', count(*), round(sum(r_regionkey) / 10.0, 6) FROM region")
def spent_within_budget(read, spark):
    return asked(read)[1].groupBy("stage").agg(F.count("*").alias("n"), F.round(F.sum("usd"), 6).alias("usd"))
