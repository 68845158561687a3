"""The corpus pipeline over documents: quality classifier, near-duplicates, repeated passages, personal data, packing.

Every stage is written as Parquet and read again as the next one's docs, so a lost executor costs a re-read at most.
Stages hold whole texts, so they bound the bytes of the batches that Python gets, for themselves and for what they return.

All stages take documents with further columns, which they leave out, and give none for none. Null ids are never
dropped as copies and never sources of a passage; null texts have no words: the classifier scores them like empty ones,
they are near copies of each other, hold no passage and no personal data, and are packed as an end mark. Rows that
repeat an id stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import conv_quality, pii, queries, simhash, substring_dedup
from attesta.llm.common import bounded_batches, sized, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier, trained on the labels that are not held out, scores 0.3 or more; without such labels all stay."""
    bounded_batches(spark)
    network = conv_quality.fit(docs, queries.table(spark, sf_dir, "labels"))
    return conv_quality.score(docs.select(COLUMNS), network, keep=True).where("_score >= 0.3").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies (five-word shingles, 0.8); null ids stay.

    Only ids are joined with the texts. Of rows that repeat an id, all stay or go.
    """
    bounded_batches(spark)
    found = simhash.near_copies(spark, docs)
    go = stage(spark, found.where("doc_id <> component_id").select("doc_id").distinct(), "pipeline-copies")
    return docs.join(sized(go), "doc_id", "left_anti").select(COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of all but their earliest document; documents with nothing left go."""
    bounded_batches(spark)
    cut = substring_dedup.without_passages(spark, docs.select(COLUMNS))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind."""
    bounded_batches(spark)
    return pii.mask(docs.select(COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens; one row per piece."""
    bounded_batches(spark)
    return queries.packed(docs)


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_duplicates), ("substring dedup", passages), ("PII", personal_data), ("packing", packing)]

#: SQL can express neither the classifier nor the fields; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table documents of sf_dir."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(spark, step(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
