"""A claim store that is kept in place: bucketed tables that join without an exchange, and loads that rewrite only what they touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.operators.claims import insert_or_replace
from attesta.sources.tables import staged


def save_bucketed(rows: DataFrame, table: str, key: str, buckets: int = 64) -> DataFrame:
    """Write rows as a table in buckets of key, sorted by it: joins of such tables on it need neither exchange nor more than a merge.

    One task writes a bucket, so that it is one file.
    """
    rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)
    return rows.sparkSession.table(table)


def write_partitions(rows: DataFrame, path: str, by: str) -> None:
    """Write the partitions of a folder that rows have; others stay."""
    rows.repartition(by, F.pmod(F.xxhash64(*[c for c in rows.columns if c != by]), F.lit(16))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: list[str], by: str) -> None:
    """Insert-or-replace into a folder of Parquet partitioned by a column: new rows take the place of those with equal keys (nulls are equal).

    Only the partitions (chapters) that new rows are in are read and written again. What is to be written is staged
    before a partition is replaced, so a failure before that leaves all as it was. new has a key once.
    """
    touched = new.select(by).distinct()
    old = spark.read.schema(new.schema).parquet(path).join(touched, by, "left_semi")
    both = old.withColumn("_load", F.lit(0)).unionByName(new.withColumn("_load", F.lit(1)))
    write_partitions(staged(insert_or_replace(both, keys, "_load").drop("_load"), "upsert"), path, by)


def set_columns(spark: SparkSession, path: str, updates: DataFrame, key: str, by: str) -> None:
    """Update in place: updates (by, key, and the columns to set) change the rows with their key, in the partitions they name."""
    touched = updates.select(by).distinct()
    new = [c for c in updates.columns if c not in (by, key)]
    old = spark.read.parquet(path).join(touched, by, "left_semi")
    fresh = updates.select(by, key, *[F.col(c).alias(f"_{c}") for c in new], F.lit(True).alias("_hit"))
    changed = old.join(fresh, [by, key], "left").withColumns({c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in new})
    write_partitions(staged(changed.select(old.columns), "update"), path, by)
