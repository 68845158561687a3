"""Tables: Parquet folders, a claim store as tables, and stores behind JDBC."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the claim store's tables.
CLAIMS = "id bigint, type string, content string, video_id string, ts_start double, ts_end double, frame_ids array<string>, confidence double, source_hash string, extra struct<superseded_by:bigint,supersession_reasons:array<string>,code_check:struct<parseable:boolean,language:string,reason:string>>"
ASSIGNMENTS = "chapter_id string, claim_id bigint"
CITATIONS = "chapter_id string, sentence_index int, sentence_text string, sentence_type string, claim_id bigint, status string, reason string"
STORE = {"claims": (CLAIMS, "video_id"), "chapter_assignments": (ASSIGNMENTS, "chapter_id"), "citations": (CITATIONS, "chapter_id")}


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def create_store(spark: SparkSession, database: str, buckets: int = 64) -> None:
    """Create the store's tables where they do not exist, bucketed by the key they are joined and filtered on."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (columns, key) in STORE.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet CLUSTERED BY ({key}) INTO {buckets} BUCKETS")


def jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, low: int = 0, high: int = 0, parts: int = 1) -> DataFrame:
    """A table behind JDBC, read in ranges of a numeric key if one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if key:
        reader = reader.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    return reader.load()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where that is unset, one below the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (found or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged").rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read back: all that reads it sees the same rows, and a lost executor costs a re-read."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def unstaged(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.staged_path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def counted(ids: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """The distinct rows of one column of numbers, staged and marked for broadcast if they take no more than limit bytes in memory; beyond it a join shuffles both sides."""
    own = staged(ids.distinct(), "counted-ids")
    return F.broadcast(own) if own.count() * 24 <= limit else own
