"""The claim store: look-ups, filters, idempotent and replacing loads. Tables are DataFrames; a load gives the new table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.sources.tables import staged


def by_id(claims: DataFrame, claim_id: int) -> DataFrame:
    return claims.where(F.col("id") == claim_id)


def in_request_order(claims: DataFrame, request: DataFrame) -> DataFrame:
    """Claims of a request (pos, id) in its order; unknown ids drop, and of a repeated id the last position counts."""
    last = request.groupBy("id").agg(F.max("pos").alias("pos"))
    return claims.join(last, "id").orderBy("pos")


def by_video(claims: DataFrame, video: Column | str) -> DataFrame:
    return claims.where(F.col("video_id") == video).orderBy("ts_start", "id")


def all_claims(claims: DataFrame) -> DataFrame:
    return claims.orderBy("video_id", "ts_start", "id")


def existing_ids(claims: DataFrame, asked: DataFrame) -> DataFrame:
    """The distinct ids among those asked for (column id) that the store has."""
    return asked.where("id IS NOT NULL").select("id").distinct().join(claims.select("id"), "id", "left_semi")


def distinct_videos(claims: DataFrame) -> DataFrame:
    return claims.select("video_id").distinct()


def for_chapter(claims: DataFrame, assignments: DataFrame, chapter: str | None = None) -> DataFrame:
    """Claims assigned to a chapter, or to each, in order of video and time."""
    own = assignments if chapter is None else assignments.where(F.col("chapter_id") == chapter)
    return claims.join(own.withColumnRenamed("claim_id", "id"), "id").orderBy("chapter_id", "video_id", "ts_start", "id")


def confident(claims: DataFrame, least: float = 0.7) -> DataFrame:
    """A missing confidence counts as 1."""
    return claims.where(F.coalesce("confidence", F.lit(1.0)) >= least)


def with_defaults(extracted: DataFrame) -> DataFrame:
    """Fill what an extractor left out: type fact, confidence 1, the segment's bounds, no frames; strip the content."""
    none = F.array().cast("array<string>")
    fills = {"type": F.coalesce("type", F.lit("fact")), "confidence": F.coalesce("confidence", F.lit(1.0)), "ts_start": F.coalesce("ts_start", "segment_start"), "ts_end": F.coalesce("ts_end", "segment_end"), "frame_ids": F.coalesce("frame_ids", none), "content": T.strip(F.col("content"))}
    out = extracted.withColumns(fills)
    return out.withColumn("source_hash", T.content_hash(F.col("video_id"), F.col("ts_start").cast("string"), F.col("content")))


def excluding(rows: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    return rows.join(excluded.select(key), key, "left_anti")


def not_loaded(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target lacks: what an incremental load still has to do."""
    return rows.join(target.select(*keys), keys, "left_anti")


def pilot(rows: DataFrame, order: list[str]) -> DataFrame:
    """The first row in a stated order."""
    return rows.orderBy(*order).limit(1)


def unskipped(vision: DataFrame) -> DataFrame:
    return vision.where(~F.coalesce("skip", F.lit(False)))


def add(claims: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """Append claims; ids go on from the largest one, without gaps, in a stated order.

    Numbering is by range: rows are sorted into partitions, partitions are counted, and each row's number is its
    partition's offset plus its place, so no single task holds all rows.
    """
    top = claims.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
    numbered = number(new, order).crossJoin(F.broadcast(top)).withColumn("id", F.col("_n") + F.col("_top")).drop("_n", "_top")
    return claims.unionByName(numbered.select(claims.columns))


def number(rows: DataFrame, order: list[str | Column]) -> DataFrame:
    """_n: the row's place from 1 in the whole order, without a single-partition window.

    The rows are written once with the partition they were dealt to. Counts and places are both taken from what was
    written, so that the two cannot disagree, however often and however differently the ranges would be planned again.
    """
    placed = staged(rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "numbered")
    counts = placed.groupBy("_p").agg(F.count("*").alias("_c"))
    # one row for each partition: the size is bounded by the number of partitions
    before = counts.withColumn("_before", F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).select("_p", "_before")
    within = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return placed.join(F.broadcast(before), "_p").withColumn("_n", F.col("_before") + within).drop("_p", "_before")


def insert_or_ignore(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key is not there yet; of repeated keys among the new ones, one."""
    return table.unionByName(not_loaded(new, table, keys).dropDuplicates(keys))


def insert_or_replace(loads: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """Of rows with equal keys, that of the last load. Null keys count as equal, so a repeated load does not double rows without a citation."""
    newest = Window.partitionBy(*keys).orderBy(F.col(sequence).desc())
    return loads.withColumn("_r", F.row_number().over(newest)).where("_r = 1").drop("_r")


def citation_rows(verified: DataFrame) -> DataFrame:
    """One row for each cited claim of a sentence (sentences with no citation: one with a null claim)."""
    return verified.select("chapter_id", F.col("index").alias("sentence_index"), F.col("text").alias("sentence_text"), F.col("type").alias("sentence_type"), F.explode_outer("cited_claim_ids").alias("_ref"), "status", "reason").withColumn("claim_id", T.claim_ref(F.col("_ref"))).drop("_ref")


def merge_extra(claims: DataFrame, updates: DataFrame) -> DataFrame:
    """Claims (id, extra: map of JSON texts) with the entries of updates (id, extra) put in; entries of other names stay."""
    fresh = updates.select("id", F.col("extra").alias("_e"))
    old = F.coalesce("extra", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(F.col("_e"), k)), F.col("_e"))
    return claims.join(fresh, "id", "left").withColumn("extra", F.when(F.col("_e").isNotNull(), merged).otherwise(F.col("extra"))).drop("_e")


def extra_json(extra: Column) -> Column:
    """A map of JSON texts as one JSON object, its names in order: equal contents give equal texts."""
    items = F.transform(F.sort_array(F.map_entries(extra)), lambda e: F.concat(F.to_json(F.struct(e["key"].alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(e["key"].alias("k")))) - 6), F.lit(":"), e["value"]))
    return F.concat(F.lit("{"), F.array_join(items, ","), F.lit("}"))


def set_extra(claims: DataFrame, updates: DataFrame) -> DataFrame:
    """Replace the column extra of the claims (id) that updates (id, extra) names."""
    fresh = updates.select("id", F.col("extra").alias("_e"), F.lit(True).alias("_hit"))
    return claims.join(fresh, "id", "left").withColumn("extra", F.when(F.col("_hit"), F.col("_e")).otherwise(F.col("extra"))).drop("_e", "_hit")


def lookup(claims: DataFrame) -> DataFrame:
    """Claims with the times in minutes and seconds and the address of their place in the video."""
    return claims.select("id", "content", "video_id", T.minutes_seconds(F.col("ts_start")).alias("starts"), T.minutes_seconds(F.col("ts_end")).alias("ends"), T.lookup_url(F.col("video_id"), F.col("ts_start")).alias("url"))
