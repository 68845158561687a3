"""Joins of timed rows: points into intervals, intervals into intervals, and by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def points_in_intervals(intervals: DataFrame, points: DataFrame, key: str, start: str, end: str, point: str, bin_size: float, how: str = "left") -> DataFrame:
    """Join every interval with the points of its key that lie in it, both ends included.

    Both sides are dealt into bins of the time axis, so the join is an equi-join on (key, bin): a key with very many
    intervals and points is spread over its bins instead of being compared all against all. An interval is repeated for
    each bin it touches; a point lies in one. Choose bin_size near the usual length of an interval. With how="left",
    intervals without a point survive with nulls.
    """
    bins = lambda c: F.floor(c / F.lit(bin_size))
    own = intervals.withColumn("_bin", F.explode(F.sequence(bins(F.col(start)), bins(F.col(end)))))
    spread = points.withColumn("_bin", bins(F.col(point)))
    hits = own.join(spread, [key, "_bin"]).where(F.col(point).between(F.col(start), F.col(end))).drop("_bin")
    if how == "inner":
        return hits
    extra = [c for c in points.columns if c != key]
    return intervals.join(hits.select(*intervals.columns, *extra), intervals.columns, "left")


def align_frames(segments: DataFrame, frames: DataFrame, vision: DataFrame, bin_size: float = 60.0) -> DataFrame:
    """Segments (video_id, segment_id, ts_start, ts_end) with the frames inside them.

    frame_ids holds all frames (video_id, frame_id, timestamp_sec) in order of time, visual_ids only those that have a
    row in vision (frame_id, skip) which is not skipped. A frame on a common boundary belongs to both segments; a
    segment without frames stays with empty lists. Segment ids are unique within a video.
    """
    seen = vision.where(~F.coalesce("skip", F.lit(False))).select("frame_id", F.lit(True).alias("_seen"))
    slim = segments.select("video_id", "segment_id", "ts_start", "ts_end")
    hits = points_in_intervals(slim, frames.select("video_id", "frame_id", "timestamp_sec").join(seen, "frame_id", "left"), "video_id", "ts_start", "ts_end", "timestamp_sec", bin_size, "inner")
    item = F.struct("timestamp_sec", "frame_id", "_seen")
    grouped = hits.groupBy("video_id", "segment_id").agg(F.sort_array(F.collect_list(item)).alias("_f"))
    out = segments.join(grouped, ["video_id", "segment_id"], "left")
    found = F.coalesce("_f", F.array().cast("array<struct<timestamp_sec:double,frame_id:string,_seen:boolean>>"))
    return out.withColumn("frame_ids", F.transform(found, lambda x: x["frame_id"])).withColumn("visual_ids", F.transform(F.filter(found, lambda x: x["_seen"].isNotNull()), lambda x: x["frame_id"])).drop("_f")


def frame_totals(aligned: DataFrame) -> DataFrame:
    """Frames of each video, and those with content."""
    return aligned.groupBy("video_id").agg(F.sum(F.size("frame_ids")).alias("frames_total"), F.sum(F.size("visual_ids")).alias("frames_with_content"))


def chapters_of_segments(segments: DataFrame, chapters: DataFrame, bin_size: float) -> DataFrame:
    """Segments in the chapter (video_id, chapter_pos, title, start_time, end_time) that contains them wholly.

    Segments over a boundary are dropped. A missing end_time is the video's duration, if that is a column and known, else 0. Chapters without a segment are dropped before numbering: topic_id is
    `<video>_<three digits>`, without gaps, in order of chapter_pos.
    """
    chapters = chapters.withColumn("end_time", F.coalesce("end_time", F.col("duration") if "duration" in chapters.columns else F.lit(None).cast("double"), F.lit(0.0))).drop("duration")
    chapters = chapters.where("end_time >= start_time")
    inside = points_in_intervals(chapters, segments, "video_id", "start_time", "end_time", "ts_start", bin_size, "inner").where(F.col("ts_end") <= F.col("end_time"))
    number = F.dense_rank().over(Window.partitionBy("video_id").orderBy("chapter_pos")) - 1
    return inside.withColumn("topic_id", F.format_string("%s_%03d", F.col("video_id").cast("string"), number))


def zip_positions(left: DataFrame, right: DataFrame, left_order: list[Column], right_order: list[Column], keys: list[str] | None = None, how: str = "left") -> DataFrame:
    """Join rows by their ordinal (column pos, from 0) within keys, each side in its own total order."""
    by = keys or []
    number = lambda df, order: df.withColumn("pos", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
    return number(left, left_order).join(number(right, right_order), [*by, "pos"], how)


def ordinal_timestamps(frames: DataFrame, stamps: DataFrame, key: str = "video_id") -> DataFrame:
    """Frames (key, file) with the timestamp (key, frame_no, pts_time) of the same ordinal; a missing one is the ordinal itself."""
    joined = zip_positions(frames, stamps, [F.col("file")], [F.col("frame_no")], [key])
    return joined.withColumn("timestamp_sec", F.coalesce("pts_time", F.col("pos").cast("double")))
