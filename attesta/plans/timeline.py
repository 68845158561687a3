"""Queries on timed rows: events stand for segments (view, six hours long) and frames (click, error) of a user's video."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from attesta.operators import alignment as A
from attesta.operators import sequence as S
from attesta.plans.registry import query

SECONDS = "epoch(ts)::DOUBLE"


def seconds():
    return F.unix_micros(F.col("ts").cast("timestamp")) / 1e6


def segments(read):
    e = read("events").where("event_type = 'view'")
    return e.select(F.col("user_id").alias("video_id"), F.col("event_id").alias("segment_id"), seconds().alias("ts_start"), (seconds() + 21600).alias("ts_end"))


def frames(read):
    e = read("events").where("event_type IN ('click', 'error')")
    return e.select(F.col("user_id").alias("video_id"), F.col("event_id").cast("string").alias("frame_id"), seconds().alias("timestamp_sec"), (F.get_json_object("props", "$.k").cast("int") < 10).alias("skip"))


@query("""WITH s AS (SELECT user_id AS video_id, event_id AS segment_id, epoch(ts)::DOUBLE AS a, epoch(ts)::DOUBLE + 21600 AS b FROM events WHERE event_type = 'view'),
    f AS (SELECT user_id AS video_id, event_id::VARCHAR AS frame_id, epoch(ts)::DOUBLE AS t, (props->>'$.k')::INT < 10 AS skip FROM events WHERE event_type IN ('click', 'error'))
    SELECT s.video_id, s.segment_id, coalesce(string_agg(f.frame_id, ',' ORDER BY t, frame_id), '') AS frame_ids, count(f.frame_id) FILTER (NOT skip) AS n_visuals
    FROM s LEFT JOIN f ON s.video_id = f.video_id AND t BETWEEN a AND b GROUP BY ALL""")
def frame_align(read, spark):
    f = frames(read)
    out = A.align_frames(segments(read), f.drop("skip"), f.select("frame_id", "skip"), bin_size=21600.0)
    return out.select("video_id", "segment_id", F.array_join("frame_ids", ",").alias("frame_ids"), F.size("visual_ids").cast("long").alias("n_visuals"))


@query("""WITH s AS (SELECT user_id AS video_id, event_id AS segment_id, epoch(ts)::DOUBLE AS a, epoch(ts)::DOUBLE + 21600 AS b FROM events WHERE event_type = 'view'),
    f AS (SELECT user_id AS video_id, event_id AS frame_id, epoch(ts)::DOUBLE AS t, (props->>'$.k')::INT < 10 AS skip FROM events WHERE event_type IN ('click', 'error'))
    SELECT s.video_id, count(f.frame_id) AS frames_total, count(f.frame_id) FILTER (NOT skip) AS frames_with_content FROM s LEFT JOIN f ON s.video_id = f.video_id AND t BETWEEN a AND b GROUP BY ALL""")
def frame_totals(read, spark):
    f = frames(read)
    return A.frame_totals(A.align_frames(segments(read), f.drop("skip"), f.select("frame_id", "skip"), bin_size=21600.0))


@query("""WITH s AS (SELECT user_id AS video_id, event_id AS segment_id, epoch(ts)::DOUBLE AS a, epoch(ts)::DOUBLE + 21600 AS b FROM events WHERE event_type = 'view'),
    c AS (SELECT DISTINCT user_id AS video_id, floor(epoch(ts)::DOUBLE / 86400) AS day FROM events),
    j AS (SELECT s.video_id, segment_id, day FROM s JOIN c ON s.video_id = c.video_id AND a >= day * 86400 AND b <= day * 86400 + 86400)
    SELECT segment_id, video_id || '_' || lpad((dense_rank() OVER (PARTITION BY video_id ORDER BY day) - 1)::VARCHAR, 3, '0') AS topic_id FROM j""")
def chapter_containment(read, spark):
    days = read("events").select(F.col("user_id").alias("video_id"), F.floor(seconds() / 86400).alias("chapter_pos")).distinct()
    # a day's last instant belongs to the next one's bin too: segments end by then
    chapters = days.select("video_id", "chapter_pos", F.lit("").alias("title"), (F.col("chapter_pos") * 86400.0).alias("start_time"), (F.col("chapter_pos") * 86400.0 + 86400).alias("end_time"))
    return A.chapters_of_segments(segments(read), chapters, 86400.0).select("segment_id", "topic_id")


@query("""WITH RECURSIVE r AS (SELECT user_id, event_id, round(value * 100)::BIGINT AS d, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    w AS (SELECT user_id, event_id, n, 0::BIGINT AS window_no, d AS total FROM r WHERE n = 1
      UNION ALL SELECT r.user_id, r.event_id, r.n, w.window_no + (w.total >= 3000)::INT, CASE WHEN w.total >= 3000 THEN r.d ELSE w.total + r.d END FROM w JOIN r ON r.user_id = w.user_id AND r.n = w.n + 1)
    SELECT user_id, event_id, window_no FROM w""")
def segment_windows(read, spark):
    e = read("events").select("user_id", "ts", "event_id", F.round(F.col("value") * 100).cast("bigint").alias("amount"))
    return S.resetting_windows(e, ["user_id"], ["ts", "event_id"], "amount", 3000).select("user_id", "event_id", "window_no")


@query("""WITH RECURSIVE r AS (SELECT user_id, event_id, epoch_us(ts) AS t, value, ('0x' || sha256(event_id::VARCHAR)[1:3])::INT AS h, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    f AS (SELECT user_id, event_id, n, CASE WHEN value < 5 THEN 'density' ELSE 'kept' END AS verdict, CASE WHEN value < 5 THEN NULL ELSE t END AS last, CASE WHEN value < 5 THEN []::INT[] ELSE [h] END AS kept FROM r WHERE n = 1
      UNION ALL SELECT r.user_id, r.event_id, r.n, v, CASE WHEN v = 'kept' THEN r.t ELSE f.last END, CASE WHEN v = 'kept' THEN list_append(f.kept, r.h) ELSE f.kept END
        FROM f JOIN (SELECT *, 0 AS z FROM r) r ON r.user_id = f.user_id AND r.n = f.n + 1,
        LATERAL (SELECT CASE WHEN r.value < 5 THEN 'density' WHEN f.last IS NOT NULL AND r.t - f.last < 3600000000 THEN 'spacing' WHEN len(list_filter(f.kept, lambda k: bit_count(xor(k, r.h)) <= 1)) > 0 THEN 'hamming' ELSE 'kept' END AS v))
    SELECT user_id, event_id, verdict FROM f""")
def frame_dedup(read, spark):
    e = read("events").select("user_id", "ts", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.col("value").alias("density"), F.conv(F.substring(F.sha2(F.col("event_id").cast("string"), 256), 1, 3), 16, 10).cast("bigint").alias("bits"))
    return S.greedy_frames(e, ["user_id"], ["ts", "event_id"], "t", "density", "bits", 5.0, 3_600_000_000, 1).select("user_id", "event_id", "verdict")


@query("""WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
    k AS (SELECT unnest(range(40)) AS k) SELECT DISTINCT user_id, event_id FROM r LEFT JOIN k ON n > 40 AND i = k * n // 40 WHERE n <= 40 OR k IS NOT NULL""")
def frame_cap(read, spark):
    return S.downsample(read("events"), ["user_id"], ["ts", "event_id"], 40).select("user_id", "event_id")


@query("""SELECT event_id, user_id || '_f' || lpad((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::VARCHAR, 4, '0') AS frame_id, user_id::VARCHAR AS video_id FROM events""")
def frame_ids(read, spark):
    from attesta.functions.text import video_of_frame

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    out = read("events").select("event_id", S.sequence_id(F.col("user_id"), n, 4, "_f").alias("frame_id"))
    return out.withColumn("video_id", video_of_frame(F.col("frame_id")))


VECTORS_SQL = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, 150 + vec_id % 100 AS words, lag(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings),
    s AS (SELECT *, CASE WHEN b IS NOT NULL THEN list_dot_product(v, b) END AS similarity FROM e),
    p AS (SELECT *, sum((coalesce(similarity < 0.02, false))::INT) OVER (PARTITION BY label ORDER BY vec_id)::BIGINT AS piece FROM s)"""


def pieces(read):
    e = read("embeddings").withColumn("words", 150 + F.col("vec_id") % 100)
    return S.boundaries(S.with_lag_similarity(e, ["label"], ["vec_id"], "embedding"), ["label"], ["vec_id"], 0.02)


@query("WITH " + VECTORS_SQL + " SELECT vec_id, label, piece, round(similarity, 6) AS similarity FROM p")
def topic_boundaries(read, spark):
    return pieces(read).select("vec_id", "label", "piece", F.round("similarity", 6).alias("similarity"))


@query("WITH " + VECTORS_SQL + """, g AS (SELECT label, piece, sum(words)::BIGINT AS words FROM p GROUP BY ALL),
    m AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY piece) = 1 OR words >= 400 AS stands FROM g)
    SELECT label, piece, words, sum(stands::INT) OVER (PARTITION BY label ORDER BY piece)::BIGINT - 1 AS group_no FROM m""")
def small_groups(read, spark):
    grouped = pieces(read).groupBy("label", "piece").agg(F.sum("words").alias("words"))
    return S.merge_small(grouped, ["label"], 400)


@query("SELECT source AS video_id, row_number() OVER (ORDER BY min(doc_id)::VARCHAR, source) - 1 AS rank FROM documents GROUP BY source")
def video_rank(read, spark):
    v = read("documents").groupBy(F.col("source").alias("video_id")).agg(F.min("doc_id").cast("string").alias("upload_date"))
    return S.video_rank(v).select("video_id", F.col("rank").cast("long").alias("rank"))


@query("""WITH a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events WHERE event_type = 'click'),
    b AS (SELECT user_id, epoch(ts)::DOUBLE AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events WHERE event_type = 'error')
    SELECT a.user_id, event_id, coalesce(t, pos::DOUBLE) AS timestamp_sec FROM a LEFT JOIN b USING (user_id, pos)""")
def positional_zip(read, spark):
    e = read("events")
    files = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("file"))
    stamps = e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("frame_no"), seconds().alias("pts_time"))
    return A.ordinal_timestamps(files, stamps, "user_id").select("user_id", F.col("file").alias("event_id"), "timestamp_sec")
