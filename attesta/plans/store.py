"""Queries on the claim store: documents stand for claims (video: source, time: doc_id), labels for assignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import claims as C
from attesta.plans.registry import query

CLAIMS_SQL = "SELECT doc_id AS id, source AS video_id, doc_id::DOUBLE AS ts_start, text AS content FROM documents"


def claims(read):
    return read("documents").select(F.col("doc_id").alias("id"), F.col("source").alias("video_id"), F.col("doc_id").cast("double").alias("ts_start"), F.col("text").alias("content"))


def assignments(read):
    return read("labels").where("quality = 1").join(read("documents").select("doc_id", "lang"), "doc_id").select(F.col("lang").alias("chapter_id"), F.col("doc_id").alias("claim_id"))


ASSIGNED_SQL = "SELECT lang AS chapter_id, doc_id AS claim_id FROM labels JOIN documents USING (doc_id) WHERE quality = 1"


@query("SELECT id, video_id, ts_start FROM (" + CLAIMS_SQL + ") WHERE id = 17")
def claim_by_id(read, spark):
    return C.by_id(claims(read), 17).select("id", "video_id", "ts_start")


@query("SELECT id, video_id, ts_start, length(content) AS n_chars FROM (" + CLAIMS_SQL + ") WHERE video_id = 'src3'")
def claims_by_video(read, spark):
    return C.by_video(claims(read), "src3").select("id", "video_id", "ts_start", F.length("content").cast("long").alias("n_chars"))


@query("SELECT chapter_id, id, video_id FROM (" + CLAIMS_SQL + ") JOIN (" + ASSIGNED_SQL + ") ON id = claim_id")
def claims_for_chapter(read, spark):
    return C.for_chapter(claims(read), assignments(read)).select("chapter_id", "id", "video_id")


@query("SELECT id::BIGINT AS id, max(pos) AS pos FROM (SELECT unnest([5, 3, 999999999, 5, 11, 8]) AS id, unnest([0, 1, 2, 3, 4, 5]) AS pos) r WHERE id IN (SELECT doc_id FROM documents) GROUP BY id")
def claims_in_order(read, spark):
    request = spark.range(1).select(F.posexplode(F.array(*[F.lit(x).cast("long") for x in (5, 3, 999999999, 5, 11, 8)])).alias("pos", "id"))
    return C.in_request_order(claims(read), request).select("id", "pos")


@query("SELECT id, video_id, row_number() OVER (ORDER BY video_id, ts_start, id) AS place FROM (" + CLAIMS_SQL + ")")
def claims_ordered(read, spark):
    return C.number(C.all_claims(claims(read)), ["video_id", "ts_start", "id"]).select("id", "video_id", F.col("_n").alias("place"))


@query("SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def existing_ids(read, spark):
    return C.existing_ids(claims(read), read("labels").select(F.col("doc_id").alias("id")))


@query("SELECT DISTINCT source AS video_id FROM documents")
def distinct_videos(read, spark):
    return C.distinct_videos(claims(read))


@query("SELECT d.doc_id AS id, coalesce(quality::DOUBLE, 1.0) AS confidence FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(quality::DOUBLE, 1.0) >= 0.7")
def confidence_filter(read, spark):
    scored = claims(read).join(read("labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("confidence")), "id", "left")
    return C.confident(scored).select("id", F.coalesce("confidence", F.lit(1.0)).alias("confidence"))


@query("""SELECT d.doc_id AS id, CASE WHEN toxic IS NULL THEN 'fact' WHEN toxic = 1 THEN 'opinion' ELSE 'fact' END AS type, coalesce(quality::DOUBLE, 1.0) AS confidence,
    coalesce(CASE WHEN quality = 1 THEN d.doc_id * 2.0 END, d.doc_id::DOUBLE) AS ts_start FROM documents d LEFT JOIN labels l USING (doc_id)""")
def default_filling(read, spark):
    found = claims(read).join(read("labels").withColumnRenamed("doc_id", "id"), "id", "left")
    raw = found.select("id", "video_id", "content", F.when(F.col("toxic") == 1, "opinion").alias("type"), F.col("quality").cast("double").alias("confidence"), F.when(F.col("quality") == 1, F.col("id") * 2.0).alias("ts_start"), F.lit(None).cast("double").alias("ts_end"), F.col("ts_start").alias("segment_start"), F.col("ts_start").alias("segment_end"), F.lit(None).cast("array<string>").alias("frame_ids"))
    return C.with_defaults(raw).select("id", "type", "confidence", "ts_start")


@query("SELECT doc_id AS id FROM documents WHERE source NOT IN ('src1', 'src2')")
def excluded_videos(read, spark):
    out = spark.createDataFrame([("src1",), ("src2",)], "video_id string")
    return C.excluding(claims(read), out, "video_id").select("id")


@query("SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def not_yet_loaded(read, spark):
    return C.not_loaded(claims(read), read("labels").select(F.col("doc_id").alias("id")), ["id"]).select("id")


@query("SELECT doc_id AS id, source AS video_id FROM documents ORDER BY source, doc_id LIMIT 1")
def pilot_video(read, spark):
    return C.pilot(claims(read), ["video_id", "id"]).select("id", "video_id")


@query("SELECT doc_id FROM labels WHERE NOT coalesce(toxic = 1, false)")
def unskipped_frames(read, spark):
    return C.unskipped(read("labels").withColumn("skip", F.col("toxic") == 1)).select("doc_id")


@query("""WITH m AS (SELECT max(doc_id) AS top FROM documents)
    SELECT item_id, top + row_number() OVER (ORDER BY item_id DESC) AS id FROM benchmark, m""")
def insert_numbered(read, spark):
    old = read("documents").select(F.col("doc_id").alias("id"), F.lit(None).cast("long").alias("item_id"))
    new = read("benchmark").select("item_id", (-F.col("item_id")).alias("o"))
    return C.add(old, new, ["o"]).where("item_id IS NOT NULL").select("item_id", "id")


@query("""SELECT doc_id, quality FROM labels UNION ALL
    SELECT doc_id, -1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id % 2 = 0""")
def insert_or_ignore(read, spark):
    new = read("documents").where("doc_id % 2 = 0").select("doc_id", F.lit(-1).alias("quality"))
    return C.insert_or_ignore(read("labels").select("doc_id", "quality"), new.union(new), ["doc_id"])


@query("""WITH loads AS (SELECT 1 AS load, lang AS chapter_id, doc_id AS sentence_index, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id END AS claim_id, 'grounded' AS status FROM documents
      UNION ALL SELECT 2, lang, doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id END, 'unsupported' FROM documents WHERE doc_id % 2 = 0)
    SELECT chapter_id, sentence_index, claim_id, arg_max(status, load) AS status FROM loads GROUP BY ALL""")
def upsert_citations(read, spark):
    base = read("documents").select(F.col("lang").alias("chapter_id"), F.col("doc_id").alias("sentence_index"), F.when(F.col("doc_id") % 3 != 0, F.col("doc_id")).alias("claim_id"))
    loads = base.withColumns({"load": F.lit(1), "status": F.lit("grounded")}).union(base.where("sentence_index % 2 = 0").withColumns({"load": F.lit(2), "status": F.lit("unsupported")}))
    return C.insert_or_replace(loads, ["chapter_id", "sentence_index", "claim_id"], "load").drop("load")


@query("""SELECT lang AS chapter_id, doc_id::INT AS sentence_index, unnest(CASE WHEN doc_id % 4 = 0 THEN [NULL] ELSE [doc_id::INT, (doc_id + 1)::INT] END) AS claim_id FROM documents""")
def citation_unnest(read, spark):
    refs = F.when(F.col("doc_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("c"), F.col("doc_id")), F.concat(F.col("doc_id") + 1, F.lit("]"))))
    rows = read("documents").select(F.col("lang").alias("chapter_id"), F.col("doc_id").cast("int").alias("index"), F.lit("").alias("text"), F.lit("factual").alias("type"), refs.alias("cited_claim_ids"), F.lit("grounded").alias("status"), F.lit("").alias("reason"))
    return C.citation_rows(rows).select("chapter_id", "sentence_index", "claim_id")


@query("""SELECT event_id AS id, 'user' || user_id AS video_id, (floor(epoch(ts))::BIGINT % 86400)::DOUBLE AS ts_start,
    ((floor(epoch(ts))::BIGINT % 86400) // 60) || 'm' || (floor(epoch(ts))::BIGINT % 60) || 's' AS starts,
    'https://www.youtube.com/watch?v=user' || user_id || '&t=' || (floor(epoch(ts))::BIGINT % 86400) || 's' AS url FROM events""")
def lookup_url(read, spark):
    at = (F.unix_timestamp(F.col("ts").cast("timestamp")) % 86400).cast("double")
    rows = read("events").select(F.col("event_id").alias("id"), F.lit("").alias("content"), F.concat(F.lit("user"), F.col("user_id")).alias("video_id"), at.alias("ts_start"), at.alias("ts_end"))
    return C.lookup(rows).join(rows.select("id", "ts_start"), "id").select("id", "video_id", "ts_start", "starts", "url")


@query("""SELECT doc_id AS id, 'c' || doc_id || ' [fact|' || source || '|' || doc_id || 's]: ' ||
    CASE WHEN length(t) > 200 THEN substr(t, 1, 197) || '...' ELSE t END AS line FROM (SELECT *, trim(replace(text, chr(10), ' '), ' ') AS t FROM documents)""")
def claim_lines(read, spark):
    return claims(read).select("id", T.claim_line(F.col("id"), F.lit("fact"), F.col("video_id"), F.col("ts_start"), F.col("content")).alias("line"))


@query("SELECT doc_id AS id, '[c' || doc_id || '] ' || replace(text, chr(10), chr(10) || '  ') AS line FROM documents")
def payload_lines(read, spark):
    return claims(read).select("id", T.payload_line(F.col("id"), F.col("content")).alias("line"))


@query("SELECT doc_id, sha256(concat_ws('|', source, doc_id::VARCHAR, text)) AS source_hash, sha256(concat_ws('|', source, doc_id::VARCHAR, text))[1:12] AS short FROM documents")
def content_hash(read, spark):
    h = T.content_hash(F.col("source"), F.col("doc_id").cast("string"), F.col("text"))
    return read("documents").select("doc_id", h.alias("source_hash"), T.short_hash(h).alias("short"))


@query("""SELECT doc_id AS id, CASE WHEN quality = 0 THEN doc_id + 1 END AS superseded_by FROM documents LEFT JOIN labels USING (doc_id)""")
def extra_update(read, spark):
    base = read("documents").select(F.col("doc_id").alias("id"), F.lit(None).cast("struct<superseded_by:bigint>").alias("extra"))
    new = read("labels").where("quality = 0").select(F.col("doc_id").alias("id"), F.struct((F.col("doc_id") + 1).alias("superseded_by")).alias("extra"))
    return C.set_extra(base, new).select("id", F.col("extra.superseded_by").alias("superseded_by"))
