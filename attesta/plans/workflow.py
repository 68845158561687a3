"""The stages of the workflow over whole tables, with models made by rule, so that SQL can say what they find."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from attesta.operators import claims as C
from attesta.operators import stages as ST
from attesta.plans.registry import query
from attesta.plans.timeline import seconds

VISUAL = "struct<frame_id:string,category:string,title:string,extracted_text:string,code:struct<language:string,content:string>,math:array<string>,diagram_summary:string,diagram_elements:array<string>>"


def described():
    """Tells by the frame's number: a face to be skipped, an answer in a fence, no JSON at all, or a slide."""

    def call(prompt: str) -> str:
        n = int(prompt)
        plain = json.dumps({"category": "slide", "title": f"T{n}"})
        return (json.dumps({"category": "face", "skip": True}), f"```json\n{plain}\n```", "no json", plain)[n % 4]

    return call


@query("""SELECT event_id::VARCHAR AS frame_id, CASE event_id % 4 WHEN 0 THEN 'face' WHEN 2 THEN NULL ELSE 'slide' END AS category, event_id % 4 IN (0, 2) AS skip, CASE WHEN event_id % 4 IN (1, 3) THEN 'T' || event_id END AS title,
    event_id % 4 = 2 AS parse_error, CASE WHEN event_id % 4 = 2 THEN 'no json' END AS raw_text FROM events WHERE event_type IN ('click', 'error') AND event_id % 7 <> 0""")
def frames_described(read, spark):
    """Frames that have no description yet are described; every seventh has one."""
    e = read("events").where("event_type IN ('click', 'error')")
    frames = e.select(F.col("event_id").cast("string").alias("frame_id"), F.col("user_id").alias("video_id"), seconds().alias("timestamp_sec"), F.col("event_id").cast("string").alias("prompt"))
    done = frames.where("CAST(frame_id AS BIGINT) % 7 = 0").select("frame_id")
    return ST.describe_frames(frames, done, described).select("frame_id", "category", "skip", "title", "parse_error", "raw_text")


@query("""WITH s AS (SELECT user_id, event_id, epoch(ts)::DOUBLE AS a, epoch(ts)::DOUBLE + 21600 AS b, event_type FROM events WHERE event_type IN ('view', 'click')),
    d AS (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY floor(a / 86400)) - 1 AS n, floor(a / 86400) AS day FROM s WHERE user_id % 2 = 0 AND b <= floor(a / 86400) * 86400 + 86400),
    o AS (SELECT *, 0 AS n, NULL::DOUBLE AS day FROM s WHERE user_id % 2 = 1), u AS (SELECT * FROM d UNION ALL SELECT * FROM o)
    SELECT user_id || '_' || lpad(n::VARCHAR, 3, '0') AS topic_id, coalesce('day ' || day::BIGINT, '') AS title, min(a) AS ts_start, max(b) AS ts_end, string_agg(event_id, ',' ORDER BY a, event_id) AS segment_ids, 2 * count(*) AS n_words FROM u GROUP BY user_id, n, day""")
def topics_segmented(read, spark):
    """Users with an even number are videos with a chapter for each day; the others have none, and without an embedder are one topic."""
    e = read("events").where("event_type IN ('view', 'click')")
    segments = e.select(F.col("user_id").cast("string").alias("video_id"), F.col("event_id").alias("segment_id"), seconds().alias("ts_start"), (seconds() + 21600).alias("ts_end"), F.concat(F.lit("said "), "event_type").alias("text"))
    day = F.floor(seconds() / 86400)
    chapter = F.struct((day * 86400.0).alias("start_time"), (day * 86400.0 + 86400).alias("end_time"), F.concat(F.lit("day "), day.cast("string")).alias("title"))
    lists = e.groupBy("user_id").agg(F.sort_array(F.collect_set(chapter)).alias("chapters"))
    videos = lists.select(F.col("user_id").cast("string").alias("video_id"), F.lit(0.0).alias("duration"), F.when(F.col("user_id") % 2 == 0, F.col("chapters")).alias("chapters"))
    out = ST.segment(videos, segments, None, bin_size=86400.0)
    return out.select("topic_id", "title", "ts_start", "ts_end", F.array_join(F.col("segment_ids").cast("array<string>"), ",").alias("segment_ids"), F.col("n_words").cast("long").alias("n_words"))


def extracted():
    """Finds in a segment's payload a fact, one of little confidence in every third, and a line of code; none in every fifth."""

    def call(prompt: str) -> str:
        n = int(re.search(r"from video (\d+)", prompt)[1])
        found = [{"content": f" fact of {n} ", "confidence": 0.5 if n % 3 == 0 else 0.9}, {"type": "code", "content": f"x = {n}" + "(" * (n % 2), "language": "python", "ts_start": n + 1.0}]
        return '{"not": "a list"}' if n % 5 == 0 else json.dumps(found)

    return call


@query("""WITH v AS (SELECT doc_id, doc_id::VARCHAR AS video_id FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 4 <> 0),
    n AS (SELECT video_id, 'fact' AS type, doc_id::DOUBLE AS ts_start, 'fact of ' || doc_id AS content, NULL AS parseable FROM v WHERE doc_id % 3 <> 0 UNION ALL SELECT video_id, 'code', doc_id + 1.0::DOUBLE, 'x = ' || doc_id || repeat('(', (doc_id % 2)::INT), doc_id % 2 = 0 FROM v),
    o AS (SELECT doc_id AS id, doc_id::VARCHAR AS video_id, 'fact' AS type, 0::DOUBLE AS ts_start, 'old' AS content, NULL::BOOLEAN AS parseable FROM documents WHERE doc_id % 4 = 0)
    SELECT * FROM o UNION ALL SELECT (SELECT max(id) FROM o) + row_number() OVER (ORDER BY video_id, ts_start, content), video_id, type, ts_start, content, parseable FROM n""")
def claims_extracted(read, spark):
    """A topic for each document; every fourth has a claim in the store already."""
    d = read("documents")
    at = F.col("doc_id").cast("double")
    segment = F.struct(at.alias("ts_start"), (at + 5).alias("ts_end"), F.substring("text", 1, 80).alias("text"), F.array().cast(f"array<{VISUAL}>").alias("visuals"))
    topics = d.select(F.col("doc_id").cast("string").alias("video_id"), at.alias("ts_start"), (at + 5).alias("ts_end"), F.col("lang").alias("title"), F.array(segment).alias("segments"))
    none = F.lit(None)
    store = d.where("doc_id % 4 = 0").select(F.col("doc_id").alias("id"), F.lit("fact").alias("type"), F.lit("old").alias("content"), F.col("doc_id").cast("string").alias("video_id"), F.lit(0.0).alias("ts_start"), F.lit(1.0).alias("ts_end"), F.array().cast("array<string>").alias("frame_ids"), F.lit(1.0).alias("confidence"), F.lit("h").alias("source_hash"), none.cast("map<string,string>").alias("extra"))
    out = ST.extract_claims(topics, store, extracted)
    return out.select("id", "video_id", "type", "ts_start", "content", F.get_json_object(F.col("extra")["code_check"], "$.parseable").cast("boolean").alias("parseable"))


def drafted():
    """Writes a chapter that cites the first of its claims, one that it does not have, and nothing."""

    def call(prompt: str) -> str:
        first = re.search(r"\[c(\d+)\]", prompt)[1]
        return f"```markdown\n# On it\n\nIt is so [c{first}]. It is odd [c999999999]. It is bare. So it goes.\n```"

    return call


def drafts(read):
    """Chapters of twenty documents each."""
    d = read("documents").withColumn("chapter_id", F.concat(F.lit("k"), F.floor(F.col("doc_id") / 20).cast("string")))
    store = d.select(F.col("doc_id").alias("id"), F.col("source").alias("video_id"), F.col("doc_id").cast("double").alias("ts_start"), F.substring(F.regexp_replace("text", r"[\[\]]", ""), 1, 100).alias("content"))
    assigned = d.select("chapter_id", F.col("doc_id").alias("claim_id"))
    return store, assigned, ST.draft_chapters(assigned.select("chapter_id", F.col("chapter_id").alias("title")).distinct(), store, assigned, drafted)


CHAPTERS_SQL = "c AS (SELECT 'k' || (doc_id // 20) AS chapter_id, arg_min(doc_id, struct_pack(v := source, t := doc_id)) AS first FROM documents GROUP BY ALL)"


@query("WITH " + CHAPTERS_SQL + """, s AS (SELECT chapter_id, first, unnest(range(5)) AS i FROM c)
    SELECT chapter_id, i::INT AS index, CASE WHEN i IN (0, 4) THEN 'narrative_ok' WHEN i = 1 THEN 'grounded' ELSE 'unsupported' END AS status,
    CASE i WHEN 0 THEN '# On it' WHEN 1 THEN 'It is so [c' || first || '].' WHEN 2 THEN 'It is odd [c999999999].' WHEN 3 THEN 'It is bare.' ELSE 'So it goes.' END AS text FROM s""")
def chapters_drafted(read, spark):
    return drafts(read)[2]["sentences"].select("chapter_id", "index", "status", "text")


@query("WITH " + CHAPTERS_SQL + """ SELECT chapter_id, '# On it It is so [c' || first || ']. So it goes.' || chr(10) AS text, 'POLISHED ' || first || ': # ON IT IT IS SO [C' || first || ']. SO IT GOES.' || chr(10) AS polished FROM c""")
def chapters_polished(read, spark):
    """What is left of the drafts, copy-edited by a model that gets the claims as well."""
    store, assigned, out = drafts(read)

    def upper():
        return lambda p: f"```md\nPOLISHED {re.search(r'c(\d+)', p)[1]}: " + p.split("polish\n\n", 1)[1].upper() + "\n```"

    payloads = C.for_chapter(store, assigned).groupBy("chapter_id").agg(F.min(F.struct("video_id", "ts_start", "id")).alias("m")).select("chapter_id", F.concat(F.lit("c"), F.col("m.id").cast("string")).alias("text"))
    return ST.polished(out["texts"], payloads, upper).select("chapter_id", "text", "polished")


def drawn():
    """Draws by the length of the description: code for two kinds, no JSON, or a wish to embed."""

    def call(prompt: str) -> str:
        n = int(re.search(r"plot (\d+)", prompt)[1])
        return (json.dumps({"mode": "mermaid", "code": "graph", "caption": f"M{n}"}), "```json\n" + json.dumps({"mode": "tikz", "code": "draw", "caption": f"Z{n}"}) + "\n```", "no json", json.dumps({"mode": "embed", "caption": f"E{n}"}))[n % 4]

    return call


@query("""WITH f AS (SELECT doc_id, 'd' || doc_id AS chapter_id, unnest(range(1, (doc_id % 3 + 1)::BIGINT)) AS number FROM documents), g AS (SELECT *, doc_id + number AS n, doc_id % 2 = 0 AS shown FROM f)
    SELECT chapter_id, number::INT AS number, CASE n % 4 WHEN 0 THEN 'mermaid' WHEN 1 THEN 'tikz' ELSE 'embed' END AS mode, CASE n % 4 WHEN 0 THEN 'graph' WHEN 1 THEN 'draw' END AS code,
      CASE n % 4 WHEN 0 THEN 'M' || n WHEN 1 THEN 'Z' || n WHEN 2 THEN 'plot ' || n ELSE 'E' || n END AS caption, CASE WHEN n % 4 = 2 THEN 'parse_error' END AS rationale,
      CASE n % 4 WHEN 0 THEN 'generated/' || chapter_id || '_fig0' || number || '.mmd' WHEN 1 THEN 'generated/' || chapter_id || '_fig0' || number || '.tex' ELSE CASE WHEN shown THEN 'embedded/' || chapter_id || '_fig0' || number || '.jpg' END END AS artifact_path,
      CASE WHEN shown THEN 'd' || doc_id || '_f1,d' || doc_id || '_f3' ELSE '' END AS images FROM g""")
def figures_drawn(read, spark):
    """Up to two directives in each document, with three diagrams of its claim for every second one, of which two images are sent."""
    d = read("documents").withColumn("chapter_id", F.concat(F.lit("d"), "doc_id"))
    number = F.sequence(F.lit(1).cast("long"), F.col("doc_id") % 3)
    marks = F.when(F.col("doc_id") % 3 > 0, F.array_join(F.transform(number, lambda n: F.concat(F.lit(" [FIGURE: plot "), (F.col("doc_id") + n).cast("string"), F.lit("]"))), " and")).otherwise("")
    texts = d.select("chapter_id", F.concat(F.translate("text", "[]", ""), marks).alias("text"))
    frame = lambda n: F.concat("chapter_id", F.lit(f"_f{n}"))
    store = d.select(F.col("doc_id").alias("id"), F.col("chapter_id").alias("video_id"), F.lit(0.0).alias("ts_start"), F.array(*map(frame, (1, 2, 3, 4))).alias("frame_ids"))
    vision = d.where("doc_id % 2 = 0").select(F.explode(F.array(*[F.struct(frame(n).alias("frame_id"), F.lit(kind).alias("category"), F.lit("t").alias("title")) for n, kind in ((1, "slide"), (2, "face"), (3, "diagram"), (4, "math"))])).alias("v")).select("v.*")
    asked = ST.figures(texts, store, d.select("chapter_id", F.col("doc_id").alias("claim_id")), vision)
    return ST.drawn_figures(asked, drawn).withColumn("images", F.array_join("images", ",")).withColumn("number", F.col("number").cast("int"))


@query("""WITH p AS (SELECT source, doc_id // 50 AS part, doc_id, doc_id % 10 = 9 AS app, text || ' [c' || doc_id || ']' AS t FROM documents WHERE doc_id % 7 <> 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY source, part, app ORDER BY doc_id) AS k FROM p)
    SELECT source, part, '---' || chr(10) || 'title: "Of ' || source || '"' || chr(10) || 'author: "me"' || chr(10) || 'date: "May 2024"' || chr(10) || '---' || chr(10) || chr(10) || string_agg(CASE WHEN app AND k = 1 THEN chr(92) || 'appendix' || chr(10) || chr(10) ELSE '' END
      || replace(regexp_replace(t, '\\s*\\[@?c\\d+(?:,\\s*@?c\\d+)*\\]', '', 'g'), '−', '-'), chr(10) || chr(10) ORDER BY app, doc_id) || chr(10) AS text FROM n GROUP BY source, part""")
def manuscripts(read, spark):
    """A manuscript of each source and fifty documents, with its metadata; every tenth document is an appendix, every seventh part is missing."""
    d = read("documents").withColumn("part", F.floor(F.col("doc_id") / 50))
    parts = d.select("source", "part", F.when(F.col("doc_id") % 10 == 9, "appendix").otherwise("chapter").alias("kind"), F.col("doc_id").alias("pos"), F.when(F.col("doc_id") % 7 != 0, F.concat("text", F.lit(" [c"), "doc_id", F.lit("]"))).alias("text"))
    return ST.manuscript(parts, F.concat(F.lit("Of "), "source"), F.lit("me"), F.lit("May 2024"), ("source", "part"))
