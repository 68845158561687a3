"""The stages of the workflow as compositions of operators: what goes in and comes out are tables, models are injected.

Each stage does what is still to be done: rows whose key the target has already are left out before a model is asked.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import code as K
from attesta.functions import text as T
from attesta.functions import vectors as V
from attesta.operators import alignment, assembly, budget, claims, grounding, lineage, providers, retrieval, sequence

Model = Callable[[], Callable[[str], str]]
Wait = Callable[[int], float]

#: Costs, exact to a millionth of a millionth.
MONEY = "decimal(30,12)"

#: What an extractor answers with for each claim, a planner for an outline, and a describer for a frame.
CLAIM = "array<struct<type:string,content:string,ts_start:double,ts_end:double,frame_ids:array<string>,confidence:double,language:string>>"
OUTLINE = "chapters array<struct<id:string,title:string,claim_ids:array<bigint>>>, appendices array<struct<id:string,title:string,claim_ids:array<bigint>>>"
FRAME = "category string, skip boolean, title string, extracted_text string"


def ask_within_budget(rows: DataFrame, prompt_col: str, make: Model, log: DataFrame, stage: str, price: float, ceiling: float, tries: int = 10, wait: Wait = providers.at_once) -> tuple[DataFrame, DataFrame]:
    """Answers of a model to rows (id, prompt), and the log with what they cost. Rows that the budget does not allow are not asked: their error says so.

    What a prompt will cost is estimated from its length before any call; prompts are admitted in order of id (unique)
    until the ceiling is reached, what was spent before included. Costs are decimals and their running total is made
    over ranges of ids, so neither partitions nor the number of rows matter. After a failed call wait(n) seconds pass.
    """
    spent = log.agg(F.coalesce(F.sum(F.col("usd").cast(MONEY)), F.lit(0).cast(MONEY)).alias("_before"))
    costs = rows.withColumn("_usd", (V.token_estimate(F.length(prompt_col)).cast("decimal(12,0)") * F.lit(Decimal(str(price))).cast("decimal(12,6)") / F.lit(10**6).cast("decimal(7,0)")).cast(MONEY))
    admitted = budget.running_total(costs, ["id"], "_usd").crossJoin(F.broadcast(spent)).withColumn("_ok", F.col("_before") + F.col("spent") + F.col("_usd") <= F.lit(Decimal(str(ceiling))))
    own = admitted.drop("spent", "_before")
    asked = providers.answers(own.where("_ok").drop("_ok"), prompt_col, make, tries=tries, wait=wait)
    refused = own.where("NOT _ok").drop("_ok").withColumns({"answer": F.lit(None).cast("string"), "error": F.lit("budget exceeded")})
    used = asked.select(F.lit(stage).alias("stage"), F.col("_usd").cast("double").alias("usd"))
    return asked.unionByName(refused).drop("_usd"), log.select("stage", "usd").unionByName(used)


def describe_frames(frames: DataFrame, done: DataFrame, make: Model, tries: int = 10, wait: Wait = providers.at_once) -> DataFrame:
    """Descriptions of the frames (frame_id, video_id, timestamp_sec, prompt) that have none yet.

    A frame whose call fails has no row and is tried again in the next run; one whose answer is no JSON is kept as
    skipped, with the answer's text.
    """
    asked = providers.answers(claims.not_loaded(frames, done, ["frame_id"]), "prompt", make, tries=tries, wait=wait).where("error IS NULL")
    parsed = providers.parsed_json(asked, "answer", FRAME)
    return parsed.select("frame_id", "video_id", "timestamp_sec", "parsed.category", (F.col("parse_error") | F.coalesce("parsed.skip", F.lit(False))).alias("skip"), "parsed.title", "parsed.extracted_text", "parse_error", "raw_text")


def align(manifest: DataFrame, segments: DataFrame, frames: DataFrame, vision: DataFrame, bin_size: float = 60.0) -> DataFrame:
    """Segments with their frames, for the videos that are listed and have both segments and frames."""
    ready = manifest.select("video_id").join(segments.select("video_id"), "video_id", "left_semi").join(frames.select("video_id"), "video_id", "left_semi")
    return alignment.align_frames(segments.join(ready, "video_id", "left_semi"), frames, vision, bin_size)


def segment(videos: DataFrame, segments: DataFrame, embed: Callable | None, window: float = 60.0, threshold: float = 0.55, min_words: int = 200, bin_size: float = 600.0) -> DataFrame:
    """Topic segments: topic_id, video_id, title, ts_start, ts_end, segment_ids, n_words.

    videos: video_id, duration, chapters (array of start_time, end_time, title). A video with chapters is cut by them;
    another one is gathered into windows of time, cut where neighbours are unlike, and small pieces join the one before.
    A single window is a single segment; a video without segments has none. segments: video_id, segment_id, ts_start,
    ts_end, text.
    """
    listed = videos.select("video_id", "duration", F.posexplode("chapters").alias("chapter_pos", "_c")).select("video_id", "duration", "chapter_pos", F.col("_c.title").alias("title"), F.col("_c.start_time").alias("start_time"), F.col("_c.end_time").alias("end_time"))
    by_chapter = alignment.chapters_of_segments(segments, listed, bin_size)
    free = segments.join(videos.where(F.size(F.coalesce("chapters", F.array())) <= 0), "video_id", "left_semi")
    placed = sequence.resetting_windows(free.withColumn("_d", F.col("ts_end") - F.col("ts_start")), ["video_id"], ["ts_start", "segment_id"], "_d", window).drop("_d")
    item = F.struct("ts_start", "segment_id", "text")
    windows = placed.groupBy("video_id", "window_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["text"]), " ").alias("text"))
    near = sequence.with_lag_similarity(providers.embedded(windows, "text", embed), ["video_id"], ["window_no"], "embedding")
    pieces = sequence.boundaries(near, ["video_id"], ["window_no"], threshold).withColumn("words", T.words(F.col("text")))
    merged = sequence.merge_small(pieces.groupBy("video_id", "piece").agg(F.sum("words").alias("words")), ["video_id"], min_words)
    groups = pieces.join(merged.select("video_id", "piece", "group_no"), ["video_id", "piece"]).select("video_id", "window_no", "group_no")
    by_topic = placed.join(groups, ["video_id", "window_no"]).withColumn("topic_id", sequence.sequence_id(F.col("video_id"), F.col("group_no"))).withColumn("title", F.lit(""))
    cols = ["topic_id", "video_id", "title", "segment_id", "ts_start", "ts_end", "text"]
    both = by_chapter.select(cols).unionByName(by_topic.select(cols))
    ids = F.transform(F.sort_array(F.collect_list(F.struct("ts_start", "segment_id"))), lambda x: x["segment_id"])
    return both.groupBy("topic_id", "video_id", "title").agg(F.min("ts_start").alias("ts_start"), F.max("ts_end").alias("ts_end"), ids.alias("segment_ids"), F.sum(T.words(F.col("text"))).alias("n_words"))


def extract_claims(topics: DataFrame, store: DataFrame, make: Model, least: float = 0.7, tries: int = 10, wait: Wait = providers.at_once) -> DataFrame:
    """The store with the claims that a model finds in the topics (video_id, ts_start, ts_end, title, segments) of videos it has none of.

    An answer that is no list gives no claim. Claims of little confidence are dropped, missing fields are filled in,
    code is checked, and ids go on from the largest one in the order of video, time and content. store has the columns
    of the claims table, extra being a map of JSON texts.
    """
    prompts = assembly.segment_payload(claims.not_loaded(topics, store.select("video_id").distinct(), ["video_id"]))
    found = providers.parsed_json(providers.answers(prompts, "payload", make, tries=tries, wait=wait), "answer", CLAIM)
    found = found.where(F.startswith(T.strip_json_fence(F.col("answer")), F.lit("[")))
    rows = found.select("video_id", F.col("ts_start").alias("segment_start"), F.col("ts_end").alias("segment_end"), F.explode("parsed").alias("_x")).select("video_id", "segment_start", "segment_end", "_x.*")
    full = claims.with_defaults(claims.confident(rows))
    check = F.to_json(K.check_code("content", "language"))
    none = F.lit(None).cast("map<string,string>")
    extra = F.when(F.col("type") == "code", F.map_from_arrays(F.array(F.lit("code_check")), F.array(check))).otherwise(none)
    return claims.add(store, full.withColumn("extra", extra).withColumn("id", F.lit(None).cast("bigint")).select(store.columns), ["video_id", "ts_start", "content"])


def outline(store: DataFrame, ranks: DataFrame, assigned: DataFrame, make: Model, tries: int = 10, wait: Wait = providers.at_once) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The chapters that a model plans over the current claims, the assignments with theirs, and the supersession applied.

    store: id, type, content, video_id, ts_start, embedding. The prompt has a line for every current claim; a claim
    that the plan names though it is superseded is pruned. An answer that is no outline raises when it is read.
    """
    applied = lineage.apply(lineage.links(store, ranks), store)
    lines = lineage.current(store, applied).withColumn("line", T.claim_line(F.col("id"), F.col("type"), F.col("video_id"), F.col("ts_start"), F.col("content")))
    prompt = assembly.joined_texts(lines.withColumn("k", F.lit(1)), ["k"], "id", "line", "\n").withColumnRenamed("text", "prompt")
    plan = providers.parsed_json(providers.answers(prompt, "prompt", make, tries=tries, wait=wait), "answer", OUTLINE)
    sound = F.when(F.col("parse_error") | F.col("parsed.chapters").isNull(), F.raise_error(F.lit("the answer is no outline"))).otherwise(F.col("parsed"))
    own = plan.select(sound.alias("p")).select(F.posexplode(F.concat(F.coalesce("p.chapters", F.array()), F.coalesce("p.appendices", F.array()))).alias("pos", "c"))
    chapters = lineage.prune_outline(own.select("pos", F.col("c.id").alias("chapter_id"), F.col("c.title").alias("title"), F.col("c.claim_ids").alias("claim_ids")), applied)
    given = chapters.select("chapter_id", F.explode("claim_ids").alias("claim_id"))
    return chapters, claims.insert_or_ignore(assigned, given, ["chapter_id", "claim_id"]), applied


def draft_chapters(chapters: DataFrame, store: DataFrame, assigned: DataFrame, make: Model, judge: Callable[[DataFrame], DataFrame] | None = None, tries: int = 10, wait: Wait = providers.at_once) -> dict[str, DataFrame]:
    """Chapters (chapter_id, title) written by a model from their claims, verified against them, and cleaned.

    Gives sentences (with status, reason, demoted), summaries (five statuses a chapter), texts (without the sentences
    that nothing supports, and their indices) and citations (rows of the store). judge may change status and reason of
    the verified sentences, as a model would; what it calls grounded is demoted if it cites what is no claim of the
    chapter.
    """
    lines = claims.for_chapter(store, assigned).withColumn("line", T.payload_line(F.col("id"), F.col("content")))
    ranked = lines.withColumn("_o", F.row_number().over(Window.partitionBy("chapter_id").orderBy("video_id", "ts_start", "id")))
    body = assembly.joined_texts(ranked, ["chapter_id"], "_o", "line", "\n")
    prompts = chapters.select("chapter_id", "title").join(body, "chapter_id", "left").withColumn("prompt", F.concat(F.lit("# "), "title", F.lit("\n\n"), F.coalesce("text", F.lit("")))).drop("text")
    drafted = providers.answers(prompts, "prompt", make, tries=tries, wait=wait).withColumn("draft", T.strip_markdown_fence(F.col("answer")))
    scope = assigned.select("chapter_id", "claim_id")
    rows = grounding.verify(grounding.sentences(drafted.where("draft IS NOT NULL"), "chapter_id", "draft"), scope, ["chapter_id", "index"], ["chapter_id"])
    judged = judge(rows) if judge else rows
    refs = judged.withColumn("cited_claim_ids", F.transform("cited_claim_ids", lambda x: F.concat(F.lit("c"), x.cast("string"))))
    final = grounding.demote(refs, scope, ["chapter_id", "index"], ["chapter_id"])
    first = grounding.summary(judged, ["chapter_id"])
    summaries = grounding.zero_filled(grounding.recounted(final, first, ["chapter_id"]), ["chapter_id"])
    return {"sentences": final, "summaries": summaries, "texts": grounding.stripped_text(final, ["chapter_id"]), "citations": claims.citation_rows(final)}


def figures(texts: DataFrame, store: DataFrame, assigned: DataFrame, vision: DataFrame, most: int = 3) -> DataFrame:
    """The figures that chapters (chapter_id, text) ask for, numbered from 1, each with the first `most` diagrams that the chapter's claims refer to."""
    own = claims.for_chapter(store, assigned).select("chapter_id", "id", "frame_ids")
    shown = assembly.diagrams_of_claims(own, vision, "chapter_id").where(F.col("pos") <= most)
    lists = shown.groupBy("chapter_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "frame_id"))), lambda x: x["frame_id"]).alias("frame_ids"))
    return assembly.figure_directives(texts, "chapter_id", "text").join(lists, "chapter_id", "left").withColumn("frame_ids", F.coalesce("frame_ids", F.array().cast("array<string>")))


#: What a model answers with for a figure.
DRAWING = "mode string, code string, caption string, rationale string"


def drawn_figures(asked: DataFrame, make: Model, images: int = 2, tries: int = 10, wait: Wait = providers.at_once) -> DataFrame:
    """Each figure of `figures` as a model draws it: chapter_id, number, mode, code, caption, rationale, artifact_path, images.

    A model gets the description, the diagrams that may help, and the first `images` of their frames. Code for mermaid or
    tikz has a file of its own; all else embeds the first frame, if there is one. An answer that is no JSON embeds it too,
    with the description as caption and parse_error as rationale.
    """
    listed = F.when(F.size("frame_ids") > 0, F.concat(F.lit("\n## Diagrams\n"), F.array_join("frame_ids", "\n"))).otherwise("")
    shown = F.slice("frame_ids", 1, images)
    prompts = asked.withColumn("prompt", F.concat(F.lit("## FIGURE\n"), "description", listed)).withColumn("images", shown)
    parsed = providers.parsed_json(providers.answers(prompts, "prompt", make, tries=tries, wait=wait), "answer", DRAWING)
    base = F.concat("chapter_id", F.lit("_fig"), F.lpad(F.col("number").cast("string"), 2, "0"))
    failed = F.coalesce("parse_error", F.lit(True))
    mode, code = F.when(failed, "embed").otherwise(F.col("parsed.mode")), F.when(~failed, F.col("parsed.code"))
    made = lambda kind: (mode == kind) & (F.coalesce(code, F.lit("")) != "")
    path = F.when(made("mermaid"), F.concat(F.lit("generated/"), base, F.lit(".mmd"))).when(made("tikz"), F.concat(F.lit("generated/"), base, F.lit(".tex"))).when(F.size("frame_ids") > 0, F.concat(F.lit("embedded/"), base, F.lit(".jpg")))
    return parsed.select("chapter_id", "number", mode.alias("mode"), code.alias("code"), F.when(failed, F.col("description")).otherwise(F.col("parsed.caption")).alias("caption"), F.when(failed, "parse_error").otherwise(F.col("parsed.rationale")).alias("rationale"), path.alias("artifact_path"), "images")


def polished(texts: DataFrame, payloads: DataFrame, make: Model, tries: int = 10, wait: Wait = providers.at_once) -> DataFrame:
    """Verified chapters (chapter_id, text) after a copy-editing model, which also gets the chapter's claims (payloads: chapter_id, text); a fence around its answer goes. A failed call keeps the verified text."""
    given = payloads.select("chapter_id", F.col("text").alias("_claims"))
    prompts = texts.join(given, "chapter_id", "left").withColumn("prompt", F.concat(F.coalesce("_claims", F.lit("")), F.lit("\n\n## Chapter to polish\n\n"), "text")).drop("_claims")
    out = providers.answers(prompts, "prompt", make, tries=tries, wait=wait)
    return out.withColumn("polished", F.coalesce(T.strip_markdown_fence(F.col("answer")), "text")).select("chapter_id", "text", "polished", "error")


def manuscript(parts: DataFrame, title: Column, author: Column, date: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """One text, or one for each value of by: a metadata block, then chapters and, after a mark, appendices (kind, pos, text: null where a part is missing) in order.

    The columns of by may stand in title, author and date. A manuscript is as long as its outline: its parts meet in one row.
    """
    ready = parts.where("text IS NOT NULL").withColumn("text", assembly.manuscript_part(F.col("text"))).withColumn("appendix", F.col("kind") == "appendix")
    number = F.row_number().over(Window.partitionBy(*by, "appendix").orderBy("pos"))
    marked = ready.withColumn("_n", number).withColumn("text", F.when(F.col("appendix") & (F.col("_n") == 1), F.concat(F.lit("\\appendix\n\n"), F.col("text"))).otherwise(F.col("text")))
    order = F.struct("appendix", "pos").alias("o")
    whole = marked.groupBy(*by).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, F.col("text").alias("t")))), lambda x: x["t"]), "\n\n").alias("body"))
    quoted = lambda c: F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    head = F.concat(F.lit("---\ntitle: "), quoted(title), F.lit("\nauthor: "), quoted(author), F.lit("\ndate: "), quoted(date), F.lit("\n---\n\n"))
    return whole.select(*by, F.concat(head, "body", F.lit("\n")).alias("text"))


def selected(store: DataFrame, topic: str, cap: int = 80) -> DataFrame:
    """The claims for a topic, in order."""
    return retrieval.select_claims(store, topic, cap).orderBy("place")
