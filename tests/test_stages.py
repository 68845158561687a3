"""The stages with fake models."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from attesta.operators import stages as S

CLAIM_STORE = "id bigint, type string, content string, video_id string, ts_start double, ts_end double, frame_ids array<string>, confidence double, source_hash string, extra map<string,string>"


def test_budget_before_the_call(spark):
    rows = spark.createDataFrame([(i, "x" * 3500) for i in range(5)], "id int, prompt string")
    log = spark.createDataFrame([("draft", 1.0)], "stage string, usd double")
    asked, used = S.ask_within_budget(rows, "prompt", lambda: lambda p: str(len(p)), log, "claims", 1000.0, 4.0)
    got = {r["id"]: (r["answer"], r["error"]) for r in asked.collect()}
    assert [got[i][0] for i in range(5)] == ["3500", "3500", "3500", None, None] and got[4][1] == "budget exceeded"
    assert used.agg(F.sum("usd")).first()[0] == 4.0


def test_frames_described(spark):
    def make():
        def call(p):
            if p == "fails":
                raise OSError("no answer")
            return {"good": '```json\n{"category": "slide", "title": "T"}\n```', "skip": '{"category": "face", "skip": true}'}.get(p, "no json")

        return call

    frames = spark.createDataFrame([(n, "v", 1.0, n) for n in ("good", "skip", "bad", "fails", "done")], "frame_id string, video_id string, timestamp_sec double, prompt string")
    got = {r["frame_id"]: r for r in S.describe_frames(frames, frames.where("frame_id = 'done'"), make, tries=2).collect()}
    assert set(got) == {"good", "skip", "bad"}  # a failed call leaves no row
    assert not got["good"]["skip"] and got["good"]["title"] == "T" and got["skip"]["skip"]
    assert got["bad"]["skip"] and got["bad"]["parse_error"] and got["bad"]["raw_text"] == "no json"


def test_segments(spark):
    chapters = "array<struct<start_time:double,end_time:double,title:string>>"
    videos = spark.createDataFrame([("a", 100.0, [(0.0, 40.0, "One"), (40.0, 50.0, "None"), (50.0, None, "Two")]), ("b", 100.0, []), ("c", 100.0, None), ("d", 5.0, [])], f"video_id string, duration double, chapters {chapters}")
    rows = [("a", i, 10.0 * i, 10.0 * i + 9, "said here") for i in (0, 1, 3, 4, 6, 9) if i != 4]
    rows += [("b", i, 30.0 * i, 30.0 * i + 30, ("cats " if i < 4 else "dogs ") * 150) for i in range(8)] + [("c", 0, 0.0, 5.0, "all there is")]
    segments = spark.createDataFrame(rows, "video_id string, segment_id int, ts_start double, ts_end double, text string")
    embed = lambda: lambda texts: [[1.0, 0.0] if "cats" in t else [0.0, 1.0] for t in texts]
    got = {r["topic_id"]: (r["title"], r["ts_start"], r["ts_end"], r["segment_ids"]) for r in S.segment(videos, segments, embed).collect()}
    assert got == {"a_000": ("One", 0.0, 39.0, [0, 1, 3]), "a_001": ("Two", 60.0, 99.0, [6, 9]), "b_000": ("", 0.0, 120.0, [0, 1, 2, 3]), "b_001": ("", 120.0, 240.0, [4, 5, 6, 7]), "c_000": ("", 0.0, 5.0, [0])}


def test_claims_extracted(spark):
    found = [{"type": "code", "content": " f(1 ", "language": "c"}, {"content": "b", "confidence": 0.5}, {"content": "a", "ts_start": 3.0}]
    topics = spark.createDataFrame([("v1", 0.0, 9.0, "t", []), ("v2", 0.0, 9.0, "t", []), ("old", 0.0, 9.0, "t", [])], "video_id string, ts_start double, ts_end double, title string, segments array<struct<ts_start:double,ts_end:double,text:string,visuals:array<struct<frame_id:string,category:string,title:string,extracted_text:string,code:struct<language:string,content:string>,math:array<string>,diagram_summary:string,diagram_elements:array<string>>>>>")
    store = spark.createDataFrame([(7, "fact", "x", "old", 0.0, 1.0, [], 1.0, "h", None)], CLAIM_STORE)
    make = lambda: lambda p: json.dumps(found) if "video v1" in p else '{"not": "a list"}'
    got = S.extract_claims(topics, store, make).orderBy("id").collect()
    assert [(r["id"], r["video_id"], r["type"], r["content"], r["ts_start"], r["ts_end"]) for r in got] == [(7, "old", "fact", "x", 0.0, 1.0), (8, "v1", "code", "f(1", 0.0, 9.0), (9, "v1", "fact", "a", 3.0, 9.0)]
    assert json.loads(got[1]["extra"]["code_check"]) == {"parseable": False, "language": "generic", "reason": "Unclosed: [')']"}
    assert got[2]["extra"] is None


def test_outline_and_chapters(spark):
    rows = [(1, "fact", "Old.", "a", 0.0, [1.0, 0.0]), (2, "fact", "New.", "b", 0.0, [1.0, 0.0]), (3, "fact", "Other.", "b", 1.0, [0.0, 1.0])]
    store = spark.createDataFrame(rows, "id bigint, type string, content string, video_id string, ts_start double, embedding array<double>")
    ranks = spark.createDataFrame([("a", 0), ("b", 1)], "video_id string, rank int")
    none = spark.createDataFrame([], "chapter_id string, claim_id bigint")
    seen = lambda p: json.dumps({"chapters": [{"id": "one", "title": "One", "claim_ids": [1, 2, 3]}], "appendices": [{"id": "app", "title": "More", "claim_ids": [3]}]}) if "c2 [" in p and "c1 [" not in p else "no"
    chapters, assigned, _ = S.outline(store, ranks, none, lambda: seen)
    assert [(r["chapter_id"], r["claim_ids"]) for r in chapters.orderBy("pos").collect()] == [("one", [2, 3]), ("app", [3])]
    assert sorted((r["chapter_id"], r["claim_id"]) for r in assigned.collect()) == [("app", 3), ("one", 2), ("one", 3)]

    def write():
        return lambda p: "# One\n\nIt is new [c2]. It is odd [c1]. It is bare. So it goes.\n" if p.startswith("# One") and "[c2] New." in p else "```markdown\n# More\n\nIt is other [c3].\n```"

    out = S.draft_chapters(chapters, store, assigned, write)
    got = {(r["chapter_id"], r["index"]): (r["status"], r["demoted"]) for r in out["sentences"].collect()}
    assert [got["one", i] for i in range(5)] == [("narrative_ok", False), ("grounded", False), ("unsupported", False), ("unsupported", False), ("narrative_ok", False)]
    assert {r["chapter_id"]: r["text"] for r in out["texts"].collect()} == {"one": "# One It is new [c2]. So it goes.\n", "app": "# More It is other [c3].\n"}
    assert {(r["chapter_id"], r["status"]): r["n"] for r in out["summaries"].collect() if r["n"]} == {("one", "grounded"): 1, ("one", "unsupported"): 2, ("one", "narrative_ok"): 2, ("app", "grounded"): 1, ("app", "narrative_ok"): 1}
    assert out["summaries"].count() == 10 and out["citations"].where("claim_id = 2").count() == 1
    # a judge that calls everything grounded: what cites no claim of the chapter is demoted, and the summary is counted anew
    judged = S.draft_chapters(chapters, store, assigned, write, judge=lambda d: d.withColumn("status", F.lit("grounded")))
    assert {(r["index"], r["status"]) for r in judged["sentences"].where("demoted").collect()} == {(2, "unsupported")}
    assert {r["n"] for r in judged["summaries"].where("chapter_id = 'one' AND status = 'unsupported'").collect()} == {1}


def test_figures_and_manuscript(spark):
    texts = spark.createDataFrame([("one", "a [FIGURE: plot] b [FIGURE:  tree ]"), ("two", "none")], "chapter_id string, text string")
    store = spark.createDataFrame([(1, "v", 0.0, ["v_f2", "v_f1"]), (2, "v", 1.0, ["v_f1", "v_f3"])], "id bigint, video_id string, ts_start double, frame_ids array<string>")
    assigned = spark.createDataFrame([("one", 1), ("one", 2)], "chapter_id string, claim_id bigint")
    vision = spark.createDataFrame([("v_f1", "slide", "A"), ("v_f2", "face", "B"), ("v_f3", "diagram", "C")], "frame_id string, category string, title string")
    got = [(r["number"], r["description"].strip(), r["frame_ids"]) for r in S.figures(texts, store, assigned, vision).orderBy("number").collect()]
    assert got == [(1, "plot", ["v_f1", "v_f3"]), (2, "tree", ["v_f1", "v_f3"])]
    parts = spark.createDataFrame([("chapter", 2, "# Two [c1]"), ("chapter", 1, "# One"), ("chapter", 3, None), ("appendix", 1, "# App")], "kind string, pos int, text string")
    book = S.manuscript(parts, F.lit('A "book"'), F.lit("me"), F.lit("May 2024")).first()["text"]
    assert book == '---\ntitle: "A \\"book\\""\nauthor: "me"\ndate: "May 2024"\n---\n\n# One\n\n# Two\n\n\\appendix\n\n# App\n'
