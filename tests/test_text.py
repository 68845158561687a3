"""Citations, typed sentences, removal, verification rules, formatting."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import grounding as G


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "ids"), [("foo [c12] bar", [12]), ("foo [c12, c47] bar [c3]", [12, 47, 3]), ("foo [C12]", [12]), ("plain", []), ("[c1,2] [c1]", [1, 2, 1])])
def test_citations(spark, text, ids):
    assert one(spark, text, T.citations) == ids


def typed(spark, md):
    rows = G.sentences(spark.createDataFrame([(1, md)], "id int, md string"), "id", "md").orderBy("index").collect()
    return [(r["index"], r["type"], r["text"], r["cited_claim_ids"]) for r in rows]


def test_heading_and_sentences(spark):
    got = typed(spark, "# Title\n\nFirst fact [c1]. Second fact [c2].")
    assert [(k, c) for _, k, _, c in got] == [("narrative", []), ("factual", [1]), ("factual", [2])]


def test_code_math_figure(spark):
    got = typed(spark, "A was here [c1].\n\n```python\n\nx = 1\ny = 2\n```\nB was here [c2].")
    assert [(k, t) for _, k, t, _ in got] == [("factual", "A was here [c1]."), ("code_block", "x = 1"), ("factual", "B was here [c2].")]
    got = typed(spark, "One [c1].\n\n$$a = b\n+ c$$\n\nTwo [c2].")
    assert [k for _, k, _, _ in got] == ["factual", "equation", "factual"]
    got = typed(spark, "One [c1].\n\n[FIGURE: a tree]\n\nTwo [c2].")
    assert [k for _, k, _, _ in got] == ["factual", "figure_directive", "factual"]
    got = typed(spark, "```\na\n```\n```\nb\n```\n```\nopen [c3]. End.")
    assert [(k, t) for _, k, t, _ in got] == [("code_block", "a"), ("code_block", "b"), ("code_block", "open [c3]. End.")]
    assert [i for i, *_ in got] == [0, 1, 2]


def test_types(spark):
    got = typed(spark, "Let us begin. Attention is old. It took 7 days. See GPU. Nothing more. [GAP: missing] so far. Été ÉAB rien.")
    assert [k for _, k, _, _ in got] == ["narrative", "factual", "factual", "factual", "narrative", "factual"]


def test_empty(spark):
    assert typed(spark, "") == [] and typed(spark, "\n\n \n") == []
    assert G.sentences(spark.createDataFrame([(1, None)], "id int, md string"), "id", "md").count() == 0


@pytest.mark.parametrize(("kind", "cited", "available", "status"), [("factual", [1], [1, 2], "grounded"), ("factual", [], [1], "unsupported"), ("factual", [99], [1, 2], "unsupported"), ("narrative", [], [], "narrative_ok"), ("figure_directive", [], [], "narrative_ok"), ("code_block", [], [1], "unsupported")])
def test_rule(spark, kind, cited, available, status):
    rows = spark.createDataFrame([(0, "x", kind, cited, available)], "index int, text string, type string, cited_claim_ids array<int>, available array<int>")
    got = G.verify_with_list(rows).first()
    assert got["status"] == status
    claims = spark.createDataFrame([(a,) for a in available], "claim_id int")
    assert G.verify(rows.withColumn("d", F.lit(1)), claims, ["d", "index"], []).first()[["status", "reason"][0]] == status
    if cited == [99]:
        assert got["reason"] == "cited claims not in chapter: [99]"


def test_demotion(spark):
    schema = "ch string, index int, cited_claim_ids array<string>, status string, reason string"
    rows = [("a", 0, ["c1"], "grounded", "ok"), ("a", 1, ["c99999", "c1"], "grounded", "ok"), ("a", 2, ["cx"], "grounded", ""), ("a", 3, [], "grounded", "ok"), ("a", 4, ["c5"], "unsupported", "no"), ("b", 0, ["c1"], "grounded", None)]
    claims = spark.createDataFrame([("a", 1)], "ch string, claim_id long")
    got = {(r["ch"], r["index"]): (r["status"], r["reason"]) for r in G.demote(spark.createDataFrame(rows, schema), claims, ["ch", "index"], ["ch"]).collect()}
    assert got[("a", 0)] == ("grounded", "ok") and got[("a", 3)] == ("grounded", "ok") and got[("a", 4)] == ("unsupported", "no")
    assert got[("a", 1)] == ("unsupported", "ok | cited claim ids not in chapter: [99999]")
    assert got[("a", 2)] == ("unsupported", "cited refs unparseable")
    assert got[("b", 0)] == ("unsupported", "cited claim ids not in chapter: [1]")


def test_strip(spark):
    docs = spark.createDataFrame([(1, "A is [c1]. B is so.  C is [c2]. B is so.", ["B is so.", "B is so."]), (2, "x  y. z", ["x y."]), (3, None, ["a"]), (4, "keep", None)], "id int, md string, bad array<string>")
    got = {r["id"]: r["verified"] for r in G.strip_in_place(docs, "md", "bad").collect()}
    assert got == {1: "A is [c1].   C is [c2]. ", 2: " z", 3: None, 4: "keep"}
    assert one(spark, got[1] + "\n\n\n\nend", T.tidy) == "A is [c1]. C is [c2]. \n\nend\n"


def test_summaries(spark):
    v = spark.createDataFrame([("a", "grounded"), ("a", None)], "ch string, status string")
    assert {(r["status"], r["n"]) for r in G.summary(v, ["ch"]).collect()} == {("grounded", 1), ("unknown", 1)}
    filled = G.zero_filled(G.summary(v.where("status IS NOT NULL"), ["ch"]), ["ch"])
    assert {r["status"]: r["n"] for r in filled.collect()} == {"grounded": 1, "unsupported": 0, "contradicted": 0, "needs_external_check": 0, "narrative_ok": 0}
    rebuilt = spark.createDataFrame([("a", 0, "One.", "grounded"), ("a", 1, "Two.", "unsupported"), ("a", 2, "Three.", "narrative_ok")], "ch string, index int, text string, status string")
    r = G.stripped_text(rebuilt, ["ch"]).first()
    assert r["text"] == "One. Three.\n" and r["stripped_sentence_indices"] == [1]


def test_headings(spark):
    assert one(spark, "## T\n\n### 12.1 A\ntext\n#### B\n", T.normalise_headings) == "# T\n\n## A\ntext\n### B\n"
    assert one(spark, "## T\n## U\n### A\n", T.normalise_headings) == "# T\n## U\n### A\n"
    assert one(spark, "# T\n## U\n### A\n", T.normalise_headings) == "# T\n## U\n## A\n"
    code = "## T\n```\n### not a heading\n## nor this\n```\n### A\n"
    assert one(spark, code, T.normalise_headings) == "# T\n```\n### not a heading\n## nor this\n```\n## A\n"


def test_fences_and_markers(spark):
    assert one(spark, '```json\n{"a": 1}\n```', T.strip_json_fence) == '{"a": 1}'
    assert one(spark, "```markdown\n# T\n```", T.strip_markdown_fence) == "# T"
    assert one(spark, "```python\nx\n```", T.strip_markdown_fence) == "```python\nx\n```"
    assert one(spark, "a [c1] b [c2, @c3].", T.drop_citations) == "a b."
    assert one(spark, "see [FIGURE: a tree] and [FIGURE:b]", T.figures) == ["a tree", "b"]
    assert one(spark, "[GAP: x] y", T.gaps) == ["[GAP: x]"]


def test_formats(spark):
    assert one(spark, "x", lambda c: T.whole(F.lit(2.5))) == "2"
    assert one(spark, "a\\b_{x}", T.latex_escape) == "a\\textbackslash\\{\\}b\\_\\{x\\}"
    assert one(spark, "vid_f0001", T.video_of_frame) == "vid" and one(spark, "a_b_12", T.video_of_frame) == "a_b"
    assert one(spark, "chapter:a:b", lambda c: T.stage_parts(c)[1]) == "a:b"
    assert one(spark, "l" * 300, T.shorten) == "l" * 197 + "..."
    r = spark.range(1).select(T.video_line(F.lit("v"), F.lit("t"), F.lit(None).cast("double")).alias("x")).first()
    assert r["x"] == "- v: t (0 min)"
