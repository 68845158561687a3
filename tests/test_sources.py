"""Files, stores, providers, streams, assembly."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from attesta.operators import assembly as A
from attesta.operators import providers as P
from attesta.operators import reports as R
from attesta.sources import files, tables
from attesta.streaming import events as E


def test_json(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "a.json").write_text(json.dumps({"frame_id": "f1", "skip": False, "code": {"language": "py", "content": "x"}, "math": ["a"]}, indent=2))
    (tmp_path / "v" / "b.json").write_text("not json")
    got = files.json_documents(spark, str(tmp_path / "v"), files.VISION, with_file=True).orderBy("file").collect()
    assert got[0]["code"]["language"] == "py" and got[1]["frame_id"] is None
    log = tmp_path / "cost.jsonl"
    log.write_text('{"stage": "a", "model": "m", "usd": 1.5}\n\nbroken\n{"stage": "chapter:x", "model": "m", "usd": 0.5}\n')
    rows = files.json_lines(spark, str(log), files.COST)
    assert rows.agg(F.sum("usd")).first()[0] == 2.0
    assert R.chapter_spend(rows).first()["chapter"] == "x"
    try:
        files.json_lines(spark, str(log), files.COST, strict=True).collect()
    except Exception:
        pass
    else:
        raise AssertionError("a malformed line must raise")
    files.append_json_lines(rows, str(tmp_path / "out"))
    files.append_json_lines(rows, str(tmp_path / "out"))
    assert files.json_lines(spark, str(tmp_path / "out"), files.COST).count() == 4


def test_texts(spark, tmp_path):
    (tmp_path / "m.txt").write_text("frame:0 pts:12 pts_time:1.5\nlavfi.scene_score=0.4\nframe:1 pts_time=oops\nframe:2 pts_time=3\n")
    assert [r["pts_time"] for r in files.frame_times(spark, str(tmp_path / "m.txt")).collect()] == [1.5, 3.0]
    assert files.scene_scores(spark, str(tmp_path / "m.txt")).first()["scene_score"] == 0.4
    (tmp_path / "g.txt").write_text("# comment\n\nGPU  Adam\ngpu\n")
    assert [r["term"] for r in files.term_list(spark, str(tmp_path / "g.txt")).orderBy("pos").collect()] == ["GPU", "Adam", "gpu"]
    (tmp_path / "ids.txt").write_text(" a \n\nb\n")
    assert [r["id"] for r in files.id_list(spark, str(tmp_path / "ids.txt")).collect()] == ["a", "b"]


def test_store_tables(spark):
    tables.create_store(spark, "evidence", buckets=2)
    tables.create_store(spark, "evidence", buckets=2)
    assert {r["tableName"] for r in spark.sql("SHOW TABLES IN evidence").collect()} == set(tables.STORE)
    spark.sql("DROP DATABASE evidence CASCADE")


def test_providers(spark):
    rows = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "json")], "id int, prompt string")

    def make():
        def call(prompt):
            if prompt == "bad":
                raise ValueError("no")
            return '```json\n{"a": 1}\n```' if prompt == "json" else prompt.upper()

        return call

    got = P.answers(rows, "prompt", make, tries=2, wait=lambda n: 0.0)
    out = {r["id"]: (r["answer"], r["error"]) for r in got.collect()}
    assert out[1] == ("GOOD", None) and out[2] == (None, "ValueError: no")
    parsed = {r["id"]: (r["parsed"], r["parse_error"], r["raw_text"]) for r in P.parsed_json(got.where("answer IS NOT NULL"), "answer", "a int").collect()}
    assert parsed[3][0]["a"] == 1 and parsed[1] == (None, True, "GOOD")
    assert P.embedded(rows, "prompt", None).first()["embedding"] is None
    assert P.embedded(rows, "prompt", lambda: lambda ts: [[1.0, 0.0] for _ in ts]).first()["embedding"] == [1.0, 0.0]


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"2024-01-0{1 + i // 3} 0{i}:00:00", f"u{i % 2}", "click", float(i)) for i in range(9)], "event_id int, t string, user_id string, event_type string, value double")
    rows = rows.withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    rows.write.parquet(str(tmp_path / "in"))
    stream = E.read(spark, str(tmp_path / "in"), rows.schema)
    q = E.tumbling(E.stamped(stream)).writeStream.format("memory").queryName("daily").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = E.tumbling(E.stamped(rows))
    assert sorted(map(tuple, spark.table("daily").collect())) == sorted(map(tuple, batch.collect()))
    E.run_available(E.distinct(E.stamped(stream), ["event_id"]), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9
    E.run_available(E.distinct(E.stamped(stream), ["event_id"]), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9


def test_assembly(spark):
    refs = spark.createDataFrame([("a", "T", "A", 2017, "1706.03762", None), ("b", "U", None, 2000, None, "n")], "id string, title string, author string, year int, arxiv string, note string")
    text = A.bibliography(refs).first()["text"]
    assert text.startswith("@article{a,\n  title = {T}") and "@book{b,\n  title = {U},\n  year = {2000},\n  note = {n}\n}" in text
    seg = "struct<ts_start:double,ts_end:double,text:string,visuals:array<struct<frame_id:string,category:string,title:string,extracted_text:string,code:struct<language:string,content:string>,math:array<string>,diagram_summary:string,diagram_elements:array<string>>>>"
    rows = spark.createDataFrame([("v", 0.0, 2.25, None, [(0.0, 2.25, "hi", [("f", "code", None, "abc", ("py", "x\ny"), ["m"], "d", ["p", "q"])])])], f"video_id string, ts_start double, ts_end double, title string, segments array<{seg}>")
    lines = A.segment_payload(rows).first()["payload"].split("\n")
    assert lines == ["# Segment from video v", "# ts: 0.0 - 2.2", "# title (if any): ", "", "## Aligned transcript + visuals", "[0.0-2.2] hi", "  FRAME f (code):", "    text: abc", "    code (py):", "      x", "      y", "    math: m", "    diagram: d", "    elements: p, q"]
    docs = spark.createDataFrame([("c", "x [FIGURE: one] y [FIGURE:two] z [FIGURE: three]")], "id string, md string")
    made = spark.createDataFrame([("c", 5, "b.png"), ("c", 2, "a.png")], "id string, index int, path string")
    got = A.directives_with_figures(A.figure_directives(docs, "id", "md"), made, "id").orderBy("number").collect()
    assert [(r["description"], r["path"]) for r in got] == [("one", "a.png"), ("two", "b.png"), ("three", None)]
    assert spark.range(1).select(A.outline_chapters(F.array(F.lit("a")), F.lit(None).cast("array<string>")).alias("x")).first()["x"] == ["a"]


def test_html_and_costs(spark):
    assert R.html_table(["a"], spark.createDataFrame([("<b>",)], "a string")).first()["html"] == "<tr><td>&lt;b&gt;</td></tr>"
    usage = spark.createDataFrame([("s", "m", 1_000_000, 0, 0, 0), ("s", "unknown", 5, 5, 5, 5)], "stage string, model string, input_tokens long, output_tokens long, cache_write_tokens long, cache_read_tokens long")
    prices = spark.createDataFrame([("m", 3.0, 15.0, 3.75, 0.3)], "model string, input double, output double, cache_write double, cache_read double")
    assert R.with_cost(usage, prices).agg(F.sum("usd")).first()[0] == 3.0
    assert R.percentages(spark.createDataFrame([], "status string")).first()["grounded_pct"] == 0.0
