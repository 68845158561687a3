"""Files: JSON documents, JSON lines, side-car texts, lists, and sinks for them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the JSON documents.
FRAME = "frame_id string, video_id string, timestamp_sec double, path string, phash string, edge_density double, sha256 string"
VISION = "category string, skip boolean, title string, extracted_text string, code struct<language:string,content:string>, math array<string>, diagram_summary string, diagram_elements array<string>, confidence double, frame_id string, video_id string, timestamp_sec double, source_image string, raw_text string, _parse_error boolean"
AUDIT = "chapter_id string, title string, summary map<string,int>, stripped_sentence_indices array<int>"
VERIFY = "chapter_id string, sentences array<struct<index:int,text:string,type:string,cited_claim_ids:array<string>,status:string,reason:string>>, summary map<string,int>"
COST = "stage string, model string, input_tokens bigint, output_tokens bigint, cache_write_tokens bigint, cache_read_tokens bigint, usd double, timestamp double"
MANIFEST = "video_id string, title string, duration_sec double, uploader string, upload_date string, chapters array<struct<start_time:double,end_time:double,title:string>>, audio_path string, audio_sha256 string"
OUTLINE = "chapters array<struct<id:string,number:int,title:string,summary:string,estimated_pages:int,claim_ids:array<bigint>,source_videos:array<string>,depends_on_chapters:array<string>>>, appendices array<struct<id:string,number:int,title:string,summary:string,estimated_pages:int,claim_ids:array<bigint>,source_videos:array<string>,depends_on_chapters:array<string>>>"


def json_documents(spark: SparkSession, path: str, schema: str, with_file: bool = False) -> DataFrame:
    """One document per file (or an array of rows); unreadable files give null rows. with_file adds the file's name, to order by."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df.withColumn("file", F.col("_metadata.file_name")) if with_file else df


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """One row per line. Blank lines are skipped; malformed ones too, unless strict: then they raise."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).text(path)


def frame_times(spark: SparkSession, path: str) -> DataFrame:
    """file, pts_time from side-car texts of key=value or key:value pairs; values that are no number are left out."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    time = F.regexp_extract("value", r"pts_time[=:]\s*([^\s]+)", 1).try_cast("double")
    return lines.select("file", time.alias("pts_time")).where("pts_time IS NOT NULL")


def scene_scores(spark: SparkSession, path: str) -> DataFrame:
    """file, scene_score from side-car texts."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    return lines.select("file", F.regexp_extract("value", r"scene_score=([0-9.eE+-]+)", 1).try_cast("double").alias("scene_score")).where("scene_score IS NOT NULL")


def term_list(spark: SparkSession, path: str) -> DataFrame:
    """pos, term of a glossary: words of the lines that are neither blank nor comments. The file is read whole, in order."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line", "value"))
    own = lines.where((F.trim("value") != "") & ~F.ltrim(F.col("value")).startswith("#"))
    return own.select("line", F.posexplode(F.split(F.trim("value"), r"\s+")).alias("p", "term")).select((F.shiftleft(F.col("line").cast("long"), 32) + F.col("p")).alias("pos"), "term")


def vision_rows(spark: SparkSession, path: str) -> DataFrame:
    """The descriptions of frames that are not to be skipped; a folder that is not there has none."""
    from pyspark.errors import AnalysisException

    try:
        found = json_documents(spark, path, VISION)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], VISION)
    return found.where(F.col("frame_id").isNotNull() & ~F.coalesce("skip", F.lit(False)))


def frame_indexes(spark: SparkSession, folders: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Frames of the folders (video_id) that have an index file, and the folders that have none: to warn about, and to leave out."""
    frames = json_documents(spark, f"{path}/*/index.json", FRAME).where("frame_id IS NOT NULL")
    return frames.join(folders, "video_id", "left_semi"), folders.join(frames.select("video_id"), "video_id", "left_anti")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """file, sha256 of the bytes of every file."""
    return spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("file"), F.sha2("content", 256).alias("sha256"))


def with_environment(rows: DataFrame, overrides: dict[str, str]) -> DataFrame:
    """Settings (name, value and further columns) where those of overrides (from the environment: upper-case names) take their place."""
    own = [(k.lower(), v) for k, v in overrides.items()]
    given = rows.sparkSession.createDataFrame(own, "name string, _v string")  # as few as a configuration has
    return rows.join(F.broadcast(given), F.lower(rows["name"]) == given["name"], "left").select(*[rows[c] for c in rows.columns if c != "value"], F.coalesce("_v", "value").alias("value"))


def _plain(value: str) -> str:
    """A scalar as text: without its comment, and without the quotes around it, whose escapes are resolved."""
    value = value.strip()
    if value[:1] == '"':
        end = re.match(r'"((?:[^"\\]|\\.)*)"', value)
        return re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), end[1]) if end else value
    if value[:1] == "'":
        end = re.match(r"'((?:[^']|'')*)'", value)
        return end[1].replace("''", "'") if end else value
    return re.split(r"(?:^|\s)#", value, maxsplit=1)[0].rstrip()


def settings_pairs(text: str) -> Iterator[tuple[str, str]]:
    """name (dotted path, places in lists counted from 0) and value of every scalar of a YAML text of nested mappings and lists.

    One walk over the lines with the stack of the blocks that are open: each has its indent and its name. Tabs, flow
    collections, anchors and texts over several lines are beyond it: their text is the value.
    """
    stack: list[list] = []  # indent, name, items so far
    for line in text.split("\n"):
        body = line.lstrip(" ")
        indent = len(line) - len(body)
        if not body.strip() or body.startswith("#") or body.rstrip() in ("---", "..."):
            continue
        while stack and (stack[-1][0] > indent or stack[-1][0] == indent and not (body.startswith(("- ", "-\n")) or body.rstrip() == "-")):
            stack.pop()
        while body.startswith("- ") or body.rstrip() == "-":
            # an item belongs to the key above it, also where it is not indented
            while stack and stack[-1][0] > indent or stack and stack[-1][0] == indent and stack[-1][2] is None and stack[-1][1].isdigit():
                stack.pop()
            owner = stack[-1] if stack else None
            number = 0 if owner is None else owner[2] or 0
            if owner is not None:
                owner[2] = number + 1
            rest = body[1:].lstrip(" ")
            stack.append([indent, str(number), None])
            indent += len(body) - len(rest)
            body = rest
        if not body.strip():
            continue
        key = re.match(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s#"'][^#]*?)\s*:(?:\s|$)""", body)
        path = [name for _, name, _ in stack]
        if key is None:
            yield ".".join(path), _plain(body)
            continue
        value = body[key.end() :]
        name = _plain(key[1])
        if value.strip() and not value.lstrip().startswith("#"):
            yield ".".join([*path, name]), _plain(value)
        else:
            stack.append([indent, name, None])


def yaml_settings(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """name, value (text) of YAML files, each read as a whole: configurations are small. with_file adds the file's name."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(f, n, v) for f, text in zip(b["file"], b["value"]) for n, v in settings_pairs(text)]
            yield pd.DataFrame(rows, columns=["file", "name", "value"])

    found = whole.mapInPandas(run, "file string, name string, value string")
    return found if with_file else found.drop("file")


def id_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''")


def manifest(listed: DataFrame, audio: DataFrame, info: DataFrame) -> DataFrame:
    """Videos whose two files both exist, with the facts of the second."""
    return listed.join(audio.select("video_id"), "video_id", "left_semi").join(info, "video_id")


def settings(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A configuration list (prices, references) as a table; small by nature."""
    return spark.createDataFrame(rows, schema)
