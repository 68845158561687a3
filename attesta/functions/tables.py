"""Table functions: what a text or a table of texts holds, as rows, also from SQL."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from attesta.functions.text import FACT_VERBS

# The patterns of functions.text as Python writes them; white space and word characters are those of Java there.
_BLANK = " \t\n\x0b\f\r"
_FENCE = re.compile(r"^[ \t]*```(?s:.*?)(?:^[ \t]*```[^\n]*$|\Z)", re.M)
_MATH = re.compile(r"\$\$[^$]+\$\$")
_END = re.compile(r"(?<=[.!?])[ \t\n\r\f]+(?=[A-Z\[`])")
_PARAGRAPH = re.compile(rf"\n[{_BLANK}]*\n")
_CITATION = re.compile(r"\[[cC]([0-9]+(?:[ \t\n\r\f]*,[ \t\n\r\f]*[cC]?[0-9]+)*)\]")
_FIGURE, _GAP = re.compile(r"\[FIGURE:[^\]]+\]"), re.compile(r"\[GAP:[^\]]+\]")
_TOKEN = re.compile(r"\b(?:\d+(?:\.\d+)?|[A-Z]{2,})\b")
_VERB = re.compile(rf" (?:{'|'.join(FACT_VERBS)}) ")


def sentences_of(text: str) -> Iterator[tuple[str, str]]:
    """type and text of the code blocks, block equations and sentences of a Markdown text, in order."""
    at = 0
    for m in _FENCE.finditer(text):
        yield from _prose(text[at : m.start()])
        lines = [x for x in m[0].split("\n")[1:] if x.strip(" ")]
        yield "code_block", (lines[0] if lines else m[0][:80]).strip(_BLANK)
        at = m.end()
    yield from _prose(text[at:])


def _prose(text: str) -> Iterator[tuple[str, str]]:
    at = 0
    for m in _MATH.finditer(text):
        yield from _paragraphs(text[at : m.start()])
        yield "equation", m[0].strip(_BLANK)
        at = m.end()
    yield from _paragraphs(text[at:])


def _paragraphs(text: str) -> Iterator[tuple[str, str]]:
    for p in filter(None, (x.strip(_BLANK) for x in _PARAGRAPH.split(text))):
        if p.startswith("#"):
            yield "narrative", p
        elif len(p) < 200 and len(_FIGURE.findall(p)) == 1:
            yield "figure_directive", p
        else:
            for s in filter(None, (x.strip(_BLANK) for x in _END.split(p))):
                fact = _TOKEN.search(s) or _VERB.search(f" {s.lower()} ") or _CITATION.search(s) or _GAP.search(s)
                yield "factual" if fact else "narrative", s


def cited(text: str) -> list[int]:
    numbers = [int(re.sub("[^0-9]", "", p)) for g in _CITATION.findall(text) for p in g.split(",")]
    return [n if n < 2**31 else None for n in numbers]


@udtf(returnType="index int, type string, text string, cited_claim_ids array<int>")
class TextSentences:
    """The sentences of one text: `SELECT d.doc_id, s.* FROM documents d, LATERAL text_sentences(d.text) s`."""

    def eval(self, text: str):
        if text is not None:
            for i, (kind, s) in enumerate(sentences_of(text)):
                yield i, kind, s, cited(s) if kind in ("factual", "narrative") and not s.startswith("#") else []


@udtf
class PartSentences:
    """The sentences of texts that come in parts, numbered through each text: `SELECT * FROM part_sentences(TABLE(parts) PARTITION BY doc_id ORDER BY part)`.

    The table has a key (first column, by which it is partitioned), the place of the part, and its text. A part is
    worked off when it comes; only the next number is kept.
    """

    def __init__(self) -> None:
        self.next = 0

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        key = rows.dataType.fields[0]
        return AnalyzeResult(StructType([StructField(key.name, key.dataType), StructField("index", IntegerType()), StructField("type", StringType()), StructField("text", StringType())]))

    def eval(self, rows: Row):
        key, _, text = rows
        for kind, s in sentences_of(text or ""):
            yield key, self.next, kind, s
            self.next += 1


def register(spark: SparkSession) -> None:
    spark.udtf.register("text_sentences", TextSentences)
    spark.udtf.register("part_sentences", PartSentences)
