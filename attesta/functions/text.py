"""Text functions as Column expressions: they stay in the JVM and inside code generation where Spark allows it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a marker or a signal in prose.
CITATION = r"\[[cC]([0-9]+(?:[ \t\n\r\f]*,[ \t\n\r\f]*[cC]?[0-9]+)*)\]"
GAP = r"\[GAP:[^\]]+\]"
FIGURE = r"\[FIGURE:[^\]]+\]"
FIGURE_TEXT = r"\[FIGURE:\s*([^\]]+)\]"
MATH = r"\$\$[^$]+\$\$"
SENTENCE_END = r"(?<=[.!?])[ \t\n\r\f]+(?=[A-Z\[`])"
FACT_TOKEN = r"(?U)\b(\d+(\.\d+)?|[A-Z]{2,})\b"
FACT_VERBS = ("is", "are", "was", "were", "uses", "has", "have", "contains", "requires", "produces", "equals", "computes", "applies", "defines")
LATEX = (("\\", "\\textbackslash{}"), ("&", "\\&"), ("%", "\\%"), ("$", "\\$"), ("#", "\\#"), ("_", "\\_"), ("^", "\\^{}"), ("~", "\\textasciitilde{}"), ("{", "\\{"), ("}", "\\}"))
HTML = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))

_MARK = "\u0001"
#: How the mark is written where a text has it itself, and how what begins that is.
_ESCAPES = (("\u0002", "\u0002\u0004"), (_MARK, "\u0002\u0003"))


def escaped(c: Column) -> Column:
    return replace_all(c, _ESCAPES)


def unescaped(c: Column) -> Column:
    return replace_all(c, tuple((new, old) for old, new in reversed(_ESCAPES)))


def _has_mark(c: Column) -> Column:
    return c.contains(_MARK) | c.contains("\u0002")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def citations(c: Column) -> Column:
    """All cited claim ids in order, repeats included."""
    groups = F.regexp_extract_all(c, F.lit(CITATION), F.lit(1))
    parts = F.flatten(F.transform(groups, lambda g: F.split(g, ",")))
    found = F.transform(parts, lambda p: F.regexp_replace(p, r"[^0-9]", "").try_cast("int"))
    return F.when(c.contains("["), found).when(c.isNotNull(), F.array().cast("array<int>"))


def gaps(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(GAP), F.lit(0))


def figures(c: Column) -> Column:
    """The descriptions of all figure directives in order."""
    return F.regexp_extract_all(c, F.lit(FIGURE_TEXT), F.lit(1))


def block_math(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(MATH), F.lit(0))


def paragraphs(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"\n\s*\n"), strip), lambda p: p != "")


def sentence_texts(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, SENTENCE_END), strip), lambda s: s != "")


def has_fact(c: Column) -> Column:
    """Whether a sentence seems to assert a fact: a number, an upper-case token, or one of the verbs."""
    lower = F.concat(F.lit(" "), F.lower(c), F.lit(" "))
    return c.rlike(FACT_TOKEN) | lower.rlike(f" (?:{'|'.join(FACT_VERBS)}) ")


def _typed(kind: str | Column, text: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("type"), text.alias("text"))


def _of_paragraph(p: Column, plain: Callable[[Column], Column]) -> Column:
    directive = p.contains("[FIGURE:") & (F.size(F.regexp_extract_all(p, F.lit(FIGURE), F.lit(0))) == 1) & (F.length(plain(p)) < 200)
    marked = lambda s: s.contains("[") & (s.rlike(CITATION) | s.rlike(GAP))
    kind = lambda s: F.when(has_fact(s) | marked(s), "factual").otherwise("narrative")
    return F.when(p.startswith("#"), F.array(_typed("narrative", p))).when(directive, F.array(_typed("figure_directive", p))).otherwise(F.transform(sentence_texts(p), lambda s: _typed(kind(s), s)))


def typed_sentences(c: Column) -> Column:
    """Markdown as an array of (type, text): code blocks, block equations and the sentences of the prose in between.

    A fence is a line that begins with three backticks; an open fence lasts to the end. A code block is represented by
    its first non-blank line after the fence. Every character of a text is kept, whatever it is: where it has the inner
    mark itself, that is escaped first.
    """
    escape = F.transform(_typed_sentences(escaped(c), unescaped, escaped), lambda s: _typed(s["type"], unescaped(s["text"])))
    return F.when(_has_mark(c), escape).otherwise(_typed_sentences(c, lambda x: x, lambda x: x))


def _typed_sentences(c: Column, plain: Callable[[Column], Column], again: Callable[[Column], Column]) -> Column:
    fenced = F.regexp_replace(c, r"(?m)^([ \t]*```(?s:.*?)(?:^[ \t]*```[^\n]*$|\z))", f"{_MARK}C$1{_MARK}T")
    # the head of the text has no mark and is prose
    pieces = F.split(F.concat(F.lit("T"), fenced), _MARK)
    blocks = F.flatten(F.transform(pieces, lambda p: F.when(p.startswith("C"), F.array(p)).otherwise(F.split(F.regexp_replace(p, f"({MATH})", f"{_MARK}M$1{_MARK}T"), _MARK))))

    def parts(b: Column) -> Column:
        body = b.substr(F.lit(2), F.length(b))
        lines = F.filter(F.slice(F.split(body, "\n"), F.lit(2), F.greatest(F.size(F.split(body, "\n")) - 1, F.lit(0))), lambda x: F.trim(x) != "")
        code = strip(F.coalesce(F.get(lines, F.lit(0)), again(plain(body).substr(1, 80))))
        return F.when(b.startswith("C"), F.array(_typed("code_block", code))).when(b.startswith("M"), F.array(_typed("equation", strip(body)))).otherwise(F.flatten(F.transform(paragraphs(body), lambda p: _of_paragraph(p, plain))))

    return F.flatten(F.transform(blocks, parts))


def tidy(c: Column) -> Column:
    """At most one blank line, no runs of blanks, one line break at the end."""
    return F.concat(strip(F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"[ \t]{2,}", " ")), F.lit("\n"))


def strip_json_fence(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(strip(c), r"^```(?:json)?\s*\n?", ""), r"\n?```\s*$", "")


def strip_markdown_fence(c: Column) -> Column:
    return F.when(strip(c).rlike(r"^```(?:markdown|md)\s*\n"), F.regexp_replace(F.regexp_replace(strip(c), r"^```(?:markdown|md)\s*\n", ""), r"\n?```\s*$", "")).otherwise(c)


def identifiers(c: Column) -> Column:
    """ASCII identifiers of a text in lower case, in order."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"([a-z_][a-z0-9_]*)"), F.lit(1))


def claim_ref(c: Column) -> Column:
    """The number in `c12`, `12` or `c12]`; null if there is none."""
    return F.regexp_replace(F.trim(c.cast("string")), r"^[cC]+|\]+$", "").try_cast("int")


def replace_all(c: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def latex_escape(c: Column) -> Column:
    """One replacement after the other, in the order of LATEX: the braces of an earlier result are escaped again."""
    return replace_all(c, LATEX)


def html_escape(c: Column) -> Column:
    return replace_all(c, HTML)


def drop_citations(c: Column) -> Column:
    return F.regexp_replace(c, r"\s*\[@?c\d+(?:,\s*@?c\d+)*\]", "")


def drop_heading_numbers(c: Column) -> Column:
    return F.regexp_replace(c, r"(?m)^(#{1,6}\s+)\d+\.\d+\s+", "$1")


def normalise_headings(c: Column) -> Column:
    """One top-level heading, outside code blocks: headings of level three and more move up where there is at most one
    of level two, and the first of level two becomes level one unless the text begins with level one."""
    return F.when(_has_mark(c), unescaped(_normalised(escaped(c)))).otherwise(_normalised(c))


def _normalised(c: Column) -> Column:
    fence = r"(?m)^((`{3,}|~{3,})(?s:.*?)\n(?s:.*?)\2\s*$)"
    pieces = F.split(F.concat(F.lit("T"), F.regexp_replace(c, fence, f"{_MARK}C$1{_MARK}T")), _MARK)
    prose = F.array_join(F.transform(F.filter(pieces, lambda p: p.startswith("T")), lambda p: p.substr(F.lit(2), F.length(p))), "\n")
    single = F.regexp_count(prose, F.lit(r"(?m)^##\s+")) <= 1
    titled = F.regexp_replace(c, r"^\s+", "").startswith("# ")
    up = lambda p: F.when(single, F.regexp_replace(p, r"(?m)^#(#{2,5})(\s+)", "$1$2")).otherwise(p)
    text = F.transform(pieces, lambda p: F.when(p.startswith("T"), up(p.substr(F.lit(2), F.length(p)))).otherwise(p.substr(F.lit(2), F.length(p))))
    joined = F.array_join(F.transform(F.arrays_zip(pieces.alias("p"), text.alias("t")), lambda x: F.when(x["p"].startswith("T"), F.concat(F.lit("T"), x["t"])).otherwise(F.concat(F.lit("C"), x["t"]))), _MARK)
    # the first heading of level two in a prose piece: nothing of that kind stands before it
    first = rf"(?s)\A((?:(?!(?:^|\n|{_MARK}T)##\s).)*?(?:T|\n))##[ \t]+"
    promoted = F.when(titled, joined).otherwise(F.regexp_replace(joined, first, "$1# "))
    bare = F.regexp_replace(promoted, rf"(?:^|{_MARK})[TC]", "")
    return drop_heading_numbers(bare)


def plain_minus(c: Column) -> Column:
    return F.replace(c, F.lit("−"), F.lit("-"))


def thousands(c: Column) -> Column:
    """1234567 as 1{,}234{,}567."""
    return F.replace(F.format_number(c, 0), F.lit(","), F.lit("{,}"))


def minutes_seconds(c: Column) -> Column:
    s = c.cast("int")
    return F.format_string("%dm%ds", F.floor(s / 60).cast("int"), (s % 60).cast("int"))


def lookup_url(video: Column, seconds: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), video, F.lit("&t="), seconds.cast("int").cast("string"), F.lit("s"))


def whole(c: Column) -> Column:
    """A number rounded half to even, without decimals, as text."""
    return F.bround(c, 0).cast("bigint").cast("string")


def one_decimal(c: Column, whole: bool = False) -> Column:
    """A number with one decimal. whole: c is an integer and keeps all its digits."""
    return c.cast("decimal(20,1)").cast("string") if whole else F.format_string("%.1f", F.bround(c, 1))


def shorten(c: Column, limit: int = 200) -> Column:
    flat = F.trim(F.replace(c, F.lit("\n"), F.lit(" ")))
    return F.when(F.length(flat) > limit, F.concat(F.substring(flat, 1, limit - 3), F.lit("..."))).otherwise(flat)


def claim_line(claim_id: Column, kind: Column, video: Column, start: Column, content: Column) -> Column:
    return F.concat(F.lit("c"), claim_id.cast("string"), F.lit(" ["), kind, F.lit("|"), video, F.lit("|"), whole(start), F.lit("s]: "), shorten(content))


def payload_line(claim_id: Column, content: Column) -> Column:
    return F.concat(F.lit("[c"), claim_id.cast("string"), F.lit("] "), F.replace(content, F.lit("\n"), F.lit("\n  ")))


def video_line(video: Column, title: Column, seconds: Column) -> Column:
    return F.concat(F.lit("- "), video, F.lit(": "), title, F.lit(" ("), whole(F.coalesce(seconds, F.lit(0.0)) / 60), F.lit(" min)"))


def video_of_frame(frame_id: Column) -> Column:
    """The text before the first `_f`, else before the last `_`."""
    return F.when(F.instr(frame_id, "_f") > 0, F.substring_index(frame_id, "_f", 1)).otherwise(F.regexp_replace(frame_id, r"_[^_]*$", ""))


def stage_parts(stage: Column) -> tuple[Column, Column]:
    """`chapter:intro` as its prefix and what follows the first colon (null without one)."""
    at = F.instr(stage, ":")
    return F.when(at > 0, F.substring_index(stage, ":", 1)).otherwise(stage), F.when(at > 0, stage.substr(at + 1, F.length(stage)))


def month_and_year(c: Column) -> Column:
    return F.date_format(c, "MMMM yyyy")


def iso_seconds(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def joined_prompt(terms: Column, most: int = 200, between: str = ", ") -> Column:
    """The first terms of a list as a prompt."""
    return F.array_join(F.slice(terms, 1, most), between)


def content_hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def short_hash(c: Column, n: int = 12) -> Column:
    return F.substring(c, 1, n)


def words(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"[ \t\n\r\f]+"), lambda w: w != ""))


def bibtex(key: Column, title: Column, author: Column, year: Column, arxiv: Column, note: Column) -> Column:
    """A BibTeX entry: an article if it has an arXiv number, else a book; missing fields are left out."""
    field = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"  {name} = {{"), c.cast("string"), F.lit("}")))
    head = F.concat(F.when(arxiv.isNotNull(), "@article{").otherwise("@book{"), key)
    return F.concat(F.concat_ws(",\n", head, field("title", title), field("author", author), field("year", year), field("eprint", arxiv), field("note", note)), F.lit("\n}"))
