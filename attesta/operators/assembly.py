"""Assembly of texts and figures from ordered parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from attesta.functions import text as T

#: Kinds of frames that can stand for a diagram.
DIAGRAMS = ("diagram", "math", "slide")


def outline_chapters(chapters: Column, appendices: Column) -> Column:
    """Chapters, then appendices; a missing list is empty."""
    return F.concat(F.coalesce(chapters, F.array().cast("array<string>")), F.coalesce(appendices, F.array().cast("array<string>")))


def joined_texts(parts: DataFrame, by: list[str], order: str, text: str, between: str = "\n\n") -> DataFrame:
    """The texts of each key in order as one text; nulls are left out."""
    items = F.sort_array(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(F.col(order).alias("o"), F.col(text).alias("t")))))
    return parts.groupBy(*by).agg(F.array_join(F.transform(items, lambda x: x["t"]), between).alias("text"))


def manuscript_part(c: Column) -> Column:
    """A chapter as it enters the manuscript: headings in order, no claim citations, plain minus signs."""
    return T.plain_minus(T.drop_citations(T.normalise_headings(c)))


def figure_directives(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, number from 1, description of the figures a text asks for."""
    return docs.select(id_col, F.posexplode(T.figures(F.col(text_col))).alias("_p", "description")).select(id_col, (F.col("_p") + 1).alias("number"), "description")


def directives_with_figures(directives: DataFrame, made: DataFrame, id_col: str) -> DataFrame:
    """The k-th directive of a text with its k-th figure by index; a missing one is null."""
    ranked = made.withColumn("number", F.row_number().over(Window.partitionBy(id_col).orderBy("index"))).drop("index")
    return directives.join(ranked, [id_col, "number"], "left")


def artifact(mode: Column, code: Column, base: Column, frame: Column) -> Column:
    """Path of a figure: generated code by mode, else the embedded frame if there is one, else null."""
    some = F.coalesce(code, F.lit("")) != ""
    return F.when((mode == "mermaid") & some, F.concat(base, F.lit(".mmd"))).when((mode == "tikz") & some, F.concat(base, F.lit(".tex"))).when(frame.isNotNull(), F.concat(base, F.lit(".jpg")))


def figure_text(mode: Column, path: Column, caption: Column, code: Column, label: Column, rendered: Column) -> Column:
    """What replaces a directive: an image, a code block, a placeholder, or a note that the figure is missing."""
    image = lambda p: F.concat(F.lit("\n!["), caption, F.lit("]("), p, F.lit("){#"), label, F.lit("}\n"))
    block = F.concat(F.lit("\n```mermaid\n"), code, F.lit("\n```\n*Figure: "), caption, F.lit("*\n"))
    centred = F.concat(F.lit("\n\\begin{center}\\textit{[Diagram: "), T.latex_escape(caption), F.lit("]}\\end{center}\n"))
    drawn = path.isNotNull()
    return F.when((mode == "mermaid") & drawn, F.when(rendered.isNotNull(), image(rendered)).otherwise(block)).when((mode == "tikz") & drawn, centred).when(drawn, image(path)).otherwise(F.concat(F.lit("\n*[Figure missing: "), caption, F.lit("]*\n")))


def diagrams_of_claims(claims: DataFrame, vision: DataFrame, key: str) -> DataFrame:
    """The diagram frames that the claims of each key refer to, each once, in order of first mention: key, pos, frame_id, video_id."""
    rows = claims.select(key, "id", F.posexplode("frame_ids").alias("_p", "frame_id"))
    first = rows.groupBy(key, "frame_id").agg(F.min(F.struct("id", "_p")).alias("_first"))
    own = first.withColumn("video_id", T.video_of_frame(F.col("frame_id")))
    kept = own.join(vision.where(F.col("category").isin(*DIAGRAMS)).select("frame_id", "category", "title"), "frame_id")
    return kept.withColumn("pos", F.row_number().over(Window.partitionBy(key).orderBy("_first"))).drop("_first")


def segment_payload(segments: DataFrame, empty_text: bool = False) -> DataFrame:
    """Topic segments (video_id, ts_start, ts_end, title, segments) as text for an extractor: payload.

    Times are all doubles or all whole numbers. empty_text: an extracted text that is empty, not null, has its line too.
    """
    time = lambda c: T.one_decimal(c, segments.schema["ts_start"].dataType == LongType())
    span = lambda a, b: F.concat(F.lit("["), time(a), F.lit("-"), time(b), F.lit("]"))

    def visual(v: Column) -> Column:
        code = F.when(v["code"].isNotNull(), F.concat_ws("\n", F.concat(F.lit("    code ("), F.coalesce(v["code"]["language"], F.lit("")), F.lit("):")), F.transform(F.split(F.coalesce(v["code"]["content"], F.lit("")), "\n"), lambda x: F.concat(F.lit("      "), x))))
        line = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"    {name}: "), c))
        text = F.substring(v["extracted_text"], 1, 500)
        text = F.concat(F.lit("    text: "), text) if empty_text else line("text", text)
        math = F.transform(F.coalesce(v["math"], F.array().cast("array<string>")), lambda m: F.concat(F.lit("    math: "), m))
        return F.concat_ws("\n", F.concat(F.lit("  FRAME "), v["frame_id"], F.lit(" ("), F.coalesce(v["category"], F.lit("?")), F.lit("):")), line("title", v["title"]), text, code, math, line("diagram", v["diagram_summary"]), F.when(F.size(F.coalesce(v["diagram_elements"], F.array().cast("array<string>"))) > 0, line("elements", F.array_join(v["diagram_elements"], ", "))))

    body = F.transform("segments", lambda s: F.concat_ws("\n", F.concat_ws(" ", span(s["ts_start"], s["ts_end"]), s["text"]), F.transform(s["visuals"], visual)))
    head = [F.concat(F.lit("# Segment from video "), F.col("video_id")), F.concat(F.lit("# ts: "), time(F.col("ts_start")), F.lit(" - "), time(F.col("ts_end"))), F.concat(F.lit("# title (if any): "), F.coalesce("title", F.lit(""))), F.lit(""), F.lit("## Aligned transcript + visuals")]
    return segments.withColumn("payload", F.concat_ws("\n", *head, body))


def bibliography(refs: DataFrame) -> DataFrame:
    """All references as one BibTeX text, by id. The reference list is a configuration table: small."""
    entry = T.bibtex(*[F.col(c) for c in ("id", "title", "author", "year", "arxiv", "note")])
    return joined_texts(refs.select(F.lit(1).alias("k"), "id", entry.alias("e")), ["k"], "id", "e").select("text")
