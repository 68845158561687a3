"""Roll-up reports: grounding, statistics, cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def status_counts(citations: DataFrame) -> DataFrame:
    """Distinct sentences of each status over all chapters."""
    return citations.groupBy("status").agg(F.count_distinct("chapter_id", "sentence_index").alias("n"))


def one_row_per_sentence(citations: DataFrame) -> DataFrame:
    """Citation rows collapsed to sentences: the first claim's row gives status and text, claim ids are listed."""
    order = F.struct(F.col("claim_id").isNotNull(), "claim_id")
    first = lambda c: F.min_by(c, order).alias(c)
    return citations.groupBy("chapter_id", "sentence_index").agg(first("sentence_text"), first("sentence_type"), first("status"), first("reason"), F.sort_array(F.collect_list("claim_id")).alias("claim_ids"))


def chapter_counts(citations: DataFrame) -> DataFrame:
    return one_row_per_sentence(citations).groupBy("chapter_id", "status").agg(F.count("*").alias("n"))


def audit_rows(citations: DataFrame, chapters: DataFrame) -> DataFrame:
    """The sentences of all chapters that have any, by sentence, texts cut at 240 characters."""
    own = one_row_per_sentence(citations).withColumn("sentence_text", F.substring("sentence_text", 1, 240))
    return chapters.join(own, "chapter_id").orderBy("chapter_id", "sentence_index")


def percentages(rows: DataFrame, status: str = "status") -> DataFrame:
    """Share of grounded and of unsupported rows in all, in per cent; 0 of no rows."""
    share = lambda s: 100.0 * F.coalesce(F.sum(F.when(F.col(status) == s, 1).otherwise(0)), F.lit(0)) / F.greatest(F.count("*"), F.lit(1))
    return rows.agg(F.count("*").alias("n"), share("grounded").alias("grounded_pct"), share("unsupported").alias("unsupported_pct"))


def status_shares(rows: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    """Rows and share in per cent of every status within by."""
    counts = rows.groupBy(*by, status).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", 100.0 * F.col("n") / F.greatest(F.sum("n").over(Window.partitionBy(*by)), F.lit(1)))


def pipeline_stats(rows: DataFrame, status: str = "status") -> DataFrame:
    """Counts of sentences, and the citation and grounding rates in per cent to one decimal, half to even; contradicted sentences count nowhere."""
    n = lambda *s: F.count_if(F.col(status).isin(*s))
    pct = lambda a, b: F.when(b > 0, F.bround(100.0 * a / b, 1)).otherwise(0.0)
    g, e, w, u = n("grounded"), n("needs_external_check", "external_ok"), n("narrative_ok"), n("unsupported")
    total = g + e + w + u
    return rows.agg(total.alias("sentences"), g.alias("grounded"), w.alias("narrative"), e.alias("external"), u.alias("unsupported"), pct(g + e, total - w).alias("citation_pct"), pct(g + w + e, total).alias("grounding_pct"))


def with_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """usd from four kinds of tokens and the price of a million of each; unknown models cost nothing. prices has a row for each model."""
    kinds = ("input", "output", "cache_write", "cache_read")
    cheap = prices.select("model", *[F.col(k).alias(f"_{k}") for k in kinds])
    total = sum((F.col(f"{k}_tokens") / 1e6 * F.coalesce(F.col(f"_{k}"), F.lit(0.0)) for k in kinds), F.lit(0.0))
    return usage.join(cheap, "model", "left").withColumn("usd", total).drop(*[f"_{k}" for k in kinds])


def cost_by(log: DataFrame, by: str) -> DataFrame:
    return log.groupBy(by).agg(F.sum("usd").alias("usd"), F.count("*").alias("calls")).orderBy(F.col("usd").desc(), by)


def cost_rollup(log: DataFrame) -> DataFrame:
    """Cost by stage, by model and in all, in one pass. kind tells which a row is."""
    sets = log.groupingSets([["stage"], ["model"], []], "stage", "model")
    kind = F.when(F.grouping("stage") == 0, "stage").when(F.grouping("model") == 0, "model").otherwise("total")
    return sets.agg(kind.alias("kind"), F.sum("usd").alias("usd"), F.count("*").alias("calls"))


def cost_totals(log: DataFrame) -> DataFrame:
    tokens = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("input_tokens", "output_tokens", "cache_write_tokens", "cache_read_tokens")]
    return log.agg(F.coalesce(F.sum("usd"), F.lit(0.0)).alias("usd"), *tokens, F.count("*").alias("calls"))


def chapter_spend(log: DataFrame) -> DataFrame:
    """Cost of every chapter: what follows the first colon of stages that begin with `chapter:`."""
    own = log.where(F.startswith("stage", F.lit("chapter:")))
    return own.groupBy(F.expr("substring(stage, instr(stage, ':') + 1)").alias("chapter")).agg(F.sum("usd").alias("usd"))


def bad_code(checked: DataFrame, by: str = "video_id") -> DataFrame:
    """Snippets of each key that do not parse."""
    return checked.groupBy(by).agg(F.count_if(~F.col("parseable")).alias("bad"))


def html_table(columns: list[str], rows: DataFrame) -> DataFrame:
    """Rows as lines of an HTML table, cells escaped: column html."""
    from attesta.functions.text import html_escape

    cell = lambda c: F.concat(F.lit("<td>"), F.coalesce(html_escape(F.col(c).cast("string")), F.lit("")), F.lit("</td>"))
    return rows.select(F.concat(F.lit("<tr>"), *map(cell, columns), F.lit("</tr>")).alias("html"))


def display_usd(c: Column) -> Column:
    return F.format_string("$%.4f", F.bround(c, 4))
