"""Ranking of rows for a topic: BM25, a dense score, and their blend, with kinds that are always kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions.text import identifiers
from attesta.operators.claims import number
from attesta.sources.tables import staged

K1, B = 1.5, 0.75
#: Kinds of claims that are kept whatever their score.
ALWAYS = ("code", "equation", "definition")


def bm25(docs: DataFrame, query: str | Column, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """id, score for the documents that share a term with the query; terms of the query count as often as they occur.

    Only terms of the query leave the tokeniser: the table is reduced to one row per document before any shuffle, with
    its length and the frequencies of the (few) query terms.
    """
    terms = docs.sparkSession.range(1).select(identifiers(F.lit(query) if isinstance(query, str) else query).alias("t")).first()["t"]
    wanted: dict[str, int] = {}
    for t in terms:
        wanted[t] = wanted.get(t, 0) + 1
    if not wanted:
        return docs.select(F.col(id_col), F.lit(0.0).alias("score")).limit(0)
    tokens = identifiers(F.col(text_col))
    base = docs.select(F.col(id_col), tokens.alias("_t")).select(F.col(id_col), F.size("_t").alias("dl"), F.filter("_t", lambda t: t.isin(*wanted)).alias("_hits"))
    hits = base.select(id_col, F.greatest("dl", F.lit(1)).alias("dl"), F.explode("_hits").alias("term")).groupBy(id_col, "dl", "term").agg(F.count("*").alias("tf"))
    facts = base.agg(F.count("*").alias("n"), F.avg("dl").alias("avg_dl"))
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    count = F.element_at(F.create_map(*[x for t, n in wanted.items() for x in (F.lit(t), F.lit(n))]), F.col("term"))
    # one row of totals, and one for each term of the query: both bounded by the query
    joined = hits.join(F.broadcast(df), "term").crossJoin(F.broadcast(facts))
    idf = F.ln((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    norm = 1 - B + B * F.col("dl") / F.when(F.col("avg_dl") > 0, F.col("avg_dl")).otherwise(1.0)
    part = count * idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * norm)
    return joined.groupBy(id_col).agg(F.sum(part).alias("score"))


def normalised(scores: DataFrame, score: str = "score") -> DataFrame:
    """Scores as shares of the largest one; all 0 if it is not positive."""
    top = scores.agg(F.max(score).alias("_top"))
    return scores.crossJoin(F.broadcast(top)).withColumn(score, F.when(F.col("_top") > 0, F.col(score) / F.col("_top")).otherwise(0.0)).drop("_top")


def blend(lexical: Column, dense: Column, weight: float = 0.5) -> Column:
    """(1 - weight) of the lexical and weight of the dense score; without a dense score the lexical one alone."""
    return F.when(dense.isNull(), lexical).otherwise((1 - weight) * lexical + weight * dense)


def top_k(scored: DataFrame, k: int, score: str = "score", ties: str = "id", digits: int | None = None) -> DataFrame:
    """The k best rows, place from 1; ties by a unique column. With digits, scores are compared rounded."""
    s = F.round(score, digits) if digits is not None else F.col(score)
    best = scored.orderBy(s.desc(), F.col(ties)).limit(k)
    return best.withColumn("place", F.row_number().over(Window.orderBy(s.desc(), F.col(ties))))


#: Decimals that scores are compared with: what the order of summing changes is beyond them.
DIGITS = 9


def select_claims(claims: DataFrame, query: str, cap: int = 80, dense: DataFrame | None = None, weight: float = 0.5) -> DataFrame:
    """At most cap claims (id, type, content, pos: input order) for a topic, with place: their order in the result.

    If there are no more than cap, all pass in input order. Kinds in ALWAYS come first, by id; if they alone reach the
    cap, the largest ids stay. The rest of the cap goes to the best of the others, ties in input order; scores are
    compared with DIGITS decimals, so the partitioning does not decide. Places are given over sorted ranges, so neither
    the claims nor a large cap go to one task.
    """
    always = F.coalesce(F.col("type").isin(*ALWAYS), F.lit(False))
    rows = staged(claims.withColumn("_must", always), "claims-to-select")  # counted, scored and ranked: made once
    counts = rows.agg(F.count("*").alias("n"), F.count_if("_must").alias("must")).first()
    own = rows.drop("_must")
    if counts["n"] <= cap:
        return placed(own, [F.col("pos")])
    must = rows.where("_must").drop("_must")
    if counts["must"] >= cap:
        return placed(must.orderBy(F.col("id").desc()).limit(cap), [F.col("id").desc()])
    rest = rows.where("NOT _must").drop("_must")
    lexical = normalised(rest.join(bm25(rest, query), "id", "left").withColumn("score", F.coalesce("score", F.lit(0.0))))
    if dense is not None:
        lexical = lexical.join(dense.select("id", F.col("score").alias("_dense")), "id", "left").withColumn("score", blend(F.col("score"), F.col("_dense"), weight)).drop("_dense")
    best = lexical.withColumn("score", F.round("score", DIGITS)).orderBy(F.desc("score"), "pos").limit(cap - counts["must"])
    ranked = placed(best, [F.desc("score"), F.col("pos")]).withColumn("place", F.col("place") + counts["must"])
    first = placed(must, [F.col("id")])
    return first.unionByName(ranked.select(first.columns))


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """place: the row's number from 1 in an order, counted over ranges of it."""
    return number(rows, order).withColumnRenamed("_n", "place")


def document_frequency(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.explode(F.array_distinct(identifiers(F.col(text_col)))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def term_frequency(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(id_col, F.explode(identifiers(F.col(text_col))).alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("tf"))


def first_terms(terms: DataFrame, cap: int = 200) -> DataFrame:
    """Terms (pos, term) without case-insensitive repeats, the first spelling of each, in order, at most cap."""
    own = terms.groupBy(F.lower("term").alias("_k")).agg(F.min_by("term", "pos").alias("term"), F.min("pos").alias("pos"))
    return own.select("pos", "term").orderBy("pos").limit(cap)
