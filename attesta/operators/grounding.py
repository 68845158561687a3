"""Grounding of prose: typed sentences, their citations against the claims of the chapter, demotion and removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions import text as T

STATUSES = ("grounded", "unsupported", "contradicted", "needs_external_check", "narrative_ok")


def sentences(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per sentence: id, index, type, text, cited_claim_ids, and the columns to keep."""
    rows = docs.select(F.col(id_col), *keep, F.posexplode(T.typed_sentences(F.col(text_col))).alias("index", "_s"))
    cited = F.when(F.col("_s.type").isin("factual", "narrative") & ~F.col("_s.text").startswith("#"), T.citations(F.col("_s.text"))).otherwise(F.array().cast("array<int>"))
    return rows.select(id_col, *keep, "index", F.col("_s.type").alias("type"), F.col("_s.text").alias("text"), cited.alias("cited_claim_ids"))


def rule(kind: Column, cited: Column, missing: Column) -> tuple[Column, Column]:
    """Status and reason of a sentence from its type, its citations and those of them that do not exist."""
    quiet = kind.isin("narrative", "figure_directive")
    status = F.when(quiet, "narrative_ok").when(F.size(cited) == 0, "unsupported").when(F.size(missing) > 0, "unsupported").otherwise("grounded")
    gone = F.concat(F.lit("cited claims not in chapter: ["), F.array_join(F.transform(missing, lambda x: x.cast("string")), ", "), F.lit("]"))
    reason = F.when(kind == "narrative", "no factual content").when(kind == "figure_directive", "figure directive").when(F.size(cited) == 0, "no citation").when(F.size(missing) > 0, gone).otherwise("citations match available claims")
    return status, reason


def verify_with_list(rows: DataFrame, available: str = "available") -> DataFrame:
    """Status and reason where each row carries the list of claims it may cite."""
    missing = F.filter("cited_claim_ids", lambda x: ~F.array_contains(F.col(available), x))
    status, reason = rule(F.col("type"), F.col("cited_claim_ids"), missing)
    return rows.withColumn("status", status).withColumn("reason", reason)


def verify(rows: DataFrame, claims: DataFrame, keys: list[str], scope: list[str]) -> DataFrame:
    """Status and reason where the claims are a table (scope columns, claim_id) of any size; keys name a sentence.

    Citations are exploded with their sentence, joined once, and gathered again by sentence, so the sentences are made
    once. A claim that very many sentences cite is a hot key of the join only, which splits.
    """
    known = claims.select(*scope, F.col("claim_id").cast("int").alias("_claim")).distinct().withColumn("_known", F.lit(True))
    cites = rows.select(*rows.columns, F.posexplode_outer("cited_claim_ids").alias("_pos", "_claim")).join(known, [*scope, "_claim"], "left")
    lost = F.sort_array(F.collect_list(F.when(F.col("_claim").isNotNull() & F.col("_known").isNull(), F.struct("_pos", "_claim"))))
    joined = cites.groupBy(*keys).agg(*[F.first(c).alias(c) for c in rows.columns if c not in keys], lost.alias("_m")).select(*rows.columns, "_m")
    status, reason = rule(F.col("type"), F.col("cited_claim_ids"), F.transform("_m", lambda x: x["_claim"]))
    return joined.withColumn("status", status).withColumn("reason", reason).drop("_m")


def verify_documents(docs: DataFrame, claims: DataFrame, id_col: str, text_col: str, scope: list[str]) -> tuple[DataFrame, DataFrame]:
    """The sentences of every document with status and reason, and the zero-filled summary of each document."""
    rows = verify(sentences(docs, id_col, text_col, tuple(c for c in scope if c != id_col)), claims, [id_col, "index"], scope)
    return rows, zero_filled(summary(rows, [id_col]), [id_col])


def recounted(verified: DataFrame, own: DataFrame, by: list[str]) -> DataFrame:
    """Summaries (by, status, n) after demotion: counted anew where a sentence was demoted, else those given (own) as they are."""
    changed = verified.groupBy(*by).agg(F.bool_or("demoted").alias("_d")).where("_d").select(*by)
    return summary(verified.join(changed, by, "left_semi"), by).unionByName(own.join(changed, by, "left_anti").select(*by, "status", "n"))


def demote(verified: DataFrame, claims: DataFrame, keys: list[str], scope: list[str]) -> DataFrame:
    """Grounded sentences that cite what is no claim of their chapter, or cite nothing readable, become unsupported.

    cited_claim_ids are references as written (`c12`). Adds demoted; only grounded rows with citations can change.
    """
    refs = F.filter(F.transform("cited_claim_ids", lambda x: T.claim_ref(x)), lambda x: x.isNotNull())
    rows = verified.withColumn("_ids", F.sort_array(F.array_distinct(F.coalesce(refs, F.array().cast("array<int>")))))
    by = list(dict.fromkeys([*keys, *scope]))
    cites = rows.where(F.col("status") == "grounded").select(*by, F.explode("_ids").alias("claim_id"))
    known = claims.select(*scope, F.col("claim_id").cast("int").alias("claim_id")).distinct()
    lost = cites.join(known, [*scope, "claim_id"], "left_anti").groupBy(*keys).agg(F.sort_array(F.collect_list("claim_id")).alias("_u"))
    cited = F.coalesce(F.size("cited_claim_ids"), F.lit(0)) > 0
    garbage = cited & (F.size("_ids") == 0)
    more = F.when(garbage, F.lit(" | cited refs unparseable")).otherwise(F.concat(F.lit(" | cited claim ids not in chapter: ["), F.array_join(F.col("_u").cast("array<string>"), ", "), F.lit("]")))
    hit = F.coalesce((F.col("status") == "grounded") & (garbage | F.col("_u").isNotNull()), F.lit(False))
    out = rows.join(lost, keys, "left").withColumn("demoted", hit)
    reason = F.when(F.col("demoted"), F.regexp_replace(F.concat(F.coalesce("reason", F.lit("")), more), r"^[ |]+|[ |]+$", "")).otherwise(F.col("reason"))
    return out.withColumn("reason", reason).withColumn("status", F.when(F.col("demoted"), "unsupported").otherwise(F.col("status"))).drop("_ids", "_u")


def summary(verified: DataFrame, by: list[str]) -> DataFrame:
    """Sentences of each status; a missing status is `unknown`."""
    return verified.groupBy(*by, F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("n"))


def zero_filled(counts: DataFrame, by: list[str]) -> DataFrame:
    """A row for each of the five statuses of every key, 0 where there is none."""
    spark = counts.sparkSession
    dimension = spark.createDataFrame([(s,) for s in STATUSES], "status string")  # five rows
    keys = counts.select(*by).distinct() if by else spark.range(1).select()
    return keys.crossJoin(F.broadcast(dimension)).join(counts, [*by, "status"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def stripped_text(verified: DataFrame, keys: list[str]) -> DataFrame:
    """Text of each document rebuilt from its sentences that are not unsupported, and the indices of those removed."""
    bad = F.col("status") == "unsupported"
    kept = F.sort_array(F.collect_list(F.when(~bad, F.struct("index", "text"))))
    gone = F.sort_array(F.collect_list(F.when(bad, F.col("index"))))
    out = verified.groupBy(*keys).agg(F.transform(kept, lambda x: x["text"]).alias("_t"), gone.alias("stripped_sentence_indices"))
    return out.withColumn("text", T.tidy(F.array_join("_t", " "))).drop("_t")


def strip_in_place(docs: DataFrame, text_col: str, remove_col: str, out_col: str = "verified") -> DataFrame:
    """Remove given sentences (array<string>, in document order) from a text: each at its first place from where the one before was.

    Where a sentence is not found to the letter, any white space matches its blanks. A fold over the sentences carries
    the text that is settled and the text that is still to be searched.
    """
    start = F.struct(F.lit("").alias("done"), F.col(text_col).alias("rest"))

    def step(s: Column, sentence: Column) -> Column:
        own, rest = T.strip(sentence), s["rest"]
        quoted = F.concat(F.lit(r"\Q"), F.replace(F.replace(own, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(" "), F.lit(r"\E\s+\Q")), F.lit(r"\E"))
        found = F.when(rest.contains(own), own).otherwise(F.call_function("regexp_extract", rest, quoted, F.lit(0)))
        at = F.call_function("locate", found, rest)
        cut = F.struct(F.concat(s["done"], rest.substr(F.lit(1), at - 1)).alias("done"), rest.substr(at + F.length(found), F.length(rest)).alias("rest"))
        return F.when((own == "") | (found == ""), s).otherwise(cut)

    out = F.aggregate(F.filter(F.coalesce(F.col(remove_col), F.array().cast("array<string>")), lambda x: x.isNotNull()), start, step, lambda s: F.concat(s["done"], s["rest"]))
    return docs.withColumn(out_col, out)


def external_queue(verified: DataFrame) -> DataFrame:
    """Sentences that wait for an outside check."""
    return verified.where(F.col("status") == "needs_external_check")
