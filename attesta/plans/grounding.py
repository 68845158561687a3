"""Queries on sentences and their citations. Testdata cite nothing, so a deterministic subset of sentences gets a reference."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import grounding as G
from attesta.operators import reports as R
from attesta.plans.registry import query

#: Sentences of all documents: pos, text, type. RE2 has no look-behind, so a mark is put at the ends first.
SENTENCES_SQL = r"""
  pieces AS (SELECT doc_id, lang, CASE WHEN p = '' THEN 'T' ELSE p END AS p, i FROM (SELECT doc_id, lang, unnest(x) AS p, generate_subscripts(x, 1) AS i FROM
    (SELECT doc_id, lang, string_split('T' || regexp_replace(text, '(\$\$[^$]+\$\$)', chr(1) || 'M\1' || chr(1) || 'T', 'g'), chr(1)) AS x FROM documents))),
  paras AS (SELECT doc_id, lang, i, left(p, 1) AS k, unnest(y) AS para, generate_subscripts(y, 1) AS j FROM
    (SELECT *, CASE WHEN left(p, 1) = 'M' THEN [substr(p, 2)] ELSE regexp_split_to_array(substr(p, 2), '\n\s*\n') END AS y FROM pieces)),
  clean AS (SELECT * REPLACE (regexp_replace(para, '^\s+|\s+$', '', 'g') AS para) FROM paras),
  parts AS (SELECT doc_id, lang, i, k, j, unnest(z) AS s, generate_subscripts(z, 1) AS l FROM
    (SELECT *, CASE WHEN k = 'M' THEN [para] ELSE string_split(regexp_replace(para, '([.!?])[ \t\n\r\f]+([A-Z\[`])', '\1' || chr(2) || '\2', 'g'), chr(2)) END AS z FROM clean WHERE para <> '')),
  sents AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY i, j, l) - 1 AS pos, k, s FROM
    (SELECT * REPLACE (regexp_replace(s, '^\s+|\s+$', '', 'g') AS s) FROM parts) WHERE s <> ''),
  typed AS (SELECT *, CASE WHEN k = 'M' THEN 'equation'
      WHEN regexp_matches(s, '(^|[^\pL\pN_])([0-9]+(\.[0-9]+)?|[A-Z]{2,})($|[^\pL\pN_])')
        OR regexp_matches(' ' || lower(s) || ' ', ' (is|are|was|were|uses|has|have|contains|requires|produces|equals|computes|applies|defines) ') THEN 'factual' ELSE 'narrative' END AS type FROM sents)"""

#: Two of three sentences cite a document id near their own; claims are the labelled documents.
CITED_SQL = SENTENCES_SQL + """,
  cited AS (SELECT *, CASE WHEN type = 'equation' OR pos % 3 = 2 THEN NULL ELSE (doc_id + pos) % 2000 END AS c FROM typed),
  verified AS (SELECT doc_id, lang, pos, CASE WHEN c IS NOT NULL THEN 'factual' ELSE type END AS type, c,
    CASE WHEN c IS NULL AND type = 'narrative' THEN 'narrative_ok' WHEN c IS NULL THEN 'unsupported' WHEN c IN (SELECT doc_id FROM labels) THEN 'grounded' ELSE 'unsupported' END AS status FROM cited)"""


def sentences(read):
    return G.sentences(read("documents"), "doc_id", "text", ("lang",))


def verified(read):
    rows = sentences(read)
    hit = (F.col("type") != "equation") & (F.col("index") % 3 != 2)
    cites = F.when(hit, F.concat(F.lit(" [c"), (F.col("doc_id") + F.col("index")) % 2000, F.lit("]"))).otherwise("")
    rows = rows.withColumn("text", F.concat("text", cites)).withColumn("cited_claim_ids", T.citations(F.col("text"))).withColumn("type", F.when(hit, "factual").otherwise(F.col("type")))
    claims = read("labels").select(F.col("doc_id").alias("claim_id"))
    return G.verify(rows, claims, ["doc_id", "index"], [])


@query("WITH " + CITED_SQL + " SELECT lang, status, count(*) AS n FROM verified GROUP BY ALL")
def grounding_audit(read, spark):
    return G.summary(verified(read), ["lang"])


@query("WITH " + SENTENCES_SQL + " SELECT doc_id, pos::INT AS index, type, md5(s) AS text_md5 FROM typed")
def sentence_table(read, spark):
    return sentences(read).select("doc_id", "index", "type", F.md5("text").alias("text_md5"))


@query("WITH " + CITED_SQL + " SELECT doc_id, pos::INT AS index, type, status FROM verified")
def verify_sentences(read, spark):
    return verified(read).select("doc_id", "index", "type", "status")


@query("WITH " + CITED_SQL + " SELECT doc_id, count(*) FILTER (status <> 'unsupported') AS n_kept, string_agg(pos::VARCHAR, ',' ORDER BY pos) FILTER (status = 'unsupported') AS removed FROM verified GROUP BY doc_id HAVING removed IS NOT NULL")
def strip_unsupported(read, spark):
    out = verified(read).groupBy("doc_id").agg(F.count_if(F.col("status") != "unsupported").alias("n_kept"), F.sort_array(F.collect_list(F.when(F.col("status") == "unsupported", F.col("index")))).alias("removed"))
    return out.where(F.size("removed") > 0).withColumn("removed", F.concat_ws(",", F.col("removed").cast("array<string>")))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 4 AND doc_id % 2 = 0 THEN 'unsupported' WHEN doc_id % 2 = 0 AND (doc_id % 5 IN (1, 2) AND (doc_id NOT IN (SELECT doc_id FROM labels) OR doc_id % 5 = 2)) THEN 'unsupported'
    WHEN doc_id % 2 = 0 THEN 'grounded' ELSE 'needs_external_check' END AS status,
    doc_id % 2 = 0 AND (doc_id % 5 = 4 OR doc_id % 5 = 2 OR (doc_id % 5 = 1 AND doc_id NOT IN (SELECT doc_id FROM labels))) AS demoted,
    CASE WHEN doc_id % 2 = 1 OR doc_id % 5 IN (0, 3) OR doc_id % 5 = 1 AND doc_id IN (SELECT doc_id FROM labels) THEN 'ok' WHEN doc_id % 5 = 4 THEN 'ok | cited refs unparseable'
      WHEN doc_id % 5 = 1 THEN 'ok | cited claim ids not in chapter: [' || doc_id || ']'
      ELSE 'ok | cited claim ids not in chapter: [-1, ' || CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN '' ELSE doc_id || ', ' END || '99999999]' END AS reason FROM documents""")
def demote_phantom(read, spark):
    own = F.concat(F.lit("c"), F.col("doc_id"))
    kind = F.col("doc_id") % 5
    refs = F.when(kind == 4, F.array(F.lit("cxyz"))).when(kind == 1, F.array(own)).when(kind == 2, F.array(own, F.lit("c-1"), F.lit("c99999999"))).otherwise(F.array().cast("array<string>"))
    rows = read("documents").select("doc_id", F.lit(0).alias("index"), refs.alias("cited_claim_ids"), F.when(F.col("doc_id") % 2 == 0, "grounded").otherwise("needs_external_check").alias("status"), F.lit("ok").alias("reason"))
    out = G.demote(rows, read("labels").select(F.col("doc_id").alias("claim_id")), ["doc_id", "index"], [])
    return out.select("doc_id", "status", "demoted", "reason")


@query("WITH s AS (SELECT unnest(['grounded','unsupported','contradicted','needs_external_check','narrative_ok']) AS status), l AS (SELECT DISTINCT lang FROM documents), " + CITED_SQL.strip() + """
    SELECT l.lang, s.status, count(v.doc_id) AS n FROM l CROSS JOIN s LEFT JOIN verified v ON v.lang = l.lang AND v.status = s.status GROUP BY ALL""")
def zero_filled_summary(read, spark):
    return G.zero_filled(G.summary(verified(read), ["lang"]), ["lang"])


@query("""WITH r AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'grounded' WHEN quality = 1 THEN 'narrative_ok' WHEN toxic = 0 THEN 'unsupported' ELSE 'needs_external_check' END AS status FROM labels)
    SELECT doc_id FROM r WHERE status = 'needs_external_check'""")
def external_queue(read, spark):
    return G.external_queue(statuses(read)).select("doc_id")


def statuses(read):
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    return read("labels").withColumn("status", F.when(good & ~toxic, "grounded").when(good, "narrative_ok").when(~toxic, "unsupported").otherwise("needs_external_check"))


STATUS_SQL = "SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'grounded' WHEN quality = 1 THEN 'narrative_ok' WHEN toxic = 0 THEN 'unsupported' ELSE 'needs_external_check' END AS status FROM labels"


@query("SELECT count(*) AS n, 100.0::DOUBLE * sum((status = 'grounded')::INT) / count(*) AS grounded_pct, 100.0::DOUBLE * sum((status = 'unsupported')::INT) / count(*) AS unsupported_pct FROM (" + STATUS_SQL + ")")
def status_pct(read, spark):
    return R.percentages(statuses(read))


@query("SELECT status, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct FROM (" + STATUS_SQL + ") GROUP BY status")
def status_share(read, spark):
    return R.status_shares(statuses(read), [])


@query("""WITH t AS (SELECT count(*) FILTER (status = 'grounded') AS g, count(*) FILTER (status = 'narrative_ok') AS w, count(*) FILTER (status = 'needs_external_check') AS e, count(*) FILTER (status = 'unsupported') AS u FROM (""" + STATUS_SQL + """))
    SELECT g + w + e + u AS sentences, g AS grounded, w AS narrative, e AS external, u AS unsupported, round(100.0::DOUBLE * (g + e) / (g + e + u), 1) AS citation_pct, round(100.0::DOUBLE * (g + w + e) / (g + w + e + u), 1) AS grounding_pct FROM t""")
def pipeline_stats(read, spark):
    return R.pipeline_stats(statuses(read))


#: Citation rows: every document is a sentence of its language, with two claims, one, or none.
CITATION_ROWS_SQL = """SELECT lang AS chapter_id, doc_id AS sentence_index, CASE WHEN quality = 1 THEN 'grounded' WHEN quality = 0 THEN 'unsupported' ELSE 'narrative_ok' END AS status,
    unnest(CASE WHEN quality = 1 THEN [doc_id, doc_id + 1] WHEN quality = 0 THEN [doc_id] ELSE [NULL] END) AS claim_id FROM documents LEFT JOIN labels USING (doc_id)"""


def citation_rows(read):
    d = read("documents").join(read("labels").select("doc_id", "quality"), "doc_id", "left")
    q = F.col("quality")
    ids = F.when(q == 1, F.array("doc_id", F.col("doc_id") + 1)).when(q == 0, F.array("doc_id")).otherwise(F.array().cast("array<bigint>"))
    status = F.when(q == 1, "grounded").when(q == 0, "unsupported").otherwise("narrative_ok")
    return d.select(F.col("lang").alias("chapter_id"), F.col("doc_id").alias("sentence_index"), F.col("text").alias("sentence_text"), F.lit("factual").alias("sentence_type"), status.alias("status"), F.lit("").alias("reason"), F.explode_outer(ids).alias("claim_id"))


@query("SELECT status, count(DISTINCT chapter_id || ':' || sentence_index) AS n FROM (" + CITATION_ROWS_SQL + ") GROUP BY status")
def status_rollup(read, spark):
    return R.status_counts(citation_rows(read))


@query("SELECT chapter_id, status, count(DISTINCT sentence_index) AS n FROM (" + CITATION_ROWS_SQL + ") GROUP BY ALL")
def chapter_status_counts(read, spark):
    return R.chapter_counts(citation_rows(read))


@query("SELECT chapter_id, sentence_index, any_value(status) AS status, count(claim_id) AS n_claims, min(substr(text, 1, 240)) AS sentence_text, '' AS reason FROM (" + CITATION_ROWS_SQL + ") JOIN documents ON doc_id = sentence_index WHERE chapter_id IN ('en', 'fr') GROUP BY ALL")
def audit_report(read, spark):
    chapters = spark.createDataFrame([("en",), ("fr",), ("xx",)], "chapter_id string")
    return R.audit_rows(citation_rows(read), chapters).select("chapter_id", "sentence_index", "status", F.size("claim_ids").cast("long").alias("n_claims"), "sentence_text", "reason")
