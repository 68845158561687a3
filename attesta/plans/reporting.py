"""Queries on costs: line items stand for calls (stage: return flag, model: line status), events for a spending log."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import code as C
from attesta.operators import budget as B
from attesta.operators import reports as R
from attesta.plans.registry import query

PRICES = [("F", 3.0, 15.0, 3.75, 0.5), ("X", 1.0, 5.0, 1.25, 0.125)]
USAGE_SQL = """usage AS (SELECT l_returnflag AS stage, l_linestatus AS model, l_quantity * 1000 AS i, l_linenumber * 1000 AS o,
    CASE WHEN l_linestatus = 'F' THEN (l_quantity * 1000 * 3 + l_linenumber * 1000 * 15)::DECIMAL(18,2) ELSE 0::DECIMAL(18,2) END / 1 AS micro FROM lineitem)"""


def usage(read, spark):
    prices = spark.createDataFrame(PRICES, "model string, input double, output double, cache_write double, cache_read double")
    l = read("lineitem").select(F.col("l_returnflag").alias("stage"), F.col("l_linestatus").alias("model"), (F.col("l_quantity") * 1000).cast("bigint").alias("input_tokens"), (F.col("l_linenumber") * 1000).cast("bigint").alias("output_tokens"), F.lit(0).cast("bigint").alias("cache_write_tokens"), F.lit(0).cast("bigint").alias("cache_read_tokens"))
    return R.with_cost(l, F.broadcast(prices))  # two rows


@query("WITH " + USAGE_SQL + " SELECT stage, round(sum(micro)::DOUBLE / 1e6, 4) AS usd, count(*) AS calls FROM usage GROUP BY stage")
def cost_by_stage(read, spark):
    return R.cost_by(usage(read, spark), "stage").withColumn("usd", F.round("usd", 4))


@query("WITH " + USAGE_SQL + " SELECT model, round(sum(micro)::DOUBLE / 1e6, 4) AS usd, count(*) AS calls FROM usage GROUP BY model")
def cost_by_model(read, spark):
    return R.cost_by(usage(read, spark), "model").withColumn("usd", F.round("usd", 4))


@query("WITH " + USAGE_SQL + " SELECT stage, model, CASE WHEN grouping(stage) = 0 THEN 'stage' WHEN grouping(model) = 0 THEN 'model' ELSE 'total' END AS kind, round(sum(micro)::DOUBLE / 1e6, 4) AS usd, count(*) AS calls FROM usage GROUP BY GROUPING SETS ((stage), (model), ())")
def cost_rollup(read, spark):
    return R.cost_rollup(usage(read, spark)).withColumn("usd", F.round("usd", 4)).select("stage", "model", "kind", "usd", "calls")


@query("WITH " + USAGE_SQL + " SELECT round(sum(micro)::DOUBLE / 1e6, 4) AS usd, sum(i)::BIGINT AS input_tokens, sum(o)::BIGINT AS output_tokens, 0::BIGINT AS cache_write_tokens, 0::BIGINT AS cache_read_tokens, count(*) AS calls FROM usage")
def cost_kpis(read, spark):
    return R.cost_totals(usage(read, spark)).withColumn("usd", F.round("usd", 4))


@query("SELECT split_part(l_shipmode, ':', 2) AS chapter, round(sum(u)::DOUBLE, 2) AS usd FROM (SELECT 'chapter:' || l_returnflag AS l_shipmode, l_quantity::DECIMAL(18,2) AS u, l_linestatus FROM lineitem) WHERE l_shipmode <> 'chapter:N' GROUP BY 1")
def chapter_spend(read, spark):
    stage = F.when(F.col("l_returnflag") == "N", "outline").otherwise(F.concat(F.lit("chapter:"), F.col("l_returnflag")))
    return R.chapter_spend(read("lineitem").select(stage.alias("stage"), F.col("l_quantity").alias("usd"))).withColumn("usd", F.round("usd", 2))


@query("""SELECT event_id, coalesce(sum(v) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS spent,
    coalesce(sum(v) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + v > 30000 AS rejected FROM (SELECT *, round(value * 100)::BIGINT AS v FROM events)""")
def budget_running(read, spark):
    e = read("events").withColumn("v", F.round(F.col("value") * 100).cast("bigint"))
    return B.running(e, ["user_id"], ["ts", "event_id"], "v", 30000).select("event_id", "spent", "rejected")


@query("""WITH RECURSIVE r AS (SELECT user_id, event_id, round(value * 100)::BIGINT AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    w AS (SELECT user_id, event_id, n, v <= 30000 AS accepted, CASE WHEN v <= 30000 THEN v ELSE 0 END AS spent FROM r WHERE n = 1
      UNION ALL SELECT r.user_id, r.event_id, r.n, w.spent + v <= 30000, CASE WHEN w.spent + v <= 30000 THEN w.spent + v ELSE w.spent END FROM w JOIN r ON r.user_id = w.user_id AND r.n = w.n + 1)
    SELECT event_id, accepted FROM w""")
def budget_admitted(read, spark):
    e = read("events").select("user_id", "ts", "event_id", F.round(F.col("value") * 100).cast("bigint").alias("v"))
    return B.admit(e, ["user_id"], ["ts", "event_id"], "v", 30000).select("event_id", "accepted")


@query("SELECT total, chapter_total, total + 1 <= 1000 AND chapter_total + 1 <= 1e12 AS accepted FROM (SELECT round(sum(l_quantity)::DOUBLE, 2) AS total, round(sum(l_quantity) FILTER (l_returnflag = 'A')::DOUBLE, 2) AS chapter_total FROM lineitem)")
def budget_check(read, spark):
    log = read("lineitem").select(F.concat(F.lit("chapter:"), F.col("l_returnflag")).alias("stage"), F.col("l_quantity").alias("usd"))
    return B.check(log, 1.0, 1000.0, "A", 1e12).withColumns({c: F.round(c, 2) for c in ("total", "chapter_total")})


#: Snippets made by rule, so that SQL can say what their check finds: by doc_id mod 6.
SNIPPETS_SQL = """s AS (SELECT doc_id, source, CASE WHEN doc_id % 6 = 5 THEN lang || ')' END AS code FROM documents)"""


def snippets(read):
    d, k = F.col("doc_id"), F.col("doc_id") % 6
    code = F.when(k == 0, F.concat(F.lit("x = "), d, F.lit("\nprint(x)"))).when(k == 1, F.lit("def f(:\n  pass")).when(k == 2, F.concat(F.lit("```c\nint main() { return "), d, F.lit("; }\n```")))
    code = code.when(k == 3, F.concat(F.lit('f("(", ['), d)).when(k == 4, F.repeat(F.lit(" "), (d % 9).cast("int"))).otherwise(F.concat("lang", F.lit(")")))
    return read("documents").select("doc_id", "source", code.alias("code"), F.when(k == 0, "py").when(k == 1, " Python ").when(k == 3, "js").alias("hint"))


@query("WITH " + SNIPPETS_SQL + """ SELECT doc_id, doc_id % 6 IN (0, 2) AS parseable, CASE WHEN doc_id % 6 IN (0, 1) THEN 'python' WHEN doc_id % 6 = 4 THEN 'unknown' ELSE 'generic' END AS language,
    CASE doc_id % 6 WHEN 1 THEN 'SyntaxError line 1: invalid syntax' WHEN 3 THEN 'Unclosed: [' || chr(39) || ')' || chr(39) || ', ' || chr(39) || ']' || chr(39) || ']' WHEN 4 THEN 'empty'
      WHEN 5 THEN 'Unmatched bracket ' || chr(39) || ')' || chr(39) || ' at offset ' || (length(code) - 1) ELSE '' END AS reason FROM s""")
def code_check(read, spark):
    return snippets(read).select("doc_id", C.check_code("code", "hint").alias("c")).select("doc_id", "c.*")


@query("WITH " + SNIPPETS_SQL + " SELECT source, count(*) FILTER (doc_id % 6 NOT IN (0, 2)) AS bad FROM s GROUP BY source")
def bad_code_by_source(read, spark):
    return R.bad_code(snippets(read).select("source", C.check_code("code", "hint").alias("c")).select("source", "c.parseable"), "source")


@query(r"""WITH b AS (SELECT doc_id, string_split(regexp_replace(text || CASE doc_id % 5 WHEN 0 THEN '([{' WHEN 1 THEN ')' WHEN 2 THEN '{[()]}' ELSE '' END, '[^()\[\]{}]', '', 'g'), '') AS x FROM (SELECT doc_id, regexp_replace(text, '["''`\\]', '', 'g') AS text FROM documents)),
    f AS (SELECT doc_id, list_reduce(list_prepend('', x), lambda s, c: CASE WHEN s = '!' THEN s WHEN c IN ('(', '[', '{') THEN c || s WHEN c = '' THEN s WHEN left(s, 1) = translate(c, ')]}', '([{') THEN substr(s, 2) ELSE '!' END) AS s FROM b)
    SELECT doc_id, coalesce(s, '') = '' AS balanced FROM f""")
def bracket_balance(read, spark):
    """Whole texts without their quotes, a tail of brackets, and strings, with escapes, whose brackets do not count."""
    k = F.col("doc_id") % 5
    tail = F.when(k == 0, "([{").when(k == 1, ")").when(k == 2, "{[()]}").otherwise("")
    code = F.concat(F.regexp_replace("text", r"[\"'`\\]", ""), tail, F.lit("\"(\\\"[\"'}'`{"))
    return read("documents").select("doc_id", C.balance_column(code).alias("balanced"))
