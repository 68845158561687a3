"""Queries on texts: tokens, blocks, formatting, assembly."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import assembly as A
from attesta.operators import retrieval as R
from attesta.plans.registry import query


@query("SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct FROM (SELECT doc_id, regexp_extract_all(lower(text), '([a-z_][a-z0-9_]*)') AS t FROM documents)")
def tokens(read, spark):
    t = T.identifiers(F.col("text"))
    return read("documents").select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"))


@query("SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '([a-z_][a-z0-9_]*)')) AS term FROM documents) GROUP BY term")
def doc_freq(read, spark):
    return R.document_frequency(read("documents"), "text")


@query("SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '([a-z_][a-z0-9_]*)')) AS term FROM benchmark) GROUP BY ALL")
def term_freq(read, spark):
    return R.term_frequency(read("benchmark"), "item_id", "text")


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda w: w <> ''))::INT AS n_words FROM documents")
def word_count(read, spark):
    return read("documents").select("doc_id", T.words(F.col("text")).alias("n_words"))


@query(r"""WITH w AS (SELECT item_id * 100000 + i AS pos, x[i] AS term FROM (SELECT item_id, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT item_id, list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda t: t <> '') AS x FROM benchmark)))
    SELECT pos, term FROM (SELECT lower(term) AS k, min(pos) AS pos, arg_min(term, pos) AS term FROM w GROUP BY 1) ORDER BY pos LIMIT 200""")
def glossary_dedup(read, spark):
    words = F.filter(F.split("text", r"[ \t\n\r\f]+"), lambda t: t != "")
    terms = read("benchmark").select("item_id", F.posexplode(words).alias("p", "term")).select((F.col("item_id") * 100000 + F.col("p") + 1).alias("pos"), "term")
    return R.first_terms(terms, 200)


@query(r"SELECT doc_id, i::INT AS pos, x[i + 1] AS math FROM (SELECT doc_id, x, unnest(range(len(x))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '\$\$[^$]+\$\$') AS x FROM documents))")
def block_math(read, spark):
    return read("documents").select("doc_id", F.posexplode(T.block_math(F.col("text"))).alias("pos", "math"))


#: A fence stands before every seventh line.
FENCED_SQL = r"""SELECT doc_id, list_reduce(list_transform(string_split(text, chr(10)), lambda l, i: CASE WHEN (i - 1) % 7 = 6 THEN '```' || chr(10) || l ELSE l END), lambda a, b: a || chr(10) || b) AS t FROM documents"""


@query("WITH l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM (" + FENCED_SQL + """)),
    f AS (SELECT *, starts_with(ltrim(line), '```') AS fence FROM l), n AS (SELECT doc_id, count(*) FILTER (fence) AS fences FROM f GROUP BY doc_id)
    SELECT doc_id, (fences + 1) // 2 AS n_code FROM n""")
def code_fence_blocks(read, spark):
    fenced = F.array_join(F.transform(F.split("text", "\n"), lambda l, i: F.when(i % 7 == 6, F.concat(F.lit("```\n"), l)).otherwise(l)), "\n")
    kinds = T.typed_sentences(F.col("t"))
    return read("documents").select("doc_id", fenced.alias("t")).select("doc_id", F.size(F.filter(kinds, lambda s: s["type"] == "code_block")).cast("long").alias("n_code"))


@query("""WITH t AS (SELECT source, doc_id // 50 AS part, doc_id, text || ' [c' || doc_id || ', @c7] end [@c1].' AS t FROM documents)
    SELECT source, part, string_agg(replace(regexp_replace(t, '\\s*\\[@?c\\d+(?:,\\s*@?c\\d+)*\\]', '', 'g'), '−', '-'), chr(10) || chr(10) ORDER BY doc_id) AS text FROM t GROUP BY source, part""")
def manuscript_assembly(read, spark):
    """A manuscript of each source and fifty documents: an outline bounds what is joined into one text."""
    cited = F.concat("text", F.lit(" [c"), "doc_id", F.lit(", @c7] end [@c1]."))
    parts = read("documents").select("source", F.floor(F.col("doc_id") / 50).alias("part"), "doc_id", T.plain_minus(T.drop_citations(cited)).alias("t"))
    return A.joined_texts(parts, ["source", "part"], "doc_id", "t")


@query("""SELECT d.doc_id, CASE WHEN doc_id % 4 = 0 AND doc_id % 3 <> 0 THEN 'fig' || doc_id || '.mmd' WHEN doc_id % 4 = 1 AND doc_id % 3 <> 0 THEN 'fig' || doc_id || '.tex' WHEN url IS NOT NULL THEN 'fig' || doc_id || '.jpg' END AS artifact FROM documents d LEFT JOIN pages ON doc_id = page_id""")
def artifact_resolution(read, spark):
    d = read("documents").join(read("pages").select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left")
    mode = F.when(F.col("doc_id") % 4 == 0, "mermaid").when(F.col("doc_id") % 4 == 1, "tikz").otherwise("embed")
    code = F.when(F.col("doc_id") % 3 != 0, "x")
    return d.select("doc_id", A.artifact(mode, code, F.concat(F.lit("fig"), F.col("doc_id")), F.col("url")).alias("artifact"))


@query(r"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN chr(10) || '```mermaid' || chr(10) || 'g' || chr(10) || '```' || chr(10) || '*Figure: ' || source || '*' || chr(10)
    WHEN 1 THEN chr(10) || '\begin{center}\textit{[Diagram: ' || source || ']}\end{center}' || chr(10)
    WHEN 2 THEN chr(10) || '![' || source || '](p' || doc_id || '){#fig:' || doc_id || '}' || chr(10) ELSE chr(10) || '*[Figure missing: ' || source || ']*' || chr(10) END AS figure FROM documents""")
def figure_texts(read, spark):
    k = F.col("doc_id") % 4
    mode = F.when(k == 0, "mermaid").when(k == 1, "tikz").otherwise("embed")
    path = F.when(k != 3, F.concat(F.lit("p"), F.col("doc_id")))
    return read("documents").select("doc_id", A.figure_text(mode, path, F.col("source"), F.lit("g"), F.concat(F.lit("fig:"), F.col("doc_id")), F.lit(None).cast("string")).alias("figure"))


@query("""SELECT doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS html,
    replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '\\', '\\textbackslash{}'), '&', '\\&'), '%', '\\%'), '$', '\\$'), '#', '\\#'), '_', '\\_'), '^', '\\^{}'), '~', '\\textasciitilde{}'), '{', '\\{'), '}', '\\}') AS latex FROM documents""".replace("\\\\", "\\"))
def escapes(read, spark):
    return read("documents").select("doc_id", T.html_escape(F.col("text")).alias("html"), T.latex_escape(F.col("text")).alias("latex"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]{2,}', ' ', 'g'), '^\s+|\s+$', '', 'g') || chr(10) AS t FROM documents")
def tidy_text(read, spark):
    return read("documents").select("doc_id", T.tidy(F.col("text")).alias("t"))


@query("SELECT o_orderkey, replace(format('{:,}', o_orderkey * 1234), ',', '{,}') AS t FROM orders")
def thousands(read, spark):
    return read("orders").select("o_orderkey", T.thousands(F.col("o_orderkey") * 1234).alias("t"))


@query("""SELECT '@' || CASE WHEN doc_id % 2 = 0 THEN 'article' ELSE 'book' END || '{d' || doc_id || ',' || chr(10) || '  title = {' || source || '},' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN '  author = {' || lang || '},' || chr(10) ELSE '' END || '  year = {' || (2000 + doc_id % 20) || '}' ||
    CASE WHEN doc_id % 2 = 0 THEN ',' || chr(10) || '  eprint = {' || doc_id || '}' ELSE '' END || chr(10) || '}' AS entry, doc_id FROM documents""")
def bibtex_entries(read, spark):
    k = F.col("doc_id")
    entry = T.bibtex(F.concat(F.lit("d"), k), F.col("source"), F.when(k % 3 == 0, F.col("lang")), 2000 + k % 20, F.when(k % 2 == 0, k), F.lit(None).cast("string"))
    return read("documents").select(entry.alias("entry"), "doc_id")


@query("""WITH c AS (SELECT lang, doc_id, [source || '_f0001', source || '_f' || lpad((doc_id % 7)::VARCHAR, 4, '0')] AS f FROM documents), e AS (SELECT lang, doc_id, unnest(f) AS frame_id, unnest([0, 1]) AS p FROM c),
    m AS (SELECT lang, frame_id, min(doc_id * 2 + p) AS o FROM e GROUP BY ALL)
    SELECT lang, frame_id, split_part(frame_id, '_f', 1) AS video_id, row_number() OVER (PARTITION BY lang ORDER BY o) AS pos FROM m WHERE right(frame_id, 1)::INT % 2 = 1""")
def chapter_diagrams(read, spark):
    ids = F.array(F.concat("source", F.lit("_f0001")), F.concat("source", F.lit("_f"), F.lpad((F.col("doc_id") % 7).cast("string"), 4, "0")))
    c = read("documents").select("lang", F.col("doc_id").alias("id"), ids.alias("frame_ids"))
    vision = c.select(F.explode("frame_ids").alias("frame_id")).distinct().withColumn("category", F.when(F.substring("frame_id", -1, 1).cast("int") % 2 == 1, "slide").otherwise("code")).withColumn("title", F.lit(""))
    return A.diagrams_of_claims(c, vision, "lang").select("lang", "frame_id", "video_id", F.col("pos").cast("long").alias("pos"))


@query("""WITH d AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS number FROM documents), m AS (SELECT lang, doc_id AS fig, row_number() OVER (PARTITION BY lang ORDER BY doc_id DESC) AS number FROM documents WHERE doc_id % 2 = 0)
    SELECT lang, doc_id, fig FROM d LEFT JOIN m USING (lang, number)""")
def figures_by_ordinal(read, spark):
    d = read("documents")
    directives = d.select("lang", "doc_id", F.row_number().over(Window.partitionBy("lang").orderBy("doc_id")).alias("number"))
    made = d.where("doc_id % 2 = 0").select("lang", (-F.col("doc_id")).alias("index"), F.col("doc_id").alias("fig"))
    return A.directives_with_figures(directives, made, "lang").select("lang", "doc_id", "fig")
