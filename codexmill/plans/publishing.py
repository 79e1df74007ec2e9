"""Queries behind pages, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill import model as M
from codexmill.functions import text as X
from codexmill.operators import publish
from codexmill.session import table


def metadata_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every statement as its value is shown, links with the target's identifier."""
    t = M.stated(spark, sf_dir)
    names = t.where(F.col("p") == M.IDENTIFIER).groupBy(F.col("s").alias("o")).agg(F.min("o").alias("name"))
    j = t.join(names, "o", "left")
    return j.select("g", "s", "p", publish.rendered_value(F.col("o"), F.col("o_kind"), F.col("o_datatype"), F.col("o_lang"), F.col("name")).alias("html"))


def statute_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nodes").where("withdrawn_at IS NULL").select("doc", "node_id", "node_type", "rubrik", "text", "seq").distinct()
    return publish.statute_pages(n).select("doc", F.md5("html").alias("digest"), F.length("html").alias("n_chars"))


def case_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "dv_cases").select("case_id", "uri", "identifier", "court", "malnummer", "avgorandedatum", "description").distinct()
    meta = {"dct:publisher": F.col("court"), "rinfo:malnummer": F.col("malnummer"), "rinfo:avgorandedatum": F.date_format("avgorandedatum", "yyyy-MM-dd")}
    html = publish.document_page("rinfo:Rattsfallsreferat", F.col("uri"), F.col("identifier"), meta, X.chunks(F.col("description"), X.PARAGRAPH))
    return c.select("case_id", F.md5(html).alias("digest"), F.length(html).alias("n_chars"))


def regulation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of the general form."""
    r = table(spark, sf_dir, "skvfs_regulations").select("reg_id", "basefile", "title", "body").distinct()
    uri = F.concat(F.lit(M.BASE + "/skvfs/"), "basefile")
    html = publish.document_page("rinfo:Myndighetsforeskrift", uri, F.coalesce("title", "basefile"), {"dct:identifier": F.col("basefile")}, X.chunks(F.col("body"), X.PARAGRAPH))
    return r.select("reg_id", F.md5(html).alias("digest"), F.length(html).alias("n_chars"))


def keyword_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases by keyword."""
    t = M.statements(spark, sf_dir)
    names = M.pattern(t, M.IDENTIFIER, "uri", "o").groupBy("uri").agg(F.min("o").alias("title"))
    e = M.pattern(t, M.SUBJECT, "uri", "keyword").join(names, "uri", "left").select("keyword", F.coalesce("title", "uri").alias("title"), "uri")
    return publish.keyword_pages(e)


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "sfs_snapshots").where("title IS NOT NULL AND uri IS NOT NULL").groupBy("uri").agg(F.min("title").alias("title"))
    e = s.select(F.regexp_extract("uri", "/([0-9]{4}):", 1).alias("category"), F.lit("all").alias("page"), F.lower("title").alias("sortkey"), "title", "uri")
    return publish.index_pages(e).select("category", "page", "rank", "title", "uri")


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("source = 'nyheter'")
    first = X.before(F.concat("text", F.lit("\n")), "\n")
    e = d.select(F.col("doc_id").alias("id"), F.coalesce("about", F.lit("")).alias("title"), F.col("about").alias("uri"), F.col("fetched_at").alias("ts"), first.alias("shortdesc"), F.col("text").alias("content"))
    return publish.feed(e)


def layout_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.layout_tables(X.exploded(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", X.LINE))


def layout_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.layout_cells(X.exploded(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", X.LINE))


def lines_in_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readers inside of readers: lines, which never leave their paragraph."""
    p = X.exploded(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", X.PARAGRAPH, "paragraph", "part")
    return X.exploded(p, "part", X.LINE, "line", "chunk")


def landing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years from the first to the last directive, with how many there are: a
    crawl by year would ask for all of them."""
    from codexmill.sources.files import year_number

    r = table(spark, sf_dir, "direktiv_records").select(F.substring_index(year_number(F.col("basefile")), ":", 1).try_cast("int").alias("year"), "record_id").where("year IS NOT NULL")
    years = r.agg(F.min("year").alias("a"), F.max("year").alias("b")).select(F.explode(F.sequence("a", "b")).alias("year"))
    return years.join(r, "year", "left").groupBy("year").agg(F.count("record_id").alias("n"))


_QUERIES = (metadata_rendered, statute_pages, case_pages, regulation_pages, keyword_pages, index_pages, feed_entries, layout_tables, layout_cells, lines_in_paragraphs, landing_years)
QUERIES = {f.__name__: f for f in _QUERIES}


def _esc(c: str) -> str:
    return f"""replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')"""


def _page_sql(kind: str, uri: str, title: str, meta: dict[str, str], body: str) -> str:
    known = " || ".join(f"""coalesce('<dt property="{p}">{p}</dt><dd>' || {_esc(v)} || '</dd>', '')""" for p, v in meta.items())
    parts = f"string_split({body}, chr(10) || chr(10))"
    kept = f"CASE WHEN {parts}[-1] = '' THEN {parts}[1:len({parts}) - 1] ELSE {parts} END"
    text = f"coalesce(array_to_string(list_transform({kept}, lambda x: '<p>' || {_esc('x')} || '</p>'), ''), '')"
    return f"""'<html about="' || {_esc(f"coalesce({uri}, '')")} || '"><head><title>' || {_esc(f"coalesce({title}, '')")} || '</title></head><body typeof="{kind}"><dl>' || {known} || '</dl><div role="main">' || {text} || '</div></body></html>'"""


_LINES = """WITH a AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts FROM a),
l AS (SELECT doc_id, CAST(unnest(range(len(parts))) AS INT) AS pos, unnest(parts) AS chunk FROM b)"""

ORACLE = {
    "case_pages": "WITH p AS (SELECT case_id, " + _page_sql("rinfo:Rattsfallsreferat", "uri", "identifier", {"dct:publisher": "court", "rinfo:malnummer": "malnummer", "rinfo:avgorandedatum": "strftime(avgorandedatum, '%Y-%m-%d')"}, "description")
    + " AS html FROM (SELECT DISTINCT case_id, uri, identifier, court, malnummer, avgorandedatum, description FROM dv_cases)) SELECT case_id, md5(html) AS digest, CAST(length(html) AS INT) AS n_chars FROM p",
    "regulation_pages": "WITH p AS (SELECT reg_id, " + _page_sql("rinfo:Myndighetsforeskrift", "'http://rinfo.example/publ/skvfs/' || basefile", "coalesce(title, basefile)", {"dct:identifier": "basefile"}, "body")
    + " AS html FROM (SELECT DISTINCT reg_id, basefile, title, body FROM skvfs_regulations)) SELECT reg_id, md5(html) AS digest, CAST(length(html) AS INT) AS n_chars FROM p",
    "keyword_pages": """WITH st AS (SELECT DISTINCT s, p, o FROM triples WHERE s IS NOT NULL AND o IS NOT NULL), n AS (SELECT s, min(o) AS title FROM st WHERE p = 'dct:identifier' GROUP BY s),
e AS (SELECT k.o AS keyword, coalesce(n.title, k.s) AS title, k.s AS uri FROM st k LEFT JOIN n USING (s) WHERE k.p = 'dct:subject')
SELECT upper(left(keyword, 1)) AS page, keyword, CAST(row_number() OVER (PARTITION BY keyword ORDER BY title, uri) AS INT) AS rank, title, uri FROM e""",
    "metadata_rendered": f"""WITH st AS (SELECT DISTINCT g, s, p, o, o_kind, o_datatype, o_lang FROM triples WHERE s IS NOT NULL AND o IS NOT NULL),
n AS (SELECT s, min(o) AS name FROM st WHERE p = 'dct:identifier' GROUP BY s)
SELECT g, st.s, p, CASE WHEN o_kind = 'uri' THEN '<a href="' || {_esc('o')} || '">' || {_esc('coalesce(name, o)')} || '</a>' WHEN o_datatype IS NOT NULL THEN '<span datatype="' || o_datatype || '">' || {_esc('o')} || '</span>'
WHEN o_lang IS NOT NULL THEN '<span xml:lang="' || o_lang || '">' || {_esc('o')} || '</span>' ELSE {_esc('o')} END AS html FROM st LEFT JOIN n ON n.s = st.o""",
    "statute_pages": f"""WITH n AS (SELECT DISTINCT doc, node_id, node_type, rubrik, text, seq FROM nodes WHERE withdrawn_at IS NULL),
h AS (SELECT doc, seq, coalesce(node_id, '') AS i, '<div class="' || lower(node_type) || '"' || CASE WHEN node_id IS NOT NULL THEN ' id="' || node_id || '"' ELSE '' END || '>' ||
CASE WHEN rubrik IS NOT NULL THEN '<h2>' || {_esc('rubrik')} || '</h2>' ELSE '' END || {_esc("coalesce(text, '')")} || '</div>' AS html FROM n),
p AS (SELECT doc, string_agg(html, chr(10) ORDER BY seq, i, html) AS html FROM h GROUP BY doc) SELECT doc, md5(html) AS digest, CAST(length(html) AS INT) AS n_chars FROM p""",
    "feed_entries": "SELECT doc_id AS id, coalesce(about, '') AS title, about AS uri, strftime(fetched_at, '%Y-%m-%dT%H:%M:%SZ') AS updated, coalesce(nullif(trim(split_part(text, chr(10), 1)), ''), text) AS summary FROM documents WHERE source = 'nyheter'",
    "layout_tables": _LINES + r""", c AS (SELECT doc_id, pos, list_transform(string_split_regex(trim(chunk, ' '), '\t|\s*\|\s*| {2,}'), lambda x: trim(x, ' ')) AS c FROM l),
t AS (SELECT *, CASE WHEN pos = lag(pos) OVER w + 1 THEN 0 ELSE 1 END AS fresh FROM c WHERE len(c) > 1 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
u AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS INT) AS table_no FROM t)
SELECT doc_id, table_no, CAST(row_number() OVER (PARTITION BY doc_id, table_no ORDER BY pos) AS INT) AS row_no, CAST(len(c) AS INT) AS n_cells, c[1] AS first, c[-1] AS last FROM u""",
    "layout_cells": _LINES + r""", c AS (SELECT doc_id, pos, list_transform(string_split_regex(trim(chunk, ' '), '\t|\s*\|\s*| {2,}'), lambda x: trim(x, ' ')) AS c FROM l),
t AS (SELECT *, CASE WHEN pos = lag(pos) OVER w + 1 THEN 0 ELSE 1 END AS fresh FROM c WHERE len(c) > 1 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
u AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS INT) AS table_no FROM t)
SELECT doc_id, table_no, CAST(row_no AS INT) AS row_no, CAST(unnest(range(len(c))) AS INT) AS cell_no, unnest(c) AS cell FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, table_no ORDER BY pos) AS row_no FROM u)""",
    "lines_in_paragraphs": """WITH a AS (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts FROM a),
c AS (SELECT doc_id, CAST(unnest(range(len(parts))) AS INT) AS paragraph, string_split(unnest(parts), chr(10)) AS parts FROM b),
d AS (SELECT doc_id, paragraph, CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts FROM c)
SELECT doc_id, paragraph, CAST(unnest(range(len(parts))) AS INT) AS line, unnest(parts) AS chunk FROM d""",
    "landing_years": r"""WITH r AS (SELECT CAST(regexp_extract(basefile, '([0-9]{4})\s*[:/]\s*([0-9]+)', 1) AS INT) AS year FROM direktiv_records WHERE regexp_matches(basefile, '([0-9]{4})\s*[:/]\s*([0-9]+)')),
y AS (SELECT CAST(unnest(range(min(year), max(year) + 1)) AS INT) AS year FROM r) SELECT y.year, count(r.year) AS n FROM y LEFT JOIN r ON r.year = y.year GROUP BY y.year""",
}
