"""Queries behind readers, stores and streams, and their SQL.

The corpus comes as tables; here what they hold is first written in the format
that a reader is for (a query result document, a wiki export, a dictionary in
Turtle, an export with tabs, ...), into the shared folder, and then read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexmill import model as M
from codexmill.functions import citations, markup
from codexmill.functions import text as X
from codexmill.operators import publish, store
from codexmill.operators.closure import closure_sql
from codexmill.plans import graph
from codexmill.plans.documents_sql import nr_sql, slug_sql
from codexmill.session import materialize, scratch, table
from codexmill.sources import files, rdfxml
from codexmill.sources.repositories import Repository, newest, unseen
from codexmill.streaming import refresh

ORG = M.BASE.rsplit("/", 1)[0] + "/org/"
#: About as many bytes has an RDF/XML document before compression, and so many the tags of a statement.
DOCUMENT_BYTES, TAG_BYTES = 8 << 20, 100


def _written(lines: DataFrame, label: str) -> str:
    """Folder of text files that hold the lines (one column)."""
    path = scratch(lines.sparkSession, label)
    lines.write.text(path)
    return path


def _documents(rows: DataFrame, label: str, root: str, parts: int = 8, compression: str = "none") -> str:
    """Folder of well-formed XML files of the elements in the rows (one column)."""
    spark, path = rows.sparkSession, scratch(rows.sparkSession, label)
    x = rows.select(F.col(rows.columns[0]).alias("value"), F.lit(1).alias("at"), F.pmod(F.xxhash64(rows.columns[0]), F.lit(parts)).alias("part"))
    for at, tag in ((0, f"<{root}>"), (2, f"</{root.split()[0]}>")):
        x = x.unionByName(spark.range(parts).select(F.lit(tag).alias("value"), F.lit(at).alias("at"), F.col("id").alias("part")))
    x.repartition("part").sortWithinPartitions("part", "at").select("value", "part").write.partitionBy("part").text(path, compression)
    return path


def _xml(c: Column) -> Column:
    return publish.escaped(c)


def result_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers as a result document of the graph server, read back; acts
    that have none are results with an unbound variable."""
    t = M.stated(spark, sf_dir)
    named = M.pattern(t, M.IDENTIFIER, "uri", "id")
    rows = named.unionByName(t.select(F.col("s").alias("uri")).distinct().join(named, "uri", "left_anti").withColumn("id", F.lit(None).cast("string")))
    bound = lambda name, kind, c: F.concat(F.lit(f"<binding name='{name}'><{kind}>"), _xml(c), F.lit(f"</{kind}></binding>"))
    lines = rows.select(F.concat(F.lit("<result>"), bound("uri", "uri", F.col("uri")), F.coalesce(bound("id", "literal", F.col("id")), F.lit("")), F.lit("</result>")).alias("value"))
    return files.query_results(spark, _documents(lines, "results", "results"), ["uri", "id"])


def _concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.regexp_extract("text", r"^'''([^']+)'''", 1)
    return table(spark, sf_dir, "documents").where("source = 'wiki'").select(name.alias("name"), F.col("doc_id")).where("name <> ''")


def wiki_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a wiki export and redirects to them from names in capitals,
    each title with where it leads."""
    names = _concepts(spark, sf_dir).select("name").distinct()
    page = lambda title, text: F.concat(F.lit("<page><title>"), _xml(title), F.lit("</title><revision><text>"), _xml(text), F.lit("</text></revision></page>"))
    lines = names.select(page(F.col("name"), F.concat(F.lit("Om "), "name")).alias("value"))
    upper = names.where(F.upper("name") != F.col("name")).groupBy(F.upper("name").alias("upper")).agg(F.min("name").alias("name"))
    lines = lines.unionByName(upper.select(page(F.col("upper"), F.concat(F.lit("#OMDIRIGERING [["), "name", F.lit("]]"))).alias("value")))
    return files.resolved(files.wiki_export(spark, _documents(lines, "wiki", "mediawiki")))


def _org_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary of organisations in Turtle, two statements each."""
    orgs = table(spark, sf_dir, "sfs_snapshots").where("creator IS NOT NULL").select("creator").distinct()
    uri = F.concat(F.lit("<" + ORG), X.slug(F.col("creator")), F.lit(">"))
    both = F.array(F.concat(uri, F.lit(' rdfs:label "'), "creator", F.lit('"@sv ;')), F.concat(F.lit('  dct:type "organisation" .')))
    return orgs.select("creator", F.posexplode(both).alias("k", "value"))


def turtle_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The organisations' dictionary, read statement by statement."""
    lines = _org_lines(spark, sf_dir)
    rank = F.dense_rank().over(Window.orderBy("creator"))
    rows = materialize(lines.select((rank * 2 + F.col("k")).alias("pos"), "value"), "turtle")
    return files.turtle_lines(rows, "orgs").select("g", "s", "p", "o", "o_kind", "o_lang")


def authority_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts by the organisation that issued them: its label is looked up in the
    dictionary; labels that it lacks stay without a URI."""
    labels = store.labelled(turtle_dictionary(spark, sf_dir), "rdfs:label")
    s = table(spark, sf_dir, "sfs_snapshots").where("uri IS NOT NULL").select("uri", F.coalesce("creator", F.lit("okänd")).alias("label")).distinct()
    return s.join(labels.withColumnRenamed("uri", "org_uri"), "label", "left").groupBy("org_uri", "label").agg(F.count("*").alias("acts"))


def listed_provisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of cited acts and provisions, a line each, read and counted."""
    cited = M.pattern(M.statements(spark, sf_dir), M.LAGRUM_P, "case", "o").select(F.regexp_extract("o", "/sfs/(.*)$", 1).alias("value")).where("value <> ''").distinct()
    lines = spark.read.text(_written(cited, "list"))
    return files.list_lines(lines).groupBy("doc").agg(F.count("*").alias("n"), F.count("fragment").alias("n_fragments"), F.max("fragment").alias("last"))


def area_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts as an export with tabs and quotes, by area (their organisation);
    rows of another width are left out by the reader."""
    s = table(spark, sf_dir, "sfs_snapshots").where("uri IS NOT NULL AND creator IS NOT NULL AND fsnummer IS NOT NULL").select("creator", "fsnummer").distinct()
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    line = F.concat_ws("\t", quoted(F.col("creator")), quoted(F.col("fsnummer")), F.substring_index("fsnummer", ":", -1), F.left("fsnummer", F.lit(4)), F.lit(""), F.lit('"x"'))
    lines = s.select(line.alias("value")).unionByName(s.select(quoted(F.col("creator")).alias("value")).distinct())
    by = files.by_area(files.area_export(spark.read.text(_written(lines, "export"))))
    return by.select("area", F.size("entries").alias("n"), F.col("entries")[0]["title"].alias("first"), F.array_max(F.transform("entries", lambda e: e["year"])).alias("newest"))


def simple_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns under one title."""
    n = table(spark, sf_dir, "nodes").where("doc IS NOT NULL AND rubrik IS NOT NULL AND node_id IS NOT NULL").select("doc", "node_id", "rubrik").distinct()
    lines = n.select(F.concat_ws("\t", "doc", "node_id", "rubrik").alias("value"))
    return files.simple_list(spark, _written(lines, "simple"), "Rubriker").groupBy("area", "doc").agg(F.count("*").alias("n"), F.min("note").alias("first"))


REPOSITORIES = (
    Repository("trips", "http://trips.example/{year}/{number}", "{yy}/{yy}{nnnn}.html"),
    Repository("asp", "http://asp.example/dir{yy}{nnnn}", "{year}/dir{year}_{number}.html", skip="bilaga"),
)
# Settings as the pipeline's configuration files have them.
SETTINGS = "[DEFAULT]\nprocesses = 1\nencoding = iso-8859-1\n[trips]\nencoding = utf-8\n[asp]\nprocesses = 4\n"


def landing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a crawl of two repositories finds in links to directives, where each
    document is and goes, and whether it has landed."""
    r = table(spark, sf_dir, "direktiv_records").select(F.col("basefile").alias("text"), "record_id", "subrepo")
    links = r.select("text", F.concat(F.lit("http://x.example/"), F.col("record_id").cast("string")).alias("url"))
    landed = r.where("subrepo = 'dir-trips'").select(F.lit("trips").alias("source"), files.year_number(F.col("text")).alias("basefile"))
    out = None
    for repo in REPOSITORIES:
        found = repo.found(links)
        todo = unseen(found, landed).select("source", "basefile").withColumn("todo", F.lit(True))
        rows = repo.located(found.withColumnRenamed("url", "link")).join(todo, ["source", "basefile"], "left").withColumn("todo", F.coalesce("todo", F.lit(False)))
        out = rows if out is None else out.unionByName(rows)
    return out.select("source", "basefile", "link", "url", "path", "todo")


def newest_directive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest directive, which a quick update fetches: one row by purpose."""
    r = table(spark, sf_dir, "direktiv_records").select(files.year_number(F.col("basefile")).alias("basefile")).where("basefile IS NOT NULL").distinct()
    return newest(r)


def source_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(s, k, v) for s in ("trips", "asp", "other") for k, v in files.settings(SETTINGS, s).items()]
    return spark.createDataFrame(rows, "source string, name string, value string")


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regulations as one file each in ISO-8859-1, read whole and decoded; a
    character that the encoding lacks shows as '?'. The second read takes only
    what changed since the first: nothing."""
    b = table(spark, sf_dir, "skvfs_regulations").where("body IS NOT NULL").select("reg_id", "body").distinct()
    path = scratch(spark, "files")
    b.select("reg_id", F.base64(F.encode(F.regexp_replace("body", "[^\\x{0}-\\x{ff}]", "?"), "iso-8859-1")).alias("value")).repartition("reg_id").write.partitionBy("reg_id").option("maxRecordsPerFile", 1).text(path)
    raw = spark.read.option("recursiveFileLookup", "true")
    f = raw.format("binaryFile").load(path).where("length > 0")
    f = f.select("path", F.col("modificationTime").alias("modified"), F.regexp_extract("path", "reg_id=([0-9]+)", 1).cast("bigint").alias("reg_id"), F.unbase64(F.trim(F.decode("content", "utf-8"), F.lit("\n"))).alias("content"))
    again = files.changed_since(f, f.select("path", "modified")).count()
    return f.select("reg_id", F.md5(F.decode("content", "iso-8859-1")).alias("digest"), F.lit(again).cast("bigint").alias("changed"))


def decoded_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles as bytes in either encoding, told apart by whether they are valid
    UTF-8: in ISO-8859-1 only such titles are written whose bytes are not."""
    t = table(spark, sf_dir, "sfs_snapshots").where("title IS NOT NULL").select("title").distinct()
    narrow = t.where(~F.col("title").rlike("[^\\x{0}-\\x{ff}]|[\\x{c2}-\\x{f4}][\\x{80}-\\x{bf}]"))
    both = t.select("title", F.encode("title", "utf-8").alias("bytes")).unionByName(narrow.select("title", F.encode("title", "iso-8859-1").alias("bytes")))
    return both.groupBy((publish.decoded(F.col("bytes")) == F.col("title")).alias("same")).agg(F.count("*").alias("n"))


def pages_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts cut into pages at form feeds; here every paragraph begins a page."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n\n"), F.lit("\f")).alias("text"))
    return X.exploded(d, "text", X.PAGE, "page", "chunk").select("doc_id", "page", F.md5("chunk").alias("digest"))


def store_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triples put into a store twice, which holds them once."""
    path, t = scratch(spark, "store"), M.statements(spark, sf_dir)
    for _ in range(2):
        store.add(t, path)
    return store.read(spark, path).groupBy("g", "p").agg(F.count("*").alias("n"))


def _withdrawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is now stated about withdrawn cases: one statement, in another graph."""
    gone = table(spark, sf_dir, "dv_cases").where("withdrawn_at IS NOT NULL AND uri IS NOT NULL").select("uri").distinct()
    none = F.lit(None).cast("string")
    return gone.select(F.lit("log").alias("g"), F.col("uri").alias("s"), F.lit("rinfoex:status").alias("p"), F.lit("withdrawn").alias("o"), F.lit("literal").alias("o_kind"), none.alias("o_datatype"), none.alias("o_lang"))


def store_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store after what it said about withdrawn cases was replaced."""
    path = scratch(spark, "store")
    store.add(M.statements(spark, sf_dir), path)
    store.replace_subjects(_withdrawn(spark, sf_dir), path)
    return store.read(spark, path).groupBy("g", "p").agg(F.count("*").alias("n"))


def stream_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stream: statements are appended, then replaced."""
    path, feed, news, cp = (scratch(spark, x) for x in ("store", "feed", "news", "checkpoint"))
    M.statements(spark, sf_dir).write.parquet(feed)
    refresh.append_new(refresh.watched(spark, feed, M.TRIPLES), path, cp + "/1").awaitTermination()
    _withdrawn(spark, sf_dir).write.parquet(news)
    refresh.replace_subjects(refresh.watched(spark, news, M.TRIPLES), path, cp + "/2").awaitTermination()
    return store.read(spark, path).groupBy("g", "p").agg(F.count("*").alias("n"))


def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages regenerated from saved edits, the newest of each; here an edit is a
    document about an act, and one without a type is minor."""
    d = table(spark, sf_dir, "documents").where("about IS NOT NULL")
    saved = d.select(F.col("about").alias("title"), F.col("doc_id").cast("string").alias("text"), F.col("doc_type").isNull().alias("minor"), F.struct("fetched_at", "doc_id").alias("at"))
    edits, out, cp = (scratch(spark, x) for x in ("edits", "pages", "checkpoint"))
    last = saved.groupBy("title", "minor").agg(F.max_by("text", "at").alias("text"), F.max("at.fetched_at").alias("saved_at"))
    last.write.parquet(edits)
    stream = refresh.watched(spark, edits, "title string, minor boolean, text string, saved_at timestamp")
    refresh.regenerated(stream, lambda x: x.select("title", "text"), out, cp).awaitTermination()
    return spark.read.parquet(out).select("title", "text")


def newest_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest id seen in each source, from which a later fetch goes on."""
    return refresh.newest_key(table(spark, sf_dir, "triples"), "triple_id").unionByName(refresh.newest_key(table(spark, sf_dir, "direktiv_records").withColumnRenamed("record_id", "triple_id"), "triple_id"))


def _root(spark: SparkSession, sf_dir: str) -> str:
    """The act that comes first: a parameter, one string."""
    first = graph.part_of(M.statements(spark, sf_dir)).where(M.is_act(F.col("parent"))).agg(F.min("parent")).collect()[0][0]
    return first or f"{M.BASE}/sfs/0000:0"


def inbound_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to one act and all that it contains, in order."""
    root = spark.range(1).select(F.lit(_root(spark, sf_dir)).alias("root"))
    return graph.inbound_of(M.statements(spark, sf_dir), root)


def contained_in_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one act contains, by a recursive query with the act as parameter."""
    return closure_sql(spark, graph.part_of(M.statements(spark, sf_dir)), _root(spark, sf_dir))


def blank_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers without a name of their own: how often each is referred to,
    and whether it is written inside the one that refers to it."""
    e = graph.part_of(M.statements(spark, sf_dir))
    name = lambda c: F.md5(c)
    t = e.select(F.col("child").alias("s"), F.lit(M.PART_OF).alias("p"), name(F.col("parent")).alias("o"), F.lit("bnode").alias("o_kind"))
    own = e.select(F.concat(F.lit("_:"), name(F.col("parent"))).alias("s"), F.lit("rdf:type").alias("p"), F.lit("container").alias("o"), F.lit("literal").alias("o_kind")).distinct()
    return store.inlined_blank_nodes(t.unionByName(own)).groupBy("inlined").agg(F.count("*").alias("n"), F.sum("refs").cast("bigint").alias("refs"))


def page_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of a page that may be edited, by name."""
    d = table(spark, sf_dir, "dv_cases").select("case_id", F.coalesce("identifier", F.lit("")).alias("a"), F.coalesce("description", F.lit("")).alias("b")).distinct()
    page = F.concat(F.lit("<html><!--start:title-->"), "a", F.lit("<!--end:title--> <!--start:text-->"), "b", F.lit("<!--end:text--></html>"))
    return d.select("case_id", F.explode(markup.slots(page)).alias("x")).select("case_id", "x.slot", "x.body")


def xhtml_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes in the intermediate form as XHTML; notes are left out."""
    n = table(spark, sf_dir, "nodes").where("rubrik IS NOT NULL").select("doc", "node_id", "node_type", "rubrik").distinct()
    n = n.withColumn("role", F.when(F.col("node_type") == "Overgangsbestammelse", "note").otherwise(F.lower("node_type")))
    xml = F.concat(F.lit('<section role="'), "role", F.lit('"><h>'), _xml(F.col("rubrik")), F.lit("</h></section>"))
    return publish.without_roles(n, "role").select("doc", "node_id", publish.as_xhtml(xml).alias("xhtml"))


def short_title_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations by short title, each title of the dictionary once: a join with
    the dictionary gives the act, the text its provision."""
    labels = store.labelled(files.short_titles(spark), "dct:alternate")
    cite = F.concat("label", F.lit(" 5:1 2 st. och "), "label", F.lit(" 22:2"))
    runs = labels.select("label", F.explode(citations.linked(citations.SHORT_TITLES)(cite, F.lit("9999:999"))).alias("run"))
    return runs.where("run.uri IS NOT NULL").join(labels, "label").select("label", "run.text", F.regexp_replace("run.uri", "^.*/sfs/", "").alias("target"), F.regexp_replace("uri", "^.*/sfs/", "").alias("act"))


def rdf_xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements written as RDF/XML and read again: by predicate, kind and
    language, how many came back. There are more documents where there is more
    to write, not larger ones."""
    t = M.stated(spark, sf_dir)
    size = F.sum(F.octet_length("s") + F.octet_length("p") + F.octet_length("o") + TAG_BYTES)
    parts = (M.statements(spark, sf_dir).agg(size).collect()[0][0] or 0) // DOCUMENT_BYTES + 1
    head, _, _ = store.ENVELOPES["xml"]
    path = _documents(store.serialized(t, "xml"), "rdfxml", head[1:-1], parts, "gzip")
    again = rdfxml.read(spark, path, "again").select("s", "p", "o", "o_kind", "o_datatype", "o_lang").distinct()
    return again.groupBy("p", "o_kind", "o_datatype", "o_lang").agg(F.count("*").alias("n"), F.max("o").alias("last"))


def serialisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases' statements in every form, by form and line."""
    t = M.stated(spark, sf_dir).where("g = 'dv'")
    out = None
    for form in ("nt", "nq", "ttl", "trig", "xml", "trix", "json"):
        rows = store.serialized(t, form).select(F.lit(form).alias("form"), "line")
        out = rows if out is None else out.unionByName(rows)
    return out


def encoded_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URIs as parts of another URI, and as links."""
    u = M.stated(spark, sf_dir).select(F.col("s").alias("uri")).distinct()
    return u.select("uri", X.encode_uri(F.col("uri")).alias("part"), X.encode_uri(F.concat("uri", F.lit("?å ä")), False).alias("link"))


_QUERIES = (
    rdf_xml_documents, serialisations, encoded_uris, result_documents, wiki_redirects, turtle_dictionary, authority_join, listed_provisions, area_export, simple_list, landing_links, newest_directive, source_settings,
    text_files, decoded_bytes, pages_of_text, store_added, store_replaced, stream_replaced, stream_pages, newest_key, inbound_one, contained_in_one, blank_nodes, page_slots,
    xhtml_nodes, short_title_links,
)
QUERIES = {f.__name__: f for f in _QUERIES}

_STATED = "SELECT DISTINCT g, s, p, o, o_kind, o_datatype, o_lang FROM triples WHERE s IS NOT NULL AND o IS NOT NULL"
_GONE = "SELECT DISTINCT uri FROM dv_cases WHERE withdrawn_at IS NOT NULL AND uri IS NOT NULL"
_REPLACED = f"""WITH st AS ({_STATED}) SELECT g, p, count(*) AS n FROM st WHERE s NOT IN ({_GONE}) GROUP BY g, p
UNION ALL SELECT 'log' AS g, 'rinfoex:status' AS p, count(*) AS n FROM ({_GONE}) HAVING count(*) > 0"""
_ORG_SQL = f"'{ORG}' || {slug_sql('creator')}"
_NAMES = "SELECT DISTINCT regexp_extract(text, '^''''''([^'']+)''''''', 1) AS name FROM documents WHERE source = 'wiki'"
_ROOT = "(SELECT min(parent) FROM e WHERE starts_with(parent, 'http://rinfo.example/publ/sfs/') AND NOT contains(parent, '#'))"


def _located(name: str, url: str, path: str, landed: str) -> str:
    return f"""SELECT '{name}' AS source, nr AS basefile, min('http://x.example/' || record_id) AS link, {url} AS url, {path} AS path, {landed} AS todo FROM r GROUP BY nr"""


_Y, _N = "split_part(nr, ':', 1)", "split_part(nr, ':', 2)"
_BRACED = lambda c: f"'<' || {c} || '>'"
_FULL = "CASE split_part(p, ':', 1) " + " ".join(f"WHEN '{k}' THEN '{v}' || substr(p, {len(k) + 2})" for k, v in M.PREFIXES.items()) + " ELSE p END"
_NT_ESC = "replace(replace(replace(replace(replace(o, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"
_NT_O = f"CASE WHEN o_kind = 'uri' THEN {_BRACED('o')} ELSE '\"' || {_NT_ESC} || '\"' || CASE WHEN o_lang IS NOT NULL THEN '@' || o_lang WHEN o_datatype IS NOT NULL THEN '^^<' || replace(o_datatype, 'xsd:', '{M.PREFIXES['xsd']}') || '>' ELSE '' END END"
_X = lambda c: f"""replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')"""
_JS = lambda c: f"to_json({c})"
ORACLE = {
    "rdf_xml_documents": f"SELECT p, o_kind, o_datatype, o_lang, count(*) AS n, max(o) AS last FROM (SELECT DISTINCT s, p, o, o_kind, o_datatype, o_lang FROM ({_STATED})) GROUP BY p, o_kind, o_datatype, o_lang",
    "serialisations": f"""WITH st AS (SELECT *, {_BRACED("s")} AS a, {_BRACED(_FULL)} AS b, {_NT_O} AS c FROM ({_STATED}) WHERE g = 'dv')
SELECT 'nt' AS form, a || ' ' || b || ' ' || c || ' .' AS line FROM st UNION ALL SELECT 'nq', a || ' ' || b || ' ' || c || ' <' || g || '> .' FROM st
UNION ALL SELECT 'ttl', a || ' ' || p || ' ' || c || ' .' FROM st UNION ALL SELECT 'trig', '<' || g || '> {{ ' || a || ' ' || p || ' ' || c || ' }}' FROM st
UNION ALL SELECT 'xml', '<rdf:Description rdf:about="' || {_X("s")} || '">' || CASE WHEN o_kind = 'uri' THEN '<' || p || ' rdf:resource="' || {_X("o")} || '"/>' ELSE '<' || p ||
  CASE WHEN o_lang IS NOT NULL THEN ' xml:lang="' || o_lang || '"' WHEN o_datatype IS NOT NULL THEN ' rdf:datatype="' || o_datatype || '"' ELSE '' END || '>' || {_X("o")} || '</' || p || '>' END || '</rdf:Description>' FROM st
UNION ALL SELECT 'trix', '<graph><uri>' || g || '</uri><triple><uri>' || {_X("s")} || '</uri><uri>' || {_FULL} || '</uri>' || CASE WHEN o_kind = 'uri' THEN '<uri>' || {_X("o")} || '</uri>'
  WHEN o_lang IS NOT NULL THEN '<plainLiteral xml:lang="' || o_lang || '">' || {_X("o")} || '</plainLiteral>' WHEN o_datatype IS NOT NULL THEN '<typedLiteral datatype="' || o_datatype || '">' || {_X("o")} || '</typedLiteral>'
  ELSE '<plainLiteral>' || {_X("o")} || '</plainLiteral>' END || '</triple></graph>' FROM st
UNION ALL SELECT 'json', '{{"s":{{"type":"uri","value":' || {_JS("s")} || '}},"p":{{"type":"uri","value":' || {_JS(_FULL)} || '}},"o":{{"type":"' || o_kind || '","value":' || {_JS("o")} ||
  CASE WHEN o_lang IS NOT NULL THEN ',"xml:lang":"' || o_lang || '"' ELSE '' END || CASE WHEN o_datatype IS NOT NULL THEN ',"datatype":"' || o_datatype || '"' ELSE '' END || '}}}}' FROM st""",
    "encoded_uris": """WITH u AS (SELECT DISTINCT s AS uri FROM triples WHERE s IS NOT NULL AND o IS NOT NULL) SELECT uri, url_encode(uri) AS part,
replace(replace(replace(replace(url_encode(uri || '?å ä'), '%3A', ':'), '%2F', '/'), '%3F', '?'), '%23', '%23') AS link FROM u""",
    "result_documents": f"""WITH st AS ({_STATED}), i AS (SELECT DISTINCT s, o FROM st WHERE p = 'dct:identifier')
SELECT s AS uri, trim(o) AS id FROM i UNION ALL SELECT DISTINCT s, CAST(NULL AS VARCHAR) FROM st WHERE s NOT IN (SELECT s FROM i)""",
    "wiki_redirects": f"""WITH n AS ({_NAMES}) SELECT name AS title, name AS target FROM n WHERE name <> '' UNION ALL SELECT upper(name), min(name) FROM n WHERE name <> '' AND upper(name) <> name GROUP BY upper(name)""",
    "turtle_dictionary": f"""WITH c AS (SELECT DISTINCT creator FROM sfs_snapshots WHERE creator IS NOT NULL)
SELECT 'orgs' AS g, {_ORG_SQL} AS s, 'rdfs:label' AS p, creator AS o, 'literal' AS o_kind, 'sv' AS o_lang FROM c UNION ALL SELECT 'orgs', {_ORG_SQL}, 'dct:type', 'organisation', 'literal', NULL FROM c""",
    "authority_join": f"""SELECT CASE WHEN creator IS NOT NULL THEN {_ORG_SQL} END AS org_uri, coalesce(creator, 'okänd') AS label, count(*) AS acts
FROM (SELECT DISTINCT uri, creator FROM sfs_snapshots WHERE uri IS NOT NULL) GROUP BY creator""",
    "listed_provisions": r"""WITH v AS (SELECT DISTINCT trim(regexp_extract(o, '/sfs/(.*)$', 1)) AS v FROM triples WHERE p = 'rinfo:lagrum' AND s IS NOT NULL AND o IS NOT NULL),
f AS (SELECT split_part(v, '#', 1) AS doc, nullif(regexp_extract(v, '#(.*)$', 1), '') AS fragment FROM v WHERE v <> '')
SELECT doc, count(*) AS n, count(fragment) AS n_fragments, max(fragment) AS last FROM f GROUP BY doc""",
    "area_export": """SELECT creator AS area, CAST(count(DISTINCT fsnummer) AS INT) AS n, min(fsnummer) AS first, max(left(fsnummer, 4)) AS newest
FROM sfs_snapshots WHERE uri IS NOT NULL AND creator IS NOT NULL AND fsnummer IS NOT NULL GROUP BY creator""",
    "simple_list": """SELECT 'Rubriker' AS area, doc, count(*) AS n, min(rubrik) AS first FROM (SELECT DISTINCT doc, node_id, rubrik FROM nodes WHERE doc IS NOT NULL AND rubrik IS NOT NULL AND node_id IS NOT NULL) GROUP BY doc""",
    "landing_links": f"""WITH r AS (SELECT *, {nr_sql()} AS nr FROM direktiv_records WHERE regexp_matches(basefile, '([0-9]{{4}})\\s*[:/]\\s*([0-9]+)'))
{_located("trips", f"'http://trips.example/' || {_Y} || '/' || {_N}", f"'trips/' || substr({_Y}, 3, 2) || '/' || substr({_Y}, 3, 2) || lpad({_N}, 4, '0') || '.html'", "NOT bool_or(coalesce(subrepo, '') = 'dir-trips')")}
UNION ALL {_located("asp", f"'http://asp.example/dir' || substr({_Y}, 3, 2) || lpad({_N}, 4, '0')", f"'asp/' || {_Y} || '/dir' || {_Y} || '_' || {_N} || '.html'", "true")}""",
    "newest_directive": f"""WITH r AS (SELECT DISTINCT {nr_sql()} AS basefile FROM direktiv_records WHERE regexp_matches(basefile, '([0-9]{{4}})\\s*[:/]\\s*([0-9]+)'))
SELECT basefile FROM r ORDER BY CAST(split_part(basefile, ':', 1) AS INT) DESC, CAST(split_part(basefile, ':', 2) AS INT) DESC LIMIT 1""",
    "source_settings": "SELECT * FROM (VALUES ('trips', 'processes', '1'), ('trips', 'encoding', 'utf-8'), ('asp', 'processes', '4'), ('asp', 'encoding', 'iso-8859-1'), ('other', 'processes', '1'), ('other', 'encoding', 'iso-8859-1')) v(source, name, value)",
    "text_files": r"SELECT DISTINCT reg_id, md5(regexp_replace(body, '[^\x00-\x{ff}]', '?', 'g')) AS digest, CAST(0 AS BIGINT) AS changed FROM skvfs_regulations WHERE body IS NOT NULL",
    "decoded_bytes": r"""WITH t AS (SELECT DISTINCT title FROM sfs_snapshots WHERE title IS NOT NULL)
SELECT true AS same, count(*) + count(*) FILTER (NOT regexp_matches(title, '[^\x00-\x{ff}]|[\x{c2}-\x{f4}][\x{80}-\x{bf}]')) AS n FROM t HAVING count(*) > 0""",
    "pages_of_text": """WITH a AS (SELECT doc_id, string_split(replace(text, chr(10) || chr(10), chr(12)), chr(12)) AS parts FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts FROM a),
c AS (SELECT doc_id, CAST(unnest(range(len(parts))) AS INT) AS page, unnest(parts) AS chunk FROM b) SELECT doc_id, page, md5(chunk) AS digest FROM c""",
    "store_added": f"SELECT g, p, count(*) AS n FROM ({_STATED}) GROUP BY g, p",
    "store_replaced": _REPLACED,
    "stream_replaced": _REPLACED,
    "stream_pages": "SELECT about AS title, CAST(arg_max(doc_id, {'a': fetched_at, 'b': doc_id}) AS VARCHAR) AS text FROM documents WHERE about IS NOT NULL AND doc_type IS NOT NULL GROUP BY about",
    "newest_key": "SELECT max(triple_id) AS triple_id FROM triples UNION ALL SELECT max(record_id) FROM direktiv_records",
    "inbound_one": graph.T_SQL + f"SELECT root, uri, CAST(NULL AS VARCHAR) AS label, lagrum FROM (SELECT DISTINCT s AS uri, o AS lagrum FROM t WHERE p = 'dct:references') r JOIN star ON star.node = r.lagrum WHERE root = {_ROOT}",
    "contained_in_one": graph.T_SQL + f"SELECT node FROM star WHERE root = {_ROOT}",
    "blank_nodes": """WITH e AS (SELECT DISTINCT s, o FROM triples WHERE p = 'dct:isPartOf' AND s IS NOT NULL AND o IS NOT NULL), r AS (SELECT o, count(*) AS refs FROM e GROUP BY o)
SELECT refs < 2 AS inlined, count(*) AS n, CAST(sum(refs) AS BIGINT) AS refs FROM r GROUP BY 1""",
    "page_slots": """WITH d AS (SELECT DISTINCT case_id, coalesce(identifier, '') AS a, coalesce(description, '') AS b FROM dv_cases)
SELECT case_id, 'title' AS slot, a AS body FROM d UNION ALL SELECT case_id, 'text', b FROM d""",
    "xhtml_nodes": """SELECT doc, node_id, '<div class="' || lower(node_type) || '"><h2>' || replace(replace(replace(replace(rubrik, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</h2></div>' AS xhtml
FROM (SELECT DISTINCT doc, node_id, node_type, rubrik FROM nodes WHERE rubrik IS NOT NULL) WHERE node_type <> 'Overgangsbestammelse'""",
    "short_title_links": "WITH d(label, act) AS (VALUES " + ", ".join(f"('{t}', '{n}')" for t, n in citations.SHORT_TITLES.items())
    + ") SELECT label, label || ' 5:1 2 st.' AS text, act || '#K5P1S2' AS target, act FROM d UNION ALL SELECT label, label || ' 22:2', act || '#K22P2', act FROM d",
}
