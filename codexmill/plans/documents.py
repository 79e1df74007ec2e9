"""Queries on texts, URIs, provisions and repositories, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexmill import model as M
from codexmill.functions import citations as C
from codexmill.functions import markup, text as X, uri as U
from codexmill.operators import store, tree
from codexmill.session import table
from codexmill.sources import files


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text")


def _uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = M.stated(spark, sf_dir)
    return t.select(F.col("s").alias("uri")).union(t.where("o_kind = 'uri'").select("o")).distinct()


def uri_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _uris(spark, sf_dir).select("uri", U.parse(F.col("uri")).alias("r")).where("r IS NOT NULL").select("uri", "r.*")


def uri_construct(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "dv_cases").select("case_id", "publikation", "artal", "lopnummer", "sidnummer").distinct()
    fields = [F.lit(M.RATTSFALL).alias("type")] + [(F.col(f) if f in r.columns else F.lit(None).cast("string")).alias(f) for f in U.FIELDS]
    return r.select("case_id", U.construct(F.struct(*fields)).alias("uri"))


def uri_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URIs by whether parsing and constructing gives them back."""
    r = _uris(spark, sf_dir).select("uri", U.construct(U.parse(F.col("uri"))).alias("again"))
    return r.groupBy(F.coalesce(F.col("uri") == F.col("again"), F.lit(False)).alias("same")).agg(F.count("*").alias("n"))


def uri_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("uri")
    return _uris(spark, sf_dir).select("uri", U.namespace(u).alias("ns"), U.local_name(u).alias("name"), U.last_index_of(u, "/").cast("int").alias("last_slash"))


def segment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.exploded(_docs(spark, sf_dir).select("doc_id", "text"), "text", X.LINE)


def segment_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.exploded(_docs(spark, sf_dir).select("doc_id", "text"), "text", X.PARAGRAPH)
    return rows.withColumn("clean", X.cleaned(F.col("chunk")))


def segment_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.offsets(X.exploded(_docs(spark, sf_dir).select("doc_id", "text"), "text", X.PARAGRAPH), ["doc_id"], X.PARAGRAPH)
    return rows.select("doc_id", "pos", F.col("start").cast("bigint").alias("start"), F.length("chunk").alias("length"))


def peek_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.peeked(X.exploded(_docs(spark, sf_dir).select("doc_id", "text"), "text", X.LINE), ["doc_id"])


def cue_readto(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", X.cue(t, "§").alias("cue"), X.cue_past(t, "§").alias("past"), X.read_to(t, "§").alias("upto"), X.read(t, 20, 10).alias("part"))


def truncate_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("description")
    return table(spark, sf_dir, "dv_cases").select("case_id", X.truncated(d, 80).alias("short80"), X.truncated(d, 200).alias("short200")).distinct()


def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return (
        table(spark, sf_dir, "sfs_snapshots").select("title").distinct()
        .select("title", X.before(t, " om ").alias("head"), X.after(t, " om ").alias("tail"), X.normal_space(t).alias("plain"), F.length(t).alias("n"))
    )


def slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nodes").select("rubrik").where("rubrik IS NOT NULL").distinct().withColumn("slug", X.slug(F.col("rubrik")))


def short_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"(https?://[^\s\])]+)"), F.lit(1))
    return _docs(spark, sf_dir).select(F.explode(found).alias("url")).distinct().withColumn("short", X.short_url(F.col("url")))


def pdf_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "sfs_snapshots").select("fsnummer").where("fsnummer IS NOT NULL").distinct()
    y, n = F.regexp_extract("fsnummer", r"^([0-9]{4}):([0-9]+)", 1).try_cast("int"), F.regexp_extract("fsnummer", r"^([0-9]{4}):([0-9]+)", 2).try_cast("int")
    link = F.concat(F.substring("fsnummer", 3, 2), F.format_string("%04d", n))
    return s.select("fsnummer", X.official_pdf(y, n).alias("official_pdf"), X.authentic_version(y, n).alias("authentic"), F.when(X.official_pdf(y, n), link).alias("pdf"))


def title_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title of each fetch or else its number; fetches with neither are left out."""
    s = table(spark, sf_dir, "sfs_snapshots").select("snapshot_id", F.coalesce("title", "fsnummer").alias("shown")).distinct()
    return s.where("coalesce(shown, '') <> ''")


def amendment_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts that changed each act, over all fetches, as one comma-separated list."""
    s = table(spark, sf_dir, "sfs_snapshots").select("uri", F.explode("konsolideringsunderlag").alias("act")).where("act IS NOT NULL AND uri IS NOT NULL").distinct()
    s = s.select("uri", F.regexp_extract("act", "([^/]*)$", 1).alias("nr"))
    return s.groupBy("uri").agg(F.array_join(F.array_sort(F.collect_list("nr")), ", ").alias("amendments"), F.count("*").alias("n"))


def toc_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nodes").where(F.col("node_type").isin("Avdelning", "Kapitel", "Rubrik", "Bilaga") & F.col("withdrawn_at").isNull())
    return n.select("doc", "node_id", "node_type", "rubrik", "seq").distinct()


def asof_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nodes").where("withdrawn_at IS NULL")
    return tree.as_of(n, F.lit("2000-01-01").cast("date")).select("node_row", "doc", "node_id").distinct()


def paragraph_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nodes").where("node_type = 'Stycke'").select("doc", "node_id").distinct()
    return n.select("doc", "node_id", X.paragraph_marker(F.col("node_id")).alias("marker"))


def first_paragraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs with the number of their section on the first one."""
    n = table(spark, sf_dir, "nodes").where("node_type = 'Stycke' AND node_id IS NOT NULL").select("doc", "node_id").distinct()
    n = n.withColumn("section", F.regexp_extract("node_id", "^(.*)S[0-9]+$", 1)).withColumn("piece", F.regexp_extract("node_id", "S([0-9]+)$", 1).try_cast("int"))
    first = F.col("piece") == F.min("piece").over(Window.partitionBy("doc", "section"))
    return n.select("doc", "node_id", F.when(first, F.nullif(F.regexp_extract("section", "P([0-9a-z]+)$", 1), F.lit(""))).alias("number"))


def type_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes by how they are rendered; unexpected types are counted, not lost."""
    kind = F.col("node_type")
    how = F.when(kind.isin("Avdelning", "Kapitel", "Rubrik"), "heading").when(kind.isin("Paragraf", "Stycke"), "text").when(kind == "Listelement", "list").otherwise("unexpected")
    return table(spark, sf_dir, "nodes").groupBy("node_type", how.alias("rendered_as")).agg(F.count("*").alias("n"))


def part_of_emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The containment that node ids imply: what contains K1P2S3N4 is K1P2S3."""
    n = table(spark, sf_dir, "nodes").where("node_id IS NOT NULL").select("doc", "node_id").distinct()
    up = F.regexp_extract("node_id", "^(.*)[A-Z][0-9]+[a-z]*$", 1)
    return n.select(M.node_uri(F.col("doc"), F.col("node_id")).alias("s"), F.when(up == "", F.col("doc")).otherwise(F.concat("doc", F.lit("#"), up)).alias("o"))


def heading_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divisions, chapters and sections numbered as headings of three levels."""
    level = F.when(F.col("node_type") == "Avdelning", 1).when(F.col("node_type") == "Kapitel", 2).when(F.col("node_type") == "Paragraf", 3)
    n = table(spark, sf_dir, "nodes").select("doc", "node_row", "node_id", level.alias("level")).where("level IS NOT NULL").distinct()
    return tree.heading_numbers(n, "doc", "node_row", "level", 3).select("node_row", "node_id", "level", "number")


def anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nodes").where("rubrik IS NOT NULL").select("doc", "node_row", X.slug(F.col("rubrik")).alias("anchor")).distinct()
    return tree.unique_anchors(n, "doc", "node_row", "anchor")


def first_repo_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the directives that several repositories hold, the first one's."""
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(("dir-trips", "dir-asp", "dir-sou", "dir-polo")) for x in (r, i)])
    r = table(spark, sf_dir, "direktiv_records").withColumn("basefile", files.year_number(F.col("basefile"))).where("basefile IS NOT NULL")
    best = F.min(F.struct(F.coalesce(rank[F.col("subrepo")], F.lit(9)).alias("rank"), "record_id", "subrepo")).alias("b")
    return r.groupBy("basefile").agg(best).select("basefile", "b.record_id", "b.subrepo")


def newest_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest regulation of each series and year, not counting appendices."""
    r = table(spark, sf_dir, "skvfs_regulations").where(~F.contains(F.coalesce("title", F.lit("")), F.lit("bilaga")))
    key = F.split("basefile", "/")
    r = r.select("reg_id", F.get(key, 0).alias("series"), F.get(key, 1).try_cast("int").alias("year"), F.get(key, 2).try_cast("int").alias("number"), "fetched_at")
    best = F.max(F.struct("number", "fetched_at", "reg_id")).alias("b")
    return r.groupBy("series", "year").agg(best).select("series", "year", "b.number", "b.reg_id", (F.col("year") >= 2007).alias("needs_pdf"))


def repository_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "direktiv_records").select(files.year_number(F.col("basefile")).alias("basefile")).where("basefile IS NOT NULL").distinct()
    y, n = F.substring_index("basefile", ":", 1).try_cast("int"), F.substring_index("basefile", ":", -1).try_cast("int")
    return r.select("basefile", files.paged_path(y, n).alias("paged"), F.concat(y.cast("string"), F.lit("/dir"), y.cast("string"), F.lit("_"), n.cast("string")).alias("by_year"))


def index_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts by year and first letter, as an index page has them."""
    s = table(spark, sf_dir, "sfs_snapshots").where("title IS NOT NULL AND fsnummer IS NOT NULL").groupBy("fsnummer").agg(F.min("title").alias("title"))
    topic = F.upper(F.left(X.after(F.col("title"), " om "), F.lit(1)))
    g = s.select(F.left("fsnummer", F.lit(4)).alias("category"), F.when(topic != "", topic).otherwise("#").alias("page"), "fsnummer", "title")
    return g.groupBy("category", "page").agg(F.array_join(F.array_sort(F.collect_list("fsnummer")), " ").alias("acts"), F.count("*").alias("n"))


def news_trailing_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "about", "fetched_at")
    #: one row by construction: an aggregate without keys
    last = d.agg((F.max("fetched_at") - F.expr("INTERVAL 30 DAYS")).alias("since")).collect()[0]["since"]
    return d.where(F.col("fetched_at") >= F.lit(last)).select("doc_id", F.coalesce("about", F.lit("")).alias("about"), F.date_format("fetched_at", "yyyy-MM-dd").alias("day"))


def collection_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cited acts and provisions as a collection: a fragment brings in only
    itself, an act all of its live nodes; by entry, with what it includes."""
    wanted = M.pattern(M.stated(spark, sf_dir), M.LAGRUM_P, "case", "o").select(F.substring_index("o", "#", 1).alias("doc"), F.nullif(F.regexp_extract("o", "#(.*)$", 1), F.lit("")).alias("fragment")).distinct()
    nodes = table(spark, sf_dir, "nodes").where("withdrawn_at IS NULL").select("doc", "node_id").distinct()
    whole = wanted.where("fragment IS NULL").join(nodes, "doc").select("doc", "fragment", "node_id")
    part = wanted.where("fragment IS NOT NULL").join(nodes.withColumnRenamed("node_id", "fragment"), ["doc", "fragment"]).select("doc", "fragment", F.col("fragment").alias("node_id"))
    return whole.unionByName(part).groupBy("doc", "fragment").agg(F.count("*").alias("n_nodes"))


def delete_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store without anything about the cases that were withdrawn."""
    gone = table(spark, sf_dir, "dv_cases").where("withdrawn_at IS NOT NULL").select(F.col("uri").alias("s"))
    return store.without(M.stated(spark, sf_dir), gone).groupBy("g", "p").agg(F.count("*").alias("n"))


def graph_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = M.stated(spark, sf_dir)
    one = lambda g: t.where(F.col("g") == g).select("s", "p", "o")
    return store.merged(one("sfs"), one("intertwine"), one("dv"))


def grit_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = store.grouped(M.stated(spark, sf_dir))
    shown = F.array_join(F.transform("properties", lambda x: F.concat(x["p"], F.lit("="), x["o"])), " | ")
    return t.select("s", shown.alias("properties"), F.size("properties").alias("n"))


def n_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.n_triples(M.stated(spark, sf_dir))


def citation_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    found = F.concat(C.cases(t), C.publications(t), C.acts(t))
    return _docs(spark, sf_dir).select(F.explode(found).alias("uri")).groupBy("uri").agg(F.count("*").alias("n"))


def citation_extract_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``citation_extract`` with bare numbers of acts and EU cases, which its SQL
    has not: every rule that needs no memory."""
    t = F.col("text")
    found = F.concat(C.cases(t), C.publications(t), C.acts(t), C.naked(t), C.eu_cases(t))
    return _docs(spark, sf_dir).select(F.explode(found).alias("uri")).groupBy("uri").agg(F.count("*").alias("n"))


def celex_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CELEX-like numbers made of case numbers: the corpus itself holds none."""
    d = table(spark, sf_dir, "dv_cases").select(F.substring("artal", 3, 2).alias("yy"), "artal", "case_id").where("artal IS NOT NULL").distinct()
    old = F.concat(F.lit("3"), "yy", F.lit("L"), F.format_string("%04d", F.col("case_id") % 10000))
    return d.select("case_id", old.alias("old"), X.celex(old).alias("celex"), X.celex(F.concat(F.lit("3"), "artal", F.lit("L0019"))).alias("kept"))


def citation_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links in provisions' texts with enumerations, short titles and "the
    same act" resolved; relative references belong to the provision's act."""
    n = table(spark, sf_dir, "nodes").where("text IS NOT NULL").select("doc", "node_id", "sfsnr", "text").distinct()
    runs = n.select("doc", "node_id", F.posexplode(C.linked(C.SHORT_TITLES)("text", "sfsnr")).alias("pos", "run"))
    return runs.where("run.uri IS NOT NULL").select("doc", "node_id", "pos", "run.text", "run.uri")


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select("doc_id", F.explode(C.definitions(F.col("text"))).alias("term"))
    return d.select("doc_id", "term", C.concept(F.col("term")).alias("concept")).distinct()


def amendment_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.explode(C.amendment_notes(F.col("text"))).alias("act")).groupBy("act").agg(F.count("*").alias("n"))


def structure_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).where("source IN ('sfs', 'skvfs')")
    return tree.structure(d, "doc_id", "text")


def markup_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).where("source = 'wiki'").select("doc_id", markup.html_lite("text").alias("html"))


def markup_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).where("source = 'wiki'").select("doc_id", markup.html("text").alias("html"), markup.page_categories("text").alias("categories"))


def wiki_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.regexp_extract_all("text", F.lit(r"\[\[([^\]|]+)"), F.lit(1))
    return _docs(spark, sf_dir).where("source = 'wiki'").select("doc_id", F.explode(target).alias("target")).groupBy("target").agg(F.count("*").alias("n"))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serialised triples read again: how many lines are kept and rejected."""
    lines = n_triples(spark, sf_dir).withColumnRenamed("line", "value")
    good, bad = files.n_triples(lines, "again")
    kept = good.select("s", "p", "o").distinct().agg(F.count("*").alias("n")).select(F.lit("kept").alias("what"), "n")
    return kept.unionByName(bad.agg(F.count("*").alias("n")).select(F.lit("rejected").alias("what"), "n"))


def tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass and fail by kind of URI, for the round trip."""
    r = uri_parse(spark, sf_dir)
    again = U.construct(F.struct("type", *U.FIELDS))
    return r.groupBy("type").agg(F.count("*").alias("n"), F.sum(F.when(F.col("uri") == again, 1).otherwise(0)).alias("passed"))


def top_cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty most cited targets: a report, so its limit is its purpose."""
    return M.pattern(M.stated(spark, sf_dir), M.REFERENCES, "s", "o").groupBy("o").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o").limit(20)


_QUERIES = (
    uri_parse, uri_construct, uri_roundtrip, uri_parts, segment_lines, segment_paragraphs, segment_positions, peek_prev, cue_readto, truncate_desc, string_functions,
    slug, short_urls, pdf_rule, title_fallback, amendment_list, toc_projection, asof_version, paragraph_markers, first_paragraph, type_dispatch, part_of_emitted,
    heading_numbering, anchor_dedup, first_repo_wins, newest_only, repository_paths, index_grouping, news_trailing_30d, collection_include, delete_subject, graph_merge,
    grit_group, n_triples, citation_extract, citation_extract_all, celex_normalise, citation_linked, definitions, amendment_notes, structure_nodes, markup_inline, markup_full, wiki_links,
    quarantine, tally, top_cited,
)
QUERIES = {f.__name__: f for f in _QUERIES}

from codexmill.plans.documents_sql import ORACLE  # noqa: E402, F401
