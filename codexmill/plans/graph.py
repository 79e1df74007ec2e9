"""The stored graph queries, each for all acts at once (column ``root``).

The registered queries ask for every act; ``inbound_of`` and its siblings take
any set of roots. Containment is followed upwards from the nodes that are
referred to, so provisions that nothing refers to are never expanded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill import model as M
from codexmill.functions.citations import definitions
from codexmill.operators.closure import above, closure, hops
from codexmill.plans.documents_sql import defs_sql
from codexmill.session import table


def part_of(t: DataFrame) -> DataFrame:
    return M.pattern(t, M.PART_OF, "child", "parent")


def _rooted(t: DataFrame, refs: DataFrame, star: bool, roots: DataFrame | None) -> DataFrame:
    """``refs`` with the ``root`` that each ``lagrum`` lies below along
    ``dct:isPartOf*`` or ``+``: any act, or one of the given roots."""
    if roots is not None:
        below = closure(part_of(t), roots, include_roots=star).withColumnRenamed("node", "lagrum")
        return refs.join(below, "lagrum")
    asked = refs.select(F.col("lagrum").alias("node")).distinct()
    up = above(part_of(t), asked).where(M.is_act(F.col("root")))
    if star:
        own = asked.where(M.is_act(F.col("node"))).withColumn("root", F.col("node"))
        up = up.where("node <> root").unionByName(own)
    return refs.join(up.withColumnRenamed("node", "lagrum"), "lagrum")


def inbound_of(t: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """References to a root and all that it contains; in order where roots are given."""
    refs = M.pattern(t, M.REFERENCES, "uri", "lagrum")
    out = _rooted(t, refs, True, roots).select("root", "uri", F.lit(None).cast("string").alias("label"), "lagrum")
    return out if roots is None else out.orderBy("root", "uri", "lagrum")


def changes_of(t: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    changes = M.pattern(t, M.CHANGES, "change", "lagrum")
    ids = M.pattern(t, M.FS_NUMBER, "change", "id")
    return _rooted(t, changes, False, roots).join(ids, "change").select("root", "change", "id", "lagrum")


def cases_of(t: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    refs = M.pattern(t, M.LAGRUM_P, "uri", "lagrum")
    ids, desc = M.pattern(t, M.IDENTIFIER, "uri", "id"), M.pattern(t, M.DESCRIPTION, "uri", "desc")
    out = _rooted(t, refs, True, roots).join(ids, "uri").join(desc, "uri").select("root", "uri", "id", "desc", "lagrum")
    return out if roots is None else out.orderBy("root", "uri", "lagrum")


def descriptions_of(t: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    return _rooted(t, M.pattern(t, M.DESCRIPTION, "lagrum", "desc"), True, roots).select("root", "lagrum", "desc")


def _routes(t: DataFrame, refs: DataFrame, first: int, last: int) -> DataFrame:
    """``refs`` to ``lagrum`` with the acts that lie ``first`` to ``last`` steps
    above, a row for every route; at 0 steps ``lagrum`` is unbound."""
    e = part_of(t)
    parts = []
    for k in range(first, last + 1):
        if k:
            parts.append(refs.join(hops(e, k).where(M.is_act(F.col("root"))).withColumnRenamed("node", "lagrum"), "lagrum"))
        else:
            parts.append(refs.where(M.is_act(F.col("lagrum"))).withColumn("root", F.col("lagrum")).withColumn("lagrum", F.lit(None).cast("string")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def inbound_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inbound_of(M.statements(spark, sf_dir))


def changes_plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_of(M.graph(spark, sf_dir))


def case_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases_of(M.graph(spark, sf_dir))


def wiki_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descriptions_of(M.graph(spark, sf_dir))


def inbound_unrolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = M.statements(spark, sf_dir)
    r = _routes(t, M.pattern(t, M.REFERENCES, "uri", "lagrum"), 0, 5)
    return r.select("root", "uri", F.lit(None).cast("string").alias("label"), "lagrum")


def changes_unrolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = M.graph(spark, sf_dir)
    r = _routes(t, M.pattern(t, M.CHANGES, "change", "lagrum"), 1, 2)
    return r.join(M.pattern(t, M.FS_NUMBER, "change", "id"), "change").select("root", "change", "id", "lagrum")


def case_refs_unrolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = M.graph(spark, sf_dir)
    r = _routes(t, M.pattern(t, M.LAGRUM_P, "uri", "lagrum"), 0, 5)
    return r.join(M.pattern(t, M.IDENTIFIER, "uri", "id"), "uri").join(M.pattern(t, M.DESCRIPTION, "uri", "desc"), "uri").select("root", "uri", "id", "desc", "lagrum")


def wiki_unrolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = M.graph(spark, sf_dir)
    return _routes(t, M.pattern(t, M.DESCRIPTION, "lagrum", "desc"), 0, 2).select("root", "lagrum", "desc")


def backlinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who refers to a node, its parts or their parts: distinct, for all nodes."""
    t = M.statements(spark, sf_dir)
    refs, e = M.pattern(t, M.REFERENCES, "source", "node"), part_of(t)
    up = refs.select("node", "source")
    parts = [up] + [refs.join(hops(e, k), "node").select(F.col("root").alias("node"), "source") for k in (1, 2)]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def subjects_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects as often as they are stated."""
    return M.statements(spark, sf_dir).where(F.col("p") == M.SUBJECT).select(F.col("o").alias("subj"))


def subjects_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.pattern(M.statements(spark, sf_dir), M.SUBJECT, "s", "subj", g="dv").select("subj").distinct()


def prefix_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements about every act and its fragments, by the act: the slice that
    a document's annotations are made of."""
    t = M.stated(spark, sf_dir)
    return t.select(F.substring_index("s", "#", 1).alias("slice"), "g", "s", "p", "o").where(F.col("s").startswith(F.lit(M.BASE + "/sfs/")))


def first_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value (the smallest) of each predicate of each subject."""
    return M.stated(spark, sf_dir).groupBy("s", "p").agg(F.min("o").alias("o"), F.count("*").alias("n_values"))


def constructed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CONSTRUCT: cited acts as subjects of the inverse relation."""
    t = M.pattern(M.statements(spark, sf_dir), M.LAGRUM_P, "case", "lagrum")
    return t.select(F.col("lagrum").alias("s"), F.lit("rinfo:isLagrumFor").alias("p"), F.col("case").alias("o")).distinct()


#: What a page says about each of its nodes, by predicate.
ANNOTATIONS = {"cases": M.LAGRUM_P, "inbound": M.REFERENCES, "comment": M.DESCRIPTION, "introduced": M.CHANGES[1], "changed": M.CHANGES[0], "repealed": M.CHANGES[2]}


def annotation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node with what the graph says about it, one relation at a time:
    cases, inbound references and the acts that introduced, changed or repealed
    it point at the node, comments are its own. All relations are collected by
    node in one pass before the join; counts are NULL-free after it."""
    t = M.graph(spark, sf_dir)
    nodes = table(spark, sf_dir, "nodes").select(M.node_uri(F.col("doc"), F.col("node_id")).alias("uri"), "node_type").distinct()
    own = F.col("p") == M.DESCRIPTION
    a = t.where(F.col("p").isin(*ANNOTATIONS.values())).select("p", F.when(own, F.col("s")).otherwise(F.col("o")).alias("uri"), F.when(own, F.col("o")).otherwise(F.col("s")).alias("from")).distinct()
    of = {k: F.when(F.col("p") == p, F.col("from")) for k, p in ANNOTATIONS.items()}
    a = a.groupBy("uri").agg(*[x for k, c in of.items() for x in (F.count(c).alias(f"n_{k}"), F.min(c).alias(f"first_{k}"), F.max(c).alias(f"last_{k}"))])
    out = nodes.join(a, "uri", "left")
    return out.select("uri", "node_type", *[x for k in ANNOTATIONS for x in (F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}"), f"first_{k}", f"last_{k}")])


def counts_per_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = M.graph(spark, sf_dir)
    parts = [M.pattern(t, p, "from", "uri").select("uri", F.lit(k).alias("what")) for k, p in (("cases", M.LAGRUM_P), ("inbound", M.REFERENCES), ("changes", M.CHANGES))]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    count = lambda k: F.count(F.when(F.col("what") == k, 1)).alias(f"n_{k}")
    return u.groupBy("uri").agg(count("cases"), count("inbound"), count("changes"))


def known_link_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References whose target is a known node (before linking to it)."""
    t = M.stated(spark, sf_dir)
    known = table(spark, sf_dir, "nodes").select(M.node_uri(F.col("doc"), F.col("node_id")).alias("o")).distinct()
    return t.where(F.col("p") == M.REFERENCES).select("s", "o").distinct().join(known, "o", "left_semi").select("s", "o")


def concept_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each concept: words of its descriptions, cases under it, and
    five times the definitions and encyclopedia entries."""
    name = F.regexp_extract("text", r"^'''([^']+)'''", 1)
    pages = table(spark, sf_dir, "documents").where("source = 'wiki'").select("doc_id", F.lower(name).alias("concept"), "text").where("concept <> ''")
    words = F.size(F.filter(F.split("text", "[ \r\n\t]+"), lambda x: x != ""))
    w = pages.groupBy("concept").agg(F.sum(words).alias("words"), F.count("*").alias("wikipedia"))
    cases = M.pattern(M.statements(spark, sf_dir), M.SUBJECT, "s", "o").groupBy(F.lower("o").alias("concept")).agg(F.count("*").alias("cases"))
    defs = table(spark, sf_dir, "documents").select(F.explode(definitions(F.col("text"))).alias("c"))
    d = defs.groupBy(F.lower("c").alias("concept")).agg(F.count("*").alias("definitions"))
    out = w.join(cases, "concept", "full").join(d, "concept", "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    out = out.select("concept", zero("words"), zero("cases"), zero("definitions"), zero("wikipedia"))
    return out.withColumn("score", F.col("words") + F.col("cases") + 5 * F.col("definitions") + 5 * F.col("wikipedia"))


_QUERIES = (
    inbound_links, changes_plus, case_refs, wiki_entries, inbound_unrolled, changes_unrolled, case_refs_unrolled, wiki_unrolled, backlinks, subjects_all,
    subjects_distinct, prefix_slice, first_value, constructed, annotation_join, counts_per_node, known_link_semi, concept_score,
)
QUERIES = {f.__name__: f for f in _QUERIES}

_T = """
WITH RECURSIVE stated AS (SELECT DISTINCT g, s, p, o, o_kind, o_datatype, o_lang FROM triples WHERE s IS NOT NULL AND o IS NOT NULL),
node AS (SELECT *, CASE WHEN node_id IS NULL THEN doc ELSE doc || '#' || node_id END AS uri FROM nodes),
t AS (
  SELECT s, p, o FROM stated
  UNION SELECT uri, 'dct:description', description FROM dv_cases WHERE uri IS NOT NULL AND description IS NOT NULL
  UNION SELECT uri, 'dct:description', text FROM node WHERE uri IS NOT NULL AND text IS NOT NULL
  UNION SELECT regexp_extract(doc, '^(.*/)[^/]*$', 1) || substr(node_id, 2), 'rinfo:inforsI', uri FROM node WHERE node_type = 'Overgangsbestammelse' AND node_id LIKE 'L%'
  UNION SELECT regexp_extract(doc, '^(.*/)[^/]*$', 1) || substr(node_id, 2), 'rinfo:fsNummer', substr(node_id, 2) FROM node WHERE node_type = 'Overgangsbestammelse' AND node_id LIKE 'L%'
),
e AS (SELECT DISTINCT s AS child, o AS parent FROM stated WHERE p = 'dct:isPartOf'),
acts AS (SELECT DISTINCT u AS root FROM (SELECT parent AS u FROM e UNION SELECT o FROM t WHERE p IN ('dct:references', 'rinfo:lagrum', 'rinfo:ersatter', 'rinfo:inforsI', 'rinfo:upphaver') UNION SELECT s FROM t WHERE p = 'dct:description')
  WHERE starts_with(u, 'http://rinfo.example/publ/sfs/') AND NOT contains(u, '#')),
plus AS (SELECT a.root, e.child AS node FROM acts a JOIN e ON e.parent = a.root UNION SELECT b.root, e.child FROM plus b JOIN e ON e.parent = b.node),
star AS (SELECT root, node FROM plus UNION SELECT root, root FROM acts),
h1 AS (SELECT child AS node, parent AS root FROM e), h2 AS (SELECT h.node, e.parent AS root FROM h1 h JOIN e ON e.child = h.root),
h3 AS (SELECT h.node, e.parent AS root FROM h2 h JOIN e ON e.child = h.root), h4 AS (SELECT h.node, e.parent AS root FROM h3 h JOIN e ON e.child = h.root),
h5 AS (SELECT h.node, e.parent AS root FROM h4 h JOIN e ON e.child = h.root)
"""


def _unrolled(refs: str, cols: str, first: int, last: int) -> str:
    parts = []
    for k in range(first, last + 1):
        if k == 0:
            parts.append(f"SELECT r.lagrum AS root, {cols}, CAST(NULL AS VARCHAR) AS lagrum FROM ({refs}) r WHERE r.lagrum IN (SELECT root FROM acts)")
        else:
            parts.append(f"SELECT h.root, {cols}, r.lagrum FROM ({refs}) r JOIN h{k} h ON h.node = r.lagrum WHERE h.root IN (SELECT root FROM acts)")
    return " UNION ALL ".join(parts)


_REFS = "SELECT DISTINCT s AS uri, o AS lagrum FROM t WHERE p = 'dct:references'"
_CHG = "SELECT DISTINCT s AS change, p, o AS lagrum FROM t WHERE p IN ('rinfo:ersatter', 'rinfo:inforsI', 'rinfo:upphaver')"
_CASES = "SELECT DISTINCT s AS uri, o AS lagrum FROM t WHERE p = 'rinfo:lagrum'"
_DESC = "SELECT DISTINCT s AS lagrum, o AS \"desc\" FROM t WHERE p = 'dct:description'"

ORACLE = {
    "inbound_links": _T + f"SELECT root, uri, CAST(NULL AS VARCHAR) AS label, lagrum FROM ({_REFS}) r JOIN star ON star.node = r.lagrum",
    "changes_plus": _T + f"SELECT root, change, i.o AS id, lagrum FROM ({_CHG}) c JOIN plus ON plus.node = c.lagrum JOIN (SELECT DISTINCT s, o FROM t WHERE p = 'rinfo:fsNummer') i ON i.s = change",
    "case_refs": _T + f"SELECT root, uri, i.o AS id, d.o AS \"desc\", lagrum FROM ({_CASES}) c JOIN star ON star.node = c.lagrum JOIN (SELECT DISTINCT s, o FROM t WHERE p = 'dct:identifier') i ON i.s = uri JOIN (SELECT DISTINCT s, o FROM t WHERE p = 'dct:description') d ON d.s = uri",
    "wiki_entries": _T + f"SELECT root, lagrum, \"desc\" FROM ({_DESC}) d JOIN star ON star.node = d.lagrum",
    "inbound_unrolled": _T + "SELECT root, uri, CAST(NULL AS VARCHAR) AS label, lagrum FROM (" + _unrolled(_REFS, "r.uri", 0, 5) + ")",
    "changes_unrolled": _T + "SELECT root, change, i.o AS id, lagrum FROM (" + _unrolled(_CHG, "r.change", 1, 2) + ") JOIN (SELECT DISTINCT s, o FROM t WHERE p = 'rinfo:fsNummer') i ON i.s = change",
    "case_refs_unrolled": _T + "SELECT root, uri, i.o AS id, d.o AS \"desc\", lagrum FROM (" + _unrolled(_CASES, "r.uri", 0, 5) + ") JOIN (SELECT DISTINCT s, o FROM t WHERE p = 'dct:identifier') i ON i.s = uri JOIN (SELECT DISTINCT s, o FROM t WHERE p = 'dct:description') d ON d.s = uri",
    "wiki_unrolled": _T + _unrolled(_DESC, 'r."desc"', 0, 2),
    "backlinks": _T + "SELECT DISTINCT node, source FROM (WITH r AS (SELECT DISTINCT s AS source, o AS node FROM t WHERE p = 'dct:references') SELECT node, source FROM r UNION SELECT h.root, source FROM r JOIN h1 h USING (node) UNION SELECT h.root, source FROM r JOIN h2 h USING (node))",
    "subjects_all": "SELECT o AS subj FROM triples WHERE s IS NOT NULL AND o IS NOT NULL AND p = 'dct:subject'",
    "subjects_distinct": "SELECT DISTINCT o AS subj FROM triples WHERE p = 'dct:subject' AND g = 'dv' AND s IS NOT NULL AND o IS NOT NULL",
    "prefix_slice": _T + "SELECT split_part(s, '#', 1) AS slice, g, s, p, o FROM stated WHERE starts_with(s, 'http://rinfo.example/publ/sfs/')",
    "first_value": _T + "SELECT s, p, min(o) AS o, count(*) AS n_values FROM stated GROUP BY s, p",
    "constructed": "SELECT DISTINCT o AS s, 'rinfo:isLagrumFor' AS p, s AS o FROM triples WHERE p = 'rinfo:lagrum' AND s IS NOT NULL AND o IS NOT NULL",
    "annotation_join": _T + ", a AS (SELECT DISTINCT p, CASE WHEN p = 'dct:description' THEN s ELSE o END AS uri, CASE WHEN p = 'dct:description' THEN o ELSE s END AS x FROM t), g AS (SELECT uri, "
    + ", ".join(f"count(x) FILTER (p = '{p}') AS n_{k}, min(x) FILTER (p = '{p}') AS first_{k}, max(x) FILTER (p = '{p}') AS last_{k}" for k, p in ANNOTATIONS.items())
    + " FROM a GROUP BY uri) SELECT n.uri, n.node_type, " + ", ".join(f"coalesce(n_{k}, 0) AS n_{k}, first_{k}, last_{k}" for k in ANNOTATIONS)
    + " FROM (SELECT DISTINCT uri, node_type FROM node) n LEFT JOIN g USING (uri)",
    "counts_per_node": _T + """SELECT uri, count(*) FILTER (what = 1) AS n_cases, count(*) FILTER (what = 2) AS n_inbound, count(*) FILTER (what = 3) AS n_changes FROM (
SELECT DISTINCT s, p, o AS uri, CASE p WHEN 'rinfo:lagrum' THEN 1 WHEN 'dct:references' THEN 2 ELSE 3 END AS what FROM t
WHERE p IN ('rinfo:lagrum', 'dct:references', 'rinfo:ersatter', 'rinfo:inforsI', 'rinfo:upphaver')) GROUP BY uri""",
    "known_link_semi": _T + "SELECT DISTINCT s, o FROM stated WHERE p = 'dct:references' AND EXISTS (SELECT 1 FROM node WHERE node.uri = stated.o)",
    "concept_score": r"""
WITH pages AS (SELECT lower(regexp_extract(text, '^''''''([^'']+)''''''', 1)) AS concept, text FROM documents WHERE source = 'wiki'),
w AS (SELECT concept, sum(len(list_filter(string_split_regex(text, '[ \r\n\t]+'), lambda x: x <> ''))) AS words, count(*) AS wikipedia FROM pages WHERE concept <> '' GROUP BY concept),
c AS (SELECT lower(o) AS concept, count(*) AS cases FROM (SELECT DISTINCT s, o FROM triples WHERE p = 'dct:subject' AND s IS NOT NULL AND o IS NOT NULL) GROUP BY 1),
d AS (SELECT lower(x) AS concept, count(*) AS definitions FROM (SELECT unnest(@DEFS@) AS x FROM documents) GROUP BY 1)
SELECT concept, CAST(coalesce(words, 0) AS BIGINT) AS words, coalesce(cases, 0) AS cases, coalesce(definitions, 0) AS definitions, coalesce(wikipedia, 0) AS wikipedia,
  CAST(coalesce(words, 0) + coalesce(cases, 0) + 5 * coalesce(definitions, 0) + 5 * coalesce(wikipedia, 0) AS BIGINT) AS score
FROM w FULL JOIN c USING (concept) FULL JOIN d USING (concept)""".replace("@DEFS@", defs_sql()),
}

T_SQL = _T
