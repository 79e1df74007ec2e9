"""Queries of the general data problems (p1, p2, p5) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.operators import hierarchy as H
from codexmill.operators.history import version_history
from codexmill.operators.orphans import find_orphans
from codexmill.session import table

REFERENCES = {"dct:references": "nodes", "rinfo:lagrum": "nodes", "rinfo:rattsfallshanvisning": "dv_cases"}


def p1_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = version_history(table(spark, sf_dir, "sfs_snapshots"))
    return v.select(
        "uri", "valid_from", "valid_to",
        F.date_format("utfardandedatum", "yyyy-MM-dd").alias("utfardandedatum"),
        F.array_join("konsolideringsunderlag", " ").alias("konsolideringsunderlag"),
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_history(table(spark, sf_dir, "sfs_snapshots")).select("uri", "valid_from", "valid_to")


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "triples").where(F.col("p").isin(*REFERENCES) & (F.col("o_kind") == "uri"))
    domain = F.when(F.col("p") == "rinfo:rattsfallshanvisning", "dv_cases").otherwise("nodes")
    refs = refs.select("triple_id", "p", "g", domain.alias("domain"), F.col("o").alias("key"), F.col("harvested_at").alias("at"))
    nodes = table(spark, sf_dir, "nodes").select(
        F.lit("nodes").alias("domain"),
        F.when(F.col("node_id").isNull(), F.col("doc")).otherwise(F.concat("doc", F.lit("#"), "node_id")).alias("key"),
        F.col("registered_at").alias("live_from"),
        F.col("withdrawn_at").alias("live_to"),
    )
    cases = table(spark, sf_dir, "dv_cases").select(
        F.lit("dv_cases").alias("domain"), F.col("uri").alias("key"), F.col("registered_at").alias("live_from"), F.col("withdrawn_at").alias("live_to")
    )
    return find_orphans(refs, nodes.unionByName(cases)).dropDuplicates(["triple_id"])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("p", "triple_id")


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).groupBy("p", "g", F.date_format("at", "yyyy-MM").alias("month")).agg(F.count("*").alias("n_orphans"))


def _part_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "triples").where("p = 'dct:isPartOf'").select("s", "o")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.cyclic_nodes(_part_of(spark, sf_dir))


def p5_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = H.hierarchy(_part_of(spark, sf_dir))
    acts = table(spark, sf_dir, "triples").where("p = 'rinfo:fsNummer' AND s IS NOT NULL").groupBy(F.col("s").alias("root")).agg(F.min("o").alias("root_fsnummer"))
    return h.join(acts, "root", "left").select("uri", "root", "root_fsnummer", "depth", F.array_join("path", " > ").alias("path"), "n_parents", "in_cycle")


def p5_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.descendants(_part_of(spark, sf_dir))


QUERIES = {f.__name__: f for f in (p1_found, p1_history, p2_found, p2_report, p5_found, p5_paths, p5_descendants)}

_VERSIONS = """
WITH days AS (
  SELECT uri, senasthamtad AS d, utfardandedatum AS u, list_sort(list_distinct(konsolideringsunderlag)) AS k
  FROM sfs_snapshots WHERE senasthamtad IS NOT NULL AND uri IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY uri, senasthamtad ORDER BY ingested_at DESC NULLS LAST, snapshot_id DESC) = 1
), filled AS (
  SELECT uri, d,
    last_value(u IGNORE NULLS) OVER w AS u, last_value(k IGNORE NULLS) OVER w AS k
  FROM days WINDOW w AS (PARTITION BY uri ORDER BY d ROWS UNBOUNDED PRECEDING)
), marked AS (
  SELECT *, row_number() OVER w = 1 OR u IS DISTINCT FROM lag(u) OVER w OR k IS DISTINCT FROM lag(k) OVER w AS begins
  FROM filled WINDOW w AS (PARTITION BY uri ORDER BY d)
), versions AS (
  SELECT uri, strftime(d, '%Y-%m-%d') AS valid_from,
    coalesce(strftime(lead(d) OVER (PARTITION BY uri ORDER BY d), '%Y-%m-%d'), '9999-12-31') AS valid_to, u, k
  FROM marked WHERE begins
)
"""

_ORPHANS = """
WITH parents AS (
  SELECT 'nodes' AS t, CASE WHEN node_id IS NULL THEN doc ELSE doc || '#' || node_id END AS k, registered_at AS a, withdrawn_at AS b FROM nodes
  UNION ALL SELECT 'dv_cases', uri, registered_at, withdrawn_at FROM dv_cases
), refs AS (
  SELECT DISTINCT triple_id, p, g, o, harvested_at, CASE WHEN p = 'rinfo:rattsfallshanvisning' THEN 'dv_cases' ELSE 'nodes' END AS t
  FROM triples WHERE p IN ('dct:references', 'rinfo:lagrum', 'rinfo:rattsfallshanvisning') AND o_kind = 'uri' AND o IS NOT NULL
), orphans AS (
  SELECT * FROM refs r WHERE NOT EXISTS (
    SELECT 1 FROM parents q WHERE q.t = r.t AND q.k = r.o AND q.a <= r.harvested_at AND (q.b IS NULL OR q.b > r.harvested_at))
)
"""

_TREE = """
WITH RECURSIVE e AS (SELECT DISTINCT s, o FROM triples WHERE p = 'dct:isPartOf' AND o IS NOT NULL AND s IS NOT NULL),
above AS (SELECT s, o AS a FROM e UNION SELECT x.s, e.o FROM above x JOIN e ON x.a = e.s)
"""

ORACLE = {
    "p1_found": _VERSIONS + "SELECT uri, valid_from, valid_to FROM versions",
    "p1_history": _VERSIONS + "SELECT uri, valid_from, valid_to, strftime(u, '%Y-%m-%d') AS utfardandedatum, array_to_string(k, ' ') AS konsolideringsunderlag FROM versions",
    "p2_found": _ORPHANS + "SELECT p, triple_id FROM orphans",
    "p2_report": _ORPHANS + "SELECT p, g, strftime(harvested_at, '%Y-%m') AS month, count(*) AS n_orphans FROM orphans GROUP BY ALL",
    "p5_found": _TREE + "SELECT s AS uri FROM above WHERE s = a",
    "p5_descendants": _TREE + "SELECT a AS uri, s AS descendant FROM above",
    "p5_paths": """
WITH RECURSIVE e AS (SELECT DISTINCT s, o FROM triples WHERE p = 'dct:isPartOf' AND o IS NOT NULL AND s IS NOT NULL),
above AS (SELECT s, o AS a FROM e UNION SELECT x.s, e.o FROM above x JOIN e ON x.a = e.s),
one AS (SELECT s, min(o) AS o, count(*) AS n FROM e GROUP BY s),
tree AS (
  SELECT DISTINCT o AS uri, o AS root, 0 AS depth, o AS path FROM e WHERE o NOT IN (SELECT s FROM e)
  UNION ALL SELECT c.s, t.root, t.depth + 1, t.path || ' > ' || c.s FROM tree t JOIN one c ON c.o = t.uri
),
acts AS (SELECT s, min(o) AS fs FROM triples WHERE p = 'rinfo:fsNummer' AND s IS NOT NULL GROUP BY s)
SELECT u.uri, t.root, acts.fs AS root_fsnummer, CAST(t.depth AS BIGINT) AS depth, t.path,
  CAST(coalesce(one.n, 0) AS INT) AS n_parents, u.uri IN (SELECT s FROM above WHERE s = a) AS in_cycle
FROM (SELECT s AS uri FROM e UNION SELECT o FROM e) u
LEFT JOIN tree t ON t.uri = u.uri LEFT JOIN one ON one.s = u.uri LEFT JOIN acts ON acts.s = t.root""",
}
