"""Schemas, vocabulary and the adapter from the driver's tables to triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.session import table

#: Base of all URIs of the corpus; a parameter wherever URIs are made or read.
BASE = "http://rinfo.example/publ"

# Types of property records.
LAGRUM, RATTSFALL, BESLUT = 1, 7, 8

# Predicates.
PART_OF, REFERENCES, SUBJECT = "dct:isPartOf", "dct:references", "dct:subject"
IDENTIFIER, DESCRIPTION, TITLE = "dct:identifier", "dct:description", "dct:title"
LAGRUM_P, CASE_P, FS_NUMBER = "rinfo:lagrum", "rinfo:rattsfallshanvisning", "rinfo:fsNummer"
CHANGES = ("rinfo:ersatter", "rinfo:inforsI", "rinfo:upphaver")
PREFIXES = {
    "dct": "http://purl.org/dc/terms/",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "rinfo": "http://rinfo.example/taxo/pub#",
    "rinfoex": "http://rinfo.example/taxo/ext#",
}

TRIPLES = "g string, s string, p string, o string, o_kind string, o_datatype string, o_lang string"


def is_act(uri: Column) -> Column:
    """Whether a URI is an act's, not a provision's."""
    return uri.startswith(f"{BASE}/sfs/") & ~F.contains(uri, F.lit("#"))


def node_uri(doc: Column, node_id: Column) -> Column:
    return F.when(node_id.isNull(), doc).otherwise(F.concat(doc, F.lit("#"), node_id))


def _row(g: str, s: Column, p: str, o: Column, kind: str = "literal") -> list[Column]:
    none = F.lit(None).cast("string")
    return [F.lit(g).alias("g"), s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), none.alias("o_datatype"), none.alias("o_lang")]


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triples as they were delivered, repeated or not; statements without
    an object say nothing."""
    t = table(spark, sf_dir, "triples").select("g", "s", "p", "o", "o_kind", "o_datatype", "o_lang")
    return t.where("s IS NOT NULL AND o IS NOT NULL")


def stated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triples as a set."""
    return statements(spark, sf_dir).distinct()


def graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples and those that the other tables imply: descriptions of cases and
    provisions, and the acts that transitional provisions bring in. Rows may
    repeat; ``pattern`` takes them as a set, of two columns instead of seven."""
    cases, nodes = table(spark, sf_dir, "dv_cases"), table(spark, sf_dir, "nodes")
    uri = node_uri(F.col("doc"), F.col("node_id"))
    moved = nodes.where("node_type = 'Overgangsbestammelse' AND node_id LIKE 'L%'").withColumn("nr", F.expr("substring(node_id, 2)"))
    act = F.concat(F.regexp_extract("doc", "^(.*/)[^/]*$", 1), "nr")
    more = [
        cases.select(*_row("dv", F.col("uri"), DESCRIPTION, F.col("description"))),
        nodes.select(*_row("sfs", uri, DESCRIPTION, F.col("text"))),
        moved.select(*_row("sfs", act, "rinfo:inforsI", uri, "uri")),
        moved.select(*_row("sfs", act, FS_NUMBER, F.col("nr"))),
    ]
    out = statements(spark, sf_dir)
    for m in more:
        out = out.unionByName(m.where("s IS NOT NULL AND o IS NOT NULL"))
    return out


def pattern(triples: DataFrame, p: str | tuple[str, ...], s: str, o: str, g: str | None = None) -> DataFrame:
    """A triple pattern with a constant predicate (or alternatives) over the
    union of graphs or one of them; the columns are named ``s`` and ``o``."""
    ps = (p,) if isinstance(p, str) else p
    t = triples.where(F.col("p").isin(*ps))
    if g is not None:
        t = t.where(F.col("g") == g)
    return t.select(F.col("s").alias(s), F.col("o").alias(o), *([] if len(ps) == 1 else ["p"])).distinct()
