"""A store of triples: a Parquet table partitioned by graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.model import PREFIXES, TRIPLES
from codexmill.session import materialize

KEY = ["g", "s", "p", "o"]


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIPLES).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def add(new: DataFrame, path: str) -> None:
    """Insert the statements that the store does not hold yet; nothing else is
    written, and no file when there is nothing new. NULLs equal each other."""
    spark = new.sparkSession
    rows = new.select([c.split()[0] for c in TRIPLES.split(", ")]).distinct()
    if exists(spark, path):
        old = read(spark, path)
        rows = rows.alias("n").join(old.alias("o"), [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in rows.columns], "left_anti")
    rows.write.mode("append").partitionBy("g").parquet(path)


def without(triples: DataFrame, subjects: DataFrame) -> DataFrame:
    """All statements but those about the given subjects (column ``s``)."""
    return triples.join(subjects.select("s").distinct(), "s", "left_anti")


def merged(*graphs: DataFrame) -> DataFrame:
    """Union of graphs as sets."""
    out = graphs[0]
    for g in graphs[1:]:
        out = out.unionByName(g)
    return out.distinct()


def replace_subjects(new: DataFrame, path: str) -> None:
    """What is stated about the subjects of ``new`` becomes exactly ``new``.

    Only the graphs that hold or receive such statements are rewritten; the new
    state is materialised before it overwrites them. A graph that is left
    without statements loses its partition. A NULL graph is a graph like any
    other; statements without a subject stay as they are and are only added.
    """
    spark = new.sparkSession
    fresh = new.select([c.split()[0] for c in TRIPLES.split(", ")]).distinct()
    emptied: list[str | None] = []
    if exists(spark, path):
        old, about = read(spark, path), fresh.select("s").distinct()
        graphs = fresh.select("g").union(old.join(about, "s", "left_semi").select("g")).distinct()
        within = old.alias("o").join(graphs.alias("k"), F.col("o.g").eqNullSafe(F.col("k.g")), "left_semi")
        fresh = materialize(merged(without(within, about).select(fresh.columns), fresh), "store")
        #: graphs are partitions, so they are few
        left = {r["g"] for r in fresh.select("g").distinct().collect()}
        emptied = [r["g"] for r in graphs.collect() if r["g"] not in left]
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("g").parquet(path)
    _drop_partitions(spark, path, emptied)


def _drop_partitions(spark: SparkSession, path: str, graphs: list[str | None]) -> None:
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for g in graphs:
        at = spark._jvm.org.apache.hadoop.fs.Path(path, names.getPartitionPathString("g", g))
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def curie_expanded(name: Column) -> Column:
    """'dct:title' to its full URI; names with other prefixes stay."""
    prefix = F.substring_index(name, ":", 1)
    full = F.create_map(*[F.lit(x) for kv in PREFIXES.items() for x in kv])
    return F.when(F.contains(name, F.lit(":")), F.coalesce(F.concat(full[prefix], F.regexp_extract(name, "^[^:]*:(.*)$", 1)), name)).otherwise(name)


def escaped(s: Column) -> Column:
    """Escapes of N-Triples literals."""
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def n_triples_line() -> Column:
    """Subject, predicate and object as N-Triples has them, parted by U+001F,
    which occurs in none of them but escaped."""
    literal = F.concat(
        F.lit('"'), escaped(F.col("o")), F.lit('"'),
        F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), "o_lang")).when(F.col("o_datatype").isNotNull(), F.concat(F.lit("^^<"), curie_expanded(F.col("o_datatype")), F.lit(">"))).otherwise(""),
    )
    obj = F.when(F.col("o_kind") == "uri", F.concat(F.lit("<"), "o", F.lit(">"))).when(F.col("o_kind") == "bnode", F.concat(F.lit("_:"), "o")).otherwise(literal)
    subj = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(F.concat(F.lit("<"), "s", F.lit(">")))
    return F.concat_ws("\x1f", subj, F.concat(F.lit("<"), curie_expanded(F.col("p")), F.lit(">")), obj)


def n_triples(triples: DataFrame) -> DataFrame:
    """(line) in N-Triples."""
    return serialized(triples, "nt")


def _xml_text(c: Column) -> Column:
    """Text for XML; characters that XML has not show as U+FFFD."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, "[\\x{0}-\\x{8}\\x{b}\\x{c}\\x{e}-\\x{1f}\\x{fffe}\\x{ffff}]", "\ufffd")


def _shown(c: Column, around: str) -> Column:
    return F.concat(F.lit(around[0]), c, F.lit(around[1]))


def _parts() -> tuple[Column, Column, Column]:
    """Subject, predicate and object in N-Triples."""
    nt = F.split(n_triples_line(), "\x1f", 3)
    return nt[0], nt[1], nt[2]


def serialized(triples: DataFrame, form: str) -> DataFrame:
    """(line): one statement a line in ``nt``, ``nq`` (with its graph), ``ttl``
    or ``n3`` (prefixed names), ``trig``, ``xml`` (a description for each
    statement), ``trix`` or ``json`` (a binding of a result document). What goes
    around the lines is in ``ENVELOPES``. Every line stands alone, so a subject
    or graph with any number of statements is written by many tasks."""
    s, p, o = _parts()
    short = F.when(F.col("p").rlike("^[A-Za-z][\\w-]*:[A-Za-z_][\\w-]*$"), F.col("p")).otherwise(p)
    graph = _shown(F.coalesce("g", F.lit("")), "<>")
    if form == "nt":
        line = F.concat_ws(" ", s, p, o, F.lit("."))
    elif form == "nq":
        line = F.concat_ws(" ", s, p, o, graph, F.lit("."))
    elif form in ("ttl", "n3"):
        line = F.concat_ws(" ", s, short, o, F.lit("."))
    elif form == "trig":
        line = F.concat_ws(" ", graph, F.lit("{"), s, short, o, F.lit("}"))
    elif form == "xml":
        about = F.when(F.col("s").startswith("_:"), F.concat(F.lit('rdf:nodeID="'), F.substring("s", 3, 1 << 30))).otherwise(F.concat(F.lit('rdf:about="'), _xml_text(F.col("s"))))
        full = curie_expanded(F.col("p"))
        local = F.regexp_extract(full, "([^/#:]*)$", 1)
        tag = F.when(F.substring_index("p", ":", 1).isin(*PREFIXES), F.col("p")).otherwise(F.concat(F.lit("p:"), local))
        ns = F.when(tag.startswith("p:"), F.concat(F.lit(' xmlns:p="'), _xml_text(F.regexp_extract(full, "^(.*[/#:])", 1)), F.lit('"'))).otherwise("")
        typed = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit(' xml:lang="'), "o_lang", F.lit('"'))).when(F.col("o_datatype").isNotNull(), F.concat(F.lit(' rdf:datatype="'), _xml_text(F.col("o_datatype")), F.lit('"'))).otherwise("")
        empty = lambda a: F.concat(F.lit("<"), tag, ns, F.lit(f' rdf:{a}="'), _xml_text(F.col("o")), F.lit('"/>'))
        literal = F.concat(F.lit("<"), tag, ns, typed, F.lit(">"), _xml_text(F.col("o")), F.lit("</"), tag, F.lit(">"))
        prop = F.when(F.col("o_kind") == "uri", empty("resource")).when(F.col("o_kind") == "bnode", empty("nodeID")).otherwise(literal)
        line = F.concat(F.lit("<rdf:Description "), about, F.lit('">'), prop, F.lit("</rdf:Description>"))
    elif form == "trix":
        node = lambda tag, c, attr="": F.concat(F.lit(f"<{tag}"), attr if isinstance(attr, Column) else F.lit(attr), F.lit(">"), _xml_text(c), F.lit(f"</{tag}>"))
        lang = F.concat(F.lit(' xml:lang="'), "o_lang", F.lit('"'))
        obj = F.when(F.col("o_kind") == "uri", node("uri", F.col("o"))).when(F.col("o_kind") == "bnode", node("id", F.col("o"))).when(F.col("o_lang").isNotNull(), node("plainLiteral", F.col("o"), lang)).when(
            F.col("o_datatype").isNotNull(), node("typedLiteral", F.col("o"), F.concat(F.lit(' datatype="'), _xml_text(F.col("o_datatype")), F.lit('"')))).otherwise(node("plainLiteral", F.col("o")))
        line = F.concat(F.lit("<graph>"), node("uri", F.coalesce("g", F.lit(""))), F.lit("<triple>"), node("uri", F.col("s")), node("uri", curie_expanded(F.col("p"))), obj, F.lit("</triple></graph>"))
    elif form == "json":
        value = lambda kind, c: F.struct(kind.alias("type"), c.alias("value"))
        obj = F.struct(F.col("o_kind").alias("type"), F.col("o").alias("value"), F.col("o_lang").alias("xml:lang"), F.col("o_datatype").alias("datatype"))
        line = F.to_json(F.struct(value(F.lit("uri"), F.col("s")).alias("s"), value(F.lit("uri"), curie_expanded(F.col("p"))).alias("p"), obj.alias("o")))
    else:
        raise ValueError(f"no such form: {form!r}")
    return triples.select(line.alias("line"))


_NS = "".join(f' xmlns:{p}="{full}"' for p, full in PREFIXES.items())
#: What a document of each form begins and ends with, and what parts its lines.
ENVELOPES = {
    "ttl": ("\n".join(f"@prefix {p}: <{full}> ." for p, full in PREFIXES.items()), "", ""), "xml": (f"<rdf:RDF{_NS}>", "</rdf:RDF>", ""),
    "trix": ('<TriX xmlns="http://www.w3.org/2004/03/trix/trix-1/">', "</TriX>", ""), "json": ('{"head":{"vars":["s","p","o"]},"results":{"bindings":[', "]}}", ","),
}
ENVELOPES |= {"n3": ENVELOPES["ttl"], "trig": ENVELOPES["ttl"]}


def grouped(triples: DataFrame) -> DataFrame:
    """(s, properties): all statements about a subject in one row, sorted.

    A subject's statements are one row here because they are one document; a
    subject with more than a row should hold is better read from ``triples``.
    """
    t = triples.select("s", "p", "o", "o_kind").distinct()
    return t.groupBy("s").agg(F.array_sort(F.collect_list(F.struct("p", "o", "o_kind"))).alias("properties"))


def inlined_blank_nodes(triples: DataFrame) -> DataFrame:
    """(bnode, refs, inlined): blank nodes referred to fewer than two times go
    inside the one that refers to them."""
    nodes = triples.where("s LIKE '\\_:%'").select(F.col("s").alias("bnode")).distinct()
    refs = triples.where("o_kind = 'bnode'").groupBy(F.concat(F.lit("_:"), "o").alias("bnode")).agg(F.count("*").alias("refs"))
    return nodes.join(refs, "bnode", "left").select("bnode", F.coalesce("refs", F.lit(0)).alias("refs"), (F.coalesce("refs", F.lit(0)) < 2).alias("inlined"))


def labelled(triples: DataFrame, *predicates: str) -> DataFrame:
    """(label, uri): dictionary of what the given predicates call a resource,
    such as short titles of acts or names of organisations. A label that
    several resources share belongs to the smallest."""
    return triples.where(F.col("p").isin(*predicates)).groupBy(F.col("o").alias("label")).agg(F.min("s").alias("uri"))
