import datetime as dt
import gzip
import os
import pathlib
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from codexmill.operators import store, tree
from codexmill.operators.closure import all_pairs, closure, closure_sql, hops
from codexmill.plans import ingest
from codexmill.sources import files, rdfxml
from codexmill.streaming import refresh
from tests import oracle
from tests.conftest import rows

STATUTE = "AVDELNING I. X\n1 kap. Om a\n1 § Första.\nAndra stycket.\n1. punkt\na) led\n2. punkt\n2 § Text.\n2 kap. Om b\n1 § Åter.\n2 a § Mer.\n– streck\nBilaga 1\nText i bilaga."


def test_structure(spark):
    df = spark.createDataFrame([(1, STATUTE), (2, ""), (3, None)], "id int, text string")
    got = [(r["node_type"], r["node_id"], r["parent_id"]) for r in tree.structure(df, "id", "text").orderBy("seq").collect()]
    assert got == [
        ("Avdelning", "A1", None), ("Kapitel", "K1", None), ("Paragraf", "K1P1", "K1"), ("Stycke", "K1P1S1", "K1P1"), ("Stycke", "K1P1S2", "K1P1"), ("Numrerad", "K1P1S2N1", "K1P1S2"),
        ("Bokstav", "K1P1S2N1Na", "K1P1S2N1"), ("Numrerad", "K1P1S2N2", "K1P1S2"), ("Paragraf", "K1P2", "K1"), ("Stycke", "K1P2S1", "K1P2"), ("Kapitel", "K2", None), ("Paragraf", "K2P1", "K2"),
        ("Stycke", "K2P1S1", "K2P1"), ("Paragraf", "K2P2a", "K2"), ("Stycke", "K2P2aS1", "K2P2a"), ("Streck", "K2P2aS1N1", "K2P2aS1"), ("Bilaga", "B1", None), ("Stycke", "B1S1", "B1"),
    ]


# Texts and the ids of their nodes in order: one case for each rule.
STRUCTURES = [
    ("Ensamt stycke.", "S1"),
    ("1 § Första.\n2 a § Andra.\nMer.", "P1 P1S1 P2a P2aS1 P2aS2"),
    ("1 Kap. Första\n1 § A.\n2 Kap. Andra\n1 § B.", "K1 K1P1 K1P1S1 K2 K2P1 K2P1S1"),
    ("1 kap. Första\nEn rubrik\n1 § A.\n2 § B.\n2 kap. Andra\nNy rubrik\n3 § C.", "K1 R1 P1 P1S1 P2 P2S1 K2 R2 P3 P3S1"),
    ("1 kap. Första\nEn rubrik\n1 § A.\n2 kap. Andra\nNy rubrik\n1 § C.", "K1 K1R1 K1P1 K1P1S1 K2 K2R1 K2P1 K2P1S1"),
    ("FÖRSTA AVDELNINGEN\nÖVERGRIPANDE\n1 kap. A\n1 § B.\nANDRA AVDELNINGEN\nANNAT\n2 kap. C\n1 § D.", "A1 K1 K1P1 K1P1S1 A2 K2 K2P1 K2P1S1"),
    ("AVD. II KAPITALVINSTER\nText.", "A2 S1"),
    ("1. Ett\n- streck\n- mer\n2. Två\na) först\nb) sedan\n- under b\n- mer under b\n3. Tre\n- nytt", "N1 N1N1 N1N2 N2 N2Na N2Nb N2NbN1 N2NbN2 N3 N3N1"),
    ("2 § Detta gäller\n4. fyra\n4 a. mer\n4 b. än mer\n- ett\n- två", "P2 P2S1 P2S1N4 P2S1N4a P2S1N4b P2S1N4bN1 P2S1N4bN2"),
    ("1 § I lagen finns\n- ett,\n- två\nTill lagen hör bilagor\n- tre", "P1 P1S1 P1S1N1 P1S1N2 P1S2 P1S2N1"),
    ("2 § Följande gäller också\n7-7 c §§ om bisysslor,\n38 § om uppsägning,\n42 §, dock inte", "P2 P2S1 P2S2 P2S3 P2S4"),
    ("Se vidare\n1 kap. 5 § andra stycket", "R1 S1"),
    ("19 kap.\n2 § har upphävts genom lag (1982:989).\n21 kap. har upphävts genom lag (1988:1556).", "K19"),
    ("1 § En lag\nÖvergångsbestämmelser\n1234:567\n1. En punkt.\n2. Två.\n1234:568\nEtt stycke.", "P1 P1S1 L1234:567 L1234:567N1 L1234:567N2 L1234:568 L1234:568S1"),
    ("[Övergångsbestämmelser]\n2001:976\nText.\nBilaga\nMer.\nBilaga\nÄn mer.", "L2001:976 L2001:976S1 B1 B1S1 B2 B2S1"),
    ("Övergångsbestämmelser\n12 § Text.", "R1 P12 P12S1"),
    ("4 kap. Krav\n" + "En rubrik som är så lång att den annars vore ett stycke, " * 2 + "dock inte\n1 § Text.", "K4 K4R1 K4P1 K4P1S1"),
]


def test_structures(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(STRUCTURES)], "id int, text string")
    got = {i: [] for i in range(len(STRUCTURES))}
    for r in tree.structure(df, "id", "text").where("node_id IS NOT NULL").orderBy("doc", "seq").collect():
        got[r["doc"]].append(r["node_id"])
    assert {i: " ".join(x) for i, x in got.items()} == {i: x for i, (_, x) in enumerate(STRUCTURES)}


def test_heading_numbers_and_anchors(spark):
    df = spark.createDataFrame([(1, i, x, "h") for i, x in enumerate([2, 3, 3, 2, 3, 1, 2])], "d int, i int, l int, a string")
    got = [r["number"] for r in tree.heading_numbers(df, "d", "i", "l").orderBy("i").collect()]
    assert got == ["1", "1.1", "1.2", "2", "2.1", "1", "1.1"]
    assert [r["unique_anchor"] for r in tree.unique_anchors(df, "d", "i", "a").orderBy("i").collect()][:3] == ["h", "h_2", "h_3"]


def test_as_of(spark):
    d = dt.date
    df = spark.createDataFrame([(1, None, d(2000, 1, 1)), (2, d(2000, 1, 1), None), (3, None, None)], "id int, valid_from date, valid_to date")
    assert [r[0] for r in rows(tree.as_of(df, F.lit("2000-01-01").cast("date")).select("id"))] == [2, 3]


EDGES = [("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "x"), ("x", "a"), (None, "a")]


def test_paths(spark):
    e = spark.createDataFrame(EDGES, "child string, parent string")
    roots = spark.createDataFrame([("a",), ("y",), (None,)], "root string")
    star = rows(closure(e, roots))
    assert star == [("a", n) for n in "abcdxy"] + [("y", "x"), ("y", "y")]
    assert ("y", "y") in rows(closure(e, roots, include_roots=False)) and ("a", "a") not in rows(closure(e, roots, include_roots=False))
    assert rows(all_pairs(e)) == sorted([(n, r) for n, r in [(n, r) for r in "abcxy" for n in "abcdxy"] if (r, n) in set(rows(closure(e, e.select(e.parent.alias("root")), False)))])
    acyclic = e.where("NOT (child = 'y' AND parent = 'x')")
    assert [r[0] for r in rows(closure_sql(spark, acyclic, "a"))] == ["a", "b", "c", "d", "x"]
    assert rows(hops(e, 2)) == [("c", "a"), ("d", "b"), ("x", "x"), ("y", "a"), ("y", "y")]


def triples(spark, data):
    return spark.createDataFrame([(g, s, p, o, "literal", None, None) for g, s, p, o in data], "g string, s string, p string, o string, o_kind string, o_datatype string, o_lang string")


def test_store(spark, tmp_path):
    path = str(tmp_path / "store")
    a = triples(spark, [("g1", "s1", "p", "1"), ("g1", "s1", "p", "1"), ("g2", "s2", "p", "2")])
    store.add(a, path)
    store.add(a, path)
    assert store.read(spark, path).count() == 2
    store.replace_subjects(triples(spark, [("g1", "s1", "q", "3")]), path)
    assert rows(store.read(spark, path).select("g", "s", "p", "o")) == [("g1", "s1", "q", "3"), ("g2", "s2", "p", "2")]


def test_replacing_leaves_no_statement_behind(spark, tmp_path):
    """A subject that moves to another graph is gone from the one it leaves,
    also where that one is then empty."""
    path = str(tmp_path / "moved")
    store.add(triples(spark, [("A", "1", "p", "old"), ("B", "2", "p", "x"), (None, "3", "p", "y"), ("C d/é", "4", "p", "z")]), path)
    store.replace_subjects(triples(spark, [("B", "1", "p", "new")]), path)
    assert rows(store.read(spark, path).select("g", "s", "o")) == [(None, "3", "y"), ("B", "1", "new"), ("B", "2", "x"), ("C d/é", "4", "z")]
    store.replace_subjects(triples(spark, [("B", "3", "p", "moved"), ("B", "4", "p", "moved")]), path)
    assert rows(store.read(spark, path).select("g", "s", "o")) == [("B", "1", "new"), ("B", "2", "x"), ("B", "3", "moved"), ("B", "4", "moved")]


def test_n_triples_both_ways(spark):
    t = triples(spark, [("g", "http://x/1", "dct:title", 'a "b"\n\\c\té')]).unionByName(spark.createDataFrame([("g", "http://x/1", "dct:isPartOf", "http://x/2", "uri", None, None), ("g", "_:b1", "dct:title", "t", "literal", None, "sv"), ("g", "http://x/1", "rinfo:d", "2001-01-01", "literal", "xsd:date", None)], "g string, s string, p string, o string, o_kind string, o_datatype string, o_lang string"))
    good, bad = files.n_triples(store.n_triples(t).withColumnRenamed("line", "value"), "g")
    want = t.withColumn("o_datatype", store.curie_expanded(F.col("o_datatype")))
    assert rows(good) == rows(want) and bad.count() == 0
    lines = spark.createDataFrame([("not a triple",), ("# comment",), ("",)], "value string")
    assert files.n_triples(lines, "g")[1].count() == 1
    assert rows(store.inlined_blank_nodes(t)) == [("_:b1", 0, True)]


def test_rdf_xml(spark, tmp_path):
    xml = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dct="http://purl.org/dc/terms/" xmlns:e="http://e/" xml:lang="sv">
      <e:Act rdf:about="http://x/1" dct:title="T"><dct:isPartOf rdf:resource="http://x/2"/><dct:issued rdf:datatype="xsd:date">2001-01-01</dct:issued>
        <dct:creator><rdf:Description><dct:title>Org &amp; Co</dct:title></rdf:Description></dct:creator><e:ref rdf:nodeID="n"/></e:Act>
      <rdf:Description rdf:about="http://x/2"><e:list rdf:parseType="Collection"><rdf:Description rdf:about="http://x/3"/></e:list></rdf:Description>
    </rdf:RDF>"""
    got = list(rdfxml.triples(xml))
    assert sorted(got, key=str) == sorted([
        ("http://x/1", "rdf:type", "http://e/Act", "uri", None, None), ("http://x/1", "dct:title", "T", "literal", None, "sv"), ("http://x/1", "dct:isPartOf", "http://x/2", "uri", None, None),
        ("http://x/1", "dct:issued", "2001-01-01", "literal", "xsd:date", None), ("http://x/1", "dct:creator", "b1", "bnode", None, None), ("_:b1", "dct:title", "Org & Co", "literal", None, "sv"),
        ("http://x/1", "http://e/ref", "n", "bnode", None, None), ("http://x/2", "http://e/list", "b2", "bnode", None, None), ("_:b2", "rdf:first", "http://x/3", "uri", None, None), ("_:b2", "rdf:rest", "rdf:nil", "uri", None, None),
    ], key=str)
    (tmp_path / "a.xml").write_text(xml)
    t = rdfxml.read(spark, str(tmp_path), "g")
    head, tail, _ = store.ENVELOPES["xml"]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "b.xml").write_text("\n".join([head, *[r[0] for r in store.serialized(t, "xml").collect()], tail]))
    again = rdfxml.read(spark, str(tmp_path / "b"), "g")
    plain = lambda df: rows(df.where("s NOT LIKE '\\\\_:%' AND o_kind <> 'bnode'"))
    assert plain(again) == plain(t) and again.count() == t.count() == 10
    with pytest.raises(ValueError, match="no such form"):
        store.serialized(t, "doc")


def test_rdf_xml_is_read_as_it_comes(spark, tmp_path):
    """The first triples are there before a document has ended, plain or gzipped."""
    one = '<rdf:Description rdf:about="http://x/{}"><dct:title>T</dct:title></rdf:Description>'
    lines = [store.ENVELOPES["xml"][0], *map(one.format, range(25_000))]
    for xml in ("\n".join(lines), "\n".join(lines).encode(), gzip.compress("\n".join(lines).encode())):
        got = rdfxml.triples(xml)
        assert next(got) == ("http://x/0", "dct:title", "T", "literal", None, None)
        with pytest.raises(ET.ParseError):
            list(got)
    (tmp_path / "a.xml.gz").write_bytes(gzip.compress("\n".join([*lines, store.ENVELOPES["xml"][1]]).encode()))
    assert rdfxml.read(spark, str(tmp_path), "g").select("s").distinct().count() == 25_000


@pytest.mark.skipif(not os.path.isdir(oracle.SF), reason="needs the test tables")
def test_rdf_xml_documents_are_more_not_larger(spark, monkeypatch):
    sizes, read = [], rdfxml.read

    def seen(spark, path, g):
        sizes.extend(len(gzip.open(p).read()) for p in pathlib.Path(path.removeprefix("file:")).rglob("*.gz"))
        return read(spark, path, g)

    monkeypatch.setattr(rdfxml, "read", seen)
    monkeypatch.setattr(ingest, "DOCUMENT_BYTES", 20_000)
    oracle.compare(spark, oracle.connection(), ingest.rdf_xml_documents, ingest.ORACLE["rdf_xml_documents"])
    assert len(sizes) > 8 and max(sizes) < 2 * 20_000


def test_turtle(spark):
    text = '@prefix a: <x> .\n<http://x/1> rdfs:label "Jordabalk"@sv ;\n  dct:alternate "JB" .\n# c\n<http://x/2> a foaf:Organization ;\n  owl:sameAs <http://x/3> .'
    lines = spark.createDataFrame(list(enumerate(text.split("\n"))), "pos int, value string")
    got = rows(files.turtle_lines(lines, "g").select("s", "p", "o", "o_kind", "o_lang"))
    assert got == [
        ("http://x/1", "dct:alternate", "JB", "literal", None), ("http://x/1", "rdfs:label", "Jordabalk", "literal", "sv"),
        ("http://x/2", "owl:sameAs", "http://x/3", "uri", None), ("http://x/2", "rdf:type", "foaf:Organization", "uri", None),
    ]


def test_readers(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("å\r\nb".encode("iso-8859-1"))
    assert files.text_files(spark, str(tmp_path / "a.txt")).select("text").collect()[0][0] == "å\r\nb"
    (tmp_path / "w.xml").write_text("<mediawiki><page><title>A</title><revision><text>#REDIRECT [[B]]</text></revision></page><page><title>B</title><revision><text>x</text></revision></page></mediawiki>")
    pages = files.wiki_export(spark, str(tmp_path / "w.xml"))
    assert rows(files.resolved(pages)) == [("A", "B"), ("B", "B")]
    (tmp_path / "r.xml").write_text("<sparql><results><result><binding name='uri'><uri>http://x</uri></binding><binding name='n'><literal>1</literal></binding></result><result><binding name='uri'><uri>http://y</uri></binding></result></results></sparql>")
    assert rows(files.query_results(spark, str(tmp_path / "r.xml"), ["uri", "n"])) == [("http://x", "1"), ("http://y", None)]
    (tmp_path / "l.tsv").write_text("d1\tl1\tn1\n")
    assert rows(files.simple_list(spark, str(tmp_path / "l.tsv"), "T")) == [("T", "d1", "l1", "n1")]
    export = spark.createDataFrame([('"A"\t"t"\t1\t2\t\tx',), ("too\tfew",)], "value string")
    assert rows(files.area_export(export)) == [("A", "t", "1", "2", "", "x")] and files.by_area(files.area_export(export)).count() == 1
    assert rows(files.list_lines(spark.createDataFrame([("1998:204#K1",), ("1999:1",), ("  ",)], "value string"))) == [("1998:204", "K1"), ("1999:1", None)]
    assert files.settings("[DEFAULT]\na = 1\n[x]\nb = 2", "x") == {"a": "1", "b": "2"}
    old = spark.createDataFrame([("p", dt.datetime(2020, 1, 1)), ("q", dt.datetime(2020, 1, 1))], "path string, modified timestamp")
    done = spark.createDataFrame([("p", dt.datetime(2020, 1, 1))], "path string, modified timestamp")
    assert rows(files.changed_since(old, done).select("path")) == [("q",)]


def test_patches(spark):
    before, after = "a\nb\nc\nd", "a\nB\nc\nd\ne"
    df = spark.createDataFrame([("s", "1", before, after), ("s", "2", "x", "x")], "source string, basefile string, text string, edited string")
    d = files.diffs(df)
    assert d.count() == 1
    got = files.patched(df.drop("edited"), d.withColumn("description", F.lit("why"))).orderBy("basefile").collect()
    assert got[0]["text"] == after and got[0]["patchdescription"] == "why" and got[1]["text"] == "x"
    with pytest.raises(ValueError, match="does not fit"):
        files.applied("q\nb", "--- a\n+++ b\n@@ -1,2 +1,2 @@\n a\n-b\n+c")


def test_basefiles(spark):
    df = spark.createDataFrame([("2006:02",), ("Dir. 2006:2.",), ("dir 1999 : 10",), ("none",), (None,)], "b string")
    assert [r[0] for r in df.select(files.year_number(F.col("b"))).collect()] == ["2006:2", "2006:2", "1999:10", None, None]
    assert spark.range(1).select(files.paged_path(F.lit(2006), F.lit(7)), files.path_basefile(F.lit("/x/2011/7.html"))).collect()[0][:] == ("06/060007", "2011:7")


def test_streams(spark, tmp_path):
    src, path = tmp_path / "in", str(tmp_path / "store")
    schema = "g string, s string, p string, o string, o_kind string, o_datatype string, o_lang string"
    for i, data in enumerate([[("g1", "s1", "p", "1")], [("g1", "s1", "p", "2"), ("g2", "s2", "p", "3")]]):
        triples(spark, data).coalesce(1).write.mode("append").parquet(str(src))
        refresh.replace_subjects(refresh.watched(spark, str(src), schema), path, str(tmp_path / "cp")).awaitTermination()
    assert rows(store.read(spark, path).select("g", "s", "p", "o")) == [("g1", "s1", "p", "2"), ("g2", "s2", "p", "3")]
    pages = str(tmp_path / "pages")
    spark.createDataFrame([("A", "x", False, dt.datetime(2020, 1, 1)), ("A", "y", False, dt.datetime(2020, 1, 2)), ("B", "z", True, dt.datetime(2020, 1, 1))], "title string, text string, minor boolean, saved_at timestamp").write.parquet(pages)
    out = str(tmp_path / "html")
    refresh.regenerated(refresh.watched(spark, pages, "title string, text string, minor boolean, saved_at timestamp"), lambda d: d, out, str(tmp_path / "cp2")).awaitTermination()
    assert rows(spark.read.parquet(out).select("title", "text")) == [("A", "y")]
    e = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 3, 1))], "id int, ts timestamp")
    assert rows(refresh.trailing(e, "ts").select("id")) == [(2,)] and refresh.trailing(e.limit(0), "ts").count() == 0
