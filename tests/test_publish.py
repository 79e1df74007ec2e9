import datetime as dt

from pyspark.sql import functions as F

from codexmill.operators import publish as P
from tests.conftest import rows


def test_values(spark):
    data = [("<x>", "uri", None, None, "T&"), ("1", "literal", "xsd:int", None, None), ("å", "literal", None, "sv", None), ("<", "literal", None, None, None), (None, "literal", None, None, None)]
    df = spark.createDataFrame(data, "o string, k string, d string, l string, t string")
    got = [r[0] for r in df.select(P.rendered_value(*[F.col(c) for c in "okdlt"])).collect()]
    assert got == ['<a href="&lt;x&gt;">T&amp;</a>', '<span datatype="xsd:int">1</span>', '<span xml:lang="sv">å</span>', "&lt;", None]


def test_pages_and_order(spark):
    n = spark.createDataFrame([("d", "K1", "Kapitel", "Om & så", None, 1), ("d", None, "Forfattning", None, "x", 0)], "doc string, node_id string, node_type string, rubrik string, text string, seq int")
    assert rows(P.statute_pages(n))[0][1] == '<div class="forfattning">x</div>\n<div class="kapitel" id="K1"><h2>Om &amp; så</h2></div>'
    e = spark.createDataFrame([("c", "p", x, x, x) for x in ("öl", "zon", "Åre", "ab", "äv")], "category string, page string, sortkey string, title string, uri string")
    assert [r["title"] for r in P.index_pages(e).orderBy("rank").collect()] == ["ab", "zon", "Åre", "äv", "öl"]
    r = spark.createDataFrame([("main",), ("note",), (None,)], "role string")
    assert P.without_roles(r, "role").count() == 2
    x = spark.range(1).select(P.as_xhtml(F.lit('<section role="a"><h>t</h></section>'))).collect()[0][0]
    assert x == '<div class="a"><h2>t</h2></div>'


def test_feed_tables_and_bytes(spark):
    f = spark.createDataFrame([(1, "t", "u", dt.datetime(2020, 1, 2, 3, 4, 5), " ", "c"), (2, "t", "u", None, "s", "c")], "id int, title string, uri string, ts timestamp, shortdesc string, content string")
    got = {r["id"]: r for r in P.feed(f).collect()}
    assert got[1]["summary"] == "c" and got[1]["updated"] == "2020-01-02T03:04:05Z" and got[2]["summary"] == "s"
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(["A  B", "c\td", "text", "e | f | g"])], "doc_id int, pos int, chunk string")
    assert rows(P.layout_tables(lines)) == [(1, 1, 1, 2, "A", "B"), (1, 1, 2, 2, "c", "d"), (1, 2, 1, 3, "e", "g")]
    b = spark.createDataFrame([(bytearray("å".encode()),), (bytearray("å".encode("latin-1")),), (None,)], "c binary")
    assert [r[0] for r in b.select(P.decoded(F.col("c"))).collect()] == ["å", "å", None]
