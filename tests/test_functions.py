import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codexmill.functions import citations as C
from codexmill.functions import markup
from codexmill.functions import text as X
from codexmill.functions import uri as U
from codexmill.model import BASE
from tests.conftest import rows

# Property records and their URIs: one of each kind.
RECORDS = [
    ({"type": 1, "law": "1998:204"}, f"{BASE}/sfs/1998:204"),
    ({"type": 1, "law": "1960:729", "chapter": "23", "section": "4", "piece": "1", "item": "4"}, f"{BASE}/sfs/1960:729#K23P4S1N4"),
    ({"type": 7, "publikation": "ad", "artal": "2004", "lopnummer": "43"}, f"{BASE}/rattsfall/ad/2004:43"),
    ({"type": 7, "publikation": "nja", "artal": "2004", "sidnummer": "43"}, f"{BASE}/rattsfall/nja/2004s43"),
    ({"type": 8, "myndighet": "jk", "dnr": "1075-02-40"}, f"{BASE}/beslut/jk/1075-02-40"),
]


def record_frame(spark, records):
    schema = "type int, " + ", ".join(f"{f} string" for f in U.FIELDS)
    return spark.createDataFrame([tuple(r.get(k) for k in ("type", *U.FIELDS)) for r in records], schema)


def test_uris_both_ways(spark):
    got = [r[0] for r in record_frame(spark, [r for r, _ in RECORDS]).select(U.construct(F.struct("type", *U.FIELDS))).collect()]
    assert got == [u for _, u in RECORDS]
    df = spark.createDataFrame([(u,) for _, u in RECORDS], "u string").select(U.parse(F.col("u")).alias("r"))
    assert [{k: v for k, v in r["r"].asDict().items() if v is not None} for r in df.collect()] == [r for r, _ in RECORDS]


def test_uri_edge_cases(spark):
    us = [f"{BASE}/sfs/1845:50_s._1", f"{BASE}/sfs/1999:1#L1998:3", f"{BASE}/sfs/1999:1#P26a", f"{BASE}/sfs/1999:1#P5S1N1Na", f"{BASE}/rattsfall/ad/2004 nr 5", "nothing", None]
    df = spark.createDataFrame([(u,) for u in us], "u string").select(U.parse(F.col("u")).alias("r"))
    got = [r["r"] and {k: v for k, v in r["r"].asDict().items() if v is not None} for r in df.collect()]
    assert got[0] == {"type": 1, "law": "1845:50_s"} and got[1] == {"type": 1, "law": "1999:1"}
    assert got[2] == {"type": 1, "law": "1999:1", "section": "26a"} and got[3]["item"] == "1"
    assert got[4] == {"type": 7, "publikation": "ad", "artal": "2004", "lopnummer": "5"} and got[5] is None and got[6] is None
    bad = record_frame(spark, [{"type": 7, "publikation": "nja", "artal": "2004"}, {"type": 3}]).select(U.construct(F.struct("type", *U.FIELDS)))
    assert [r[0] for r in bad.collect()] == [f"{BASE}/rattsfall/nja/2004sNone", None]


def test_uri_roundtrip_property(spark):
    import itertools

    parts = [{"type": 1, "law": "1999:1"} | {k: v for k, v in zip(("chapter", "section", "piece", "item"), c, strict=True) if v} for c in itertools.product((None, "1", "12a"), (None, "3", "4b"), (None, "2"), (None, "1", "9"))]
    df = record_frame(spark, parts).select(F.struct("type", *U.FIELDS).alias("r"), U.construct(F.struct("type", *U.FIELDS)).alias("u"))
    assert df.where(U.parse(F.col("u")).cast(df.schema["r"].dataType) != F.col("r")).count() == 0
    assert df.count() == len(parts)


A = f"{BASE}/sfs/"
EXT = BASE.rsplit("/", 1)[0] + "/ext"
CITED = [
    ("AD 2008 nr 28", [("AD 2008 nr 28", f"{BASE}/rattsfall/ad/2008:28")]),
    ("NJA 1998 s. 14", [("NJA 1998 s. 14", f"{BASE}/rattsfall/nja/1998s14")]),
    ("RH 2007:108", [("RH 2007:108", f"{BASE}/rattsfall/rh/2007:108")]),
    ("1998:204", [("1998:204", A + "1998:204")]),
    ("avses i tredje stycket 2, 3 eller 4 b i denna paragraf", [("avses i ", None), ("tredje stycket 2", A + "9999:999#S3N2"), (", ", None), ("3", A + "9999:999#S3N3"), (" eller ", None), ("4 b", A + "9999:999#S3N4b"), (" i denna paragraf", None)]),
    ("4 §\nindrivningsförordningen (1993:1229). Av 3 § samma förordning framgår", [("4 §\nindrivningsförordningen (1993:1229)", A + "1993:1229#P4"), (". Av ", None), ("3 § samma förordning", A + "1993:1229#P3"), (" framgår", None)]),
    ("JB 22:2. RB 5:1 2 st.", [("JB 22:2", A + "1970:994#K22P2"), (". ", None), ("RB 5:1 2 st.", A + "1942:740#K5P1S2")]),
    ("Prop. 1996/97:85, bet. 1996/97:NU11, rskr. 1996/97:266", [("Prop. 1996/97:85", f"{BASE}/prop/1996/97:85"), (", ", None), ("bet. 1996/97:NU11", f"{EXT}/bet/1996/97:NU11"), (", ", None), ("rskr. 1996/97:266", f"{EXT}/rskr/1996/97:266")]),
    ("32002L0019\n392L0100  393L0083", [("32002L0019", f"{EXT}/celex/32002L0019"), ("\n", None), ("392L0100", f"{EXT}/celex/31992L0100"), ("  ", None), ("393L0083", f"{EXT}/celex/31993L0083")]),
    ("", [("", None)]),
]


@pytest.mark.parametrize(("text", "want"), CITED)
def test_citations(text, want):
    assert C.runs(text, aliases={"JB": "1970:994", "RB": "1942:740"}) == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0123456789 §kap.,()abLagNJAs:stycketförsta\n", max_size=80))
def test_citation_runs_concatenate(text):
    assert "".join(t for t, _ in C.runs(text)) == text


BARE = [
    ("1998:204", ["1998:204"]),
    ("SFS 1980:855\nRubrik: Lag (SFS 1985:206), 1990:1: se", ["1980:855", "1985:206", "1990:1"]),
    ("enligt lag 1998:204 och 1942:740.", ["1998:204", "1942:740"]),
    ("LAG 1998:204", ["1998:204"]),
    ("(1998:204) prop. 1982:135 s. 2, Ds 1999:3, dir. 2001:4, RÅ 1995:6, NJA 1998:7", []),
    ("SOU 1965:115, 1966:3 och 1967:8, SKVFS 2005:12, HSLF-FS 2015:3, prop. 1999/2000:12", []),
    ("http://x.example/sfs/1998:204, 11998:204, 1998:204:3", []),
    (None, None),
]


def test_bare_numbers_of_acts(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(BARE)], "i int, t string")
    got = {r[0]: r[1] for r in df.select("i", C.naked(F.col("t"))).collect()}
    assert [got[i] for i in range(len(BARE))] == [w if w is None else [f"{BASE}/sfs/{x}" for x in w] for _, w in BARE]


def test_eu_cases(spark):
    text = "By order in Case F\u201123/07 M v EMEA, Case C\u2011197/09 RX\u2011II and C-176/09, not AC-1/09 nor T-1/2009"
    got = spark.createDataFrame([(text,)], "t string").select(C.eu_cases(F.col("t"))).collect()[0][0]
    assert got == [f"{C.EXT}/ecj/{x}" for x in ("F-23/07", "C-197/09", "C-176/09")]


def test_simple_citations_as_columns(spark):
    df = spark.createDataFrame([("se NJA 1998 s. 14 och AD 2008 nr 28, prop. 1996/97:85 och 392L0100 (1998:204)",), (None,), ("",)], "t string")
    got = df.select(C.cases(F.col("t")), C.publications(F.col("t")), C.acts(F.col("t"))).collect()
    assert got[0][0] == [f"{BASE}/rattsfall/nja/1998s14", f"{BASE}/rattsfall/ad/2008:28"]
    assert got[0][1] == [f"{BASE}/prop/1996/97:85", f"{EXT}/celex/31992L0100"] and got[0][2] == [A + "1998:204"]
    assert got[2][0] == []


@pytest.mark.parametrize(("wiki", "html"), [
    ("''a'' '''b''' '''''c'''''", "<p><i>a</i> <b>b</b> <i><b>c</b></i></p>"),
    ("'''''a''' b''", "<p><i><b>a</b> b</i></p>"),
    ("'''''a'' b'''", "<p><b><i>a</i> b</b></p>"),
    ("''open", "<p><i>open</i></p>"),
    ("* a\n** b\n* c\n# d", "<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul><ol><li>d</li></ol>"),
    ("; term\n: def", "<dl><dt>term</dt><dd>def</dd></dl>"),
    ("{|\n! A !! B\n|-\n| 1 || 2\n|}", "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>"),
    ("{|\n|}", ""),
    ("----", "<hr />"),
    ("<nowiki>''x''</nowiki>", "<p>''x''</p>"),
    ("<script>x</script>", "<p>&lt;script&gt;x&lt;/script&gt;</p>"),
    ("<b>x", "<p><b>x</b></p>"),
    ("a & b &amp; c", "<p>a &amp; b &amp; c</p>"),
    ("a <!-- c --> b", "<p>a  b</p>"),
    ("[http://x.example/ y]", '<p><a href="http://x.example/" rel="nofollow">y</a></p>'),
    ("", ""),
])
def test_markup(wiki, html):
    assert markup.render(wiki) == html


def test_markup_headings_and_contents():
    out = markup.render("== A ==\n=== B ===\n== A ==\n== C ==\ntext")
    assert '<ul id="toc">' in out and 'id="w_a_2"' in out and "1.1 B" in out and "3 C" in out
    assert "toc" not in markup.render("== A ==\n== B ==") and "toc" in markup.render("__FORCETOC__\n== A ==")


def test_hooks_reach_the_workers(spark):
    df = spark.createDataFrame([("<loud>x</loud>",)], "t string")
    shout = {"loud": lambda body, attrs: f"<b>{body.upper()}</b>"}
    assert df.select(markup.html("t", hooks=shout)).collect()[0][0] == "<p><b>X</b></p>"
    assert df.select(markup.html("t")).collect()[0][0] == "<p>&lt;loud&gt;x&lt;/loud&gt;</p>"
    markup.register_hook("loud", shout["loud"])
    try:
        assert df.select(markup.html_lite("t")).collect()[0][0] == "<p><b>X</b></p>"
    finally:
        del markup.HOOKS["loud"]


def test_attributes_by_element_and_code_points():
    assert markup.render('<table border="1" cite="x"><tr><td height="2">a</td></tr></table>') == '<table border="1"><tr><td height="2">a</td></tr></table>'
    assert markup.render('<span height="2" lang="sv" onclick="x">a</span>') == '<p><span lang="sv">a</span></p>'
    assert markup.render('<blockquote cite="u">a</blockquote><ol start="3"><li value="4">b</li></ol>') == '<blockquote cite="u">a</blockquote><ol start="3"><li value="4">b</li></ol>'
    assert markup.render("&#65; &#0; &#xD800; &#x1F600; &eacute; &nosuch; &") == "<p>&#65; &amp;#0; &amp;#xD800; &#x1F600; &eacute; &amp;nosuch; &amp;</p>"


DEFINED = [
    ("Med ren förmögenhetsskada förstås i denna lag sådan skada.", ["ren förmögenhetsskada"]),
    ("Inteckning får på ansökan dödas (dödning). För dödning krävs", ["dödning"]),
    ("I denna lag betyder\n1. affärsförbindelse: en förbindelse,\n2. brevlådebank: ett institut", ["affärsförbindelse", "brevlådebank"]),
    ("I förordningen avses med\nriksdagspension - pension enligt lagen\ntjänstepension - pension", ["riksdagspension", "tjänstepension"]),
    ("I denna förordning avses med\n- funktionshinder: fysiska\na) hemskola: den skola", ["funktionshinder", "hemskola"]),
    ("Den som smädar annan dömes, om gärningen ej är belagd med straff enligt 1 §, för förolämpning till böter.", ["förolämpning"]),
    ("För miljöbrott döms till böter. Om grovt, skall för grovt brott dömas till fängelse. Den döms för mord till fängelse.", ["miljöbrott", "grovt brott", "mord"]),
    ("Rubrik: inget (se lag). 1. nej: inte här", []),
    (None, None),
]


def test_definitions_of_every_form(spark):
    df = spark.createDataFrame([(t,) for t, _ in DEFINED], "t string")
    got = [r[0] for r in df.select(C.definitions(F.col("t"))).collect()]
    assert [x and sorted(x) for x in got] == [x and sorted(x) for _, x in DEFINED]


def test_amendment_notes(spark):
    df = spark.createDataFrame([("Text. Lag (1234:567). Mer. Förordning (2003:1116).",), ("enligt lag (1:2) utan punkt",), (None,)], "t string")
    assert [r[0] for r in df.select(C.amendment_notes(F.col("t"))).collect()] == [["1234:567", "2003:1116"], [], None]


def test_a_line_with_a_space_ends_a_paragraph():
    assert markup.render("text\n förformaterat\n mer\nslut") == "<p>text</p><pre>förformaterat\nmer\n</pre><p>slut</p>"


def test_command_line(spark, capsys, tmp_path):
    from codexmill.__main__ import main

    main(["list"])
    assert "inbound_links" in capsys.readouterr().out
    main(["run", "top_cited", "/root/testdata/sf0.001", "--out", str(tmp_path / "o")])
    assert spark.read.parquet(str(tmp_path / "o")).count() == 20
    main(["profile", "top_cited", "/root/testdata/sf0.001"])
    assert capsys.readouterr().out.startswith("top_cited: ")
    with pytest.raises(SystemExit, match="no such query"):
        main(["run", "none", "x"])


def test_tab_stops(spark):
    ts = ["a\tb", "\t", "12345678\tx\ty", "å\tb\n123\t4", "", None, "no tabs"]
    df = spark.createDataFrame([(t,) for t in ts], "t string")
    assert [r[0] for r in df.select(X.expanded_tabs(F.col("t"))).collect()] == [None if t is None else t.expandtabs(8) for t in ts]
    assert df.select(X.cleaned(F.col("t"), strip=False, dewrap=False)).collect()[3][0] == "å       b\n123     4"
    assert "Python" not in df.select(X.cleaned(F.col("t")))._jdf.queryExecution().executedPlan().toString()


def test_templates_and_categories():
    t = {"Lag": "''{{{1}}}'' ({{{nr|okänt}}})", "Loop": "{{Loop}}", "Yttre": "[{{Lag|{{{1}}}|nr=2}}]"}
    assert markup.expanded("Se {{Lag|avtalslagen|nr=1915:218}} och {{Lag|x}}.", t) == "Se ''avtalslagen'' (1915:218) och ''x'' (okänt)."
    assert markup.expanded("{{Yttre|a}} {{Saknas|b}} {{Loop}}", t) == "[''a'' (2)] [[Mall:Saknas]] [[Mall:Loop]]"
    assert markup.render("{{Lag|a}}", templates=t) == "<p><i>a</i> (okänt)</p>"
    assert markup.categories("[[Kategori:Avtal]] [[:Kategori:Köp]]") == ["Avtal"]
    assert markup.render("x [[Kategori:Avtal]]") == "<p>x </p>" and ">Köp</a>" in markup.render("[[:Kategori:Köp|Köp]]")


def test_short_urls(spark):
    urls = ["http://a.example/b", "http://a.example/" + "x" * 50, "http://a.example/" + "y/" * 30 + "end/", "http://" + "h" * 60]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(X.short_url(F.col("u"))).collect()]
    assert got == [urls[0], "http://a.example/" + "x" * 36 + "...", urls[2][:37] + ".../end/", "http://" + "h" * 36 + "..."]
    assert got == [markup.shortened(u) for u in urls]


def test_hooks_and_categories():
    markup.register_hook("quote", lambda body, attrs: f"<q cite='{attrs.get('by')}'>{body}</q>")
    assert markup.render('<quote by="me">x</quote>') == "<p><q cite='me'>x</q></p>"
    markup.HOOKS.clear()
    assert markup.categories("[[Kategori:Rätt]] [[:Kategori:Annan]]") == ["Rätt"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="'{|}!-=*#:;<>b/ \nx[]&", max_size=60))
def test_markup_never_fails(text):
    markup.render(text)
    markup.render(text, lite=True)


def test_text_units(spark):
    df = spark.createDataFrame([(1, "a\nb\n\nc\n"), (2, ""), (3, None), (4, "\n")], "id int, text string")
    assert rows(X.exploded(df, "text", "\n")) == [(1, 0, "a"), (1, 1, "b"), (1, 2, ""), (1, 3, "c"), (4, 0, "")]
    assert rows(X.exploded(df, "text", "\n\n")) == [(1, 0, "a\nb"), (1, 1, "c\n"), (4, 0, "\n")]
    p = X.offsets(X.exploded(df, "text", "\n"), ["id"], "\n").where("id = 1").orderBy("pos").collect()
    assert [r["start"] for r in p] == [0, 2, 4, 5]
    t = F.lit("abc def ghi")
    one = spark.range(1).select(X.cue(t, "def"), X.cue_past(t, "def"), X.read_to(t, "def"), X.cue(t, "zz"), X.read_to(t, "zz"), X.read(t, 3, 4), X.truncated(t, 6), X.before(t, "q"), X.after(t, "abc ")).collect()[0]
    assert tuple(one) == (4, 7, "abc ", None, None, "def", "abc...", "", "def ghi")
    tabs = spark.createDataFrame([("  a\tb\nc  ",), (None,)], "t string").select(X.cleaned(F.col("t"))).collect()
    assert [r[0] for r in tabs] == ["a       b c", None]


def test_names_and_rules(spark):
    f = lambda c: spark.range(1).select(c).collect()[0][0]
    assert f(X.slug(F.lit(" Åre / Ö_x.y!? "))) == "are-o-x-y"
    assert f(X.slug(F.lit(None).cast("string"))) is None
    assert f(X.celex(F.lit("392L0100"))) == "31992L0100" and f(X.celex(F.lit("32002L0019"))) == "32002L0019"
    assert [f(X.official_pdf(F.lit(y), F.lit(n))) for y, n in ((1998, 305), (1998, 306), (2018, 159), (2018, 160), (2020, 1))] == [False, True, True, False, False]
    assert f(X.authentic_version(F.lit(2018), F.lit(160)))
    assert [f(X.paragraph_marker(F.lit(x))) for x in ("K2P3S1", "K2P3S2", "P3S1", "P3S4")] == ["K2", "S2", None, "S4"]
    assert f(U.last_index_of(F.lit("a/b/c"), "/")) == 4 and f(U.namespace(F.lit("http://x/y#z"))) == "http://x/y#"
    assert f(U.normalised(F.lit(" http://x//y///z "))) == "http://x/y/z"
    assert f(C.concept(F.lit("god man"))) == BASE.rsplit("/", 1)[0] + "/concept/God_man"
    s = spark.createDataFrame([("<!--start:P1-->a\nb<!--end:P1--> x <!--start:P2-->c<!--end:P2-->",)], "t string").select(markup.slots(F.col("t"))).collect()[0][0]
    assert [(x["slot"], x["body"]) for x in s] == [("P1", "a\nb"), ("P2", "c")]
