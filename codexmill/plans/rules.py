"""Rules that SQL cannot express, on texts whose results it can.

Citations in context, the structure of statutes and wiki markup are read by
rules that carry what came before. Here a text is made for every act or concept
of the corpus, with its number or name in it, and SQL has what must come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill import model as M
from codexmill.functions import citations, markup
from codexmill.operators import tree
from codexmill.session import table

SFS, RP, EXT = f"{M.BASE}/sfs/", M.BASE, citations.EXT

CITING = (
    "Enligt 4 § förvaltningslagen (@) och 5 § samma lag gäller tredje stycket 2, 3 eller 4 b. Se @, 2 kap. 3 a § andra stycket, NJA 1998 s. 14, AD 2008 nr 28, RH 2007:108, "
    "prop. 1997/98:45, bet. 1997/98:KU13, rskr. 1997/98:180, 392L0100, 32004L0019, Case C-176/09, T‑3/99 och JB 22:2 eller BrB 3:1 2 st."
)
#: Links in order: what is linked and where to; '@' is the number of the act.
CITED = (
    ("4 § förvaltningslagen (@)", f"{SFS}@#P4"), ("5 § samma lag", f"{SFS}@#P5"), ("tredje stycket 2", f"{SFS}9999:999#S3N2"), ("3", f"{SFS}9999:999#S3N3"),
    ("4 b", f"{SFS}9999:999#S3N4b"), ("@", f"{SFS}@"), ("2 kap. 3 a § andra stycket", f"{SFS}9999:999#K2P3aS2"), ("NJA 1998 s. 14", f"{RP}/rattsfall/nja/1998s14"),
    ("AD 2008 nr 28", f"{RP}/rattsfall/ad/2008:28"), ("RH 2007:108", f"{RP}/rattsfall/rh/2007:108"), ("prop. 1997/98:45", f"{RP}/prop/1997/98:45"),
    ("bet. 1997/98:KU13", f"{EXT}/bet/1997/98:KU13"), ("rskr. 1997/98:180", f"{EXT}/rskr/1997/98:180"), ("392L0100", f"{EXT}/celex/31992L0100"), ("32004L0019", f"{EXT}/celex/32004L0019"),
    ("Case C-176/09", f"{EXT}/ecj/C-176/09"), ("T‑3/99", f"{EXT}/ecj/T-3/99"), ("JB 22:2", f"{SFS}1970:994#K22P2"), ("BrB 3:1 2 st.", f"{SFS}1962:700#K3P1S2"),
)

STATUTE = """FÖRSTA AVDELNINGEN
INLEDNING
1 kap. Om lag @
Tillämpning
1 § Lagen gäller
1. den som
a) söker
- skriftligen
- muntligen
b) svarar
2. andra
Andra stycket.
2 § har upphävts genom lag (@).
2 kap. Om annat
Undantag
1 § Första.
3 a § Se
7-9 §§ om annat,
1 kap. 1 § gäller.
Övergångsbestämmelser
@
1. Denna lag träder i kraft.
Bilaga
Förteckning över annat."""
#: (type, id, parent) of each node in order.
NODES = (
    ("Avdelning", "A1", None), ("Underrubrik", None, None), ("Kapitel", "K1", None), ("Rubrik", "K1R1", "K1"), ("Paragraf", "K1P1", "K1"), ("Stycke", "K1P1S1", "K1P1"),
    ("Numrerad", "K1P1S1N1", "K1P1S1"), ("Bokstav", "K1P1S1N1Na", "K1P1S1N1"), ("Streck", "K1P1S1N1NaN1", "K1P1S1N1Na"), ("Streck", "K1P1S1N1NaN2", "K1P1S1N1Na"),
    ("Bokstav", "K1P1S1N1Nb", "K1P1S1N1"), ("Numrerad", "K1P1S1N2", "K1P1S1"), ("Stycke", "K1P1S2", "K1P1"), ("UpphavdParagraf", None, "K1"), ("Kapitel", "K2", None), ("Rubrik", "K2R1", "K2"),
    ("Paragraf", "K2P1", "K2"), ("Stycke", "K2P1S1", "K2P1"), ("Paragraf", "K2P3a", "K2"), ("Stycke", "K2P3aS1", "K2P3a"), ("Stycke", "K2P3aS2", "K2P3a"), ("Stycke", "K2P3aS3", "K2P3a"),
    ("Overgangsbestammelser", None, None), ("Overgangsbestammelse", "L@", None), ("Numrerad", "L@N1", "L@"), ("Bilaga", "B1", None), ("Stycke", "B1S1", "B1"),
)

PAGE = """__FORCETOC__
== Om @ ==
'''@''' är ''kort'' och '''''båda'''''. Hur ? Så !
* ett
** två
* tre
# fyra
: indrag
-----
{| border="1" onclick="x"
|+ Tabell
! Nr !! Namn
|-
| 1 || @
|}
<b>fet</b> <script>bort</script> &amp; &nosuch; <nowiki>''så''</nowiki><!-- inte med -->
[[@|länk]] [http://x.example/a text] [[Kategori:Avtal]]
 förformaterat

=== Om @ ==="""
HTML = (
    '<ul id="toc"><li class="toc-2"><a href="#w_om-@">1 Om @</a></li><li class="toc-3"><a href="#w_om-@_2">1.1 Om @</a></li></ul>'
    '<h2 id="w_om-@">Om @</h2><p><b>@</b> är <i>kort</i> och <i><b>båda</b></i>. Hur&nbsp;? Så&nbsp;!</p><ul><li>ett<ul><li>två</li></ul></li><li>tre</li></ul><ol><li>fyra</li></ol><dl><dd>indrag</dd></dl><hr />'
    '<table border="1"><caption>Tabell</caption><tr><th>Nr</th><th>Namn</th></tr><tr><td>1</td><td>@</td></tr></table>'
    "<p><b>fet</b> &lt;script&gt;bort&lt;/script&gt; &amp; &amp;nosuch; ''så''\n"
    '<a href="http://rinfo.example/concept/@">länk</a> <a href="http://x.example/a" rel="nofollow">text</a> </p><pre>förformaterat\n</pre><h3 id="w_om-@_2">Om @</h3>'
)


def _filled(template: str, c: Column) -> Column:
    return F.replace(F.lit(template), F.lit("@"), c)


def _acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nodes").select(F.col("sfsnr").alias("nr")).where(F.col("nr").rlike("^[0-9]{4}:[0-9]+$")).distinct()


def citation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links in a text about each act: provisions with their act, "samma lag",
    enumerations that inherit a paragraph, bare numbers, cases, bills, EU acts
    and cases, short titles."""
    runs = _acts(spark, sf_dir).select("nr", citations.linked(citations.SHORT_TITLES)(_filled(CITING, F.col("nr")), F.lit(None).cast("string")).alias("runs"))
    whole = F.array_join(F.transform("runs", lambda r: r["text"]), "") == _filled(CITING, F.col("nr"))
    return runs.select("nr", whole.alias("whole"), F.posexplode(F.filter("runs", lambda r: r["uri"].isNotNull())).alias("k", "run")).select("nr", "whole", "k", "run.text", "run.uri")


def structure_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of a statute made for each act: divisions, chapters, headings,
    sections, lists of three levels, repealed sections, transitional provisions
    and appendices."""
    n = tree.structure(_acts(spark, sf_dir).select("nr", _filled(STATUTE, F.col("nr")).alias("text")), "nr", "text")
    return n.select(F.col("doc").alias("nr"), "node_type", "node_id", "parent_id")


def markup_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of markup made for each concept, as HTML without line breaks
    between elements."""
    name = F.regexp_extract("text", r"^'''([A-ZÅÄÖ]\p{L}+)'''", 1)
    names = table(spark, sf_dir, "documents").where("source = 'wiki'").select(F.regexp_extract(F.translate(name, "ÅÄÖåäö", "AAOaao"), "^([A-Za-z]+)$", 1).alias("name")).where("name <> ''").distinct()
    page = markup.html(_filled(PAGE, F.col("name")))
    return names.select("name", F.regexp_replace(page, "(?<=>)\n(?=<)", "").alias("html"))


QUERIES = {f.__name__: f for f in (citation_rules, structure_rules, markup_rules)}

_ACTS = "acts AS (SELECT DISTINCT sfsnr AS nr FROM nodes WHERE regexp_matches(sfsnr, '^[0-9]{4}:[0-9]+$'))"


def _values(rows: tuple[tuple[str | None, ...], ...]) -> str:
    text = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({i}, " + ", ".join(map(text, r)) + ")" for i, r in enumerate(rows))


ORACLE = {
    "citation_rules": f"WITH {_ACTS}, c(k, text, uri) AS (VALUES {_values(CITED)}) SELECT nr, true AS whole, CAST(k AS INT) AS k, replace(text, '@', nr) AS text, replace(uri, '@', nr) AS uri FROM acts, c",
    "structure_rules": f"WITH {_ACTS}, n(k, node_type, node_id, parent_id) AS (VALUES {_values(NODES)}) SELECT nr, node_type, replace(node_id, '@', nr) AS node_id, replace(parent_id, '@', nr) AS parent_id FROM acts, n",
    "markup_rules": """WITH n AS (SELECT DISTINCT regexp_extract(translate(regexp_extract(text, '^''''''([A-ZÅÄÖ]\\p{L}+)''''''', 1), 'ÅÄÖåäö', 'AAOaao'), '^([A-Za-z]+)$', 1) AS name FROM documents WHERE source = 'wiki')
SELECT name, replace(replace('""" + HTML.replace("'", "''") + """', 'w_om-@', 'w_om-' || lower(name)), '@', name) AS html FROM n WHERE name <> ''""",
}
