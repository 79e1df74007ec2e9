"""Statute text to a tree of addressable nodes.

Lines are classified by patterns, and every line learns where it stands from
the lines before it in its document by window functions: chapter, section,
paragraph and list item are carried down, so no per-document Python runs. A
document's lines are one window partition; its size is that of one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_NR = "([0-9]+ ?[a-z]?)"
# Ordinals in the headings of divisions.
ORDINALS = {w: str(i) for i, w in enumerate("första andra tredje fjärde femte sjätte sjunde åttonde nionde tionde".split(), 1)}
ROMAN = {w: str(i) for i, w in enumerate("I II III IV V VI VII VIII IX X XI XII XIII XIV XV".split(), 1)}
# Beginnings of lines by node type, tried in this order.
LINE_TYPES = (
    ("Avdelning", r"^(?i)(?:AVD(?:ELNING|\.) ([IVXLC]+|[0-9]+)\b|(FÖRSTA|ANDRA|TREDJE|FJÄRDE|FEMTE|SJÄTTE|SJUNDE|ÅTTONDE|NIONDE|TIONDE) AVDELNINGEN)"),
    ("UpphavtKapitel", rf"^{_NR} kap\. *[Hh]ar upphävts"),
    #: "1 kap. 5 § andra stycket" is a reference, no heading
    ("Kapitel", rf"^{_NR} [Kk]ap\.(?! ?[0-9]+ ?[a-z]? ?§)"),
    ("UpphavdParagraf", rf"^{_NR} § *[Hh]ar upphävts"),
    #: "7-9 §§", "7 §," and "7 § om arbetskonflikter" are references
    ("Paragraf", rf"^{_NR} §(?![§,;.)]| \p{{Ll}})"),
    ("Bilaga", r"^Bilaga(?: ([0-9]+))?\b"),
    ("Overgangsbestammelser", r"^\[?Övergångsbest\p{L}+\]?$"),
    ("Overgangsbestammelse", r"^([0-9]{4}:[0-9]+)$"),
    ("Numrerad", r"^([0-9]+(?: [a-z])?)\. "),
    ("Bokstav", r"^([a-zåäö])\) "),
    ("Streck", r"^([-–]) "),
)
LISTS = ("Numrerad", "Bokstav", "Streck")
#: Longest heading, and longest one right above a section.
HEADING_WIDTH, HEADING_ABOVE = 100, 250


def line_type(line: Column, after: Column) -> Column:
    """Type of a line; ``after`` is the next one, which tells a heading from a
    paragraph that introduces a list."""
    out = None
    section = F.coalesce(after.rlike(dict(LINE_TYPES)["Paragraf"]), F.lit(False))
    for name, pattern in LINE_TYPES:
        hit = line.rlike(pattern) & ~section if name == "Overgangsbestammelser" else line.rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    listed = after.rlike("|".join(f"(?:{p})" for n, p in LINE_TYPES if n in LISTS))
    heading = ((F.length(line) < HEADING_WIDTH) | (section & (F.length(line) < HEADING_ABOVE))) & ~line.rlike(r"[.,:;!?]$") & line.rlike(r"^[A-ZÅÄÖ]") & ~F.coalesce(listed, F.lit(False))
    return out.when(heading, "Rubrik").otherwise("Stycke")


def ordinal(line: Column, kind: Column) -> Column:
    """Number of a line as its id has it: no space, divisions in figures."""
    out = None
    for name, pattern in LINE_TYPES:
        group = lambda i, p=pattern: F.nullif(F.replace(F.regexp_extract(line, p, i), F.lit(" "), F.lit("")), F.lit(""))
        if name in ("Overgangsbestammelser", "Streck"):
            x = F.lit(None).cast("string")
        elif name == "Avdelning":
            figure = F.create_map(*[F.lit(v) for kv in (ROMAN | {w.upper(): n for w, n in ORDINALS.items()}).items() for v in kv])
            word = F.upper(F.coalesce(group(1), group(2)))
            x = F.coalesce(F.element_at(figure, F.coalesce(word, F.lit(""))), word)
        else:
            x = group(1)
        out = F.when(kind == name, x) if out is None else out.when(kind == name, x)
    return out


def structure(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, seq, node_type, ordinal, node_id, parent_id, text) of every
    non-blank line of every text; a section's line is two nodes, the section
    and its first paragraph.

    Ids follow K#P#S#N#, A#, K#R#, B# and L#. Sections and headings carry their
    chapter unless there are several chapters and numbers run on through them.
    Lists hang under the paragraph they follow, letters under a number, dashes
    under a letter or else a number. A heading below a division's is a part of
    it. NULL and empty texts have no nodes. ``doc`` should be unique; texts
    under the same doc would be numbered as one.
    """
    lines = docs.select(F.col(doc).alias("doc"), F.posexplode(F.split(F.regexp_replace(text, "\r\n", "\n"), "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", F.regexp_replace(F.regexp_replace("line", r"^\s+", ""), r"\s+$", "")).where("line <> ''")
    w = Window.partitionBy("doc").orderBy("pos")
    lines = lines.withColumn("node_type", line_type(F.col("line"), F.lead("line").over(w)))
    lines = lines.withColumn("ordinal", ordinal(F.col("line"), F.col("node_type")))
    below = (F.col("node_type") == "Rubrik") & (F.lag("node_type").over(w) == "Avdelning")
    lines = lines.withColumn("node_type", F.when(below, "Underrubrik").otherwise(F.col("node_type")))
    return numbered(_with_first_paragraphs(lines))


def _with_first_paragraphs(lines: DataFrame) -> DataFrame:
    """Two rows of a section's line, one of any other."""
    head, rest = F.regexp_extract("line", rf"^{_NR} §", 0), F.regexp_replace("line", rf"^{_NR} §\s*", "")
    row = lambda kind, nr, line, k: F.struct(kind.alias("node_type"), nr.alias("ordinal"), line.alias("line"), (2 * F.col("pos") + k).alias("pos"))
    whole = row(F.col("node_type"), F.col("ordinal"), F.col("line"), 0)
    section = row(F.col("node_type"), F.col("ordinal"), head, 0)
    first = row(F.lit("Stycke"), F.lit(None).cast("string"), rest, 1)
    two = (F.col("node_type") == "Paragraf") & (rest != "")
    return lines.select("doc", F.inline(F.when(two, F.array(section, first)).otherwise(F.array(whole))))


def numbered(lines: DataFrame) -> DataFrame:
    kind = F.col("node_type")
    section = kind.isin("Paragraf", "UpphavdParagraf")
    parts = kind.isin("Kapitel", "UpphavtKapitel", "Avdelning", "Bilaga", "Overgangsbestammelse", "Overgangsbestammelser")
    w = Window.partitionBy("doc").orderBy("pos")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("doc")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    x = lines.select(
        "*",
        F.last(F.when(kind == "Kapitel", F.col("ordinal")).when(kind.isin("Bilaga", "Overgangsbestammelser", "UpphavtKapitel", "Avdelning"), F.lit("")), True).over(upto).alias("chapter"),
        count(section | parts).over(upto).alias("part"),
        count(kind == "Kapitel").over(upto).alias("nth_chapter"),
        count(kind == "Bilaga").over(upto).alias("nth_appendix"),
        ((count(kind == "Kapitel").over(whole) > 1) & (count(section & (F.col("ordinal") == "1")).over(whole) < 2)).alias("running"),
    )
    in_part = Window.partitionBy("doc", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = parts | (kind == "Rubrik") | (kind == "Underrubrik")
    k = F.when((F.coalesce("chapter", F.lit("")) == "") | F.col("running"), "").otherwise(F.concat(F.lit("K"), "chapter"))
    own = (
        F.when(section, F.concat(k, F.lit("P"), "ordinal"))
        .when(kind == "Kapitel", F.concat(F.lit("K"), "ordinal"))
        .when(kind == "Avdelning", F.concat(F.lit("A"), "ordinal"))
        .when(kind == "Bilaga", F.concat(F.lit("B"), F.coalesce("ordinal", F.col("nth_appendix").cast("string"))))
        .when(kind == "Overgangsbestammelse", F.concat(F.lit("L"), "ordinal"))
    )
    x = x.withColumn("own", own).withColumn("prefix", k)
    x = x.withColumn("base", F.coalesce(F.first(F.when(kind != "Avdelning", F.col("own")), True).over(in_part), F.lit("")))
    x = x.withColumn("piece", count(kind == "Stycke").over(in_part))
    in_piece = Window.partitionBy("doc", "part", "piece").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("item", F.last(F.when(kind == "Numrerad", F.col("ordinal")), True).over(in_piece))
    x = x.withColumn("nth_item", count(kind == "Numrerad").over(in_piece))
    in_item = Window.partitionBy("doc", "part", "piece", "nth_item").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("letter", F.last(F.when(kind == "Bokstav", F.col("ordinal")), True).over(in_item))
    x = x.withColumn("nth_letter", count(kind == "Bokstav").over(in_item))
    in_letter = Window.partitionBy("doc", "part", "piece", "nth_item", "nth_letter").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("dash", count(kind == "Streck").over(in_letter))
    of_chapter = Window.partitionBy("doc", F.when(F.col("prefix") != "", F.col("nth_chapter")).otherwise(0)).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("heading", count(kind == "Rubrik").over(of_chapter))
    piece_id = F.when(F.col("piece") > 0, F.concat("base", F.lit("S"), F.col("piece").cast("string"))).otherwise(F.col("base"))
    item_id = F.when(F.col("item").isNotNull(), F.concat(piece_id, F.lit("N"), "item")).otherwise(piece_id)
    letter_id = F.when(F.col("letter").isNotNull(), F.concat(item_id, F.lit("N"), "letter")).otherwise(item_id)
    node_id = (
        F.when(kind == "Rubrik", F.concat("prefix", F.lit("R"), F.col("heading").cast("string")))
        .when(kind == "Stycke", piece_id)
        .when(kind == "Numrerad", item_id)
        .when(kind == "Bokstav", letter_id)
        .when(kind == "Streck", F.concat(letter_id, F.lit("N"), F.col("dash").cast("string")))
        .otherwise(F.col("own"))
    )
    none = lambda c: F.nullif(c, F.lit(""))
    chapter_id = F.when(F.coalesce("chapter", F.lit("")) != "", F.concat(F.lit("K"), "chapter"))
    parent = (
        F.when(section | (kind == "Rubrik"), chapter_id)
        .when(head, F.lit(None).cast("string"))
        .when(kind == "Stycke", none(F.col("base")))
        .when(kind == "Numrerad", none(piece_id))
        .when(kind == "Bokstav", none(item_id))
        .otherwise(none(letter_id))
    )
    kept = F.when(~kind.isin("UpphavdParagraf", "UpphavtKapitel", "Underrubrik"), node_id)
    return x.select("doc", F.col("pos").alias("seq"), "node_type", "ordinal", kept.alias("node_id"), parent.alias("parent_id"), F.col("line").alias("text"))


def as_of(nodes: DataFrame, day: Column) -> DataFrame:
    """Versions in force on a day. A NULL date, be it missing or prose like
    "the day the government decides", is an open end."""
    return nodes.where((F.col("valid_from").isNull() | (F.col("valid_from") <= day)) & (F.col("valid_to").isNull() | (day < F.col("valid_to"))))


def heading_numbers(rows: DataFrame, doc: str, seq: str, level: str, top: int = 6) -> DataFrame:
    """Add ``number`` ("1.2.1") of headings with levels 1 to ``top``: a level's
    count starts anew whenever a higher heading comes. Levels left out do not
    show as zeros."""
    out = rows
    w = Window.partitionBy(doc).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.select("*", *[F.sum(F.when(F.col(level) < k, 1).otherwise(0)).over(w).alias(f"_above_{k}") for k in range(2, top + 1)])
    counts = [F.sum(F.when(F.col(level) == 1, 1).otherwise(0)).over(w)]
    for k in range(2, top + 1):
        wk = Window.partitionBy(doc, f"_above_{k}").orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts.append(F.sum(F.when(F.col(level) == k, 1).otherwise(0)).over(wk))
    parts = [F.when((F.col(level) >= k + 1) & (c > 0), c.cast("string")) for k, c in enumerate(counts)]
    return out.withColumn("number", F.concat_ws(".", *parts)).drop(*[f"_above_{k}" for k in range(2, top + 1)])


def unique_anchors(rows: DataFrame, doc: str, seq: str, anchor: str) -> DataFrame:
    """Add ``unique_anchor``: repeated anchors of a document get _2, _3, ..."""
    n = F.row_number().over(Window.partitionBy(doc, anchor).orderBy(seq))
    return rows.withColumn("unique_anchor", F.when(n == 1, F.col(anchor)).otherwise(F.concat(anchor, F.lit("_"), n.cast("string"))))
