"""What pages are made of: metadata, statute pages, index pages, feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def escaped(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def rendered_value(o: Column, kind: Column, datatype: Column, lang: Column, title: Column) -> Column:
    """A value as a link with its title, a typed, a language-tagged or a plain literal."""
    link = F.concat(F.lit('<a href="'), escaped(o), F.lit('">'), escaped(F.coalesce(title, o)), F.lit("</a>"))
    typed = F.concat(F.lit('<span datatype="'), datatype, F.lit('">'), escaped(o), F.lit("</span>"))
    tagged = F.concat(F.lit('<span xml:lang="'), lang, F.lit('">'), escaped(o), F.lit("</span>"))
    return F.when(kind == "uri", link).when(datatype.isNotNull(), typed).when(lang.isNotNull(), tagged).otherwise(escaped(o))


def statute_pages(nodes: DataFrame) -> DataFrame:
    """(doc, html): nodes (doc, node_id, node_type, rubrik, text, seq) in order.
    A page is one document, so its nodes are one row by purpose."""
    part = F.concat(
        F.lit('<div class="'), F.lower("node_type"), F.lit('"'),
        F.when(F.col("node_id").isNotNull(), F.concat(F.lit(' id="'), "node_id", F.lit('"'))).otherwise(""), F.lit(">"),
        F.when(F.col("rubrik").isNotNull(), F.concat(F.lit("<h2>"), escaped(F.col("rubrik")), F.lit("</h2>"))).otherwise(""),
        escaped(F.coalesce("text", F.lit(""))), F.lit("</div>"),
    )
    rows = F.array_sort(F.collect_list(F.struct("seq", F.coalesce("node_id", F.lit("")).alias("node_id"), part.alias("html"))))
    return nodes.groupBy("doc").agg(rows.alias("r")).select("doc", F.array_join(F.transform("r", lambda x: x["html"]), "\n").alias("html"))


def document_page(kind: str, uri: Column, title: Column, meta: dict[str, Column], body: Column) -> Column:
    """A page of one document other than a statute: its type, title, what is
    known about it (properties without a value do not show) and its paragraphs,
    an ARRAY<STRING>."""
    known = F.concat(*[F.coalesce(F.concat(F.lit(f'<dt property="{p}">{p}</dt><dd>'), escaped(v), F.lit("</dd>")), F.lit("")) for p, v in meta.items()])
    text = F.array_join(F.transform(F.coalesce(body, F.array().cast("array<string>")), lambda x: F.concat(F.lit("<p>"), escaped(x), F.lit("</p>"))), "")
    return F.concat(
        F.lit('<html about="'), escaped(F.coalesce(uri, F.lit(""))), F.lit('"><head><title>'), escaped(F.coalesce(title, F.lit(""))),
        F.lit(f'</title></head><body typeof="{kind}"><dl>'), known, F.lit('</dl><div role="main">'), text, F.lit("</div></body></html>"),
    )


def keyword_pages(entries: DataFrame) -> DataFrame:
    """(page, keyword, rank, title, uri): index pages with a level of keywords,
    by first letter, entries of a keyword in order of title."""
    page = F.upper(F.left("keyword", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy("keyword").orderBy("title", "uri"))
    return entries.select(page.alias("page"), "keyword", rank.alias("rank"), "title", "uri")


def without_roles(nodes: DataFrame, role: str, dropped: tuple[str, ...] = ("contentinfo", "navigation", "note")) -> DataFrame:
    return nodes.where(~F.coalesce(F.col(role), F.lit("")).isin(*dropped))


def as_xhtml(xml: Column) -> Column:
    """Elements of the intermediate form by their names in XHTML: sections are
    divisions and a role becomes a class."""
    x = F.regexp_replace(xml, r"<(/?)section\b", "<$1div")
    return F.regexp_replace(F.regexp_replace(x, r'\brole="', 'class="'), r"<(/?)h>", "<$1h2>")


def index_pages(entries: DataFrame, collation: str = "sv") -> DataFrame:
    """(category, page, rank, title, uri): the order of entries on their page,
    by the alphabet of ``collation`` (å, ä and ö come last in Swedish)."""
    order = F.collate("sortkey", collation)
    return entries.select("category", "page", F.row_number().over(Window.partitionBy("category", "page").orderBy(order, "uri")).alias("rank"), "title", "uri")


def feed(entries: DataFrame) -> DataFrame:
    """Entries of a feed: a short description counts before the content."""
    text = F.coalesce(F.nullif(F.trim("shortdesc"), F.lit("")), F.col("content"))
    return entries.select("id", "title", "uri", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated"), text.alias("summary"))


def cells(line: Column) -> Column:
    """Cells of a table line in layout: parted by tabs, bars or two spaces."""
    return F.transform(F.split(F.trim(line), r"\t|\s*\|\s*| {2,}", -1), lambda x: F.trim(x))


def layout_tables(lines: DataFrame, doc: str = "doc_id", keep: bool = False) -> DataFrame:
    """(doc, table_no, row_no, n_cells, first, last) of lines (doc, pos, chunk)
    that have two cells or more; lines that follow each other are one table."""
    t = lines.withColumn("_c", cells(F.col("chunk"))).where(F.size("_c") > 1)
    w = Window.partitionBy(doc).orderBy("pos")
    t = t.withColumn("_new", F.when(F.col("pos") == F.lag("pos").over(w) + 1, 0).otherwise(1))
    t = t.withColumn("table_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"))
    row = F.row_number().over(Window.partitionBy(doc, "table_no").orderBy("pos"))
    if keep:
        return t.select(doc, "table_no", row.alias("row_no"), F.col("_c").alias("cells"))
    return t.select(doc, "table_no", row.alias("row_no"), F.size("_c").alias("n_cells"), F.element_at("_c", 1).alias("first"), F.element_at("_c", -1).alias("last"))


def layout_cells(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, table_no, row_no, cell_no, cell): every cell of ``layout_tables``,
    empty ones too."""
    rows = layout_tables(lines, doc, keep=True)
    return rows.select(doc, "table_no", "row_no", F.posexplode("cells").alias("cell_no", "cell"))


def decoded(content: Column) -> Column:
    """Bytes as UTF-8 where they are valid, else as ISO-8859-1."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))
