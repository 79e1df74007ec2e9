"""Readers of the file formats that the corpus comes in."""

from __future__ import annotations

import configparser
import difflib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.functions.citations import SHORT_TITLES
from codexmill.model import BASE, PREFIXES, TRIPLES


def text_files(spark: SparkSession, path: str, encoding: str = "iso-8859-1") -> DataFrame:
    """(path, modified, text): whole files, decoded. The text source reads
    UTF-8 only, so files are read as bytes."""
    f = spark.read.format("binaryFile").load(path)
    return f.select("path", F.col("modificationTime").alias("modified"), F.decode("content", encoding).alias("text"))


def changed_since(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files that have no output yet or one older than they are; ``done`` has
    path and modified of the inputs that outputs were made of."""
    d = done.groupBy("path").agg(F.max("modified").alias("_done"))
    return files.join(d, "path", "left").where("_done IS NULL OR modified > _done").drop("_done")


def list_lines(lines: DataFrame) -> DataFrame:
    """(doc, fragment) of lines like ``1998:204#K1P2``; blank lines say nothing."""
    v = F.trim(F.col("value"))
    return lines.where(v != "").select(F.substring_index(v, "#", 1).alias("doc"), F.nullif(F.regexp_extract(v, "#(.*)$", 1), F.lit("")).alias("fragment"))


def area_export(lines: DataFrame, columns: tuple[str, ...] = ("area", "title", "number", "year", "fragment", "note")) -> DataFrame:
    """Rows of a tab-separated export with outer quotes; rows with another
    number of fields than ``columns`` are dropped."""
    unquoted = F.transform(F.split("value", "\t", -1), lambda x: F.regexp_replace(x, '^"|"$', ""))
    rows = lines.select(unquoted.alias("f")).where(F.size("f") == len(columns))
    return rows.select(*[F.col("f")[i].alias(c) for i, c in enumerate(columns)])


def by_area(rows: DataFrame) -> DataFrame:
    """(area, entries): entries of an area, sorted by title. A printed
    collection's areas are short by nature."""
    return rows.groupBy("area").agg(F.array_sort(F.collect_list(F.struct(*[c for c in rows.columns if c != "area"]))).alias("entries"))


def simple_list(spark: SparkSession, path: str, title: str) -> DataFrame:
    """Three tab-separated columns under one title; other rows are an error."""
    rows = spark.read.csv(path, sep="\t", schema="doc string, label string, note string", mode="FAILFAST")
    return rows.select(F.lit(title).alias("area"), "*")


def wiki_export(spark: SparkSession, path: str) -> DataFrame:
    """(title, text, redirect_to) of a wiki's XML export."""
    schema = "title string, redirect struct<_title string>, revision struct<text struct<_VALUE string>>"
    x = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    text = F.col("revision.text._VALUE")
    named = F.nullif(F.regexp_extract(text, r"(?i)^#(?:redirect|omdirigering)\s*\[\[([^\]|#]+)", 1), F.lit(""))
    return x.select("title", text.alias("text"), F.coalesce(F.col("redirect._title"), named).alias("redirect_to"))


def resolved(pages: DataFrame, hops: int = 3) -> DataFrame:
    """(title, target): where each title leads after at most ``hops`` redirects."""
    to = pages.select(F.col("title").alias("_t"), F.col("redirect_to").alias("_to")).dropDuplicates(["_t"])
    out = pages.select("title", F.coalesce("redirect_to", "title").alias("target")).dropDuplicates(["title"])
    for _ in range(hops - 1):
        out = out.join(to, F.col("target") == F.col("_t"), "left").select("title", F.coalesce("_to", "target").alias("target"))
    return out


def query_results(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    """A row a result of a SPARQL result document; unbound variables are NULL
    and every value is text."""
    binding = "struct<_name string, uri string, literal struct<_VALUE string>, bnode string>"
    x = spark.read.format("xml").option("rowTag", "result").schema(f"binding array<{binding}>").load(path)

    def value(of: str) -> Column:
        named = F.filter("binding", lambda b: b["_name"] == of)
        return F.try_element_at(F.transform(named, lambda b: F.coalesce(b["uri"], b["literal"]["_VALUE"], b["bnode"])), F.lit(1)).alias(of)

    return x.select(*map(value, variables))


def turtle_lines(lines: DataFrame, g: str) -> DataFrame:
    """Triples of a dictionary in Turtle with one statement a line: subjects
    carry over ``;`` lists, quoted or bracketed objects, @prefix lines read.

    ``lines`` has pos and value of one file; files are dictionaries written by
    hand, so one window over a file is small.
    """
    from pyspark.sql import Window

    w = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.trim(F.col("value"))
    rows = lines.where((v != "") & ~v.startswith("#") & ~v.startswith("@")).select("pos", v.alias("v"))
    #: a line opens a statement unless the one before ended with ';'
    goes_on = F.coalesce(F.lag("v").over(Window.orderBy("pos")).rlike(r";\s*$"), F.lit(False))
    rows = rows.withColumn("starts", F.when(goes_on, "").otherwise(F.regexp_extract("v", r"^(<[^>]*>|[\w-]+:[^\s;]+)\s", 1)))
    starts = F.col("starts")
    rows = rows.withColumn("s", F.last(F.nullif(starts, F.lit("")), True).over(w))
    body = F.when(starts != "", F.regexp_replace("v", r"^(?:<[^>]*>|[\w-]+:[^\s;]+)\s+", "")).otherwise(F.col("v"))
    p = F.regexp_extract(body, r"^([^\s]+)\s", 1)
    o = F.regexp_extract(body, r'^[^\s]+\s+("(?:[^"\\]|\\.)*"(?:@[\w-]+|\^\^\S+)?|<[^>]*>|[^\s;.]+)', 1)
    name = lambda c: F.regexp_replace(c, "^<(.*)>$", "$1")
    lit = o.startswith('"')
    none = lambda c: F.nullif(c, F.lit(""))
    return rows.where((p != "") & (o != "")).select(
        F.lit(g).alias("g"), name(F.col("s")).alias("s"), F.when(p == "a", "rdf:type").otherwise(name(p)).alias("p"),
        F.when(lit, F.regexp_extract(o, r'^"((?:[^"\\]|\\.)*)"', 1)).otherwise(name(o)).alias("o"),
        F.when(lit, "literal").otherwise("uri").alias("o_kind"),
        none(F.regexp_extract(o, r"\^\^(\S+)$", 1)).alias("o_datatype"), none(F.regexp_extract(o, r'"@([\w-]+)$', 1)).alias("o_lang"),
    )


def short_titles(spark: SparkSession) -> DataFrame:
    """Triples of the dictionary of short titles of acts."""
    return spark.createDataFrame([("dictionary", f"{BASE}/sfs/{n}", "dct:alternate", t) for t, n in SHORT_TITLES.items()], "g string, s string, p string, o string")


def n_triples(lines: DataFrame, g: str) -> tuple[DataFrame, DataFrame]:
    """(triples, rejected lines) of (value) in N-Triples."""
    pattern = r'^(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(<[^>]*>|_:\S+|"(?:[^"\\]|\\.)*"(?:@[\w-]+|\^\^<[^>]*>)?)\s*\.\s*$'
    ok = F.col("value").rlike(pattern)
    part = lambda i: F.regexp_extract("value", pattern, i)
    o = part(3)
    text = F.regexp_extract(o, r'^"((?:[^"\\]|\\.)*)"', 1)
    for a, b in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"'), ("\\\\", "\\")):
        text = F.replace(text, F.lit(a), F.lit(b))
    kind = F.when(o.startswith("<"), "uri").when(o.startswith("_:"), "bnode").otherwise("literal")
    none = lambda c: F.nullif(c, F.lit(""))
    bare = lambda c: F.regexp_replace(F.regexp_replace(c, "^<(.*)>$", "$1"), "^_:", "")
    short = part(2)
    for prefix, full in PREFIXES.items():
        short = F.when(short.startswith(full), F.concat(F.lit(prefix + ":"), F.substring(short, F.lit(len(full) + 1), F.length(short)))).otherwise(short)
    rows = lines.where(ok).select(
        F.lit(g).alias("g"), F.regexp_replace(part(1), "^<(.*)>$", "$1").alias("s"), short.alias("p"),
        F.when(kind == "literal", text).otherwise(bare(o)).alias("o"), kind.alias("o_kind"),
        none(F.regexp_extract(o, r"\^\^<([^>]*)>$", 1)).alias("o_datatype"), none(F.regexp_extract(o, r'"@([\w-]+)$', 1)).alias("o_lang"),
    )
    bad = lines.where(~ok & (F.trim("value") != "") & ~F.trim(F.col("value")).startswith("#"))
    return rows.select([c.split()[0] for c in TRIPLES.split(", ")]), bad


def settings(text: str, section: str) -> dict[str, str]:
    """Settings of one source: the section's own, over those of [DEFAULT]."""
    p = configparser.ConfigParser(interpolation=None)
    p.read_string(text)
    return dict(p[section]) if section in p else dict(p.defaults())


def applied(original: str | None, diff: str | None) -> str | None:
    """Text with a unified diff applied; a hunk that does not fit is an error."""
    if original is None or not diff:
        return original
    src, out, at = original.split("\n"), [], 0
    hunk = None
    for line in diff.split("\n"):
        if m := re.match(r"^@@ -(\d+)(?:,(\d+))? \+\d+(?:,\d+)? @@", line):
            start = int(m[1]) - (0 if m[2] == "0" else 1)
            out += src[at:start]
            at, hunk = start, True
        elif hunk and line[:1] in (" ", "-"):
            if at >= len(src) or src[at] != line[1:]:
                raise ValueError(f"the patch does not fit at line {at + 1}")
            if line[0] == " ":
                out.append(src[at])
            at += 1
        elif hunk and line[:1] == "+":
            out.append(line[1:])
    return "\n".join(out + src[at:])


def patched(docs: DataFrame, patches: DataFrame) -> DataFrame:
    """Documents (source, basefile, text) with their patches (source, basefile,
    diff, description) applied; ``description`` goes downstream with the text."""

    @F.pandas_udf("string")
    def patch(text: pd.Series, diff: pd.Series) -> pd.Series:
        return pd.Series([applied(t, d) for t, d in zip(text, diff, strict=True)])

    j = docs.join(patches.select("source", "basefile", "diff", F.col("description").alias("patchdescription")), ["source", "basefile"], "left")
    return j.withColumn("text", F.when(F.col("diff").isNotNull(), patch("text", "diff")).otherwise(F.col("text"))).drop("diff")


def diffs(docs: DataFrame) -> DataFrame:
    """(source, basefile, diff) between ``text`` and ``edited``; none if equal."""

    @F.pandas_udf("string")
    def diff(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(difflib.unified_diff((x or "").split("\n"), (y or "").split("\n"), "text", "edited", lineterm="")) for x, y in zip(a, b, strict=True)])

    return docs.where("NOT (text <=> edited)").select("source", "basefile", diff("text", "edited").alias("diff"))


def year_number(basefile: Column) -> Column:
    """'2006:02', 'Dir. 2006:2.' and the like as '2006:2'; a strict form first,
    then any two numbers with a colon or slash; NULL where there is neither."""
    strict, lax = r"^([0-9]{4}):([0-9]+)$", r"([0-9]{4})\s*[:/]\s*([0-9]+)"
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(basefile, strict, i), F.lit("")), F.nullif(F.regexp_extract(basefile, lax, i), F.lit("")))
    return F.concat(part(1), F.lit(":"), F.regexp_replace(part(2), "^0+(?=[0-9])", ""))


def paged_path(year: Column, number: Column) -> Column:
    """'yy/yynnnn', where one repository keeps a directive."""
    yy = F.format_string("%02d", year % 100)
    return F.concat(yy, F.lit("/"), yy, F.format_string("%04d", number))


def path_basefile(path: Column) -> Column:
    """'.../2011/7.html' to '2011:7'."""
    return F.concat_ws(":", F.nullif(F.regexp_extract(path, r"([0-9]{4})/([0-9]+)[^/]*$", 1), F.lit("")), F.nullif(F.regexp_extract(path, r"([0-9]{4})/([0-9]+)[^/]*$", 2), F.lit("")))
