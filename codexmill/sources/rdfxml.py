"""RDF/XML to triples.

A file, plain or gzipped, is one document. It is parsed as it is decompressed,
one outermost description at a time, so a task holds the bytes of a file as they
are stored and never its tree. What its descriptions say about one resource needs
no merging, because triples are a set. Nested descriptions, blank nodes, typed
nodes, collections, language tags and datatypes are read.
"""

from __future__ import annotations

import gzip
import io
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched, count

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.model import PREFIXES, TRIPLES

RDF, XML = "{" + PREFIXES["rdf"] + "}", "{http://www.w3.org/XML/1998/namespace}"
GZIP = b"\x1f\x8b"
#: Triples that a task holds at a time.
ROWS = 10_000
Triple = tuple[str, str, str, str, str | None, str | None]


@lru_cache(maxsize=10_000)
def _name(tag: str) -> str:
    """'{namespace}local' as a prefixed name where the prefix is known."""
    ns, _, local = tag[1:].partition("}")
    return next((f"{p}:{local}" for p, full in PREFIXES.items() if full == ns), ns + local)


def _opened(xml: str | bytes) -> io.TextIOBase | io.BufferedIOBase:
    if isinstance(xml, str):
        return io.StringIO(xml)
    raw = io.BytesIO(xml)
    return gzip.GzipFile(fileobj=raw) if xml.startswith(GZIP) else raw


def triples(xml: str | bytes, blank: str = "b") -> Iterator[Triple]:
    """(s, p, o, kind, datatype, lang). Blank nodes without an id of their own
    are numbered in order of appearance, after ``blank``."""
    numbers = count(1)

    def subject(e: ET.Element) -> str:
        if (about := e.get(RDF + "about")) is not None:
            return about.strip()
        if (own := e.get(RDF + "ID")) is not None:
            return "#" + own
        return "_:" + (e.get(RDF + "nodeID") or f"{blank}{next(numbers)}")

    def link(s: str, p: str, node: str) -> Triple:
        return (s, p, node[2:], "bnode", None, None) if node.startswith("_:") else (s, p, node, "uri", None, None)

    def described(e: ET.Element, s: str, lang: str | None) -> Iterator[Triple]:
        lang = e.get(XML + "lang", lang)
        if e.tag != RDF + "Description":
            yield s, "rdf:type", _name(e.tag), "uri", None, None
        for a, v in e.attrib.items():
            if a.startswith("{") and not a.startswith((RDF, XML)):
                yield s, _name(a), v, "literal", None, lang
        for prop in e:
            yield from stated(s, prop, lang)

    def stated(s: str, prop: ET.Element, lang: str | None) -> Iterator[Triple]:
        p, lang, inner = _name(prop.tag), prop.get(XML + "lang", lang), list(prop)
        if (to := prop.get(RDF + "resource")) is not None:
            yield s, p, to.strip(), "uri", None, None
        elif prop.get(RDF + "parseType") == "Collection":
            at, via = s, p
            for x in inner:
                cell, node = f"_:{blank}{next(numbers)}", subject(x)
                yield link(at, via, cell)
                yield link(cell, "rdf:first", node)
                yield from described(x, node, lang)
                at, via = cell, "rdf:rest"
            yield at, via, "rdf:nil", "uri", None, None
        elif prop.get(RDF + "parseType") == "Literal":
            yield s, p, (prop.text or "") + "".join(ET.tostring(x, encoding="unicode") for x in inner), "literal", "rdf:XMLLiteral", None
        elif prop.get(RDF + "parseType") == "Resource":
            node = f"_:{blank}{next(numbers)}"
            yield link(s, p, node)
            for x in inner:
                yield from stated(node, x, lang)
        elif inner:
            node = subject(inner[0])
            yield link(s, p, node)
            yield from described(inner[0], node, lang)
        elif (node := prop.get(RDF + "nodeID")) is not None:
            yield s, p, node, "bnode", None, None
        else:
            kind = prop.get(RDF + "datatype")
            yield s, p, prop.text or "", "literal", kind, None if kind else lang

    #: open elements around the one that has just begun or ended
    depth, outermost = 0, 0
    for event, e in ET.iterparse(_opened(xml), ("start", "end")):
        if event == "start":
            if depth == 0:
                root, outermost = e, int(e.tag == RDF + "RDF")
            depth += 1
            continue
        depth -= 1
        if depth == outermost:
            yield from described(e, subject(e), root.get(XML + "lang"))
            del root[:]


def read(spark: SparkSession, path: str, g: str) -> DataFrame:
    """Triples of all files below ``path``, in graph ``g``. Blank nodes of
    different files are different. A file that is no XML is an error."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for xml, file in zip(b["xml"], b["file"], strict=True):
                for some in batched(triples(xml, f"b{file}x"), ROWS):
                    yield pd.DataFrame([(g, *t) for t in some], columns=["g", "s", "p", "o", "o_kind", "o_datatype", "o_lang"], dtype=object)

    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0")
    return f.select(F.col("content").alias("xml"), F.substring(F.md5("path"), 1, 12).alias("file")).mapInPandas(parse, TRIPLES)
