"""Pages of strung-together keywords, link lists and product tags.

Each line is cut into statements and each statement reduced to a shape: how many
words, function words, capitals, separators, numbers and links it has, in coarse
steps, and how it begins and ends. The shape alone says whether its statements
are sentences, entries of a table or none of these. Shapes are grouped by
document, and a page is flagged when those that are no sentences hold most of
its text; how few shapes do so is measured by their effective number.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent Swedish and English function words.
FUNCTION_WORDS = frozenset(
    """
    alla allt andra att av bland bli blir bör bort både dess dessa den denna denne detta det de dem deras du då där därför därefter efter
    ej eller en enligt ett enbart eftersom finns fram från får för före genom genast gäller ha hade han hans har hon hur här i icke in inom inte
    innan ingen inget inte kan kunna kunde man med mellan men mot måste mer mycket ni nu när någon något några och också oss om på redan sig sin sitt sina ska
    skall skulle som så sådan sådana sägs till trots under upp ut utan var vara varit varje vi vid vill vilka vilken vilket vår våra är än även åt över
    a about after all also an and any are as at be been before being both but by can could did do does each either every for from further had has have he
    her his how if in into is it its may might more must no nor not nothing of on only or other our out over shall she should since so some such than that
    the their them then there these they this those to under unless until upon was we were what when where which while who will with within would you your
    """.split()
)
WORD = re.compile(r"[^\W\d_]+")
#: With a scheme, or a bare host name.
URL = re.compile(r"(?:https?://|www\.)[^\s<>\"']+|(?<![\w@./-])[\w-]{3,}(?:\.[\w-]{2,})*\.[a-z]{2,}(?![\w@-])")
_MAY_LINK = re.compile(r"\w\.[a-z]{2}|://|www|<|\]\(")
#: A link with its text, in HTML or Markdown.
ANCHOR = re.compile(r"<a\s[^<>]*>(.*?)</a\s*>|\[([^\[\]]*)\]\((?:https?://|www\.)[^()\s]*\)", re.IGNORECASE)
TAG = re.compile(r"</?[a-z][^<>]*>", re.IGNORECASE)
#: HTML elements that begin or end a line.
BREAK = re.compile(r"</?(?:li|p|br|div|ul|ol|tr|td|th|table|h[1-6])\b[^<>]*>", re.IGNORECASE)
NUMBER = re.compile(r"\d+")
NOT_YEAR = re.compile(r"(?<!\d)(?!(?:19|20)\d\d(?!\d))\d+")
CAPITAL = re.compile(r"\b[A-ZÅÄÖ]")
PRICE = re.compile(r"\d\s?(?:kr|:-)(?!\w)|★|☆|\bart\.?\s?nr\b|[€$£]\s?\d|\d\s?[€$£]", re.IGNORECASE)
#: A link belongs to the title before it, and what begins anew after a link is another statement.
STATEMENT = re.compile(r"(?<=[.!?])\s+(?!https?://|www\.)(?=[^\W\d_]|[#\[*•])")
AFTER_LINK = re.compile(r"((?:https?://|www\.)\S+|\((?:[\w-]+\.)+[a-z]{2,}\))\s+(?=[A-ZÅÄÖ])")
#: A link at the end of a statement, and what stands before it.
LAST_LINK = re.compile(r"^(.*?)\s*\(?((?:https?://|www\.)\S+?|(?<![\w@./-])[\w-]{3,}(?:\.[\w-]{2,})*\.[a-z]{2,})\)?$")
#: Beginnings of entries of registers, tables, contents and statutes.
ENTRY = re.compile(r"\s*(?:\d{1,3}(?:\.\d+)*[.;|)\t ]|\d+ ?[a-z]? ?(?:§|kap\b)|[A-ZÅÄÖ][^\s:|]*(?: [^\s:|]+)?:\s(?!\s*http)|(?:section|chapter|art(?:icle|ikel)?)\s\d)", re.IGNORECASE)
LEADER = re.compile(r"\.{4,}\s*\d+\s*$")
#: A page with fewer characters is too short to tell.
LEAST_CHARS = 80
#: Share of a page's text in shapes that are no sentences that flags it.
MOST = 0.5
#: A text may repeat a phrase when fewer of its words are different. Words of a phrase come in so large a share of the
#: sentences and in each so many times on average; a sentence is made for it when so many of its content words are such.
VARIED, IN_SENTENCES, TIMES, MADE_OF = 0.6, 0.5, 1.3, 0.4
#: From so many product tags on, what is said after each of them is part of the tag.
LEAST_PRODUCTS = 2
SENTENCE, NEUTRAL = "sentence", "entry"


class Shape(NamedTuple):
    """Counts in coarse steps, shares in steps of ``_share``, flags as 0 or 1."""

    words: int
    capitals: int
    separators: int
    links: int
    functions: int
    """Share of function words: 0 up to a tenth, 1 below 0.15, 2 from there on."""
    linked: int
    """What links are to the statement: 0 none or a part of it, 1 its end, below a title, 2 most of it."""
    numbers: int
    tags: int
    entry: int
    price: int
    stop: int

    @property
    def kind(self) -> str:
        if self.linked:
            return "links"
        if self.tags:
            return "tags"
        if self.entry:
            return NEUTRAL
        if self.price:
            return "products"
        if self.numbers:
            return NEUTRAL
        if self.functions == 0 and self.words:
            return "keywords"
        return SENTENCE


def _step(n: int) -> int:
    return n if n < 4 else 4 if n < 7 else 5 if n < 15 else 6 if n < 40 else 7


def _linked(s: str, n: int, fw: int, urls: list[str], anchors: list[str]) -> int:
    if anchors and sum(map(len, anchors)) >= 0.6 * len(s):
        return 2
    if not urls:
        return 0
    if fw <= 0.1 * n and (len(urls) >= 3 or sum(map(len, urls)) >= 0.4 * len(s)):
        return 2
    m = LAST_LINK.match(s) if s[-1] != "." and len(urls) == 1 else None
    if m and m[1] and len(m[2]) >= 0.15 * len(s) and not m[1].endswith(","):
        last = WORD.findall(m[1].lower())[-1:]
        parted = m[1][-1] in ".!?:)-–" or s[-1] == ")"
        if parted or (last and last[0] not in FUNCTION_WORDS and len(m[2]) >= 0.3 * len(s)):
            return 1
    return 0


def _statements(text: str) -> Iterator[tuple[str, bool]]:
    """(statement, whether it may hold links or markup)."""
    for line in (BREAK.sub("\n", text) if "<" in text else text).split("\n"):
        line = line.strip()
        if not line:
            continue
        rich = _MAY_LINK.search(line) is not None
        for s in STATEMENT.split(line):
            if rich:
                yield from ((x, True) for x in AFTER_LINK.sub(r"\1\n", s).split("\n") if x)
            elif s:
                yield s, False


@lru_cache(maxsize=100_000)
def _named(shape: Shape) -> tuple[str, str]:
    return "".join(map(str, shape)), shape.kind


def reduced(s: str, rich: bool = True) -> tuple[Shape, list[str]]:
    """The shape of a statement and its words; without ``rich`` links and markup
    are not looked for."""
    visible, urls, anchors = s, [], []
    if rich:
        anchors = [a or b for a, b in ANCHOR.findall(s)]
        visible = TAG.sub("", ANCHOR.sub(r"\1\2", s)) if anchors or "<" in s else s
        urls = URL.findall(visible)
    bare = URL.sub(" ", visible) if urls else visible
    words = WORD.findall(bare.lower())
    n, fw = len(words), sum(map(FUNCTION_WORDS.__contains__, words))
    tags = s.count("#")
    seps = s.count(",") + s.count(";") + s.count("|") + s.count("•") + s.count("/") + s.count("\t")
    end = s[-1]
    shape = Shape(
        _step(n), _step(len(CAPITAL.findall(bare))), _step(seps), _step(len(urls) + len(anchors)),
        0 if fw <= 0.1 * n else 1 if fw < 0.15 * n else 2, _linked(visible, n, fw, urls, anchors) if rich and visible else 0,
        int(NUMBER.search(bare) is not None and len(NOT_YEAR.findall(bare)) >= max(1, 0.3 * n)), int(tags >= 2 and tags >= 0.2 * n),
        int(ENTRY.match(s) is not None or (end.isdigit() and LEADER.search(s) is not None)), int(fw < 0.15 * n and PRICE.search(s) is not None), int(end in ".!?"),
    )
    return shape, words


def shapes(text: str) -> Iterator[tuple[str, str, int]]:
    """(shape, kind, characters) of every statement of a text."""
    found = []
    total, distinct = 0, set()
    for s, rich in _statements(text):
        shape, words = reduced(s, rich)
        total += len(words)
        distinct.update(words)
        name, kind = _named(shape)
        found.append((s, kind, words, name))
    hot: set[str] = set()
    again: Counter[str] = Counter()
    products = sum(f[1] == "products" for f in found)
    if products >= LEAST_PRODUCTS:  # what is said after every product is part of its tag
        again.update(NUMBER.sub("0", f[0]) for f in found)
    if len(distinct) < VARIED * total:
        hot = _hot([f[2] for f in found if f[1] in (SENTENCE, "keywords")])
    for s, kind, words, name in found:
        k = kind
        if k == SENTENCE and hot:
            own = [w for w in words if len(w) > 3 and w not in FUNCTION_WORDS]
            if own and sum(w in hot for w in own) >= MADE_OF * len(own):
                k = "phrase"
        if k == SENTENCE and products >= LEAST_PRODUCTS and again[NUMBER.sub("0", s)] > 1:
            k = "refrain"
        yield f"{k}:{name}", k, len(s)


def _hot(sentences: list[list[str]]) -> set[str]:
    """Content words that come in every other sentence and then, on average,
    more than once: what sentences made to repeat a phrase have."""
    if len(sentences) < 2:
        return set()
    within: Counter[str] = Counter()
    times: Counter[str] = Counter()
    for words in sentences:
        own = [w for w in words if len(w) > 3 and w not in FUNCTION_WORDS]
        within.update(set(own))
        times.update(own)
    return {w for w, k in within.items() if k >= max(2, IN_SENTENCES * len(sentences)) and times[w] >= TIMES * k}


def document_shapes(docs: DataFrame) -> DataFrame:
    """(doc_id, shape, kind, statements, chars) of (doc_id, text)."""

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, text in zip(b["doc_id"], b["text"], strict=True):
                if not text:
                    continue
                n: Counter[tuple[str, str]] = Counter()
                chars: Counter[tuple[str, str]] = Counter()
                for shape, kind, size in shapes(text):
                    n[shape, kind] += 1
                    chars[shape, kind] += size
                rows += [(i, shape, kind, k, chars[shape, kind]) for (shape, kind), k in n.items()]
            yield pd.DataFrame(rows, columns=["doc_id", "shape", "kind", "statements", "chars"])

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInPandas(reduce, "doc_id bigint, shape string, kind string, statements bigint, chars bigint")


def stuffed_pages(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, share, shapes, effective): flagged pages, the kind that
    holds most of the text, the share of characters in shapes that are no
    sentences, how many such shapes there are, and how many equally large ones
    would be as concentrated (few where a page repeats itself).

    NULL, empty and very short texts are no cases, rows without an id neither. Repeated doc_ids are judged
    together, once. Entries of registers, tables, contents and reference lists
    count as text, but not as keywords.
    """
    s = document_shapes(docs).groupBy("doc_id", "shape", "kind").agg(F.sum("chars").alias("chars"))
    odd = F.when(~F.col("kind").isin(SENTENCE, NEUTRAL), F.col("chars"))
    d = s.groupBy("doc_id").agg(
        F.coalesce(F.sum(odd), F.lit(0)).alias("odd"), F.sum("chars").alias("all"), F.max_by("kind", F.struct(F.coalesce(odd, F.lit(0)), "shape")).alias("kind"),
        F.count(odd).cast("int").alias("shapes"), F.sum(odd.cast("double") * odd).alias("squares"),
    )
    flagged = (F.col("odd") >= MOST * F.col("all")) & (F.col("all") >= LEAST_CHARS)
    return d.where(flagged).select("doc_id", "kind", (F.col("odd") / F.col("all")).alias("share"), "shapes", (F.col("odd") / F.col("squares") * F.col("odd")).alias("effective"))
