"""Reading units of text and string functions, as column expressions.

Text is read in chunks up to a literal delimiter. Where text ends with the
delimiter nothing follows it: the last, empty piece of a split is no chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINE, PARAGRAPH, PAGE = "\n", "\n\n", "\f"


def unix_lines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n", "\n")


def chunks(text: Column, delimiter: str) -> Column:
    """Array of chunks; empty for an empty text, NULL for NULL."""
    parts = F.split(text, "\\Q" + delimiter + "\\E", -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def exploded(df: DataFrame, text: str, delimiter: str, pos: str = "pos", chunk: str = "chunk") -> DataFrame:
    """A row a chunk, numbered from 0; a text without chunks has none."""
    return df.select(*[c for c in df.columns if c != text], F.posexplode(chunks(F.col(text), delimiter)).alias(pos, chunk))


def offsets(df: DataFrame, key: list[str], delimiter: str) -> DataFrame:
    """Add ``start``, the 0-based character position of each chunk."""
    w = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("start", F.coalesce(F.sum(F.length("chunk") + len(delimiter)).over(w), F.lit(0)))


def peeked(df: DataFrame, key: list[str], ahead: int = 1, back: int = 1) -> DataFrame:
    """Add ``peek`` and ``prev``, the n-th chunk ahead and back; NULL past either end."""
    w = Window.partitionBy(*key).orderBy("pos")
    return df.withColumn("peek", F.lead("chunk", ahead).over(w)).withColumn("prev", F.lag("chunk", back).over(w))


def cue(text: Column, what: str, start: int = 0) -> Column:
    """0-based position of the next ``what`` from ``start``; NULL where absent."""
    at = F.locate(what, text, start + 1)
    return F.when(at > 0, at - 1)


def cue_past(text: Column, what: str, start: int = 0) -> Column:
    return cue(text, what, start) + len(what)


def read_to(text: Column, what: str, start: int = 0) -> Column:
    """From ``start`` up to, not including, the next ``what``; NULL where absent."""
    return F.when(cue(text, what, start).isNotNull(), F.substring(text, F.lit(start + 1), cue(text, what, start) - start))


def read(text: Column, size: int, start: int = 0) -> Column:
    return F.substring(text, start + 1, size)


def stripped(chunk: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(chunk, r"^\s+", ""), r"\s+$", "")


def dewrapped(chunk: Column, line: str = LINE) -> Column:
    return F.replace(chunk, F.lit(line), F.lit(" "))


def expanded_tabs(chunk: Column, width: int = 8) -> Column:
    """Tab stops every eight columns, counted anew on every line."""
    wide = lambda a: (F.floor(F.length(a) / width).cast("int") + 1) * width

    def line(x: Column) -> Column:
        cells = F.split(x, "\t", -1)
        return F.aggregate(F.slice(cells, 2, F.size(cells)), cells[0], lambda a, c: F.concat(F.rpad(a, wide(a), F.lit(" ")), c))

    return F.array_join(F.transform(F.split(chunk, "\n", -1), line), "\n")


def cleaned(chunk: Column, strip: bool = True, dewrap: bool = True, tabs: bool = True) -> Column:
    """Strip, join wrapped lines and expand tabs, in this order."""
    out = stripped(chunk) if strip else chunk
    out = dewrapped(out) if dewrap else out
    return F.when(F.contains(out, F.lit("\t")), expanded_tabs(out)).otherwise(out) if tabs else out


def encode_uri(s: Column, reserved: bool = True) -> Column:
    """Percent-encoded; without ``reserved`` characters that part a URI stay."""
    out = F.replace(F.replace(F.url_encode(s), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    out = F.replace(out, F.lit("%7E"), F.lit("~"))
    for c in "" if reserved else ";/?:@&=+$,[]":
        out = F.replace(out, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return out


def before(s: Column, what: str) -> Column:
    """'' where ``what`` is absent."""
    return F.when(F.contains(s, F.lit(what)), F.substring_index(s, what, 1)).otherwise(F.when(s.isNotNull(), ""))


def after(s: Column, what: str) -> Column:
    at = F.locate(what, s)
    return F.when(at > 0, F.substring(s, at + len(what), F.length(s))).otherwise(F.when(s.isNotNull(), ""))


def normal_space(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, "[ \t\r\n]+", " "))


def tuned_width(s: Column, width: int, default: int) -> Column:
    """Position of the last space in the first ``width`` characters, or ``default``."""
    head = F.left(s, F.lit(width))
    space = F.locate(" ", F.reverse(head))
    return F.when(space > 0, F.length(head) - space + 1).otherwise(default)


def truncated(s: Column, width: int) -> Column:
    """A description no longer than about ``width``, cut at a space, with '...'."""
    cut = F.substring(s, F.lit(1), tuned_width(s, width, width) - 1)
    return F.when(F.length(s) > width, F.concat(normal_space(cut), F.lit("..."))).otherwise(s)


def transliteration() -> dict[str, str]:
    """Accented letter to its ASCII letter, by the rule that a letter whose
    canonical decomposition begins with an ASCII letter becomes that letter."""
    import unicodedata

    out = {}
    for i in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        d = unicodedata.normalize("NFD", chr(i))
        if len(d) > 1 and d[0].isascii() and d[0].isalpha():
            out[chr(i)] = d[0]
    # Letters without a decomposition.
    return out | dict(zip("ÆæØøÐðŁłĐđĦħıŦŧŒœß", "AaOoDdLlDdHhiTtOos", strict=True))


def ascii_letters(s: Column) -> Column:
    t = transliteration()
    return F.translate(s, "".join(t), "".join(t.values()))


def slug(s: Column, remove_slashes: bool = True) -> Column:
    """Name as a part of a URL: transliterated, other characters dropped, space,
    dot and underscore to '-', runs collapsed, ends trimmed, lower case."""
    keep = "[^a-zA-Z0-9\\-_\\s.]" if remove_slashes else "[^a-zA-Z0-9\\-_\\s./]"
    x = F.regexp_replace(ascii_letters(s), keep, "")
    x = F.regexp_replace(F.regexp_replace(x, r"[\s._]", "-"), "-+", "-")
    return F.lower(F.regexp_replace(x, "^-+|-+$", ""))


def short_url(url: Column, length: int = 40) -> Column:
    """A URL longer than ``length`` with dots for a part of it: where what stands
    before the last path segment is short enough the segment is cut, else what
    stands before it. URLs that are short, or end without a segment, stay."""
    keep, last = length - 3, F.regexp_extract(url, "(/[^/]+/?)$", 1)
    head = F.left(url, F.length(url) - F.length(last))
    cut = F.when(F.length(head) <= keep, F.concat(head, F.left(last, F.lit(keep)), F.lit("..."))).otherwise(F.concat(F.left(head, F.lit(keep)), F.lit("..."), last))
    return F.when((F.length(url) <= length) | (last == ""), url).otherwise(cut)


def celex(s: Column) -> Column:
    """CELEX number with its year in four digits."""
    return F.regexp_replace(s, r"^3([0-9]{2})([A-Z])", "319$1$2")


def official_pdf(year: Column, number: Column) -> Column:
    """Whether a facsimile is published: from 1998:306 to 2018:159."""
    old = (year > 1998) | ((year == 1998) & (number >= 306))
    return old & ((year < 2018) | ((year == 2018) & (number < 160)))


def authentic_version(year: Column, number: Column) -> Column:
    """Whether the electronic version is the authentic one: from 2018:160."""
    return (year > 2018) | ((year == 2018) & (number >= 160))


def paragraph_marker(fragment: Column) -> Column:
    """Marker of a paragraph in the margin: the first shows its chapter, if
    any, the others their number."""
    n = F.regexp_extract(fragment, r"S([0-9]+)", 1)
    chapter = F.regexp_extract(fragment, r"^K([0-9a-z]+)", 1)
    return F.when((n == "1") & (chapter != ""), F.concat(F.lit("K"), chapter)).when((n != "1") & (n != ""), F.concat(F.lit("S"), n))
