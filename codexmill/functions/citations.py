"""Citations in running text.

Each rule is a pattern with the URI that its match stands for. Rules that need
no memory are column expressions (``simple``); enumerations that inherit what
came before, short titles and "the same act" need one pass from left to right
and run as an Arrow UDF (``linked``).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from codexmill.model import BASE

EXT = BASE.rsplit("/", 1)[0] + "/ext"

# Swedish ordinals in references to paragraphs.
ORDINALS = {w: str(i) for i, w in enumerate("första andra tredje fjärde femte sjätte sjunde åttonde nionde tionde".split(), 1)}

# Short titles of acts, and the acts' numbers.
_SHORT = """
    BB=1736:0123_1 HB=1736:0123_2 SO=1810:0926 LkL=1845:50_s._1 IÄL=1904:26_1 AvtL=1915:218 GB=1920:405 SkbrL=1936:81 GåvoL=1936:83 RB=1942:740
    LsL=1946:808 TF=1949:105 FB=1949:381 Upplåtelser=1957:259 ÄB=1958:637 VML=1960:644 URL=1960:729 BrB=1962:700 BrP=1964:163 FL=1967:868 NSL=1968:64
    FRL=1970:979 FBL=1970:988 JB=1970:994 JP=1970:995 AFDL=1971:289 FPL=1971:291 BehL=1971:309 FfL=1971:494 SBL=1971:69 LIA=1971:796 VägL=1971:948
    SkL=1972:207 ExL=1972:719 AL=1973:1149 SFL=1973:1150 RF=1974:152 RO=1974:153 MBL=1976:580 HFL=1978:304 FTL=1979:1152 SekrL=1980:100 SekrF=1980:657
    UB=1981:774 UF=1981:981 HSL=1982:763 LAS=1982:80 PL=1984:387 VitesL=1985:206 KTjL=1985:716 FL=1986:223 PBL=1987:10 ESL=1987:11 ÄktB=1987:230
    KL=1987:672 CISG=1987:822 LVM=1988:870 TaxL=1990:324 LVU=1990:52 LBH=1990:746 ArkivL=1990:782 KöpL=1990:931 KKöpL=1990:932 LPT=1991:1128 LRV=1991:1129
    YGL=1991:1469 SINK=1991:586 BRL=1991:641 KL=1991:900 KML=1992:1685 Avgift=1992:191 KKrL=1992:830 OL=1993:1617 LSS=1993:387 SjöL=1994:1009
    IURF=1994:193 ML=1994:200 LOA=1994:260 PbrL=1994:448 BVL=1994:847 VerksF=1995:1322 LIF=1997:192 EL=1997:857 PUL=1998:204 KörkL=1998:488 LIP=1998:674
    MB=1998:808 IL=1999:1229 SAL=2000:980 LSK=2001:1227 SoL=2001:453 Tillhandahållande=2003:234 LEK=2003:389 LSO=2003:778 SmittskL=2004:168 FAL=2005:104
    ABL=2005:551 UtlL=2005:716 RättsprL=2006:304 MFL=2008:486 OSL=2009:400
""".split()
#: A title that two acts share is the older one's.
SHORT_TITLES = {title: number for title, _, number in reversed([x.partition("=") for x in _SHORT])}

#: Patterns that mean the same in Java, RE2 and Python.
CASE = r"\b(AD|MD|RH|RÅ|HFD|NJA) ([0-9]{4})(?::| nr | ref\. | s\. )([0-9]+)"
BILL = r"\b[Pp]rop\. ([0-9]{4}(?:/[0-9]{2,4})?:[0-9]+)"
REPORT = r"\b[Bb]et\. ([0-9]{4}/[0-9]{2,4}:[A-Z][A-Za-z]+[0-9]+)"
LETTER = r"\b[Rr]skr\. ([0-9]{4}/[0-9]{2,4}:[0-9]+)"
CELEX = r"\b(3[0-9]{4}[A-Z][0-9]{4}|3[0-9]{2}[A-Z][0-9]{4})\b"
ACT = r"\(([0-9]{4}:[0-9]+)\)"
#: Java only: a bare number, numbers of other series (SOU, SKVFS, dir.) with those listed after them, EU cases.
NAKED = r"(?<![0-9:/])([0-9]{4}:[0-9]+)(?![0-9]|[:/][0-9])"
SERIES = (
    r"(?<!\p{L})(?!(?:SFS|LAG|BALK|OCH)\s*[0-9])(?:[\p{Lu}-]*\p{Lu}FS|\p{Lu}{2,4}|(?:Ds|[Dd]ir|[Pp]rop|[Bb]et|[Rr]?[Ss]kr)\.?)\s*[0-9]{4}:[0-9]+"
    r"(?:(?:, | och | samt | eller )[0-9]{4}:[0-9]+)*"
)
ECJ = r"(?<![\p{L}0-9])([CTF][-\x{2011}][0-9]+/[0-9]{2})(?![0-9])"


def all_of(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def cases(text: Column, base: str = BASE) -> Column:
    """URIs of the cases in a text, in order. NJA is cited by page."""
    out = lambda whole: F.concat(
        F.lit(f"{base}/rattsfall/"), F.lower(F.regexp_extract(whole, CASE, 1)), F.lit("/"), F.regexp_extract(whole, CASE, 2),
        F.when(F.regexp_extract(whole, CASE, 1) == "NJA", "s").otherwise(":"), F.regexp_extract(whole, CASE, 3),
    )
    return F.transform(all_of(text, CASE, 0), out)


def publications(text: Column, base: str = BASE, ext: str = EXT) -> Column:
    """URIs of bills, committee reports, letters and EU acts, by kind."""
    at = lambda pattern, head, f=lambda x: x: F.transform(all_of(text, pattern, 1), lambda x: F.concat(F.lit(head), f(x)))
    year = lambda x: F.regexp_replace(x, r"^3([0-9]{2})([A-Z])", "319$1$2")
    return F.concat(at(BILL, f"{base}/prop/"), at(REPORT, f"{ext}/bet/"), at(LETTER, f"{ext}/rskr/"), at(CELEX, f"{ext}/celex/", year))


def acts(text: Column, base: str = BASE) -> Column:
    return F.transform(all_of(text, ACT, 1), lambda x: F.concat(F.lit(f"{base}/sfs/"), x))


def naked(text: Column, base: str = BASE) -> Column:
    """URIs of acts by bare number, with or without "SFS", that no other rule
    claims and that isn't the number of another series."""
    rest = F.regexp_replace(text, "|".join((SERIES, CASE, BILL, REPORT, LETTER, CELEX, ACT)), " ")
    return F.transform(all_of(rest, NAKED, 1), lambda x: F.concat(F.lit(f"{base}/sfs/"), x))


def eu_cases(text: Column, ext: str = EXT) -> Column:
    """URIs of EU cases; their hyphen may be one that doesn't break."""
    return F.transform(all_of(text, ECJ, 1), lambda x: F.concat(F.lit(f"{ext}/ecj/"), F.translate(x, "\u2011", "-")))


_NR = r"\d+(?:\s?[a-z]\b)?"
_ACT_TITLE = r"(?:\w+\s)?\w*(?:lagen|förordningen|balken|lag|förordning|balk)"
_TOKEN = rf"""
    (?P<case>\b(?P<court>AD|MD|RH|RÅ|HFD|NJA)\s(?P<cy>\d{{4}})(?::|\snr\s|\sref\.\s|\ss\.\s)(?P<cn>\d+))
  | (?P<prop>\b[Pp]rop\.\s(?P<pn>\d{{4}}(?:/\d{{2,4}})?:\d+))
  | (?P<bet>\b[Bb]et\.\s(?P<bn>\d{{4}}/\d{{2,4}}:[A-Za-z]+\d+))
  | (?P<rskr>\b[Rr]skr\.\s(?P<rn>\d{{4}}/\d{{2,4}}:\d+))
  | (?P<celex>\b3\d{{2}}(?:\d{{2}})?[A-Z]\d{{4}}\b)
  | (?P<ecj>\b(?:Case\s)?(?P<et>[CTF])[-‑](?P<es>\d+)/(?P<ey>\d{{2}})\b)
  | (?P<short>\b(?P<ab>@)\s(?P<sk>\d+):(?P<sp>\d+(?:\s?[a-z]\b)?)(?:\s(?P<ss>\d+)\sst\.)?)
  | (?P<prov>(?:(?P<k>{_NR})\skap\.\s)?(?P<p>{_NR})\s§(?:\s(?P<so>{"|".join(ORDINALS)})\sstycket(?:\s(?P<sn>{_NR}))?)?
      (?:\s(?:(?P<same>samma\s(?:lag|förordning|balk))|(?P<title>{_ACT_TITLE})\s\((?P<law>\d{{4}}:\d+)\)))?)
  | (?P<piece>\b(?P<o>{"|".join(ORDINALS)})\sstycket(?:\s(?P<n>{_NR}))?)
  | (?P<named>\b{_ACT_TITLE}\s\((?P<nl>\d{{4}}:\d+)\))
  | (?P<naked>(?<![\d:/])\d{{4}}:\d+(?!\d))
    """


@lru_cache
def _token(titles: tuple[str, ...]) -> re.Pattern:
    """The rules, with the short titles that are known, the longest first."""
    known = "|".join(map(re.escape, sorted(titles, key=lambda x: (-len(x), x)))) or "(?!)"
    return re.compile(_TOKEN.replace("@", known), re.VERBOSE)


_MORE = re.compile(rf"(?P<sep>,\s|\seller\s|\soch\s|\ssamt\s)(?P<n>{_NR})(?!\s?(?:§|kap\b|:|\d))")


def _nr(x: str) -> str:
    return re.sub(r"\s", "", x)


def runs(text: str | None, home: str = "9999:999", aliases: dict[str, str] | None = None, base: str = BASE, ext: str = EXT) -> list[tuple[str, str | None]]:
    """(text, uri or None) in order; the texts concatenate to the input. NULL
    and empty texts are one empty run. References without an act belong to
    ``home`` or, with "samma lag", to the act named last."""
    if not text:
        return [("", None)]
    out: list[tuple[str, str | None]] = []
    at, last = 0, home
    sfs = f"{base}/sfs/"

    def plain(upto: int) -> None:
        if upto > at:
            out.append((text[at:upto], None))

    pos = 0
    token = _token(tuple(sorted(aliases or ())))
    while m := token.search(text, pos):
        g = m.groupdict()
        pos = max(m.end(), m.start() + 1)
        prefix = None
        if g["case"]:
            uri = f"{base}/rattsfall/{g['court'].lower()}/{g['cy']}{'s' if g['court'] == 'NJA' else ':'}{g['cn']}"
        elif g["prop"]:
            uri = f"{base}/prop/{g['pn']}"
        elif g["bet"]:
            uri = f"{ext}/bet/{g['bn']}"
        elif g["rskr"]:
            uri = f"{ext}/rskr/{g['rn']}"
        elif g["celex"]:
            uri = f"{ext}/celex/" + re.sub(r"^3(\d{2})([A-Z])", r"319\1\2", g["celex"])
        elif g["ecj"]:
            uri = f"{ext}/ecj/{g['et']}-{g['es']}/{g['ey']}"
        elif g["short"]:
            law = (aliases or {})[g["ab"]]
            uri = f"{sfs}{law}#K{g['sk']}P{_nr(g['sp'])}" + (f"S{g['ss']}" if g["ss"] else "")
        elif g["prov"]:
            if g["law"]:
                last = g["law"]
            law = last if g["law"] or g["same"] else home
            prefix = f"{sfs}{law}#" + (f"K{_nr(g['k'])}" if g["k"] else "") + f"P{_nr(g['p'])}" + (f"S{ORDINALS[g['so']]}" if g["so"] else "")
            uri = prefix + (f"N{_nr(g['sn'])}" if g["sn"] else "")
            prefix = prefix if g["sn"] and not (g["law"] or g["same"]) else None
        elif g["piece"]:
            prefix = f"{sfs}{home}#S{ORDINALS[g['o']]}"
            uri = prefix + (f"N{_nr(g['n'])}" if g["n"] else "")
            prefix = prefix if g["n"] else None
        else:
            last = g["nl"] or g["naked"]
            uri = sfs + last
        plain(m.start())
        out.append((m[0], uri))
        at = m.end()
        while prefix and (more := _MORE.match(text, at)):
            out += [(more["sep"], None), (more["n"], f"{prefix}N{_nr(more['n'])}")]
            at = pos = more.end()
    plain(len(text))
    return out


def linked(aliases: dict[str, str] | None = None, base: str = BASE, ext: str = EXT) -> Callable[[Column, Column], Column]:
    """UDF (text, home act) to ARRAY<STRUCT<text, uri>>. ``aliases`` is a
    dictionary of short titles, a table of settings."""

    @F.pandas_udf("array<struct<text string, uri string>>")
    def link(text: pd.Series, home: pd.Series) -> pd.Series:
        return pd.Series([runs(t, h or "9999:999", aliases, base, ext) for t, h in zip(text, home, strict=True)])

    return link


# What introduces a defined term or an offence's name.
DEFINITIONS = (r"Med ([\p{L}\- ]+?) (?:avses|förstås)", r"döms? för ([\p{L}\- ]+?) till", r"dömes för ([\p{L}\- ]+?) till", r"[Ff]ör ([\p{L}\- ]+?) döms", r"skall för ([\p{L}\- ]+?) dömas",
    r"döme?s, [^.]*, för ([\p{L}\- ]+?) till", r"\((\p{Ll}[\p{Ll}\-]+)\)\.")
#: What introduces a list of terms, and a term in it: before a colon or dash, with or without a number, letter or dash.
TERM_LIST = r"(?s)(?:avses med|betyder|förstås med):?[ \t]*\n(.*)$"
LISTED_TERM = r"(?m)^(?:[0-9]+\. |[a-z]\) |[-–] )?(\p{Ll}[\p{L}\- ]{0,60}?)(?::| [-–]) "


def concept(term: Column, base: str = BASE) -> Column:
    name = F.regexp_replace(F.trim(term), " ", "_")
    return F.concat(F.lit(base.rsplit("/", 1)[0] + "/concept/"), F.upper(F.left(name, F.lit(1))), F.substring(name, F.lit(2), F.length(name)))


def definitions(text: Column) -> Column:
    """Terms that a text defines, by rule and in order."""
    return F.concat(*[all_of(text, p, 1) for p in DEFINITIONS], all_of(F.regexp_extract(text, TERM_LIST, 1), LISTED_TERM, 1))


def amendment_notes(text: Column) -> Column:
    """Acts named in notes like "Lag (1234:567)." """
    return all_of(text, r"(?:Lag|Förordning) \(([0-9]{4}:[0-9]+)\)\.", 1)
