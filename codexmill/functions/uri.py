"""URI algebra: property records to URIs and back, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codexmill.model import BASE, BESLUT, LAGRUM, RATTSFALL

#: Fields of a property record, with ``type``.
FIELDS = ("law", "chapter", "section", "piece", "item", "publikation", "artal", "lopnummer", "sidnummer", "myndighet", "dnr")

# What follows the base in each of the three kinds of URI. ASCII
# word characters only, prefix match: what follows the pattern is ignored.
CASE_PATTERN = r"/rattsfall/([0-9A-Za-z_]+)/([0-9]+)(?:s([0-9]+)|(?::| nr | ref )([0-9]+))"
DECISION_PATTERN = r"/beslut/([0-9A-Za-z_]+)/([^\n]*)"
ACT_PATTERN = r"/sfs/([0-9]{4}:[0-9A-Za-z_]+)#?(?:K([0-9a-z]+))?(?:P([0-9a-z]+))?(?:S([0-9a-z]+))?(?:N([0-9a-z]+))?"


def _quoted(base: str) -> str:
    return "".join(c if c.isalnum() or c in "/:_-" else "\\" + c for c in base)


def _group(uri: Column, pattern: str, i: int) -> Column:
    """A group, or NULL where it took no part (Spark gives '' for both)."""
    return F.nullif(F.regexp_extract(uri, pattern, i), F.lit(""))


def parse(uri: Column, base: str = BASE) -> Column:
    """STRUCT<type, law, ...> of a URI; NULL where it fits none of the kinds."""
    head = "^" + _quoted(base)
    case, decision, act = (head + p for p in (CASE_PATTERN, DECISION_PATTERN, ACT_PATTERN))
    kind = F.when(uri.rlike(case), RATTSFALL).when(uri.rlike(decision), BESLUT).when(uri.rlike(act), LAGRUM)
    at = {"law": (act, 1), "chapter": (act, 2), "section": (act, 3), "piece": (act, 4), "item": (act, 5)}
    at |= {"publikation": (case, 1), "artal": (case, 2), "sidnummer": (case, 3), "lopnummer": (case, 4), "myndighet": (decision, 1), "dnr": (decision, 2)}
    fields = [_group(uri, *at[f]).alias(f) for f in FIELDS]
    return F.when(kind.isNotNull(), F.struct(kind.alias("type"), *fields))


def construct(record: Column, base: str = BASE) -> Column:
    """URI of a property record; NULL for an unknown type. A case's missing
    parts show as ``None``, as its consumers expect."""
    f = {n: record[n] for n in FIELDS}
    shown = lambda c: F.coalesce(c, F.lit("None"))
    fragment = F.concat_ws("", *[F.concat(F.lit(sign), f[n]) for sign, n in zip("KPSN", ("chapter", "section", "piece", "item"), strict=True)])
    act = F.concat(F.lit(f"{base}/sfs/"), f["law"], F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))
    by_page = F.concat(F.lit(f"{base}/rattsfall/"), shown(f["publikation"]), F.lit("/"), shown(f["artal"]), F.lit("s"), shown(f["sidnummer"]))
    by_serial = F.concat(F.lit(f"{base}/rattsfall/"), shown(f["publikation"]), F.lit("/"), shown(f["artal"]), F.lit(":"), shown(f["lopnummer"]))
    decision = F.concat(F.lit(f"{base}/beslut/"), shown(f["myndighet"]), F.lit("/"), shown(f["dnr"]))
    return (
        F.when(record["type"] == RATTSFALL, F.when(f["publikation"] == "nja", by_page).otherwise(by_serial))
        .when(record["type"] == LAGRUM, act)
        .when(record["type"] == BESLUT, decision)
    )


def namespace(uri: Column) -> Column:
    """Up to and including the last of ``#``, ``/`` and ``:``."""
    return F.regexp_extract(uri, r"^(.*[#/:])", 1)


def local_name(uri: Column) -> Column:
    return F.regexp_extract(uri, r"([^#/:]*)$", 1)


def last_index_of(s: Column, c: str) -> Column:
    """1-based position of the last ``c``; 0 where there is none."""
    return F.when(F.contains(s, F.lit(c)), F.length(s) - F.length(F.substring_index(s, c, -1)) - len(c) + 1).otherwise(0)


def normalised(uri: Column) -> Column:
    """Trimmed, with one slash where a path repeats it; the scheme's stays."""
    return F.regexp_replace(F.trim(uri), r"([^:])/{2,}", "$1/")
