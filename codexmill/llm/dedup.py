"""Records that differ in writing only.

Each normalised field-name and value pair is hashed by itself; the sums of the
hashes' halves are a multiset hash, which no order of fields changes. Records
are grouped by this fingerprint, the smallest id of a group is joined back, and
every member's pairs are compared with its representative's as multisets,
without sorting. Members that differ (a collision) are grouped by their pairs.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.session import materialize

#: Beyond Latin letters a character may have other compositions; these go through NFC.
_MAY_COMPOSE = "[^\\x{0}-\\x{2ff}\\x{2010}-\\x{2027}]"
NOT_WRITTEN = "[^\\p{L}\\p{M}\\p{Nd}]"


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def composed(c: Column) -> Column:
    """NFC. Python sees only values that hold characters which may change."""
    may = F.when(c.rlike(_MAY_COMPOSE), c)
    return F.coalesce(_nfc(may), c)


def number_pair(basefile: Column) -> Column:
    """'year:number' as integers, without leading zeros or surroundings; NULL
    when there aren't two numbers."""
    part = lambda i: F.regexp_extract(basefile, r"(\d{4})\D+(\d+)", i)
    plain = lambda i: F.regexp_replace(part(i), "^0+(?=\\d)", "")
    return F.when(part(1) != "", F.concat_ws(":", plain(1), plain(2)))


def pairs_of(basefile: Column, record: Column) -> Column:
    """Array of (name, value): the fields of ``record`` and the number of
    ``basefile``, normalised. A field's name ends at its first ':' or '='; only
    letters and digits count, in either case. Empty values and parts without a
    name are left out, so an empty field equals a missing one; NULLs have no
    pairs. A basefile without a number counts as it is written."""
    clean = lambda c: F.lower(F.regexp_replace(c, NOT_WRITTEN, ""))
    field = lambda x: F.struct(
        clean(F.regexp_extract(x, r"^([^:=]*)[:=]", 1)).alias("name"), clean(F.regexp_extract(x, r"(?s)^[^:=]*[:=](.*)$", 1)).alias("value")
    )
    fields = F.transform(F.split(F.coalesce(record, F.lit("")), "[;|\r\n]"), field)
    fields = F.filter(fields, lambda f: (f["name"] != "") & (f["value"] != ""))
    number = F.coalesce(number_pair(basefile), clean(basefile), F.lit(""))
    return F.concat(F.array(F.struct(F.lit("basefile:").alias("name"), number.alias("value"))), fields)


def fingerprinted(records: DataFrame) -> DataFrame:
    """(record_id, pairs, fp_lo, fp_hi) of (record_id, basefile, record)."""
    r = records.select("record_id", composed(F.col("basefile")).alias("basefile"), composed(F.col("record")).alias("record"))
    r = r.select("record_id", pairs_of(F.col("basefile"), F.col("record")).alias("pairs"))
    total = lambda part: F.aggregate("pairs", F.lit(0).cast("bigint"), lambda a, p: a + part(F.xxhash64(p["name"], p["value"])))
    return r.select(
        "record_id", "pairs",
        total(lambda h: h.bitwiseAND(0xFFFFFFFF)).alias("fp_lo"),
        total(lambda h: F.shiftrightunsigned(h, 32)).alias("fp_hi"),
    )


def _same_multiset(a: str, b: str) -> Column:
    times = lambda arr, p: F.size(F.filter(F.col(arr), lambda x: x == p))
    return (F.size(a) == F.size(b)) & F.forall(F.col(a), lambda p: times(a, p) == times(b, p))


def groups(records: DataFrame) -> DataFrame:
    """(first_id, record_id): every record with the smallest id of its group.

    The smallest id of a fingerprint is found map-side first; the joins back
    have one row a fingerprint on their one side, so AQE may split a fingerprint
    that holds a third of all rows. Nothing is sorted. Rows with a NULL record_id are left out; a
    record_id that is delivered twice counts once if its pairs agree.
    """
    r = materialize(fingerprinted(records.where("record_id IS NOT NULL")), "fingerprints")
    key = ["fp_lo", "fp_hi"]
    first = r.groupBy(*key).agg(F.min("record_id").alias("first_id"))
    head = r.join(first.withColumnRenamed("first_id", "record_id").hint("shuffle_hash"), [*key, "record_id"])
    head = head.select(*key, F.col("record_id").alias("first_id"), F.col("pairs").alias("first_pairs"))
    j = r.join(head.hint("shuffle_hash"), key)
    other = F.when(~_same_multiset("pairs", "first_pairs"), F.col("pairs"))
    judged = materialize(j.select("first_id", "record_id", other.alias("other")).distinct(), "judged")
    same = judged.where("other IS NULL").select("first_id", "record_id")
    rest = judged.where("other IS NOT NULL").select("record_id", F.array_sort("other").alias("all_pairs"))
    again = rest.join(rest.groupBy("all_pairs").agg(F.min("record_id").alias("first_id")), "all_pairs").select("first_id", "record_id")
    return same.unionByName(again)


def copies(records: DataFrame) -> DataFrame:
    """(first_id, copy_id) of every record but the first of its group."""
    return groups(records).where("record_id <> first_id").select("first_id", F.col("record_id").alias("copy_id")).distinct()


def collapsed(records: DataFrame) -> DataFrame:
    """(record_id, n_copies, number, and the record as written): one row a
    group, with the number of its records, itself included."""
    n = groups(records).groupBy("first_id").agg(F.count("*").alias("n_copies"))
    kept = records.select("record_id", number_pair(F.col("basefile")).alias("number"), "basefile", "record").dropDuplicates(["record_id"])
    return kept.join(n.withColumnRenamed("first_id", "record_id"), "record_id")
