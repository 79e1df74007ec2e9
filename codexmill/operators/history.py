"""Histories of changing attributes from snapshots.

Tree reduction: every reported value is a unit interval. The units of an entity
and a block of days meet in one row, where neighbouring runs are merged in pairs,
then pairs of pairs and so on, for as many rounds as the logarithm of their
number; where two runs that meet carry equal payloads they become one run. A
block has one unit a day at most, so a row is bounded however many snapshots an
entity has. Over its blocks an entity is then scanned: a block takes the value
last known from the blocks before it, which settles its first run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days in a block (a power of two by its bits); so many units a row holds at most.
BLOCK_BITS = 10
OPEN_END = "9999-12-31"


def coalesced(units: Column, payload: str) -> Column:
    """ARRAY<STRUCT<lo, hi, v>>: the maximal runs of equal payloads of
    ARRAY<STRUCT<at INT, v payload>>, which is in order of ``at`` and has no
    NULL payload. Equal neighbours merge whatever lies between them in time."""
    runs = f"array<struct<lo:int,hi:int,v:{payload}>>"

    def met(left: Column, right: Column) -> Column:
        a, b = F.element_at(left, -1), F.element_at(right, 1)
        one = F.array(F.struct(a["lo"].alias("lo"), b["hi"].alias("hi"), a["v"].alias("v")))
        merged = F.concat(F.slice(left, 1, F.size(left) - 1), one, F.slice(right, 2, F.size(right)))
        return F.when(right.isNull(), left).when(a["v"] == b["v"], merged).otherwise(F.concat(left, right))

    def paired(level: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
        return F.transform(pairs, lambda i: met(F.get(level, 2 * i), F.get(level, 2 * i + 1))).cast(f"array<{runs}>")

    leaves = F.transform(units, lambda u: F.array(F.struct(u["at"].alias("lo"), u["at"].alias("hi"), u["v"].alias("v")))).cast(f"array<{runs}>")
    rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.size(units))).cast("int"))
    top = F.when(F.size(units) > 1, F.aggregate(rounds, leaves, lambda level, _: paired(level))).otherwise(leaves)
    return F.coalesce(F.get(top, 0), F.array().cast(runs))


def histories(days: DataFrame, attributes: dict[str, str], block_bits: int = BLOCK_BITS) -> DataFrame:
    """(entity, from_day, to_day, and the attributes) of (entity, day INT, and
    the attributes), which has one row an entity and day.

    ``attributes`` has the type of each. NULL in an attribute means that it was
    not reported: the value last reported stands. A version begins on an
    entity's first day and wherever an attribute takes another value; ``to_day``
    is the day that the next one begins, or NULL.
    """
    names = list(attributes)
    units = F.array_sort(F.collect_list(F.struct("day", *names)))
    blocks = days.groupBy("entity", F.shiftright("day", block_bits).alias("block")).agg(units.alias("units"))
    runs_of = lambda a: coalesced(F.transform(F.filter("units", lambda u: u[a].isNotNull()), lambda u: F.struct(u["day"].alias("at"), u[a].alias("v"))), attributes[a])
    x = blocks.select("entity", "block", F.col("units")[0]["day"].alias("first"), *[runs_of(a).alias(a) for a in names])
    w = Window.partitionBy("entity").orderBy("block")
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    x = x.select("*", F.lag("block").over(w).isNull().alias("opens"), *[F.last(F.try_element_at(a, F.lit(-1))["v"], True).over(before).alias(f"old_{a}") for a in names])
    changed = lambda a: F.transform(F.filter(a, lambda r, i: (i > 0) | F.col(f"old_{a}").isNull() | (r["v"] != F.col(f"old_{a}"))), lambda r: r["lo"])
    begins = F.concat(F.when(F.col("opens"), F.array("first")).otherwise(F.array().cast("array<int>")), *[changed(a) for a in names])
    x = x.withColumn("begins", F.array_sort(F.array_distinct(begins)))
    x = x.withColumn("later", F.first(F.get("begins", F.lit(0)), True).over(after))
    x = x.select("*", F.posexplode("begins").alias("i", "from_day"))
    stands = lambda a: F.coalesce(F.try_element_at(F.filter(a, lambda r: r["lo"] <= F.col("from_day")), F.lit(-1))["v"], F.col(f"old_{a}")).alias(a)
    return x.select("entity", "from_day", F.coalesce(F.get("begins", F.col("i") + 1), F.col("later")).alias("to_day"), *[stands(a) for a in names])


def latest_fetch(snapshots: DataFrame) -> DataFrame:
    """One row per uri and day: the one ingested last (then the largest id).

    The maximum is taken map-side before the shuffle, so a uri with a third of
    all rows arrives as no more rows than there are days.
    """
    kons = F.array_sort(F.array_distinct(F.filter("konsolideringsunderlag", lambda x: x.isNotNull())))
    return (
        snapshots.where(F.col("senasthamtad").isNotNull() & F.col("uri").isNotNull())
        .select(
            F.col("uri").alias("entity"),
            F.unix_date("senasthamtad").alias("day"),
            F.struct("ingested_at", "snapshot_id", F.col("utfardandedatum").alias("utf"), kons.alias("kons")).alias("v"),
        )
        .groupBy("entity", "day")
        .agg(F.max("v").alias("v"))
        .select("entity", "day", "v.utf", "v.kons")
    )


def version_history(snapshots: DataFrame) -> DataFrame:
    """Versions (uri, valid_from, valid_to, utfardandedatum,
    konsolideringsunderlag) of each statute's state.

    * Rows without ``senasthamtad`` or ``uri`` say nothing. Of rows with equal
      uri and day the one ingested last counts, then the largest snapshot_id.
    * NULL in an attribute means not reported: the value last reported stands.
      NULL elements and repeated or reordered elements of the list do not
      count; an empty list is a reported, empty set.
    * An attribute's change does not depend on the other attribute, so each is
      coalesced alone; a version begins at the first fetch and wherever either
      attribute begins a new run.
    * ``valid_to`` is the day the next version begins or 9999-12-31. An empty
      input gives an empty result.
    """
    v = histories(latest_fetch(snapshots), {"utf": "date", "kons": "array<string>"})
    day = lambda c: F.date_format(F.date_from_unix_date(c), "yyyy-MM-dd")
    return v.select(
        F.col("entity").alias("uri"),
        day("from_day").alias("valid_from"),
        F.coalesce(day("to_day"), F.lit(OPEN_END)).alias("valid_to"),
        F.col("utf").alias("utfardandedatum"),
        F.col("kons").alias("konsolideringsunderlag"),
    )
