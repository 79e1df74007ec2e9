"""References whose target did not exist at the time of the reference.

Keys are dictionary-encoded to integers inside hash buckets. For every range of
64 keys (a word) and period there are three bitmaps: keys referenced, keys that
some parent row holds at some time of the period, and keys that a parent row
holds throughout the period. Words without a set bit are not stored, which is
the compression; liveness is stored as the months where a bit flips and rebuilt
by a running XOR. ``referenced AND NOT possible`` survives as certain orphans,
``referenced AND possible AND NOT throughout`` goes on to an exact check in
time, and only surviving bits are decoded to keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexmill.operators.scan import running_sum
from codexmill.session import materialize

OPEN = 1 << 20
WORD_BITS = 6
#: Rows whose keys share a dictionary: one task sorts a bucket, so there are more buckets where there are more rows.
BUCKET_ROWS = 50_000
LEAST_BUCKETS = 256


def month_no(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts) - 1


def _bucket(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("domain", "key"), F.lit(n_buckets)).cast("int")


def _parent_spans(parents: DataFrame) -> DataFrame:
    """Months in which a parent row is live at some time, and throughout."""
    a, b = F.col("live_from"), F.col("live_to")
    p = parents.where(F.col("key").isNotNull() & a.isNotNull() & (b.isNull() | (b > a)))
    at_start = F.trunc(a.cast("date"), "month").cast(parents.schema["live_from"].dataType) == a
    return p.select(
        "domain",
        "key",
        month_no(a).alias("p_from"),
        F.when(b.isNull(), OPEN).otherwise(month_no(b - F.expr("INTERVAL 1 MICROSECOND"))).alias("p_to"),
        F.when(at_start, month_no(a)).otherwise(month_no(a) + 1).alias("f_from"),
        F.when(b.isNull(), OPEN).otherwise(month_no(b) - 1).alias("f_to"),
    )


def _words(refs: DataFrame, parents: DataFrame, n_buckets: int) -> tuple[DataFrame, DataFrame]:
    """(encoded reference keys, bitmap words by bucket, word and month)."""
    r = refs.select("domain", "key", "month").distinct()
    r = r.select("domain", "key", F.lit(0).alias("kind"), F.col("month").alias("lo"), F.col("month").alias("hi"))
    p = _parent_spans(parents).groupBy("domain", "key", "p_from", "f_from").agg(F.max("p_to").alias("p_to"), F.max("f_to").alias("f_to"))
    span = lambda kind, lo, hi: F.struct(F.lit(kind).alias("kind"), F.col(lo).alias("lo"), F.col(hi).alias("hi"))
    p = p.select("domain", "key", F.explode(F.array(span(1, "p_from", "p_to"), span(2, "f_from", "f_to"))).alias("x"))
    p = p.select("domain", "key", "x.*").where("lo <= hi")
    enc = r.unionByName(p).withColumn("bucket", _bucket(n_buckets))
    enc = enc.withColumn("code", F.dense_rank().over(Window.partitionBy("bucket").orderBy("domain", "key")) - 1)
    before = Window.partitionBy("bucket", "domain", "key", "kind").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    cut = enc.withColumn("seen", F.when(F.col("kind") > 0, F.max("hi").over(before)))
    cut = cut.where((F.col("kind") == 0) | F.col("seen").isNull() | (F.col("hi") > F.col("seen")))
    lo = F.greatest(F.col("lo"), F.coalesce(F.col("seen") + 1, F.col("lo")))
    flips = F.when(F.col("kind") == 0, F.array("lo")).otherwise(F.array(lo, F.col("hi") + 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("code").bitwiseAND(63).cast("int"))
    ev = cut.select("bucket", F.shiftright("code", WORD_BITS).alias("word"), bit.alias("bit"), "kind", F.explode(flips).alias("month"))
    ev = ev.where(F.col("month") <= OPEN)
    pick = lambda k: F.when(F.col("kind") == k, F.col("bit"))
    words = ev.groupBy("bucket", "word", "month").agg(
        F.coalesce(F.bit_or(pick(0)), F.lit(0)).alias("referenced"),
        F.coalesce(F.bit_xor(pick(1)), F.lit(0)).alias("flip_possible"),
        F.coalesce(F.bit_xor(pick(2)), F.lit(0)).alias("flip_throughout"),
    )
    upto = Window.partitionBy("bucket", "word").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    words = words.select(
        "bucket", "word", "month", "referenced",
        F.bit_xor("flip_possible").over(upto).alias("possible"),
        F.bit_xor("flip_throughout").over(upto).alias("throughout"),
    )
    return enc.where("kind = 0").select("bucket", "code", F.col("lo").alias("month"), "domain", "key"), words.where("referenced <> 0")


def suspects(refs: DataFrame, parents: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """(domain, key, month, certain): the keys of surviving bits by month."""
    n_buckets = n_buckets or max(LEAST_BUCKETS, -(-(refs.count() + parents.count()) // BUCKET_ROWS))
    coded, words = _words(refs, parents, n_buckets)
    left = words.select(
        "bucket", "word", "month",
        F.expr("referenced & ~possible").alias("dead"),
        F.expr("referenced & possible & ~throughout").alias("partly"),
    ).where("dead <> 0 OR partly <> 0")
    bits = left.select("bucket", "word", "month", "dead", "partly", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i"))
    is_set = lambda c: F.expr(f"(shiftrightunsigned({c}, i) & 1) = 1")
    bits = bits.where(is_set("dead") | is_set("partly"))
    bits = bits.select("bucket", (F.shiftleft("word", WORD_BITS) + F.col("i")).alias("code"), "month", is_set("dead").alias("certain"))
    return coded.join(bits, ["bucket", "code", "month"]).select("domain", "key", "month", "certain")


def find_orphans(refs: DataFrame, parents: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """Rows of ``refs`` for whose (domain, key) no row of ``parents`` is live at
    ``at``; a parent is live from ``live_from`` until before ``live_to``.

    refs: domain, key, at and any other columns; parents: domain, key,
    live_from, live_to, where other columns do not count.
    References with a NULL key are no references. A reference with NULL ``at``
    can meet no live row and is an orphan. Parents with a NULL key or
    ``live_from``, or ending no later than they begin, are never live. Repeated
    rows stay repeated. A key with a third of all rows is reduced map-side to
    one row a month before keys are shuffled.
    """
    r = refs.select("domain", "key", "at", F.struct(*refs.columns).alias("row")).where(F.col("key").isNotNull())
    timed = r.where(F.col("at").isNotNull()).withColumn("month", month_no(F.col("at")))
    p = parents.select("domain", "key", "live_from", "live_to")
    hit = materialize(timed.join(suspects(timed, p, n_buckets), ["domain", "key", "month"]), "suspects")
    maybe = hit.where(~F.col("certain"))
    live = p.where(F.col("live_from").isNotNull() & (F.col("live_to").isNull() | (F.col("live_to") > F.col("live_from"))))
    asked = maybe.select("domain", "key", "at").distinct()
    flips = live.join(asked.select("domain", "key").distinct(), ["domain", "key"], "left_semi").select(
        "domain", "key", F.explode(F.array(
            F.struct(F.col("live_from").alias("at"), F.lit(1).alias("d")), F.struct(F.col("live_to").alias("at"), F.lit(-1).alias("d"))
        )).alias("x"),
    )
    flips = flips.select("domain", "key", "x.at", "x.d", F.lit(0).alias("asked")).where(F.col("at").isNotNull())
    ticks = flips.unionByName(asked.select("domain", "key", "at", F.lit(0).alias("d"), F.lit(1).alias("asked")))
    ticks = ticks.groupBy("domain", "key", "at").agg(F.sum("d").alias("d"), F.max("asked").alias("asked")).withColumn("_m", month_no(F.col("at")))
    dead = running_sum(ticks, ["domain", "key"], "at", "_m", "d", "_live").where("asked = 1 AND _live = 0").select("domain", "key", "at")
    checked = maybe.join(dead, ["domain", "key", "at"], "left_semi")
    never = r.where(F.col("at").isNull())
    return hit.where("certain").select("row.*").unionByName(checked.select("row.*")).unionByName(never.select("row.*"))
