"""Keeping results fresh with Structured Streaming.

Sources are watched folders or streams of rows; sinks are the triple store and
tables of regenerated pages. Every batch is idempotent: it replaces what it is
about, so a batch that is repeated after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codexmill.operators import store


def edits(events: DataFrame) -> DataFrame:
    """Saved pages that are to be regenerated: minor edits are not."""
    return events.where(~F.coalesce("minor", F.lit(False)))


def replace_subjects(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """What a batch states about a subject becomes all that the store says."""

    def batch(rows: DataFrame, _: int) -> None:
        store.replace_subjects(rows, path)

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def append_new(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Statements are added unless the store has them."""

    def batch(rows: DataFrame, _: int) -> None:
        store.add(rows, path)

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def watched(spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A folder as a stream. The checkpoint remembers the files that were
    read, so only new ones are; replacing a file takes a new name."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(folder)


def regenerated(pages: DataFrame, render: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Pages (title, text, minor) rendered again; the newest of a batch counts."""

    def batch(rows: DataFrame, epoch: int) -> None:
        newest = edits(rows).groupBy("title").agg(F.max_by("text", "saved_at").alias("text"), F.max("saved_at").alias("saved_at"))
        render(newest).withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path)

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest_key(df: DataFrame, key: str) -> DataFrame:
    """The largest key seen, from which a later fetch goes on."""
    return df.agg(F.max(key).alias(key))


def trailing(entries: DataFrame, ts: str, days: int = 30) -> DataFrame:
    """Entries of the last days before the newest; an extension for streams is
    ``windowed``."""
    last = entries.agg(F.max(ts).alias("t")).collect()[0]["t"]
    return entries.where(F.lit(last).isNotNull() & (F.col(ts) >= F.lit(last) - F.expr(f"INTERVAL {int(days)} DAYS"))) if last is not None else entries.limit(0)


def windowed(events: DataFrame, ts: str, key: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Extension: counts by time window and key, with late rows let in for a while."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), key).agg(F.count("*").alias("n")).select("w.start", "w.end", key, "n")
