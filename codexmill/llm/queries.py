"""Queries of the problems on texts (p3, p4, p6, p7, p8); SQL is in ``sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codexmill.llm import dedup, encoding, mixing, packing, stuffing, tokens
from codexmill.llm.sql import ORACLE
from codexmill.session import materialize, table

__all__ = ["ORACLE", "QUERIES"]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.copies(table(spark, sf_dir, "direktiv_records"))


def p3_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.collapsed(table(spark, sf_dir, "direktiv_records")).select("record_id", "number", "n_copies")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields that may hold wrongly decoded text."""
    fields = (("sfs_snapshots", "snapshot_id", "title"), ("dv_cases", "case_id", "description"), ("skvfs_regulations", "reg_id", "body"))
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("src_table"), F.col(i).alias("row_id"), F.col(c).alias("text")) for t, i, c in fields]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.found(_texts(spark, sf_dir))


def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.restored(_texts(spark, sf_dir))


def _capacities(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """A table of settings, one row a kind of container."""
    return {r["container_kind"]: r["capacity_tokens"] for r in table(spark, sf_dir, "container_sizes").collect()}


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _capacities(spark, sf_dir))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"), _capacities(spark, sf_dir))


def p6_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By kind: containers above their capacity, texts that are not or not
    wholly packed, and texts whose pieces do not follow each other."""
    caps = _capacities(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    p = materialize(packing.pack(docs, caps), "packed")
    cap = F.element_at(F.create_map(*[F.lit(x) for kv in caps.items() for x in kv]), F.col("container_kind"))
    over = p.groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("used")).groupBy("container_kind").agg(F.sum((F.col("used") > cap).cast("bigint")).alias("containers_over"))
    per = p.groupBy("container_kind", "doc_id").agg(F.sum("n_tokens").alias("n"), F.max(F.col("token_start") + F.col("n_tokens")).alias("end"), F.count("*").alias("k"), F.countDistinct("token_start").alias("starts"))
    uneven = per.groupBy("container_kind").agg(F.sum(((F.col("n") != F.col("end")) | (F.col("k") != F.col("starts"))).cast("bigint")).alias("uneven"))
    n = tokens.counted_texts(docs.where("doc_id IS NOT NULL"))
    have = n.select("doc_id", "n_tokens", F.explode(F.array(*map(F.lit, caps))).alias("container_kind"))
    lost = have.join(per.withColumnRenamed("n", "packed"), ["container_kind", "doc_id"], "left").groupBy("container_kind").agg(F.sum((~F.col("packed").eqNullSafe(F.col("n_tokens"))).cast("bigint")).alias("lost"))
    return over.join(uneven, "container_kind").join(lost, "container_kind")


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), mixing.AVAILABLE)


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[0]


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]


def p7_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By source: whether its documents are used within their repeats, and
    whether it has its share: all that its repeats give, or as many tokens for
    its target as any source that is not at its repeats, to a hundredth or to
    one document of average length."""
    copies, rep = _mix(spark, sf_dir)
    cap = table(spark, sf_dir, "mix_targets").select("source", "max_repeats")
    used = copies.join(F.broadcast(cap), "source").groupBy("source").agg(F.max(F.col("copies") - F.col("max_repeats")).alias("over"), F.count("*").alias("k"), F.countDistinct("doc_id").alias("ids"))
    full = F.col("mix_tokens") == F.col("max_repeats") * F.col("tokens")
    rate = F.col("mix_tokens") / F.col("target_share")
    #: over one row a source, a table of settings
    top = F.max(F.when(~full & (F.col("target_share") > 0), rate)).over(Window.partitionBy(F.lit(0)))
    r = rep.join(F.broadcast(used), "source", "left").withColumn("top", top)
    short = F.col("top") * F.col("target_share") - F.col("mix_tokens")
    fair = full | (F.col("target_share") <= 0) | (short <= F.greatest(0.01 * F.col("mix_tokens"), F.col("tokens") / F.col("documents")))
    return r.select("source", (F.coalesce("over", F.lit(0)) <= 0).alias("within_repeats"), (F.coalesce("k", F.lit(0)) == F.coalesce("ids", F.lit(0))).alias("once"), F.coalesce(fair, F.lit(False)).alias("met"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffing.stuffed_pages(table(spark, sf_dir, "documents")).select("doc_id")


def p8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffing.stuffed_pages(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p3_found, p3_collapsed, p4_found, p4_restored, p6_containers, p6_report, p6_valid, p7_mix, p7_report, p7_valid, p8_found, p8_pages)}
