"""Document repositories as settings, and what a crawl's link lists become.

A repository says how its keys are written and where a document lies; fetching
is left to whatever fills the landing tables.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.sources.files import year_number


@dataclass(frozen=True)
class Repository:
    """``url`` and ``path`` hold {year}, {number}, {yy} and {nnnn}; ``key`` is
    the pattern of a key in a link's text, tried before ``lax``."""

    name: str
    url: str
    path: str
    key: str = r"([0-9]{4}:[0-9]+)"
    lax: str = r"([0-9]{4}\s*[:/]\s*[0-9]+)"
    skip: str = ""

    def filled(self, template: str, basefile: Column) -> Column:
        year, number = F.substring_index(basefile, ":", 1), F.substring_index(basefile, ":", -1)
        values = {"year": year, "number": number, "yy": F.substring(year, 3, 2), "nnnn": F.lpad(number, 4, "0")}
        return reduce(lambda t, kv: F.replace(t, F.lit("{" + kv[0] + "}"), kv[1]), values.items(), F.lit(template))

    def located(self, df: DataFrame, basefile: str = "basefile") -> DataFrame:
        """Add ``url`` and ``path``; a slash in a key becomes '-' in a path."""
        b = F.col(basefile)
        return df.withColumn("url", self.filled(self.url, b)).withColumn("path", F.concat(F.lit(self.name + "/"), self.filled(self.path, F.replace(b, F.lit("/"), F.lit("-")))))

    def found(self, links: DataFrame) -> DataFrame:
        """(source, basefile, url) of links (text, url) that name a document,
        each once; a key that several links name keeps the smallest URL."""
        group = lambda p: F.nullif(F.regexp_extract("text", p, 1), F.lit(""))
        key = year_number(F.coalesce(group(self.key), group(self.lax)))
        rows = links.where(~F.contains(F.lower("url"), F.lit(self.skip))) if self.skip else links
        return rows.select(F.lit(self.name).alias("source"), key.alias("basefile"), "url").where("basefile IS NOT NULL").groupBy("source", "basefile").agg(F.min("url").alias("url"))


def unseen(found: DataFrame, landed: DataFrame) -> DataFrame:
    """What a crawl still has to fetch: keys that have not landed."""
    return found.join(landed.select("source", "basefile").distinct(), ["source", "basefile"], "left_anti")


def newest(found: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` newest keys, by year and number: what a quick update fetches."""
    year, number = (F.substring_index("basefile", ":", i).try_cast("int") for i in (1, -1))
    return found.orderBy(year.desc_nulls_last(), number.desc_nulls_last(), "basefile").limit(n)


def first_of(ordered: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """Union of repositories in order; a key is taken from the first that has it."""
    parts = [df.withColumn("_rank", F.lit(i)).withColumn("_from", F.lit(name)) for i, (name, df) in enumerate(ordered)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    best = F.min_by(F.struct(*[c for c in rows.columns if c not in ("_rank", "_from")], F.col("_from").alias("repository")), "_rank")
    return rows.groupBy("basefile").agg(best.alias("b")).select("b.*")
