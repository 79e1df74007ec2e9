"""A mix of sources with target shares of all tokens.

Entropy balancing: among document rates that meet every source's token target
the one closest (in relative entropy) to using each document once, and within
the cap on repeats, is an exponential tilt ``min(cap, exp(lambda * tokens))``.
Newton steps on the convex dual find lambda of each source; a step is one
distributed aggregation over the histogram of text sizes, which is exact and
much smaller than the documents. Rates are rounded to whole copies by a hash of
the document, with a threshold per source found in two passes over a histogram
of hashes; what is then missing is filled by the longest documents that fit.
Documents are whole and a target is never exceeded: a document longer than what
its source may give stays out, shorter ones fill its place, and where there are
none the source falls short by what is left.

What is known of each source (a row of settings) enters the plans as a literal
map, so documents are never joined, shuffled or broadcast by their source.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexmill.llm.tokens import VOCABULARY, counter
from codexmill.session import materialize

#: Bins of one refinement of the rounding threshold; at most this many rows a source reach the driver.
BINS = 1 << 12
STEPS = 60
#: Rounds that fill what the threshold leaves of a source's target.
FILLS = 6
#: A total of as many tokens as the sources of the mix hold.
AVAILABLE = "available"


def counted(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens) of (doc_id, source, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = counter(vocabulary)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": [n(t) for t in b["text"]]})

    return docs.where("doc_id IS NOT NULL").select("doc_id", "source", "text").mapInPandas(count, "doc_id bigint, source string, n_tokens bigint")


def plan(targets: list[dict], tokens: dict[str, int], total: float | str | None = None) -> tuple[dict[str, float], dict[str, float]]:
    """(wanted tokens, wanted share) by source. Shares of sources without tokens
    go to the others in proportion. With a total (``AVAILABLE``: the tokens of
    all sources that may be used) sources that can't reach their share give all
    that they may and the others fill the rest in proportion, which of all mixes
    of that size is the closest (in relative entropy) to the shares. Without a
    total it is the largest at which no source needs more than its repeats."""
    live = {t["source"]: t for t in targets if tokens.get(t["source"], 0) > 0 and (t["target_share"] or 0) > 0 and (t["max_repeats"] or 0) > 0}
    whole = sum(t["target_share"] for t in live.values())
    share = {s: t["target_share"] / whole for s, t in live.items()}
    most = {s: t["max_repeats"] * tokens[s] for s, t in live.items()}
    if total is None:
        size = min((most[s] / share[s] for s in live), default=0.0)
        return {s: min(most[s], share[s] * size) for s in live}, share
    left = float(sum(tokens[s] for s in live) if total == AVAILABLE else total)
    want: dict[str, float] = {}
    while rest := sorted(live.keys() - want.keys()):
        part = left / sum(share[s] for s in rest)
        full = [s for s in rest if most[s] <= part * share[s]]
        if not full:
            return want | {s: part * share[s] for s in rest}, share
        want |= {s: float(most[s]) for s in full}
        left -= sum(most[s] for s in full)
    return want, share


def _of(values: dict[str, float | int | None], kind: str = "double") -> Column:
    """Setting of a row's source; NULL for other sources."""
    known = {s: v for s, v in values.items() if v is not None}
    if not known:
        return F.lit(None).cast(kind)
    return F.element_at(F.create_map(*[F.lit(x) for kv in sorted(known.items()) for x in kv]), F.col("source")).cast(kind)


def tilt(hist: DataFrame, want: dict[str, float], cap: dict[str, int], tokens: dict[str, int], scale: float) -> dict[str, float]:
    """lambda of each source: Newton on the logarithm of the dual's gradient,
    kept inside a shrinking bracket. Sources that must give all have infinity."""
    lam = {s: (math.inf if want[s] >= cap[s] * tokens[s] * (1 - 1e-12) else 0.0) for s in want}
    low, high = dict.fromkeys(want, -math.inf), dict.fromkeys(want, math.inf)
    live = {s for s in want if lam[s] != math.inf}
    for _ in range(STEPS):
        if not live:
            break
        x = F.col("n_tokens") / F.lit(scale)
        rate = F.least(F.col("cap"), F.exp(F.col("lam") * x))
        free = F.exp(F.col("lam") * x) < F.col("cap")
        got = (
            hist.where(F.col("source").isin(sorted(live)))
            .select("*", _of({s: lam[s] for s in live}).alias("lam"), _of({s: cap[s] for s in live}).alias("cap"))
            .groupBy("source")
            .agg(F.sum(F.col("docs") * F.col("n_tokens") * rate).alias("s"), F.sum(F.when(free, F.col("docs") * F.col("n_tokens") * x * rate)).alias("h"))
            .collect()
        )
        for r in got:
            s, now, slope = r["source"], r["s"], r["h"] or 0.0
            if abs(now - want[s]) <= 1e-9 * want[s]:
                live.discard(s)
                continue
            (low if now < want[s] else high)[s] = lam[s]
            step = lam[s] + math.log(want[s] / now) * now / slope if slope > 0 and now > 0 else math.nan
            if not low[s] < step < high[s]:
                a, b = low[s], high[s]
                step = (a + b) / 2 if math.isfinite(a + b) else (a + 1 + abs(a) if math.isfinite(a) else b - 1 - abs(b))
            if step == lam[s]:
                live.discard(s)
            lam[s] = step
    return lam


def mix(docs: DataFrame, targets: DataFrame, total_tokens: float | str | None = None, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(copies, report).

    copies: doc_id, source, n_tokens, copies (1 to max_repeats) of documents
    that are in the mix. report: a row for each source of ``targets`` with
    target_share, max_repeats, documents, tokens, mix_tokens, actual_share and
    wanted_share (the target after the shares of empty sources went to the
    others; above actual_share where the repeats don't allow it). ``targets`` is a table of settings with one row a source: it is
    read to the driver. Documents whose source is NULL or not a target, those
    without tokens and those without an id are not used. Sources without documents report 0.
    """
    spark = docs.sparkSession
    rows = [r.asDict() for r in targets.where("source IS NOT NULL").collect()]
    if len({r["source"] for r in rows}) != len(rows):
        raise ValueError("targets name a source twice")
    names = [r["source"] for r in rows]
    used = materialize(counted(docs.where(F.col("source").isin(names)), vocabulary), "counted").where("n_tokens > 0")
    hist = materialize(used.groupBy("source", "n_tokens").agg(F.count("*").alias("docs")), "sizes")
    have = {r["source"]: r for r in hist.groupBy("source").agg(F.sum(F.col("docs") * F.col("n_tokens")).alias("tokens"), F.sum("docs").alias("docs")).collect()}
    tokens = {s: r["tokens"] for s, r in have.items()}
    want, goal = plan(rows, tokens, total_tokens)
    cap = {r["source"]: r["max_repeats"] for r in rows}
    scale = sum(tokens.values()) / max(1, sum(r["docs"] for r in have.values())) or 1.0
    lam = tilt(hist, want, cap, tokens, scale)
    r = _rated(used, want, lam, cap, scale)
    extra = _extra(r, want)
    out = r.select("doc_id", "source", "n_tokens", (F.col("base") + extra).cast("int").alias("copies")).where("copies > 0")
    got = out.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mix_tokens"))
    known = [(t["source"], t["target_share"], t["max_repeats"], int(have[t["source"]]["docs"]) if t["source"] in have else 0, int(tokens.get(t["source"], 0)), float(goal.get(t["source"], 0.0))) for t in rows]
    rep = spark.createDataFrame(known, "source string, target_share double, max_repeats int, documents bigint, tokens bigint, wanted_share double")
    rep = rep.join(F.broadcast(got), "source", "left").withColumn("mix_tokens", F.coalesce("mix_tokens", F.lit(0)))
    #: over one row a target, a table of settings
    whole = F.sum("mix_tokens").over(Window.partitionBy(F.lit(0)))
    rep = rep.withColumn("actual_share", F.when(whole > 0, F.col("mix_tokens") / whole).otherwise(0.0))
    return out, rep


def _rated(used: DataFrame, want: dict[str, float], lam: dict[str, float], cap: dict[str, int], scale: float) -> DataFrame:
    """(doc_id, source, n_tokens, base, edge) of documents of wanted sources:
    whole copies, and how far the document's hash lies above the rest of its
    rate; NULL where the cap is reached. Equal ids of one source share a hash."""
    wanted = used.where(F.col("source").isin(sorted(want))) if want else used.limit(0)
    x = wanted.select("doc_id", "source", "n_tokens", _of(lam).alias("lam"), _of({s: cap[s] for s in want}).alias("cap"))
    rate = F.when(F.col("lam") == math.inf, F.col("cap")).otherwise(F.least(F.col("cap"), F.exp(F.col("lam") * F.col("n_tokens") / F.lit(scale))))
    u = F.pmod(F.xxhash64("doc_id", F.lit(20240229)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    x = x.withColumn("rate", rate).withColumn("base", F.floor("rate"))
    return x.select("doc_id", "source", "n_tokens", "base", F.when(F.col("base") < F.col("cap"), u - (F.col("rate") - F.col("base"))).alias("edge"))


def _extra(r: DataFrame, want: dict[str, float]) -> Column:
    """1 for documents that get a copy more, else 0: all of a source's whose
    edge is below its threshold, then, where a longer document crosses the
    target, what fits into the rest, for up to ``FILLS`` rounds. A rest that
    holds several documents gets a threshold of its own among those that fit;
    a smaller one the longest that fits. A document delivered several times is
    no filling."""
    whole = {x["source"]: x["t"] for x in r.groupBy("source").agg(F.sum(F.col("base") * F.col("n_tokens")).alias("t")).collect()} if want else {}
    left = {s: want[s] - float(whole.get(s) or 0) for s in want}
    since, free = dict.fromkeys(want, -1.0), F.col("edge").isNotNull()
    taken, picked = F.lit(False), set()
    for k in range(FILLS + 1):
        live = {s: x for s, x in left.items() if x >= 1}
        if not live:
            break
        fits = free & (F.col("edge") >= _of(since)) & (F.lit(k == 0) | (F.col("n_tokens") <= _of(live)))
        fits = fits & ~F.col("doc_id").isin(sorted(picked)) if picked else fits
        may = r.where(fits & F.col("source").isin(sorted(live)))
        some = live
        if k:
            best = {x["source"]: x["b"] for x in may.groupBy("source").agg(F.max(F.struct("n_tokens", "doc_id")).alias("b")).collect()}
            some = {s: live[s] for s in best if live[s] >= 3 * best[s]["n_tokens"]}
            ids = {s: b["doc_id"] for s, b in best.items() if s not in some}
            times = dict(r.where(F.col("doc_id").isin(list(ids.values()))).groupBy("doc_id").count().collect()) if ids else {}
            for s, i in ids.items():
                if times[i] == 1:
                    left[s] -= best[s]["n_tokens"]
                    picked.add(i)
            if not best:
                break
        if some:
            cut, got = _threshold(may.where(F.col("source").isin(sorted(some))), some, since)
            hit = fits & (F.col("edge") < _of(cut))
            taken = taken | F.coalesce(hit, F.lit(False))
            since = since | cut
            left = {s: x - got.get(s, 0.0) for s, x in left.items()}
    chosen = taken | F.col("doc_id").isin(sorted(picked)) if picked else taken
    return F.when(chosen, 1).otherwise(0)


def _threshold(r: DataFrame, left: dict[str, float], since: dict[str, float]) -> tuple[dict[str, float], dict[str, float]]:
    """(threshold, tokens below it) of each source: as far as its documents, in
    the order of their edges, stay within what is left. It is found in ``BINS``
    bins, then in as many inside the bin where the target is crossed."""
    got = dict.fromkeys(left, 0.0)
    lo, hi = {s: since[s] for s in left}, dict.fromkeys(left, 1.0)
    for _ in range(2):
        at = F.floor((F.col("edge") - _of(lo)) / (_of(hi) - _of(lo)) * BINS)
        inside = r.where((F.col("edge") >= _of(lo)) & (F.col("edge") < _of(hi)))
        bins: dict[str, list[tuple[int, int]]] = {s: [] for s in left}
        for x in inside.groupBy("source", F.least(F.lit(BINS - 1), at).alias("b")).agg(F.sum("n_tokens").alias("t")).collect():
            bins[x["source"]].append((x["b"], x["t"]))
        for s, found in bins.items():
            width, cross = (hi[s] - lo[s]) / BINS, None
            for i, t in sorted(found):
                if got[s] + t > left[s]:
                    cross = i
                    break
                got[s] += t
            lo[s], hi[s] = (hi[s], hi[s] + width) if cross is None else (lo[s] + cross * width, lo[s] + (cross + 1) * width)
    return lo, got
