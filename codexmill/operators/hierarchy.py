"""Parent-child rows to hierarchies: path, depth, root, descendants, cycles.

Edges are range-partitioned by child, so that neighbours in name order, which
mostly belong to one tree, share a fragment and a large tree spreads over many.
Each fragment contracts its parent chains to the first node outside of it (the
exit) by pointer doubling. Only nodes that are exits of other fragments stay in
the quotient, which is solved the same way until it fits one fragment; then
paths and cycles are expanded fragment by fragment. Fragments are of one size at
every level. Names are no neighbourhood in a quotient, so there a coin decides
which nodes join their parent's fragment: of the links of any chain a quarter is
contracted at each level, besides all nodes that nothing leads to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.operators.closure import all_pairs
from codexmill.session import materialize

SEP = "\x1f"
#: Edges in one fragment. A fragment is held in a task's memory, about 1 kB an edge.
FRAGMENT_EDGES = 120_000

_CONTRACTED = "frag int, s string, o string, primary boolean, lead string, exit string, hops bigint, seg string, scc string, n_parents int"


class _Fragment:
    """The edges of one fragment, contracted.

    Rows with ``primary`` carry a node's own result; all rows with an exit are
    the (node, exit) pairs that its edges lead to. ``scc`` names the cycle (the
    strongly connected set) that a node lies on by its smallest node.
    """

    def __init__(self, e: pd.DataFrame, segments: bool, base: bool = True) -> None:
        e = e.sort_values(["s", "primary", "o"], ascending=[True, False, True], kind="stable").reset_index(drop=True)
        self.e, self.segments = e, segments
        names = pd.Index(e["s"].unique())
        self.names, n = names, len(names)
        src = names.get_indexer(e["s"])
        dst = names.get_indexer(e["o"])
        self.src, self.dst = src, dst
        first = np.flatnonzero(np.r_[True, src[1:] != src[:-1]]) if len(src) else np.array([], dtype=int)
        self.first = first
        degree = np.bincount(src, minlength=n)
        self.degree = degree
        self._primary(n, first, dst, np.ones(n, dtype=bool) if base else e["primary"].to_numpy(dtype=bool)[first])
        self._cycles(n, first, src, dst, degree)

    @staticmethod
    def _double(nxt: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Follow pointers (-1 ends a chain): the last node of each chain, the
        weight up to it, and whether the chain ends at all."""
        n = len(nxt)
        own = np.arange(n)
        end = np.where(nxt < 0, own, nxt)
        far = np.where(nxt < 0, 0, weight)
        for _ in range(max(1, n).bit_length() + 1):
            step = end[end]
            if (step == end).all():
                break
            far = far + far[end]
            end = step
        return end, far, nxt[end] < 0

    def _primary(self, n: int, first: np.ndarray, dst: np.ndarray, has: np.ndarray) -> None:
        """In the quotient a node's own parent chain may have ended in a cycle
        (``has`` is false); pointing at itself, it has no exit here either."""
        hops = self.e["hops"].to_numpy()[first] if n else np.array([], dtype=np.int64)
        nxt = np.where(has, dst[first], np.arange(n)) if n else np.array([], dtype=int)
        end, far, ends = self._double(nxt, hops)
        out = self.e["o"].to_numpy()[first][end] if n else np.array([], dtype=object)
        self.exit = np.where(ends, out, None)
        self.hops = np.where(ends, far + (hops[end] if n else 0), 0)
        self.seg = np.full(n, None, dtype=object)
        if not self.segments:
            return
        seg = self.e["seg"].to_numpy()[first]
        depth = self._double(nxt, np.ones(n, dtype=np.int64))[1]
        for i in np.argsort(depth, kind="stable"):
            if ends[i]:
                self.seg[i] = seg[i] if nxt[i] < 0 else self.seg[nxt[i]] + SEP + seg[i]

    def _cycles(self, n: int, first: np.ndarray, src: np.ndarray, dst: np.ndarray, degree: np.ndarray) -> None:
        """Chains of single-parent nodes contract to their terminal: a node
        whose only parent is outside, or one with several parents. Strongly
        connected sets are then sought among the few latter nodes only."""
        o = self.e["o"].to_numpy()
        complex_ = degree > 1
        nxt = np.where(complex_, -1, dst[first]) if n else np.array([], dtype=int)
        end, _, ends = self._double(nxt, np.ones(n, dtype=np.int64))
        self.term = np.where(ends, end, -1)
        scc_of = np.full(n, None, dtype=object)
        #: after n steps a chain without end stands on its cycle, and every node of a cycle is so reached
        for v in np.unique(end[~ends]).tolist():
            if scc_of[v] is None:  # the smallest of its cycle, as nodes are sorted
                w = v
                while scc_of[w] is None:
                    scc_of[w] = self.names[v]
                    w = int(nxt[w])
        rows_of = {int(c): range(int(first[c]), int(first[c]) + int(degree[c])) for c in np.flatnonzero(complex_)}
        graph: dict[int, list[int]] = {c: [] for c in rows_of}
        direct: dict[int, set[str]] = {c: set() for c in rows_of}
        for c, rows in rows_of.items():
            for k in rows:
                t = int(dst[k])
                if t < 0:
                    direct[c].add(o[k])
                    continue
                t = int(self.term[t])
                if t < 0:
                    continue
                if complex_[t]:
                    graph[c].append(t)
                else:
                    direct[c].add(o[first[t]])
        self.exits: dict[int, frozenset[str]] = {}
        for scc in _sccs(graph):
            inside = set(scc)
            reach = set().union(*(direct[c] for c in scc), *(self.exits[t] for c in scc for t in graph[c] if t not in inside))
            for c in scc:
                self.exits[c] = frozenset(reach)
            if len(scc) > 1 or scc[0] in graph[scc[0]]:
                ring = set(scc)
                for c in scc:
                    for r in rows_of[c]:
                        v = int(dst[r])
                        if v >= 0 and int(self.term[v]) in inside:
                            while v not in inside:
                                ring.add(v)
                                v = int(nxt[v])
                scc_of[list(ring)] = self.names[min(ring)]
        self.scc = scc_of

    def exits_of(self, v: int) -> frozenset[str]:
        t = int(self.term[v])
        if t < 0:
            return frozenset()
        return self.exits[t] if t in self.exits else frozenset([self.e["o"].iat[int(self.first[t])]])

    def rows(self, frag: int) -> pd.DataFrame:
        e, n = self.e, len(self.names)
        out = pd.DataFrame({"frag": np.int32(frag), "s": e["s"], "o": e["o"]})
        is_first = np.zeros(len(e), dtype=bool)
        is_first[self.first] = True
        out["primary"] = is_first
        put = lambda x: np.where(is_first, np.asarray(x, dtype=object)[self.src], None) if n else []
        out["exit"], out["hops"], out["seg"] = put(self.exit), pd.array(put(self.hops), dtype="Int64"), put(self.seg)
        out["scc"], out["lead"] = (self.scc[self.src], self.exit[self.src]) if n else ([], [])
        out["n_parents"] = self.degree[self.src].astype(np.int32) if n else []
        more = []
        if self.exits:
            through = np.flatnonzero(np.isin(self.term, np.fromiter(self.exits, dtype=np.int64)))
            for v in through:
                more += [(self.names[v], x, self.exit[v]) for x in self.exits_of(int(v)) if x != self.exit[v]]
        if more:
            x = pd.DataFrame(more, columns=["s", "exit", "lead"]).assign(frag=np.int32(frag), o=None, primary=False, hops=None, seg=None, scc=None, n_parents=None)
            out = pd.concat([out, x[out.columns]], ignore_index=True)
        return out[[c.split()[0] for c in _CONTRACTED.split(", ")]]

    def between(self, x: str, y: str) -> set[int]:
        """Local nodes on a way from ``x`` out to ``y``."""
        at = int(self.names.get_indexer([x])[0])
        seen, stack = {at}, [at]
        while stack:
            v = stack.pop()
            lo = int(self.first[v])
            for t in self.dst[lo : lo + int(self.degree[v])]:
                if t >= 0 and int(t) not in seen:
                    seen.add(int(t))
                    stack.append(int(t))
        return {v for v in seen if y in self.exits_of(v)}


def _sccs(graph: dict[int, list[int]]) -> Iterator[list[int]]:
    """Strongly connected sets, each after those that it leads to."""
    index: dict[int, int] = {}
    low: dict[int, int] = {}
    on: set[int] = set()
    stack: list[int] = []
    for root in graph:
        if root in index:
            continue
        work = [(root, iter(graph[root]))]
        index[root] = low[root] = len(index)
        stack.append(root)
        on.add(root)
        while work:
            v, it = work[-1]
            for t in it:
                if t not in index:
                    index[t] = low[t] = len(index)
                    stack.append(t)
                    on.add(t)
                    work.append((t, iter(graph[t])))
                    break
                if t in on:
                    low[v] = min(low[v], index[t])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[v])
                if low[v] == index[v]:
                    scc = []
                    while True:
                        t = stack.pop()
                        on.discard(t)
                        scc.append(t)
                        if t == v:
                            break
                    yield scc


def _contract(edges: DataFrame, size: int, segments: bool, level: int) -> tuple[DataFrame, int]:
    """Fragment-wise contraction of edges (s, o, primary, lead, hops, seg), and
    how many edges there are."""

    def fragment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            yield _Fragment(pd.concat(parts, ignore_index=True), segments, level == 0).rows(TaskContext.get().partitionId())

    total = edges.count()
    n = max(1, -(-total // size))
    coin = lambda c: F.pmod(F.xxhash64(c, F.lit(level)), F.lit(2)) == 0
    joins = coin("s") & F.col("lead").isNotNull() & ~coin("lead")
    at = [F.col("s")] if level == 0 else [F.xxhash64(F.when(joins, F.col("lead")).otherwise(F.col("s"))), F.col("s")]
    cut = edges.repartition(1) if n == 1 else edges.repartitionByRange(n, *at)
    return materialize(cut.mapInPandas(fragment, _CONTRACTED), "fragments"), total


def _quotient(k: DataFrame) -> DataFrame:
    """(s, o, primary, lead, hops, seg) between nodes that other fragments lead to."""
    out = k.where("exit IS NOT NULL")
    entries = out.select(F.col("exit").alias("s")).distinct()
    q = out.join(entries, "s", "left_semi")
    return q.select("s", F.col("exit").alias("o"), "primary", "lead", F.coalesce("hops", F.lit(1)).alias("hops"), "seg")


def _solve(edges: DataFrame, size: int, segments: bool, level: int = 0) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(contracted edges, cycles (s, scc), solved quotient or None).

    The quotient holds nodes between fragments only and shrinks with every
    level; the last one fits a fragment. Should links be so many that it does
    not shrink (every node with many parents everywhere), fragments double.
    """
    k, total = _contract(edges, size, segments, level)
    local = k.where("scc IS NOT NULL").select("s", "scc").distinct()
    if total <= size:
        return k, local, None
    q = materialize(_quotient(k), "quotient")
    left = q.count()
    if left == 0:
        return k, local, None
    if level and left > 0.98 * total:
        size *= 2
    kq, rings, upper = _solve(q, size, segments, level + 1)
    solved = _paths(kq, upper) if segments else None
    return k, materialize(_expanded(k, local, kq, rings), "cycles"), solved


def _expanded(k: DataFrame, local: DataFrame, kq: DataFrame, rings: DataFrame) -> DataFrame:
    """(s, scc) of the fragments' nodes, from the cycles of their quotient.

    A link of the quotient lies on a cycle when both its ends are in one
    strongly connected set; then so do the nodes that it passes in its
    fragment. Only fragments with such links are contracted again.
    """
    ends = materialize(rings, "rings")
    link = kq.where("o IS NOT NULL").select("s", "o").join(ends, "s").join(ends.select(F.col("s").alias("o"), F.col("scc").alias("_of")), "o").where("scc = _of")
    where = k.where("o IS NOT NULL AND primary").select("frag", "s")
    todo = materialize(link.join(where, "s").select("frag", F.col("s").alias("x"), F.col("o").alias("y"), "scc").distinct(), "cycle-entries")

    def mark(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"s": [], "scc": []}, dtype=object)
        f = _Fragment(left.assign(hops=1, seg=None), False)
        hit: dict[int, str] = {}
        for x, y, scc in right[["x", "y", "scc"]].itertuples(index=False):
            hit |= dict.fromkeys(f.between(x, y), scc)
        return pd.DataFrame({"s": [f.names[v] for v in hit], "scc": list(hit.values())}, dtype=object)

    edges = k.where("o IS NOT NULL").join(todo.select("frag").distinct(), "frag", "left_semi").select("frag", "s", "o", "primary")
    more = materialize(edges.groupBy("frag").cogroup(todo.groupBy("frag")).applyInPandas(mark, "s string, scc string"), "on-cycles")
    return more.unionByName(local.join(more, "s", "left_anti"))


def _paths(k: DataFrame, upper: DataFrame | None) -> DataFrame:
    """(uri, root, depth, path, n_parents) of every child node; root, depth and
    path are NULL where the path runs into a cycle."""
    own = k.where("primary").select(F.col("s").alias("uri"), "exit", "hops", "seg", "n_parents")
    lost = materialize(own.where("exit IS NULL").select(F.col("uri").alias("exit")), "lost")
    own = own.join(lost.withColumn("_lost", F.lit(True)), "exit", "left").withColumn("exit", F.when(F.col("_lost").isNull(), F.col("exit"))).drop("_lost")
    if upper is None:
        out = own.withColumn("root", F.col("exit")).withColumn("up", F.col("exit")).withColumn("above", F.lit(0))
    else:
        u = upper.select(F.col("uri").alias("exit"), F.col("root").alias("_root"), F.col("depth").alias("above"), F.col("path").alias("_up"), F.lit(True).alias("_in"))
        j = own.join(u, "exit", "left")
        out = j.withColumn("root", F.when(F.col("_in"), F.col("_root")).otherwise(F.col("exit"))).withColumn("up", F.when(F.col("_in"), F.col("_up")).otherwise(F.col("exit"))).withColumn("above", F.coalesce("above", F.lit(0)))
    rooted = F.col("root").isNotNull()
    return out.select(
        "uri", "root",
        F.when(rooted, F.col("hops") + F.col("above")).alias("depth"),
        F.when(rooted, F.concat_ws(SEP, "up", "seg")).alias("path"),
        "n_parents",
    )


def _edges(pairs: DataFrame) -> DataFrame:
    e = pairs.where("s IS NOT NULL AND o IS NOT NULL").select("s", "o").distinct()
    return materialize(e, "edges").select("s", "o", F.lit(False).alias("primary"), F.lit(None).cast("string").alias("lead"), F.lit(1).cast("bigint").alias("hops"), F.col("s").alias("seg"))


def cyclic_nodes(pairs: DataFrame, fragment_edges: int = FRAGMENT_EDGES) -> DataFrame:
    """(uri): nodes of (s, o) that reach themselves in one or more steps.

    Nodes that only lead to a cycle, or lie between two, are none. Rows with a
    NULL end do not count, repeated rows count once, a row from a node to
    itself is a cycle, and an empty table has none.
    """
    return _solve(_edges(pairs), fragment_edges, segments=False)[1].select(F.col("s").alias("uri"))


def cycles(pairs: DataFrame, fragment_edges: int = FRAGMENT_EDGES) -> DataFrame:
    """(uri, cycle): nodes that reach themselves, and the name (one of its
    nodes) of the strongly connected set that each of them is in."""
    return _solve(_edges(pairs), fragment_edges, segments=False)[1].select(F.col("s").alias("uri"), F.col("scc").alias("cycle"))


def hierarchy(pairs: DataFrame, fragment_edges: int = FRAGMENT_EDGES) -> DataFrame:
    """(uri, root, depth, path, n_parents, in_cycle, cycle), one row for every
    URI in (s, o); ``path`` is an array from the root down to the URI, ``cycle``
    names the strongly connected set that it is in, if any.

    A node with several parents takes its path through the smallest of them;
    ``descendants`` follows them all. Root, depth and path are NULL where the
    path runs into a cycle. Roots have depth 0 and no parents. NULL ends,
    repeated rows and empty tables are treated as in ``cyclic_nodes``.
    """
    edges = _edges(pairs)
    k, rings, upper = _solve(edges, fragment_edges, segments=True)
    rings = materialize(rings, "rings").select(F.col("s").alias("uri"), F.col("scc").alias("cycle"))
    below = _paths(k, upper).join(rings, "uri", "left")
    below = below.select("uri", "root", "depth", F.split("path", SEP).alias("path"), "n_parents", F.col("cycle").isNotNull().alias("in_cycle"), "cycle")
    tops = edges.select(F.col("o").alias("uri")).distinct().join(edges.select(F.col("s").alias("uri")), "uri", "left_anti")
    tops = tops.select("uri", F.col("uri").alias("root"), F.lit(0).cast("bigint").alias("depth"), F.array("uri").alias("path"), F.lit(0).alias("n_parents"), F.lit(False).alias("in_cycle"), F.lit(None).cast("string").alias("cycle"))
    return below.unionByName(tops)


def descendants(pairs: DataFrame, fragment_edges: int = FRAGMENT_EDGES) -> DataFrame:
    """(uri, descendant): every pair of a node and one that lies below it in
    one or more steps, along all parents; nodes on a cycle lie below themselves.

    Pairs along paths come straight from the paths. Links that paths leave out
    (further parents, cycles) form a graph of their own: one leads to another
    whose child is above its parent; those inside one strongly connected set
    count as one, so that graph has no cycles. Over its closure, what is below
    the first link's child is paired with what is above the last one's parent,
    so only pairs that such links add are joined.
    """
    h = materialize(hierarchy(pairs, fragment_edges).select("uri", "path", "n_parents", "cycle"), "hierarchy")
    above = F.slice("path", 1, F.size("path") - 1)
    along = h.where("path IS NOT NULL").select(F.explode(above).alias("uri"), F.col("uri").alias("descendant"))
    special = h.where("n_parents > 1 OR path IS NULL").select(F.col("uri").alias("s"), "path", F.col("cycle").alias("_from"))
    extra = pairs.where("s IS NOT NULL AND o IS NOT NULL").join(special, "s").where("path IS NULL OR element_at(path, -2) <> o").select("s", "o", "_from").distinct()
    extra = extra.join(h.where("cycle IS NOT NULL").select(F.col("uri").alias("o"), F.col("cycle").alias("_to")), "o", "left")
    link = F.when(F.col("_from") == F.col("_to"), F.concat(F.lit(SEP), "_from")).otherwise(F.concat_ws(SEP, "s", "o"))
    extra = materialize(extra.select("s", "o", link.alias("link")), "extra-links")
    if extra.isEmpty():
        return along
    up = extra.join(h.select(F.col("uri").alias("o"), "path"), "o").select("link", F.explode(F.coalesce("path", F.array("o"))).alias("a"))
    up = materialize(up.distinct(), "above-links")
    leads = up.join(extra.select(F.col("s").alias("a"), F.col("link").alias("parent")), "a").select(F.col("link").alias("child"), "parent").where("child <> parent")
    chains = all_pairs(leads).select(F.col("node").alias("low"), F.col("root").alias("high"))
    chains = chains.unionByName(extra.select(F.col("link").alias("low"), F.col("link").alias("high"))).distinct()
    starts = extra.select("s", F.col("link").alias("low")).distinct()
    down = h.where("path IS NOT NULL").select(F.explode("path").alias("s"), F.col("uri").alias("d")).join(starts.select("s").distinct(), "s")
    down = down.unionByName(starts.select("s", F.col("s").alias("d"))).distinct().join(starts, "s").select("low", "d")
    new = down.join(chains, "low").join(up.withColumnRenamed("link", "high"), "high").select(F.col("a").alias("uri"), F.col("d").alias("descendant")).distinct()
    known = h.select(F.col("uri").alias("descendant"), above.alias("known"))
    new = new.join(known, "descendant").where(F.col("known").isNull() | ~F.array_contains("known", F.col("uri"))).select("uri", "descendant")
    return along.unionByName(new)
