import random

import pytest

from codexmill.operators import hierarchy as H
from tests.conftest import rows


def brute(edges):
    e = {(s, o) for s, o in edges if s is not None and o is not None}
    above = {}
    for s, _ in e:
        seen, stack = set(), [s]
        while stack:
            v = stack.pop()
            for a, b in e:
                if a == v and b not in seen:
                    seen.add(b)
                    stack.append(b)
        above[s] = seen
    return e, above


def brute_paths(e):
    parent = {}
    for s, o in e:
        parent[s] = min(o, parent.get(s, o))
    out = {}
    for v in {x for p in e for x in p}:
        path, at = [v], v
        while at in parent and len(path) <= len(parent) + 1:
            at = parent[at]
            path.append(at)
        out[v] = None if at in parent else path[::-1]
    return out


def random_edges(seed, n, extra, back):
    r = random.Random(seed)
    names = [f"n{r.randrange(10**6):06d}" for _ in range(n)]
    e = [(names[i], names[r.randrange(max(0, i - 6), i)]) for i in range(1, n) if r.random() < 0.9]
    e += [(names[i], names[r.randrange(i)]) for i in r.sample(range(1, n), extra)]
    e += [(names[i], names[r.randrange(i, n)]) for i in r.sample(range(n), back)]
    return e + e[:5] + [(None, names[0]), (names[0], None)]


@pytest.mark.parametrize(("seed", "extra", "back", "size"), [(1, 0, 0, 12), (2, 5, 3, 12), (3, 8, 6, 9), (4, 0, 4, 10), (5, 6, 6, 1000)])
def test_against_brute_force(spark, seed, extra, back, size):
    edges = random_edges(seed, 70, extra, back)
    df = spark.createDataFrame(edges, "s string, o string")
    e, above = brute(edges)
    assert {r[0] for r in rows(H.cyclic_nodes(df, size))} == {s for s in above if s in above[s]}
    want = brute_paths(e)
    got = {r["uri"]: r for r in H.hierarchy(df, size).collect()}
    assert {k: v["path"] for k, v in got.items()} == want
    assert all(r["depth"] == len(r["path"]) - 1 and r["root"] == r["path"][0] for r in got.values() if r["path"])


def test_descendants_follow_all_parents(spark):
    edges = random_edges(6, 40, 5, 3)
    e, above = brute(edges)
    got = rows(H.descendants(spark.createDataFrame(edges, "s string, o string"), 9))
    assert got == sorted((a, s) for s in above for a in above[s])


def test_long_chain_self_loop_and_two_cycle(spark):
    edges = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(300)] + [("x", "x"), ("a", "b"), ("b", "a"), ("z", "a")]
    df = spark.createDataFrame(edges, "s string, o string")
    assert [r[0] for r in rows(H.cyclic_nodes(df, 40))] == ["a", "b", "x"]
    got = {r["uri"]: r for r in H.hierarchy(df, 40).collect()}
    assert got["c0000"]["depth"] == 300 and got["c0000"]["root"] == "c0300"
    assert got["z"]["root"] is None and not got["z"]["in_cycle"] and got["x"]["in_cycle"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "s string, o string")
    assert H.cyclic_nodes(df).count() == 0 and H.hierarchy(df).count() == 0 and H.descendants(df).count() == 0


def test_cycles_are_told_apart(spark):
    edges = random_edges(2, 60, 5, 4) + [("n0", "n1"), ("n1", "n0"), ("n1", "q"), ("q", "r"), ("r", "q")]
    _, above = brute(edges)
    got = dict(rows(H.cycles(spark.createDataFrame(edges, "s string, o string"), 12)))
    assert set(got) == {s for s in above if s in above[s]}
    for v in got:
        same = {w for w in got if w in above[v] and v in above[w]}
        assert got[v] in same and {w for w in got if got[w] == got[v]} == same


def test_names_without_any_locality(spark):
    """A long chain and a long cycle whose names are in no order: fragments
    keep their size and the quotient still shrinks."""
    r = random.Random(5)
    names = [f"{x:06d}" for x in r.sample(range(10**6), 700)]
    edges = list(zip(names[:400], names[1:401], strict=True)) + list(zip(names[401:], names[402:] + names[401:402], strict=True))
    df = spark.createDataFrame(edges, "s string, o string")
    assert {x[0] for x in rows(H.cyclic_nodes(df, 150))} == set(names[401:])
    got = {x["uri"]: x for x in H.hierarchy(df, 150).collect()}
    assert got[names[0]]["path"] == names[400::-1] and got[names[500]]["path"] is None and got[names[500]]["in_cycle"]
