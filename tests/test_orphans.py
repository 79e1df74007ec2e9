import datetime as dt
import random

from codexmill.operators.orphans import find_orphans
from tests.conftest import rows

REFS = "id bigint, domain string, key string, at timestamp_ntz, month int"
PARENTS = "domain string, key string, live_from timestamp_ntz, live_to timestamp_ntz, code int, note string"


def brute(refs, parents):
    out = []
    for i, dom, key, at, _ in refs:
        if key is None:
            continue
        live = any(d == dom and k == key and a is not None and at is not None and a <= at and (b is None or at < b) for d, k, a, b, *_ in parents)
        if not live:
            out.append(i)
    return sorted(out)


def when(r):
    t = dt.datetime(2020, 1, 1) + dt.timedelta(days=r.randrange(200))
    return r.choice([t, t.replace(day=1), t + dt.timedelta(seconds=r.randrange(86400), microseconds=r.randrange(10**6))])


def test_against_brute_force(spark):
    r = random.Random(11)
    keys = [f"k{i}" for i in range(150)] + [None]
    parents = []
    for _ in range(400):
        a = when(r) if r.random() > 0.03 else None
        b = None if r.random() < 0.4 else when(r) if a is None or r.random() < 0.2 else a + dt.timedelta(days=r.choice([0, 1, 29, 31, 60]))
        row = (r.choice("de"), "hot" if r.random() < 0.3 else r.choice(keys), a, b, 1, "n")
        parents += [row] * r.choice([1, 1, 2])
    refs = [(i, r.choice("de"), "hot" if r.random() < 0.3 else r.choice(keys), when(r) if r.random() > 0.03 else None, 5) for i in range(900)]
    starts = [a for _, _, a, _, *_ in parents if a] + [b for _, _, _, b, *_ in parents if b]
    refs += [(1000 + i, "d", "hot", t, 5) for i, t in enumerate(starts[:80])]
    for n in (3, 512):
        got = find_orphans(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS), n_buckets=n)
        assert [x[0] for x in sorted(rows(got.select("id")))] == brute(refs, parents)


def test_repeated_rows_stay_and_empty_tables(spark):
    t = dt.datetime(2020, 5, 5)
    refs = spark.createDataFrame([(1, "d", "x", t, 0)] * 2, REFS)
    none = spark.createDataFrame([], PARENTS)
    assert find_orphans(refs, none).count() == 2
    assert find_orphans(refs.limit(0), none).count() == 0


def test_two_intervals_that_touch_cover_a_month(spark):
    a, b, c = dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 10, 3), dt.datetime(2020, 4, 1)
    parents = spark.createDataFrame([("d", "x", a, b, 0, ""), ("d", "x", b, c, 0, "")], PARENTS)
    refs = spark.createDataFrame([(1, "d", "x", b, 0), (2, "d", "x", b - dt.timedelta(microseconds=1), 0), (3, "d", "x", c, 0)], REFS)
    assert [x[0] for x in rows(find_orphans(refs, parents).select("id"))] == [3]
