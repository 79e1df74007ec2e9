import datetime as dt
import random
from itertools import groupby

from pyspark.sql import functions as F

from codexmill.operators.history import coalesced, histories, version_history
from tests.conftest import rows

SCHEMA = "snapshot_id bigint, uri string, utfardandedatum date, konsolideringsunderlag array<string>, senasthamtad date, ingested_at timestamp, extra string, _blk int, day int"


def brute(data):
    latest = {}
    for i, uri, utf, kons, day, at, *_ in data:
        if uri is None or day is None:
            continue
        k = (uri, day)
        if k not in latest or ((at is not None, at), i) > latest[k][0]:
            latest[k] = (((at is not None, at), i), utf, None if kons is None else frozenset(x for x in kons if x is not None))
    out, state, last = [], {}, {}
    for uri, day in sorted(latest):
        _, utf, kons = latest[uri, day]
        old = state.get(uri, (None, None))
        new = (utf if utf is not None else old[0], kons if kons is not None else old[1])
        if uri not in state or new != old:
            if uri in last:
                out[last[uri]][2] = str(day)
            last[uri] = len(out)
            out.append([uri, str(day), "9999-12-31"])
        state[uri] = new
    return sorted(map(tuple, out))


def test_against_brute_force(spark):
    r = random.Random(7)
    data = []
    for i in range(700):
        uri = "hot" if r.random() < 0.4 else f"u{r.randrange(12)}"
        day = dt.date(2019, 1, 1) + dt.timedelta(days=r.choice([r.randrange(90), r.randrange(3000)]))
        utf = r.choice([None, dt.date(1990, 1, 1), dt.date(1991, 1, 1)])
        kons = r.choice([None, [], ["a"], ["a", "b"], ["b", "a", "a"], ["b", None]])
        row = (i, uri, utf, kons, day if r.random() > 0.05 else None, dt.datetime(2020, 1, 1) + dt.timedelta(hours=r.randrange(50)), "x", 1, 2)
        data += [row] * (2 if r.random() < 0.1 else 1)
    data.append((9999, None, None, None, dt.date(2020, 1, 1), dt.datetime(2020, 1, 1), None, None, None))
    got = version_history(spark.createDataFrame(data, SCHEMA)).select("uri", "valid_from", "valid_to")
    assert rows(got) == brute(data)


def test_values_carry_over(spark):
    d = dt.date
    at = dt.datetime(2020, 1, 1)
    data = [(1, "u", d(1990, 1, 1), None, d(2020, 1, 1), at), (2, "u", None, ["b", "a"], d(2020, 2, 1), at), (3, "u", None, None, d(2020, 3, 1), at), (4, "u", d(1990, 1, 1), ["a", "b"], d(2020, 4, 1), at)]
    got = rows(version_history(spark.createDataFrame(data, ", ".join(SCHEMA.split(", ")[:6]))))
    assert got == [("u", "2020-01-01", "2020-02-01", d(1990, 1, 1), None), ("u", "2020-02-01", "9999-12-31", d(1990, 1, 1), ["a", "b"])]


def test_empty_table(spark):
    assert version_history(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_are_maximal(spark):
    r = random.Random(3)
    data = [[(t, r.choice("ab")) for t in sorted(r.sample(range(20000), n))] for n in (0, 1, 2, 3, 7, 8, 9, 64, 301)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(data)], "i int, u array<struct<at:int,v:string>>")
    got = {x["i"]: [tuple(y) for y in x["r"]] for x in df.select("i", coalesced(F.col("u"), "string").alias("r")).collect()}
    for i, x in enumerate(data):
        runs = [list(g) for _, g in groupby(x, key=lambda p: p[1])]
        assert got[i] == [(g[0][0], g[-1][0], g[0][1]) for g in runs]


def test_blocks_do_not_change_versions(spark):
    r = random.Random(4)
    days = r.sample(range(-3000, 20000), 200)
    df = spark.createDataFrame([("e", t, r.choice(["a", "b", None]), r.choice([1, None])) for t in days], "entity string, day int, v string, k int")
    a, b, c = (rows(histories(df, {"v": "string", "k": "int"}, block_bits=k)) for k in (0, 6, 16))
    assert a == b == c and len(a) > 50
