import random
import re
import unicodedata

from codexmill.llm import dedup as D
from tests.conftest import rows

SCHEMA = "record_id bigint, subrepo string, basefile string, record string, fetched_at timestamp, pairs string"
NAMES = ["titel", "departement", "beslutad", "diarienr", "sidor"]


def norm(x):
    return re.sub(r"[^\w]|_", "", unicodedata.normalize("NFC", x)).lower()


def brute(data):
    first = {}
    out = []
    for i, _, base, rec, *_ in sorted((d for d in data if d[0] is not None), key=lambda d: d[0]):
        m = re.search(r"(\d+)\s*:\s*(\d+)", base or "")
        fields = []
        for part in re.split(r"[;|\r\n]", rec or ""):
            f = re.match(r"(?s)([^:=]*)[:=](.*)$", part)
            if f and norm(f[1]) and norm(f[2]):
                fields.append((norm(unicodedata.normalize("NFC", f[1])), norm(f[2])))
        key = ((int(m[1]), int(m[2])) if m else norm(base or ""), tuple(sorted(fields)))
        if key in first:
            if first[key] != i:
                out.append((first[key], i))
        else:
            first[key] = i
    return sorted(set(out))


def written(r, values):
    order = r.sample(range(5), 5)
    eq, sep = r.choice([":", "=", " : ", ": "]), r.choice([";", " | ", "\n", " ;\n"])
    case = r.choice([str.lower, str.upper, str.title, lambda x: x])
    form = r.choice(["NFC", "NFD"])
    return unicodedata.normalize(form, sep.join(case(NAMES[k]) + eq + r.choice(["", " ", '"']) + case(values[k]).replace(" ", r.choice([" ", "  ", "\xa0"])) + r.choice(["", ".", '"']) for k in order))


def test_against_brute_force(spark):
    r = random.Random(5)
    originals = [([f"Översyn {w} å", "Rätt", "1999-01-0" + str(k % 9), f"Ju{k}", str(k % 3)], f"{1990 + k % 4}:{k % 5 + 1}") for k, w in enumerate(["av lag", "av lag", "ä", "a", "é", "é", "om x"] * 3)]
    data = []
    for i in range(300):
        v, b = originals[0] if r.random() < 0.4 else r.choice(originals)
        y, n = b.split(":")
        base = r.choice([f"{y}:{n}", f"Dir. {y}:0{n}.", f" {y} : {n}", f"dir {y}:00{n}"])
        data.append((i, "s", base, written(r, v), None, "clash"))
    data += [(900, None, None, None, None, None), (901, None, None, None, None, None), (902, None, "x", "", None, None), (903, None, "X.", ";;|", None, None), (None, None, "1990:1", "a:b", None, None)]
    data += [(904, None, "1990:1", "titel: a; titel: a", None, None), (905, None, "1990:1", "titel: a", None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(D.copies(df)) == sorted(brute(data), key=lambda t: [(x is not None, str(x)) for x in t])
    n = {r["record_id"]: r["n_copies"] for r in D.collapsed(df).collect()}
    assert sum(n.values()) == len([d for d in data if d[0] is not None]) and n[904] == 1


def test_collisions_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(D, "fingerprinted", lambda rec, f=D.fingerprinted: f(rec).withColumn("fp_lo", F.lit(1).cast("bigint")).withColumn("fp_hi", F.lit(1).cast("bigint")))
    data = [(i, "s", f"1990:{i % 3}", "titel: a", None, None) for i in range(9)]
    assert rows(D.copies(spark.createDataFrame(data, SCHEMA))) == [(0, 3), (0, 6), (1, 4), (1, 7), (2, 5), (2, 8)]


def test_delivered_twice_and_empty(spark):
    df = spark.createDataFrame([(1, "s", "1990:1", "titel: a", None, None)] * 2, SCHEMA)
    assert rows(D.copies(df)) == [] and D.collapsed(df).count() == 1
    assert D.copies(df.limit(0)).count() == 0
