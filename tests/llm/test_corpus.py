import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from codexmill.llm import mixing, packing, stuffing, tokens
from tests.conftest import rows

SCHEMA = "doc_id bigint, source string, text string, n_tokens bigint, curve string"


def texts():
    r = random.Random(9)
    words = "lagen om hyra ska prövas av nämnden enligt förordning rätt \n avtal 12 § (se 4 kap.)".split(" ")
    out = [" ".join(r.choice(words) for _ in range(int(r.expovariate(1 / 120)))) for _ in range(300)]
    return out + ["", None, "  two  spaces ", " x", "x ", "\t\n", "a\x00b", "ord " * 30000, out[0], out[0], out[0]]


def frame(spark, source=lambda i: "s"):
    return spark.createDataFrame([(i, source(i), t, 1, "c") for i, t in enumerate(texts())], SCHEMA)


def test_word_counts_equal_whole_counts():
    enc, n = tokens.encoder(), tokens.counter()
    for t in [*texts(), "foo\n bar", "foo \nbar", "a'll b's", "x y z", "1 2  3", "é́ ö"]:
        assert n(t) == (len(enc(t)) if t else 0)


def test_hilbert_is_a_curve():
    b = 3
    cells = np.array(np.meshgrid(*[np.arange(1 << b)] * 3, indexing="ij")).reshape(3, -1).T
    order = packing.hilbert(cells, b)
    assert sorted(order.tolist()) == list(range(1 << 3 * b))
    at = cells[np.argsort(order)]
    assert (np.abs(np.diff(at, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("window", [5, 1000])
def test_fit(window):
    sizes = np.array([random.Random(i).randrange(0, 101) for i in range(400)])
    at, n = packing.fit(sizes, 100, window)
    used = np.bincount(at, weights=sizes, minlength=n)
    assert used.max() <= 100 and len(used) == n
    if window > 400:
        assert n <= sizes.sum() / 100 * 1.1 + 1


def test_pack(spark):
    df = frame(spark)
    n = {i: tokens.counter()(t) for i, t in enumerate(texts())}
    got = packing.pack(df, {"small": 100, "large": 4000}).collect()
    for kind, cap in (("small", 100), ("large", 4000)):
        mine = [r for r in got if r["container_kind"] == kind]
        used = {}
        for r in mine:
            used[r["container_id"]] = used.get(r["container_id"], 0) + r["n_tokens"]
        assert max(used.values()) <= cap
        for i, size in n.items():
            pieces = sorted((r["token_start"], r["n_tokens"]) for r in mine if r["doc_id"] == i)
            assert sum(k for _, k in pieces) == size and len(pieces) == max(1, -(-size // cap))
            assert all(s == j * cap for j, (s, _) in enumerate(pieces))
        assert sum(used.values()) / (cap * len(used)) > 0.9
    assert packing.pack(df.limit(0), {"small": 100}).count() == 0
    with pytest.raises(ValueError, match="at least 1"):
        packing.pack(df, {"x": 0})


def test_neighbours_share_containers(spark):
    """Texts of one subject lie together on the curve and in containers."""
    r = random.Random(8)
    subjects = [[f"ord{k}x{j}" for j in range(30)] for k in range(12)]
    data = [(i, "s", " ".join(r.choices(subjects[i * 7 % 12], k=r.randrange(20, 60))), 0, "") for i in range(3000)]
    got = packing.report(spark.createDataFrame(data, SCHEMA), {"small": 1000, "large": 8000}).collect()
    for x in got:
        assert x["curve_span"] < 0.5 * x["random_span"] and x["fill"] > 0.95 and x["fullest"] <= x["capacity_tokens"]


def test_packer_keeps_a_window(spark):
    p = packing.Packer(100, 4)
    sizes = np.array([random.Random(i).randrange(0, 101) for i in range(5000)])
    at = []
    for lo in range(0, 5000, 37):
        at.append(p.add(sizes[lo : lo + 37]))
        assert p.tokens < 400 and sum(map(len, p.room.values())) <= 40
    at = np.concatenate([*at, p.rest()])
    used = np.bincount(at, weights=sizes, minlength=p.n)
    assert len(at) == 5000 and used.max() <= 100
    assert (at == packing.fit(sizes, 100, 4)[0]).all()


def test_copies_of_one_text_spread(spark):
    df = spark.createDataFrame([(i, "s", "samma text", 0, "") for i in range(2000)], SCHEMA).repartition(4)
    got = packing.pack(df, {"k": 50})
    assert got.select("doc_id").distinct().count() == 2000
    assert got.groupBy("container_id").agg(F.sum("n_tokens").alias("n")).where("n > 50").count() == 0


TARGETS = [("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.15, 3), ("gone", 0.05, 4)]


def mixed(spark, source, targets=TARGETS, **kw):
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    docs = frame(spark, source).where("text IS NULL OR length(text) < 50000")
    out, rep = mixing.mix(docs, t, **kw)
    return out.collect(), {r["source"]: r for r in rep.collect()}


def by(i):
    return "a" if i % 3 == 0 else "b" if i % 3 == 1 else "c" if i % 2 else None if i % 4 else "other"


def test_mix_meets_shares(spark):
    out, rep = mixed(spark, by)
    cap = {s: m for s, _, m in TARGETS}
    assert all(1 <= r["copies"] <= cap[r["source"]] for r in out) and len({r["doc_id"] for r in out}) == len(out)
    total = sum(r["copies"] * r["n_tokens"] for r in out)
    biggest = max(r["n_tokens"] for r in out)
    for s, share, _ in TARGETS[:3]:
        assert rep[s]["wanted_share"] == pytest.approx(share / 0.95)
        assert abs(rep[s]["mix_tokens"] - rep[s]["wanted_share"] * total) <= 100 < biggest
        assert rep[s]["actual_share"] == pytest.approx(rep[s]["mix_tokens"] / total)
    assert rep["gone"]["mix_tokens"] == 0 and rep["gone"]["documents"] == 0


@pytest.mark.parametrize("total", [20000.0, 100000.0])
def test_mix_with_a_text_longer_than_its_source_may_give(spark, total):
    """The long text stays out, shorter ones fill the share as far as they go;
    a source of nothing but the long text gives none and reports the shortfall."""
    alone = 307
    assert len(texts()[alone]) == 120000
    source = lambda i: "only" if i == alone + 1000 else by(i)
    docs = frame(spark, source).unionByName(spark.createDataFrame([(alone + 1000, "only", texts()[alone], 1, "c")], SCHEMA))
    rows_ = [("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.15, 3), ("only", 0.05, 4)]
    out, rep = mixing.mix(docs, spark.createDataFrame(rows_, "source string, target_share double, max_repeats int"), total)
    used, rep = {r["doc_id"] for r in out.collect()}, {r["source"]: r for r in rep.collect()}
    want, _ = mixing.plan([{"source": s, "target_share": p, "max_repeats": m} for s, p, m in rows_], {s: r["tokens"] for s, r in rep.items()}, total)
    long = rep["only"]["tokens"]
    assert long > max(want["b"], want["only"]) and not used & {alone, alone + 1000}
    assert rep["only"]["mix_tokens"] == 0 and rep["only"]["wanted_share"] == pytest.approx(0.05)
    for s in "abc":
        most = min(want[s], {x: m for x, _, m in rows_}[s] * (rep[s]["tokens"] - (long if s == "b" else 0)))
        assert most - 100 <= rep[s]["mix_tokens"] <= want[s]


def test_total_beyond_the_caps_gives_all(spark):
    out, rep = mixed(spark, by, total_tokens=1e9)
    assert all(r["copies"] == {s: m for s, _, m in TARGETS}[r["source"]] for r in out)


def test_scarce_source_does_not_shrink_the_mix(spark):
    scarce = lambda i: "c" if i == 2 else "a" if i % 2 else "b"
    out, rep = mixed(spark, scarce, total_tokens=mixing.AVAILABLE)
    have = {s: r["tokens"] for s, r in rep.items()}
    assert rep["c"]["documents"] == 1 and rep["c"]["mix_tokens"] == 3 * have["c"] and rep["c"]["actual_share"] < rep["c"]["wanted_share"] == pytest.approx(0.15 / 0.95)
    assert sum(r["mix_tokens"] for r in rep.values()) == pytest.approx(sum(have.values()), abs=200)
    assert rep["a"]["mix_tokens"] / rep["b"]["mix_tokens"] == pytest.approx(0.5 / 0.3, rel=0.02)


def test_rest_of_the_mix_is_filled_in_proportion():
    t = [{"source": s, "target_share": p, "max_repeats": m} for s, p, m in (("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.2, 3), ("gone", 0.5, 1))]
    want, share = mixing.plan(t, {"a": 900, "b": 90, "c": 10}, mixing.AVAILABLE)
    assert want == pytest.approx({"a": 880, "b": 90, "c": 30}) and share == pytest.approx({"a": 0.5, "b": 0.3, "c": 0.2})
    assert mixing.plan(t, {"a": 900, "b": 90, "c": 10}, 1e9)[0] == {"a": 1800, "b": 90, "c": 30}
    assert mixing.plan(t, {"a": 900, "b": 90, "c": 10})[0] == pytest.approx({"a": 75, "b": 45, "c": 30})
    assert mixing.plan(t, {}, mixing.AVAILABLE) == ({}, {})


def test_smaller_total_prefers_whole_numbers_of_copies(spark):
    out, rep = mixed(spark, by, total_tokens=20000.0)
    assert sum(r["mix_tokens"] for r in rep.values()) == pytest.approx(20000, abs=100)


def test_mix_without_documents(spark):
    out, rep = mixed(spark, lambda i: None)
    assert out == [] and all(r["actual_share"] == 0 for r in rep.values())


def test_newton_solves_the_dual(spark):
    hist = spark.createDataFrame([("s", t, 10) for t in (5, 50, 500)], "source string, n_tokens bigint, docs bigint")
    for want in (600.0, 5000.0, 7000.0, 16000.0):
        lam = mixing.tilt(hist, {"s": want}, {"s": 3}, {"s": 5550}, 100.0)["s"]
        got = sum(10 * t * min(3, np.exp(lam * t / 100)) for t in (5, 50, 500))
        assert got == pytest.approx(want, rel=1e-6)


PROSE = "Hyresgästen ska överlämna lägenheten senast den dag då avtalet upphör. Om det inte sker får hyresvärden begära ersättning för den tid som har gått.\n\nNämnden prövar frågan efter ansökan. Beslutet får överklagas till domstolen inom tre veckor."
STUFFED = {
    "keywords": "advokat Norrköping, billig jurist, skilsmässa, bodelning, juristbyrå, rättshjälp, testamente, bästa advokat, gratis jurist, köp avtal",
    "lines": "\n".join(f"advokat {x}stad" for x in ("Norr", "Söder", "Väster", "Öster", "Mellan", "Ny", "Gammel", "Stor", "Lill")),
    "tags": " ".join(f"#advokat{x}" for x in ("Norr", "Söder", "Billig", "Bäst", "Nära", "Jour", "Gratis", "Online")),
    "links": "\n".join(f"Avtal {i} http://www.exempel{i}.example/sida-om-avtal.html" for i in range(8)),
    "titled": "\n".join(f"Guide om hur man skriver ett avtal nummer {i}. https://www.exempel{i}.example/avtal-om-hyra/{i}" for i in range(6)),
    "anchors": " | ".join(f'<a href="http://exempel{i}.example/sida">Lag om avtal och hyra nummer {i}</a>' for i in range(6)),
    "items": "\n".join(f"<li><a href='http://exempel{i}.example/'>Mall för avtal om hyra</a></li>" for i in range(6)),
    "markdown": "\n".join(f"[Mall för avtal om hyra {i}](https://exempel.example/{i})" for i in range(6)),
    "hosts": " ".join(f"Guide om avtal och hyra (hyresjuridik{i}.example)" for i in range(6)),
    "shapes": "\n".join(" ".join(["Jurist"] * (i % 7) + ["billig"] * (i // 7 % 7 + 1)) + " ,;|/"[1 : 1 + i // 49 % 5] for i in range(300)),
    "products": " • ".join(f"Lagbok avtalsmall {100 + i} kr fri frakt" for i in range(8)),
    "phrase": " ".join(f"Om du letar efter jurist Norrstad så är det jurist Norrstad som du ska ha. Vi är jurist Norrstad och {x} är jurist Norrstad." for x in ("bäst", "nära", "billig")),
}
DECENT = {
    "prose": PROSE,
    "tagged": PROSE + "\n\nNyckelord: hyra, avtal, nämnd, uppsägning",
    "linked": PROSE + "\n\nhttp://www.exempel.example/a\nhttp://www.exempel.example/b",
    "sources": "\n\n".join(f"Nämnden prövar frågan efter ansökan. Underlaget finns på http://exempel{i}.example/u.html och en äldre version på http://www.exempel{i}.example/a." for i in range(8)),
    "marked up": "<p>" + PROSE.replace("Nämnden", '<a href="http://exempel.example/namnden">Nämnden</a>') + "</p>",
    "table": "Tabell. Avgiften är den som anges.\n\nNr | Slag | Belopp\n" + "\n".join(f"{i} | avgifter | {i}00" for i in range(1, 30)),
    "contents": "Innehåll\n" + "\n".join(f"{i}.1 Om avtal och avgifter ..... {i}0" for i in range(1, 15)),
    "register": "\n".join(f"SFS 19{i}:10\nRubrik: Lag om ändring i lagen om hyra\nOmfattning: ändr. {i} §\nIkraft: 19{i}-01-01" for i in range(60, 75)),
    "cases": "Rättsfall: " + "; ".join(f"NJA 19{i} s. {i}" for i in range(60, 80)),
    "formula": "\n\n".join(f"{i} § Den som bryter mot lagen döms för hyresbrott till böter eller fängelse i högst {i} år." for i in range(1, 9)),
    "short": "Upphävd.",
    "empty": "",
    "none": None,
}


def test_stuffed_pages(spark):
    names = [*STUFFED, *DECENT]
    df = spark.createDataFrame([(i, "s", (STUFFED | DECENT)[n], 0, "") for i, n in enumerate(names)], SCHEMA)
    assert {names[r[0]] for r in rows(stuffing.stuffed_pages(df).select("doc_id"))} == set(STUFFED)
    assert stuffing.stuffed_pages(df.limit(0)).count() == 0
    twice = df.unionByName(df)
    assert {names[r[0]] for r in rows(stuffing.stuffed_pages(twice).select("doc_id"))} == set(STUFFED)
    varied = " ".join(PROSE.replace("lägenheten", f"lägenhet {i}").replace("frågan", "fråga" + "abcdefghij"[i % 10]) for i in range(2000))
    long = spark.createDataFrame([(1, "s", varied, 0, ""), (2, "s", STUFFED["keywords"] * 3000, 0, "")], SCHEMA)
    assert [r[0] for r in rows(stuffing.stuffed_pages(long).select("doc_id"))] == [2]


def test_many_odd_shapes_are_still_odd(spark):
    """The verdict is on all shapes that are no sentences, however many; few
    equal ones only make the effective number small."""
    df = spark.createDataFrame([(1, "s", STUFFED["shapes"], 0, ""), (2, "s", STUFFED["items"], 0, "")], SCHEMA)
    got = {r["doc_id"]: r for r in stuffing.stuffed_pages(df).collect()}
    assert got[1]["share"] == 1.0 and got[1]["shapes"] > 40 and got[1]["effective"] > 12
    assert got[2]["effective"] == pytest.approx(1.0) and got[2]["kind"] == "links"
