import pytest
from pyspark.sql import functions as F

from codexmill.llm import encoding as E
from tests.conftest import rows

WORDS = "förordning särskilda bestämmelser åtgärder rättegång före områden på från år även § hyresgäst sökanden tillämpas också gäller länsstyrelsen måste får Öster".split()
ODD = ["€-klausulen", "Ðorfjärden", "A|B-protokollet", "{bilaga", "São", "Ærø–Hålland", "”ålderdomliga”", "‰-regeln"]


def corpus(spark):
    out = []
    for i in range(400):
        t = " ".join(WORDS[(i * k) % len(WORDS)] for k in (1, 3, 7, 11)) + (" " + ODD[i % len(ODD)] if i % 4 == 0 else "") + " och den som inte har"
        out.append(("t", i, t, "x"))
    return out


@pytest.fixture(scope="module")
def restorer(spark):
    df = spark.createDataFrame(corpus(spark), "src_table string, row_id bigint, text string, extra string")
    return E.Restorer(*E.train(E.distinct_words(df)))


def misread(text, true, read):
    return "".join(E._tables()[1][read][b] for b in text.encode(true))


@pytest.mark.parametrize(("true", "read"), [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp850"), ("utf-8", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "mac_roman"), ("cp850", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "cp1251")])
def test_round_trip(restorer, true, read):
    text = "förordning på särskilda områden får tillämpas"
    got = restorer.restore(misread(text, true, read))
    assert got and got[0] == text and got[2] == "restored"


def test_twice_in_places_seven_bit_and_lost(restorer):
    text = "även före år gäller bestämmelser"
    assert restorer.restore(misread(misread(text, "utf-8", "cp1252"), "utf-8", "cp1252"))[0] == text
    assert restorer.restore("Åre: fÃ¶re år gäller")[0] == "Åre: före år gäller"
    assert restorer.restore("s{rskilda best{mmelser f|r")[0].startswith("särskilda bestämmelser")
    assert restorer.restore("f�re �r")[2] == "lost"
    assert restorer.restore("best?mmelser")[2] == "lost"


def test_clean_text_is_left_alone(restorer):
    for t in [*(w for w in WORDS + ODD), "hyra och {bilaga 2} vid A|B-protokollet", "", None, "plain ascii text? yes", "år " * 20000]:
        assert restorer.restore(t) is None, t


def test_tables_and_single_texts_agree(spark, restorer, monkeypatch):
    """Verdicts joined back, by broadcast or by shuffle, restore what word by
    word restores; control characters alone are damage."""
    bad = ["fÃ¶re år", misread("särskilda åtgärder", "cp1252", "cp850"), "best?mmelser", "A|B-protokollet", "tecken \x85 här", "f|re s{rskilda"]
    data = corpus(spark) + [("u", i, t, None) for i, t in enumerate(bad)]
    df = spark.createDataFrame(data, "src_table string, row_id bigint, text string, extra string")
    model = spark.createDataFrame(corpus(spark), "src_table string, row_id bigint, text string, extra string")
    want = [("u", i, *got) for i, t in enumerate(bad) if (got := restorer.restore(t))]
    assert len(want) == 5
    assert rows(E.restored(df, model)) == want
    monkeypatch.setattr(E, "BROADCAST_VERDICTS", 0)
    assert rows(E.restored(df, model)) == want and rows(E.found(df, model)) == [x[:2] for x in want]


def test_model_counts_every_gram_in_fixed_memory(spark):
    df = spark.createDataFrame([("a", 3, False), ("ab", 2, False)], "word string, n bigint, held boolean")
    m = E.Model(E._load(E._tally(df)))
    assert m._n("a") == 5 and m._n("ab") == 2 and m._n("b\x03") == 2 and m._n("zz") == 0 and m._n(E.TOTAL) == 12
    assert m.low.shape == m.high.shape == (E.SLOTS,)


def test_rows(spark):
    data = corpus(spark) + [("t", 1000, misread("särskilda åtgärder", "utf-8", "cp1252"), None)] * 2 + [("u", 1, None, None), (None, None, "", None)]
    df = spark.createDataFrame(data, "src_table string, row_id bigint, text string, extra string")
    assert rows(E.restored(df).select("src_table", "row_id", "restored", "status")) == [("t", 1000, "särskilda åtgärder", "restored")]
    assert rows(E.found(df)) == [("t", 1000)]
    assert E.restored(df.limit(0)).count() == 0
    assert E.restored(df.where(F.col("text").isNull())).count() == 0


def test_margin_comes_from_all_clean_words(spark):
    """Every clean word and each of its corrupted copies is judged once, however
    many there are; and not by what it counted itself."""
    made = [f"{a}{b}ö{c}{d}" for a in WORDS[:12] for b in "bdfg" for c in "klmn" for d in "aeiuy"] + [(odd := misread("förordningböka", "cp1252", "cp850"))] * 3
    words = E.distinct_words(spark.createDataFrame([(w,) for w in made], "text string")).where("n > 0")
    parts = [E._load(E._tally(words.where(F.col("held") == k))) for k in range(E.FOLDS)]
    got = {kind: [r for r in E.gains(words, parts).collect() if r["clean"] == kind] for kind in (True, False)}
    assert sum(r["n"] for r in got[True]) == len(set(made)) == 961
    assert sum(r["n"] for r in got[False]) == sum(len(list(E.corruptions(w))) for w in set(made))
    assert sum(r["n"] for r in got[False] if r["top"] > E.MARGINS[0]) > 0.9 * 10 * 960
    own = E.Model(E._together(parts)).best(odd)[0]
    assert max(r["top"] for r in got[True]) == E.gains(words.where(F.col("word") == odd), parts).where("clean").collect()[0]["top"] > own + 1
    assert E.validated_margin(words, parts) in E.MARGINS
