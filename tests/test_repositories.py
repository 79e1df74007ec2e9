from codexmill.operators import store
from codexmill.sources import repositories as R
from tests.conftest import rows


def test_links_paths_and_order(spark):
    repo = R.Repository("a", "http://x.example/{year}/dir{year}_{number}", "{yy}/{yy}{nnnn}.html", skip="bilaga")
    links = spark.createDataFrame([("Dir. 2006:02 om x", "u2"), ("2006:2", "u1"), ("2007:1", "bilaga1"), ("2007 / 3", "u3"), ("om", "u4"), (None, "u5")], "text string, url string")
    found = repo.found(links)
    assert rows(found) == [("a", "2006:2", "u1"), ("a", "2007:3", "u3")]
    assert [r["basefile"] for r in R.newest(found).collect()] == ["2007:3"]
    landed = found.where("basefile = '2006:2'")
    assert rows(R.unseen(found, landed).select("basefile")) == [("2007:3",)]
    got = repo.located(landed.select("basefile")).collect()[0]
    assert got["url"] == "http://x.example/2006/dir2006_2" and got["path"] == "a/06/060002.html"


def test_first_repository_wins(spark):
    df = lambda data: spark.createDataFrame(data, "basefile string, v int")
    got = R.first_of([("x", df([("1:1", 1)])), ("y", df([("1:1", 2), ("1:2", 3)]))])
    assert rows(got) == [("1:1", 1, "x"), ("1:2", 3, "y")]


def test_labels(spark):
    t = spark.createDataFrame([("g", "u2", "dct:alternate", "JB"), ("g", "u1", "dct:alternate", "JB"), ("g", "u3", "rdfs:label", "L")], "g string, s string, p string, o string")
    assert rows(store.labelled(t, "dct:alternate")) == [("JB", "u1")]
