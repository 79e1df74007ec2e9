import os
import re
from collections import Counter

import pytest

from codexmill.plans import registry
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.SF), reason="needs the test tables")
QUERIES = {k: f for m in registry.modules() for k, f in m.QUERIES.items()}
ORACLE = {k: q for m in registry.modules() for k, q in m.ORACLE.items()}


@pytest.fixture(scope="module")
def con():
    return oracle.connection()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, con, name):
    oracle.compare(spark, con, QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, oracle.SF).count() > 0


def test_bare_numbers_in_documents_against_brute_force(spark, con):
    """Every number in a text is an act's, unless a name of something else
    stands before it. The smallest tables hold no bare numbers."""
    sf = os.path.join(os.path.dirname(oracle.SF), "sf0.01")
    want = Counter()
    for (text,) in con.execute(f"SELECT text FROM '{sf}/documents.parquet' WHERE text IS NOT NULL").fetchall():
        for m in re.finditer("[0-9]{4}:[0-9]+", text):
            word = re.split(r"[\s(]", text[: m.start()].rstrip(" "))[-1]
            want[m[0]] += word not in ("prop.", "Prop.", "SOU", "Ds", "dir.", "RÅ", "RH", "MD", "HFD", "AD", "NJA")
    got = QUERIES["citation_extract_all"](spark, sf).where("contains(uri, '/publ/sfs/')").collect()
    assert {r["uri"].rpartition("/")[2]: r["n"] for r in got} == dict(+want)
    before = QUERIES["citation_extract"](spark, sf).where("contains(uri, '/publ/sfs/')").groupBy().sum("n").collect()[0][0]
    assert sum(want.values()) > before


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["root", "uri", "label", "lagrum"]
    assert set(ORACLE) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["inbound_links", "case_refs", "p1_found", "p2_found", "annotation_join", "uri_parse", "structure_nodes"])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = QUERIES[name](spark, oracle.SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan and "Pandas" not in plan


def test_filters_reach_the_scan(spark):
    plan = QUERIES["top_cited"](spark, oracle.SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull" in plan and "EqualTo(p,dct:references)" in plan
