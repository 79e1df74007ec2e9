import os

import pytest

from codexmill.llm import queries
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.SF), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    oracle.compare(spark, oracle.connection(), queries.QUERIES[name], queries.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, oracle.SF).count() > 0


def test_registered_mix_is_as_large_as_the_corpus(spark):
    rep = queries.p7_report(spark, oracle.SF).where("wanted_share > 0").collect()
    have = sum(r["tokens"] for r in rep)
    assert sum(r["mix_tokens"] for r in rep) == pytest.approx(have, rel=0.01)
    for r in rep:
        assert r["actual_share"] > r["wanted_share"] - 0.01 or r["mix_tokens"] == r["max_repeats"] * r["tokens"]


def test_core_imports_nothing_from_here():
    import pathlib

    core = pathlib.Path(queries.__file__).parents[1]
    assert not [p for p in core.rglob("*.py") if "llm" not in p.parts[-2:] and "codexmill.llm" in p.read_text()]
