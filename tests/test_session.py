import os

from codexmill.session import materialize, release, scratch, shared_dir
from tests.conftest import rows


def test_intermediates_are_released(spark):
    df = materialize(spark.createDataFrame([(1, None), (2, "b")], "i int, s string"), "mine")
    assert rows(df) == [(1, None), (2, "b")]
    top = shared_dir(spark).removeprefix("file://").removeprefix("file:") + "/codexmill/" + spark.sparkContext.applicationId
    assert any(x.startswith("mine-") for x in os.listdir(top)) and scratch(spark, "mine") != scratch(spark, "mine")
    release(spark)
    assert not os.path.exists(top)
    assert rows(materialize(df.sparkSession.range(2).toDF("i"), "again")) == [(0,), (1,)]
