"""Session and shared-storage helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("codexmill")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder loses data
    with its machine.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="codexmill-")
        spark.sparkContext.setCheckpointDir(at)
    return at


def scratch(spark: SparkSession, label: str) -> str:
    """A new path for a table or folder of this application, below the shared
    folder. ``release`` deletes them all; at the latest it is called when the
    driver ends."""
    global _at_exit
    if not _at_exit:
        _at_exit = True
        atexit.register(_release_active)
    return f"{shared_dir(spark).rstrip('/')}/codexmill/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


_at_exit = False


def release(spark: SparkSession) -> None:
    """Delete what this application has materialised. Call it once results are
    written: a DataFrame that is not may still read from there."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/codexmill/{spark.sparkContext.applicationId}")
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def _release_active() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        release(spark)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a compressed table into the shared folder and read it
    back: lineage ends here, the rows survive the loss of any executor, and
    later readers still prune columns and push filters down. See ``release``."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
