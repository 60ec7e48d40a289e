"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_STAGED: list[str] = []  # staged by this driver and not deleted yet


def local_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and single-machine runs; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("parcelmatch")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The folder shared by all executors, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="parcelmatch-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return root.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the staging folder and read it back.

    Cuts the lineage on durable storage, so a lost executor re-reads files instead of
    recomputing, and values that depend on a sampled partitioning stay fixed.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def temporary_staging(spark: SparkSession) -> Iterator[None]:
    """Deletes what is staged inside the block at its end; results must be written before."""
    before = len(_STAGED)
    try:
        yield
    finally:
        for path in _STAGED[before:]:
            remove(spark, path)
        del _STAGED[before:]
