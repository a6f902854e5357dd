"""Session helper and the shared folder used for written tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "quillframe", cpus: str = "8", memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks; on a cluster the submitter sets these."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only where ``spark.checkpoint.dir`` is unset (tests) is a folder made and
    put into the session, so that later calls find the same one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="quillframe-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/quillframe/{label}-{uuid.uuid4().hex}"


def fresh_name(label: str) -> str:
    """A catalog name that no other call uses."""
    return f"{label}_{uuid.uuid4().hex}"


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """A frame that is read several times inside the block and let go after it."""
    df = df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


#: Bytes of rows that a Python worker gets at a time within ``small_batches``.
BATCH_BYTES = 8 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """Rows that are computed inside the block go to Python workers in small batches.

    A batch of Spark's own size, of long texts, is held several times over: by Spark on both ways, and by the worker as words.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and return the written table."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
