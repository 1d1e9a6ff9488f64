"""Session settings, and the shared folder where long lineages are cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet is compressed: a table counts for a broadcast by what its rows come to, not by the size of its files.
    # What turns out small enough when it is exchanged is still sent whole.
    "spark.sql.sources.fileCompressionFactor": "32",
    # So is what a task reads: narrow rows take 50 times their compressed bytes once a task groups or sorts them.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.session.timeZone": "UTC",
    # Lets the text readers decode legacy charsets such as ISO-8859-2.
    "spark.sql.legacy.javaCharsets": "true",
}

STAGING = "shelfmark.staging"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("shelfmark")
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
    } | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> None:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or one in the warehouse, which all executors share too."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, in the folder of the staging scope or else in the shared folder."""
    folder = spark.sparkContext.getLocalProperty(STAGING) or shared_folder(spark)
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any file system that Spark knows; one that is not there is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A scope whose staged files lie in one folder of the shared one and go with it, also after an error.

    What reads them must be written before the scope ends. Scopes nest. The folder is a local property of
    the thread, so threads started by ``inheritable_thread_target`` stage in it too and other jobs do not.
    """
    folder, outer = new_path(spark, "job"), spark.sparkContext.getLocalProperty(STAGING)
    spark.sparkContext.setLocalProperty(STAGING, folder)
    try:
        yield folder
    finally:
        spark.sparkContext.setLocalProperty(STAGING, outer)
        remove(spark, folder)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """A scope in which each query's shuffle files go when it ends; else they stay until the driver collects its garbage.

    A frame that is asked twice computes its exchanges again then.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back: no executor's loss can undo it.

    Unlike a checkpoint of rows, the written table is columnar, so later steps read only what they use.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
