"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Stored tables are read a few times and hold texts: less disk is worth the seconds.
COMPRESSION = "zstd"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as the session names it.

    Only a local session may go without the setting; it gets a fresh folder.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/ledgerloom/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of what runs in the block go when it ends, not when the driver's heap is next collected.

    For writes: nothing reads their shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def write_table(df, path: str, mode: str = "errorifexists", partition_by=()) -> None:
    """Writes a folder of files, compressed, and leaves no shuffle behind."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode(mode).option("compression", COMPRESSION).parquet(path, partitionBy=list(partition_by) or None)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def stored(df, name: str, partition_by=()):
    """``written`` for the time of a block; the table is removed after it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_table(df, path, partition_by=partition_by)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def written(df, name: str):
    """The rows of ``df`` as a table in the shared folder; cuts the lineage there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)
