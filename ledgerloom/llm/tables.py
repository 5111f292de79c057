"""The given tables, and small checks that the operators share."""

from __future__ import annotations

import contextlib
import pickle

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.sizing import fits_broadcast
from ledgerloom.session import written

# Largest side that the driver gathers for a broadcast.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for a broadcast if it is measured to be small, else as it is."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def without_texts(docs: DataFrame, bad: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: str = "left_anti") -> DataFrame:
    """``docs`` without the rows of an id and text of ``bad`` (id, text_hash), all columns kept;
    those rows alone if ``how`` is ``left_semi``."""
    taken = {c.lower() for c in docs.columns}
    free = [next(n for n in (f"{'_' * k}{name}" for k in range(len(taken) + 1)) if n not in taken) for name in ("bad_id", "bad_hash")]
    bad = written(bad.select(F.col("id").alias(free[0]), F.col("text_hash").alias(free[1])).distinct(), "dropped")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(free[0])) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(free[1]))
    return docs.join(small(bad), same, how)


def first_of_each(df: DataFrame, by: str, most: int, *order: str) -> DataFrame:
    """At most ``most`` rows of each value of ``by``, by a hash of ``order``.

    What goes to the task of a value is cut down to about twice that before, however many
    rows the value has.
    """
    counts = small(df.groupBy(by).agg(F.count(F.lit(1)).alias("rows")))
    hashed = df.withColumn("hash", F.xxhash64(*order)).join(counts, by)
    place = F.pmod("hash", F.lit(1 << 30))
    within = place < F.lit(2.0 * most + 64) / F.col("rows") * (1 << 30)
    by_hash = Window.partitionBy(by).orderBy(place, "hash", *order)
    return hashed.filter(within).withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= most).select(df.columns)


def tasks_for(df: DataFrame, amount: int, each: int) -> int:
    """Number of partitions of about ``each`` units, as many as the session has at least."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-amount // each))


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def text_batches(spark: SparkSession, most: int = 8 << 20):
    """Smaller Arrow batches for what runs within the block: rows that hold whole texts."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(most))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


class Shared:
    """An object that every task can read; its class travels with it."""

    def __init__(self, spark: SparkSession, value):
        self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self.held.value)
