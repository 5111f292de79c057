"""A table as numbered snapshots in a folder, rewritten by key buckets.

Parquet cannot be updated in place and must not be overwritten while it is read. Rows are
kept in folders by a hash of their key (``data/<write>/bucket=K``), and a version is a small
table of which folder holds each bucket. A merge writes the buckets that its delta touches
and a new version that names the others where they are; their files stay as they are. A
version counts once Spark has committed it (its ``_SUCCESS`` marker), so a lost job leaves
the table as it was.

A number is claimed before its version is written, so of several writers that started from
the same version one goes on and the others fail with ``FileExistsError``; they start again
from the newest version (``with_retries``). A version written for a micro-batch carries the
stream's and the batch's name; only a repeat of that batch replaces it. A claim that led to no
version is given up after ``STALE_SECONDS``.

Buckets follow the hash that Spark deals rows by, so rows that come from a shuffle by the key
(``dealt``) are written where they are; tables of before keep the hash they were dealt by.

There are as many buckets as the table's bytes ask for (``BUCKET_BYTES`` each, ``LEAST_BUCKETS``
at least), so the tasks of a load grow with the table; when buckets have grown to twice that,
the next merge deals the whole table anew, with room to grow. Where a table format with
row-level MERGE is at hand, use ``merge_into_table``.
"""

from __future__ import annotations

import contextlib
import math
import re
import time
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from py4j.protocol import Py4JJavaError

from ledgerloom.operators.cdc import _taken
from ledgerloom.operators.sizing import measured_bytes
from ledgerloom.session import stored, write_table

BUCKET_BYTES = 256 << 20
LEAST_BUCKETS = 64
# Stored bytes of table and delta that one job of a merge pairs; its shuffles go before the next.
MERGE_BYTES = 2 << 30
# A delta may be stored in folders by this many parts of its key's hash, so a job reads its own only.
SLICES, SLICE = 8, "_slice"
# Plans without statistics claim to be about this large.
_UNKNOWN_BYTES = 1 << 60
STALE_SECONDS = 3_600
MANIFEST = "bucket int, path string, schema string, hashed string"
_FOLDER = re.compile(r"version=(\d+)(?:\.([\w-]+)\.(\d+))?/")


class Version(NamedTuple):
    number: int
    stream: str | None
    batch: int | None
    path: str


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def committed(spark: SparkSession, base: str) -> list[Version]:
    """Committed versions, oldest first."""
    files, pattern = _file_system(spark, f"{base}/version=*/_SUCCESS")
    found = []
    for status in files.globStatus(pattern) or []:
        path = status.getPath().toString()
        number, stream, batch = _FOLDER.search(path).groups()
        found.append(Version(int(number), stream, None if batch is None else int(batch), path.removesuffix("/_SUCCESS")))
    return sorted(found, key=lambda v: v.number)


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed snapshot numbers, oldest first."""
    return [v.number for v in committed(spark, base)]


def _manifest(spark: SparkSession, path: str) -> tuple[dict[int, str | None], str, str]:
    """The folder of every bucket, None for one without rows, the table's schema and the hash of its buckets."""
    rows = spark.read.schema(MANIFEST).parquet(path).collect()  # one per bucket
    return {r["bucket"]: r["path"] for r in rows}, rows[0]["schema"], rows[0]["hashed"] or "xxhash64"


def bucket_of(key: str, buckets: int, hashed: str = "hash") -> Column:
    return F.pmod(F.call_function(hashed, F.col(key)), F.lit(buckets)).cast("int")


def read_snapshot(spark: SparkSession, base: str, version: int | None = None, touched: Sequence[int] | None = None) -> DataFrame | None:
    """The given or the newest snapshot, or some of its buckets; None if there is none yet."""
    known = {v.number: v for v in committed(spark, base)}
    if not known:
        return None
    path = known[max(known) if version is None else version].path
    folders, schema, _ = _manifest(spark, path)
    wanted = [folders[b] for b in (folders if touched is None else touched) if folders[b]]
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*wanted)


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _write_buckets(df: DataFrame, base: str, key: str | None, buckets: int, hashed: str = "hash", dealt: bool = False) -> dict[int, str]:
    """Rows by bucket under a folder of their own; gives the folders that were written."""
    spark, root = df.sparkSession, f"{base}/data/{uuid.uuid4().hex}"
    if key is None:
        write_table(df, f"{root}/bucket=0")
        return {0: f"{root}/bucket=0"}
    placed = df.withColumn("bucket", bucket_of(key, buckets, hashed))
    # a bucket then lies within one task of the shuffle by key
    if not (dealt and hashed == "hash" and buckets % _shuffle_partitions(spark) == 0):
        # few buckets need no more tasks than the session's
        placed = placed.repartition("bucket") if buckets <= LEAST_BUCKETS else placed.repartition(buckets, "bucket")
    write_table(placed, root, partition_by=["bucket"])
    files, pattern = _file_system(spark, f"{root}/bucket=*")
    names = [s.getPath().getName() for s in files.globStatus(pattern) or []]
    return {int(n.removeprefix("bucket=")): f"{root}/{n}" for n in names}


def _claim(spark: SparkSession, base: str, version: int, owner: str) -> None:
    """Takes the number, or fails if another writer has it."""
    files, path = _file_system(spark, f"{base}/claims/{version:09d}")
    try:
        out = files.create(path, False)
    except Py4JJavaError:
        if not files.exists(path):
            raise
        age = time.time() - files.getFileStatus(path).getModificationTime() / 1000
        taken = version in versions(spark, base)
        into = files.open(path)
        holder = bytes(into.readAllBytes()).decode()
        into.close()
        if holder != owner and (taken or age < STALE_SECONDS):
            raise FileExistsError(f"version {version} of {base} is taken") from None
        out = files.create(path, True)
    out.write(bytearray(owner.encode()))
    out.close()


def _publish(df: DataFrame, base: str, version: int, folders: dict[int, str | None], hashed: str, stream: str | None, batch: int | None, parent: int | None) -> None:
    spark = df.sparkSession
    schema = df._jdf.schema().toDDL()
    rows = spark.createDataFrame([(b, p, schema, hashed) for b, p in sorted(folders.items())], MANIFEST)
    name = f"version={version:09d}" + (f".{stream}.{batch}" if stream is not None else "")
    _claim(spark, base, version, uuid.uuid4().hex if stream is None else f"{stream}.{batch}")
    newer = [v.number for v in committed(spark, base) if v.number > (parent or 0) and (stream is None or (v.stream, v.batch) != (stream, batch))]
    if newer:
        raise FileExistsError(f"version {newer[0]} of {base} came after version {parent}")
    # a repeat of the same micro-batch replaces its own version only
    rows.coalesce(1).write.mode("errorifexists" if stream is None else "overwrite").parquet(f"{base}/{name}")


def with_retries(write: Callable[[], None], times: int = 5) -> None:
    """Runs a write that starts from the newest version; again if another writer was faster."""
    for left in range(times - 1, -1, -1):
        try:
            return write()
        except FileExistsError:
            if not left:
                raise


def buckets_for(size: float, parts: int = 1) -> int:
    """``parts``: tasks of the shuffle that the rows come from; each then fills whole buckets,
    unless that would take far more of them."""
    wanted = max(LEAST_BUCKETS, -(-int(size) // BUCKET_BYTES))
    even = -(-wanted // parts) * parts
    return even if even <= 4 * wanted else wanted


def expected_bytes(df: DataFrame) -> int:
    """What Catalyst knows of the rows' bytes; they are counted only where it knows nothing."""
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return known if known < _UNKNOWN_BYTES else measured_bytes(df)


def stored_bytes(spark: SparkSession, folders: Sequence[str]) -> int:
    """Bytes of the files in the folders."""
    total = 0
    for folder in folders:
        files, path = _file_system(spark, folder)
        total += files.getContentSummary(path).getLength()
    return total


def write_snapshot(df: DataFrame, base: str, version: int, key: str | None = None, buckets: int | None = None, stream: str | None = None, batch: int | None = None, parent: int | None = None, dealt: bool = False) -> None:
    """Writes a whole snapshot, by buckets of ``key`` if one is given.

    ``parent``: the version it was made from. ``dealt``: the rows come from a shuffle by the key
    alone, as those of ``dedupe_latest`` do; they are not dealt again.
    """
    if buckets is None:
        buckets = buckets_for(expected_bytes(df), _shuffle_partitions(df.sparkSession) if dealt else 1) if key else 1
    folders: dict[int, str | None] = dict.fromkeys(range(buckets if key else 1))
    folders.update(_write_buckets(df, base, key, buckets, dealt=dealt))
    _publish(df, base, version, folders, "hash", stream, batch, version - 1 if parent is None else parent)


@contextlib.contextmanager
def stored_delta(newest: DataFrame, key: str):
    """A delta stored for the time of its merge, in slices that ``update_snapshot`` can take one by one."""
    with stored(newest.withColumn(SLICE, bucket_of(key, SLICES)), "delta", [SLICE]) as delta:
        yield delta


def _rounds(buckets: int, touched: list[int], folders: dict[int, str | None], delta: DataFrame, hashed: str) -> list[tuple[list[int], DataFrame]]:
    """The touched buckets and their delta, in rounds of about ``MERGE_BYTES`` where the delta is stored in slices."""
    spark = delta.sparkSession
    if SLICE not in delta.columns:
        return [(touched, delta)]
    most = math.gcd(buckets, SLICES) if hashed == "hash" else 1
    size = stored_bytes(spark, [folders[b] for b in touched if folders[b]]) + stored_bytes(spark, delta.inputFiles())
    n = min(most, max(1, -(-size // MERGE_BYTES)))
    # a bucket's rows lie in the slices that leave the same rest
    rounds = []
    for i in range(n):
        own = {c for c in range(most) if c % n == i}
        mine = [b for b in touched if b % most in own]
        if mine:
            rounds.append((mine, delta.filter(F.col(SLICE).isin([s for s in range(SLICES) if s % most in own])).drop(SLICE)))
    return rounds or [(touched, delta.drop(SLICE))]


def update_snapshot(spark: SparkSession, base: str, from_version: int, version: int, delta: DataFrame, merge, key: str, stream: str | None = None, batch: int | None = None, dealt: bool = False) -> None:
    """Writes ``version``: ``merge(target, delta)`` in the buckets that ``delta`` touches.

    All other buckets are taken over from ``from_version`` without being read. ``delta`` is
    stored rows: it is read for its buckets and for the merge. ``dealt``: the merge leaves its rows
    as a shuffle by the key dealt them.
    """
    path = {v.number: v for v in committed(spark, base)}[from_version].path
    folders, _, hashed = _manifest(spark, path)
    size = stored_bytes(spark, [f for f in folders.values() if f])
    # a table that was written without a key, or has outgrown its buckets
    if len(folders) == 1 or size > 2 * BUCKET_BYTES * len(folders):
        buckets = buckets_for(2 * size, _shuffle_partitions(spark) if dealt else 1)
        write_snapshot(merge(read_snapshot(spark, base, from_version), delta.drop(SLICE)), base, version, key, buckets, stream, batch, from_version, dealt)
        return
    rows = delta.select(bucket_of(key, len(folders), hashed).alias("bucket")).distinct().collect()  # at most one per bucket
    touched = sorted(r["bucket"] for r in rows)
    for own, part in _rounds(len(folders), touched, folders, delta, hashed):
        merged = merge(read_snapshot(spark, base, from_version, own), part)
        # a merge may leave nothing in a bucket
        folders.update({**dict.fromkeys(own), **_write_buckets(merged, base, key, len(folders), hashed, dealt)})
    _publish(merged, base, version, folders, hashed, stream, batch, from_version)


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Removes all but the newest ``keep`` versions, and data that no kept version names.

    For a time without writers: data of a version that isn't committed yet is named by none.
    """
    known = committed(spark, base)
    used = {p for v in known[-keep:] for p in _manifest(spark, v.path)[0].values() if p}
    files, pattern = _file_system(spark, f"{base}/data/*/bucket=*")
    names = {re.search(r"data/.*$", p)[0] for p in used}
    gone = [s.getPath() for s in files.globStatus(pattern) or [] if re.search(r"data/.*$", s.getPath().toString())[0] not in names]
    for v in known[:-keep]:
        files.delete(_file_system(spark, v.path)[1], True)
    for path in gone:
        files.delete(path, True)
    return len(gone)


def merge_into_table(
    delta: DataFrame,
    table: str,
    key: str = "nct_id",
    update_columns: Sequence[str] | None = None,
    order_by: str | None = None,
) -> None:
    """The same upsert as MERGE, for catalogs whose tables support it."""
    taken = _taken(delta.columns, key, update_columns)
    assignments = {c: F.col(f"incoming.{c}") for c in sorted(taken)}
    assignments["_update_count"] = F.col(f"{table}._update_count") + 1
    changed = f"{table}._record_hash <> incoming._record_hash"
    if order_by is not None:
        assignments[order_by] = F.col(f"incoming.{order_by}")
        changed += f" and ({table}.{order_by} is null or incoming.{order_by} >= {table}.{order_by})"
    (
        delta.alias("incoming")
        .mergeInto(table, F.expr(f"{table}.{key} = incoming.{key}"))
        .whenMatched(F.expr(changed))
        .update(assignments)
        .whenNotMatched()
        .insertAll()
        .merge()
    )
