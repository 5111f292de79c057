"""The newest copy per key kept in state: a stream that puts out changes only.

The rank and the fingerprint of one copy per key are held in the state store (RocksDB); a copy that is newer, by the order of
``dedupe_latest``, and differs by its fingerprint is put out and takes its place, an older or
equal one is put out as late or as repeated. Deliveries may come in any order and be cut into
micro-batches in any way: the last change that is put out for a key is always its newest copy.

State grows with the keys, not with the rows; a key is kept as long as the stream's checkpoint.
Keys are held in ``STATE_BUCKETS`` buckets by their hash, so a batch asks the store once per
bucket and not several times per key. The number is part of the checkpoint.
"""

from __future__ import annotations

import contextlib
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerloom.operators.dedupe import NEWEST_FIRST

register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGE = "_change"
CHANGES = ("new", "changed", "repeated", "late")
STATE_BUCKETS = 1_024
# Rows of a bucket that are put in order of rank at once.
RUN_ROWS = 20_000


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession):
    """State in RocksDB, which the state operator needs, for streams that start in the block."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def _packed(held: dict[str, tuple[str, str | None]]) -> bytes:
    table = pa.table(
        {
            "key": pa.array(list(held), pa.large_string()),
            "rank": pa.array([rank for rank, _ in held.values()], pa.large_string()),
            "hash": pa.array([record_hash for _, record_hash in held.values()], pa.large_string()),
        }
    )
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(part: bytes) -> dict[str, tuple[str, str | None]]:
    table = pa.ipc.open_stream(part).read_all()
    keys, ranks, hashes = (column.to_pylist() for column in table.columns)
    return dict(zip(keys, zip(ranks, hashes)))


class _Newest(StatefulProcessor):
    """State of a bucket: the rank of the newest copy of each of its keys, as one comparable text,
    and its fingerprint. What a batch changes is added as a part; once the parts added hold as
    many entries as the first one, all are put together."""

    def __init__(self, columns: Sequence[str]) -> None:
        self.columns = list(columns)
        self.arriving = [*columns, "_rank", "_hash", "_key", "_bucket"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.parts = handle.getListState("newest_copies", "part binary, entries int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held, entries = {}, []
        for part, n in self.parts.get():
            held.update(_unpacked(bytes(part)))
            entries.append(n)
        fresh = {}
        for run in self._runs(rows):
            changes = []
            for name, rank, record_hash in zip(run["_key"], run["_rank"], run["_hash"]):
                before = held.get(name)
                if before is None:
                    change = "new"
                elif rank < before[0]:
                    change = "late"
                elif record_hash == before[1]:
                    change = "repeated"
                else:
                    change = "changed"
                if change != "late":
                    held[name] = fresh[name] = (rank, record_hash)
                changes.append(change)
            yield run[self.columns].assign(**{CHANGE: changes})
        if not fresh:
            return
        if entries and sum(entries[1:]) + len(fresh) < entries[0]:
            self.parts.appendValue((_packed(fresh), len(fresh)))
        else:
            self.parts.put([(_packed(held), len(held))])

    def _runs(self, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The bucket's rows in runs of about ``RUN_ROWS``, each in order of rank."""
        waiting, n = [], 0
        for part in rows:
            # names that begin with an underscore come as numbers
            part.columns = self.arriving
            waiting.append(part)
            n += len(part)
            if n >= RUN_ROWS:
                yield self._by_rank(waiting)
                waiting, n = [], 0
        if waiting:
            yield self._by_rank(waiting)

    @staticmethod
    def _by_rank(parts: list[pd.DataFrame]) -> pd.DataFrame:
        run = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        return run.sort_values("_rank", kind="stable")

    def close(self) -> None:
        pass


def rank_text(columns: Sequence[str]):
    """The columns as one text that sorts like them, NULL first."""
    parts = []
    for c in columns:
        value = F.col(c).cast("string")
        # times and dates sort as texts; the mark keeps NULL below every value
        parts.append(F.when(value.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), value)))
    return F.concat_ws("\x01", *parts)


def latest_changes(
    records: DataFrame,
    key: str = "nct_id",
    newest_first: Sequence[str] = NEWEST_FIRST,
    hash_column: str = "_record_hash",
) -> DataFrame:
    """Every record of a stream with what it is to the newest copy of its key (``_change``).

    Keep rows of ``new`` and ``changed`` to follow the table; ``late`` and ``repeated`` ones go
    to an output of their own or are left out. Records without a key are left out: they have
    no newest copy, and would all be one key.
    """
    columns = records.columns
    named = records.filter(F.col(key).isNotNull())
    ranked = named.withColumn("_rank", rank_text(newest_first)).withColumn("_hash", F.col(hash_column).cast("string"))
    ranked = ranked.withColumn("_key", F.col(key).cast("string")).withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(STATE_BUCKETS)).cast("int"))
    schema = T.StructType([*records.schema.fields, T.StructField(CHANGE, T.StringType())])
    return ranked.groupBy("_bucket").transformWithStateInPandas(_Newest(columns), schema, "append", "none")
