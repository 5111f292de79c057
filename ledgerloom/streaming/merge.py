"""Folding a stream into the one-row-per-key table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.cdc import chosen_strategy, merge_changes, with_order
from ledgerloom.operators.dedupe import NEWEST_FIRST, dedupe_latest
from ledgerloom.sinks.snapshots import committed, drop_old_versions, stored_delta, update_snapshot, with_retries, write_snapshot


def stream_name(batch: DataFrame) -> str:
    """The query's lasting id; a lost checkpoint makes a new one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def merge_batch(
    base: str,
    prepare: Callable[[DataFrame], DataFrame],
    key: str = "nct_id",
    update_columns: Sequence[str] | None = None,
    order_by: str | None = "ingestion_ts",
    newest_first: Sequence[str] = NEWEST_FIRST,
    strategy: str = "auto",
    keep: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: newest copy per key, then upsert.

    A micro-batch is merged into the newest version, whoever wrote it, and its own version
    carries the stream's and the batch's name. If Spark runs a batch again, it starts from
    the version before its own and replaces that one, so its changes count once. Only
    buckets with changes are rewritten; if another writer was faster, the batch is merged into
    what that one has written. ``keep`` removes all but so many versions.
    ``prepare`` maps the raw batch to silver columns plus those of ``newest_first``.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        newest = dedupe_latest(prepare(batch), key, newest_first)
        if not begun(newest, stream_name(batch), batch_id):
            # read for its buckets and by the merge, so it is computed once and measured on disk
            with stored_delta(newest, key) as delta:
                how = chosen_strategy(strategy, delta)
                with_retries(lambda: merge_once(delta, stream_name(batch), batch_id, how))
        if keep is not None:
            drop_old_versions(batch.sparkSession, base, max(2, keep))

    def begun(newest: DataFrame, stream: str, batch_id: int) -> bool:
        """Whether the batch is the table's first version, which needs no merge."""
        if committed(newest.sparkSession, base):
            return False
        try:
            write_snapshot(newest, base, 1, key, stream=stream, batch=batch_id, dealt=True)
        except FileExistsError:
            return False
        return True

    def merge_once(delta: DataFrame, stream: str, batch_id: int, how: str) -> None:
        spark = delta.sparkSession
        known = committed(spark, base)
        own = [v for v in known if (v.stream, v.batch) == (stream, batch_id)]
        if own and own[-1] != known[-1]:
            return  # done, and others have gone on from it
        before = [v.number for v in known if not own or v.number < own[-1].number]
        version = own[-1].number if own else (before[-1] + 1 if before else 1)
        if not before:
            write_snapshot(delta, base, version, key, stream=stream, batch=batch_id)
            return
        update_snapshot(
            spark, base, before[-1], version, delta,
            lambda target, rows: merge_changes(*with_order(target, rows, order_by), key, update_columns, order_by, how),
            key, stream, batch_id, how == "shuffle",
        )

    return fold


def stream_merge(
    bronze: DataFrame,
    base: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    **options,
) -> StreamingQuery:
    """Starts a triggered run that merges all landed files into the table at ``base``."""
    return (
        bronze.writeStream.foreachBatch(merge_batch(base, prepare, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
