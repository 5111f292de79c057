"""Clean records from a stream, and the runs that write them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.normalise import normalise_stream
from ledgerloom.operators.quality import STREAM_DROP_RULES, STREAM_WARN_RULES, expect, quarantine
from ledgerloom.session import COMPRESSION, stored, write_table
from ledgerloom.streaming.merge import stream_name


def stream_silver(
    bronze: DataFrame,
    drop=STREAM_DROP_RULES,
    warn=STREAM_WARN_RULES,
    observation: str | None = "silver_expectations",
) -> DataFrame:
    """The batch clean-up on a stream, with expectations.

    Rows breaking a drop rule leave; failures of all rules are counted in the query's
    progress under ``observation``.
    """
    return expect(normalise_stream(bronze), drop, warn, observation)


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what has landed since the last run, then stops (for scheduled runs)."""
    return (
        df.writeStream.format("parquet")
        .option("compression", COMPRESSION)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start(path)
    )


def write_with_expectations(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    counts: str,
    set_aside: str,
    drop=STREAM_DROP_RULES,
    warn=STREAM_WARN_RULES,
) -> StreamingQuery:
    """The stream's clean rows, the rows that a drop rule sets aside, and counts per batch.

    All three are written by the stream's lasting id and the batch's, so a repeated batch
    replaces its own rows and no other's, whoever else writes there: a second stream, or one
    that starts again without its checkpoint. The counts of every batch are kept: rule,
    ``failed_rows`` and ``rows_in``.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        own = f"stream={stream_name(batch)}/batch={batch_id}"
        with stored(normalise_stream(batch), "expected") as rows:
            kept, broken = quarantine(rows, drop)
            write_table(kept, f"{path}/{own}", "overwrite")
            write_table(broken, f"{set_aside}/{own}", "overwrite")
            failed = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.count_if(~r.holds).alias("failed_rows")) for r in (*drop, *warn)])
            found = rows.agg(F.count(F.lit(1)).alias("rows_in"), failed.alias("failed")).select("rows_in", F.inline("failed"))
            write_table(found, f"{counts}/{own}", "overwrite")

    return bronze.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Waits for a triggered run and raises what it raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def expectation_counts(query: StreamingQuery, observation: str = "silver_expectations") -> dict[str, int]:
    """Expectation counts of a finished run, over the micro-batches that Spark still keeps
    (100 by default); ``write_with_expectations`` stores those of all."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        row = (progress.observedMetrics or {}).get(observation)
        for name, value in (row.asDict() if row is not None else {}).items():
            totals[name] = totals.get(name, 0) + (value or 0)
    return totals


def refresh_after(
    query: StreamingQuery, read_silver: Callable[[], DataFrame], tables: dict[str, Callable], sink: Callable
) -> None:
    """Waits for a triggered run, then recomputes each summary table from silver."""
    run_to_end(query)
    silver = read_silver()
    for name, build in tables.items():
        sink(build(silver), name)
