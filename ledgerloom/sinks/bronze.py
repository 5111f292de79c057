"""Raw landing table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import RAW_COLUMNS
from ledgerloom.functions import date_of, timestamp_of
from ledgerloom.session import write_table


def with_ingestion_date(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_date", date_of(timestamp_of("ingestion_ts")))


def land_bronze(df: DataFrame, path: str, mode: str = "append") -> bool:
    """Writes raw records partitioned by arrival date; False if there were none.

    ``append`` and ``overwrite`` as in Spark. An empty input leaves the table as it
    is, also in overwrite mode. Columns beyond the raw record are written too; read
    the table with ``scan_path(..., merge_schema=True)`` to see them in all rows.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode: {mode}")
    if df.isEmpty():
        return False
    extra = [c for c in df.columns if c not in RAW_COLUMNS]
    write_table(with_ingestion_date(df.select(*RAW_COLUMNS, *extra)), path, mode, ["ingestion_date"])
    return True


def since(df: DataFrame, last_ts: str | None, overlap_seconds: int = 0) -> DataFrame:
    """Arrivals after a time; prunes the partitions of the landing table.

    Later deliveries of the same day are read, and so are rows without an arrival time.
    ``overlap_seconds`` goes back further, for deliveries that land out of order: a merge
    with ``order_by`` takes rows that it has seen as no change.
    """
    if last_ts is None:
        return df
    start = F.expr(f"timestamp'{last_ts}' - make_interval(0, 0, 0, 0, 0, 0, {int(overlap_seconds)})")
    day, arrival = F.col("ingestion_date"), timestamp_of("ingestion_ts")
    return df.filter(day.isNull() | ((day >= start.cast("date")) & (arrival > start)))
