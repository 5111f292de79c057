"""Raw records to clean, typed records (batch and stream share one body)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.fixed_values import (
    HASH_COLUMNS,
    SILVER_COLUMNS,
    STREAM_HASH_COLUMNS,
    STREAM_SILVER_COLUMNS,
)
from ledgerloom.functions import (
    clean_text,
    clean_upper,
    count_of,
    date_of,
    days_between,
    fingerprint,
    timestamp_of,
)

DATE_COLUMNS = ("start_date", "completion_date", "last_update_date")


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "enrollment_count": count_of("enrollment_count"),
            "overall_status": clean_upper("overall_status"),
            "study_type": clean_upper("study_type"),
            "brief_title": clean_text("brief_title"),
            "lead_sponsor": clean_text("lead_sponsor"),
            **{c: date_of(c) for c in DATE_COLUMNS},
        }
    ).withColumns(
        {
            "is_recruiting": F.col("overall_status") == "RECRUITING",
            "is_completed": F.col("overall_status") == "COMPLETED",
            "is_interventional": F.col("study_type") == "INTERVENTIONAL",
            "duration_days": days_between("start_date", "completion_date"),
        }
    )


def normalise(
    df: DataFrame,
    run_ts: Column | str,
    hash_columns: Sequence[str] = HASH_COLUMNS,
    null_token: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Raw frame to the batch silver columns.

    ``run_ts`` is the load's timestamp (text or Column), given from outside so that
    a repeated run writes the same rows. ``carry`` names raw columns to keep besides
    (the arrival time, needed to pick the newest copy of a record).
    """
    ts = F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts
    return (
        _typed(df)
        .withColumns(
            {
                "_record_hash": fingerprint(hash_columns, null_token=null_token),
                "_silver_created_at": ts,
                "_silver_updated_at": ts,
                "_update_count": F.lit(0),
            }
        )
        .select(*SILVER_COLUMNS, *carry)
    )


def normalise_stream(
    df: DataFrame,
    hash_columns: Sequence[str] = STREAM_HASH_COLUMNS,
    null_token: str | None = None,
    arrival_ts: Column | None = None,
) -> DataFrame:
    """Raw frame (streaming or not) to the streaming silver columns."""
    return (
        _typed(df)
        .withColumns(
            {
                "ingestion_ts": timestamp_of("ingestion_ts"),
                "_record_hash": fingerprint(hash_columns, null_token=null_token),
                "_silver_ts": F.current_timestamp() if arrival_ts is None else arrival_ts,
            }
        )
        .select(*STREAM_SILVER_COLUMNS)
    )


def unparsed_counts(df: DataFrame) -> DataFrame:
    """One row: per typed column, how many non-blank raw values failed to parse."""
    checks = {
        "enrollment_count": count_of("enrollment_count"),
        **{c: date_of(c) for c in DATE_COLUMNS},
    }
    return df.agg(
        *[
            F.count_if(parsed.isNull() & (F.trim(F.col(c).cast("string")) != "")).alias(c)
            for c, parsed in checks.items()
        ]
    )
