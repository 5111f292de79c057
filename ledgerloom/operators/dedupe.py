"""Newest copy of every record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEWEST_FIRST = ("ingestion_ts", "last_update_date", "_record_hash")


def dedupe_latest(
    df: DataFrame,
    key: str = "nct_id",
    newest_first: Sequence[str | Column] = NEWEST_FIRST,
) -> DataFrame:
    """One row per key: the greatest by ``newest_first`` (NULL is oldest).

    Spark keeps one row per key in every input partition before the shuffle
    (WindowGroupLimit), so a key with very many copies sends one row per task.
    """
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in newest_first]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_copy_rank", rank).filter(F.col("_copy_rank") == 1).drop("_copy_rank")
