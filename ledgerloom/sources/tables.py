"""Named tables and namespaces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_path(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet folder; ``merge_schema`` unites the columns of files written at
    different times (old rows read NULL in columns they never had)."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_namespaces(
    spark: SparkSession,
    schemas: Sequence[str] = ("bronze", "silver", "gold"),
    catalog: str | None = None,
) -> None:
    for s in schemas:
        name = f"`{catalog}`.`{s}`" if catalog else f"`{s}`"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def preview(df: DataFrame, columns: Sequence[str] | None = None, n: int = 3) -> DataFrame:
    """A few rows to look at."""
    return (df.select(*columns) if columns else df).limit(n)
