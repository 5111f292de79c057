"""Summary tables, vector items and run logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.gold import row_counts


def refresh_table(df: DataFrame, path: str) -> None:
    """Full refresh of a summary table."""
    df.write.mode("overwrite").parquet(path)


def refresh_named_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def table_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table_name, row_count) of written tables; counts come from file footers."""
    return row_counts({name: spark.read.parquet(p) for name, p in paths.items()})


def rebuild_items(items: DataFrame, path: str) -> None:
    """Drops and rewrites the vector collection."""
    items.write.mode("overwrite").parquet(path)


RUN_COLUMNS = (
    "run_name string, query_id string, question string, encoder string, top_k int, "
    "question_length int, collection_size bigint, top1_similarity double, "
    "avg_similarity double, min_similarity double, recruiting_trials_found bigint, "
    "trials_retrieved bigint, recruiting_found boolean, high_confidence boolean, context string"
)


def run_rows(
    questions: DataFrame,
    metrics: DataFrame,
    tags: DataFrame,
    contexts: DataFrame,
    collection_size: DataFrame,
    encoder: str,
    top_k: int,
    run_name: str,
) -> DataFrame:
    """One row per question: parameters, measures, tags and the context it was given, if any.

    ``collection_size`` is the one-row frame of ``collection_info``.
    """
    size = F.broadcast(collection_size.select("collection_size", F.lit(True).alias("_one")))
    return (
        questions.join(metrics, "query_id", "left")
        .join(tags.drop("query"), "query_id", "left")
        .join(contexts, "query_id", "left")
        .withColumn("_one", F.lit(True))
        .join(size, "_one")
        .select(
            F.lit(run_name).alias("run_name"),
            F.col("query_id").cast("string").alias("query_id"),
            "question",
            F.lit(encoder).alias("encoder"),
            F.lit(top_k).alias("top_k"),
            F.length("question").alias("question_length"),
            "collection_size",
            "top1_similarity",
            "avg_similarity",
            "min_similarity",
            "recruiting_trials_found",
            "trials_retrieved",
            "recruiting_found",
            "high_confidence",
            "context",
        )
    )


def append_runs(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_COLUMNS).parquet(path)
