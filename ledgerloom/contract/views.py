"""Registry-shaped inputs built from the given tables (FIXTURES.md)."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.normalise import normalise
from ledgerloom.session import scratch_path, stored, write_table

DAY_1, DAY_2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


# Columns in use, per given table; a known schema saves a pass over the file footers.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "part": "p_partkey bigint, p_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def trial_view(
    spark: SparkSession, sf_dir: str, conditions: bool = True, summary: bool = True
) -> DataFrame:
    """one raw registry record per order, dirty on purpose.

    A query that reads no conditions or no summaries says so and saves their joins;
    the columns are then NULL.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    part = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    if conditions:
        lines = lines.join(
            part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"), "left"
        )
    else:
        lines = lines.withColumn("p_name", F.lit(None).cast("string"))
    per_order = (
        lines.groupBy("l_orderkey")
        .agg(
            F.max("l_shipdate").alias("last_ship"),
            F.sum("l_quantity").cast("bigint").alias("quantity"),
            F.array_join(F.array_sort(F.collect_set("p_name")), ", ").alias("names"),
        )
    )
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date").cast("string")
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(per_order, key == F.col("l_orderkey"), "left")
    )
    if summary:
        joined = joined.join(docs, key == F.col("doc_id"), "left")
    else:
        joined = joined.withColumn("text", F.lit(None).cast("string"))
    return joined.select(
        F.concat(F.lit("NCT"), F.lpad(key.cast("string"), 8, "0")).alias("nct_id"),
        F.concat(F.lit(" "), "c_name", F.lit(" / "), "o_orderpriority", F.lit(" ")).alias("brief_title"),
        F.when(F.col("o_orderstatus") == "F", "Completed")
        .when(F.col("o_orderstatus") == "O", " recruiting ")
        .when((F.col("o_orderstatus") == "P") & (key % 7 == 0), "on_hold")
        .when(F.col("o_orderstatus") == "P", "Active_Not_Recruiting")
        .alias("overall_status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "PHASE1")
        .when(F.col("o_orderpriority") == "2-HIGH", "PHASE2")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "PHASE3")
        .when(F.col("o_orderpriority") == "5-LOW", "PHASE2, PHASE3")
        .alias("phase"),
        F.when(key % 97 == 0, None)
        .when(key % 5 == 0, F.substring(day, 1, 7))
        .otherwise(day)
        .alias("start_date"),
        F.col("last_ship").cast("date").cast("string").alias("completion_date"),
        day.alias("last_update_date"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "Observational")
        .otherwise("Interventional")
        .alias("study_type"),
        F.when(key % 101 == 0, -F.col("quantity")).otherwise(F.col("quantity")).alias("enrollment_count"),
        F.when(F.col("names") != "", F.col("names")).alias("conditions"),
        F.col("text").alias("brief_summary"),
        F.when(F.col("o_custkey") % 25 == 0, None)
        .otherwise(F.concat("c_name", F.lit(" ")))
        .alias("lead_sponsor"),
        F.lit(DAY_1).alias("ingestion_ts"),
        F.col("c_mktsegment").alias("query_term"),
        F.lit("tables").alias("source"),
    )


def silver_view(
    spark: SparkSession, sf_dir: str, conditions: bool = True, summary: bool = True
) -> DataFrame:
    return normalise(trial_view(spark, sf_dir, conditions, summary), DAY_1)


def _second(raw: DataFrame, changes: Column) -> DataFrame:
    """The second delivery's values in the rows where ``changes`` holds."""
    term = F.col("query_term")

    def changed(c: str, segment: str, value: Column) -> Column:
        return F.when(changes & (term == segment), value).otherwise(F.col(c))

    return raw.withColumns(
        {
            "overall_status": changed("overall_status", "AUTOMOBILE", F.lit("TERMINATED")),
            "brief_title": changed("brief_title", "BUILDING", F.concat(F.trim("brief_title"), F.lit(" v2"))),
            "lead_sponsor": changed("lead_sponsor", "FURNITURE", F.concat(F.trim("lead_sponsor"), F.lit(" Group"))),
            "enrollment_count": changed("enrollment_count", "HOUSEHOLD", F.col("enrollment_count") + 10),
            "ingestion_ts": F.when(changes, DAY_2).otherwise(F.col("ingestion_ts")),
        }
    )


IN_DAY_1, IN_DAY_2 = "last_update_date < '2000-07-01'", "last_update_date >= '1995-07-01'"


def _days_of(trials: DataFrame) -> tuple[DataFrame, DataFrame]:
    return trials.filter(IN_DAY_1), _second(trials.filter(IN_DAY_2), F.lit(True))


def raw_days(
    spark: SparkSession, sf_dir: str, conditions: bool = True, summary: bool = True
) -> tuple[DataFrame, DataFrame]:
    """two deliveries. Records start and stop being delivered by their date, and
    one kind of change happens in each market segment."""
    return _days_of(trial_view(spark, sf_dir, conditions, summary))


@contextlib.contextmanager
def stored_raw_days(spark: SparkSession, sf_dir: str) -> Iterator[tuple[DataFrame, DataFrame]]:
    """``raw_days`` of records that are joined once for both; for deliveries that land one after the other."""
    with stored(trial_view(spark, sf_dir), "trials") as trials:
        yield _days_of(trials)


def silver_days(
    spark: SparkSession, sf_dir: str, conditions: bool = True, summary: bool = True
) -> tuple[DataFrame, DataFrame]:
    """F2 cleaned and stored, as a table and its next delivery are; both in one pass."""
    days = F.array_compact(F.array(F.when(F.expr(IN_DAY_1), 1), F.when(F.expr(IN_DAY_2), 2)))
    both = trial_view(spark, sf_dir, conditions, summary).withColumn("_day", F.explode(days))
    clean = normalise(_second(both, F.col("_day") == 2), F.col("ingestion_ts").cast("timestamp"), carry=("_day",))
    path = scratch_path(spark, "days")
    write_table(clean, path, partition_by=["_day"])
    # of the folder as a whole: a day without rows has none of its own
    stored_days = spark.read.schema(clean.schema).parquet(path)
    return tuple(stored_days.filter(F.col("_day") == n).drop("_day") for n in (1, 2))


def study_pages(raw: DataFrame, page_rows: int = 1000) -> DataFrame:
    """raw records as nested studies, ``page_rows`` to a page."""
    def part(*fields):
        return F.struct(*fields)

    def dated(c):
        return F.when(F.col(c).isNotNull(), part(F.col(c).alias("date")))

    study = part(
        part(
            part(F.col("nct_id").alias("nctId"), F.col("brief_title").alias("briefTitle")).alias(
                "identificationModule"
            ),
            part(
                F.col("overall_status").alias("overallStatus"),
                dated("start_date").alias("startDateStruct"),
                dated("completion_date").alias("completionDateStruct"),
                dated("last_update_date").alias("lastUpdatePostDateStruct"),
            ).alias("statusModule"),
            part(
                F.split("phase", ", ").alias("phases"),
                F.col("study_type").alias("studyType"),
                F.when(
                    F.col("enrollment_count").isNotNull(), part(F.col("enrollment_count").alias("count"))
                ).alias("enrollmentInfo"),
            ).alias("designModule"),
            F.when(
                F.col("brief_summary").isNotNull(), part(F.col("brief_summary").alias("briefSummary"))
            ).alias("descriptionModule"),
            F.when(
                F.col("lead_sponsor").isNotNull(),
                part(part(F.col("lead_sponsor").alias("name")).alias("leadSponsor")),
            ).alias("sponsorCollaboratorsModule"),
            F.when(
                F.col("conditions").isNotNull(), part(F.split("conditions", ", ").alias("conditions"))
            ).alias("conditionsModule"),
        ).alias("protocolSection")
    )
    number = F.substring("nct_id", 4, 8).cast("bigint")
    return raw.groupBy(
        "query_term", F.floor(number / page_rows).alias("page")
    ).agg(F.collect_list(study).alias("studies"))


def question_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn of the conversations is a question."""
    turns = table(spark, sf_dir, "conversations").filter("role = 'user'")
    return turns.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
        F.col("text").alias("question"),
    )


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per label of the vector table: the mean of its vectors."""
    cells = table(spark, sf_dir, "embeddings").select(
        "label", F.posexplode("embedding").alias("place", "value")
    )
    means = cells.groupBy("label", "place").agg(
        F.round(F.avg(F.col("value").cast("double")), 6).alias("mean")
    )
    return means.groupBy("label").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "mean"))), lambda c: c["mean"]
        ).alias("embedding")
    ).select(F.col("label").alias("query_id"), "embedding", "label")
