"""Registered queries that write to the shared folder: pages, raw table, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.contract.batch_queries import as_text
from ledgerloom.contract.views import DAY_1, DAY_2, raw_days, stored_raw_days, study_pages, trial_view
from ledgerloom.operators import gold
from ledgerloom.operators.dedupe import dedupe_latest
from ledgerloom.operators.normalise import normalise
from ledgerloom.plans.medallion import load_silver, refresh_gold
from ledgerloom.session import scratch_path, shuffles_dropped, written
from ledgerloom.sinks.bronze import land_bronze, since
from ledgerloom.sinks.snapshots import read_snapshot
from ledgerloom.sources.pages import (
    explode_pages,
    flatten_studies,
    raw_schema,
    read_pages,
    read_terms,
    with_ingest_metadata,
)
from ledgerloom.sinks.tables import refresh_named_table, refresh_table
from ledgerloom.sources.tables import create_namespaces, preview, scan_path, scan_table, table_exists
from ledgerloom.streaming.bronze import evolve_schema, fit, stream_bronze
from ledgerloom.streaming.latest import latest_changes, rocksdb_state
from ledgerloom.streaming.merge import stream_merge
from ledgerloom.streaming.silver import refresh_after, run_to_end, stream_silver, write_stream, write_with_expectations

FLAT = (
    "nct_id",
    "brief_title",
    "overall_status",
    "phase",
    "start_date",
    "completion_date",
    "last_update_date",
    "study_type",
    "enrollment_count",
    "conditions",
    "brief_summary",
    "lead_sponsor",
    "query_term",
)


def _land_json(df: DataFrame, path: str) -> None:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("append").option("compression", "gzip").json(path)


def page_flatten(spark, d):
    """Trials as landed pages, read back and flattened."""
    path = scratch_path(spark, "pages")
    study_pages(trial_view(spark, d)).drop("page", "query_term").write.json(path)
    flat = with_ingest_metadata(flatten_studies(read_pages(spark, path)), DAY_1, "orders", "tables")
    return flat.select(
        *FLAT,
        "ingestion_ts",
        "source",
        F.get_json_object("raw_json", "$.protocolSection.identificationModule.nctId").alias("raw_id"),
    )


def page_terms(spark, d):
    """Pages landed per search term, all terms in one read."""
    path = scratch_path(spark, "term-pages")
    study_pages(trial_view(spark, d)).drop("page").write.partitionBy(
        "query_term"
    ).json(path)
    terms = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    flat = flatten_studies(read_terms(spark, path, terms))
    return flat.groupBy("query_term").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("conditions").alias("with_conditions"),
        F.sum("enrollment_count").alias("total_enrollment"),
    )


def condition_arrays(spark, d):
    """Analytics straight from the label arrays, no splitting of text."""
    flat = flatten_studies(
        explode_pages(
            study_pages(trial_view(spark, d)).select(
                "query_term", F.transform("studies", lambda s: F.to_json(s)).alias("studies")
            )
        ),
        keep_arrays=True,
    ).withColumn("is_recruiting", F.upper(F.trim("overall_status")) == "RECRUITING")
    return gold.exploded_analytics(flat, labels="condition_list", distinct_labels=True)


def _with_raw(raw: DataFrame) -> DataFrame:
    return raw.withColumn("raw_json", F.to_json(F.struct(*raw.columns)))


def bronze_append(spark, d):
    """Two deliveries appended to the raw table; only the later one is read back whole."""
    path = scratch_path(spark, "bronze")
    for raw in raw_days(spark, d):
        land_bronze(_with_raw(raw), path)
    bronze = scan_path(spark, path)
    totals = (
        F.count(F.lit(1)).alias("row_count"),
        F.sum("enrollment_count").alias("total_enrollment"),
        F.count("raw_json").alias("with_raw"),
        F.sum(F.length("brief_summary")).alias("summary_chars"),
        F.sum(F.length(F.get_json_object("raw_json", "$.brief_summary"))).alias("raw_summary_chars"),
        F.sum(F.length(F.get_json_object("raw_json", "$.conditions"))).alias("raw_condition_chars"),
    )
    by_day = bronze.groupBy(F.col("ingestion_date").cast("string").alias("ingestion_date")).agg(*totals)
    later = since(bronze, DAY_1).agg(F.lit("later").alias("ingestion_date"), *totals)
    return by_day.unionAll(later)


def _two_loads(spark, d):
    bronze, base = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    seen = None
    with stored_raw_days(spark, d) as days:
        for raw, ts in zip(days, (DAY_1, DAY_2)):
            land_bronze(_with_raw(raw), bronze)
            # each load reads what has arrived since the one before
            load_silver(since(scan_path(spark, bronze), seen), base, ts)
            seen = ts
    return read_snapshot(spark, base)


def silver_load(spark, d):
    """Two loads into the clean table: create, then merge."""
    return as_text(_two_loads(spark, d)).drop("ingestion_ts")


def gold_refresh(spark, d):
    """The four summary tables written, and their row counts."""
    silver = _two_loads(spark, d)
    return refresh_gold(spark, silver, scratch_path(spark, "gold"), DAY_2)


def page_quarantine(spark, d):
    """Pages of which every third is cut off: what is read of each term, and what is set aside."""
    path, broken = scratch_path(spark, "broken-pages"), scratch_path(spark, "quarantine")
    pages = study_pages(trial_view(spark, d))
    text = F.to_json(F.struct("studies"))
    cut = F.when(F.col("page") % 3 == 0, F.substring(text, 1, F.floor(F.length(text) / 2).cast("int"))).otherwise(text)
    pages.select("query_term", cut.alias("value")).write.partitionBy("query_term").text(path)
    studies = flatten_studies(read_pages(spark, path, broken=broken))
    read = studies.groupBy("query_term").agg(F.count(F.lit(1)).alias("studies_read"), F.lit(0).cast("bigint").alias("broken_pages"))
    aside = spark.read.parquet(broken).select(F.regexp_extract("_source_file", "query_term=([^/]*)/", 1).alias("query_term"))
    lost = aside.groupBy("query_term").agg(F.lit(0).cast("bigint").alias("studies_read"), F.count(F.lit(1)).alias("broken_pages"))
    return read.unionAll(lost).groupBy("query_term").agg(F.sum("studies_read").alias("studies_read"), F.sum("broken_pages").alias("broken_pages"))


def _flat_json(raw: DataFrame) -> DataFrame:
    return raw.select(*FLAT, "ingestion_ts", "source")


def _streaming_silver(spark, d, out):
    landing = scratch_path(spark, "landing")
    _land_json(_flat_json(trial_view(spark, d)), landing)
    stream = stream_silver(stream_bronze(spark, landing, raw_schema()))
    return write_stream(stream, out, scratch_path(spark, "checkpoint"))


def stream_silver_query(spark, d):
    path = scratch_path(spark, "stream-silver")
    run_to_end(_streaming_silver(spark, d, path))
    out = as_text(spark.read.parquet(path)).drop("_silver_ts")
    return out.withColumn("ingestion_ts", F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss"))


def stream_gold(spark, d):
    """Summary tables recomputed from the table that a stream writes, once it has ended."""
    silver, gold_base = scratch_path(spark, "stream-silver"), scratch_path(spark, "stream-gold")
    refresh_after(
        _streaming_silver(spark, d, silver),
        lambda: spark.read.parquet(silver),
        {"trial_status_summary": lambda df: gold.status_summary(df, duration=None, rounded=False)},
        lambda df, name: refresh_table(df, f"{gold_base}/{name}"),
    )
    return spark.read.parquet(f"{gold_base}/trial_status_summary")


def named_tables(spark, d):
    """Namespaces made, a table written under a name, found, previewed and scanned."""
    name = f"bronze_{uuid.uuid4().hex}"
    create_namespaces(spark, (name,))
    try:
        refresh_named_table(trial_view(spark, d), f"{name}.trials")
        facts = table_exists(spark, f"{name}.trials"), table_exists(spark, f"{name}.missing"), preview(scan_table(spark, f"{name}.trials"), ["nct_id"], 3).count()
        totals = scan_table(spark, f"{name}.trials").agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.length("brief_summary")).alias("summary_chars"))
        return written(totals.select(F.lit(facts[0]).alias("found"), F.lit(facts[1]).alias("found_missing"), F.lit(facts[2]).alias("previewed"), "row_count", "summary_chars"), "named-tables")
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def _stream_in(spark, base, *deliveries):
    """Deliveries landed one after the other, each folded in by a triggered run."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")

    def prepare(batch):
        return normalise(batch, F.col("ingestion_ts").cast("timestamp"), carry=("ingestion_ts",))

    for raw in deliveries:
        _land_json(_flat_json(raw), landing)
        bronze = stream_bronze(spark, landing, raw_schema())
        run_to_end(stream_merge(bronze, base, checkpoint, prepare))
    return as_text(read_snapshot(spark, base).drop("ingestion_ts"))


def stream_cdc(spark, d):
    """Two deliveries through the stream."""
    with stored_raw_days(spark, d) as days:
        return _stream_in(spark, scratch_path(spark, "stream-merge"), *days)


def stream_latest(spark, d):
    """The newest copy per key, followed by the changes that a stateful stream puts out; the second
    delivery comes first."""
    landing, out, checkpoint = (scratch_path(spark, x) for x in ("landing", "latest", "checkpoint"))
    with rocksdb_state(spark), stored_raw_days(spark, d) as days:
        for raw in reversed(days):
            _land_json(_flat_json(raw), landing)
            bronze = stream_bronze(spark, landing, raw_schema())
            clean = normalise(bronze, F.col("ingestion_ts").cast("timestamp"), carry=("ingestion_ts",))
            run_to_end(write_stream(latest_changes(clean), out, checkpoint))
    rows = spark.read.parquet(out)
    newest = dedupe_latest(rows.filter(F.col("_change").isin("new", "changed")))
    late = rows.filter("_change = 'late'").select("nct_id", F.lit(True).alias("had_late")).distinct()
    return newest.join(late, "nct_id", "left").select("nct_id", "_record_hash", F.coalesce("had_late", F.lit(False)).alias("had_late"), F.length("brief_summary").alias("summary_chars"))


def stream_cdc_existing(spark, d):
    """A batch load makes the table; a stream that starts on it brings the second delivery."""
    base = scratch_path(spark, "stream-merge")
    with stored_raw_days(spark, d) as (first, second):
        load_silver(first, base, DAY_1)
        return _stream_in(spark, base, second)


def _with_flaws(raw: DataFrame) -> DataFrame:
    """Some records with a broken key, some with hardly a title."""
    key = F.substring("nct_id", 4, 8).cast("bigint")
    return raw.withColumns(
        {
            "nct_id": F.when(key % 11 == 0, F.substring("nct_id", 4, 8)).otherwise(F.col("nct_id")),
            "brief_title": F.when(key % 13 == 0, "none").otherwise(F.col("brief_title")),
        }
    )


def _expectations_met(spark, out, counts, aside):
    found = spark.read.parquet(counts).groupBy("rule").agg(F.sum("failed_rows").alias("row_count"))
    kept, broken = (spark.read.parquet(p).select(F.lit(n).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("row_count")) for n, p in (("kept", out), ("set_aside", aside)))
    return found.unionAll(kept).unionAll(broken)


def stream_expectation_counts(spark, d):
    """Rows that break a rule, per rule, and what is kept and set aside."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "expected")
    counts, aside = scratch_path(spark, "counts"), scratch_path(spark, "set-aside")
    _land_json(_flat_json(_with_flaws(trial_view(spark, d))), landing)
    bronze = stream_bronze(spark, landing, raw_schema(), max_files_per_trigger=1)
    run_to_end(write_with_expectations(bronze, out, scratch_path(spark, "checkpoint"), counts, aside))
    return _expectations_met(spark, out, counts, aside)


def stream_restart_counts(spark, d):
    """Two streams without a common checkpoint write to the same outputs, a delivery each."""
    out, counts, aside = (scratch_path(spark, x) for x in ("expected", "counts", "set-aside"))
    with stored_raw_days(spark, d) as days:
        for raw in days:
            landing = scratch_path(spark, "landing")
            _land_json(_flat_json(_with_flaws(raw)), landing)
            bronze = stream_bronze(spark, landing, raw_schema())
            run_to_end(write_with_expectations(bronze, out, scratch_path(spark, "checkpoint"), counts, aside))
    return _expectations_met(spark, out, counts, aside)


def stream_type_widening(spark, d):
    """A count that comes as text, and a field within a struct, in the second delivery."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "widened")
    location, checkpoint = scratch_path(spark, "schema"), scratch_path(spark, "checkpoint")
    approx = F.when(F.col("query_term") == "BUILDING", F.concat("enrollment_count", F.lit(" approx")))
    kept = None
    text_count = F.coalesce(approx, F.col("enrollment_count").cast("string"))
    with stored_raw_days(spark, d) as (first, second):
        for raw in (
            first.withColumn("site", F.struct("query_term")).drop("query_term"),
            second.withColumn("enrollment_count", text_count).withColumn("site", F.struct("query_term", "study_type")).drop("query_term"),
        ):
            _land_json(raw, landing)
            schema = evolve_schema(spark, landing, location)
            kept = kept or schema
            run_to_end(write_stream(fit(stream_bronze(spark, landing, schema), kept), out, checkpoint))
    stored = scan_path(spark, out, merge_schema=True)
    return stored.groupBy(F.col("site.query_term").alias("query_term")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("enrollment_count").alias("total_enrollment"),
        F.count(F.element_at("_rescued", "enrollment_count")).alias("rescued"),
        F.count("site.study_type").alias("with_study_type"),
        F.sum(F.length("brief_summary")).alias("summary_chars"),
    )


def stream_schema_widening(spark, d):
    """A second delivery brings a new field; rows of the first read NULL in it."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "widened")
    stored, checkpoint = scratch_path(spark, "schema"), scratch_path(spark, "checkpoint")
    with stored_raw_days(spark, d) as (first, second):
        for raw in (first, second.withColumn("registry_note", F.upper("study_type"))):
            _land_json(raw, landing)
            schema = evolve_schema(spark, landing, stored)
            run_to_end(write_stream(stream_bronze(spark, landing, schema), out, checkpoint))
    return (
        scan_path(spark, out, merge_schema=True)
        .groupBy("registry_note")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("enrollment_count").alias("total_enrollment"),
            F.count("_source_file").alias("with_source_file"),
            F.sum(F.length("conditions")).alias("condition_chars"),
            F.sum(F.length("brief_summary")).alias("summary_chars"),
        )
    )


QUERIES = {
    "page_flatten": page_flatten,
    "page_terms": page_terms,
    "condition_arrays": condition_arrays,
    "bronze_append": bronze_append,
    "silver_load": silver_load,
    "gold_refresh": gold_refresh,
    "stream_silver": stream_silver_query,
    "stream_gold": stream_gold,
    "named_tables": named_tables,
    "stream_cdc": stream_cdc,
    "stream_cdc_existing": stream_cdc_existing,
    "stream_latest": stream_latest,
    "stream_expectation_counts": stream_expectation_counts,
    "stream_restart_counts": stream_restart_counts,
    "stream_type_widening": stream_type_widening,
    "page_quarantine": page_quarantine,
    "stream_schema_widening": stream_schema_widening,
}
