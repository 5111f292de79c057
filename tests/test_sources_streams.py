from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import scratch_path
from ledgerloom.sinks.bronze import land_bronze, since
from ledgerloom.sources.pages import flatten_studies, raw_schema, read_pages, with_ingest_metadata
from ledgerloom.sources.tables import create_namespaces, preview, scan_path, scan_table, table_exists
from ledgerloom.streaming.bronze import (
    evolve_schema,
    fit,
    load_schema,
    stream_broken_pages,
    stream_bronze,
    stream_pages,
    widen,
)
from ledgerloom.streaming.merge import stream_merge
from ledgerloom.streaming.silver import (
    expectation_counts,
    run_to_end,
    stream_silver,
    write_stream,
    write_with_expectations,
)
from ledgerloom.operators.normalise import normalise, normalise_stream
from ledgerloom.sinks.snapshots import read_snapshot
from tests.test_cdc import T1, T2, record
from tests.test_normalise_quality import raw

FULL = {
    "protocolSection": {
        "identificationModule": {"nctId": "NCT00000001", "briefTitle": "Title"},
        "statusModule": {"overallStatus": "RECRUITING", "startDateStruct": {"date": "2024-03"}},
        "designModule": {"phases": ["PHASE1", "PHASE2"], "enrollmentInfo": {"count": 7}},
        "conditionsModule": {"conditions": ["Diabetes Mellitus, Type 2", "Asthma"]},
    },
    "unknownPart": {"kept": [1, 2]},
}


def put(spark, path, name, text):
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p)
    out.write(text.encode())
    out.close()


@pytest.mark.parametrize("pretty", [False, True])
def test_pages(spark, pretty):
    path = scratch_path(spark, "test-pages")
    pages = [{"studies": [FULL, {}, {"protocolSection": {}}], "nextPageToken": "t"}, {"studies": []}, {}]
    for i, page in enumerate(pages):
        put(spark, path, f"p{i}.json", json.dumps(page, indent=2 if pretty else None))
    flat = flatten_studies(read_pages(spark, path, multi_line=pretty), keep_arrays=True)
    got = {r.nct_id: r for r in with_ingest_metadata(flat, T1, "term").collect()}
    assert flat.count() == 3
    r = got["NCT00000001"]
    assert (r.phase, r.enrollment_count, r.start_date, r.completion_date, r.lead_sponsor) == (
        "PHASE1, PHASE2", 7, "2024-03", None, None
    )
    assert r.condition_list == ["Diabetes Mellitus, Type 2", "Asthma"] and r.query_term == "term"
    assert json.loads(r.raw_json)["unknownPart"] == {"kept": [1, 2]}
    assert all(v is None for k, v in got[None].asDict().items() if k in ("phase", "conditions", "brief_title"))


def test_bronze_modes(spark):
    path = scratch_path(spark, "test-bronze")
    first, second = raw(spark, record("NCT1", ingestion_ts=T1)), raw(spark, record("NCT2", ingestion_ts=T2))
    assert land_bronze(first, path) and land_bronze(second.withColumn("extra", F.lit("e")), path)
    got = {r.nct_id: (str(r.ingestion_date), r.extra) for r in scan_path(spark, path, merge_schema=True).collect()}
    assert got == {"NCT1": ("2024-01-01", None), "NCT2": ("2024-01-02", "e")}
    assert not land_bronze(first.limit(0), path, "overwrite")
    assert scan_path(spark, path).count() == 2
    land_bronze(second, path, "overwrite")
    assert scan_path(spark, path).count() == 1


def test_names(spark):
    create_namespaces(spark, ["ll_test"])
    assert not table_exists(spark, "ll_test.none")
    spark.range(5).createOrReplaceTempView("ll_view")
    assert table_exists(spark, "ll_view") and scan_table(spark, "ll_view").count() == 5
    assert preview(spark.range(5)).count() == 3
    spark.sql("DROP SCHEMA ll_test")


def _lines(spark, path, name, *rows):
    put(spark, path, name, "\n".join(json.dumps({k: v for k, v in r.items() if v is not None}) for r in rows))


def test_stream_equals_batch_and_counts_expectations(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    _lines(spark, landing, "a.json", record("NCT1", ingestion_ts=T1), record("bad", ingestion_ts=T1))
    _lines(spark, landing, "b.json", record("NCT2", n=-1, ingestion_ts=T1), record("NCT3", title="x", ingestion_ts=T1))
    bronze = stream_bronze(spark, landing, raw_schema(), max_files_per_trigger=1)
    query = run_to_end(write_stream(stream_silver(bronze), out, scratch_path(spark, "cp")))
    counts = expectation_counts(query)
    assert counts == {"rows_in": 4, "failed_valid_nct_id": 1, "failed_has_title": 1, "failed_positive_enrollment": 1}
    batch = normalise_stream(spark.read.schema(raw_schema()).json(landing)).drop("_silver_ts")
    streamed = spark.read.parquet(out).drop("_silver_ts")
    assert sorted(map(str, streamed.collect())) == sorted(
        map(str, batch.filter("nct_id in ('NCT1', 'NCT2')").collect())
    )


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_merge_is_the_same_in_one_or_many_batches(spark, per_trigger):
    landing, base = scratch_path(spark, "landing"), scratch_path(spark, "merged")
    _lines(spark, landing, "1.json", record("NCT1", ingestion_ts=T1), record("NCT2", ingestion_ts=T1))
    _lines(spark, landing, "2.json", record("NCT1", "COMPLETED", ingestion_ts=T2))
    bronze = stream_bronze(spark, landing, raw_schema(), max_files_per_trigger=per_trigger)
    prepare = lambda b: normalise(b, F.col("ingestion_ts").cast("timestamp"), carry=("ingestion_ts",))
    run_to_end(stream_merge(bronze, base, scratch_path(spark, "cp"), prepare, order_by="ingestion_ts"))
    got = {r.nct_id: r.overall_status for r in read_snapshot(spark, base).collect()}
    assert got == {"NCT1": "COMPLETED", "NCT2": "RECRUITING"}


def test_page_stream_keeps_lineage(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    put(spark, landing, "p.json", json.dumps({"studies": [FULL]}))
    run_to_end(write_stream(stream_pages(spark, landing), out, scratch_path(spark, "cp")))
    r = spark.read.parquet(out).first()
    assert r.nct_id == "NCT00000001" and r._source_file.endswith("p.json") and r._ingestion_ts is not None


def test_schema_grows_once_per_new_field(spark):
    landing, stored = scratch_path(spark, "landing"), scratch_path(spark, "schema")
    put(spark, landing, "a.json", '{"nct_id": "NCT1", "n": 1}')
    evolve_schema(spark, landing, stored)
    evolve_schema(spark, landing, stored)
    assert load_schema(spark, stored)[1] == 1
    put(spark, landing, "b.json", '{"nct_id": "NCT2", "added": "x"}')
    assert evolve_schema(spark, landing, stored).fieldNames() == ["n", "nct_id", "added"]
    assert load_schema(spark, stored)[1] == 2


def test_since_reads_later_rows_of_the_same_day(spark):
    path = scratch_path(spark, "test-since")
    rows = [record(f"NCT{i}", ingestion_ts=ts) for i, ts in enumerate((T1, "2024-01-01 09:00:00", T2, None))]
    land_bronze(raw(spark, *rows), path)
    bronze = scan_path(spark, path)
    assert {r.nct_id for r in since(bronze, T1).collect()} == {"NCT1", "NCT2", "NCT3"}
    assert {r.nct_id for r in since(bronze, T2, overlap_seconds=16 * 3600).collect()} == {"NCT1", "NCT2", "NCT3"}
    assert since(bronze, None).count() == 4


@pytest.mark.parametrize("pretty", [False, True])
def test_broken_pages_are_set_aside(spark, pretty):
    path, aside = scratch_path(spark, "test-broken"), scratch_path(spark, "test-aside")
    good = json.dumps({"studies": [FULL]}, indent=2 if pretty else None)
    put(spark, path, "good.json", good)
    put(spark, path, "cut.json", good[: len(good) // 2])
    assert read_pages(spark, path, multi_line=pretty, broken=aside).count() == 1
    assert [r._source_file.rsplit("/", 1)[1] for r in spark.read.parquet(aside).collect()] == ["cut.json"]
    with pytest.raises(Exception):
        read_pages(spark, path, multi_line=pretty, fail=True).collect()
    out = scratch_path(spark, "out")
    run_to_end(write_stream(stream_broken_pages(spark, path, multi_line=pretty), out, scratch_path(spark, "cp")))
    assert spark.read.parquet(out).count() == 1


def test_counts_of_every_batch_are_kept(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    counts, aside = scratch_path(spark, "counts"), scratch_path(spark, "aside")
    for i in range(8):
        _lines(spark, landing, f"{i}.json", record(f"NCT{i}" if i % 2 else "bad", ingestion_ts=T1))
    bronze = stream_bronze(spark, landing, raw_schema(), max_files_per_trigger=1)
    run_to_end(write_with_expectations(bronze, out, scratch_path(spark, "cp"), counts, aside))
    stored = spark.read.parquet(counts).filter("rule = 'valid_nct_id'").collect()
    assert len(stored) == 8 and sum(r.failed_rows for r in stored) == 4 == spark.read.parquet(aside).count()
    assert spark.read.parquet(out).count() == 4


def test_types_widen_by_their_parts():
    kind = T.StructType.fromDDL
    known = kind("n bigint, o struct<a: bigint>, l array<struct<x: bigint>>, s string")
    seen = kind("n double, o struct<a: string, b: string>, l array<struct<y: string>>, t string")
    assert widen(known, seen) == kind("n double, o struct<a: string, b: string>, l array<struct<x: bigint, y: string>>, s string, t string")


def test_values_that_do_not_fit_are_rescued(spark):
    df = spark.createDataFrame([("7", 1.0), ("12 approx", 2.5), (None, None)], "n string, m double")
    got = [(r.n, r.m, r._rescued) for r in fit(df, T.StructType.fromDDL("n bigint, m bigint")).collect()]
    assert got == [(7, 1, None), (None, None, {"n": "12 approx", "m": "2.5"}), (None, None, None)]


def test_schema_pass_reads_new_files_only(spark):
    landing, stored = scratch_path(spark, "landing"), scratch_path(spark, "schema")
    put(spark, landing, "a.json", '{"nct_id": "NCT1"}')
    evolve_schema(spark, landing, stored)
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/a.json")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(p, 1_600_000_000_000, -1)
    assert evolve_schema(spark, landing, stored).fieldNames() == ["nct_id"]
    put(spark, landing, "b.json", '{"more": 1}')
    assert evolve_schema(spark, landing, stored).fieldNames() == ["nct_id", "more"]
