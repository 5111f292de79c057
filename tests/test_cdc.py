from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from ledgerloom.fixed_values import WIDE_UPDATE_COLUMNS
from ledgerloom.contract import batch_queries
from ledgerloom.operators import cdc
from ledgerloom.operators.sizing import fits_broadcast, measured_bytes
from ledgerloom.operators.normalise import normalise
from ledgerloom.sinks.snapshots import drop_old_versions, read_snapshot, versions, write_snapshot
from ledgerloom.session import scratch_path, written
from ledgerloom.streaming.merge import merge_batch
from ledgerloom.plans.medallion import load_silver, refresh_gold
from ledgerloom.operators.quality import QualityGateError
from tests.test_normalise_quality import raw

T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def record(key, status="RECRUITING", n=1, sponsor="S", title="a long title", **more):
    return {
        "nct_id": key, "overall_status": status, "enrollment_count": n, "lead_sponsor": sponsor,
        "brief_title": title, **more,
    }


def silver(spark, ts, *rows, carry=()):
    return normalise(raw(spark, *rows), ts, carry=carry)


@pytest.fixture(scope="module")
def sides(spark):
    target = silver(spark, T1, record("NCT1"), record("NCT2"), record("NCT3"), record(None), record("NCT5"))
    delta = silver(
        spark, T2,
        record("NCT1", "COMPLETED", sponsor="S2"), record("NCT2", title="another title"),
        record("NCT4"), record(None, "COMPLETED"),
    )
    return target.cache(), delta.cache()


def state(df):
    return sorted((r.nct_id or "", r.overall_status, r.lead_sponsor, r.brief_title, r._update_count) for r in df.collect())


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast", "auto"])
def test_merge(sides, strategy):
    target, delta = sides
    assert state(cdc.merge_changes(target, delta, strategy=strategy)) == sorted([
        ("NCT1", "COMPLETED", "S2", "a long title", 1),
        ("NCT2", "RECRUITING", "S", "a long title", 0),   # a title alone is not a change
        ("NCT3", "RECRUITING", "S", "a long title", 0),
        ("NCT4", "RECRUITING", "S", "a long title", 0),
        ("NCT5", "RECRUITING", "S", "a long title", 0),
        ("", "RECRUITING", "S", "a long title", 0),       # a missing key matches nothing
        ("", "COMPLETED", "S", "a long title", 0),
    ])


def test_listed_columns_only(sides):
    target, delta = sides
    got = {r.nct_id: r for r in cdc.merge_changes(target, delta, update_columns=WIDE_UPDATE_COLUMNS).collect()}
    assert got["NCT1"].lead_sponsor == "S" and got["NCT1"].overall_status == "COMPLETED"
    assert str(got["NCT1"]._silver_created_at) < str(got["NCT1"]._silver_updated_at)


def test_small_delta_does_not_shuffle_the_target(spark, sides):
    target, delta = sides
    plan = cdc.merge_changes(target, delta, strategy="broadcast")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_size_check(spark):
    df = spark.range(1000).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert 100_000 <= measured_bytes(df) <= 200_000
    assert fits_broadcast(df, 200_000) and not fits_broadcast(df, 50_000)


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_merge_is_idempotent_and_counts_add_up(sides, strategy):
    target, delta = sides
    delta = delta.filter("nct_id is not null")
    once = cdc.merge_changes(target, delta, strategy=strategy)
    assert state(cdc.merge_changes(once, delta, strategy=strategy)) == state(once)
    stats = {r.action: r.row_count for r in cdc.merge_stats(cdc.pair_changes(target, delta, strategy=strategy)).collect()}
    assert stats == {"inserted": 1, "updated": 1, "unchanged": 1, "target_only": 3}
    assert stats["inserted"] + stats["updated"] + stats["unchanged"] == delta.count()
    assert cdc.updated_rows(once).first().updated_records == 1


def test_change_feed(sides):
    target, delta = sides
    feed = cdc.change_feed(cdc.pair_changes(target, delta.filter("nct_id is not null")), target.columns)
    got = sorted((r._change_type, r.nct_id, r.overall_status) for r in feed.collect())
    assert got == [
        ("insert", "NCT4", "RECRUITING"),
        ("update_postimage", "NCT1", "COMPLETED"),
        ("update_preimage", "NCT1", "RECRUITING"),
    ]


def test_order_of_deliveries_does_not_matter_with_a_sequence(spark):
    deltas = [
        silver(spark, ts, record("NCT1", status, ingestion_ts=ts), carry=("ingestion_ts",))
        for ts, status in ((T1, "RECRUITING"), (T2, "SUSPENDED"), (T3, "COMPLETED"))
    ]
    for order in itertools.permutations(range(3)):
        table = deltas[order[0]]
        for i in order[1:]:
            table = cdc.merge_changes(table, deltas[i], order_by="ingestion_ts", strategy="shuffle")
        assert [r.overall_status for r in table.collect()] == ["COMPLETED"]


def test_repeated_micro_batch_counts_once(spark):
    base = scratch_path(spark, "test-merge")
    fold = merge_batch(base, lambda b: normalise(b, F.col("ingestion_ts").cast("timestamp"), carry=("ingestion_ts",)))
    first = raw(spark, record("NCT1", ingestion_ts=T1), record("NCT2", ingestion_ts=T1))
    second = raw(spark, record("NCT1", "COMPLETED", ingestion_ts=T2), record("NCT1", ingestion_ts=T1))
    fold(first, 0)
    fold(second, 1)
    fold(second, 1)
    got = {r.nct_id: (r.overall_status, r._update_count) for r in read_snapshot(spark, base).collect()}
    assert got == {"NCT1": ("COMPLETED", 1), "NCT2": ("RECRUITING", 0)}
    assert versions(spark, base) == [1, 2]


def test_equal_redelivery_moves_the_sequence_on(spark):
    deltas = [
        silver(spark, ts, record("NCT1", status, ingestion_ts=ts), record(None, ingestion_ts=ts), carry=("ingestion_ts",))
        for ts, status in ((T1, "RECRUITING"), (T3, "RECRUITING"), (T2, "SUSPENDED"))
    ]
    for strategy in ("shuffle", "broadcast"):
        table = deltas[0]
        for delta in deltas[1:]:
            table = cdc.merge_changes(table, delta, order_by="ingestion_ts", strategy=strategy)
        got = [(r.nct_id, r.overall_status, str(r.ingestion_ts), r._update_count) for r in table.collect()]
        assert ("NCT1", "RECRUITING", T3, 0) in got and len(got) == 4


def _prepare(batch):
    return normalise(batch, F.col("ingestion_ts").cast("timestamp"), carry=("ingestion_ts",))


def test_a_stream_goes_on_from_an_existing_table(spark):
    base = scratch_path(spark, "test-existing")
    load_silver(raw(spark, *[record(f"NCT{i}", ingestion_ts=T1) for i in range(5)]), base, T1)
    fold = merge_batch(base, _prepare)
    batch = raw(spark, record("NCT1", "COMPLETED", ingestion_ts=T2), record("NCT9", ingestion_ts=T2))
    for _ in range(2):
        fold(batch, 0)
        got = {r.nct_id: (r.overall_status, r._update_count) for r in read_snapshot(spark, base).collect()}
        assert len(got) == 6 and got["NCT1"] == ("COMPLETED", 1) and got["NCT0"] == ("RECRUITING", 0)
    # another writer goes on; the same batch once more changes nothing
    load_silver(raw(spark, record("NCT1", "SUSPENDED", ingestion_ts=T3)), base, T3)
    fold(batch, 0)
    assert {r.nct_id: r.overall_status for r in read_snapshot(spark, base).collect()}["NCT1"] == "SUSPENDED"
    assert versions(spark, base) == [1, 2, 3]


def test_untouched_buckets_keep_their_files(spark):
    base = scratch_path(spark, "test-buckets")
    load_silver(raw(spark, *[record(f"NCT{i}", ingestion_ts=T1) for i in range(200)]), base, T1)
    before = set(read_snapshot(spark, base).inputFiles())
    result = load_silver(raw(spark, record("NCT7", "COMPLETED", ingestion_ts=T2)), base, T2)
    after = set(read_snapshot(spark, base).inputFiles())
    assert len(before - after) == len(after - before) == 1 and len(after) > 20
    assert {r.action: r.row_count for r in result.stats.collect()}["updated"] == 1
    assert read_snapshot(spark, base).count() == 200
    load_silver(raw(spark, record("NCT8", "COMPLETED", ingestion_ts=T3)), base, T3)
    gone = drop_old_versions(spark, base, 1)
    assert gone == 2 and versions(spark, base) == [3] and read_snapshot(spark, base).count() == 200


def test_a_taken_version_is_not_replaced(spark):
    base = scratch_path(spark, "test-taken")
    write_snapshot(spark.range(3), base, 1)
    with pytest.raises(FileExistsError):
        write_snapshot(spark.range(5), base, 1)
    assert read_snapshot(spark, base).count() == 3


def test_load_and_gate(spark):
    base = scratch_path(spark, "test-load")
    assert load_silver(raw(spark, record("NCT1", ingestion_ts=T1)), base, T1).version == 1
    result = load_silver(
        raw(spark, record("NCT1", "COMPLETED", ingestion_ts=T2), record("NCT1", ingestion_ts=T1)), base, T2
    )
    assert result.version == 2
    assert {r.action: r.row_count for r in result.stats.collect()} == {"updated": 1}
    with pytest.raises(QualityGateError):
        load_silver(raw(spark, record("broken", ingestion_ts=T3)), base, T3)
    assert versions(spark, base) == [1, 2]
    counts = refresh_gold(spark, read_snapshot(spark, base), scratch_path(spark, "test-gold"), T3)
    assert {r.table_name: r.row_count for r in counts.collect()}["trial_status_summary"] == 1


def test_unfinished_snapshot_does_not_count(spark):
    base = scratch_path(spark, "test-unfinished")
    write_snapshot(spark.range(3), base, 1)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/version=000000002/part-0.parquet")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()
    assert versions(spark, base) == [1] and read_snapshot(spark, base).count() == 3


def test_three_deliveries_are_stored_and_dealt_once(spark, monkeypatch):
    key = F.when(F.col("id") < 40, F.concat(F.lit("NCT"), F.lpad(F.col("id").cast("string"), 8, "0")))
    texts = ("phase", "study_type", "conditions", "brief_summary", "lead_sponsor", "query_term", "source")
    dates = ("start_date", "completion_date", "last_update_date")
    raw = spark.range(43).select(
        key.alias("nct_id"),
        F.lit("a title").alias("brief_title"),
        F.lit("recruiting").alias("overall_status"),
        F.col("id").alias("enrollment_count"),
        F.lit("2024-01-01 00:00:00").alias("ingestion_ts"),
        *[F.lit(c).alias(c) for c in texts],
        *[F.lit("1999-01-02").alias(c) for c in dates],
    )
    names = []
    monkeypatch.setattr(batch_queries, "raw_days", lambda *_: (raw, None))
    monkeypatch.setattr(batch_queries, "written", lambda df, name: (names.append(name), written(df, name))[1])
    want = sorted(map(str, batch_queries.cdc_merge_late(spark, "").collect()))
    assert names == ["first-delivery"] and len(want) == 40 + 3 * 3
    monkeypatch.setattr(batch_queries, "fits_broadcast", lambda *_: False, raising=False)
    late = batch_queries.cdc_merge_late(spark, "")
    assert sorted(map(str, late.collect())) == want
    assert "ReusedExchange" in late._jdf.queryExecution().executedPlan().toString()
