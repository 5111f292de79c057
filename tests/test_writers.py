"""Several writers of one table, streams that start again, and tables that outgrow their buckets."""

from __future__ import annotations


import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.cdc import merge_changes
from ledgerloom.session import scratch_path
from ledgerloom.sinks import snapshots
from ledgerloom.sinks.snapshots import committed, read_snapshot, update_snapshot, versions, with_retries, write_snapshot
from ledgerloom.sources.pages import raw_schema
from ledgerloom.streaming.bronze import stream_bronze
from ledgerloom.streaming.merge import merge_batch
from ledgerloom.streaming.silver import run_to_end, write_with_expectations
from tests.test_cdc import T1, T2, T3, _prepare, raw, record
from tests.test_sources_streams import _lines

TABLE = "nct_id string, status string, _record_hash string, _silver_created_at string, _silver_updated_at string, _update_count int"


def _table(spark, *rows):
    return spark.createDataFrame([(k, v, v, "t", "t", 0) for k, v in rows], TABLE)


def _held(spark, base):
    return {r.nct_id: r.status for r in read_snapshot(spark, base).collect()}


def _update(spark, base, delta, before_merge=lambda: None):
    def merge(target, rows):
        before_merge()
        return merge_changes(target, rows)

    last = versions(spark, base)[-1]
    update_snapshot(spark, base, last, last + 1, delta, merge, "nct_id")


def test_the_slower_of_two_writers_starts_again(spark):
    base = scratch_path(spark, "test-two-writers")
    write_snapshot(_table(spark, ("a", "1"), ("b", "1")), base, 1, "nct_id")
    interfered = []

    def other_writer():
        if not interfered:
            interfered.append(True)
            _update(spark, base, _table(spark, ("b", "2"), ("c", "2")))

    slower = _table(spark, ("a", "3"), ("d", "3"))
    with pytest.raises(FileExistsError):
        _update(spark, base, slower, other_writer)
    assert _held(spark, base) == {"a": "1", "b": "2", "c": "2"}
    interfered.clear()
    with_retries(lambda: _update(spark, base, slower, other_writer))
    assert _held(spark, base) == {"a": "3", "b": "2", "c": "2", "d": "3"}
    assert versions(spark, base) == [1, 2, 3, 4]


def test_a_stream_and_a_load_lose_nothing(spark, monkeypatch):
    base = scratch_path(spark, "test-stream-and-load")
    write_snapshot(_prepare(raw(spark, record("NCT1", ingestion_ts=T1))), base, 1, "nct_id")
    from ledgerloom.streaming import merge as streaming_merge

    real, met = streaming_merge.merge_changes, []

    def slow_merge(*args, **options):
        if not met:  # another stream's batch comes in between
            met.append(True)
            other = merge_batch(base, _prepare)
            monkeypatch.setattr(streaming_merge, "stream_name", lambda batch: "other")
            other(raw(spark, record("NCT2", ingestion_ts=T2)), 0)
            monkeypatch.setattr(streaming_merge, "stream_name", lambda batch: "own")
        return real(*args, **options)

    monkeypatch.setattr(streaming_merge, "stream_name", lambda batch: "own")
    monkeypatch.setattr(streaming_merge, "merge_changes", slow_merge)
    merge_batch(base, _prepare)(raw(spark, record("NCT3", ingestion_ts=T3)), 0)
    assert {r.nct_id for r in read_snapshot(spark, base).collect()} == {"NCT1", "NCT2", "NCT3"}
    assert [(v.number, v.stream) for v in committed(spark, base)] == [(1, None), (2, "other"), (3, "own")]


def test_a_claim_that_led_to_nothing_is_given_up(spark, monkeypatch):
    base = scratch_path(spark, "test-claims")
    write_snapshot(spark.range(3), base, 1)
    snapshots._claim(spark, base, 2, "a writer that is gone")
    with pytest.raises(FileExistsError):
        write_snapshot(spark.range(4), base, 2)
    monkeypatch.setattr(snapshots, "STALE_SECONDS", -1)
    write_snapshot(spark.range(4), base, 2)
    assert read_snapshot(spark, base).count() == 4
    with pytest.raises(FileExistsError):  # a version that stands is never replaced
        write_snapshot(spark.range(5), base, 2)


def test_buckets_and_tasks_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "LEAST_BUCKETS", 2)
    few, base = {}, scratch_path(spark, "test-growth")
    for rows in (200, 20_000):
        df = _table(spark, *[(f"k{i}", f"{i % 97}") for i in range(rows)])
        monkeypatch.setattr(snapshots, "BUCKET_BYTES", 40_000)
        path = scratch_path(spark, "test-size")
        write_snapshot(df, path, 1, "nct_id")
        few[rows] = len(snapshots._manifest(spark, committed(spark, path)[-1].path)[0])
    assert few[200] == 2 and few[20_000] > 20
    # buckets of a table that has grown by merges are dealt anew, with nothing lost
    monkeypatch.setattr(snapshots, "BUCKET_BYTES", 4_000)
    write_snapshot(_table(spark, ("k0", "x")), base, 1, "nct_id", buckets=2)
    for load in range(3):
        _update(spark, base, _table(spark, *[(f"k{load}-{i}", f"{i}") for i in range(3000)]))
    sizes = [len(snapshots._manifest(spark, v.path)[0]) for v in committed(spark, base)]
    assert sizes[0] == sizes[1] == 2 and sizes[-1] > 8
    assert read_snapshot(spark, base).count() == 9001 == read_snapshot(spark, base).select("nct_id").distinct().count()


def test_outputs_of_a_second_stream_are_kept(spark):
    out, counts, aside = (scratch_path(spark, x) for x in ("out", "counts", "aside"))
    for first, ids in ((True, ("NCT1", "NCT2", "bad", "NCT3", "NCT4")), (False, ("NCT8", "bad2"))):
        landing = scratch_path(spark, "landing")
        _lines(spark, landing, "1.json", *[record(i, ingestion_ts=T1) for i in ids])
        # no checkpoint of the first stream: the batches are numbered from 0 again
        run_to_end(write_with_expectations(stream_bronze(spark, landing, raw_schema()), out, scratch_path(spark, "cp"), counts, aside))
    assert {r.nct_id for r in spark.read.parquet(out).collect()} == {"NCT1", "NCT2", "NCT3", "NCT4", "NCT8"}
    assert spark.read.parquet(aside).count() == 2
    rows_in = spark.read.parquet(counts).filter("rule = 'valid_nct_id'").agg(F.sum("rows_in"), F.sum("failed_rows")).first()
    assert tuple(rows_in) == (7, 2)
