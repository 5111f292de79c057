"""What a job leaves on disk and how often it deals its rows."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from ledgerloom.contract import landing_queries, views
from ledgerloom.operators import trigrams
from ledgerloom.operators.cdc import merge_changes
from ledgerloom.operators.dedupe import dedupe_latest
from ledgerloom.operators.quality import SILVER_RULES
from ledgerloom.plans.medallion import load_silver
from ledgerloom.session import SHUFFLE_CLEANUP, scratch_path, shuffles_dropped, stored, written
from ledgerloom.sinks import snapshots
from ledgerloom.sinks.bronze import land_bronze
from ledgerloom.sinks.snapshots import _manifest, bucket_of, committed, read_snapshot, update_snapshot, write_snapshot
from ledgerloom.streaming.merge import merge_batch
from tests.test_cdc import T1, T2, T3, _prepare, raw, record
from tests.test_writers import _held, _table

# a rule that records without a key keep, too
KNOWN = [r for r in SILVER_RULES if r.name == "status_is_known"]


def _files(path):
    return [f for f in glob.glob(f"{path}/**/*", recursive=True) if f.endswith((".parquet", ".json", ".gz"))]


def _trials(spark, n=60):
    """Records of which a part is in each delivery, some in neither, one without a key."""
    terms = F.array(*[F.lit(t) for t in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")])
    texts = ("phase", "study_type", "conditions", "brief_summary", "source")
    day = F.when(F.col("id") % 7 != 6, F.concat((1993 + F.col("id") % 9).cast("string"), F.lit("-03-04")))
    return spark.range(n).select(
        F.when(F.col("id") != 8, F.concat(F.lit("NCT"), F.lpad(F.col("id").cast("string"), 8, "0"))).alias("nct_id"),
        F.lit(" a title ").alias("brief_title"),
        F.when(F.col("id") % 3 == 0, " recruiting ").otherwise("Completed").alias("overall_status"),
        F.when(F.col("id") % 4 != 0, F.col("id")).alias("enrollment_count"),
        F.when(F.col("id") % 5 != 2, F.concat(F.lit("s"), F.col("id").cast("string"))).alias("lead_sponsor"),
        F.when(F.col("id") % 11 != 3, F.element_at(terms, (F.col("id") % 5 + 1).cast("int"))).alias("query_term"),
        F.lit(views.DAY_1).alias("ingestion_ts"),
        *[F.lit(c).alias(c) for c in texts],
        *[F.lit("1999-01-02").alias(c) for c in ("start_date", "completion_date")],
        day.alias("last_update_date"),
    )


def test_both_days_are_stored_in_one_pass(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(views, "trial_view", lambda *_: (asked.append(True), _trials(spark))[1])
    want = [views.normalise(raw, ts) for raw, ts in zip(views.raw_days(spark, ""), (views.DAY_1, views.DAY_2))]
    asked.clear()
    days = views.silver_days(spark, "")
    assert len(asked) == 1
    for day, rows in zip(days, want):
        assert day.columns == rows.columns and sorted(map(str, day.collect())) == sorted(map(str, rows.collect()))
    files = [{r.f for r in day.select(F.col("_metadata.file_path").alias("f")).collect()} for day in days]
    assert all(f"/_day={n}/" in f for n, own in enumerate(files, 1) for f in own)
    assert len({f.rsplit("/_day=", 1)[0] for own in files for f in own}) == 1


def test_deliveries_of_a_load_are_joined_once(spark, monkeypatch):
    asked, made = [], []

    def trials(*_):
        asked.append(True)
        return _trials(spark).withColumn("brief_summary", F.concat("brief_summary", F.uuid()))

    monkeypatch.setattr(views, "trial_view", trials)
    with views.stored_raw_days(spark, "") as days:
        made = [d.inputFiles() for d in days]
        # a second reading gives the same rows: they are stored
        assert {r.brief_summary for r in days[0].collect()} == {r.brief_summary for r in days[0].collect()}
    assert len(asked) == 1 and made[0] == made[1]


def test_landed_files_are_compressed(spark):
    bronze, landing = scratch_path(spark, "bronze"), scratch_path(spark, "landing")
    rows = _trials(spark).withColumn("raw_json", F.lit("{}"))
    assert land_bronze(rows, bronze)
    landing_queries._land_json(rows, landing)
    with stored(rows, "rows") as kept:
        assert all(".zstd." in f for f in kept.inputFiles())
    assert _files(bronze) and all(".zstd." in f for f in _files(bronze))
    assert _files(landing) and all(f.endswith(".json.gz") for f in _files(landing))
    assert spark.read.json(landing).count() == 60


def test_a_write_leaves_no_shuffle_files(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        return {b for b in tracker.getAllFiles().mkString("\n").split("\n") if "shuffle_" in b}

    first = held()
    written(spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count(), "grouped")
    for _ in range(50):
        if held() <= first:
            break
        spark.range(1).count()
    assert held() <= first
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    with pytest.raises(ValueError), shuffles_dropped(spark):
        raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_rows_dealt_by_key_are_written_where_they_are(spark, monkeypatch):
    seen = []
    real = snapshots.write_table
    monkeypatch.setattr(snapshots, "write_table", lambda df, *args, **options: (seen.append(_exchanges(df)), real(df, *args, **options))[1])
    rows = [record(f"NCT{i % 90}", ingestion_ts=T1) for i in range(200)] + [record(None, ingestion_ts=T1)]
    base = scratch_path(spark, "test-dealt")
    newest = dedupe_latest(_prepare(raw(spark, *rows)), "nct_id")
    write_snapshot(newest, base, 1, "nct_id", dealt=True)
    assert seen[0] == 1
    placed = read_snapshot(spark, base).select("nct_id", F.col("_metadata.file_path").alias("file"), bucket_of("nct_id", 64).alias("b")).collect()
    assert len(placed) == 91 and all(f"bucket={r.b}/" in r.file for r in placed)
    # a bucket is one file
    assert len({r.file for r in placed}) == len({r.b for r in placed})


def test_the_first_batch_of_a_stream_is_written_once(spark, monkeypatch):
    from ledgerloom.streaming import merge as streaming_merge

    base, names = scratch_path(spark, "test-first"), []
    real = streaming_merge.stored_delta
    monkeypatch.setattr(streaming_merge, "stored_delta", lambda *args: (names.append("delta"), real(*args))[1])
    fold = merge_batch(base, _prepare)
    fold(raw(spark, record("NCT1", ingestion_ts=T1), record("NCT1", "COMPLETED", ingestion_ts=T2)), 0)
    assert names == [] and {r.overall_status for r in read_snapshot(spark, base).collect()} == {"COMPLETED"}
    fold(raw(spark, record("NCT2", ingestion_ts=T2)), 1)
    assert names == ["delta"] and read_snapshot(spark, base).count() == 2


def test_a_merge_in_rounds_is_that_of_one(spark, monkeypatch):
    first = [record(f"NCT{i}", ingestion_ts=T1) for i in range(150)] + [record(None, ingestion_ts=T1)]
    second = [record(f"NCT{i}", "COMPLETED" if i % 2 else "RECRUITING", ingestion_ts=T2) for i in range(100, 250)] + [record(None, "COMPLETED", ingestion_ts=T2)]
    found = {}
    monkeypatch.setattr(snapshots, "LEAST_BUCKETS", 8)
    real = snapshots._rounds
    for most, strategy in ((1, "shuffle"), (1 << 40, "shuffle"), (1, "broadcast")):
        monkeypatch.setattr(snapshots, "MERGE_BYTES", most)
        base, merges = scratch_path(spark, "test-rounds"), []
        monkeypatch.setattr(snapshots, "_rounds", lambda *a: (merges.append(len(real(*a))), real(*a))[1])
        load_silver(raw(spark, *first), base, T1, rules=KNOWN)
        result = load_silver(raw(spark, *second), base, T2, rules=KNOWN, strategy=strategy)
        assert merges == ([8] if most == 1 else [1])
        found[most, strategy] = sorted(map(str, read_snapshot(spark, base).collect())), {r.action: r.row_count for r in result.stats.collect()}
    rows, stats = found[1, "shuffle"]
    assert all(x == (rows, stats) for x in found.values())
    assert len(rows) == 252 and stats["inserted"] == 101 and stats["updated"] == 25 and stats["unchanged"] == 25


def test_a_table_dealt_by_the_former_hash_is_gone_on_with(spark, monkeypatch):
    base = scratch_path(spark, "test-former")
    with monkeypatch.context() as before:
        former = "bucket int, path string, schema string"
        before.setattr(snapshots, "bucket_of", lambda key, buckets, hashed=None: bucket_of(key, buckets, "xxhash64"))
        write_snapshot(_table(spark, *[(f"k{i}", "old") for i in range(100)]), base, 1, "nct_id")
        path = committed(spark, base)[0].path
        rows = spark.createDataFrame([tuple(r)[:3] for r in spark.read.parquet(path).collect()], former)
        rows.coalesce(1).write.mode("overwrite").parquet(path)
    assert _manifest(spark, path)[2] == "xxhash64"
    delta = _table(spark, *[(f"k{i}", "new") for i in range(90, 120)])
    update_snapshot(spark, base, 1, 2, delta, merge_changes, "nct_id", dealt=True)
    update_snapshot(spark, base, 2, 3, _table(spark, ("k1", "newest")), merge_changes, "nct_id")
    want = {f"k{i}": "old" if i < 90 else "new" for i in range(120)} | {"k1": "newest"}
    assert _held(spark, base) == want and read_snapshot(spark, base).count() == 120
    assert _manifest(spark, committed(spark, base)[-1].path)[2] == "xxhash64"


def test_posting_lists_are_dealt_once(spark, monkeypatch):
    plans, real = [], trigrams.write_table
    monkeypatch.setattr(trigrams, "write_table", lambda df, *args: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *args))[1])
    monkeypatch.setattr(trigrams, "SPAN_BLOCKS", 2)
    base = scratch_path(spark, "test-lists")
    df = spark.range(500).select(F.col("id").cast("string").alias("nct_id"), F.concat(F.lit("text of "), F.col("id")).alias("brief_title"))
    trigrams.write_index(df, base, ["brief_title"], block_records=100)
    assert plans[-1].count("Exchange") == 1 and "rangepartitioning" not in plans[-1]
    lists = spark.read.schema(trigrams.LISTS).parquet(f"{base}/grams")
    assert lists.count() == lists.select("gram", trigrams.BLOCK).distinct().count()
    found = trigrams.index_search(spark, base, "of 49", ["brief_title"])
    assert {r.nct_id for r in found.collect()} == {"49", *map(str, range(490, 500))}
