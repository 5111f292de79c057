"""The newest copy per key in state, for every order of deliveries."""

from __future__ import annotations

import itertools

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.dedupe import dedupe_latest
from ledgerloom.operators.normalise import normalise
from ledgerloom.session import scratch_path
from ledgerloom.sources.pages import raw_schema
from ledgerloom.streaming.bronze import stream_bronze
from ledgerloom.streaming.latest import _Newest, latest_changes, rocksdb_state
from ledgerloom.streaming.silver import run_to_end, write_stream
from tests.test_cdc import T1, T2, T3, record
from tests.test_sources_streams import _lines

DELIVERIES = (
    [record("NCT1", ingestion_ts=T1), record("NCT2", ingestion_ts=T1), record(None, ingestion_ts=T1)],
    [record("NCT1", "COMPLETED", ingestion_ts=T2), record("NCT1", ingestion_ts=T1)],
    [record("NCT1", "COMPLETED", ingestion_ts=T3), record("NCT3", "SUSPENDED", ingestion_ts=T3)],
)


@pytest.fixture
def rocksdb(spark):
    with rocksdb_state(spark):
        yield


def _clean(df):
    return normalise(df, F.col("ingestion_ts").cast("timestamp"), carry=("ingestion_ts",))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_the_last_change_is_the_newest_copy(spark, rocksdb, order):
    landing, out, checkpoint = (scratch_path(spark, x) for x in ("landing", "latest", "cp"))
    for run, k in enumerate(order):
        _lines(spark, landing, f"{run}.json", *DELIVERIES[k])
        changes = latest_changes(_clean(stream_bronze(spark, landing, raw_schema())))
        run_to_end(write_stream(changes, out, checkpoint))
    rows = spark.read.parquet(out)
    every = _clean(spark.read.schema(raw_schema()).json(landing))
    want = {r.nct_id: r._record_hash for r in dedupe_latest(every).filter("nct_id is not null").collect()}
    followed = dedupe_latest(rows.filter("_change in ('new', 'changed')"))
    assert {r.nct_id: r._record_hash for r in followed.collect()} == want
    assert rows.count() == every.filter("nct_id is not null").count()
    kinds = {r["_change"]: r["count"] for r in rows.groupBy("_change").count().collect()}
    assert kinds["new"] == 3 and (kinds.get("late", 0) > 0) == (order != (0, 1, 2))
    assert len(list(itertools.chain(*DELIVERIES))) == rows.count() + 1


class _Store:
    """A bucket's list state that counts how often it is asked."""

    def __init__(self):
        self.rows, self.asked = [], 0

    def getListState(self, name, schema):  # noqa: N802
        return self

    def get(self):
        self.asked += 1
        return iter(list(self.rows))

    def put(self, rows):
        self.asked += 1
        self.rows = list(rows)

    def appendValue(self, row):  # noqa: N802
        self.asked += 1
        self.rows.append(row)


def test_a_bucket_of_many_keys_asks_the_state_twice_a_batch():
    store = _Store()
    held = {}
    for batch in range(12):
        # every third key, some with an older copy, some with the same, in two parts
        rows = [(f"NCT{k}", f"{(k * 7 + batch * 5) % 11:02d}", f"h{k % 2}{batch // 4}") for k in range(batch % 3, 400, 3)]
        want = []
        for key, rank, record_hash in sorted(rows, key=lambda r: r[1]):
            before = held.get(key)
            change = "new" if before is None else "late" if rank < before[0] else "repeated" if record_hash == before[1] else "changed"
            if change != "late":
                held[key] = (rank, record_hash)
            want.append((key, change))
        processor = _Newest(["nct_id"])
        processor.init(store)
        store.asked = 0
        frame = pd.DataFrame([(key, rank, record_hash, key, 5) for key, rank, record_hash in rows])
        parts = processor.handleInputRows((5,), iter([frame[:50].copy(), frame[50:].copy()]), None)
        found = pd.concat(list(parts))
        assert sorted(zip(found["nct_id"], found["_change"])) == sorted(want)
        assert store.asked <= 2
        assert sum(n for _, n in store.rows) <= 2 * len(held)
