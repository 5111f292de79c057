"""Summaries kept up to date against recounts."""

from __future__ import annotations

import itertools
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cdc, gold, incremental

COLUMNS = "nct_id string, overall_status string, phase string, study_type string, conditions string, lead_sponsor string, enrollment_count long, duration_days int, start_date date, is_recruiting boolean, is_completed boolean, is_interventional boolean, _record_hash string, _silver_created_at string, _silver_updated_at string, _update_count int"


def _records(spark, rows):
    """(number, status, sponsor, amount, conditions, year)"""
    full = [
        (f"NCT{i:08d}", status, "P1" if i % 2 else None, "T", conditions, sponsor, amount, None if amount is None else amount * 2, None, status == "R", status == "C", i % 3 == 0, f"{status}{sponsor}{amount}{conditions}{year}", "t", "t", 0, year)
        for i, status, sponsor, amount, conditions, year in rows
    ]
    df = spark.createDataFrame(full, COLUMNS + ", y int")
    return df.withColumn("start_date", F.make_date("y", F.lit(3), F.lit(1))).drop("y")


FIRST = [(1, "R", "A", 10, "flu, cold", 2001), (2, "R", "A", 5, "flu", 2001), (3, "C", "B", None, None, 2002), (4, None, None, 7, "cold, cold", 1990), (5, "C", "C", -3, "gout", 2002)]
SECOND = [(1, "C", "B", 11, "flu", 2001), (2, "R", None, 5, "flu", 2003), (3, "C", "B", 4, "gout, flu", None), (4, None, None, 7, "cold, cold", 1990), (6, "R", "D", 1, "rare", 2025)]
THIRD = [(5, "R", "A", None, None, None), (6, "C", "D", 1, "rare", 2025), (7, "R", "E", 2, "flu", 2000)]

RECOUNTS = {
    "trial_status_summary": gold.status_summary,
    "sponsor_leaderboard": gold.leaderboard,
    "condition_analytics": gold.exploded_analytics,
    "yearly_trend": gold.yearly_trend,
    "platform_kpis": gold.kpis,
}


def _rows(df):
    return sorted((tuple(sorted((k, None if v is None else float(v) if isinstance(v, (int, float)) else v) for k, v in r.asDict().items())) for r in df.collect()), key=str)


def _files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("data/**/*.parquet")}


@pytest.mark.parametrize("name", sorted(RECOUNTS))
def test_equal_to_a_recount_after_every_load(spark, tmp_path, name):
    base, summary = str(tmp_path), incremental.SUMMARIES[name]
    table = _records(spark, FIRST)
    incremental.start_state(table, summary, base)
    assert _rows(incremental.read_summary(spark, summary, base)) == _rows(RECOUNTS[name](table))
    for version, rows in enumerate((SECOND, THIRD, SECOND), 2):
        delta = _records(spark, rows)
        pairs = cdc.pair_changes(table, delta)
        feed = cdc.change_feed(pairs, table.columns)
        assert incremental.update_state(spark, feed, summary, base, version)
        # the same feed once more changes nothing
        assert not incremental.update_state(spark, feed, summary, base, version)
        table = spark.createDataFrame(cdc.merge_changes(table, delta).collect(), table.schema)
        assert _rows(incremental.read_summary(spark, summary, base)) == _rows(RECOUNTS[name](table))
    assert _rows(incremental.read_summary(spark, summary, base, 1)) == _rows(RECOUNTS[name](_records(spark, FIRST)))


def test_only_changed_groups_are_written(spark, tmp_path):
    base, summary = str(tmp_path), incremental.BOARD
    table = _records(spark, [(i, "R", f"sponsor {i}", i, None, 2001) for i in range(200)])
    incremental.start_state(table, summary, base)
    before = _files(base)
    delta = _records(spark, [(7, "C", "sponsor 7", 7, None, 2001)])
    incremental.update_state(spark, cdc.change_feed(cdc.pair_changes(table, delta), table.columns), summary, base, 2)
    added = _files(base) - before
    assert before <= _files(base) and len(added) == 1
    assert incremental.read_summary(spark, summary, base).filter("completed_trials = 1").count() == 1


def test_any_order_of_changes(spark):
    """Retractions may come before what they take off."""
    summary = incremental.STATUS
    table = _records(spark, FIRST)
    feeds, now = [], table
    for rows in (SECOND, THIRD):
        delta = _records(spark, rows)
        feeds.append(incremental.state_change(cdc.change_feed(cdc.pair_changes(now, delta), now.columns), summary))
        now = spark.createDataFrame(cdc.merge_changes(now, delta).collect(), now.schema)
    states = []
    for order in itertools.permutations(feeds):
        state = incremental.state_of(table, summary)
        for change in order:
            state = incremental.add_change(state, change, summary)
        states.append(_rows(incremental.summarise(state, summary)))
    assert states[0] == states[1] == _rows(gold.status_summary(now))


def test_a_state_has_to_be_started(spark, tmp_path):
    feed = _records(spark, FIRST).withColumn("_change_type", F.lit("insert"))
    with pytest.raises(FileNotFoundError):
        incremental.update_state(spark, feed, incremental.KPIS, str(tmp_path), 2)
    empty = _records(spark, [])
    incremental.start_state(empty, incremental.KPIS, str(tmp_path))
    assert incremental.update_state(spark, feed, incremental.KPIS, str(tmp_path), 2)
    assert _rows(incremental.read_summary(spark, incremental.KPIS, str(tmp_path))) == _rows(gold.kpis(_records(spark, FIRST)))
