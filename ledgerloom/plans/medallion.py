"""Raw table to clean table to summaries, as one load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import gold
from ledgerloom.operators.cdc import ACTIONS, apply_pairs, chosen_strategy, merge_stats, pair_changes, with_order
from ledgerloom.operators.dedupe import dedupe_latest
from ledgerloom.operators.normalise import normalise
from ledgerloom.operators.quality import SILVER_RULES, Rule, gate, run_rules
from ledgerloom.session import written
from ledgerloom.sinks.snapshots import stored_delta, update_snapshot, versions, with_retries, write_snapshot
from ledgerloom.sinks.tables import refresh_table, table_counts


@dataclass(frozen=True)
class LoadResult:
    version: int
    report: DataFrame
    stats: DataFrame | None


def load_silver(
    bronze: DataFrame,
    base: str,
    run_ts: str,
    rules: Sequence[Rule] = SILVER_RULES,
    update_columns: Sequence[str] | None = None,
    order_by: str | None = "ingestion_ts",
    key: str = "nct_id",
    strategy: str = "auto",
) -> LoadResult:
    """Clean, check, keep the newest copies, then create or merge the silver table.

    ``bronze`` is a stored table, or its arrivals since the last load (``sinks.bronze.since``):
    the rule check reads the few columns it needs, then the newest copies are written once,
    to be measured and merged from there. A critical failure raises before anything is
    written. ``order_by`` is kept in the table and guards it against late deliveries.
    Only the buckets of the keys that were delivered are rewritten.
    """
    spark = bronze.sparkSession
    clean = normalise(bronze, run_ts, carry=("ingestion_ts",))
    report = run_rules(clean, rules)
    gate(report)
    newest = dedupe_latest(clean, key)
    if order_by != "ingestion_ts":
        newest = newest.drop("ingestion_ts")
    known = versions(spark, base)
    if not known:
        write_snapshot(newest, base, 1, key, dealt=True)
        return LoadResult(1, report, None)
    counted: list[Observation | DataFrame] = []

    with stored_delta(newest, key) as delta:
        strategy = chosen_strategy(strategy, delta)

        def merge(target: DataFrame, delta: DataFrame) -> DataFrame:
            target, delta = with_order(target, delta, order_by)
            pairs = pair_changes(target, delta, key, order_by, strategy)
            merged = apply_pairs(pairs, target.columns, key, update_columns, keep_action=True, order_by=order_by)
            if strategy == "shuffle":
                # counted as they are written, where the join has dealt them
                counted.append(Observation())
                return merged.observe(counted[-1], *[F.count_if(F.col("action") == a).alias(a) for a in ACTIONS]).drop("action")
            # stored once with its actions: the counts and the table come from there
            counted.append(written(merged, "merged"))
            return counted[-1].drop("action")

        def update() -> None:
            counted.clear()
            last = versions(spark, base)[-1]
            update_snapshot(spark, base, last, last + 1, delta, merge, key, dealt=strategy == "shuffle")
            done.append(last + 1)

        done: list[int] = []
        with_retries(update)
    # of the buckets that were touched; the records of the others were not delivered
    return LoadResult(done[0], report, _action_counts(spark, counted))


def _action_counts(spark: SparkSession, counted: Sequence[Observation | DataFrame]) -> DataFrame:
    """Rows per action, over the rounds of a merge."""
    if isinstance(counted[0], DataFrame):
        return merge_stats(reduce(DataFrame.unionByName, counted))
    seen = [c.get for c in counted]
    totals = {a: sum(found.get(a) or 0 for found in seen) for a in ACTIONS}
    return spark.createDataFrame([x for x in totals.items() if x[1]], "action string, row_count bigint")


GOLD_TABLES = {
    "trial_status_summary": gold.status_summary,
    "sponsor_leaderboard": gold.leaderboard,
    "condition_analytics": gold.exploded_analytics,
    "yearly_trend": gold.yearly_trend,
}


def refresh_gold(
    spark: SparkSession, silver: DataFrame, base: str, run_ts: str
) -> DataFrame:
    """Rewrites the four summary tables and returns their row counts."""
    for name, build in GOLD_TABLES.items():
        refresh_table(gold.stamped(build(silver), run_ts), f"{base}/{name}")
    return table_counts(spark, {name: f"{base}/{name}" for name in GOLD_TABLES})
