"""Summaries kept up to date by a change feed instead of a recount.

A summary's state has a row for each group, or for each group and party whose distinct number
is wanted: how many records there are, and of each measure its total and how many records have
it. Records before a change are taken off and records after it are added, so a state row can
also shrink, and goes when nothing is left in it; a party stops counting with its last record.
All parts are whole numbers, so the result is that of a recount, in any order of changes.

The state is a bucketed snapshot (``sinks.snapshots``): a feed rewrites only the buckets of the
groups that it changes. Each version says which version of the records it stands for, so a feed
that is delivered again is not added twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import percent_of
from ledgerloom.operators.gold import explode_labels
from ledgerloom.session import stored
from ledgerloom.sinks.snapshots import read_snapshot, update_snapshot, versions, write_snapshot

SIGN = "_sign"
GROUP = "_group"


@dataclass(frozen=True)
class Summary:
    """What a summary groups by, counts and adds up.

    ``prepare`` maps records to the rows that are grouped (keeping further columns), ``measures``
    are whole-number columns, ``flags`` map outputs to boolean columns, ``distinct`` is the
    party whose distinct number is wanted, ``finish`` makes the output columns from ``n``,
    ``<measure>_total``, ``<measure>_n``, ``<flag>`` and ``parties``.
    """

    keys: tuple[str, ...]
    finish: Callable[[DataFrame], DataFrame]
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df
    measures: tuple[str, ...] = ()
    flags: Mapping[str, str] = field(default_factory=dict)
    distinct: str | None = None

    @property
    def row_key(self) -> tuple[str, ...]:
        return self.keys + ((self.distinct,) if self.distinct else ())

    @property
    def parts(self) -> tuple[str, ...]:
        return ("n", *(f"{m}{end}" for m in self.measures for end in ("_total", "_n")), *self.flags)


def _signed(df: DataFrame, summary: Summary) -> DataFrame:
    """State rows of records with a sign."""
    sign = F.col(SIGN)
    sums = {"n": sign}
    for m in summary.measures:
        sums[f"{m}_total"] = F.coalesce(F.col(m).cast("bigint"), F.lit(0)) * sign
        sums[f"{m}_n"] = F.when(F.col(m).isNotNull(), sign).otherwise(0)
    for name, c in summary.flags.items():
        sums[name] = F.when(F.col(c), sign).otherwise(0)
    rows = summary.prepare(df)
    return rows.groupBy(*summary.row_key).agg(*[F.sum(x).cast("bigint").alias(name) for name, x in sums.items()])


def state_of(df: DataFrame, summary: Summary) -> DataFrame:
    """The state of a summary of all records of ``df``."""
    return _signed(df.withColumn(SIGN, F.lit(1)), summary)


def state_change(feed: DataFrame, summary: Summary) -> DataFrame:
    """What a change feed adds to the state; rows that come to nothing are left out."""
    sign = F.when(F.col("_change_type").isin("update_preimage", "delete"), -1).otherwise(1)
    change = _signed(feed.withColumn(SIGN, sign), summary)
    moved = [F.col(p) != 0 for p in summary.parts]
    any_moved: Column = moved[0]
    for m in moved[1:]:
        any_moved = any_moved | m
    return change.filter(any_moved)


def add_change(state: DataFrame, change: DataFrame, summary: Summary) -> DataFrame:
    """The state after a change."""
    both = state.select(*summary.row_key, *summary.parts).unionByName(change.select(*summary.row_key, *summary.parts))
    summed = both.groupBy(*summary.row_key).agg(*[F.sum(p).alias(p) for p in summary.parts])
    return summed.filter("n <> 0")


def summarise(state: DataFrame, summary: Summary) -> DataFrame:
    """The summary's output rows."""
    sums = [F.sum(p).alias(p) for p in summary.parts]
    if summary.distinct:
        sums.append(F.count(summary.distinct).alias("parties"))
    return summary.finish(state.groupBy(*summary.keys).agg(*sums))


def _keyed(state: DataFrame, summary: Summary) -> DataFrame:
    return state.withColumn(GROUP, F.xxhash64(*summary.row_key))


def start_state(records: DataFrame, summary: Summary, base: str, version: int = 1) -> None:
    """Writes the state of all records as the first version."""
    write_snapshot(_keyed(state_of(records, summary), summary), base, version, GROUP)


def update_state(spark: SparkSession, feed: DataFrame, summary: Summary, base: str, version: int) -> bool:
    """Adds the feed that leads to ``version`` of the records; False if that is done already."""
    known = versions(spark, base)
    if not known:
        raise FileNotFoundError(f"no state at {base}; start_state makes one")
    if version <= known[-1]:
        return False

    def merge(state: DataFrame, change: DataFrame) -> DataFrame:
        return _keyed(add_change(state, change, summary), summary)

    # read for its buckets and by the merge
    with stored(_keyed(state_change(feed, summary), summary), "summary-change") as change:
        update_snapshot(spark, base, known[-1], version, change, merge, GROUP)
    return True


def read_summary(spark: SparkSession, summary: Summary, base: str, version: int | None = None) -> DataFrame | None:
    state = read_snapshot(spark, base, version)
    return None if state is None else summarise(state, summary)


# -- the summaries of clean records ---------------------------------------------------


def _total(c: str) -> Column:
    """The sum of a measure; NULL where no record has it."""
    return F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_total"))


def _average(c: str) -> Column:
    return F.when(F.col(f"{c}_n") > 0, F.round(F.col(f"{c}_total") / F.col(f"{c}_n"), 0))


def _status(df: DataFrame) -> DataFrame:
    return df.select(
        "overall_status", "phase", "study_type",
        F.col("n").alias("trial_count"),
        _average("enrollment_count").alias("avg_enrollment"),
        _total("enrollment_count").alias("total_enrollment"),
        F.col("parties").alias("unique_sponsors"),
        F.col("duration_days_n").alias("trials_with_duration"),
        _average("duration_days").alias("avg_duration_days"),
    )


def _board(df: DataFrame) -> DataFrame:
    board = df.select(
        "lead_sponsor",
        F.col("n").alias("total_trials"),
        "recruiting_trials", "completed_trials", "interventional_trials",
        _total("enrollment_count").alias("total_enrollment"),
        _average("enrollment_count").alias("avg_enrollment_per_trial"),
    )
    return board.withColumn("completion_rate", percent_of("completed_trials", "total_trials"))


def _conditions(df: DataFrame) -> DataFrame:
    return df.select(
        "condition",
        F.col("n").alias("trial_count"),
        "recruiting_now",
        _total("enrollment_count").alias("total_patients_enrolled"),
        _average("enrollment_count").alias("avg_enrollment"),
    )


def _years(df: DataFrame) -> DataFrame:
    return df.select(
        "start_year",
        F.col("n").alias("trials_started"),
        "interventional_trials",
        _total("enrollment_count").alias("total_enrollment"),
        _average("enrollment_count").alias("avg_enrollment"),
    )


def _kpis(df: DataFrame) -> DataFrame:
    out = df.select(
        F.coalesce("n", F.lit(0)).alias("total_trials"),
        F.coalesce("recruiting_now", F.lit(0)).alias("recruiting_now"),
        F.coalesce("completed_trials", F.lit(0)).alias("completed_trials"),
        F.coalesce("enrollment_count_total", F.lit(0)).alias("total_enrollment"),
        F.col("parties").alias("unique_sponsors"),
        F.coalesce(F.col("duration_days_total") / F.nullif(F.col("duration_days_n"), F.lit(0)), F.lit(0)).cast("bigint").alias("avg_duration"),
    )
    return out.withColumns({"recruitment_rate": percent_of("recruiting_now", "total_trials"), "completion_rate": percent_of("completed_trials", "total_trials")})


def _started(first: int, last: int) -> Callable[[DataFrame], DataFrame]:
    def prepare(df: DataFrame) -> DataFrame:
        return df.withColumn("start_year", F.year("start_date")).filter(F.col("start_year").between(first, last))

    return prepare


STATUS = Summary(("overall_status", "phase", "study_type"), _status, measures=("enrollment_count", "duration_days"), distinct="lead_sponsor")
BOARD = Summary(
    ("lead_sponsor",), _board, lambda df: df.filter("lead_sponsor is not null"), ("enrollment_count",),
    {"recruiting_trials": "is_recruiting", "completed_trials": "is_completed", "interventional_trials": "is_interventional"},
)
CONDITIONS = Summary(("condition",), _conditions, explode_labels, ("enrollment_count",), {"recruiting_now": "is_recruiting"})


def years(first: int = 2000, last: int = 2025) -> Summary:
    return Summary(("start_year",), _years, _started(first, last), ("enrollment_count",), {"interventional_trials": "is_interventional"})


YEARS = years()
KPIS = Summary(
    (), _kpis, lambda df: df.withColumn("lead_sponsor", F.nullif(F.trim("lead_sponsor"), F.lit(""))), ("enrollment_count", "duration_days"),
    {"recruiting_now": "is_recruiting", "completed_trials": "is_completed"}, "lead_sponsor",
)

SUMMARIES: Mapping[str, Summary] = {"trial_status_summary": STATUS, "sponsor_leaderboard": BOARD, "condition_analytics": CONDITIONS, "yearly_trend": YEARS, "platform_kpis": KPIS}


def start_all(records: DataFrame, base: str, version: int = 1, names: Sequence[str] = tuple(SUMMARIES)) -> None:
    for name in names:
        start_state(records, SUMMARIES[name], f"{base}/{name}", version)


def update_all(spark: SparkSession, feed: DataFrame, base: str, version: int, names: Sequence[str] = tuple(SUMMARIES)) -> dict[str, bool]:
    """Adds a stored feed to every summary; those that have it already are left as they are."""
    return {name: update_state(spark, feed, SUMMARIES[name], f"{base}/{name}", version) for name in names}
