"""Declarative rules: report, gate, quarantine, expectations, duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.fixed_values import ID_PREFIX, KNOWN_STATUSES

_STATUS_LIST = ", ".join(f"'{s}'" for s in KNOWN_STATUSES)


@dataclass(frozen=True)
class Rule:
    """``condition`` is SQL text; a row passes only where it is TRUE (not NULL)."""

    name: str
    condition: str
    critical: bool
    reason: str = ""

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


# Rule names, severities and the conditions behind them.
ID_PRESENT = "nct_id is not null"
ID_FORMAT = f"nct_id like '{ID_PREFIX}%'"
TITLE_PRESENT = "brief_title is not null"
TITLE_LONG_ENOUGH = "brief_title is not null and length(brief_title) > 5"
STATUS_KNOWN = f"overall_status in ({_STATUS_LIST})"
ENROLLMENT_SIGN = "enrollment_count is null or enrollment_count >= 0"
DATES_IN_ORDER = "start_date is null or completion_date is null or completion_date >= start_date"

SILVER_RULES = (
    Rule("nct_id_not_null", ID_PRESENT, True, "records are joined and merged on the id"),
    Rule("nct_id_format_valid", ID_FORMAT, True, "an id without the registry prefix is damaged"),
    Rule("brief_title_not_null", TITLE_LONG_ENOUGH, True, "records are shown and searched by title"),
    Rule("status_is_known", STATUS_KNOWN, False, "a new status needs a decision"),
    Rule("enrollment_non_negative", ENROLLMENT_SIGN, False, "a head count has no sign"),
    Rule("completion_after_start", DATES_IN_ORDER, False, "reversed dates point to bad parsing"),
)

COMPACT_RULES = (
    Rule("nct_id_not_null", ID_PRESENT, True),
    Rule("nct_id_format", ID_FORMAT, True),
    Rule("title_not_null", TITLE_PRESENT, True),
    Rule("enrollment_positive", ENROLLMENT_SIGN, False),
    Rule("valid_status", STATUS_KNOWN, False),
)

STREAM_DROP_RULES = (
    Rule("valid_nct_id", f"{ID_PRESENT} and {ID_FORMAT}", True),
    Rule("has_title", TITLE_LONG_ENOUGH, True),
)
STREAM_WARN_RULES = (Rule("positive_enrollment", ENROLLMENT_SIGN, False),)


class QualityGateError(ValueError):
    """A critical rule has failing rows; nothing was written."""


def run_rules(df: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    """One row per rule, from a single pass over the frame."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(r.holds).alias(f"pass_{i}") for i, r in enumerate(rules)],
    )
    rows = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.critical).alias("is_critical"),
            F.col(f"pass_{i}").alias("passing_rows"),
            F.lit(r.reason).alias("reason"),
        )
        for i, r in enumerate(rules)
    ]
    failing = F.col("total") - F.col("r.passing_rows")
    return counts.select("total", F.explode(F.array(*rows)).alias("r")).select(
        "r.rule",
        (failing == 0).alias("passed"),
        "r.is_critical",
        "r.passing_rows",
        failing.alias("failing_rows"),
        F.coalesce(
            F.round(F.try_divide(F.col("r.passing_rows"), F.col("total")) * 100, 2), F.lit(0.0)
        ).alias("pass_rate"),
        "r.reason",
    )


def gate(report: DataFrame) -> None:
    """Raise if a critical rule failed. Reads one row per rule, never the data."""
    broken = report.filter("is_critical and not passed").select("rule", "failing_rows").collect()
    if broken:
        raise QualityGateError(
            "critical rules failed: " + ", ".join(f"{r.rule} ({r.failing_rows} rows)" for r in broken)
        )


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks."""
    return F.array_compact(F.array(*[F.when(~r.holds, F.lit(r.name)) for r in rules]))


def quarantine(
    df: DataFrame, rules: Sequence[Rule] = SILVER_RULES, critical_only: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(kept rows, set-aside rows with ``failed_rules``); together they are the input."""
    used = [r for r in rules if r.critical or not critical_only]
    marked = df.withColumn("failed_rules", failed_rules(used))
    kept = marked.filter(F.size("failed_rules") == 0).drop("failed_rules")
    return kept, marked.filter(F.size("failed_rules") > 0)


def expect(
    df: DataFrame,
    drop: Sequence[Rule] = STREAM_DROP_RULES,
    warn: Sequence[Rule] = STREAM_WARN_RULES,
    observation: Observation | str | None = None,
) -> DataFrame:
    """Drop rows that break a ``drop`` rule; count failures of all rules on the way.

    The counts ride along with the query through ``observe`` (batch: give an
    ``Observation``; stream: give a name and read it from the query progress).
    """
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            *[F.count_if(~r.holds).alias(f"failed_{r.name}") for r in (*drop, *warn)],
        )
    for r in drop:
        df = df.filter(r.condition)
    return df


def duplicate_count(df: DataFrame, key: str = "nct_id") -> DataFrame:
    """Rows minus distinct keys, where a missing key counts as one key."""
    return df.agg(
        (
            F.count(F.lit(1))
            - F.count_distinct(F.col(key))
            - F.coalesce(F.max(F.col(key).isNull().cast("bigint")), F.lit(0))
        ).alias("duplicates")
    )


def raw_validation(df: DataFrame, key: str = "nct_id", prefix: str = ID_PREFIX) -> DataFrame:
    """Rows, columns, missing keys and keys without the prefix, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_if(~F.col(key).startswith(prefix)).alias("malformed_keys"),
    )
