"""Summary tables and KPIs. Results are unordered; the ``report_*`` readers sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import label_or_unknown, percent_of


def _rows() -> Column:
    return F.count(F.lit(1))


def value_profile(
    df: DataFrame, column: str, keep_null: bool = True, count_name: str = "count"
) -> DataFrame:
    """Rows per value of one column."""
    if not keep_null:
        df = df.filter(F.col(column).isNotNull())
    return df.groupBy(column).agg(_rows().alias(count_name))


def value_profiles(
    df: DataFrame, columns: Mapping[str, bool], count_name: str = "count"
) -> DataFrame:
    """(column_name, value, count) of several text columns in one pass.

    ``columns``: name to whether missing values count as a value.
    """
    cells = [
        F.when(F.lit(keep_null) | F.col(c).isNotNull(), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
        for c, keep_null in columns.items()
    ]
    each = df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
    return each.groupBy("cell.column_name", "cell.value").agg(_rows().alias(count_name))


def distribution(
    df: DataFrame, column: str, unknown: str | None = None, count_name: str = "count"
) -> DataFrame:
    """Rows per label for a chart: missing labels left out, or named by ``unknown``."""
    if unknown is None:
        return value_profile(df, column, keep_null=False, count_name=count_name)
    return value_profile(
        df.select(label_or_unknown(column, unknown).alias(column)), column, count_name=count_name
    )


def top_n(
    df: DataFrame, measure: str, n: int | None = None, ties: Sequence[str] = (), ascending: bool = False
) -> DataFrame:
    """Sorted by a measure, ties by the given columns; the first ``n`` if given."""
    lead = F.col(measure).asc_nulls_last() if ascending else F.col(measure).desc_nulls_last()
    ordered = df.orderBy(lead, *[F.col(c).asc_nulls_first() for c in ties])
    return ordered if n is None else ordered.limit(n)


def status_summary(
    df: DataFrame,
    keys: Sequence[str] = ("overall_status", "phase", "study_type"),
    amount: str = "enrollment_count",
    party: str = "lead_sponsor",
    duration: str | None = "duration_days",
    rounded: bool = True,
) -> DataFrame:
    """Counts, enrollment and sponsors per group; with durations unless None."""
    measures: dict[str, Column] = {
        "trial_count": _rows(),
        "avg_enrollment": F.avg(amount),
        "total_enrollment": F.sum(amount),
        "unique_sponsors": F.count_distinct(F.col(party)),
    }
    if duration is not None:
        measures["trials_with_duration"] = F.count(duration)
        measures["avg_duration_days"] = F.avg(duration)
    if rounded:
        measures = {n: F.round(m, 0) if n.startswith("avg_") else m for n, m in measures.items()}
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])


def status_rollup(summary: DataFrame, key: str = "overall_status") -> DataFrame:
    """Totals per status from the status summary."""
    return summary.groupBy(key).agg(F.sum("trial_count").alias("total"))


def leaderboard(
    df: DataFrame,
    party: str = "lead_sponsor",
    amount: str = "enrollment_count",
    flags: Mapping[str, str] | None = None,
    detailed: bool = True,
) -> DataFrame:
    """Totals per sponsor. ``flags`` maps output counts to boolean columns."""
    if flags is None:
        flags = {
            "recruiting_trials": "is_recruiting",
            "completed_trials": "is_completed",
            "interventional_trials": "is_interventional",
        }
    measures = {
        "total_trials": _rows(),
        **{n: F.count_if(F.col(c)) for n, c in flags.items()},
        "total_enrollment": F.sum(amount),
    }
    if detailed:
        measures["avg_enrollment_per_trial"] = F.round(F.avg(amount), 0)
    out = (
        df.filter(F.col(party).isNotNull())
        .groupBy(party)
        .agg(*[m.alias(n) for n, m in measures.items()])
    )
    if detailed:
        out = out.withColumn("completion_rate", percent_of("completed_trials", "total_trials"))
    return out


STREAM_LEADERBOARD_FLAGS = {"active_trials": "is_recruiting", "completed_trials": "is_completed"}


def active_sponsors(df: DataFrame, n: int = 10, party: str = "lead_sponsor") -> DataFrame:
    """Sponsors with the most records, and how many of theirs are recruiting."""
    counts = (
        df.filter(F.col(party).isNotNull())
        .groupBy(party)
        .agg(_rows().alias("total_trials"), F.count_if("is_recruiting").alias("active_trials"))
    )
    return top_n(counts, "total_trials", n, ties=[party])


def explode_labels(
    df: DataFrame,
    labels: str = "conditions",
    label: str = "condition",
    min_length: int = 3,
    distinct_labels: bool = False,
    sep: str = ", ",
) -> DataFrame:
    """One row per label of a record, from an array column or a joined text."""
    values = F.col(labels)
    if dict(df.dtypes)[labels] == "string":
        values = F.split(values, sep)
    values = F.transform(values, lambda v: F.trim(v))
    if distinct_labels:
        values = F.array_distinct(values)
    return df.withColumn(label, F.explode(values)).filter(F.length(label) >= min_length)


def exploded_analytics(
    df: DataFrame,
    labels: str = "conditions",
    label: str = "condition",
    amount: str = "enrollment_count",
    distinct_labels: bool = False,
) -> DataFrame:
    """Totals per label. A record counts once under each of its labels, so the
    totals of different labels must not be added up."""
    return (
        explode_labels(df, labels, label, distinct_labels=distinct_labels)
        .groupBy(label)
        .agg(
            _rows().alias("trial_count"),
            F.count_if("is_recruiting").alias("recruiting_now"),
            F.sum(amount).alias("total_patients_enrolled"),
            F.round(F.avg(amount), 0).alias("avg_enrollment"),
        )
    )


def yearly_trend(
    df: DataFrame,
    date: str = "start_date",
    amount: str = "enrollment_count",
    first_year: int = 2000,
    last_year: int = 2025,
) -> DataFrame:
    """Totals per start year. The year bounds become a date range for the scan."""
    in_range = F.col(date).between(
        F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
        F.make_date(F.lit(last_year), F.lit(12), F.lit(31)),
    )
    return (
        df.filter(in_range)
        .groupBy(F.year(date).alias("start_year"))
        .agg(
            _rows().alias("trials_started"),
            F.count_if("is_interventional").alias("interventional_trials"),
            F.sum(amount).alias("total_enrollment"),
            F.round(F.avg(amount), 0).alias("avg_enrollment"),
        )
    )


def kpis(
    df: DataFrame,
    party: str = "lead_sponsor",
    amount: str = "enrollment_count",
    count_null: bool = False,
) -> DataFrame:
    """One row of headline numbers from one pass.

    ``count_null=True`` counts a missing sponsor, and a blank one, as sponsors.
    """
    if count_null:
        sponsors = F.count_distinct(F.col(party)) + F.coalesce(
            F.max(F.col(party).isNull().cast("bigint")), F.lit(0)
        )
    else:
        sponsors = F.count_distinct(F.nullif(F.trim(F.col(party)), F.lit("")))
    return df.agg(
        _rows().alias("total_trials"),
        F.count_if("is_recruiting").alias("recruiting_now"),
        F.count_if("is_completed").alias("completed_trials"),
        F.coalesce(F.sum(amount), F.lit(0)).alias("total_enrollment"),
        sponsors.alias("unique_sponsors"),
        F.coalesce(F.avg("duration_days"), F.lit(0.0)).alias("avg_duration"),
    ).withColumns(
        {
            "avg_duration": F.col("avg_duration").cast("bigint"),
            "recruitment_rate": percent_of("recruiting_now", "total_trials"),
            "completion_rate": percent_of("completed_trials", "total_trials"),
        }
    )


def dashboard_kpis(
    df: DataFrame, party: str = "lead_sponsor", amount: str = "enrollment_count"
) -> DataFrame:
    return kpis(df, party, amount).select(
        "total_trials",
        "recruiting_now",
        "recruitment_rate",
        "completed_trials",
        "completion_rate",
        "unique_sponsors",
        "total_enrollment",
    )


def silver_counts(df: DataFrame) -> DataFrame:
    """Totals of the clean table, with the records that were ever updated."""
    return df.agg(
        _rows().alias("total_trials"),
        F.count_if("is_recruiting").alias("recruiting"),
        F.count_if("is_completed").alias("completed"),
        F.count_if("is_interventional").alias("interventional"),
        F.count_if(F.col("_update_count") > 0).alias("updated"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for several tables in one query."""
    parts = [
        t.agg(_rows().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, t in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def stamped(df: DataFrame, ts: Column | str, name: str = "_gold_updated_at") -> DataFrame:
    """Adds the refresh time, given from outside."""
    return df.withColumn(name, F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts)
