"""Registered queries over batch operators. Dates leave as text, for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path, written
from ledgerloom.contract.views import (
    DAY_1,
    DAY_2,
    raw_days,
    silver_days,
    silver_view,
    trial_view,
)
from ledgerloom.fixed_values import (
    NARROW_UPDATE_COLUMNS,
    SILVER_COLUMNS,
    WIDE_UPDATE_COLUMNS,
)
from ledgerloom.functions import clipped, fingerprint
from ledgerloom.operators import cdc, gold, incremental, keywords, quality, search, sketches, trigrams
from ledgerloom.operators.dedupe import dedupe_latest
from ledgerloom.operators.normalise import normalise, normalise_stream, unparsed_counts
from ledgerloom.operators.sizing import fits_broadcast

Query = Callable[[SparkSession, str], DataFrame]

DATES = ("start_date", "completion_date", "last_update_date")


def as_text(df: DataFrame) -> DataFrame:
    """Dates as text; audit times as the day they fall on."""
    changes = {c: F.col(c).cast("string") for c in DATES if c in df.columns}
    for old, new in (("_silver_created_at", "created_on"), ("_silver_updated_at", "updated_on")):
        if old in df.columns:
            changes[new] = F.to_date(old).cast("string")
    return df.withColumns(changes).drop("_silver_created_at", "_silver_updated_at")


# -- normalise ------------------------------------------------------------------------


def silver_normalise(spark, d):
    return as_text(silver_view(spark, d))


def record_fingerprint(spark, d):
    silver = silver_view(spark, d, conditions=False, summary=False)
    four = ("nct_id", "overall_status", "enrollment_count", "completion_date")
    five = (*four, "lead_sponsor")
    return silver.select(
        "nct_id",
        fingerprint(five).alias("hash_5"),
        fingerprint(four).alias("hash_4"),
        fingerprint(five, null_token="").alias("hash_5_null_kept"),
    )


def stream_columns(spark, d):
    out = normalise_stream(trial_view(spark, d), arrival_ts=F.lit(DAY_2).cast("timestamp"))
    out = as_text(out)
    return out.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("ingestion_ts", "_silver_ts")}
    )


def unparsed_values(spark, d):
    return unparsed_counts(trial_view(spark, d, conditions=False, summary=False))


# -- summaries ------------------------------------------------------------------------


def value_profile(spark, d):
    raw = trial_view(spark, d, conditions=False, summary=False)
    return gold.value_profiles(
        raw, {"overall_status": True, "phase": True, "lead_sponsor": False}, count_name="row_count"
    )


def status_summary(spark, d):
    return gold.status_summary(silver_view(spark, d, conditions=False, summary=False))


def status_summary_plain(spark, d):
    return gold.status_summary(
        silver_view(spark, d, conditions=False, summary=False), duration=None, rounded=False
    )


def status_rollup(spark, d):
    rolled = gold.status_rollup(status_summary(spark, d))
    return gold.top_n(rolled, "total", ties=["overall_status"])


def sponsor_leaderboard(spark, d):
    board = gold.leaderboard(silver_view(spark, d, conditions=False, summary=False))
    return gold.top_n(board, "total_trials", ties=["lead_sponsor"])


def sponsor_leaderboard_plain(spark, d):
    return gold.leaderboard(
        silver_view(spark, d, conditions=False, summary=False),
        flags=gold.STREAM_LEADERBOARD_FLAGS,
        detailed=False,
    )


def active_sponsors(spark, d):
    return gold.active_sponsors(silver_view(spark, d, conditions=False, summary=False))


def condition_analytics(spark, d):
    return gold.exploded_analytics(silver_view(spark, d, summary=False))


def yearly_trend(spark, d):
    trend = gold.yearly_trend(
        silver_view(spark, d, conditions=False, summary=False), first_year=1996, last_year=2000
    )
    return gold.top_n(trend, "start_year", ascending=True)


def chart_sponsors(spark, d):
    board = gold.leaderboard(silver_view(spark, d, conditions=False, summary=False))
    return gold.top_n(board, "total_trials", 10, ["lead_sponsor"]).select(
        "lead_sponsor", "total_trials", "recruiting_trials", "completion_rate"
    )


def chart_conditions(spark, d):
    return gold.top_n(condition_analytics(spark, d), "trial_count", 15, ["condition"]).select(
        "condition", "trial_count", "recruiting_now"
    )


def platform_kpis(spark, d):
    silver = silver_view(spark, d, conditions=False, summary=False)
    return gold.kpis(silver)


def platform_kpis_null_sponsor(spark, d):
    silver = silver_view(spark, d, conditions=False, summary=False)
    return gold.kpis(silver, count_null=True)


def dashboard_kpis(spark, d):
    return gold.dashboard_kpis(silver_view(spark, d, conditions=False, summary=False))


def distributions(spark, d):
    silver = silver_view(spark, d, conditions=False, summary=False)
    charts = [
        ("status", "overall_status", None, 8),
        ("sponsor", "lead_sponsor", None, 10),
        ("phase", "phase", "Unknown", None),
    ]
    out = None
    for chart, column, unknown, n in charts:
        counts = gold.distribution(silver, column, unknown, "row_count")
        part = gold.top_n(counts, "row_count", n, [column]) if n else counts
        part = part.select(F.lit(chart).alias("chart"), F.col(column).alias("label"), "row_count")
        out = part if out is None else out.unionAll(part)
    return out


def silver_counts(spark, d):
    return gold.silver_counts(cdc_merge_frame(spark, d, conditions=False, summary=False))


# -- quality --------------------------------------------------------------------------


def rule_report(spark, d):
    report = quality.run_rules(silver_view(spark, d, conditions=False, summary=False))
    return report.drop("reason")


def dirty_silver(spark, d):
    """Clean records of which some lost their id, its form, their title, dates' order or sign."""
    key = F.substring("nct_id", 4, 8).cast("bigint")
    return silver_view(spark, d, conditions=False, summary=False).withColumns(
        {
            "nct_id": F.when(key % 17 == 0, None).when(key % 19 == 0, F.substring("nct_id", 4, 8)).otherwise(F.col("nct_id")),
            "brief_title": F.when(key % 23 == 0, "short").when(key % 29 == 0, None).otherwise(F.col("brief_title")),
            "completion_date": F.when(key % 31 == 0, F.date_sub("start_date", 1)).otherwise(F.col("completion_date")),
        }
    )


def rule_report_dirty(spark, d):
    return quality.run_rules(dirty_silver(spark, d)).drop("reason")


def expect_drop_dirty(spark, d):
    """The stream's own drop rules, on records that break them."""
    kept = quality.expect(dirty_silver(spark, d))
    return kept.select("nct_id", "brief_title", "overall_status")


def rule_report_alt(spark, d):
    silver = silver_view(spark, d, conditions=False, summary=False)
    return quality.run_rules(silver, quality.COMPACT_RULES).drop("reason")


def quarantine(spark, d):
    silver = silver_view(spark, d, conditions=False, summary=False)
    kept, aside = quality.quarantine(silver, critical_only=False)
    return aside.select(
        "nct_id", F.array_join("failed_rules", ",").alias("failed_rules")
    ).unionAll(kept.select("nct_id", F.lit("").alias("failed_rules")))


def expect_drop(spark, d):
    silver = silver_view(spark, d, conditions=False, summary=False)
    known = [r for r in quality.SILVER_RULES if r.name == "status_is_known"]
    kept = quality.expect(silver, drop=(*quality.STREAM_DROP_RULES, *known))
    return kept.select("nct_id", "overall_status", "enrollment_count")


def raw_validation(spark, d):
    raw = trial_view(spark, d, conditions=False, summary=False)
    # keys of the orders without an urgent priority lose their prefix, those of the
    # unspecified ones are missing
    key = (
        F.when(F.col("phase") == "PHASE1", F.col("nct_id"))
        .when(F.col("phase").isNull(), None)
        .otherwise(F.substring("nct_id", 4, 8))
    )
    return quality.raw_validation(raw.withColumn("nct_id", key))


def duplicate_count(spark, d):
    first, second = raw_days(spark, d, conditions=False, summary=False)
    return quality.duplicate_count(first.unionByName(second))


# -- dedupe and change capture --------------------------------------------------------


def dedupe_latest_query(spark, d):
    first, second = raw_days(spark, d)
    clean = normalise(first.unionByName(second), DAY_2, carry=("ingestion_ts",))
    return as_text(dedupe_latest(clean))


def cdc_merge_frame(spark, d, update_columns=None, **parts):
    target, delta = silver_days(spark, d, **parts)
    return cdc.merge_changes(target, delta, update_columns=update_columns)


def cdc_merge(spark, d):
    return as_text(cdc_merge_frame(spark, d))


def cdc_merge_wide(spark, d):
    return as_text(cdc_merge_frame(spark, d, WIDE_UPDATE_COLUMNS))


def cdc_merge_narrow(spark, d):
    return as_text(cdc_merge_frame(spark, d, NARROW_UPDATE_COLUMNS))


def cdc_change_feed(spark, d):
    target, delta = silver_days(spark, d)
    feed = cdc.change_feed(cdc.pair_changes(target, delta), SILVER_COLUMNS)
    return as_text(feed)


def cdc_merge_late(spark, d):
    """The first delivery, the same again two days on, then a changed one of the day between."""
    raw = written(raw_days(spark, d)[0], "first-delivery")
    small = fits_broadcast(normalise(raw, DAY_1, carry=("ingestion_ts",)))
    if not small:
        # dealt by key before the three are made of it, so merges need not deal each anew
        raw = raw.repartition("nct_id")
    late = raw.withColumn("overall_status", F.lit("withdrawn"))
    table = None
    for rows, day in ((raw, DAY_1), (raw, "2024-01-03 00:00:00"), (late, DAY_2)):
        arrived = rows.withColumn("ingestion_ts", F.lit(day))
        delta = normalise(arrived, day, carry=("ingestion_ts",))
        table = delta if table is None else cdc.merge_changes(table, delta, order_by="ingestion_ts", strategy="broadcast" if small else "shuffle")
    return as_text(table).withColumn("ingestion_ts", F.col("ingestion_ts").cast("string"))


def cdc_stats(spark, d):
    target, delta = silver_days(spark, d, conditions=False, summary=False)
    return cdc.merge_stats(cdc.pair_changes(target, delta))


def updated_rows(spark, d):
    return cdc.updated_rows(cdc_merge_frame(spark, d, conditions=False, summary=False))


# -- search without vectors -----------------------------------------------------------


def facet_search(spark, d):
    silver = silver_view(spark, d, summary=False)
    hits = search.facet_search(
        silver, {"overall_status": ["RECRUITING"], "phase": ["PHASE2", "PHASE3"]}, "widget"
    )
    return hits.select("nct_id", "brief_title", "overall_status", "phase", "conditions")


def keyword_search(spark, d):
    silver = silver_view(spark, d)
    return search.keyword_search(silver, "Red Widget").select("nct_id", "conditions")


def keyword_regex(spark, d):
    silver = silver_view(spark, d)
    return search.keyword_search(silver, "(red|blue) (widget|ring)", mode="regex").select(
        "nct_id", "conditions"
    )


def _by_index(spark, d, keyword, mode="literal"):
    base = scratch_path(spark, "trigrams")
    silver = silver_view(spark, d).select("nct_id", *search.TEXT_COLUMNS)
    trigrams.write_index(silver, base)
    return trigrams.index_search(spark, base, keyword, mode=mode).select("nct_id", "conditions")


def keyword_index(spark, d):
    """The rows of ``keyword_search``, by posting lists."""
    return _by_index(spark, d, "Red Widget")


def keyword_index_regex(spark, d):
    """The rows of ``keyword_regex``, by posting lists."""
    return _by_index(spark, d, "(red|blue) (widget|ring)", "regex")


def term_counts(spark, d):
    """Every occurrence of every part name, and of each of their words, in all texts of a record."""
    part = spark.read.parquet(f"{d}/part.parquet").select("p_name")
    words = part.select(F.explode(F.split("p_name", " ")).alias("term"))
    terms = part.select(F.col("p_name").alias("term")).union(words)
    places = [spark.read.parquet(f"{d}/{t}.parquet").select(F.col(c).alias("term")) for t, c in (("nation", "n_name"), ("region", "r_name"))]
    return keywords.count_terms(silver_view(spark, d), terms.union(places[0]).union(places[1]))


def condition_labels(spark, d):
    """Records per label, from joined texts whose labels have commas inside."""
    part = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.concat("p_name", F.lit(", type "), F.col("p_partkey") % 3).alias("label"))
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_partkey")
    per_order = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("label")), ", ").alias("conditions"))
    cut = keywords.split_known(per_order, part)
    return cut.select(F.explode("label_list").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("trial_count"))


def summary_preview(spark, d):
    """Summaries cut at load, NULL as an empty text."""
    return silver_view(spark, d).select("nct_id", clipped("brief_summary", 300).alias("summary"))


def keyword_fallback(spark, d):
    silver = silver_view(spark, d)
    out = None
    for name, question in (("hit", "red widget"), ("miss", "no such words anywhere")):
        part = search.keyword_or_all(silver, question).select(
            F.lit(name).alias("question"), "nct_id", "brief_title"
        )
        out = part if out is None else out.unionAll(part)
    return out


def any_keyword(spark, d):
    return search.any_keyword(silver_view(spark, d, conditions=False), ["the", "license"]).select(
        "nct_id", "brief_title", "overall_status"
    )


def facet_values(spark, d):
    silver = silver_view(spark, d, conditions=False, summary=False)
    return search.facet_values(silver, "overall_status")


def display_cards(spark, d):
    return search.display_cards(silver_view(spark, d))


def listing_page(spark, d):
    hits = search.facet_search(silver_view(spark, d), keyword="gear")
    return search.display_cards(search.first_rows(hits, 20))


# -- summaries kept up to date ----------------------------------------------------------


def _kept_up(spark, d, summary):
    """The summary of the first delivery, brought up to date by the second one's change feed."""
    target, delta = silver_days(spark, d)
    feed = written(cdc.change_feed(cdc.pair_changes(target, delta), SILVER_COLUMNS), "feed")
    base = scratch_path(spark, "summary")
    incremental.start_state(target, summary, base)
    incremental.update_state(spark, feed, summary, base, 2)
    return incremental.read_summary(spark, summary, base)


def incremental_status(spark, d):
    return _kept_up(spark, d, incremental.STATUS)


def incremental_leaderboard(spark, d):
    return _kept_up(spark, d, incremental.BOARD)


def incremental_conditions(spark, d):
    return _kept_up(spark, d, incremental.CONDITIONS)


def incremental_yearly(spark, d):
    return _kept_up(spark, d, incremental.years(1996, 2000))


def incremental_kpis(spark, d):
    return _kept_up(spark, d, incremental.KPIS)


def profile_by_sketches(spark, d):
    """Two loads profiled from stored sketches, held against exact counts of all their rows."""
    path, texts, numbers = scratch_path(spark, "sketches"), ["overall_status", "lead_sponsor"], ["enrollment_count"]
    days = silver_days(spark, d)
    for day, df in zip((DAY_1, DAY_2), days):
        sketches.load_sketches(df, texts, numbers, day).write.mode("append").parquet(path)
    found = written(sketches.sketch_profile(sketches.merge_sketches(spark.read.parquet(path))), "profile")
    every = days[0].select(*texts, *numbers).union(days[1].select(*texts, *numbers))
    exact = sketches.exact_profile(every, texts, numbers)
    median = found.filter("quantiles is not null").select("column_name", F.col("quantiles")[1].alias("q"))
    value = F.col("enrollment_count")
    ranks = every.filter(value.isNotNull()).join(F.broadcast(median)).groupBy("column_name").agg(  # one row of one column
        ((F.avg((value < F.col("q")).cast("double")) <= 0.52) & (F.avg((value <= F.col("q")).cast("double")) >= 0.48)).alias("median_close")
    )
    both = found.alias("f").join(exact.alias("e"), "column_name").join(ranks, "column_name", "left")
    return both.select(
        "column_name",
        "f.row_count",
        "f.nulls",
        (F.abs(F.col("f.distinct_values") / F.col("e.distinct_values") - 1) < 0.05).alias("distinct_close"),
        "median_close",
        # values of few kinds are all tracked, so their counts are exact
        F.when(F.col("column_name") == "overall_status", F.col("f.top_values")[0]["count"] == F.col("e.top_values")[0]["count"]).alias("top_exact"),
    )


QUERIES: dict[str, Query] = {
    "profile_by_sketches": profile_by_sketches,
    "incremental_status": incremental_status,
    "incremental_leaderboard": incremental_leaderboard,
    "incremental_conditions": incremental_conditions,
    "incremental_yearly": incremental_yearly,
    "incremental_kpis": incremental_kpis,
    "silver_normalise": silver_normalise,
    "record_fingerprint": record_fingerprint,
    "stream_columns": stream_columns,
    "unparsed_values": unparsed_values,
    "value_profile": value_profile,
    "status_summary": status_summary,
    "status_summary_plain": status_summary_plain,
    "status_rollup": status_rollup,
    "sponsor_leaderboard": sponsor_leaderboard,
    "sponsor_leaderboard_plain": sponsor_leaderboard_plain,
    "active_sponsors": active_sponsors,
    "condition_analytics": condition_analytics,
    "yearly_trend": yearly_trend,
    "chart_sponsors": chart_sponsors,
    "chart_conditions": chart_conditions,
    "platform_kpis": platform_kpis,
    "platform_kpis_null_sponsor": platform_kpis_null_sponsor,
    "dashboard_kpis": dashboard_kpis,
    "distributions": distributions,
    "silver_counts": silver_counts,
    "rule_report": rule_report,
    "rule_report_alt": rule_report_alt,
    "rule_report_dirty": rule_report_dirty,
    "expect_drop_dirty": expect_drop_dirty,
    "quarantine": quarantine,
    "expect_drop": expect_drop,
    "raw_validation": raw_validation,
    "duplicate_count": duplicate_count,
    "dedupe_latest": dedupe_latest_query,
    "cdc_merge": cdc_merge,
    "cdc_merge_wide": cdc_merge_wide,
    "cdc_merge_narrow": cdc_merge_narrow,
    "cdc_change_feed": cdc_change_feed,
    "cdc_merge_late": cdc_merge_late,
    "cdc_stats": cdc_stats,
    "updated_rows": updated_rows,
    "facet_search": facet_search,
    "keyword_search": keyword_search,
    "keyword_regex": keyword_regex,
    "keyword_index": keyword_index,
    "keyword_index_regex": keyword_index_regex,
    "term_counts": term_counts,
    "condition_labels": condition_labels,
    "summary_preview": summary_preview,
    "keyword_fallback": keyword_fallback,
    "any_keyword": any_keyword,
    "facet_values": facet_values,
    "display_cards": display_cards,
    "listing_page": listing_page,
}
