"""Facet filters, keyword search, fallback, display cards."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import clipped, label_or_unknown, study_link

TITLE_COLUMNS = ("brief_title", "conditions")
TEXT_COLUMNS = ("brief_title", "conditions", "brief_summary")
DEFAULT_FACETS = {"overall_status": ("RECRUITING",)}


def keyword_hit(keyword: str, columns: Sequence[str], mode: str = "literal") -> Column:
    """Case-blind match in any column; NULL matches nothing, '' matches all rows.

    mode 'literal' looks for the text as it is, 'regex' reads it as a pattern.
    """
    if not keyword:
        return F.lit(True)
    if mode == "literal":
        hits = [F.lower(F.col(c)).contains(keyword.lower()) for c in columns]
    elif mode == "regex":
        re.compile(keyword)
        hits = [F.col(c).rlike(f"(?i){keyword}") for c in columns]
    else:
        raise ValueError(f"unknown mode: {mode}")
    out = F.lit(False)
    for h in hits:
        out = out | F.coalesce(h, F.lit(False))
    return out


def keyword_search(
    df: DataFrame, keyword: str, columns: Sequence[str] = TEXT_COLUMNS, mode: str = "literal"
) -> DataFrame:
    return df.filter(keyword_hit(keyword, columns, mode)) if keyword else df


def any_keyword(df: DataFrame, keywords: Sequence[str], column: str = "brief_summary") -> DataFrame:
    """Rows whose text holds at least one of the keywords."""
    out = F.lit(False)
    for k in keywords:
        out = out | keyword_hit(k, [column])
    return df.filter(out)


def facet_search(
    df: DataFrame,
    facets: Mapping[str, Sequence[str]] = DEFAULT_FACETS,
    keyword: str = "",
    columns: Sequence[str] = TITLE_COLUMNS,
    mode: str = "literal",
) -> DataFrame:
    """All facets must match; a facet without chosen values does not filter."""
    for column, chosen in facets.items():
        if chosen:
            df = df.filter(F.col(column).isin(*chosen))
    return keyword_search(df, keyword, columns, mode)


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Values a facet offers, sorted, without NULL."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def first_rows(df: DataFrame, n: int, key: str = "nct_id") -> DataFrame:
    """The first n rows of a result in key order (a page of a listing)."""
    return df.orderBy(key).limit(n)


def keyword_or_all(
    df: DataFrame,
    question: str,
    n: int = 8,
    columns: Sequence[str] = TEXT_COLUMNS,
    key: str = "nct_id",
    mode: str = "literal",
) -> DataFrame:
    """First n matches of the whole question; if there is none, the first n rows.

    Matches sort before the rest, so the n leading rows tell whether any exists and
    no second pass over the table is needed.
    """
    lead = (
        df.withColumn("_hit", keyword_hit(question, columns, mode))
        .orderBy(F.col("_hit").desc(), key)
        .limit(n)
    )
    # the window runs over the n rows that are left
    found = F.max("_hit").over(Window.partitionBy())
    return (
        lead.withColumn("_found", found).filter(F.col("_hit") == F.col("_found")).drop("_hit", "_found")
    )


def display_cards(
    df: DataFrame,
    title_chars: int = 80,
    conditions_chars: int = 100,
    summary_chars: int = 300,
    key: str = "nct_id",
) -> DataFrame:
    """What a listing shows of each record."""
    return df.select(
        key,
        F.substring("brief_title", 1, title_chars).alias("title"),
        F.col("overall_status").alias("status"),
        label_or_unknown("phase", "N/A").alias("phase"),
        F.coalesce("enrollment_count", F.lit(0)).alias("enrollment"),
        F.col("lead_sponsor").alias("sponsor"),
        F.coalesce(F.col("start_date").cast("string"), F.lit("N/A")).alias("start"),
        clipped("conditions", conditions_chars).alias("conditions"),
        F.when(
            F.length("brief_summary") > 0,
            F.concat(F.substring("brief_summary", 1, summary_chars), F.lit("...")),
        ).alias("summary"),
        study_link(key).alias("link"),
    )
