"""Column expressions: every function maps Columns to a Column."""

from ledgerloom.functions.scalars import (
    clean_text,
    clean_upper,
    count_of,
    date_of,
    days_between,
    fingerprint,
    grouped_number,
    join_list,
    label_or_unknown,
    percent_of,
    similarity_percent,
    study_link,
    timestamp_of,
    yes_no,
)
from ledgerloom.functions.text import (
    clipped,
    fill_layout,
    search_text,
    term_buckets,
)

__all__ = [
    "clean_text",
    "clean_upper",
    "clipped",
    "count_of",
    "date_of",
    "days_between",
    "fill_layout",
    "fingerprint",
    "grouped_number",
    "join_list",
    "label_or_unknown",
    "percent_of",
    "search_text",
    "similarity_percent",
    "study_link",
    "term_buckets",
    "timestamp_of",
    "yes_no",
]
