"""Registry records on Spark: landing, cleaning, change capture, summaries, search."""

from ledgerloom.functions import fingerprint
from ledgerloom.operators.cdc import change_feed, merge_changes, merge_stats, pair_changes
from ledgerloom.operators.context import (
    build_context,
    build_prompts,
    citation_check,
    evaluate,
    retrieval_metrics,
)
from ledgerloom.operators.dedupe import dedupe_latest
from ledgerloom.operators.gold import (
    exploded_analytics,
    kpis,
    leaderboard,
    status_summary,
    yearly_trend,
)
from ledgerloom.operators.normalise import normalise
from ledgerloom.operators.quality import gate, quarantine, run_rules
from ledgerloom.operators.search import facet_search, keyword_search
from ledgerloom.operators.vectors import approx_top_k, embed, top_k
from ledgerloom.sinks.bronze import land_bronze
from ledgerloom.sources.pages import flatten_studies, read_pages
from ledgerloom.streaming.bronze import stream_bronze
from ledgerloom.streaming.merge import stream_merge
from ledgerloom.streaming.silver import stream_silver

__all__ = [
    "approx_top_k",
    "build_context",
    "build_prompts",
    "change_feed",
    "citation_check",
    "dedupe_latest",
    "embed",
    "evaluate",
    "exploded_analytics",
    "facet_search",
    "fingerprint",
    "flatten_studies",
    "gate",
    "keyword_search",
    "kpis",
    "land_bronze",
    "leaderboard",
    "merge_changes",
    "merge_stats",
    "normalise",
    "pair_changes",
    "quarantine",
    "read_pages",
    "retrieval_metrics",
    "run_rules",
    "status_summary",
    "stream_bronze",
    "stream_merge",
    "stream_silver",
    "top_k",
    "yearly_trend",
]
