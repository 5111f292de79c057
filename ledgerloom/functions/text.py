"""Search text, term vectors and text layouts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clipped(c: Column | str, chars: int | None) -> Column:
    """Text with NULL as '' and, if ``chars`` is given, cut to that length."""
    text = F.coalesce(_col(c), F.lit(""))
    return text if chars is None else F.substring(text, 1, chars)


def search_text(
    columns: Sequence[str],
    summary: str,
    summary_chars: int | None = None,
    sep: str = " | ",
) -> Column:
    """One text to search or embed: the fields, then the summary.

    NULL counts as '' so that every separator stays. The whole summary is used
    unless ``summary_chars`` asks for a shorter text.
    """
    parts = [clipped(c, None) for c in columns] + [clipped(summary, summary_chars)]
    return F.concat_ws(sep, *parts)


def term_buckets(text: Column | str, dims: int) -> Column:
    """Bucket number, as text, of every word (runs of a-z in the lower-cased text)."""
    words = F.filter(F.split(F.lower(_col(text)), "[^a-z]+"), lambda w: w != "")
    return F.transform(
        words,
        lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % dims).cast("string"),
    )


def fill_layout(layout: str, values: Mapping[str, Column]) -> Column:
    """Text from a layout with ``{name}`` places; NULL values become ''."""
    parts: list[Column] = []
    for piece in re.split(r"(\{\w+\})", layout):
        if piece.startswith("{") and piece.endswith("}"):
            parts.append(F.coalesce(values[piece[1:-1]].cast("string"), F.lit("")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
