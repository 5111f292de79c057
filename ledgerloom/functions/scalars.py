"""Typing, cleaning and formatting of single values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.fixed_values import RECRUITING_NO, RECRUITING_YES, STUDY_PAGE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_of(c: Column | str) -> Column:
    """Whole number, NULL where the text is not one."""
    return _col(c).try_cast("bigint")


def date_of(c: Column | str) -> Column:
    """Date from text; a month or a year alone means its first day, bad text NULL."""
    return _col(c).try_cast("date")


def timestamp_of(c: Column | str) -> Column:
    return _col(c).try_cast("timestamp")


def clean_text(c: Column | str) -> Column:
    return F.trim(_col(c))


def clean_upper(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start)).cast("int")


def fingerprint(
    columns: Sequence[Column | str], sep: str = "|", null_token: str | None = None
) -> Column:
    """MD5 over the given fields.

    NULL fields are left out of the text, so (NULL, x) and (x, NULL) are the same
    record; give ``null_token`` to keep their places apart.
    """
    parts = [_col(c).cast("string") for c in columns]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.md5(F.concat_ws(sep, *parts))


def join_list(c: Column | str, sep: str = ", ") -> Column:
    """Array of labels to one text; NULL stays NULL."""
    return F.array_join(_col(c), sep)


def percent_of(part: Column | str, whole: Column | str, places: int = 1) -> Column:
    """Share in percent; NULL when the whole is 0."""
    return F.round(F.try_divide(_col(part), _col(whole)) * 100, places)


def similarity_percent(cosine: Column | str, places: int = 1) -> Column:
    """Cosine similarity (1 - cosine distance) in percent."""
    # adding 0.0 turns -0.0 into 0.0
    return F.round(_col(cosine) * 100, places) + F.lit(0.0)


def label_or_unknown(c: Column | str, unknown: str = "Unknown") -> Column:
    return F.coalesce(F.nullif(F.trim(_col(c)), F.lit("")), F.lit(unknown))


def study_link(key: Column | str, base: str = STUDY_PAGE) -> Column:
    return F.concat(F.lit(base), _col(key))


def yes_no(flag: Column | str, yes: str = RECRUITING_YES, no: str = RECRUITING_NO) -> Column:
    return F.when(_col(flag), yes).otherwise(no)


def grouped_number(c: Column | str) -> Column:
    """Number with thousands separators and no decimals."""
    return F.format_number(_col(c), 0)
