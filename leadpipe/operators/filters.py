"""Row filters of the posting and title cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadpipe.functions.postings import MAX_AGE_DAYS
from leadpipe.functions.titles import JUNK_PHRASE, JUNK_TITLES

MIN_SCORE = 80


def filter_recent(df: DataFrame, days: str = "days_ago", limit: int = MAX_AGE_DAYS) -> DataFrame:
    """Rows younger than the limit; belongs after the deduplication."""
    return df.where(F.col(days) < limit)


def filter_score(df: DataFrame, score: str = "titleScore", threshold: int = MIN_SCORE) -> DataFrame:
    """Rows scoring the threshold or more; a null score does not pass."""
    return df.where(F.col(score) >= threshold)


def filter_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def filter_blocklist(df: DataFrame, column: str, values: list[str] | None = None) -> DataFrame:
    """Rows whose value is none of the junk titles; nulls are not in the list."""
    blocked = F.col(column).isin(JUNK_TITLES if values is None else values)
    return df.where(~F.coalesce(blocked, F.lit(False)))


def filter_not_contains(df: DataFrame, column: str, phrase: str = JUNK_PHRASE) -> DataFrame:
    return df.where(~F.contains(F.col(column), F.lit(phrase)))


def filter_nonempty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) != "")


def has_n_links(df: DataFrame, links: str, n: int) -> DataFrame:
    """Rows whose link list has exactly n elements."""
    return df.where(F.size(links) == n)
