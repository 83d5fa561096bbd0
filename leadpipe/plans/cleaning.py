"""Raw postings to clean ones."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpipe.functions import postings as p
from leadpipe.operators.filters import filter_recent
from leadpipe.operators.projection import compute_once, rename_positional
from leadpipe.operators.relational import dedup_first
from leadpipe.schemas import CLEAN_COLUMNS, RAW_COLUMNS

# Needed for the clean layout; `url` and `job_date` are not.
_TEXTS = [
    "job_link",
    "title",
    "company_link",
    "account_name",
    "job_location",
    "job_description",
]


def reject_postings(raw: DataFrame) -> DataFrame:
    """Raw rows that cannot be cleaned, with the reason."""
    link, age = F.col("job_link"), F.col("job_date")
    reason = (
        F.when(link.isNull(), "no link")
        .when(~p.has_job_id(link), "no id in link")
        .when(age.isNull(), "no date")
        .when(~p.has_age(age), "no number of days")
        .when(F.col("title").isNull(), "no title")
    )
    return raw.withColumn("reason", reason).where(F.col("reason").isNotNull())


def can_be_cleaned() -> Column:
    """Rows `reject_postings` does not list, told by plain tests of the raw columns."""
    return p.has_job_id(F.col("job_link")) & has_age_and_title()


def has_age_and_title() -> Column:
    """Rows that can be cleaned if their link has an id."""
    return p.has_age(F.col("job_date")) & F.col("title").isNotNull()


def identify_postings(raw: DataFrame, id_rule: str = "second") -> DataFrame:
    """The rows that can be cleaned, with `JobId` and `days_ago`.

    A link is searched once, for its id, and one without any gives a null: a filter by a test of
    its own, or by an expression Spark could copy, would look into every link again.
    """
    told = raw.where(has_age_and_title()).withColumns(
        {
            "JobId": p.extract_job_id(F.col("job_link"), id_rule),
            "days_ago": p.parse_days_ago(F.col("job_date")),
        }
    )
    return compute_once(told, "JobId", "days_ago").where(F.col("JobId").isNotNull())


def clean_postings(
    raw: DataFrame,
    as_of: datetime.date,
    order_by: Sequence[str],
    id_rule: str = "second",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Identify, deduplicate, date, age-filter and normalise raw postings.

    `keep` names further columns to carry along.
    """
    extra = [c for c in dict.fromkeys([*order_by, *keep]) if c not in RAW_COLUMNS]
    rows = identify_postings(raw.select(*RAW_COLUMNS, *extra), id_rule)
    return first_postings(rows, as_of, order_by, keep)


def first_postings(
    rows: DataFrame,
    as_of: datetime.date,
    order_by: Sequence[str],
    keep: Sequence[str] = (),
    texts_if: Column | None = None,
) -> DataFrame:
    """Deduplicate, date, age-filter and normalise identified postings.

    The first row per id is chosen before the age filter: an id whose first
    row is old is gone even if a later row is fresh.  Old rows only take part
    in that choice, so they travel through its shuffle without their texts.
    `keep` names further columns to carry along.  `texts_if` withholds the
    texts from more rows that only take part in the choice; the caller filters
    those rows afterwards.
    """
    kept = [c for c in dict.fromkeys([*order_by, *keep]) if c not in ("JobId", "days_ago")]
    wanted = F.col("days_ago") < p.MAX_AGE_DAYS
    if texts_if is not None:
        wanted = wanted & texts_if
    texts = [F.when(wanted, F.col(c)).alias(f"_{c}") for c in _TEXTS]
    narrow = rows.select("JobId", "days_ago", *kept, *texts)
    recent = filter_recent(dedup_first(narrow, "JobId", order_by))
    clean = recent.select(
        "_job_link",
        "_title",
        "_company_link",
        p.title_case(F.col("_account_name")),
        "_job_location",
        p.clean_description(F.col("_job_description")),
        "JobId",
        p.post_date(F.col("days_ago"), as_of),
        *keep,
    )
    return rename_positional(clean, [*CLEAN_COLUMNS, *keep])
