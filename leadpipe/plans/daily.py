"""The daily upload and the link discovery."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpipe.functions import postings as p
from leadpipe.functions.similarity import best_candidate
from leadpipe.operators.filters import MIN_SCORE, filter_score
from leadpipe.operators.pages import company_links
from leadpipe.operators.projection import swap_column
from leadpipe.operators.relational import anti_existing, enrich_top1
from leadpipe.operators.scoring import add_title_score
from leadpipe.plans.cleaning import first_postings, identify_postings
from leadpipe.schemas import TARGET_TYPE, UPLOAD_COLUMNS
from leadpipe.session import scratch_scope
from leadpipe.sources.readers import scan_existing
from leadpipe.sources.sinks import sink_append_batches, sink_dated_csv


def scored_postings(
    raw: DataFrame,
    dims: dict[str, DataFrame],
    as_of: datetime.date,
    order_by: Sequence[str],
    existing: DataFrame | None = None,
    keep: Sequence[str] = (),
    min_score: int = MIN_SCORE,
    id_rule: str = "second",
    per_token: bool = False,
) -> DataFrame:
    """Clean postings that score high enough, with score, state and some link.

    Titles are scored first, of rows that are not too old.  Few rows score
    high, and only those take their texts through the shuffle of the
    deduplication; the others just take part in the choice of the first row.
    Ids in `existing` leave while the rows are still partitioned by id.
    """
    age = p.parse_days_ago(F.col("job_date"))
    fresh = F.when(age < p.MAX_AGE_DAYS, F.col("title")).alias("JobTitle")
    # Few links have no id; the titles are not worth a look into all of them.  A row of another
    # age gets a score or a null, and goes without its texts in any case.
    rated = add_title_score(
        identify_postings(raw, id_rule).withColumn("JobTitle", F.col("title")),
        dims,
        per_token=per_token,
        min_score=min_score,
        titles=raw.select(fresh),
    )
    high = F.col("titleScore") >= min_score
    clean = first_postings(rated, as_of, order_by, ["titleScore", *keep], texts_if=high)
    scored = filter_score(clean, threshold=min_score)
    if existing is not None:
        scored = anti_existing(scored, existing, unique=True)
    return scored.withColumns(
        {
            "State": p.extract_state(F.col("JobLocation")),
            "CompanyLink": p.company_link_fallback(F.col("CompanyLink"), F.col("AccountName")),
        }
    )


def daily_upload(
    raw: DataFrame,
    dims: dict[str, DataFrame],
    results: DataFrame,
    existing: DataFrame,
    as_of: datetime.date,
    order_by: Sequence[str],
    keep_own_link: bool = False,
    **rules,
) -> DataFrame:
    """New high-scoring postings of a run, ready for the target.

    The search result replaces the company link, also by nothing;
    `keep_own_link=True` keeps the link where the search found none.  `rules` are
    those of `scored_postings`: score threshold, id rule and per-token spelling.
    """
    new = scored_postings(raw, dims, as_of, order_by, existing, **rules)
    found = enrich_top1(new, results)
    if keep_own_link:
        found = found.withColumn("google_link", F.coalesce("google_link", "CompanyLink"))
    return swap_column(found, "CompanyLink", "google_link").select(*UPLOAD_COLUMNS, *rules.get("keep", ()))


def run_daily(
    spark: SparkSession,
    raw: DataFrame,
    dims: dict[str, DataFrame],
    results: DataFrame,
    target: str,
    report: str,
    as_of: datetime.date,
    order_by: Sequence[str],
    tag: str = TARGET_TYPE,
    **rules,
) -> DataFrame:
    """One day's job: append the new postings in batches, then report them as CSV.

    Ids of the same run date do not count as existing, so a repeated run
    replaces its own rows.  Returns the rows per batch.  Batches are cut in the
    feed's order, which travels with the rows.  `tag` names the type of the target
    object, `rules` are those of `daily_upload`.
    """
    existing = scan_existing(spark, target).where(F.col("run_date") != str(as_of))
    with scratch_scope(spark):
        new = daily_upload(raw, dims, results, existing, as_of, order_by, keep=order_by, **rules)
        batches = sink_append_batches(new, target, as_of, order_by, tag=tag)
    written = spark.read.parquet(f"{target}/run_date={as_of}").drop("batch", "type")
    sink_dated_csv(written, report, as_of)
    return batches


def link_discovery(
    postings: DataFrame,
    pages: DataFrame,
    container: str = "dd",
    mode: str = "token_set_ratio",
) -> DataFrame:
    """Company links of scored postings and the one most like the company name."""
    companies = postings.select("CompanyLink", "AccountName").distinct()
    linked = company_links(companies, pages, container)
    matched = linked.withColumn(
        "best", best_candidate(p.compact_name(F.col("AccountName")), F.col("links"), mode)
    )
    return matched.select(
        "CompanyLink", "AccountName", "links", F.col("best.link").alias("link"), "best.score"
    )
