"""Whole jobs: cleaning, the daily upload, link discovery, incremental runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadpipe.plans import cleaning, daily
from leadpipe.session import scratch_path
from leadpipe.sources.readers import CSV_FORMAT
from leadpipe.streaming.incremental import incremental_upload as run_incremental
from workload import sqltext as q
from workload.data import (
    AS_OF,
    EXISTING_SQL,
    ORDER,
    ORDER_SQL,
    RESULTS_SQL,
    dims,
    existing_ids,
    postings,
    search_results,
    sheet_sql,
    table,
)
from workload.registry import query
from workload.text_queries import KEYS, KEYS_SQL, POST

_REASON = f"""CASE WHEN job_link IS NULL THEN 'no link'
  WHEN ({q.job_id('job_link')}) IS NULL THEN 'no id in link'
  WHEN job_date IS NULL THEN 'no date'
  WHEN ({q.days_ago('job_date')}) IS NULL THEN 'no number of days'
  WHEN title IS NULL THEN 'no title' END"""


def clean_sql(source: str, partition: str = "JobId", more: str = "") -> str:
    return f"""
SELECT job_link AS JobLink, title AS JobTitle, company_link AS CompanyLink,
  {q.title_case('account_name')} AS AccountName, job_location AS JobLocation,
  {q.description('job_description')} AS JobDescription, JobId,
  strftime(DATE '{AS_OF}' - days, '%Y-%m-%d') AS PostDate{more}
FROM (
  SELECT *, {q.job_id('job_link')} AS JobId, {q.days_ago('job_date')} AS days FROM {source}
  WHERE ({_REASON}) IS NULL
  QUALIFY row_number() OVER (PARTITION BY {partition} ORDER BY {ORDER_SQL}) = 1
) WHERE days < 30"""


def scored_sql(clean: str) -> str:
    titled = (
        f"SELECT *, {q.whole_mapped('squashed', sheet_sql('mapping'))} AS cleanTitle "
        f"FROM (SELECT *, {q.squash('JobTitle')} AS squashed FROM ({clean}))"
    )
    return f"""
SELECT * EXCLUDE (cleanTitle, squashed, title_level, new_title, points, CompanyLink),
  points AS titleScore, {q.state('JobLocation')} AS State,
  coalesce(CompanyLink, 'https://www.google.com/#q=' || AccountName) AS CompanyLink
FROM ({q.scored(titled, 'cleanTitle', sheet_sql)}) WHERE points >= 80"""


CLEAN = clean_sql(POST)
SCORED = scored_sql(CLEAN)
FIRST_URL = f"(SELECT query, arg_min(url, rank) AS url FROM ({RESULTS_SQL}) GROUP BY query)"
DAILY = f"""
SELECT new.* EXCLUDE (CompanyLink), url AS CompanyLink
FROM ({SCORED}) AS new LEFT JOIN {FIRST_URL} ON AccountName = query
WHERE NOT EXISTS (SELECT 1 FROM ({EXISTING_SQL}) AS old WHERE old.JobId = new.JobId)"""


def _dated(df):
    return df.withColumn("PostDate", F.col("PostDate").cast("string"))


@query("clean_postings", CLEAN)
def clean_postings(spark, sf_dir):
    return _dated(cleaning.clean_postings(postings(spark, sf_dir), AS_OF, ORDER))


@query(
    "reject_postings",
    f"SELECT {KEYS_SQL}, reason FROM (SELECT *, {_REASON} AS reason FROM {POST}) "
    "WHERE reason IS NOT NULL",
)
def reject_postings(spark, sf_dir):
    return cleaning.reject_postings(postings(spark, sf_dir)).select(*KEYS, "reason")


@query("scored_postings", SCORED)
def scored_postings(spark, sf_dir):
    return _dated(daily.scored_postings(postings(spark, sf_dir), dims(spark), AS_OF, ORDER))


@query("daily_upload", DAILY)
def daily_upload(spark, sf_dir):
    return _dated(
        daily.daily_upload(
            postings(spark, sf_dir),
            dims(spark),
            search_results(spark, sf_dir),
            existing_ids(spark, sf_dir),
            AS_OF,
            ORDER,
        )
    )


@query(
    "daily_upload_own_link",
    f"""SELECT new.* EXCLUDE (CompanyLink), coalesce(url, CompanyLink) AS CompanyLink
        FROM ({SCORED}) AS new LEFT JOIN {FIRST_URL} ON AccountName = query
        WHERE NOT EXISTS (SELECT 1 FROM ({EXISTING_SQL}) AS old WHERE old.JobId = new.JobId)""",
)
def daily_upload_own_link(spark, sf_dir):
    return _dated(
        daily.daily_upload(
            postings(spark, sf_dir),
            dims(spark),
            search_results(spark, sf_dir),
            existing_ids(spark, sf_dir),
            AS_OF,
            ORDER,
            keep_own_link=True,
        )
    )


@query(
    "run_daily",
    f"""SELECT batch, count(*) AS rows FROM (SELECT (row_number() OVER () - 1) // 100 AS batch
        FROM ({SCORED})) GROUP BY batch""",
)
def run_daily(spark, sf_dir):
    """Run the same day twice: the second run replaces the first."""
    target, report = scratch_path(spark, "target"), scratch_path(spark, "report")
    batches = None
    for _ in range(2):
        batches = daily.run_daily(
            spark,
            postings(spark, sf_dir),
            dims(spark),
            search_results(spark, sf_dir),
            target,
            report,
            AS_OF,
            ORDER,
        )
    return batches


_ORDERED = scored_sql(clean_sql(POST, more=f", {ORDER_SQL}"))
_TARGET_ROWS = f"""
SELECT new.JobId AS JobId__c, new.AccountName AS Account_Name__c, new.JobLocation AS Job_Location__c,
  new.PostDate AS Post_Date__c, new.JobTitle AS Job_Title__c, new.JobLink AS Job_Link__c,
  url AS Company_Link__c, new.JobDescription AS Job_Description__c, new.titleScore AS Title_Score__c,
  new.State AS State__c, (row_number() OVER (ORDER BY {ORDER_SQL}) - 1) // 100 AS batch
FROM ({_ORDERED}) AS new LEFT JOIN {FIRST_URL} ON AccountName = query
WHERE NOT EXISTS (SELECT 1 FROM ({EXISTING_SQL}) AS old WHERE old.JobId = new.JobId)"""


def _ran(spark, sf_dir):
    """Folders of a day's job over a target that holds ids of an earlier day."""
    target, report = scratch_path(spark, "target"), scratch_path(spark, "report")
    existing_ids(spark, sf_dir).select(F.col("JobId").alias("JobId__c")).write.parquet(
        f"{target}/run_date=2001-01-01"
    )
    raw, sheets, results = postings(spark, sf_dir), dims(spark), search_results(spark, sf_dir)
    daily.run_daily(spark, raw, sheets, results, target, report, AS_OF, ORDER, tag="Lead__c")
    return f"{target}/run_date={AS_OF}", f"{report}/run_date={AS_OF}"


@query("run_daily_rows", f"SELECT *, 'Lead__c' AS type FROM ({_TARGET_ROWS})")
def run_daily_rows(spark, sf_dir):
    """Every field and the batch of each row that the job appends."""
    rows = spark.read.parquet(_ran(spark, sf_dir)[0])
    return rows.withColumn("Post_Date__c", F.col("Post_Date__c").cast("string"))


@query(
    "run_daily_report",
    f"SELECT * EXCLUDE (batch, Title_Score__c), CAST(Title_Score__c AS VARCHAR) AS Title_Score__c "
    f"FROM ({_TARGET_ROWS})",
)
def run_daily_report(spark, sf_dir):
    """The same rows as the job's CSV report has them."""
    return spark.read.options(**CSV_FORMAT, multiLine=True).csv(_ran(spark, sf_dir)[1])


_SITE_PAGES = """
SELECT page_id, concat('https://jobs.example.com/cmp/', page_id) AS url,
  replace(replace(replace(html, '<li>', '<dd>'), '</li>', '</dd>'),
    'href="/', 'href="https://www.example.com/') AS html
FROM {pages}
"""


_PAIRS = f"""(SELECT row_number() OVER () AS n, * FROM (SELECT DISTINCT CompanyLink, AccountName FROM ({SCORED})))"""
_SITE_LINKS = q.outside_links(q.hrefs_in("html", "dd"))
_DISCOVERED = f"""(SELECT n, CompanyLink, AccountName, CASE WHEN contains(CompanyLink, 'google') THEN [CompanyLink]
    WHEN len(found) > 0 THEN found ELSE ['https://www.google.com/#q=' || AccountName] END AS links
  FROM {_PAIRS} LEFT JOIN (SELECT url, arg_min({_SITE_LINKS}, page_id) AS found
    FROM ({_SITE_PAGES.format(pages="pages")}) GROUP BY url) ON CompanyLink = url)"""
_BEST = q.best_links(
    f"SELECT n, {q.compact('AccountName')} AS name, links FROM {_DISCOVERED}", "n", q.token_set_scores
)


@query(
    "link_discovery",
    f"""WITH discovered AS MATERIALIZED {_DISCOVERED}
    SELECT CompanyLink, AccountName, array_to_string(links, '|') AS links, link, score
    FROM discovered JOIN ({_BEST.replace(_DISCOVERED, "discovered")}) USING (n)""",
)
def link_discovery(spark, sf_dir):
    scored = daily.scored_postings(postings(spark, sf_dir), dims(spark), AS_OF, ORDER)
    site = spark.sql(_SITE_PAGES, pages=table(spark, sf_dir, "pages"))
    return daily.link_discovery(scored, site).withColumn("links", F.array_join("links", "|"))


# --- incremental runs ---------------------------------------------------------------


@query("incremental_upload", "SELECT DISTINCT event_id, user_id, event_type, value FROM events")
def incremental_upload(spark, sf_dir):
    """Two overlapping arrivals and one without news: every event is appended once."""
    events = table(spark, sf_dir, "events")
    columns = ["event_id", "user_id", "event_type", "value"]
    schema = events.select(*columns).schema
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "target")
    checkpoint = scratch_path(spark, "stream")
    first_half = F.dayofmonth("ts") <= 15
    for arrival in (events.where(first_half), events, events.where(first_half)):
        arrival.select(*columns).write.mode("append").parquet(landing)
        run_incremental(
            spark, landing, schema, target, checkpoint, "event_id", ["user_id", "value"]
        )
    return spark.read.parquet(target).select(*columns)


# Postings arrive by line number; the second arrival repeats the first.
ARRIVALS = 3
ARRIVED = f"(SELECT *, l_linenumber % {ARRIVALS} AS arrival FROM {POST})"


@query(
    "incremental_postings",
    f"""SELECT JobId, JobTitle, PostDate, arrival FROM ({
        clean_sql(ARRIVED, f"arrival, {q.job_id('job_link')}", ", arrival")})
        QUALIFY row_number() OVER (PARTITION BY JobId ORDER BY arrival) = 1""",
)
def incremental_postings(spark, sf_dir):
    """Posting files in three arrivals, each cleaned as a whole micro-batch."""
    raw = postings(spark, sf_dir).withColumn(
        "arrival", (F.col("l_linenumber") % ARRIVALS).cast("int")
    )
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "target")
    checkpoint = scratch_path(spark, "stream")
    for arrival in range(ARRIVALS):
        raw.where(F.col("arrival") == arrival).write.mode("append").parquet(landing)
        run_incremental(
            spark,
            landing,
            raw.schema,
            target,
            checkpoint,
            "JobId",
            prepare=lambda batch: cleaning.clean_postings(batch, AS_OF, ORDER, keep=["arrival"]),
        )
    return _dated(spark.read.parquet(target)).select("JobId", "JobTitle", "PostDate", "arrival")
