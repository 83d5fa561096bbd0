"""Scalar functions, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadpipe.functions import postings as p
from leadpipe.functions import titles as t
from leadpipe.operators import filters, projection
from leadpipe.schemas import TARGET_TYPE
from workload import sqltext as q
from workload.data import AS_OF, ORDER, ORDER_SQL, POSTINGS_SQL, postings, table
from workload.registry import query

POST = f"({POSTINGS_SQL}) AS postings"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEYS_SQL = ", ".join(KEYS)


@query(
    "extract_job_id",
    f"SELECT {KEYS_SQL}, job_link, {q.job_id('job_link')} AS JobId FROM {POST}",
)
def extract_job_id(spark, sf_dir):
    return postings(spark, sf_dir).select(
        *KEYS, "job_link", p.extract_job_id(F.col("job_link")).alias("JobId")
    )


@query(
    "extract_job_id_from_pages",
    f"SELECT page_id, url, {q.job_id('url')} AS first_rule, "
    "regexp_extract_all(url, '-([a-z0-9]+)', 1)[-1] AS last_rule FROM pages",
)
def extract_job_id_from_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        p.extract_job_id(F.col("url")).alias("first_rule"),
        p.extract_job_id(F.col("url"), id_rule="last").alias("last_rule"),
    )


@query("parse_days_ago", f"SELECT {KEYS_SQL}, {q.days_ago('job_date')} AS days_ago FROM {POST}")
def parse_days_ago(spark, sf_dir):
    return postings(spark, sf_dir).select(
        *KEYS, p.parse_days_ago(F.col("job_date")).alias("days_ago")
    )


@query(
    "post_date",
    f"SELECT {KEYS_SQL}, strftime(DATE '{AS_OF}' - ({q.days_ago('job_date')}), '%Y-%m-%d') "
    f"AS PostDate FROM {POST}",
)
def post_date(spark, sf_dir):
    dated = p.post_date(p.parse_days_ago(F.col("job_date")), AS_OF)
    return postings(spark, sf_dir).select(*KEYS, dated.cast("string").alias("PostDate"))


@query(
    "filter_recent",
    f"SELECT {KEYS_SQL}, {q.days_ago('job_date')} AS days_ago FROM {POST} "
    f"WHERE {q.days_ago('job_date')} < 30",
)
def filter_recent(spark, sf_dir):
    aged = postings(spark, sf_dir).withColumn("days_ago", p.parse_days_ago(F.col("job_date")))
    return filters.filter_recent(aged).select(*KEYS, "days_ago")


@query(
    "title_case",
    f"SELECT c_custkey AS id, {q.title_case('c_name')} AS titled FROM customer UNION ALL "
    f"SELECT doc_id, {q.title_case('text')} FROM documents UNION ALL "
    f"SELECT {ORDER[0]}, {q.title_case('account_name')} FROM {POST}",
)
def title_case(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    accounts = postings(spark, sf_dir).select("l_orderkey", "account_name")
    return (
        names.union(texts).union(accounts).select("id", p.title_case(F.col("c_name")).alias("titled"))
    )


@query(
    "clean_description",
    f"SELECT doc_id, {q.description('text')} AS cleaned, "
    "trim(regexp_replace(text, '[^A-Za-z0-9_]', ' ', 'g')) AS cleaned_per_char FROM documents",
)
def clean_description(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        p.clean_description(F.col("text")).alias("cleaned"),
        p.clean_description(F.col("text"), per_char=True).alias("cleaned_per_char"),
    )


@query(
    "extract_state",
    f"SELECT o_orderkey AS id, {q.state('o_orderpriority')} AS State FROM orders UNION ALL "
    f"SELECT l_orderkey, {q.state('job_location')} FROM {POST}",
)
def extract_state(spark, sf_dir):
    priorities = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("location")
    )
    places = postings(spark, sf_dir).select("l_orderkey", "job_location")
    return priorities.union(places).select("id", p.extract_state(F.col("location")).alias("State"))


@query(
    "company_link_fallback",
    f"SELECT {KEYS_SQL}, coalesce(company_link, 'https://www.google.com/#q=' || account_name) "
    f"AS CompanyLink FROM {POST}",
)
def company_link_fallback(spark, sf_dir):
    return postings(spark, sf_dir).select(
        *KEYS,
        p.company_link_fallback(F.col("company_link"), F.col("account_name")).alias("CompanyLink"),
    )


@query(
    "is_search_link",
    f"SELECT {KEYS_SQL}, company_link, contains(company_link, 'google') AS is_search FROM {POST}",
)
def is_search_link(spark, sf_dir):
    return postings(spark, sf_dir).select(
        *KEYS, "company_link", p.is_search_link(F.col("company_link")).alias("is_search")
    )


@query("is_null", f"SELECT {KEYS_SQL}, company_link IS NULL AS no_link FROM {POST}")
def is_null(spark, sf_dir):
    return postings(spark, sf_dir).select(*KEYS, F.isnull("company_link").alias("no_link"))


@query(
    "truncate_rate",
    f"SELECT l_orderkey, l_linenumber, {q.truncated('l_discount')} AS discount, "
    f"{q.truncated('l_extendedprice / 1000')} AS thousands, "
    f"{q.truncated('l_tax / 7')} AS share FROM lineitem",
)
def truncate_rate(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        p.truncate_rate(F.col("l_discount")).alias("discount"),
        p.truncate_rate(F.col("l_extendedprice") / 1000).alias("thousands"),
        p.truncate_rate(F.col("l_tax") / 7).alias("share"),
    )


@query(
    "compact_name",
    f"SELECT {KEYS_SQL}, {q.compact('account_name')} AS name FROM {POST}",
)
def compact_name(spark, sf_dir):
    return postings(spark, sf_dir).select(
        *KEYS, p.compact_name(F.col("account_name")).alias("name")
    )


@query("normalize_space", f"SELECT doc_id, {q.normalized('text')} AS text FROM documents")
def normalize_space(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", p.normalize_space(F.col("text")).alias("text")
    )


@query(
    "flatten",
    """SELECT doc_id, array_to_string(flatten(list_transform(string_split(text, chr(10)),
         lambda line: string_split(line, ' '))), '|') AS words FROM documents""",
)
def flatten(spark, sf_dir):
    lines = F.split("text", "\n")
    words = F.flatten(F.transform(lines, lambda line: F.split(line, " ")))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(words, "|").alias("words")
    )


@query(
    "string_functions",
    """SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low,
         contains(p_name, 'old') AS has_old, replace(p_name, 'o', '0') AS replaced,
         trim('  ' || p_brand || ' ') AS trimmed, concat(p_name, '/', p_brand) AS joined,
         string_split(p_name, ' ')[1] AS first_word FROM part""",
)
def string_functions(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.upper("p_name").alias("up"),
        F.lower("p_type").alias("low"),
        F.contains("p_name", F.lit("old")).alias("has_old"),
        F.replace("p_name", F.lit("o"), F.lit("0")).alias("replaced"),
        F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("trimmed"),
        F.concat("p_name", F.lit("/"), "p_brand").alias("joined"),
        F.get(F.split("p_name", " "), F.lit(0)).alias("first_word"),
    )


@query(
    "casts",
    "SELECT c_custkey, TRY_CAST(substr(c_name, 10) AS INTEGER) AS number, "
    "TRY_CAST(c_name AS INTEGER) AS no_number, CAST(c_nationkey AS VARCHAR) AS text FROM customer",
)
def casts(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.substr("c_name", F.lit(10)).try_cast("int").alias("number"),
        F.col("c_name").try_cast("int").alias("no_number"),
        F.col("c_nationkey").cast("string").alias("text"),
    )


@query(
    "join_strings",
    "SELECT doc_id, array_to_string(regexp_extract_all(text, '[A-Z][a-z]+'), ', ') AS words "
    "FROM documents",
)
def join_strings(spark, sf_dir):
    words = F.regexp_extract_all("text", F.lit("([A-Z][a-z]+)"), F.lit(1))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(words, ", ").alias("words")
    )


# --- projections ------------------------------------------------------------------


@query(
    "rename_positional",
    "SELECT c_custkey AS id, c_name AS account, c_nationkey AS nation, c_acctbal AS balance, "
    "c_mktsegment AS segment FROM customer",
)
def rename_positional(spark, sf_dir):
    return projection.rename_positional(
        table(spark, sf_dir, "customer"), ["id", "account", "nation", "balance", "segment"]
    )


@query("drop_columns", "SELECT * EXCLUDE (c_acctbal, c_mktsegment) FROM customer")
def drop_columns(spark, sf_dir):
    return projection.drop_columns(table(spark, sf_dir, "customer"), "c_acctbal", "c_mktsegment")


@query(
    "swap_column",
    "SELECT c_custkey, c_mktsegment AS c_name, c_nationkey, c_acctbal FROM customer",
)
def swap_column(spark, sf_dir):
    return projection.swap_column(table(spark, sf_dir, "customer"), "c_name", "c_mktsegment")


@query(
    "map_target_fields",
    "SELECT CAST(c_custkey AS VARCHAR) AS JobId__c, c_name AS Account_Name__c, "
    f"'{TARGET_TYPE}' AS type FROM customer",
)
def map_target_fields(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("JobId"), F.col("c_name").alias("AccountName")
    )
    return projection.map_target_fields(
        rows, {"JobId": "JobId__c", "AccountName": "Account_Name__c"}
    )


@query(
    "normalize_colnames",
    "SELECT c_custkey AS customerkey, c_name AS accountname, c_mktsegment AS marketseg FROM customer",
)
def normalize_colnames(spark, sf_dir):
    named = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer Key"),
        F.col("c_name").alias("Account/Name"),
        F.col("c_mktsegment").alias("Market \\Seg"),
    )
    return projection.normalize_colnames(named)


@query(
    "conditional_assign",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal "
    "FROM customer",
)
def conditional_assign(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return projection.conditional_assign(rows, "c_acctbal", F.col("c_acctbal") < 0, F.lit(0.0))


@query(
    "add_constant",
    f"SELECT c_custkey, '{AS_OF}' AS post_date, CAST(0 AS INTEGER) AS days_ago FROM customer",
)
def add_constant(spark, sf_dir):
    rows = projection.add_run_constants(table(spark, sf_dir, "customer"), AS_OF)
    return rows.select("c_custkey", F.col("post_date").cast("string").alias("post_date"), "days_ago")


# --- filters --------------------------------------------------------------------


@query("filter_null_title", f"SELECT {KEYS_SQL}, title FROM {POST} WHERE title IS NOT NULL")
def filter_null_title(spark, sf_dir):
    return filters.filter_null(postings(spark, sf_dir), "title").select(*KEYS, "title")


@query(
    "filter_blocklist",
    "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'other', 'click')",
)
def filter_blocklist(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return filters.filter_blocklist(rows, "event_type", ["error", "other", "click"])


@query(
    "filter_not_contains",
    "SELECT p_partkey, p_name FROM part WHERE NOT contains(p_name, 'old')",
)
def filter_not_contains(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return filters.filter_not_contains(rows, "p_name", "old")


@query(
    "filter_nonempty",
    "SELECT doc_id, letters FROM (SELECT doc_id, regexp_replace(text, '[^q]', '', 'g') AS letters "
    "FROM documents) WHERE letters <> ''",
)
def filter_nonempty(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.regexp_replace("text", "[^q]", "").alias("letters")
    )
    return filters.filter_nonempty(rows, "letters")


@query(
    "filter_tokens",
    "SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), "
    "lambda w: regexp_full_match(w, '[a-z]{2,}')), ' ') AS tokens FROM documents",
)
def filter_tokens(spark, sf_dir):
    tokens = t.filter_tokens(F.split("text", " "))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(tokens, " ").alias("tokens")
    )


__all__ = ["KEYS", "KEYS_SQL", "ORDER_SQL", "POST"]
