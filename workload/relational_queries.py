"""Deduplication, lookups, aggregates, batches and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadpipe.functions import postings as p
from leadpipe.operators import relational
from workload import sqltext as q
from workload.data import (
    EXISTING_SQL,
    ORDER,
    ORDER_SQL,
    RESULTS_SQL,
    TERRITORY_SQL,
    existing_ids,
    postings,
    search_results,
    table,
)
from workload.registry import query
from workload.text_queries import KEYS, KEYS_SQL, POST


def _accounts(spark, sf_dir):
    return postings(spark, sf_dir).select(
        *KEYS, p.title_case(F.col("account_name")).alias("AccountName")
    )


ACCOUNTS = f"(SELECT {KEYS_SQL}, {q.title_case('account_name')} AS AccountName FROM {POST})"


@query(
    "dedup_first",
    """SELECT * FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def dedup_first(spark, sf_dir):
    return relational.dedup_first(
        table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"]
    )


@query(
    "dedup_first_posting",
    f"""SELECT {KEYS_SQL}, JobId FROM (SELECT *, {q.job_id('job_link')} AS JobId FROM {POST})
        WHERE JobId IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY JobId ORDER BY {ORDER_SQL}) = 1""",
)
def dedup_first_posting(spark, sf_dir):
    ids = (
        postings(spark, sf_dir)
        .where(p.has_job_id(F.col("job_link")))
        .select(*ORDER, p.extract_job_id(F.col("job_link")).alias("JobId"))
    )
    first = relational.dedup_first(ids, "JobId", ORDER)
    return first.select(*KEYS, "JobId")


@query(
    "anti_existing",
    f"""SELECT {KEYS_SQL}, JobId FROM (SELECT *, {q.job_id('job_link')} AS JobId FROM {POST}) AS new
        WHERE JobId IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM ({EXISTING_SQL}) AS old WHERE old.JobId = new.JobId)""",
)
def anti_existing(spark, sf_dir):
    new = (
        postings(spark, sf_dir)
        .where(p.has_job_id(F.col("job_link")))
        .select(*KEYS, p.extract_job_id(F.col("job_link")).alias("JobId"))
    )
    return relational.anti_existing(new, existing_ids(spark, sf_dir)).select(*KEYS, "JobId")


@query(
    "territory_lookup",
    f"""SELECT {KEYS_SQL}, lower(State) AS State, rep
        FROM (SELECT *, {q.state('job_location')} AS State FROM {POST})
        LEFT JOIN (SELECT DISTINCT state AS of_state, rep FROM ({TERRITORY_SQL}))
          ON of_state = State""",
)
def territory_lookup(spark, sf_dir):
    rows = postings(spark, sf_dir).select(
        *KEYS, F.lower(p.extract_state(F.col("job_location"))).alias("State")
    )
    return relational.territory_lookup(rows, spark.sql(TERRITORY_SQL))


@query(
    "top1",
    """SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey,
         arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey""",
)
def top1(spark, sf_dir):
    return relational.top1(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderkey", "o_totalprice"
    )


FIRST = f"(SELECT query, arg_min(url, rank) AS url, arg_min(score, rank) AS score FROM ({RESULTS_SQL}) GROUP BY query)"


@query(
    "enrich_top1",
    f"SELECT {KEYS_SQL}, AccountName, url AS google_link FROM {ACCOUNTS} "
    f"LEFT JOIN {FIRST} ON AccountName = query",
)
def enrich_top1(spark, sf_dir):
    return relational.enrich_top1(_accounts(spark, sf_dir), search_results(spark, sf_dir))


@query(
    "enrich_kg",
    f"SELECT {KEYS_SQL}, AccountName, url || ' (' || CAST(score AS VARCHAR) || ')' AS entity "
    f"FROM {ACCOUNTS} LEFT JOIN {FIRST} ON AccountName = query",
)
def enrich_kg(spark, sf_dir):
    return relational.enrich_kg(_accounts(spark, sf_dir), search_results(spark, sf_dir))


ORDER_STRUCT = "{" + ", ".join(f"'{c}': {c}" for c in ORDER) + "}"


@query(
    "first_account_for_link",
    f"""SELECT {KEYS_SQL}, company_link, firstAccount FROM {POST} LEFT JOIN (
          SELECT company_link AS link, arg_min(account_name, {ORDER_STRUCT}) AS firstAccount
          FROM {POST} WHERE company_link IS NOT NULL GROUP BY company_link)
        ON company_link = link""",
)
def first_account_for_link(spark, sf_dir):
    rows = postings(spark, sf_dir).select(*ORDER, "company_link", "account_name")
    named = relational.first_account_for_link(
        rows, F.struct(*ORDER), link="company_link", account="account_name"
    )
    return named.select(*KEYS, "company_link", "firstAccount")


@query(
    "best_score",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_orderkey) = 1""",
)
def best_score(spark, sf_dir):
    return relational.best_score(
        table(spark, sf_dir, "orders").withColumn("pos", F.col("o_orderkey")),
        "o_custkey",
        "o_orderkey",
        "o_orderpriority",
        "pos",
    )


@query(
    "row_count",
    f"""SELECT 'postings' AS name, count(*) AS rows FROM {POST} UNION ALL
        SELECT 'documents', count(*) FROM documents UNION ALL
        SELECT 'words', CAST(sum(len(string_split(text, ' '))) AS BIGINT) FROM documents""",
)
def row_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return (
        postings(spark, sf_dir)
        .agg(F.count("*").alias("rows"))
        .select(F.lit("postings").alias("name"), "rows")
        .union(docs.agg(F.count("*")).select(F.lit("documents"), "*"))
        .union(docs.agg(F.sum(F.size(F.split("text", " ")))).select(F.lit("words"), "*"))
    )


@query(
    "batch_number",
    "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch FROM orders",
)
def batch_number(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return relational.batch_number(orders, ["o_orderkey"])


@query(
    "batch_number_postings",
    f"""SELECT batch, count(*) AS rows, min(l_orderkey) AS first_order FROM (
          SELECT *, (row_number() OVER (ORDER BY {ORDER_SQL}) - 1) // 100 AS batch FROM {POST})
        GROUP BY batch""",
)
def batch_number_postings(spark, sf_dir):
    numbered = relational.batch_number(postings(spark, sf_dir).select(*ORDER), ORDER)
    return numbered.groupBy("batch").agg(
        F.count("*").alias("rows"), F.min("l_orderkey").alias("first_order")
    )


@query(
    "sample_rows",
    "SELECT c_custkey, c_name FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)) LIMIT 5",
)
def sample_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return relational.sample_rows(customers, "c_custkey", 5)


@query(
    "concat_pages",
    """SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL
       SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer""",
)
def concat_pages(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    return relational.concat_pages(customers, suppliers, customers)
