"""Sources and sinks: what is written is read back whole."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadpipe.functions import postings as p
from leadpipe.schemas import RAW_COLUMNS, TARGET_FIELDS, TARGET_TYPE
from leadpipe.session import scratch_path
from leadpipe.sources import readers, sinks
from workload import sqltext as q
from workload.data import (
    AS_OF,
    EXISTING_SQL,
    ORDER,
    POSTINGS_SQL,
    RESULTS_SQL,
    existing_ids,
    postings,
    search_results,
    table,
)
from workload.registry import query

RAW_SQL = ", ".join(RAW_COLUMNS)


@query("scan_csv", f"SELECT {RAW_SQL} FROM ({POSTINGS_SQL})")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "feed")
    postings(spark, sf_dir).select(*RAW_COLUMNS).write.options(**readers.CSV_PACKED).csv(path)
    return readers.scan_csv(spark, path)


@query(
    "scan_csv_documents",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, lang FROM documents",
)
def scan_csv_documents(spark, sf_dir):
    """Whole texts with line breaks and quotes survive the CSV feed."""
    path = scratch_path(spark, "feed")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", "lang"
    )
    docs.write.options(**readers.CSV_FORMAT).csv(path)
    return readers.scan_csv(spark, path, docs.schema)


@query(
    "scan_dims",
    """SELECT 'title_matrix' AS sheet, p_partkey AS pos, p_name AS entry,
         CAST(p_size AS VARCHAR) AS value FROM part
       UNION ALL SELECT 'mapping', p_partkey, p_name, p_type FROM part
       UNION ALL SELECT 'level_mapping', p_partkey, p_name, p_brand FROM part
       UNION ALL SELECT 'keywords', p_partkey, p_name, CAST(p_size AS VARCHAR) FROM part
       UNION ALL SELECT 'no_match_levels', p_partkey, p_name, CAST(p_size AS VARCHAR) FROM part""",
)
def scan_dims(spark, sf_dir):
    folder = scratch_path(spark, "sheets")
    part = table(spark, sf_dir, "part")
    columns = {
        "title_matrix": ["p_partkey", "p_name", "p_brand", "p_size"],
        "mapping": ["p_partkey", "p_name", "p_type"],
        "level_mapping": ["p_partkey", "p_name", "p_brand"],
        "keywords": ["p_partkey", "p_name", "p_size"],
        "no_match_levels": ["p_partkey", "p_name", "p_size"],
    }
    for name, chosen in columns.items():
        part.select(*chosen).write.options(**readers.CSV_FORMAT).csv(f"{folder}/{name}")
    sheets = readers.scan_dims(spark, folder)
    rows = None
    for name, sheet in sheets.items():
        pos, entry, *_, value = sheet.columns
        one = sheet.select(
            F.lit(name).alias("sheet"),
            F.col(pos).cast("bigint").alias("pos"),
            F.col(entry).alias("entry"),
            F.col(value).cast("string").alias("value"),
        )
        rows = one if rows is None else rows.union(one)
    return rows


# The layouts that uploads have had over time: with and without an index, with more columns, in another order.
_LAYOUTS = {
    "indexed": [None, "JobTitle", "JobLink", "AccountName", "PostDate", "titleScore"],
    "with state": ["JobLink", "JobTitle", "AccountName", "PostDate", "titleScore", "State"],
    "with link": [None, "JobLink", "JobTitle", "AccountName", "PostDate", "titleScore", "google_link"],
}
_UPLOADS = """
SELECT o_orderkey AS key, {docs}.text AS JobTitle, o_orderpriority AS JobLink, nullif({docs}.lang, '') AS AccountName,
  CAST(o_orderdate AS DATE) AS PostDate, CAST(o_orderkey % 97 AS INT) AS titleScore, o_orderstatus AS State
FROM {orders} JOIN {docs} ON o_orderkey = {docs}.doc_id
"""


@query(
    "scan_layouts",
    f"""SELECT nullif(JobTitle, '') AS JobTitle, JobLink, AccountName,
         strftime(PostDate, '%Y-%m-%d') AS PostDate, titleScore, CASE WHEN key % 3 = 1 THEN State END AS State,
         CASE key % 3 WHEN 0 THEN 'indexed' WHEN 1 THEN 'with state' ELSE 'with link' END AS layout
       FROM ({_UPLOADS.format(orders="orders", docs="documents")})""",
)
def scan_layouts(spark, sf_dir):
    """Files of three layouts and an unknown one in one folder; whole texts with line breaks are a column."""
    folder = scratch_path(spark, "uploads")
    tables = {"orders": table(spark, sf_dir, "orders"), "docs": table(spark, sf_dir, "documents")}
    rows = spark.sql(_UPLOADS, **tables)
    write = lambda part, columns: (
        part.select(*columns).write.mode("append").options(**readers.CSV_FORMAT).csv(folder)
    )
    for kind, header in enumerate(_LAYOUTS.values()):
        columns = [F.col("key").alias("index") if c is None else F.lit("x").alias(c) if c == "google_link" else c for c in header]
        write(rows.where(F.col("key") % 3 == kind), columns)
    write(rows, ["JobLink", "key"])
    schema = T.StructType.fromDDL(
        "JobTitle string, JobLink string, AccountName string, PostDate date, titleScore int, State string"
    )
    return readers.scan_layouts(spark, folder, _LAYOUTS, schema).withColumn("PostDate", F.col("PostDate").cast("string"))


# Level columns of a matrix as people keep it.
_LEVELS = ["Manager", "Director", "Vice President"]


@query(
    "scan_dims_wide",
    """SELECT 'title_matrix' AS sheet, CAST(nth AS INTEGER) AS pos, p_name AS entry, level AS more,
         CASE level WHEN 'manager' THEN p_size WHEN 'director' THEN p_size + 1 ELSE p_size * 2 END AS value
       FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS nth FROM part),
         (VALUES ('manager'), ('director'), ('vice president')) AS l(level)
       WHERE NOT (level = 'director' AND p_size % 5 = 0)
       UNION ALL SELECT 'keywords', CAST(row_number() OVER (ORDER BY p_partkey) AS INTEGER), p_name, NULL, p_size
       FROM part""",
)
def scan_dims_wide(spark, sf_dir):
    """Sheets without positions, the matrix with a column per level and empty cells."""
    folder = scratch_path(spark, "sheets")
    part = table(spark, sf_dir, "part").orderBy("p_partkey")
    cells = [F.col("p_size"), F.when(F.col("p_size") % 5 != 0, F.col("p_size") + 1), F.col("p_size") * 2]
    matrix = part.select(F.col("p_name").alias("Title"), *[c.alias(n) for c, n in zip(cells, _LEVELS, strict=True)])
    two = {"mapping": "p_type", "level_mapping": "p_brand", "keywords": "p_size", "no_match_levels": "p_size"}
    written = {"title_matrix": matrix} | {name: part.select("p_name", value) for name, value in two.items()}
    for name, sheet in written.items():
        sheet.write.options(**readers.CSV_FORMAT).csv(f"{folder}/{name}")
    sheets = readers.scan_dims_wide(spark, folder)
    wide = sheets["title_matrix"].select(
        F.lit("title_matrix").alias("sheet"), "pos", F.col("title").alias("entry"), F.col("level").alias("more"),
        F.col("points").alias("value"),
    )
    return wide.unionByName(
        sheets["keywords"].select(
            F.lit("keywords").alias("sheet"), "pos", F.col("keyword").alias("entry"),
            F.lit(None).cast("string").alias("more"), F.col("points").alias("value"),
        )
    )


@query("scan_existing", EXISTING_SQL)
def scan_existing(spark, sf_dir):
    target = scratch_path(spark, "target")
    rows = existing_ids(spark, sf_dir).select(
        F.col("JobId").alias("JobId__c"), F.concat(F.lit("Id"), "JobId").alias("Id")
    )
    rows.write.parquet(sinks.run_folder(target, AS_OF))
    return readers.scan_existing(spark, target).select("JobId")


# Pages of a hundred keys; one without a following page ends its chain.
_STORED_PAGES = """
SELECT concat('q-', nth) AS page, to_json(named_struct('records', records, 'done', next IS NULL,
  'queryLocator', if(next IS NULL, NULL, concat('q-', next)))) AS response
FROM (SELECT o_orderkey DIV 100 AS nth, collect_list(named_struct('Id', concat('a', o_orderkey),
        'JobId__c', hex(o_orderkey), 'Status', o_orderstatus)) AS records FROM {orders} GROUP BY 1)
  LEFT JOIN (SELECT DISTINCT o_orderkey DIV 100 AS next FROM {orders}) ON next = nth + 1
"""


@query(
    "scan_existing_pages",
    """SELECT concat('q-', o_orderkey // 100) AS page, concat('a', o_orderkey) AS Id,
         printf('%X', o_orderkey) AS JobId__c FROM orders""",
)
def scan_existing_pages(spark, sf_dir):
    """Known ids from the stored pages of a query's response."""
    path = scratch_path(spark, "responses")
    spark.sql(_STORED_PAGES, orders=table(spark, sf_dir, "orders")).write.parquet(path)
    return readers.existing_from_pages(spark.read.parquet(path), "Id string, JobId__c string")


@query("scan_pages", "SELECT page_id, url, html FROM pages")
def scan_pages(spark, sf_dir):
    return readers.scan_pages(spark, f"{sf_dir}/pages.parquet")


@query("scan_search_results", RESULTS_SQL)
def scan_search_results(spark, sf_dir):
    path = scratch_path(spark, "results")
    search_results(spark, sf_dir).write.parquet(path)
    return readers.scan_search_results(spark, path)


_RESPONSES = """
SELECT c_name AS query,
  concat('{{"items": [{{"formattedUrl": "https://www.example.com/', o_orderkey, '"}}, ',
    '{{"formattedUrl": "https://www.example.org/', o_orderkey, '", "title": "x"}}]}}') AS results,
  concat('{{"itemListElement": [{{"resultScore": ', o_totalprice,
    ', "result": {{"name": "x", "url": "https://www.example.com/', o_orderkey, '"}}}}, ',
    '{{"result": {{"name": "no address"}}}}]}}') AS entities
FROM {customer} JOIN {orders} ON c_custkey = o_custkey
"""


def _responses(spark, sf_dir, column):
    tables = {t: table(spark, sf_dir, t) for t in ("customer", "orders")}
    return spark.sql(_RESPONSES, **tables).select("query", F.col(column).alias("response"))


@query(
    "search_results_from_json",
    """SELECT c_name AS query, CAST(1 AS BIGINT) AS rank,
         concat('https://www.example.com/', o_orderkey) AS url, CAST(NULL AS DOUBLE) AS score
       FROM customer JOIN orders ON c_custkey = o_custkey UNION ALL
       SELECT c_name, 2, concat('https://www.example.org/', o_orderkey), NULL
       FROM customer JOIN orders ON c_custkey = o_custkey""",
)
def search_results_from_json(spark, sf_dir):
    return readers.search_results_from_json(_responses(spark, sf_dir, "results"))


@query(
    "entities_from_json",
    """SELECT c_name AS query, CAST(1 AS BIGINT) AS rank,
         concat('https://www.example.com/', o_orderkey) AS url, o_totalprice AS score
       FROM customer JOIN orders ON c_custkey = o_custkey UNION ALL
       SELECT c_name, 2, NULL, NULL FROM customer JOIN orders ON c_custkey = o_custkey""",
)
def entities_from_json(spark, sf_dir):
    return readers.entities_from_json(_responses(spark, sf_dir, "entities"))


@query("sink_dated_csv", f"SELECT {RAW_SQL}, '{AS_OF}' AS run_date FROM ({POSTINGS_SQL})")
def sink_dated_csv(spark, sf_dir):
    target = scratch_path(spark, "dated")
    rows = postings(spark, sf_dir).select(*RAW_COLUMNS)
    for _ in range(2):  # the second run replaces the first
        sinks.sink_dated_csv(rows, target, AS_OF)
    schema = ", ".join(f"{c} string" for c in [*RAW_COLUMNS, "run_date"])
    return spark.read.schema(schema).options(**readers.CSV_FORMAT).csv(target)


@query(
    "sink_append_batches",
    f"""SELECT batch, count(*) AS rows FROM (
          SELECT (row_number() OVER () - 1) // 100 AS batch FROM ({POSTINGS_SQL})) GROUP BY batch""",
)
def sink_append_batches(spark, sf_dir):
    target = scratch_path(spark, "target")
    return sinks.sink_append_batches(_target_rows(spark, sf_dir), target, AS_OF, ORDER)


def _target_rows(spark, sf_dir):
    return postings(spark, sf_dir).select(
        *ORDER,
        p.extract_job_id(F.col("job_link")).alias("JobId"),
        F.col("account_name").alias("AccountName"),
        F.col("job_location").alias("JobLocation"),
        F.lit(AS_OF).alias("PostDate"),
        F.col("title").alias("JobTitle"),
        F.col("job_link").alias("JobLink"),
        F.col("job_description").alias("JobDescription"),
        F.col("company_link").alias("CompanyLink"),
        p.parse_days_ago(F.col("job_date")).alias("titleScore"),
        p.extract_state(F.col("job_location")).alias("State"),
    )


@query(
    "sink_append_batches_rows",
    f"""SELECT {q.job_id('job_link')} AS JobId__c, account_name AS Account_Name__c,
          job_location AS Job_Location__c, title AS Job_Title__c, job_link AS Job_Link__c,
          job_description AS Job_Description__c, company_link AS Company_Link__c,
          {q.days_ago('job_date')} AS Title_Score__c, {q.state('job_location')} AS State__c,
          '{TARGET_TYPE}' AS type FROM ({POSTINGS_SQL})""",
)
def sink_append_batches_rows(spark, sf_dir):
    target = scratch_path(spark, "target")
    sinks.sink_append_batches(_target_rows(spark, sf_dir), target, AS_OF, ORDER)
    fields = [f for f in TARGET_FIELDS.values() if f != "Post_Date__c"]
    return spark.read.parquet(target).select(*fields, "type")


@query(
    "sink_delete_by_id",
    """SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer
         WHERE c_mktsegment = 'MACHINERY')""",
)
def sink_delete_by_id(spark, sf_dir):
    listed = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "MACHINERY")
    return sinks.sink_delete_by_id(
        table(spark, sf_dir, "orders"),
        listed.select(F.col("c_custkey").alias("o_custkey")),
        "o_custkey",
        scratch_path(spark, "kept"),
    )


@query(
    "sink_update_by_id",
    f"""SELECT o_orderkey, coalesce(rate, o_totalprice) AS o_totalprice FROM orders LEFT JOIN (
          SELECT l_orderkey, arg_max({q.truncated('l_extendedprice / 777')},
            {{'n': l_linenumber, 'p': l_partkey, 's': l_suppkey, 'e': l_extendedprice}}) AS rate
          FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
        ON o_orderkey = l_orderkey""",
)
def sink_update_by_id(spark, sf_dir):
    target = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    updates = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(
            F.col("l_orderkey").alias("o_orderkey"),
            (F.col("l_extendedprice") / 777).alias("o_totalprice"),
            F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("nth"),
        )
    )
    return sinks.sink_update_by_id(
        target, updates, "o_orderkey", "o_totalprice", scratch_path(spark, "updated"), "nth"
    )
