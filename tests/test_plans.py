"""Properties of the physical plans."""

import re

import pytest

from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from leadpipe.operators import relational

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["score_title", "daily_upload", "anti_existing", "enrich_top1", "company_links", "map_tokens"],
)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "EvalPython" not in text


def test_title_is_scored_once(spark):
    df = queries()["filter_score"](spark, SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in text.splitlines() if re.search(r"Filter .*>= 80", line)]
    assert len(filters) == 1
    # Rows meet a table of their distinct titles' scores; no row is searched itself.
    assert "aggregate(" not in text


def test_rows_move_only_where_many_titles_score_high(spark, frame):
    """The table of high-scoring titles is known in size, so no text is shuffled to meet it."""
    from leadpipe.operators.scoring import add_title_score
    from workload.data import dims

    rows = frame([("red ring", "text"), ("none of it", "text")] * 20, "JobTitle string, job_description string")
    text = plan(add_title_score(rows, dims(spark), min_score=80))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(queries()["anti_existing"](spark, SF))
    orders = [line for line in text.splitlines() if "orders.parquet" in line]
    assert any("ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in x for x in orders)
    assert any("EqualTo(o_orderstatus,F)" in x for x in orders)
    assert not any("l_extendedprice" in x or "l_tax" in x for x in text.splitlines())


def test_clean_postings_shuffles_rows_once(spark):
    text = plan(queries()["clean_postings"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("WindowGroupLimit") == 2


def test_daily_upload_keeps_the_partitioning_by_id(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(queries()["daily_upload"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Once for the postings (deduplication and anti-join share it), once for the known ids.
    assert len(re.findall(r"Exchange hashpartitioning\((JobId|_key)#", text)) == 2


def test_daily_upload_scores_before_the_shuffle(spark):
    text = plan(queries()["daily_upload"](spark, SF))
    # Read bottom up: meet the scores, keep texts of wanted rows, one row per id, shuffle.
    scores = re.search(r"FileScan parquet \[text#\d+,_score#", text)
    assert text.index("hashpartitioning(JobId") < scores.start()
    assert "aggregate(" not in text and "hashpartitioning(JobTitle" not in text


def test_batches_need_no_window_over_the_rows(spark):
    text = plan(queries()["batch_number_postings"](spark, SF))
    window = text[text.index("Window [") :]
    assert "HashAggregate(keys=[_part" in window  # only the partition counts are below it


def test_every_query_with_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_hot_keys_are_split_in_lookups(spark):
    """With joins shuffled, adaptive execution splits the partition of a hot key."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        name = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id")))
        rows = spark.range(0, 90_000, 1, 8).select("id", name.alias("AccountName"))
        results = spark.range(0, 90_000, 1, 8).select(
            F.concat(F.lit("n"), "id").alias("query"),
            F.lit(1).alias("rank"),
            F.col("id").cast("string").alias("url"),
        )
        old = results.select(F.col("query").alias("AccountName"))
        jobs = {
            relational.enrich_top1(rows, results): 90_000,
            relational.first_account_for_link(rows, "id", link="AccountName", account="id"): 90_000,
            relational.anti_existing(rows, old, "AccountName"): 30_000,
        }
        for found, n in jobs.items():
            assert len(found.collect()) == n
            assert "skew=true" in plan(found)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_lines_move_once_to_meet_orders_and_customers(spark, monkeypatch):
    """Orders meet their customers before the lines of orders come in."""
    from workload import data

    monkeypatch.setattr(data, "LARGE_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(data.postings(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = text[text.index("hashpartitioning(o_custkey") :]
    assert "o_orderkey" in re.search(r"FileScan parquet \[([^]]*)", below).group(1)


def test_large_scans_are_spread_by_the_next_join(spark):
    """What is spread by its key is not shuffled again to be joined."""
    from workload import data

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = data.spread(spark.range(100).coalesce(1), "id")
        text = plan(rows.join(spark.range(50).withColumnRenamed("id", "other"), F.col("id") == F.col("other")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(id") == 1 and "RoundRobin" not in text


def test_scores_meet_their_rows_by_digests(spark):
    """Found scores and keywords travel without the texts they belong to."""
    text = plan(queries()["score_documents"](spark, SF))
    assert "hashpartitioning(title" not in text and "hashpartitioning(text" not in text
    assert "hashpartitioning(rest#" not in text


def test_titles_are_listed_without_a_look_into_links(spark, monkeypatch):
    """Titles are scored once; only their rows are held against the rules for links."""
    from leadpipe.plans import daily

    score, asked = daily.add_title_score, []

    def add_title_score(df, *args, titles=None, **rules):
        asked.append(df if titles is None else titles)
        return score(df, *args, titles=titles, **rules)

    monkeypatch.setattr(daily, "add_title_score", add_title_score)
    queries()["scored_postings"](spark, SF)
    assert "RLIKE" not in plan(asked[0].select("JobTitle"))


def test_links_are_searched_once_for_their_ids(spark):
    """No filter looks into the links again, and only those with a key are searched for it."""
    for name in ("clean_postings", "daily_upload"):
        text = plan(queries()[name](spark, SF))
        assert len(re.findall(r"RLIKE\([^\n]*jk=", text)) == 0
        assert text.count("-([a-z0-9]+)") == 1


def test_the_stage_of_large_postings_is_compiled(spark, monkeypatch):
    """Java leaves methods of more than 8,000 bytes to its interpreter, so no generated one is as long."""
    from workload import data

    monkeypatch.setattr(data, "LARGE_ROWS", 10)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "20000"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = queries()["daily_upload"](spark, SF)
        codegen = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = rows._jdf.queryExecution().explainString(codegen)
    finally:
        for key in settings:
            spark.conf.unset(key)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000
