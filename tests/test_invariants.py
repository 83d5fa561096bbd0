"""What holds for every upload, whatever the postings."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from leadpipe.functions import postings as p
from leadpipe.plans import cleaning, daily
from leadpipe.sources import readers
from workload.data import AS_OF, ORDER, dims, existing_ids, postings, search_results

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def upload(spark):
    return daily.daily_upload(
        postings(spark, SF),
        dims(spark),
        search_results(spark, SF),
        existing_ids(spark, SF),
        AS_OF,
        ORDER,
    ).collect()


def test_ids_are_unique_new_and_from_the_link(spark, upload):
    ids = [r.JobId for r in upload]
    assert ids and len(ids) == len(set(ids))
    assert not set(ids) & {r.JobId for r in existing_ids(spark, SF).collect()}
    df = spark.createDataFrame(upload).withColumn("again", p.extract_job_id(F.col("JobLink")))
    assert df.where("again <> JobId").count() == 0


def test_values(spark, upload):
    for r in upload:
        assert r.titleScore >= 80
        assert datetime.timedelta(0) <= AS_OF - r.PostDate < datetime.timedelta(days=30)
        assert re.fullmatch("[A-Za-z0-9_ ]*", r.JobDescription)
        assert r.State is None or re.fullmatch("([A-Z]{2})+", r.State)
        assert r.State == ("".join(re.findall("[A-Z][A-Z]", r.JobLocation or "")) or None)
    df = spark.createDataFrame(upload)
    assert df.where(p.title_case(F.col("AccountName")) != F.col("AccountName")).count() == 0


def test_score_depends_on_the_title_only(upload):
    scores = {}
    for r in upload:
        assert scores.setdefault(r.JobTitle, r.titleScore) == r.titleScore


def test_partitioning_does_not_matter(spark, upload):
    settings = {"spark.sql.shuffle.partitions": "3", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        again = daily.daily_upload(
            postings(spark, SF).repartition(5),
            dims(spark),
            search_results(spark, SF).repartition(4),
            existing_ids(spark, SF),
            AS_OF,
            ORDER,
        ).collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sorted(again, key=str) == sorted(upload, key=str)


def test_from_a_csv_feed(spark, tmp_path):
    """The rows of a feed give the same clean postings in the order they were written."""
    raw = postings(spark, SF)
    texts = raw.orderBy(*ORDER).drop(*ORDER)
    texts.coalesce(1).write.options(**readers.CSV_FORMAT).csv(str(tmp_path / "feed"))
    feed = readers.scan_csv(spark, str(tmp_path / "feed"), with_order=True)
    direct = cleaning.clean_postings(raw, AS_OF, ORDER)
    read = cleaning.clean_postings(feed, AS_OF, readers.FEED_ORDER)
    assert direct.exceptAll(read).isEmpty() and read.exceptAll(direct).isEmpty()
    assert direct.count() > 0
