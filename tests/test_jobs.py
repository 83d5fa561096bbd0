"""Whole jobs on small invented postings."""

import datetime
from pathlib import Path

import pytest

from leadpipe import session
from leadpipe.plans import cleaning, daily
from leadpipe.schemas import CLEAN_COLUMNS, RAW_COLUMNS, UPLOAD_COLUMNS
from leadpipe.sources.readers import CSV_FORMAT
from leadpipe.streaming import incremental
from workload.data import dims

DAY = datetime.date(2017, 3, 31)
SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", seq bigint"


def posting(seq, job, age="Just posted", title="Lead Gear", account="acme co", link=None, loc="X, NY"):
    url = None if job is None else f"https://x/rc/clk?jk={job}&fccid=1" if job else "https://x/v"
    return ("u", url, title, link, account, loc, "What’s new?", age, seq)


@pytest.fixture
def raw(frame):
    return frame(
        [
            posting(1, "fresh-old", "3 days ago"),
            posting(2, "fresh-old", "30+ days ago"),
            posting(3, "old-fresh", "30+ days ago"),
            posting(4, "old-fresh", "Just posted"),
            posting(5, "new", "29 days ago", account="o'neil", link="http://c", loc=None),
            posting(6, ""),
            posting(7, None),
            posting(8, "nodate", None),
            posting(9, "nonumber", "days ago"),
            posting(10, "notitle", title=None),
            posting(11, "low", title="Clerk"),
        ],
        SCHEMA,
    )


def test_clean_postings(raw):
    clean = cleaning.clean_postings(raw, DAY, ["seq"])
    assert clean.columns == CLEAN_COLUMNS
    rows = {r.JobId: r for r in clean.collect()}
    # An id whose first row is old is gone, even if a later one is fresh.
    assert set(rows) == {"fresh-old", "new", "low"}
    assert rows["fresh-old"].PostDate == datetime.date(2017, 3, 28)
    assert rows["new"].AccountName == "O'Neil"
    assert rows["new"].JobDescription == "What   s new"


def test_rejects_and_clean_rows_cover_the_input(raw):
    rejects = {r.seq: r.reason for r in cleaning.reject_postings(raw).collect()}
    assert rejects == {
        6: "no id in link",
        7: "no link",
        8: "no date",
        9: "no number of days",
        10: "no title",
    }
    assert raw.where(cleaning.can_be_cleaned()).count() + len(rejects) == raw.count()


def test_an_old_row_of_a_scored_title_still_hides_its_id(spark, frame):
    """Titles are joined whatever the age of the row; the first row of an id decides as before."""
    raw = frame(
        [
            posting(1, "a", "30+ days ago"),
            posting(2, "a", "Just posted"),
            posting(3, "b", "99999999999 days ago"),  # no number an age can have
            posting(4, "b", "1 day ago"),
            posting(5, "c", "1 day ago"),
            posting(6, "c", "30+ days ago"),
            posting(7, "d", "30+ days ago", title="Lead Bolt"),  # a title of old rows only
        ],
        SCHEMA,
    )
    scored = daily.scored_postings(raw, dims(spark), DAY, ["seq"], keep=["seq"])
    assert [(r.JobId, r.seq) for r in scored.collect()] == [("c", 5)]


def test_more_columns_are_carried(raw):
    kept = cleaning.clean_postings(raw, DAY, ["seq"], keep=["seq"])
    assert {r.seq for r in kept.collect()} == {1, 5, 11}


@pytest.fixture
def results(frame):
    return frame(
        [("Acme Co", 2, "http://late", 1.0), ("Acme Co", 1, "http://acme", 1.0)],
        "query string, rank bigint, url string, score double",
    )


def test_daily_upload(spark, frame, raw, results):
    existing = frame(["gone"], "JobId string")
    new = daily.daily_upload(raw, dims(spark), results, existing, DAY, ["seq"])
    assert new.columns == UPLOAD_COLUMNS
    rows = {r.JobId: r for r in new.collect()}
    assert set(rows) == {"fresh-old", "new"}
    assert rows["fresh-old"].CompanyLink == "http://acme"
    assert rows["fresh-old"].State == "NY"
    assert rows["new"].State is None
    assert rows["new"].CompanyLink is None  # the search found nothing
    own = daily.daily_upload(raw, dims(spark), results, existing, DAY, ["seq"], keep_own_link=True)
    assert {r.JobId: r.CompanyLink for r in own.collect()}["new"] == "http://c"
    known = frame(["new", "fresh-old"], "JobId string")
    assert daily.daily_upload(raw, dims(spark), results, known, DAY, ["seq"]).count() == 0


def test_days_in_a_row(spark, raw, results, tmp_path):
    target, report = str(tmp_path / "target"), str(tmp_path / "report")

    def run(day):
        batches = daily.run_daily(
            spark, raw, dims(spark), results, target, report, day, ["seq"]
        )
        return sum(r["rows"] for r in batches.collect())

    before = set(Path(session.shared_dir(spark).removeprefix("file:")).glob("*"))
    next_day = DAY + datetime.timedelta(days=1)
    assert run(DAY) == 2
    assert run(DAY) == 2  # a rerun replaces its own rows
    assert run(next_day) == 0  # nothing new
    # The job removes the tables it kept for itself.
    assert set(Path(session.shared_dir(spark).removeprefix("file:")).glob("*")) == before
    assert spark.read.parquet(target).count() == 2
    assert spark.read.option("header", True).csv(report).count() == 2


def test_link_discovery(spark, frame):
    postings = frame(
        [("http://p/1", "Acme Co"), ("http://p/1", "Acme Co"), ("http://p/2", "Other")],
        "CompanyLink string, AccountName string",
    )
    pages = frame(
        [(1, "http://p/1", "<dd><a href='http://x.org'>x</a><a href='http://acmeco.com'>a</a></dd>")],
        "page_id bigint, url string, html string",
    )
    rows = daily.link_discovery(postings, pages).collect()
    assert {r.AccountName: r.link for r in rows} == {
        "Acme Co": "http://acmeco.com",
        "Other": "https://www.google.com/#q=Other",
    }


def test_incremental_upload_and_replay(spark, frame, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    schema = frame([("a", 1)], "id string, n int").schema

    def run(checkpoint="checkpoint"):
        incremental.incremental_upload(
            spark, landing, schema, target, str(tmp_path / checkpoint), "id", ["n"]
        )
        return {(r.id, r.n) for r in spark.read.schema(schema).parquet(target).collect()}

    frame([("a", 2), ("a", 1), ("b", 1)], schema).write.parquet(landing)
    assert run() == {("a", 1), ("b", 1)}
    frame([("a", 0), ("c", 5)], schema).write.mode("append").parquet(landing)
    assert run() == {("a", 1), ("b", 1), ("c", 5)}
    assert run() == {("a", 1), ("b", 1), ("c", 5)}  # no new files
    # A lost checkpoint replays everything as batch 0, which replaces its rows only.
    assert {i for i, _ in run("lost")} == {"a", "b", "c"}
    assert spark.read.schema(schema).parquet(target).count() == 3


def test_incremental_upload_from_csv(spark, frame, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    rows = frame([("a", "one\ntwo"), ("b", " x "), ("c", None)], "id string, v string")
    rows.coalesce(1).write.options(**CSV_FORMAT).csv(landing)
    incremental.incremental_upload(
        spark, landing, rows.schema, target, str(tmp_path / "checkpoint"), "id", ["v"], fmt="csv"
    )
    found = spark.read.schema(rows.schema).parquet(target).collect()
    assert {(r.id, r.v) for r in found} == {("a", "one\ntwo"), ("b", " x "), ("c", None)}
