import csv
import datetime
import random

import pytest
from pyspark.sql import types as T

from leadpipe.sources import readers
from leadpipe.sources.records import scan_records

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
PIECES = ["x", "word ", "é", "\n", "\n\n", '"', '""', ",", "\r\n", "", " ", '",\n"']


@pytest.fixture
def small_splits(spark):
    """Sets the bytes of a split, small enough for fields to lie over several."""

    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(path, rows, end="\n"):
    with path.open("w", newline="") as f:
        csv.writer(f, lineterminator=end).writerows([("a", "b", "c"), *rows])


def read(spark, path, **options):
    feed = readers.scan_csv(spark, str(path), SCHEMA, with_order=True, **options)
    return [tuple(r)[:3] for r in feed.orderBy(*readers.FEED_ORDER).collect()]


@pytest.mark.parametrize("size", [64, 400, 1_000_000])
def test_rows_are_those_written(spark, tmp_path, small_splits, size):
    """Quotes and line breaks at every border, of two kinds."""
    rng = random.Random(size)
    field = lambda: "".join(rng.choices(PIECES, k=rng.choice([0, 1, 3, 30])))
    expected = {}
    for name, end in (("one", "\n"), ("two", "\r\n")):
        expected[name] = [(f"{name}{i}", field(), field()) for i in range(25)]
        write(tmp_path / f"{name}.csv", expected[name], end)
    small_splits(size)
    assert read(spark, tmp_path) == [tuple(v or None for v in row) for rows in expected.values() for row in rows]
    whole = read(spark, tmp_path / "one.csv", whole_files=True)
    assert whole == read(spark, tmp_path / "one.csv") and len(whole) == 25


def test_every_place_of_the_border(spark, tmp_path, small_splits):
    """One quoted break is moved over the whole of a split."""
    for shift in range(0, 40, 3):
        write(tmp_path / f"f{shift:02}.csv", [("x" * shift, 'q "\n" q', "z"), ("p", "q", "r")])
    small_splits(40)
    found = read(spark, tmp_path)
    assert found == [row for s in range(0, 40, 3) for row in (("x" * s or None, 'q "\n" q', "z"), ("p", "q", "r"))]


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    write(tmp_path / "feed.csv", [(str(i), "line\nbreak", "z" * 50) for i in range(3_000)])
    small_splits(20_000)
    records = scan_records(spark, str(tmp_path / "feed.csv"))
    assert records.select("feed_block").distinct().count() > 5
    assert records.where("header").collect()[0].record == "a,b,c"
    assert records.count() == 3_001
    plan = records._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_more_splits_than_a_broadcast_may_hold(spark, tmp_path, small_splits, monkeypatch):
    write(tmp_path / "feed.csv", [(str(i), 'a\n"b"', "z" * (i % 50)) for i in range(200)])
    small_splits(300)
    expected = read(spark, tmp_path)
    monkeypatch.setattr("leadpipe.sources.records.MAX_BROADCAST_ROWS", 3)
    assert read(spark, tmp_path) == expected and len(expected) == 200


def test_rejects_of_both_readers(spark, tmp_path, small_splits):
    (tmp_path / "feed.csv").write_text('a,b,c\n1,2,3\n\nshort,"x\ny"\n4,5,6,7\n"8\n","9",\n')
    small_splits(8)
    both = [
        sorted(r.row for r in readers.csv_rejects(spark, str(tmp_path), SCHEMA, whole_files=whole).collect())
        for whole in (False, True)
    ]
    assert both[0] == both[1] and len(both[0]) == 2
    assert read(spark, tmp_path) == read(spark, tmp_path, whole_files=True) == [("1", "2", "3"), ("8\n", "9", None)]


def test_odd_files(spark, tmp_path, small_splits):
    """Empty files, files of a header alone or of empty lines, no line end at the end, a quote left open,
    which takes the rest of the file but its last line end."""
    for name, text in {"empty": "", "head": "a,b,c\n", "blank": "\n\r\n\n", "late": '\n\na,b,c\n1,2,3'}.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    assert read(spark, tmp_path) == [("1", "2", "3")]
    (tmp_path / "open.csv").write_text('a,b,c\n4,5,6\n7,8,"' + "nine\n" * 30)
    small_splits(30)
    assert read(spark, tmp_path)[1:] == [("4", "5", "6"), ("7", "8", "\n".join(["nine"] * 30))]


def test_a_quote_that_stays_open_is_an_error(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "open.csv").write_text('a,b,c\n7,8,"' + "nine\n" * 300)
    small_splits(100)
    monkeypatch.setattr("leadpipe.sources.records.MAX_RECORD", 500)
    with pytest.raises(Exception, match="a quote is not closed in"):
        read(spark, tmp_path)


LAYOUTS = {"plain": ["Title", "Score"], "indexed": [None, "Title", "Score", "Day"], "turned": ["score", "title"]}
TARGET = T.StructType(
    [T.StructField("title", T.StringType()), T.StructField("score", T.IntegerType()), T.StructField("day", T.DateType())]
)


def test_layouts(spark, tmp_path, small_splits):
    """Each file is read by its header, and what fits none is listed row by row."""
    files = {
        "a": 'Title,Score\n"one\nline",1\nNA,2\nshort\n',
        "b": ',Title,Score,Day\n0,two,x,2017-03-01\n1,"t,2",3,2017-13-01\n',
        "c": '﻿" SCORE ",title\r\n5,turned\r\n',
        "d": 'Title,Points\n"not\nknown",1\nnor,2\n',
        "e": "",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    small_splits(16)
    rows = readers.scan_layouts(spark, str(tmp_path), LAYOUTS, TARGET, with_order=True).orderBy(*readers.FEED_ORDER)
    day = datetime.date(2017, 3, 1)
    assert [tuple(r)[:4] for r in rows.collect()] == [
        ("one\nline", 1, None, "plain"),
        (None, 2, None, "plain"),
        ("two", None, day, "indexed"),
        ("t,2", 3, None, "indexed"),
        ("turned", 5, None, "turned"),
    ]
    rejects = readers.layout_rejects(spark, str(tmp_path), LAYOUTS, TARGET).collect()
    assert sorted((r.row, r.reason) for r in rejects) == [
        ('"not\nknown",1', "unknown layout"),
        ("nor,2", "unknown layout"),
        ("short", "number of fields"),
    ]
