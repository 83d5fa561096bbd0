"""CSV records of large files, read by many tasks although fields may hold line breaks.

A line break belongs to a record where the number of quotes before it is odd.  Spark splits a text file
at line ends, so the quotes of each split are counted first.  From the sums of the earlier splits each
one then knows whether it begins inside a quoted field.  Its task joins lines to records, and the few
records that go over a border between splits are joined from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadpipe.operators.relational import MAX_BROADCAST_ROWS
from leadpipe.session import scratch_path

# Most characters of the splits that lie within one record: what a quote that is never closed swallows.
MAX_RECORD = 256_000_000
RECORDS = "feed_file string, feed_block long, feed_row long, record string"


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of `records_and_headers`."""
    return records_and_headers(spark, path)[0]


def records_and_headers(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Every record of the files as it stands there, with its place and whether it is the file's header.

    `feed_file, feed_block, feed_row` order the records, by the file's name and then as in the file;
    `header` is true for the first record of each file.  The second table has the first line of each file that
    is not empty (`feed_file, line`).  Records end with a line feed, after a carriage
    return or not, and empty ones are left out.  Quotes stand around fields and are doubled inside them:
    a single one within a plain field is taken for the start of a quoted one.

    The input is read three times, twice by the JVM alone.  Nothing but the records over a border between
    splits is shuffled.  A file that changes between the reads is an error, and so is a quote that is
    still open after MAX_RECORD characters of whole splits.  Where executors come and go, small files
    may be split anew between the reads; `spark.sql.files.minPartitionNum` fixes that.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row"),
            F.col("value").alias("line"),
            ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1).alias("odd"),
        )
    )
    written = scratch_path(spark, "splits")
    _splits(lines).write.parquet(written)
    splits = spark.read.parquet(written)
    known = splits.select(F.col("file").alias("of_file"), F.col("block").alias("of_block"), "lines", "first_row", "start",
                          "owner", "opens", "first_odd", "last_odd")
    small = splits.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    same = (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block"))
    placed = lines.join(F.broadcast(known) if small else known, same, "left")
    ordered = placed if small else placed.repartition("file", "block").sortWithinPartitions("file", "block", "row")
    whole = ordered.select("file", "block", "row", "line", "odd", "start", "first_row", "lines").mapInArrow(_join_lines, RECORDS)
    found = whole.unionByName(_over_borders(placed))
    heads = splits.where("first IS NOT NULL").groupBy("file").agg(F.min(F.struct("block", "first")).alias("head"))
    heads = heads.select("file", "head.block", "head.first.row", "head.first.line")
    headers = heads.select(F.col("file").alias("feed_file"), F.regexp_replace("line", "\r$", "").alias("line"))
    heads = heads.drop("line")
    is_head = (F.col("feed_file") == F.col("file")) & (F.col("feed_block") == F.col("block")) & (F.col("feed_row") == F.col("row"))
    record = F.regexp_replace("record", "\r$", "")
    records = (
        found.withColumn("record", record)
        .where(F.col("record") != "")
        .join(F.broadcast(heads) if small else heads, is_head, "left")
        .select("feed_file", "feed_block", "feed_row", "record", F.col("file").isNotNull().alias("header"))
    )
    return records, headers


def _splits(lines: DataFrame) -> DataFrame:
    """Per split its lines and the places of those with an odd number of quotes; whether it starts inside
    a quoted field, which earlier split began that record (`owner`), and whether its own last record
    goes on in the next (`opens`)."""
    per = lines.groupBy("file", "block").agg(
        F.count("*").alias("lines"),
        F.min("row").alias("first_row"),
        F.count_if("odd").alias("odds"),
        F.min(F.when(F.col("odd"), F.col("row"))).alias("first_odd"),
        F.max(F.when(F.col("odd"), F.col("row"))).alias("last_odd"),
        F.min(F.when(~F.col("line").isin("", "\r"), F.struct("row", "line"))).alias("first"),
        F.sum(F.length("line")).alias("chars"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    states = per.withColumn("start", F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2 == 1).withColumn(
        "opens", (F.col("odds") > 0) & (F.col("start") != (F.col("odds") % 2 == 1))
    )
    owned = states.withColumn("owner", F.last(F.when(F.col("opens"), F.col("block")), ignorenulls=True).over(before))
    # Splits that lie within a record; their sizes bound what is joined to one value.
    inner = F.sum(F.when(F.col("start") & (F.col("odds") == 0), F.col("chars"))).over(Window.partitionBy("file", "owner"))
    endless = F.concat(F.lit("a quote is not closed in "), "file", F.lit(" after byte "), F.col("owner").cast("string"))
    checked = F.when(inner > MAX_RECORD, F.raise_error(endless)).otherwise(F.col("start"))
    return owned.withColumn("start", checked).drop("odds", "chars")


def _over_borders(placed: DataFrame) -> DataFrame:
    """The records over borders between splits, from the end of one, what lies between, and the start of another."""
    head = F.col("start") & (F.col("first_odd").isNull() | (F.col("row") <= F.col("first_odd")))
    tail = F.col("opens") & (F.col("row") >= F.col("last_odd"))
    # One line can end a record and begin the next only where it is not odd, so it is never both.
    pieces = placed.where(head | tail).select("file", F.when(tail, F.col("block")).otherwise(F.col("owner")).alias("from"),
                                              "block", "row", "line")
    joined = pieces.groupBy("file", "from").agg(F.array_sort(F.collect_list(F.struct("block", "row", "line"))).alias("all"))
    return joined.select(
        F.col("file").alias("feed_file"),
        F.col("from").alias("feed_block"),
        F.col("all")[0]["row"].alias("feed_row"),
        F.array_join(F.transform("all", lambda p: p["line"]), "\n").alias("record"),
    )


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that begin and end in one split; `inside` is a piece of one from an earlier split."""
    split, seen, expected, inside, held, first = None, 0, 0, False, [], 0

    def check():
        if split is not None and seen != expected:
            raise RuntimeError(f"{split[0]} was changed or split anew between two reads")

    for batch in batches:
        out = []
        for file, block, row, line, odd, start, first_row, lines in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, block) != split:
                check()
                if start is None or row != first_row:
                    raise RuntimeError(f"{file} was changed or split anew between two reads")
                split, seen, expected, inside, held = (file, block), 0, lines, start, []
            seen += 1
            if inside:
                inside = not odd
            elif held:
                held.append(line)
                if odd:
                    out.append((file, block, first, "\n".join(held)))
                    held = []
            elif odd:
                held, first = [line], row
            else:
                out.append((file, block, row, line))
        columns = zip(*out, strict=True) if out else ([], [], [], [])
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["feed_file", "feed_block", "feed_row", "record"])
    check()
