"""Sources: the raw feed, the scoring sheets and the lookup tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadpipe.operators.relational import MAX_BROADCAST_ROWS, number_rows, same_key
from leadpipe.schemas import DIMENSIONS, PAGES, RAW, SEARCH_RESULTS
from leadpipe.sources.records import records_and_headers, scan_records
from leadpipe.sources.workbook import scan_workbook

# Quotes inside a quoted field are doubled; blanks at the ends of a field stay.
CSV_FORMAT = {
    "header": True,
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# How large feeds and reports are written: texts shrink to a fraction.  A compressed file is read by one
# task, so none holds more rows than that.
CSV_PACKED = {**CSV_FORMAT, "compression": "gzip", "maxRecordsPerFile": 250_000}
# A row of another width is kept as text in this column, which is null for all others.
BAD_ROW = "_bad_row"
KEEP_BAD_ROWS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_ROW, "columnPruning": False}
BAD_WIDTH = "number of fields"
UNKNOWN_LAYOUT = "unknown layout"
# Fixed values the feed's reader takes for a missing field.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "N/A", "NA", "NULL", "NaN", "nan",
]


# Order of a feed's rows: by file name, then as in the file.
FEED_ORDER = ["feed_file", "feed_block", "feed_row"]


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW,
    multi_line: bool = True,
    with_order: bool = False,
    whole_files: bool = False,
) -> DataFrame:
    """Read the positional CSV feed under declared names and types.

    Rows with more or fewer fields are left out, and `csv_rejects` lists them; a
    feed that has no others and another header is an error.  Texts that
    stand for a missing field are read as null.  Fields may hold line breaks, and
    large files are read by many tasks, see `scan_records`; `multi_line=False` is
    faster where no field has one.  `whole_files=True` reads each file by one task:
    for feeds with single quotes inside plain fields or lines that end with a
    carriage return alone.
    """
    rows = _csv_rows(spark, path, schema, multi_line, whole_files).where(~is_bad(schema))
    header = spark.read.options(**CSV_FORMAT).csv(path).columns
    if len(header) != len(schema) and rows.isEmpty():
        raise ValueError(f"expected {len(schema)} columns, found {len(header)}: {header}")
    rows = rows.select(*schema.fieldNames(), *(FEED_ORDER if with_order else []))
    return missing_to_null(rows, schema.fieldNames())


def csv_rejects(
    spark: SparkSession, path: str, schema: T.StructType = RAW, multi_line: bool = True, whole_files: bool = False
) -> DataFrame:
    """Rows that `scan_csv` leaves out, as `row`, with the `reason`."""
    rows = _csv_rows(spark, path, schema, multi_line, whole_files)
    return rows.where(is_bad(schema)).select(
        F.col(BAD_ROW).alias("row"), F.lit(BAD_WIDTH).alias("reason")
    )


def with_bad_row(schema: T.StructType) -> T.StructType:
    """The schema with a field for rows that do not fit it."""
    return T.StructType([*schema.fields, T.StructField(BAD_ROW, T.StringType())])


def is_bad(schema: T.StructType) -> Column:
    """Is this a row of another width.

    Spark reads the column of bad rows only along with another one, so the test
    looks at both, at no character of the other.
    """
    other = F.substring(F.col(schema.fieldNames()[0]).cast("string"), 1, 0)
    return F.length(F.concat_ws("", BAD_ROW, other)) > 0


def _csv_rows(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool, whole_files: bool
) -> DataFrame:
    """The fields of the schema, BAD_ROW and FEED_ORDER."""
    if multi_line and not whole_files:
        records = scan_records(spark, path).where("NOT header")
        return records.select(F.inline(F.array(parse_record(F.col("record"), schema))), *FEED_ORDER)
    rows = (
        spark.read.schema(with_bad_row(schema))
        .options(**CSV_FORMAT, **KEEP_BAD_ROWS, multiLine=multi_line, enforceSchema=True)
        .csv(path)
    )
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("feed_file"),
        F.col("_metadata.file_block_start").alias("feed_block"),
        F.monotonically_increasing_id().alias("feed_row"),
    )


def parse_record(record: Column, schema: T.StructType) -> Column:
    """The fields of a CSV record and BAD_ROW as a struct."""
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in (CSV_FORMAT | KEEP_BAD_ROWS).items()}
    # A header is a record of its own here.
    return F.from_csv(record, with_bad_row(schema).toDDL(), options | {"header": "false", "multiLine": "true"})


def scan_layouts(
    spark: SparkSession,
    path: str,
    layouts: Mapping[str, Sequence[str | None]],
    schema: T.StructType,
    with_order: bool = False,
) -> DataFrame:
    """Read files of several layouts in one pass, each by the one its header names.

    A layout is the names of its columns in order, by which it is found whatever their case and the blanks
    around them; None stands for a column of any name.  Its columns go to those of the schema by name;
    a schema's column that a layout lacks is null, as is a value that does not have the type.
    `layout` tells which one a row's file has.  What is not read, `layout_rejects` lists.  Texts that stand
    for a missing field are null.  A header has no line breaks; the rest is as in `scan_csv`.
    """
    rows = _layout_rows(spark, path, layouts, schema).where(F.col("_reason").isNull())
    rows = rows.select(*schema.fieldNames(), "layout", *(FEED_ORDER if with_order else []))
    return missing_to_null(rows, schema.fieldNames())


def layout_rejects(
    spark: SparkSession, path: str, layouts: Mapping[str, Sequence[str | None]], schema: T.StructType
) -> DataFrame:
    """Rows that `scan_layouts` leaves out, as `row`, with the `reason` and their file: those of files
    of an unknown layout, and those of another width than their layout."""
    rows = _layout_rows(spark, path, layouts, schema).where(F.col("_reason").isNotNull())
    return rows.select(F.col(BAD_ROW).alias("row"), F.col("_reason").alias("reason"), "feed_file")


def layout_of(line: Column, layouts: Mapping[str, Sequence[str | None]]) -> Column:
    """The first layout that a header line fits, or null."""
    bare = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    found = F.lit(None).cast("string")
    for name, header in reversed(layouts.items()):
        fields = parse_record(F.regexp_replace(line, "^\ufeff", ""), _texts(len(header)))
        fits = fields[BAD_ROW].isNull()
        for i, column in enumerate(header):
            if column is not None:
                fits &= bare(fields[f"c{i}"]) == F.lit(column.strip().lower())
        found = F.when(fits, F.lit(name)).otherwise(found)
    return found


def _texts(n: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(n)])


def _layout_rows(
    spark: SparkSession, path: str, layouts: Mapping[str, Sequence[str | None]], schema: T.StructType
) -> DataFrame:
    """The fields of the schema, `layout`, BAD_ROW with the `_reason`, and FEED_ORDER."""
    records, headers = records_and_headers(spark, path)
    known = headers.select(F.col("feed_file").alias("of_file"), layout_of(F.col("line"), layouts).alias("layout"))
    if known.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        known = F.broadcast(known)
    rows = records.where("NOT header").join(known, same_key(F.col("feed_file"), F.col("of_file")))
    text = F.lit(None).cast("string")

    def result(values: dict[str, Column], bad: Column, reason: Column) -> Column:
        fields = [values.get(f.name.lower(), F.lit(None)).try_cast(f.dataType).alias(f.name) for f in schema]
        return F.struct(*fields, bad.alias(BAD_ROW), reason.alias("_reason"))

    def in_layout(header: Sequence[str | None]) -> Column:
        places = {c.strip().lower(): f"c{i}" for i, c in enumerate(header) if c is not None}

        def read(fields: Column) -> Column:
            values = {c: fields[place] for c, place in places.items()}
            return result(values, fields[BAD_ROW], F.when(fields[BAD_ROW].isNotNull(), BAD_WIDTH).otherwise(text))

        # Within `transform` a record is parsed once.
        return F.transform(F.array(parse_record(F.col("record"), _texts(len(header)))), read)[0]

    chosen = result({}, F.col("record"), F.lit(UNKNOWN_LAYOUT))
    for name, header in layouts.items():
        chosen = F.when(F.col("layout") == name, in_layout(header)).otherwise(chosen)
    return rows.select(F.inline(F.array(chosen)), "layout", *FEED_ORDER)


def missing_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null for every text that stands for a missing field."""
    texts = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name in (columns or df.columns)
    ]
    return df.withColumns({c: F.when(~F.col(c).isin(MISSING), F.col(c)) for c in texts})


def scan_dims(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Read the five scoring sheets, one file or folder each, in their long form.

    A CSV sheet of another number of columns is an error, see `scan_dims_wide` and, for
    a workbook, `scan_dims_workbook`.
    """
    options = CSV_FORMAT if fmt == "csv" else {}
    sheets = {}
    for name, schema in DIMENSIONS.items():
        path = f"{folder}/{name}"
        if fmt == "csv":
            header = spark.read.options(**CSV_FORMAT).csv(path).columns
            fields = [f.strip().split()[0] for f in schema.split(",")]
            if len(header) != len(fields):
                raise ValueError(f"{name}: expected the columns {fields}, found {header}")
        sheets[name] = spark.read.schema(schema).options(**options).format(fmt).load(path)
    return sheets


def scan_dims_wide(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Read the five scoring sheets as people keep them: without positions, and the title matrix
    with one column of points per level.

    A position is a row's place in its sheet, by file and then as in the file; rows are
    numbered by many tasks.  Columns go by place but for the level columns of the matrix, whose
    names are the levels, in lower case.  A cell without points is no entry.
    """
    found = {}
    for name in DIMENSIONS:
        sheet = spark.read.options(**CSV_FORMAT, multiLine=True).csv(f"{folder}/{name}")
        rows = sheet.select(
            F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line"), *sheet.columns
        )
        numbered = number_rows(rows, ["_file", "_line"], "pos").withColumn("pos", (F.col("pos") + 1).cast("int"))
        found[name] = _dimension(name, numbered.select("pos", *sheet.columns))
    return found


def scan_dims_workbook(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Read the five scoring sheets from one workbook, in their wide form under their own names.

    The first row with a value is the header.  A position is the number of rows from there, empty
    ones too.  The rest is as in `scan_dims_wide`.
    """
    cells = scan_workbook(spark, path, list(DIMENSIONS))
    heads = cells.groupBy("sheet").agg(F.min_by(F.struct("row", "cells"), "row").alias("head")).collect()
    header = {r["sheet"]: r["head"] for r in heads}
    found = {}
    for name in DIMENSIONS:
        if name not in header:
            raise ValueError(f"{name}: no such sheet, or an empty one")
        names = [(i, c) for i, c in enumerate(header[name].cells) if c is not None]
        rows = cells.where((F.col("sheet") == name) & (F.col("row") > header[name].row)).select(
            (F.col("row") - header[name].row).alias("pos"), *[F.get("cells", F.lit(i)).alias(c) for i, c in names]
        )
        found[name] = _dimension(name, rows)
    return found


def _dimension(name: str, rows: DataFrame) -> DataFrame:
    """A wide sheet with the column `pos` as a dimension."""
    columns = [c for c in rows.columns if c != "pos"]
    fields = [f.strip().split() for f in DIMENSIONS[name].split(",")][1:]
    if name == "title_matrix":
        title, *levels = columns
        rows = rows.unpivot(["pos", title], levels, "level", "points").withColumn("level", F.lower(F.trim("level")))
        rows = rows.where("points IS NOT NULL")
    given = [c for c in rows.columns if c != "pos"]
    if len(given) != len(fields):
        raise ValueError(f"{name}: expected {len(fields)} columns, found {given}")
    typed = [F.col(f"`{c}`").cast(kind).alias(field) for c, (field, kind) in zip(given, fields, strict=True)]
    return rows.select("pos", *typed)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_existing(
    spark: SparkSession, target: str, id_field: str = "JobId__c", partition: str = "run_date string"
) -> DataFrame:
    """Ids already in the target as `JobId`, with the partition that holds each.

    A target that does not exist yet holds none.
    """
    name = partition.split()[0]
    table = read_or_empty(spark, target, f"{id_field} string, {partition}")
    return table.select(table[id_field].alias("JobId"), name)


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages."""
    return spark.read.schema(PAGES).parquet(path)


def scan_search_results(spark: SparkSession, path: str) -> DataFrame:
    """Ranked results per company name."""
    return spark.read.schema(SEARCH_RESULTS).parquet(path)


def search_results_from_json(responses: DataFrame) -> DataFrame:
    """Ranked results from raw search responses (`query, response`)."""
    items = F.from_json("response", "items array<struct<formattedUrl:string>>")
    return _ranked(responses, items["items"]).select(
        "query", "rank", F.col("item.formattedUrl").alias("url"), F.lit(None).cast("double").alias("score")
    )


def entities_from_json(responses: DataFrame) -> DataFrame:
    """Ranked entities from raw entity-search responses (`query, response`)."""
    schema = "itemListElement array<struct<result:struct<url:string>,resultScore:double>>"
    items = F.from_json("response", schema)
    return _ranked(responses, items["itemListElement"]).select(
        "query",
        "rank",
        F.col("item.result.url").alias("url"),
        F.col("item.resultScore").alias("score"),
    )


def existing_from_pages(pages: DataFrame, fields: str = "Id string, JobId__c string, CreatedDate timestamp") -> DataFrame:
    """The records of a query's stored response pages (`page, response`), with the page of each.

    A response has `records`, and where it is not `done`, the name of the next page as `queryLocator`.
    Each page is stored once, and all are read, by many tasks; chains of pages need no order for that.
    A response that cannot be parsed and a next page that is not stored are errors, as records would be
    missing; the check moves names of pages only.  No pages give no records.
    """
    schema = f"records array<struct<{fields}>>, done boolean, queryLocator string"
    parsed = pages.select("page", F.from_json("response", schema).alias("r"))
    # A response that is not JSON has no `done`.
    follows = parsed.where("r.done IS NULL OR NOT r.done").select("page", F.col("r.queryLocator").alias("next"))
    stored = pages.select(F.col("page").alias("stored"))
    lost = follows.join(stored, same_key(F.col("next"), F.col("stored")), "left_anti").select("page").limit(5).collect()
    if lost:
        raise ValueError(f"no next page is stored for the pages {sorted(str(r.page) for r in lost)}")
    return parsed.select("page", F.inline("r.records"))


def _ranked(responses: DataFrame, items: Column) -> DataFrame:
    """One row per item, ranked from 1 in the order of the response."""
    ranked = responses.select("query", F.posexplode(items).alias("pos", "item"))
    return ranked.withColumn("rank", (F.col("pos") + 1).cast("bigint"))
