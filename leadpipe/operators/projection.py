"""Column-level operators."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpipe.schemas import TARGET_FIELDS, TARGET_TYPE


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Replace all column names by position; a different number is an error."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(names)} columns, found {len(df.columns)}: {df.columns}")
    return df.toDF(*names)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*names)


def swap_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Drop `old` and give its name to `new`."""
    return drop_columns(df, old).withColumnRenamed(new, old)


def map_target_fields(
    df: DataFrame, fields: dict[str, str] | None = None, tag: str = TARGET_TYPE
) -> DataFrame:
    """Rename to the fields of the target object and add its type tag."""
    fields = TARGET_FIELDS if fields is None else fields
    return df.select(
        *[F.col(source).alias(field) for source, field in fields.items()],
        F.lit(tag).alias("type"),
    )


def normalize_colnames(df: DataFrame) -> DataFrame:
    """Column names without blanks and slashes, in lower case."""
    return df.toDF(*[c.translate(str.maketrans("", "", " \\/")).lower() for c in df.columns])


def conditional_assign(df: DataFrame, column: str, mask: Column, value: Column) -> DataFrame:
    """Set a column where the mask holds; a null mask changes nothing."""
    return df.withColumn(column, F.when(mask, value).otherwise(F.col(column)))


def add_run_constants(df: DataFrame, as_of: datetime.date) -> DataFrame:
    """The constant columns a run starts from: its date and an age of 0 days."""
    return df.withColumns({"post_date": F.lit(as_of), "days_ago": F.lit(0)})


def compute_once(df: DataFrame, *columns: str) -> DataFrame:
    """Keep later filters from repeating the work of costly columns.

    Spark pushes a filter below a projection by copying the expressions it
    uses.  It does not push one below a generator, here of exactly one row.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    once = df.select(*kept, F.inline(F.array(F.struct(*columns))))
    return once.select(*[F.col(f"`{c}`") for c in df.columns])
