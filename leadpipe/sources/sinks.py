"""Sinks: dated output, batched append, delete and update by id.

A run owns one partition folder of the target and replaces it as a whole, so
a repeated run leaves the same table and no other run's rows are touched.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadpipe.functions.postings import truncate_rate
from leadpipe.operators.projection import map_target_fields
from leadpipe.operators.relational import BATCH_ROWS, anti_existing, batch_number, same_key
from leadpipe.schemas import TARGET_FIELDS, TARGET_TYPE
from leadpipe.session import scratch
from leadpipe.sources.readers import CSV_PACKED


def run_folder(target: str, run_date: datetime.date | str) -> str:
    return f"{target.rstrip('/')}/run_date={run_date}"


def sink_dated_csv(df: DataFrame, target: str, run_date: datetime.date | str) -> str:
    """Write a run's rows as CSV under its date, in compressed files that any CSV reader of Spark opens."""
    path = run_folder(target, run_date)
    df.write.mode("overwrite").options(**CSV_PACKED).csv(path)
    return path


def sink_append_batches(
    df: DataFrame,
    target: str,
    run_date: datetime.date | str,
    order_by: Sequence[str] | None = None,
    rows: int = BATCH_ROWS,
    tag: str = TARGET_TYPE,
) -> DataFrame:
    """Append rows in the target layout, numbered in batches; rows per batch.

    Every row counts, not just the first one of a batch.  `tag` names the type of
    the target object.
    """
    path = run_folder(target, run_date)
    fields = {**TARGET_FIELDS, "batch": "batch"}
    with scratch(df.sparkSession, "numbered") as kept:
        chosen = df.select(*TARGET_FIELDS, *_extra(order_by))
        numbered = batch_number(chosen, order_by, rows, path=kept)
        map_target_fields(numbered, fields, tag).write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema("batch bigint").parquet(path)
    return written.groupBy("batch").agg(F.count("*").alias("rows"))


def _extra(columns: Sequence[str] | None) -> list[str]:
    """Order columns that are not part of the target layout."""
    return [c for c in columns or () if c not in TARGET_FIELDS]


def sink_delete_by_id(target: DataFrame, ids: DataFrame, key: str, path: str) -> DataFrame:
    """Rewrite the rows whose id is not listed to a new path."""
    anti_existing(target, ids, key).write.parquet(path)
    return target.sparkSession.read.schema(target.schema).parquet(path)


def sink_update_by_id(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    field: str,
    path: str,
    order_by: str | None = None,
) -> DataFrame:
    """Rewrite the target to a new path with one truncated rate per listed id.

    Of several updates of an id the last one by `order_by` counts; without an
    order several different ones are an error.
    """
    new = truncate_rate(F.col(field))
    several = F.raise_error(F.lit(f"several updates of one {key}, and no order"))
    only = F.when(F.min(new).eqNullSafe(F.max(new)), F.max(new)).otherwise(several.cast("double"))
    last = F.max_by(new, order_by) if order_by else only
    latest = updates.groupBy(F.col(key).alias("_key")).agg(last.alias("_new"))
    (
        target.join(latest, same_key(F.col(key), F.col("_key")), "left")
        .withColumn(field, F.coalesce("_new", field))
        .select(*target.columns)
        .write.parquet(path)
    )
    return target.sparkSession.read.schema(target.schema).parquet(path)
