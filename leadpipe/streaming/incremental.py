"""Incremental upload: new files are cleaned and only unknown ids appended."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadpipe.operators.relational import anti_existing, dedup_first
from leadpipe.session import scratch_scope
from leadpipe.sources.readers import (
    BAD_ROW,
    BAD_WIDTH,
    CSV_FORMAT,
    KEEP_BAD_ROWS,
    is_bad,
    missing_to_null,
    read_or_empty,
    with_bad_row,
)


def incremental_upload(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    key: str,
    order_by: Sequence[str] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int | None = None,
    fmt: str = "parquet",
    rejects: str | None = None,
) -> None:
    """Process all files that arrived since the last call, then stop.

    Per micro-batch: prepare, first row per key (unless `prepare` leaves keys
    unique and no order is given), drop keys the target holds, write.  CSV rows
    of another width go to the folder `rejects`; without one they are an error.  A
    micro-batch owns the folder `batch_id=n` of the target.  A replayed one
    does not see its own rows and replaces them, so a failure between writing
    and committing leaves no duplicates.
    """
    if not order_by and not prepare:
        raise ValueError("repeated keys of a micro-batch need an order, or a `prepare` that leaves them unique")
    reader = spark.readStream.schema(with_bad_row(schema) if fmt == "csv" else schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_FORMAT, **KEEP_BAD_ROWS, multiLine=True, enforceSchema=True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def upload(batch: DataFrame, batch_id: int) -> None:
        if fmt == "csv":
            bad = batch.where(is_bad(schema))
            if rejects:
                bad.select(F.col(BAD_ROW).alias("row"), F.lit(BAD_WIDTH).alias("reason")).write.mode(
                    "overwrite"
                ).parquet(f"{rejects}/batch_id={batch_id}")
            elif not bad.isEmpty():
                raise ValueError(f"rows of another {BAD_WIDTH}; name a folder for `rejects` to go on without them")
            batch = missing_to_null(batch.where(~is_bad(schema)).drop(BAD_ROW))
        with scratch_scope(spark):
            rows = prepare(batch) if prepare else batch
            key_type = rows.schema[key].dataType.simpleString()
            known = read_or_empty(spark, target, f"{key} {key_type}, batch_id bigint")
            known = known.where(F.col("batch_id") != batch_id)
            first = dedup_first(rows, key, order_by) if order_by else rows
            anti_existing(first, known, key, unique=True).write.mode("overwrite").parquet(
                f"{target}/batch_id={batch_id}"
            )

    (
        reader.load(landing)
        .writeStream.foreachBatch(upload)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
