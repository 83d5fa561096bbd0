"""Deduplication, lookups, batching and sampling.

No side is broadcast by hint: Spark broadcasts what its statistics prove small
and otherwise shuffles, where adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadpipe.session import scratch_path

BATCH_ROWS = 100
# Two numbers per row: 16 MB.
MAX_BROADCAST_ROWS = 1_000_000


def dedup_first(df: DataFrame, key: str, order_by: Sequence[str | Column]) -> DataFrame:
    """First row per key in an explicit total order.

    The rank filter lets Spark keep one row per key in every map task before
    the shuffle, so a hot key ships one row per task, not all its rows.
    """
    order = Window.partitionBy(key).orderBy(*order_by)
    return (
        df.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") == 1).drop("_nth")
    )


def same_key(left: Column, right: Column) -> Column:
    """Join condition for a side that was aggregated by the join key.

    The key alone would let Spark reuse the partitions of the aggregation, and
    adaptive execution splits a skewed partition only where both join sides
    come straight from a shuffle.  The second condition, implied by the first,
    makes it shuffle the aggregated side once more, one row per key, so a hot
    key on the other side is split over many tasks.
    """
    return (left == right) & (F.xxhash64(left) == F.xxhash64(right))


def anti_existing(
    df: DataFrame, existing: DataFrame, key: str = "JobId", unique: bool = False
) -> DataFrame:
    """Rows whose key the target does not hold yet.

    The distinct collapses repeated target keys before their shuffle.  Rows
    known to have `unique` keys are joined where they are, without another
    shuffle if they are partitioned by the key.
    """
    known = existing.select(F.col(key).alias("_key")).distinct()
    if unique:
        return df.join(known, F.col(key) == F.col("_key"), "left_anti")
    return df.join(known, same_key(F.col(key), F.col("_key")), "left_anti")


def territory_lookup(
    df: DataFrame, territory: DataFrame, state: str = "State", into: str = "rep"
) -> DataFrame:
    """Sales representative of a state in any case; NULL where nobody covers it.

    A state listed twice for one representative counts once; of several
    representatives the first by code is taken.
    """
    reps = territory.groupBy(F.upper("state").alias("_state")).agg(F.min("rep").alias(into))
    return df.join(reps, same_key(F.upper(state), F.col("_state")), "left").drop("_state")


def top1(df: DataFrame, key: str, rank: str | Column, *values: str) -> DataFrame:
    """The values of the best-ranked row per key, combined before the shuffle."""
    best = F.min_by(F.struct(*values), rank)
    return df.groupBy(key).agg(best.alias("_best")).select(key, "_best.*")


def enrich_top1(
    df: DataFrame, results: DataFrame, name: str = "AccountName", into: str = "google_link"
) -> DataFrame:
    """First search result of each company name; NULL without results."""
    first = top1(results, "query", "rank", "url").withColumnRenamed("url", into)
    return df.join(first, same_key(F.col(name), F.col("query")), "left").drop("query")


def enrich_kg(
    df: DataFrame, entities: DataFrame, name: str = "AccountName", into: str = "entity"
) -> DataFrame:
    """First entity of each company name as `url (score)`."""
    first = top1(entities, "query", "rank", "url", "score").select(
        "query",
        F.when(
            F.col("url").isNotNull() & F.col("score").isNotNull(),
            F.concat("url", F.lit(" ("), F.col("score").cast("string"), F.lit(")")),
        ).alias(into),
    )
    return df.join(first, same_key(F.col(name), F.col("query")), "left").drop("query")


def first_account_for_link(
    df: DataFrame,
    order_by: str | Column,
    link: str = "CompanyLink",
    account: str = "AccountName",
    into: str = "firstAccount",
) -> DataFrame:
    """Account name of the first row that has the row's company link."""
    first = (
        df.where(F.col(link).isNotNull())
        .groupBy(F.col(link).alias("_link"))
        .agg(F.min_by(account, order_by).alias(into))
    )
    return df.join(first, same_key(F.col(link), F.col("_link")), "left").drop("_link")


def best_score(df: DataFrame, key: str, value: str, score: str, pos: str) -> DataFrame:
    """Value and score of the best-scored row per key; the first position wins ties."""
    best = F.max_by(F.struct(value, score), F.struct(F.col(score), -F.col(pos)))
    return df.groupBy(key).agg(best.alias("_best")).select(key, "_best.*")


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column] | None = None,
    into: str = "nth",
    path: str | None = None,
) -> DataFrame:
    """Number all rows from 0 without a window over the data.

    In a total order, or without one in the order the rows are in, which needs
    no shuffle.  Rows of equal order keys go by a hash of their plain columns, so that many of
    them are spread over tasks; only rows alike in all of these stay together.  The rows are written once with their partition and place in
    it.  The place among all rows is then the place in the partition plus the
    rows of all earlier partitions, a table of one row per partition.  `path` is
    where the rows are written, for a caller that deletes them.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "numbered")
    if order_by:
        # A function of the row alone: a map task that is run again deals its rows as before.
        plain = [f"`{f.name}`" for f in df.schema if isinstance(f.dataType, T.AtomicType)]
        keys = [*order_by, F.xxhash64(*plain)] if plain else order_by
        ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    else:
        ordered = df
    ordered.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    written = spark.read.parquet(path).select(
        *df.columns,
        F.shiftright("_place", 33).alias("_part"),
        F.col("_place").bitwiseAND((1 << 33) - 1).alias("_row"),
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        written.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    if offsets.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    nth = F.col("_before") + F.col("_row")
    return written.join(offsets, "_part").select(*df.columns, nth.alias(into))


def batch_number(
    df: DataFrame,
    order_by: Sequence[str | Column] | None = None,
    rows: int = BATCH_ROWS,
    into: str = "batch",
    path: str | None = None,
) -> DataFrame:
    """Number consecutive chunks of `rows` rows, from 0; see `number_rows`."""
    numbered = number_rows(df, order_by, into, path)
    return numbered.withColumn(into, F.floor(F.col(into) / rows))


def sample_rows(df: DataFrame, key: str, n: int = 1) -> DataFrame:
    """A repeatable sample of n rows: the smallest hashes of the key."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def concat_pages(first: DataFrame, *more: DataFrame) -> DataFrame:
    """All result pages in one table, duplicates kept."""
    for page in more:
        first = first.unionByName(page)
    return first
