"""Search of texts for the entries of a dictionary of any size.

A search consumes a text: entries are tried in order, and one that is found
leaves the text before the next is tried.  An entry is in what is left of a text
only if its rarest three letters are.  So entries are filed under these, a text
asks for all of its own, and an equi-join brings the two together; the few
entries it gives are tried in order.  What is left of a text has new letters next
to each other only at its seams; those are asked for as well, until nothing new
is found.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpipe.functions.titles import let
from leadpipe.operators.relational import same_key
from leadpipe.session import scratch_path

GRAM = 3
# Stands where an entry has left; no character of a text.
SEAM = "￿"


def grams(df: DataFrame, text: str, lengths: Sequence[int]) -> DataFrame:
    """One row per substring of so many bytes, repeats included: the other columns and `gram`.

    A text holds an entry if its bytes hold those of the entry.  Bytes are reached by their
    place, characters only by counting.
    """
    kept = [c for c in df.columns if c != text]
    size = F.octet_length("_bytes")

    def of(n: int) -> DataFrame:
        rows = df.select(*kept, F.col(text).cast("binary").alias("_bytes"))
        places = F.explode(F.when(size >= n, F.sequence(F.lit(1), size - (n - 1))))
        return rows.select(*kept, "_bytes", places.alias("_at")).select(
            *kept, F.substring("_bytes", F.col("_at"), F.lit(n)).alias("gram")
        )

    return functools.reduce(DataFrame.union, [of(n) for n in lengths])


def _seams(rest: Column, entry: Column) -> Column:
    """Up to two characters of both sides where an entry leaves a text.

    Entries that stand next to each other leave one seam, so all parts between
    seams have a character, and two characters before a seam are in two parts.
    """

    def over(parts: Column) -> Column:
        def window(i: Column) -> Column:
            before = F.concat(F.coalesce(F.get(parts, i - 1), F.lit("")), F.get(parts, i))
            return F.concat(F.right(before, F.lit(2)), F.left(F.get(parts, i + 1), F.lit(2)))

        return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(parts) - 2), window))

    marked = F.regexp_replace(F.replace(rest, entry, F.lit(SEAM)), f"{SEAM}+", SEAM)
    return let(F.split(marked, SEAM), over)


def _search(text: Column, items: Column, items_type: str, strip: bool, entries: int) -> Column:
    """Consume a text by items in order: struct(rest, found, seams).

    Seams bring nothing forth where all entries are among the items already.
    """
    none = F.array().cast("array<string>")
    more = F.size(items) < entries

    def step(acc: Column, item: Column) -> Column:
        rest = F.replace(acc["rest"], item["entry"], F.lit(""))
        return F.when(
            F.contains(acc["rest"], item["entry"]),
            F.struct(
                (F.trim(rest) if strip else rest).alias("rest"),
                F.array_append(acc["found"], item).alias("found"),
                F.concat(acc["seams"], F.when(more, _seams(acc["rest"], item["entry"])).otherwise(none)).alias("seams"),
            ),
        ).otherwise(acc)

    start = F.struct(
        text.alias("rest"),
        F.array().cast(items_type).alias("found"),
        none.alias("seams"),
    )
    return F.aggregate(items, start, step)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Index:
    """Dictionary entries by their rarest gram.

    `entries` has `sheet`, `entry`, which is not empty, `nth`, a sortable value that orders
    the entries of a sheet, and sortable values besides.  The table is written once, so Spark
    knows its size and picks the join by it.
    """

    def __init__(self, entries: DataFrame):
        named = entries.withColumn("_entry", F.col("entry"))
        short = named.where(F.octet_length("entry") < GRAM).withColumn("gram", F.col("_entry").cast("binary"))
        filed = grams(named, "_entry", [GRAM]).distinct().unionByName(short.drop("_entry"))
        often = filed.groupBy(F.col("gram").alias("gram_")).agg(F.count("*").alias("often"))
        rows = filed.join(often, same_key(F.col("gram"), F.col("gram_")))
        rarest = F.min_by("gram", F.struct("often", "gram")).alias("gram")
        payload = F.struct("nth", *[c for c in entries.columns if c not in ("sheet", "nth")])
        self.table = saved(
            rows.groupBy("sheet", payload.alias("item")).agg(rarest), "dictionary"
        )
        self.items_type = f"array<{self.table.schema['item'].dataType.simpleString()}>"
        sizes = self.table.groupBy("sheet", F.octet_length("gram").alias("n")).count().collect()
        self.lengths = sorted({r.n for r in sizes})
        self.entries = Counter()
        for r in sizes:
            self.entries[r.sheet] += r["count"]

    def _candidates(self, asked: DataFrame, sheets: Iterable[str]) -> DataFrame:
        """For `id_` and `gram` of some texts, a row per `id_` with an array of items per sheet."""
        filed = self.table.where(F.col("sheet").isin(*sheets)).withColumn("gram_", F.xxhash64("gram")).drop("gram")
        keys = filed.select(F.col("gram_").alias("key")).distinct()
        # A text has a gram in many places; one row of each goes on.
        hashed = asked.select("id_", F.xxhash64("gram").alias("gram"))
        told = hashed.join(keys, F.col("gram") == F.col("key"), "left_semi").distinct()
        met = told.join(filed, F.col("gram") == F.col("gram_"))
        return met.groupBy("id_").agg(
            *[F.collect_set(F.when(F.col("sheet") == s, F.col("item"))).alias(f"{s}_new") for s in sheets]
        )

    def held(self, texts: DataFrame, sheets: Iterable[str]) -> DataFrame:
        """The distinct texts of the column `text` with `id` and, per sheet, the items they can hold in order.

        Those are the items whose gram a text has; one may be there in part only, and come to be whole
        where something in it has left.  Only ids and grams take part in the look-up, not the texts.
        """
        named = saved(texts.select("text", F.xxhash64("text").alias("id")), "texts")
        asked = grams(named.withColumnRenamed("id", "id_"), "text", self.lengths)
        found = self._candidates(asked, sheets)

        none = F.array().cast(self.items_type)
        joined = named.join(found, F.col("id") == F.col("id_"), "left")
        return joined.select(
            "text", "id", *[F.coalesce(F.sort_array(f"{s}_new"), none).alias(s) for s in sheets]
        )

    def consumed(self, held: DataFrame, searches: dict[str, bool]) -> DataFrame:
        """The rows of `held` with a column per search: struct(rest, found, seams) as `<sheet>_search`.

        `searches` has the sheets, and whether blanks at the ends go with an entry.  Texts
        with items that only seams bring forth are searched again with those among the others.
        """

        def searched(rows: DataFrame) -> DataFrame:
            made = {
                f"{s}_search": _search(F.col("text"), F.col(s), self.items_type, strip, self.entries[s])
                for s, strip in searches.items()
            }
            return saved(rows.withColumns(made), "searched")

        none = F.array().cast(self.items_type)
        done, now = [], searched(held)
        while True:
            fresh = now.select("id", *searches)
            for sheet in searches:
                seams = now.select(F.col("id").alias("id_"), F.explode(f"{sheet}_search.seams").alias("seam"))
                seen = grams(seams.distinct(), "seam", self.lengths)
                fresh = fresh.join(self._candidates(seen, [sheet]), F.col("id") == F.col("id_"), "left").drop("id_")
            unseen = [F.coalesce(F.array_except(f"{s}_new", F.col(s)), none).alias(f"{s}_new") for s in searches]
            fresh = fresh.select("id", *unseen)
            some = functools.reduce(Column.__or__, [F.size(f"{s}_new") > 0 for s in searches])
            fresh = saved(fresh.where(some), "seams")
            if fresh.isEmpty():
                return functools.reduce(DataFrame.unionByName, done, now)
            done.append(now.join(fresh.select("id"), "id", "left_anti").select(now.columns))
            more = now.select(held.columns).join(fresh, "id").withColumns(
                {s: F.sort_array(F.concat(F.col(s), F.col(f"{s}_new"))) for s in searches}
            )
            more = more.select(held.columns)
            now = searched(more)
