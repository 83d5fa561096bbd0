"""Title scoring against the five dimension sheets.

Titles repeat, so each distinct one is searched and scored once, and rows get
the results by their title.  The sheets may have any size: a title meets the
entries it holds by an index, see `dictionary`.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpipe.functions import titles as t
from leadpipe.operators import filters
from leadpipe.operators.dictionary import Index, saved
from leadpipe.operators.relational import number_rows, same_key


def keep_last(df: DataFrame, key: str, *values: str) -> DataFrame:
    """One row per key: its first position, its last values (a keyed lookup's view)."""
    return (
        df.where(F.col(key).isNotNull() & (F.col(key) != ""))
        .groupBy(key)
        .agg(F.min("pos").alias("pos"), *[F.max_by(v, "pos").alias(v) for v in values])
    )


def in_order(df: DataFrame, order_by: list[Column], into: str) -> DataFrame:
    """Number rows from 1 by many tasks."""
    return number_rows(df, order_by, into).withColumn(into, (F.col(into) + 1).cast("int"))


def sort_by_length(df: DataFrame, entry: str, pos: str = "pos") -> DataFrame:
    """Number dictionary entries longest first, equal lengths in sheet order."""
    return in_order(df, [F.char_length(entry).desc(), F.col(pos).asc()], "lookup_order")


def rank_levels(no_match_levels: DataFrame) -> DataFrame:
    """Rank canonical levels by their stand-alone points, best first."""
    levels = keep_last(no_match_levels, "job_level", "points")
    return in_order(levels, [F.col("points").desc_nulls_last(), F.col("pos").asc()], "rank")


NTH = "struct<length:int,pos:bigint,name:string>"
PAYLOAD = {
    "level": "string",
    "rank": "int",
    "points": "int",
    "by_level": "array<struct<level:string,points:int>>",
}


class TitleSheets:
    """The dictionaries of the scoring rule, indexed when first used."""

    def __init__(self, dims: dict[str, DataFrame]):
        self.dims = dims

    def _entries(self, rows: DataFrame, sheet: str, entry: str, nth: list[Column], **payload: Column) -> DataFrame:
        """Entries in the order of lookup, all sheets in one layout."""
        order = [c.cast(kind) for c, kind in zip(nth, ("int", "bigint", "string"), strict=True)]
        columns = {c: payload.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in PAYLOAD.items()}
        named = F.struct(*[c.alias(n) for c, n in zip(order, ("length", "pos", "name"), strict=True)])
        return rows.select(F.lit(sheet).alias("sheet"), F.col(entry).alias("entry"), named.alias("nth"), *columns.values())

    @property
    def levels(self) -> DataFrame:
        """Levels longest first with their canonical name, rank and own points."""
        ranks = rank_levels(self.dims["no_match_levels"]).select(F.col("job_level").alias("sfdc"), "rank", "points")
        rows = keep_last(self.dims["level_mapping"], "actual", "sfdc").join(ranks, "sfdc", "left")
        nth = [-F.char_length("actual"), F.col("pos"), F.lit("")]
        return self._entries(
            rows, "levels", "actual", nth, level=F.col("sfdc"), rank=F.col("rank"), points=F.col("points")
        )

    @property
    def targets(self) -> DataFrame:
        """Target titles in sheet order with their points per level."""
        rows = (
            self.dims["title_matrix"]
            .where(F.col("title").isNotNull() & (F.col("title") != ""))
            .groupBy("title", "level")
            .agg(F.min("pos").alias("pos"), F.max_by("points", "pos").alias("points"))
            .groupBy("title")
            .agg(
                F.min("pos").alias("pos"),
                F.sort_array(F.collect_list(F.struct("level", "points"))).alias("by_level"),
            )
        )
        return self._entries(
            rows, "targets", "title", [F.lit(0), F.col("pos"), F.col("title")], by_level=F.col("by_level")
        )

    @property
    def keywords(self) -> DataFrame:
        """Keywords longest first with their points."""
        rows = keep_last(self.dims["keywords"], "keyword", "points")
        nth = [-F.char_length("keyword"), F.col("pos"), F.lit("")]
        return self._entries(rows, "keywords", "keyword", nth, points=F.col("points"))

    @cached_property
    def index(self) -> Index:
        """The entries of the three sheets titles are searched for."""
        return Index(self.levels.union(self.targets).union(self.keywords))

    @property
    def spelling(self) -> DataFrame:
        """Old and new spellings."""
        known = keep_last(self.dims["mapping"], "old", "new").where(F.col("new").isNotNull())
        return known.select("old", "new")


def prepare_sheets(dims: dict[str, DataFrame]) -> TitleSheets:
    """Order and link the five sheets."""
    return TitleSheets(dims)


def _texts(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.col(text).alias("text")).where("text IS NOT NULL").distinct()


def _add(df: DataFrame, text: str, results: DataFrame, into: str, without: Column | None = None) -> DataFrame:
    """Add a column of results by text; a null text gets `without`."""
    known = results.select(F.col("text").alias("_text"), F.col(into).alias("_into"))
    kept = [F.col(f"`{c}`") for c in df.columns if c != into]
    value = F.col("_into") if without is None else F.coalesce("_into", without)
    return df.join(known, same_key(F.col(text), F.col("_text")), "left").select(*kept, value.alias(into))


def _find(df: DataFrame, sheets: TitleSheets, text: str, into: str, sheet: str, strip: bool, kind: str) -> DataFrame:
    index = sheets.index
    found = index.consumed(index.held(_texts(df, text), [sheet]), {sheet: strip})
    made = F.struct(
        F.col(f"{sheet}_search.rest").alias("rest"), t.typed(F.col(f"{sheet}_search.found"), kind).alias("found")
    )
    none = F.struct(F.lit(None).cast("string").alias("rest"), F.array().cast(kind).alias("found"))
    return _add(df, text, found.select("text", made.alias(into)), into, none)


def find_levels(df: DataFrame, sheets: TitleSheets, title: str, into: str = "levels") -> DataFrame:
    """Levels inside a title and the remainder: struct(rest, found)."""
    return _find(df, sheets, title, into, "levels", True, t.LEVELS)


def find_targets(df: DataFrame, sheets: TitleSheets, title: str, into: str = "targets") -> DataFrame:
    """Target titles inside a title, in sheet order: struct(rest, found)."""
    return _find(df, sheets, title, into, "targets", False, t.TARGETS)


def _keywords(texts: DataFrame, sheets: TitleSheets) -> DataFrame:
    """Keywords of distinct texts, in order of discovery, as `found`."""
    index = sheets.index
    rows = index.consumed(index.held(texts, ["keywords"]), {"keywords": True})
    found = t.found_keywords(F.col("text"), F.col("keywords"), F.col("keywords_search.found"))
    return rows.select("text", t.typed(found, t.KEYWORDS).alias("found"))


def _digest(text: str) -> Column:
    """128 bits that stand for a text where texts would be shuffled to meet."""
    return F.unhex(F.md5(F.col(text)))


def find_keywords(df: DataFrame, sheets: TitleSheets, text: str, into: str = "keywords") -> DataFrame:
    """Keywords of a text, in order of discovery."""
    found = _keywords(_texts(df, text), sheets).withColumnRenamed("found", into)
    return _add(df, text, found, into, F.array().cast(t.KEYWORDS))


def scores(texts: DataFrame, sheets: TitleSheets) -> DataFrame:
    """Score of each distinct cleaned title: its `digest` and struct(title_level, new_title, points).

    A title that is a target scores at the default level.  Otherwise the best
    target found scores at the best level found.  Without any target the
    keywords in what the levels left of the title count, and the best level
    adds its own points.
    """
    index = sheets.index
    held = index.held(texts, ["levels", "targets"])
    rows = index.consumed(held, {"levels": True, "targets": False}).select(
        _digest("text").alias("digest"),
        F.col("levels_search.rest").alias("rest"),
        t.best_level(t.typed(F.col("levels_search.found"), t.LEVELS)).alias("level"),
        F.get(t.equal_entries(F.col("text"), t.typed(F.col("targets"), t.TARGETS)), F.lit(0)).alias("exact"),
        t.typed(F.col("targets_search.found"), t.TARGETS).alias("targets"),
    )
    at = F.coalesce(F.col("level.level"), F.lit(t.DEFAULT_LEVEL))
    by_keywords = F.col("exact").isNull() & F.col("target").isNull()
    # The texts end here but for those the keywords are searched in.
    rows = rows.withColumn("target", t.best_target(F.col("targets"), at)).drop("targets")
    rows = saved(rows.withColumn("rest", F.when(by_keywords, F.col("rest"))), "scored")
    told = _keywords(_texts(rows, "rest"), sheets).select(_digest("text").alias("rest_"), "found")
    both = rows.join(told, same_key(_digest("rest"), F.col("rest_")), "left")
    score = t.score(F.col("exact.entry"), F.col("exact"), F.col("level"), F.col("target"), F.col("found"))
    return both.select("digest", score.alias("score"))


def score_title(df: DataFrame, sheets: TitleSheets, title: str, into: str = "score") -> DataFrame:
    """Add struct(title_level, new_title, points) for a cleaned title."""
    known = scores(_texts(df, title), sheets).select("digest", F.col("score").alias("_into"))
    kept = [F.col(f"`{c}`") for c in df.columns if c != into]
    return df.join(known, same_key(_digest(title), F.col("digest")), "left").select(*kept, F.col("_into").alias(into))


def map_whole_title(df: DataFrame, mapping: DataFrame, title: str) -> DataFrame:
    """Replace a title that equals a spelling-map entry; Spark picks the join."""
    spelling = (
        keep_last(mapping, "old", "new")
        .where(F.col("new").isNotNull())
        .select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    )
    return (
        df.join(spelling, same_key(F.col(title), F.col("_old")), "left")
        .withColumn(title, F.coalesce("_new", title))
        .drop("_old", "_new")
    )


def map_tokens(df: DataFrame, sheets: TitleSheets, tokens: str) -> DataFrame:
    """Replace every token the spelling map knows.

    Distinct lists of tokens ask for their distinct tokens by an equi-join; where none is
    known, nothing comes back.
    """
    lists = df.select(F.col(tokens).alias("tokens")).distinct().withColumn("id", F.xxhash64("tokens"))
    asked = lists.select("id", F.explode(F.array_distinct("tokens")).alias("token"))
    known = asked.join(sheets.spelling, F.col("token") == F.col("old")).select("id", "token", "new").distinct()
    maps = known.groupBy(F.col("id").alias("_id")).agg(
        F.map_from_entries(F.collect_list(F.struct("token", "new"))).alias("_new")
    )
    kept = [F.col(f"`{c}`") for c in df.columns]
    mapped = F.transform(F.col(tokens), lambda w: F.coalesce(F.try_element_at("_new", w), w))
    joined = df.join(maps, same_key(F.xxhash64(tokens), F.col("_id")), "left")
    return joined.select(*[
        F.when(F.col("_new").isNull(), c).otherwise(mapped).alias(n) if n == tokens else c
        for n, c in zip(df.columns, kept, strict=True)
    ])


def clean_title(
    df: DataFrame,
    dims: dict[str, DataFrame],
    title: str = "JobTitle",
    into: str = "cleanTitle",
    per_token: bool = False,
    sheets: TitleSheets | None = None,
) -> DataFrame:
    """Squash a title and apply the spelling map to it as a whole, or per token."""
    df = df.withColumn(into, t.squash_title(F.col(title)))
    if not per_token:
        return map_whole_title(df, dims["mapping"], into)
    df = df.withColumn(into, F.split(into, " "))
    return map_tokens(df, sheets or prepare_sheets(dims), into).withColumn(
        into, F.array_join(into, " ")
    )


def clean_title_tokens(df: DataFrame, sheets: TitleSheets, title: str = "title") -> DataFrame:
    """Bulk cleaning: drop junk titles, add the cleaned tokens as `title_split`."""
    lowered = filters.filter_null(df.withColumn(title, F.lower(title)), title)
    kept = filters.filter_not_contains(filters.filter_blocklist(lowered, title), title)
    mapped = map_tokens(kept.withColumn("title_split", t.title_tokens(F.col(title))), sheets, "title_split")
    return filters.filter_nonempty(mapped.withColumn("title_split", F.array_join("title_split", " ")), "title_split")


def title_scores(titles: DataFrame, dims: dict[str, DataFrame], per_token: bool = False) -> DataFrame:
    """Score of each distinct title in the column `text`: `text` and struct(title_level, new_title, points).

    The spelling map sees the whole title, or each of its tokens.
    """
    sheets = prepare_sheets(dims)
    clean = clean_title(titles, dims, "text", per_token=per_token, sheets=sheets)
    clean = saved(clean.select("text", "cleanTitle"), "titles")
    return score_title(clean, sheets, "cleanTitle").select("text", "score")


def add_title_score(
    df: DataFrame,
    dims: dict[str, DataFrame],
    keep_parts: bool = False,
    per_token: bool = False,
    min_score: int | None = None,
    titles: DataFrame | None = None,
) -> DataFrame:
    """Add `titleScore`; with `keep_parts` also the level and the matched title.

    Distinct titles are cleaned and scored, and the rows meet a table of them.  With
    `min_score` it only has the titles that score as much, and others get a null: few
    titles do, so that Spark, which knows the table's size, need not move the rows.
    `titles` has the `JobTitle`s to score, where that is cheaper to make than the rows; a
    row of any other gets a null.
    """
    score = title_scores(_texts(df if titles is None else titles, "JobTitle"), dims, per_token)
    if min_score is not None:
        score = score.where(F.col("score.points") >= min_score)
    known = saved(score.withColumnRenamed("score", "_score"), "scores")
    kept = [F.col(f"`{c}`") for c in df.columns]
    parts = [F.col("_score.title_level").alias("titleLevel"), F.col("_score.new_title").alias("newTitle")]
    return _add(df, "JobTitle", known, "_score").select(
        *kept, F.col("_score.points").alias("titleScore"), *(parts if keep_parts else [])
    )


def unranked_levels(dims: dict[str, DataFrame]) -> DataFrame:
    """Data-quality count of mapped levels the ranking sheet does not know."""
    mapped = keep_last(dims["level_mapping"], "actual", "sfdc").select("sfdc").distinct()
    ranked = dims["no_match_levels"].select(F.col("job_level").alias("sfdc"))
    return mapped.join(ranked, "sfdc", "left_anti").agg(F.count("*").alias("unranked_levels"))
