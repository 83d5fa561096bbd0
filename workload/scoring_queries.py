"""Title cleaning and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadpipe.functions import titles as t
from leadpipe.operators import filters
from leadpipe.operators import scoring as s
from workload import sqltext as q
from workload.data import DOC_SHEETS, dims, postings, sheet_sql, table
from workload.registry import query
from workload.text_queries import KEYS, KEYS_SQL, POST


def doc_sheet(name: str) -> str:
    return sheet_sql(name, DOC_SHEETS)


DICT = q.dictionaries(sheet_sql)
DOC_DICT = q.dictionaries(doc_sheet)
DOCS = f"(SELECT doc_id, {q.squash('text')} AS title FROM documents)"
TITLES = (
    f"SELECT {KEYS_SQL}, {q.squash('title')} AS squashed FROM {POST} WHERE title IS NOT NULL"
)
CLEAN_TITLES = (
    f"SELECT {KEYS_SQL}, {q.whole_mapped('squashed', sheet_sql('mapping'))} AS cleanTitle "
    f"FROM ({TITLES})"
)


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", t.squash_title(F.col("text")).alias("title")
    )


def _doc_sheets(spark):
    return s.prepare_sheets(dims(spark, DOC_SHEETS))


def _names(found):
    return F.array_join(t.entry_names(F.col(found)), "|")


@query("clean_title", CLEAN_TITLES)
def clean_title(spark, sf_dir):
    rows = filters.filter_null(postings(spark, sf_dir), "title").select(*KEYS, "title")
    return s.clean_title(rows, dims(spark), "title").drop("title")


@query("map_whole_title", f"SELECT p_partkey, {q.whole_mapped('p_name', sheet_sql('mapping'))} AS p_name FROM part")
def map_whole_title(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return s.map_whole_title(rows, dims(spark)["mapping"], "p_name")


@query(
    "map_tokens",
    f"""SELECT doc_id, array_to_string(list_transform(string_split(title, ' '),
          lambda w: coalesce(spelling[w], w)), ' ') AS title FROM {DOCS}, {DOC_DICT}""",
)
def map_tokens(spark, sf_dir):
    rows = _documents(spark, sf_dir).withColumn("title", F.split("title", " "))
    mapped = s.map_tokens(rows, _doc_sheets(spark), "title")
    return mapped.withColumn("title", F.array_join("title", " "))


@query(
    "clean_title_per_token",
    f"""SELECT {KEYS_SQL}, array_to_string(list_transform(string_split(squashed, ' '),
          lambda w: coalesce(spelling[w], w)), ' ') AS cleanTitle FROM ({TITLES}), {DICT}""",
)
def clean_title_per_token(spark, sf_dir):
    rows = filters.filter_null(postings(spark, sf_dir), "title").select(*KEYS, "title")
    return s.clean_title(rows, dims(spark), "title", per_token=True).drop("title")


@query(
    "clean_title_tokens",
    f"""SELECT * FROM (SELECT doc_id, lower(text) AS title, array_to_string(list_transform(
          {q.tokens('text')}, lambda w: coalesce(spelling[w], w)), ' ') AS title_split
        FROM documents, {DOC_DICT}
        WHERE lower(text) NOT IN ('none', 'mrs', 'mr', 'other', 'intern', 'unknown',
          'no longer with') AND NOT contains(lower(text), 'no longer with'))
        WHERE title_split <> ''""",
)
def clean_title_tokens(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("title"))
    return s.clean_title_tokens(rows, _doc_sheets(spark))


@query(
    "find_levels",
    f"""SELECT doc_id, array_to_string(lv.found, '|') AS levels, lv.rest AS remainder FROM (
          SELECT doc_id, {q.consume('title', 'level_entries', True)} AS lv FROM {DOCS}, {DOC_DICT})""",
)
def find_levels(spark, sf_dir):
    found = s.find_levels(_documents(spark, sf_dir), _doc_sheets(spark), "title")
    return found.select(
        "doc_id", _names("levels.found").alias("levels"), F.col("levels.rest").alias("remainder")
    )


@query(
    "find_targets",
    f"""SELECT doc_id, array_to_string(({q.consume('title', 'target_entries', False)}).found, '|')
          AS targets FROM {DOCS}, {DOC_DICT}""",
)
def find_targets(spark, sf_dir):
    found = s.find_targets(_documents(spark, sf_dir), _doc_sheets(spark), "title")
    return found.select("doc_id", _names("targets.found").alias("targets"))


@query(
    "find_keywords",
    f"SELECT doc_id, array_to_string({q.keywords_found('title')}, '|') AS keywords "
    f"FROM {DOCS}, {DOC_DICT}",
)
def find_keywords(spark, sf_dir):
    found = s.find_keywords(_documents(spark, sf_dir), _doc_sheets(spark), "title")
    return found.select("doc_id", _names("keywords").alias("keywords"))


@query(
    "contains_match",
    f"""SELECT p_partkey, array_to_string(lv.found, '|') AS levels, lv.rest AS remainder,
          array_to_string(tg.found, '|') AS targets FROM (
          SELECT p_partkey, {q.consume('p_name', 'level_entries', True)} AS lv,
            {q.consume('p_name', 'target_entries', False)} AS tg FROM part, {DICT})""",
)
def contains_match(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sheets = s.prepare_sheets(dims(spark))
    found = s.find_targets(s.find_levels(rows, sheets, "p_name"), sheets, "p_name")
    return found.select(
        "p_partkey",
        _names("levels.found").alias("levels"),
        F.col("levels.rest").alias("remainder"),
        _names("targets.found").alias("targets"),
    )


@query(
    "map_levels",
    f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(
          ({q.consume('title', 'level_entries', True)}).found, lambda f: level_map[f].level))), '|')
          AS levels FROM {DOCS}, {DOC_DICT}""",
)
def map_levels(spark, sf_dir):
    found = s.find_levels(_documents(spark, sf_dir), _doc_sheets(spark), "title")
    names = F.array_sort(t.canonical_levels(F.col("levels.found")))
    return found.select("doc_id", F.array_join(names, "|").alias("levels"))


@query(
    "distinct_levels",
    """SELECT o_custkey, array_to_string(list_sort(list_distinct(list(o_orderpriority))), '|')
         AS priorities FROM orders GROUP BY o_custkey""",
)
def distinct_levels(spark, sf_dir):
    # A set per key, so the state of a hot key stays as small as its distinct values.
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("priorities"))
    )


LEVELED = f"""(SELECT p_partkey, {q.best_level('lv.found')} AS bl, tg, lv.rest AS rest, d.*
  EXCLUDE (p_partkey, lv, tg) FROM (SELECT p_partkey,
    {q.consume('p_name', 'level_entries', True)} AS lv,
    ({q.consume('p_name', 'target_entries', False)}).found AS tg, dict.*
    FROM part, {DICT} AS dict) AS d)"""


def _leveled(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sheets = s.prepare_sheets(dims(spark))
    found = s.find_targets(s.find_levels(rows, sheets, "p_name"), sheets, "p_name")
    return found.withColumn("best", t.best_level(F.col("levels.found"))), sheets


@query(
    "best_level",
    f"SELECT p_partkey, bl.level AS title_level, bl.rank AS rank FROM {LEVELED}",
)
def best_level(spark, sf_dir):
    found, _ = _leveled(spark, sf_dir)
    return found.select(
        "p_partkey",
        F.col("best.level").alias("title_level"),
        F.col("best.rank").cast("bigint").alias("rank"),
    )


@query(
    "level_points",
    f"SELECT p_partkey, bl.level AS title_level, bl.points AS points FROM {LEVELED} "
    "WHERE bl IS NOT NULL",
)
def level_points(spark, sf_dir):
    found, _ = _leveled(spark, sf_dir)
    return found.where(F.col("best").isNotNull()).select(
        "p_partkey", F.col("best.level").alias("title_level"), F.col("best.points").alias("points")
    )


AT_LEVEL = f"""(SELECT p_partkey, rest, {q.best_target('tg', 'at_level')} AS bt, keyword_map,
  keyword_names, keyword_entries
  FROM (SELECT *, coalesce(bl.level, 'individual contributer') AS at_level FROM {LEVELED}))"""


def _targeted(spark, sf_dir):
    found, sheets = _leveled(spark, sf_dir)
    level = F.coalesce(F.col("best.level"), F.lit(t.DEFAULT_LEVEL))
    return found.withColumn("target", t.best_target(F.col("targets.found"), level)), sheets


@query("best_target", f"SELECT p_partkey, bt.target AS target FROM {AT_LEVEL}")
def best_target(spark, sf_dir):
    found, _ = _targeted(spark, sf_dir)
    return found.select("p_partkey", F.col("target.entry").alias("target"))


@query(
    "points_lookup",
    f"SELECT p_partkey, -bt.points AS points FROM {AT_LEVEL} WHERE bt IS NOT NULL",
)
def points_lookup(spark, sf_dir):
    found, _ = _targeted(spark, sf_dir)
    return found.where(F.col("target").isNotNull()).select(
        "p_partkey", F.col("target.points").alias("points")
    )


KEYED = f"(SELECT p_partkey, keyword_map, {q.keywords_found('rest')} AS kw FROM {AT_LEVEL})"


@query(
    "keyword_points",
    f"SELECT p_partkey, k AS keyword, keyword_map[k] AS points "
    f"FROM (SELECT p_partkey, keyword_map, unnest(kw) AS k FROM {KEYED})",
)
def keyword_points(spark, sf_dir):
    found, sheets = _targeted(spark, sf_dir)
    rest = found.withColumn("rest", F.col("levels.rest"))
    keyed = s.find_keywords(rest, sheets, "rest")
    return keyed.select("p_partkey", F.inline("keywords").alias("keyword", "points"))


@query(
    "sum_keyword_points",
    f"""SELECT p_partkey, CAST(50 + coalesce(list_sum(list_transform(kw,
          lambda k: keyword_map[k])), 0) AS INTEGER) AS points FROM {KEYED}""",
)
def sum_keyword_points(spark, sf_dir):
    found, sheets = _targeted(spark, sf_dir)
    rest = found.withColumn("rest", F.col("levels.rest"))
    keyed = s.find_keywords(rest, sheets, "rest")
    return keyed.select("p_partkey", t.keyword_total(F.col("keywords")).alias("points"))


SCORED = q.scored(CLEAN_TITLES, "cleanTitle", sheet_sql)


@query("score_title", SCORED)
def score_title(spark, sf_dir):
    rows = filters.filter_null(postings(spark, sf_dir), "title").select(*KEYS, "title")
    clean = s.clean_title(rows, dims(spark), "title").drop("title")
    return s.score_title(clean, s.prepare_sheets(dims(spark)), "cleanTitle").select(
        *KEYS, "cleanTitle", "score.*"
    )


@query("score_part_names", q.scored("SELECT p_partkey, p_name FROM part", "p_name", sheet_sql))
def score_part_names(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sheets = s.prepare_sheets(dims(spark))
    return s.score_title(rows, sheets, "p_name").select("p_partkey", "p_name", "score.*")


@query("score_documents", q.scored(f"SELECT * FROM {DOCS}", "title", doc_sheet))
def score_documents(spark, sf_dir):
    scored = s.score_title(_documents(spark, sf_dir), _doc_sheets(spark), "title")
    return scored.select("doc_id", "title", "score.*")


@query(
    "filter_score",
    f"SELECT {KEYS_SQL}, points AS titleScore FROM ({SCORED}) WHERE points >= 80",
)
def filter_score(spark, sf_dir):
    rows = filters.filter_null(postings(spark, sf_dir), "title").select(
        *KEYS, F.col("title").alias("JobTitle")
    )
    return filters.filter_score(s.add_title_score(rows, dims(spark))).drop("JobTitle")


# Dictionaries derived from the tables: part names in order of first appearance.
NAMES = "SELECT p_name AS entry, min(p_partkey) AS pos FROM part GROUP BY p_name"


def _part_names(spark, sf_dir):
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_name").alias("entry"))
        .agg(F.min("p_partkey").alias("pos"))
    )


@query(
    "sort_by_length",
    f"SELECT entry, row_number() OVER (ORDER BY length(entry) DESC, pos) AS lookup_order FROM ({NAMES})",
)
def sort_by_length(spark, sf_dir):
    ordered = s.sort_by_length(_part_names(spark, sf_dir), "entry")
    return ordered.select("entry", F.col("lookup_order").cast("bigint").alias("lookup_order"))


@query(
    "rank_levels",
    """SELECT p_type AS job_level, points, row_number() OVER (ORDER BY points DESC, pos) AS rank
       FROM (SELECT p_type, min(p_partkey) AS pos, CAST(count(*) // 25 AS INTEGER) AS points
             FROM part GROUP BY p_type)""",
)
def rank_levels(spark, sf_dir):
    levels = (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_type").alias("job_level"))
        .agg(
            F.min("p_partkey").alias("pos"),
            F.floor(F.count("*") / 25).cast("int").alias("points"),
        )
    )
    return s.rank_levels(levels).select("job_level", "points", F.col("rank").cast("bigint"))
