"""Stand-in inputs derived from the driver tables, and invented scoring sheets.

The stand-in views and the sheets are plain SQL text, so Spark and the checking
engine start from the same statement.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpipe.functions.postings import title_case
from workload import sqltext as q

AS_OF = datetime.date(2001, 8, 1)

# Total order of the posting rows; ids made of the first two repeat.
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
ORDER_SQL = ", ".join(ORDER)

# --- scoring sheets -----------------------------------------------------------

LEVELS = ["individual contributer", "manager", "director", "vice president"]
TARGETS = ["ring", "red ring", "bolt", "blue bolt", "gear", "small anvil"]
SHEETS = {
    "title_matrix": (
        "pos, title, level, points",
        [
            (i, title, level, 70 + 3 * i + 5 * j)
            for i, title in enumerate(TARGETS, 1)
            for j, level in enumerate(LEVELS)
        ],
    ),
    "mapping": (
        "pos, old, new",
        [
            (1, "old gizmo", "red ring"),
            (2, "small rod", "gear"),
            (3, "gizmo", "widget"),
            (4, "cold", "hot"),
            (5, "the", "der"),
        ],
    ),
    "level_mapping": (
        "pos, actual, sfdc",
        [
            (1, "senior", "manager"),
            (2, "lead", "director"),
            (3, "old", "individual contributer"),
            (4, "cold", "vice president"),
            (5, "hot", "manager"),
            (6, "new", "consultant"),
        ],
    ),
    "keywords": (
        "pos, keyword, points",
        [
            (1, "widget", 10),
            (2, "anvil", 25),
            (3, "plate", 30),
            (4, "household", 5),
            (5, "machinery", 12),
            (6, "large widget", 40),
            (7, "rod", 20),
            (8, "building", 5),
            (9, "ring", 1),
        ],
    ),
    "no_match_levels": (
        "pos, job_level, points",
        [
            (1, "individual contributer", 0),
            (2, "manager", 8),
            (3, "director", 13),
            (4, "vice president", 15),
        ],
    ),
}

# The same kinds of entries for the prose of `documents`.
DOC_SHEETS = {
    **SHEETS,
    "title_matrix": (
        "pos, title, level, points",
        [
            (i, title, level, 60 + i + 2 * j)
            for i, title in enumerate(["than her", "ther", "ation", "con la", "de la"], 1)
            for j, level in enumerate(LEVELS)
        ],
    ),
    "level_mapping": (
        "pos, actual, sfdc",
        [
            (1, "the", "manager"),
            (2, "in the", "director"),
            (3, "der", "individual contributer"),
            (4, "ing", "vice president"),
        ],
    ),
    "keywords": (
        "pos, keyword, points",
        [(1, "that", 3), (2, "in", 2), (3, "of the", 9), (4, "he", 1), (5, "und", 4), (6, "que", 5)],
    ),
}

TERRITORY = [
    *[(state, "REP_A") for state in ("BB", "CO", "CO")],
    *[(state, "REP_B") for state in ("LZ", "KS", "US")],
]


def values_sql(columns: str, rows: list[tuple]) -> str:
    """Rows as a SELECT both engines read."""

    def literal(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


def sheet_sql(name: str, sheets: dict = SHEETS) -> str:
    return values_sql(*sheets[name])


def dims(spark: SparkSession, sheets: dict = SHEETS) -> dict[str, DataFrame]:
    return {name: spark.sql(sheet_sql(name, sheets)) for name in sheets}


TERRITORY_SQL = values_sql("state, rep", TERRITORY)

# --- stand-in views -----------------------------------------------------------

_ACCOUNT = """CASE c_custkey % 5
      WHEN 0 THEN c_name
      WHEN 1 THEN concat('at&t ', lower(c_mktsegment), ' ', c_custkey)
      WHEN 2 THEN concat('o''neil-', c_custkey, ' & SONS')
      WHEN 3 THEN concat('café société ', c_custkey)
      ELSE concat(lower(c_mktsegment), ' GROUP ', c_custkey) END"""

_POSTINGS = f"""
SELECT
  concat('https://feed.example.com/p/', l_suppkey) AS url,
  CASE
    WHEN l_orderkey % 211 = 7 THEN NULL
    WHEN l_orderkey % 97 = 5 THEN 'https://jobs.example.com/viewjob'
    WHEN l_orderkey % 6 = 0
      THEN concat('https://jobs.example.com/rc/clk?jk=', job, '&fccid=', l_suppkey)
    WHEN l_orderkey % 6 = 3
      THEN concat('https://jobs.example.com/rc/clk?jk=', job, '&from=feed&fccid=', l_suppkey)
    WHEN l_orderkey % 3 = 1 THEN concat('https://jobs.example.com/jobs/Title-', job, '?q=1')
    ELSE concat('https://jobs.example.com/jobs/Lead-', split_part(p_name, ' ', 1), '-', job,
                '-', split_part(p_name, ' ', 2))
  END AS job_link,
  CASE
    WHEN l_orderkey % 503 = 11 THEN NULL
    WHEN l_linenumber % 4 = 0 THEN p_name
    WHEN l_linenumber % 4 = 1 THEN concat('Senior ', upper(p_name))
    WHEN l_linenumber % 4 = 2 THEN concat(p_name, ' (Lead)')
    ELSE concat(p_name, ' and ', lower(c_mktsegment))
  END AS title,
  CASE c_custkey % 4
    WHEN 0 THEN NULL
    WHEN 1 THEN concat('https://www.google.com/#q=', c_custkey)
    ELSE concat('https://jobs.example.com/cmp/', c_custkey)
  END AS company_link,
  {_ACCOUNT} AS account_name,
  CASE c_nationkey % 5
    WHEN 0 THEN NULL
    WHEN 1 THEN concat('City ', n_nationkey, ', ', chr(65 + n_nationkey), chr(65 + n_nationkey * 7 % 26))
    WHEN 2 THEN 'Portland, USA'
    WHEN 3 THEN 'Remote'
    ELSE 'Kansas City, KS or MO'
  END AS job_location,
  concat('We’re hiring: ', p_type, ' … ', p_brand, ' – naïve_test 😀 "quoted", ',
         c_mktsegment, '!') AS job_description,
  CASE
    WHEN age = 0 THEN 'Just posted'
    WHEN age = 1 THEN '1 day ago'
    WHEN age = 2 THEN '5 hours ago'
    WHEN age = 39 THEN 'days ago'
    WHEN age < 30 THEN concat(age, ' days ago')
    ELSE '30+ days ago'
  END AS job_date,
  {ORDER_SQL}
FROM (
  SELECT *, concat('k', l_orderkey, 'x', l_linenumber) AS job, %(age)s AS age
  FROM %(joins)s
) AS joined
"""
_JOINS = """{lineitem}
  JOIN {orders} ON l_orderkey = o_orderkey
  JOIN {customer} ON o_custkey = c_custkey
  JOIN {part} ON l_partkey = p_partkey
  JOIN {nation} ON c_nationkey = n_nationkey"""
# The same rows where no table is small enough to be sent to all tasks: orders meet their customers first, so that the many lines move once for both, and
# lines meet their parts, whose texts are short and few, while they are narrow.
_LARGE_JOINS = """{lineitem}
  JOIN {part} ON l_partkey = p_partkey
  JOIN (SELECT * FROM {orders}
        JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey) AS ordered ON l_orderkey = o_orderkey"""
_TABLES = ["lineitem", "orders", "customer", "part", "nation"]

# Spark makes a customer's name once, before its orders.
_NAMED_CUSTOMERS = f"SELECT c_custkey, {_ACCOUNT} AS name FROM {{customer}}"
_RESULTS_OF_NAMED = """
SELECT query, o_orderkey AS rank,
  concat('https://www.example.com/', o_orderkey) AS url, o_totalprice AS score
FROM {named} JOIN {orders} ON c_custkey = o_custkey
"""
_RAW_RESULTS = f"""
SELECT {_ACCOUNT} AS name, o_orderkey AS rank,
  concat('https://www.example.com/', o_orderkey) AS url, o_totalprice AS score
FROM {{customer}} JOIN {{orders}} ON c_custkey = o_custkey
"""

_EXISTING = "SELECT concat('k', o_orderkey, 'x', 3) AS JobId FROM {orders} WHERE o_orderstatus = 'F'"


def _age(date: str, engine: str) -> str:
    if engine == "spark":
        return f"datediff(DATE'{AS_OF}', CAST({date} AS DATE)) % 40"
    return f"date_diff('day', CAST({date} AS DATE), DATE '{AS_OF}') % 40"


def _named(text: str, tables: list[str]) -> str:
    return text.format(**{t: t for t in tables})


def _escape(text: str) -> str:
    """Double the percent signs that are SQL, leaving `%(age)s` and `%(joins)s`."""
    return text.replace("%", "%%").replace("%%(age)s", "%(age)s").replace("%%(joins)s", "%(joins)s")


# Tables whose rows go through costly text expressions.
COSTLY = ("lineitem", "documents", "pages")
# From so many lines on, the joins of postings shuffle them.
LARGE_ROWS = 1_000_000


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Share a scan of fewer splits than cores among all cores.

    For the small test tables, which are one file with one row group each.  Rows that
    go by the `key` of a join that shuffles need no shuffle of their own there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(key) if key else df.repartition(cores)


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows, key) if name in COSTLY else rows


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw postings (8 columns) followed by their order columns."""
    large = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() >= LARGE_ROWS
    joins, keys = (_LARGE_JOINS, {"lineitem": "l_orderkey"}) if large else (_JOINS, {})
    text = _escape(_POSTINGS) % {"age": _age("o_orderdate", "spark"), "joins": joins}
    return spark.sql(text, **{t: table(spark, sf_dir, t, keys.get(t)) for t in _TABLES})


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked results per company, under the names the clean postings use."""
    customers = spark.sql(_NAMED_CUSTOMERS, customer=table(spark, sf_dir, "customer"))
    named = customers.select("c_custkey", title_case(F.col("name")).alias("query"))
    return spark.sql(_RESULTS_OF_NAMED, named=named, orders=table(spark, sf_dir, "orders"))


def existing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_EXISTING, orders=table(spark, sf_dir, "orders"))


POSTINGS_SQL = _named(_escape(_POSTINGS) % {"age": _age("o_orderdate", "duckdb"), "joins": _JOINS}, _TABLES)
RESULTS_SQL = (
    f"SELECT {q.title_case('name')} AS query, rank, url, score "
    f"FROM ({_named(_RAW_RESULTS, ['customer', 'orders'])})"
)
EXISTING_SQL = _named(_EXISTING, ["orders"])
