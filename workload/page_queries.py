"""Links, text and headings of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadpipe.functions import markup
from leadpipe.functions import postings as p
from leadpipe.functions.similarity import best_candidate
from leadpipe.operators import filters, pages
from workload import sqltext as q
from workload.data import table
from workload.registry import query

# The driver pages list relative links in <ul><li>.  As company pages they get
# <dl><dd> lists and, by page, full addresses, bare hosts or no address at all.
_COMPANY_PAGES = """
SELECT page_id, url,
  replace(replace(replace(replace(html, '<li>', '<dd>'), '</li>', '</dd>'),
    '<ul>', '<dl class="wide cmp-inline-block">'),
    'href="/', CASE page_id % 3 WHEN 0 THEN 'href="https://www.example.com/?a=1&amp;b='
      WHEN 1 THEN 'href="//www.example.com/' ELSE 'href="/' END) AS html
FROM {pages}
"""
COMPANY_PAGES = f"({_COMPANY_PAGES.format(pages='pages')}) AS company_pages"

_COMPANIES = """
SELECT page_id, CASE WHEN page_id % 7 = 3 THEN concat('https://www.google.com/#q=', page_id)
    ELSE url END AS CompanyLink, split_part(url, '/', 3) AS AccountName
FROM {pages}
"""
LINKS = q.outside_links(q.hrefs_in("html", "dd"))
LINKED = f"""(SELECT page_id, CompanyLink, AccountName,
    CASE WHEN contains(CompanyLink, 'google') THEN [CompanyLink]
      WHEN len(found) > 0 THEN found
      ELSE ['https://www.google.com/#q=' || AccountName] END AS links
  FROM ({_COMPANIES.format(pages='pages')}) LEFT JOIN (
    SELECT url, arg_min({LINKS}, page_id) AS found FROM {COMPANY_PAGES} GROUP BY url)
  ON CompanyLink = url)"""


def company_pages(spark, sf_dir):
    return spark.sql(_COMPANY_PAGES, pages=table(spark, sf_dir, "pages"))


def _linked(spark, sf_dir):
    companies = spark.sql(_COMPANIES, pages=table(spark, sf_dir, "pages"))
    return pages.company_links(companies, company_pages(spark, sf_dir))


@query(
    "company_links",
    f"SELECT page_id, CompanyLink, AccountName, array_to_string(links, '|') AS links FROM {LINKED}",
)
def company_links(spark, sf_dir):
    return _linked(spark, sf_dir).withColumn("links", F.array_join("links", "|"))


@query(
    "has_n_links",
    f"SELECT page_id, CompanyLink, links[1] AS link FROM {LINKED} WHERE len(links) = 1",
)
def has_n_links(spark, sf_dir):
    single = filters.has_n_links(_linked(spark, sf_dir), "links", 1)
    return single.select("page_id", "CompanyLink", F.get("links", F.lit(0)).alias("link"))


def _best_sql(scores) -> str:
    rows = f"SELECT page_id, {q.compact('AccountName')} AS name, links FROM {LINKED}"
    return f"SELECT page_id, AccountName, link, score FROM {LINKED} JOIN ({q.best_links(rows, 'page_id', scores)}) USING (page_id)"


def _best(spark, sf_dir, mode):
    linked = _linked(spark, sf_dir)
    best = best_candidate(p.compact_name(F.col("AccountName")), F.col("links"), mode)
    return linked.withColumn("best", best).select("page_id", "AccountName", "best.*")


@query("best_candidate", _best_sql(q.token_set_scores))
def best_candidate_link(spark, sf_dir):
    return _best(spark, sf_dir, "token_set_ratio")


@query("best_candidate_extract_one", _best_sql(q.weighted_scores))
def best_candidate_extract_one(spark, sf_dir):
    return _best(spark, sf_dir, "extractOne")


@query("best_candidate_token_sort", _best_sql(q.token_sort_scores))
def best_candidate_token_sort(spark, sf_dir):
    return _best(spark, sf_dir, "token_sort_ratio")


LIST = '<dl class="wide cmp-inline-block">'
BELOW = f"CASE WHEN contains(html, '{LIST}') THEN substr(html, strpos(html, '{LIST}')) END"


@query(
    "sidebar_link",
    f"SELECT page_id, ({q.hrefs_in(BELOW, 'dd')})[1] AS link FROM {COMPANY_PAGES}",
)
def sidebar_link(spark, sf_dir):
    link = markup.sidebar_link(F.col("html"), "cmp-inline-block")
    return company_pages(spark, sf_dir).select("page_id", link.alias("link"))


@query(
    "page_text",
    f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS block, blocks[i] AS text FROM (
          SELECT page_id, blocks, unnest(range(1, len(blocks) + 1)) AS i FROM (
            SELECT page_id, {q.page_text('html')} AS blocks FROM pages))""",
)
def page_text(spark, sf_dir):
    return pages.page_blocks(table(spark, sf_dir, "pages"))


# Pages made of nested lists, so that their blocks are known without reading them.
_NESTED = """
SELECT p_partkey AS page_id, concat('<ul class="top"><li>', a, '<div>', b, '</div><h3>', c, '</h3>',
  CASE WHEN p_partkey % 3 = 0 THEN concat('<ol><li>', d, '<p>', e, '</p>', f, '</li></ol>')
    WHEN p_partkey % 3 = 1 THEN concat('<!-- <li> --><p>', d, '<p>', e, '<div>', f, '</div>')
    ELSE concat('<ul><li>', d, '<li>', e, '</ul>', f) END,
  '</li></ul>', g, '<p>', h) AS html
FROM (SELECT *, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, p_brand AS c,
    split_part(p_type, ' ', 1) AS d, concat('e', p_size) AS e, concat('f', p_partkey) AS f,
    concat('g', p_size) AS g, concat('h', p_partkey) AS h FROM {part}) AS words
"""
_NESTED_WORDS = """SELECT *, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, p_brand AS c,
    split_part(p_type, ' ', 1) AS d, 'e' || p_size AS e, 'f' || p_partkey AS f, 'h' || p_partkey AS h FROM part"""
_NESTED_BLOCKS = f"""SELECT p_partkey AS page_id, CASE p_partkey % 3
    WHEN 0 THEN [a || b || c || d || e || f, d || e || f, e, h]
    WHEN 1 THEN [a || b || c || d || e || f, d, e, h]
    ELSE [a || b || c || d || e || f, d, e, h] END AS blocks FROM ({_NESTED_WORDS})"""


@query(
    "page_text_nested",
    f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS block, blocks[i] AS text
        FROM (SELECT page_id, blocks, unnest([1, 2, 3, 4]) AS i FROM ({_NESTED_BLOCKS}))""",
)
def page_text_nested(spark, sf_dir):
    return pages.page_blocks(spark.sql(_NESTED, part=table(spark, sf_dir, "part")))


@query(
    "first_heading",
    f"SELECT page_id, {q.plain(q.element('html', 'h1') + '[1]')} AS heading, "
    f"{q.plain(q.element('html', 'h2') + '[1]')} AS second_level FROM pages",
)
def first_heading(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        markup.first_heading(F.col("html"), "h1").alias("heading"),
        markup.first_heading(F.col("html")).alias("second_level"),
    )


_DIV_PAGES = """
SELECT page_id, replace(replace(replace(html, '<article>', '<div><div class="x">'),
  '</article>', '</div>'), '<nav>', '<div><nav>') AS html FROM {pages}
"""
_DIVS = f"""
SELECT page_id, list_reduce(
  list_transform(regexp_extract_all(regexp_replace(html, {q.text(markup.INVISIBLE)}, '', 'g'),
    '(?i)<(/?div|h1)(?:\\s[^>]*)?>', 1),
    lambda t: {{'tag': lower(t), 'flags': []::INTEGER[], 'headed': 0}}),
  lambda a, e: CASE e.tag
    WHEN 'div' THEN {{'tag': '', 'flags': list_append(a.flags, 0), 'headed': a.headed}}
    WHEN '/div' THEN {{'tag': '', 'flags': a.flags[:-2], 'headed': a.headed + coalesce(a.flags[-1], 0)}}
    ELSE {{'tag': '', 'flags': list_transform(a.flags, lambda f: 1), 'headed': a.headed}} END,
  {{'tag': '', 'flags': []::INTEGER[], 'headed': 0}}) AS walked
FROM ({_DIV_PAGES.format(pages='pages')})"""


@query(
    "headed_divs",
    f"SELECT page_id, CAST(walked.headed + coalesce(list_sum(walked.flags), 0) AS INTEGER) AS divs "
    f"FROM ({_DIVS})",
)
def headed_divs(spark, sf_dir):
    pages_with_divs = spark.sql(_DIV_PAGES, pages=table(spark, sf_dir, "pages"))
    return pages_with_divs.select("page_id", markup.headed_divs(F.col("html"), "h1").alias("divs"))
