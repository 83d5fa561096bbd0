"""Jobs over a table of fetched pages (`page_id, url, html`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadpipe.functions import markup
from leadpipe.functions.postings import SEARCH_PREFIX, is_search_link
from leadpipe.operators.relational import same_key, top1


def company_links(
    companies: DataFrame,
    pages: DataFrame,
    container: str = "dd",
    link: str = "CompanyLink",
    account: str = "AccountName",
    into: str = "links",
) -> DataFrame:
    """Web addresses on a company's page, always as a list.

    A search link is its own answer.  Without a page, or with a page that
    names no address, the answer is the search for the account name.  The
    addresses are taken from the pages before the join, so no HTML is shuffled.
    Of several copies of a page the one with the smallest id counts.
    """
    addresses = pages.select(
        F.col("url").alias("_url"),
        "page_id",
        markup.outside_links(markup.hrefs_in(F.col("html"), container)).alias("_found"),
    )
    found = top1(addresses, "_url", "page_id", "_found").where(F.size("_found") > 0)
    search = F.array(F.concat(F.lit(SEARCH_PREFIX), F.col(account)))
    links = F.when(is_search_link(F.col(link)), F.array(F.col(link))).otherwise(
        F.coalesce("_found", search)
    )
    return (
        companies.join(found, same_key(F.col(link), F.col("_url")), "left")
        .withColumn(into, links)
        .drop("_url", "_found")
    )


def page_blocks(pages: DataFrame) -> DataFrame:
    """One row per text block: page_id, block number from 0, text."""
    return pages.select("page_id", F.posexplode(markup.page_text(F.col("html"))).alias("block", "text"))
