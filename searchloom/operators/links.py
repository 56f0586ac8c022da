"""From stored responses to links, and to the fetch, visit and URL logs of a crawl.

A page's HTML is read once. Resolved links stay in the page's row as an array, so
counting the distinct ones needs no shuffle; they become rows only where rows are
wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom import fixed_values as fixed
from searchloom.functions import html, urls


def page_links(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """Replace the HTML by ``hrefs`` (as written) and ``links`` (absolute), both in page order."""
    parts = pages.withColumn("hrefs", html.anchor_hrefs(F.col(html_column))).drop(html_column)
    resolved = F.transform(
        "hrefs", lambda href: urls.resolve_parts(F.col("url"), F.col("_base"), href)
    )
    return (
        parts.withColumn("_base", urls.split_url(F.col("url")))
        .withColumn("links", resolved)
        .drop("_base")
    )


def anchors(pages: DataFrame) -> DataFrame:
    """``(page_id, pos, href)`` for every non-empty link of every page."""
    return pages.select(
        "page_id", F.posexplode(html.anchor_hrefs(F.col("html"))).alias("pos", "href")
    )


def link_rows(linked: DataFrame) -> DataFrame:
    """``(page_id, page_url, pos, href, url)`` from :func:`page_links`."""
    return linked.select(
        "page_id",
        F.col("url").alias("page_url"),
        F.posexplode(F.arrays_zip("hrefs", "links")).alias("pos", "link"),
    ).select("page_id", "page_url", "pos", F.col("link.hrefs").alias("href"), F.col("link.links").alias("url"))


def validity(url: Column, seed_netloc: str) -> Column:
    return F.when(urls.is_valid_link(url, seed_netloc), fixed.VALID_LABEL).otherwise(fixed.INVALID_LABEL)


def distinct_links(links: str | Column = "links") -> Column:
    return F.size(F.array_distinct(links))


def media_type(header: Column) -> Column:
    return F.substring_index(F.coalesce(header, F.lit("")), ";", 1)


def outcome(status: Column) -> Column:
    """What became of a fetch: success, redirect, failed (exception) or error."""
    return (
        F.when(status == "200", "success")
        .when(status.isin("301", "302"), "redirect")
        .when(status == fixed.FAILED_STATUS, "failed")
        .otherwise("error")
    )


def fetch_log(responses: DataFrame) -> DataFrame:
    return responses.select("url", F.col("status").cast("string").alias("status"))


def _visited(linked: DataFrame) -> DataFrame:
    """Rows that get a visit row: fetched, and HTML or one of the listed binary types."""
    kind = F.col("content_type")
    is_html = F.contains(kind, F.lit("text/html"))
    is_binary = F.lit(False)
    for name in fixed.BINARY_CONTENT_TYPES:
        is_binary = is_binary | F.contains(kind, F.lit(name))
    return (
        linked.where(F.col("status") == "200")
        .withColumn("content_type", media_type(kind))
        .where(is_html | is_binary)
        .withColumn("is_html", is_html)
    )


def visit_log(linked: DataFrame) -> DataFrame:
    """``(url, size, out_links, content_type)``; only HTML has out-links."""
    return _visited(linked).select(
        "url",
        F.col("size").cast("bigint").alias("size"),
        F.when(F.col("is_html"), F.col("out_links")).otherwise(0).alias("out_links"),
        "content_type",
    )


def exploded_links(linked: DataFrame, *columns: Column | str) -> DataFrame:
    """A row per link, with ``columns`` of its page.

    The outer form keeps Catalyst from adding a test for empty arrays to the scan,
    for which the HTML would be read a second time.
    """
    rows = linked.select(*columns, F.explode_outer("links").alias("link"))
    return rows.where(F.col("link").isNotNull())


def url_log(linked: DataFrame, seed_netloc: str) -> DataFrame:
    """``(url, valid)``, a row per link occurrence on fetched HTML pages."""
    found = exploded_links(_visited(linked).where("is_html")).withColumnRenamed("link", "url")
    return found.withColumn("valid", validity(F.col("url"), seed_netloc))


def linked_responses(responses: DataFrame) -> DataFrame:
    """``(page_id, url, status, content_type, size, hrefs, links, out_links)``, the HTML left behind."""
    linked = page_links(responses.withColumn("size", F.octet_length("html")))
    return linked.withColumn("out_links", distinct_links())


def crawl_edges(linked: DataFrame, seed_netloc: str) -> DataFrame:
    """What a crawler follows: ``(src, dst, weight)``.

    Valid links of fetched HTML pages weigh 1. If there is a ``location`` column,
    valid targets of redirects weigh 0, as they are crawled at the depth of their source.
    """
    pages = _visited(linked).where("is_html")
    edges = exploded_links(pages, F.col("url").alias("src")).withColumnRenamed("link", "dst")
    edges = edges.withColumn("weight", F.lit(1))
    if "location" in linked.columns:
        redirects = linked.where(outcome(F.col("status")) == "redirect").select(
            F.col("url").alias("src"), F.col("location").alias("dst"), F.lit(0).alias("weight")
        )
        edges = edges.unionByName(redirects)
    return edges.distinct().where(urls.is_valid_link(F.col("dst"), seed_netloc))


def link_edges(linked: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` of the page graph."""
    found = exploded_links(linked, F.col("url").alias("src"))
    return found.withColumnRenamed("link", "dst").distinct()
