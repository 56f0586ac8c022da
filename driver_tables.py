"""The given tables in the shapes the jobs expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from searchloom.functions import html
from searchloom.storage import spread_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return spread_out(table(spark, sf_dir, "documents").select("doc_id", "text"))


def pages(spark, sf_dir) -> DataFrame:
    return spread_out(table(spark, sf_dir, "pages"))


def page_lists(spark, sf_dir) -> DataFrame:
    """The links of a page as a ranked list: ``(query, urls)``."""
    return pages(spark, sf_dir).select(
        F.col("page_id").alias("query"), html.anchor_hrefs(F.col("html")).alias("urls")
    )


def _top_ten(scored: DataFrame, url) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), "c_custkey")
    return (
        scored.withColumn("rank", F.row_number().over(order) - 1)
        .where(F.col("rank") < 10)
        .select("query", "rank", url.alias("url"))
    )


def _customers(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("query"))
    return table(spark, sf_dir, "customer").join(nation, "c_nationkey")


def ranking_a(spark, sf_dir) -> DataFrame:
    """``(query, rank, url)``: the ten customers of a nation with the highest balance."""
    scored = _customers(spark, sf_dir).withColumn("score", F.col("c_acctbal").cast("decimal(18,2)"))
    return _top_ten(scored, F.concat(F.lit("http://www.shop.example.com/c/"), F.col("c_custkey"), F.lit("/")))


def ranking_b(spark, sf_dir) -> DataFrame:
    """``(query, rank, url)``: the ten customers of a nation with the highest order value."""
    value = (
        table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("score"))
    )
    scored = _customers(spark, sf_dir).join(value, "c_custkey")
    return _top_ten(scored, F.concat(F.lit("https://shop.example.com/c/"), F.col("c_custkey")))


def fetches(events: DataFrame) -> DataFrame:
    """Events as a fetch log ``(url, status)``."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "404").when(kind == "signup", "FAILED")
        .when(kind == "purchase", "301").when(kind == "view", "204").otherwise("200")
    )
    return events.select(
        F.concat(F.lit("https://example.com/u/"), F.col("user_id")).alias("url"), status.alias("status")
    )


def responses(spark, sf_dir) -> DataFrame:
    """Pages as stored responses with a status and a content-type header."""
    url = F.col("url")
    status = (
        F.when(url.contains("cheap-pills"), "404").when(url.contains("//m."), "302").otherwise("200")
    )
    header = (
        F.when(url.contains(".org/"), "application/pdf; version=1.7")
        .when(url.contains("/de/"), "application/json").otherwise("text/html; charset=utf-8")
    )
    return pages(spark, sf_dir).withColumn("status", status).withColumn("content_type", header)


def page_edges(spark, sf_dir, first_link_weight: int = 1) -> DataFrame:
    """Links between page URLs and raw hrefs, both ways; a page's first link may be a redirect."""
    found = pages(spark, sf_dir).select(
        "url", F.posexplode(html.anchor_hrefs(F.col("html"))).alias("pos", "href")
    )
    weight = F.when(F.col("pos") == 0, F.lit(first_link_weight)).otherwise(F.lit(1))
    ends = F.array(
        F.struct(F.col("url").alias("src"), F.col("href").alias("dst"), weight.alias("weight")),
        F.struct(F.col("href").alias("src"), F.col("url").alias("dst"), F.lit(1).alias("weight")),
    )
    return found.select(F.inline(ends)).distinct()


WALKED = "https://www.example.com/page/"


def walked_site(spark, sf_dir) -> DataFrame:
    """Pages as responses of one site that link to each other: by number, with redirects, missing pages and other types."""
    n = F.col("page_id")
    more = F.concat(F.lit('<a href="'), 2 * n + 1, F.lit('"><a href="/page/'), 2 * n + 2, F.lit('">'))
    to = F.when(n % 4 == 0, F.concat(F.lit("/page/"), n + 1)).otherwise(F.concat(F.lit(WALKED), n - n % 10 + 3 + n % 3 * 5))
    return pages(spark, sf_dir).select(
        "page_id", F.concat(F.lit(WALKED), n).alias("url"), F.concat("html", more).alias("html"),
        F.when(n % 5 == 3, "301").when(n % 11 == 10, "404").otherwise("200").alias("status"),
        F.when(n % 7 == 6, "application/pdf; version=1.7").otherwise("text/html; charset=utf-8").alias("content_type"),
        F.when(n % 5 == 3, to).alias("location"),
    )


def seed_page(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").where(F.col("page_id") == 0).select("url")
