"""Comparing two engines' ranked result lists, query by query.

Lists come in two shapes. ``lists(query, urls)`` has one row per query with a
short array; it is compared inside the row. ``rows(query, rank, url)`` has one row
per result; it is compared by joins on ``(query, url)``, so even a query with a
very long list is spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from searchloom import fixed_values as fixed
from searchloom.functions import urls

POSITIONS_PER_SELECTOR = 1 << 48


def list_rows(lists: DataFrame) -> DataFrame:
    """``(query, urls)`` to ``(query, rank, url)``, ranks from 0."""
    rows = lists.select("query", F.posexplode_outer("urls").alias("rank", "url"))
    return rows.where(F.col("rank").isNotNull())


def normalized(rows: DataFrame) -> DataFrame:
    return rows.withColumn("url", urls.normalize(F.col("url")))


def first_seen(rows: DataFrame) -> DataFrame:
    """One row per query and URL, at the rank of its first occurrence (gaps stay)."""
    return rows.groupBy("query", "url").agg(F.min("rank").alias("rank"))


def distinct_lists(lists: DataFrame) -> DataFrame:
    """First-seen distinct URLs of each short list, normalized; in the row, without a shuffle."""
    clean = F.array_distinct(F.transform("urls", urls.normalize))
    return lists.select("query", F.array_remove(clean, "").alias("urls"))


def top_results(candidates: DataFrame, k: int = fixed.RESULTS_PER_QUERY) -> DataFrame:
    """The first ``k`` distinct URLs by ``(selector_no, pos)``; rank from 0, without gaps.

    ``row_number() <= k`` is cut per task before the shuffle, so a query with very
    many candidates sends at most ``k`` rows per task. Selector and position are
    compared as one number, which keeps the aggregation a hash aggregation.
    """
    order = W.partitionBy("query").orderBy("seen_at", "url")
    place = F.col("selector_no").cast("bigint") * POSITIONS_PER_SELECTOR + F.col("pos")
    return (
        candidates.where(F.col("url") != "")
        .groupBy("query", "url")
        .agg(F.min(place).alias("seen_at"))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= k)
        .select("query", (F.col("place") - 1).alias("rank"), "url")
    )


def collect_lists(rows: DataFrame) -> DataFrame:
    """``(query, rank, url)`` back to ``(query, urls)``; meant for cut lists."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "url")))
    return rows.groupBy("query").agg(ordered["url"].alias("urls"))


def latest_lists(runs: DataFrame) -> DataFrame:
    """``(run, query, urls)`` to ``(query, urls)``: the last run of a query wins."""
    return runs.groupBy("query").agg(F.max_by("urls", "run").alias("urls"))


def key_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both lists of each query that the two sides share: ``(query, a_urls, b_urls)``."""
    return a.select("query", F.col("urls").alias("a_urls")).join(
        b.select("query", F.col("urls").alias("b_urls")), "query"
    )


def missing_keys(queries: DataFrame, b: DataFrame) -> DataFrame:
    """Queries for which the second side has no list."""
    return queries.select("query").distinct().join(b.select("query"), "query", "left_anti")


def shared_urls(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct ``(query, url)`` found on both sides."""
    return a.select("query", "url").intersect(b.select("query", "url"))


def matches(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(query, url, rank_a, rank_b)`` of URLs on both sides, at their first ranks."""
    return (
        first_seen(a).withColumnRenamed("rank", "rank_a")
        .join(first_seen(b).withColumnRenamed("rank", "rank_b"), ["query", "url"])
    )


def spearman(n: Column, sum_of_squares: Column) -> Column:
    """Rank correlation on raw positions (it may leave [-1, 1]); 0 without a match."""
    size = n.cast("double")
    return (
        F.when(n == 0, F.lit(0.0))
        .when(n == 1, F.when(sum_of_squares == 0, F.lit(1.0)).otherwise(F.lit(-1.0)))
        .otherwise(1 - (6 * sum_of_squares) / (size * (size * size - 1)))
    )


def _statistics(n: Column, b_size: Column, sum_of_squares: Column) -> list[Column]:
    percent = F.try_divide(n.cast("double"), b_size) * 100
    return [
        n.cast("bigint").alias("n_matches"),
        (percent / 10).cast("int").alias("n_overlap"),
        percent.alias("pct_overlap"),
        spearman(n, sum_of_squares).alias("rho"),
    ]


def compare_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Statistics per query of ``b`` from ``(query, rank, url)`` rows; each side is read once, and nothing is joined.

    A query whose lists share nothing keeps its row. The percentage is taken of
    the length of the second list, duplicates counted. Rows can't tell an empty second list from none: a query
    that only ``a`` has gets no row here, as in :func:`compare_lists` without a list in ``b``.
    """
    none = F.lit(None).cast("int")
    both = a.select("query", "url", F.col("rank").alias("rank_a"), none.alias("rank_b")).unionByName(
        b.select("query", "url", none.alias("rank_a"), F.col("rank").alias("rank_b"))
    )
    firsts = both.groupBy("query", "url").agg(
        F.min("rank_a").alias("rank_a"), F.min("rank_b").alias("rank_b"), F.count("rank_b").alias("b_rows")
    )
    gap = F.col("rank_a") - F.col("rank_b")  # null unless the URL is on both sides
    per_query = firsts.groupBy("query").agg(
        F.count(gap).alias("n"), F.coalesce(F.sum(F.pow(gap, F.lit(2))), F.lit(0.0)).alias("d2"), F.sum("b_rows").alias("b_size")
    )
    return per_query.where("b_size > 0").select("query", *_statistics(F.col("n"), F.col("b_size"), F.col("d2")))


def compare_lists(a: DataFrame, b: DataFrame) -> DataFrame:
    """As :func:`compare_rows` for short lists: one join on the query, the rest in the row.

    Queries that only ``b`` has count as having no results on the other side.
    """
    def clean(urls_of: str) -> Column:
        return F.transform(urls_of, urls.normalize)

    joined = (
        b.select("query", clean("urls").alias("b_urls"))
        .join(a.select("query", clean("urls").alias("a_urls")), "query", "left")
        .withColumn("a_urls", F.coalesce("a_urls", F.array().cast("array<string>")))
    )

    def squared_distance(total: Column, url: Column) -> Column:
        gap = F.array_position("a_urls", url) - F.array_position("b_urls", url)
        return total + (gap * gap).cast("double")

    common = F.array_intersect("a_urls", "b_urls")
    measured = joined.select(
        "query",
        F.size(common).alias("n"),
        F.size("b_urls").alias("b_size"),
        F.aggregate(common, F.lit(0.0), squared_distance).alias("d2"),
    )
    return measured.select("query", *_statistics(F.col("n"), F.col("b_size"), F.col("d2")))


def averages(stats: DataFrame) -> DataFrame:
    """Mean percentage and correlation; the mean count is the percentage over ten."""
    return stats.agg(F.avg("pct_overlap").alias("pct_overlap"), F.avg("rho").alias("rho")).select(
        (F.col("pct_overlap") / 10).alias("n_overlap"), "pct_overlap", "rho"
    )


def stats_table(stats: DataFrame) -> DataFrame:
    """Rows per query and a last row of averages: ``(part, query, n_overlap, pct_overlap, rho)``.

    A ``position`` of the queries is kept, as a last column.
    """
    place = [c for c in stats.columns if c == "position"]
    rows = stats.select(
        F.lit(0).alias("part"), "query", F.col("n_overlap").cast("double").alias("n_overlap"),
        "pct_overlap", "rho", *place,
    )
    last = averages(stats).select(
        F.lit(1).alias("part"), F.lit(fixed.AVERAGES_LABEL).alias("query"),
        "n_overlap", "pct_overlap", "rho",
    )
    return rows.unionByName(last, allowMissingColumns=True)
