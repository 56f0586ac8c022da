"""Statistics over the logs of a crawl.

Each log is scanned once and reduced to a small histogram; the report's sections
are read off the histograms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom import fixed_values as fixed
from searchloom.functions import urls
from searchloom.operators.links import outcome
from searchloom.operators.ordered import numbered
from searchloom.storage import written


def status_histogram(fetches: DataFrame) -> DataFrame:
    return fetches.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def fetch_counts(fetches: DataFrame) -> DataFrame:
    """Attempted, succeeded (2xx) and failed fetches."""
    return _fetch_counts(status_histogram(fetches))


def _fetch_counts(statuses: DataFrame) -> DataFrame:
    succeeded = F.coalesce(F.sum(F.when(F.col("status").startswith("2"), F.col("n"))), F.lit(0))
    attempted = F.coalesce(F.sum("n"), F.lit(0))
    return (
        statuses.agg(attempted.alias("attempted"), succeeded.alias("succeeded"))
        .withColumn("failed", F.col("attempted") - F.col("succeeded"))
    )


def outcome_counts(fetches: DataFrame) -> DataFrame:
    return fetches.groupBy(outcome(F.col("status")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def crawl_totals(fetches: DataFrame) -> DataFrame:
    """Pages, successes and failures; a redirect counts as a page only."""
    def total(*names: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("outcome").isin(*names), F.col("n"))), F.lit(0))

    return outcome_counts(fetches).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pages"),
        total("success").alias("successes"),
        total("failed", "error").alias("failures"),
    )


def size_bucket(size: Column) -> Column:
    """Number of the bucket a byte size falls into."""
    bucket = F.when(F.lit(False), F.lit(0))
    for number, (edge, _) in enumerate(fixed.SIZE_BUCKETS):
        bucket = bucket.when(size < edge, F.lit(number)) if edge else bucket.otherwise(F.lit(number))
    return bucket


def bucket_name(bucket: Column) -> Column:
    names = F.array(*[F.lit(name) for _, name in fixed.SIZE_BUCKETS])
    return F.element_at(names, bucket + 1)


def _visit_summary(visits: DataFrame) -> DataFrame:
    """One pass over the visit log; all visit statistics are sums over this small table."""
    return visits.groupBy(size_bucket(F.col("size")).alias("bucket"), "content_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("out_links").cast("bigint")).alias("out_links")
    )


def size_histogram(visits: DataFrame) -> DataFrame:
    """``(bucket, size_range, n)``; empty buckets are left out."""
    return _size_histogram(_visit_summary(visits))


def _size_histogram(summary: DataFrame) -> DataFrame:
    buckets = summary.groupBy("bucket").agg(F.sum("n").alias("n"))
    return buckets.select("bucket", bucket_name(F.col("bucket")).alias("size_range"), "n")


def content_type_histogram(visits: DataFrame) -> DataFrame:
    return _content_type_histogram(_visit_summary(visits))


def _content_type_histogram(summary: DataFrame) -> DataFrame:
    return summary.groupBy("content_type").agg(F.sum("n").alias("n"))


def total_links(visits: DataFrame) -> DataFrame:
    """Sum of the visits' distinct out-links (not the number of distinct links)."""
    return _total_links(_visit_summary(visits))


def _total_links(summary: DataFrame) -> DataFrame:
    return summary.agg(F.coalesce(F.sum("out_links"), F.lit(0)).alias("total_urls"))


def url_uniques(url_rows: DataFrame, site: str, approximate: bool = False) -> DataFrame:
    """Distinct URLs: all, within the site (its name occurs in the host), outside.

    Exact counts come from one distinct; a URL is within or not by itself, so the
    three counts need no further shuffle of URLs.
    """
    within = urls.netloc(F.col("url")).contains(site)
    if approximate:
        return url_rows.agg(
            F.approx_count_distinct("url").alias("n_unique"),
            F.approx_count_distinct(F.when(within, F.col("url"))).alias("n_within"),
            F.approx_count_distinct(F.when(~within, F.col("url"))).alias("n_outside"),
        )
    return (
        url_rows.select("url").distinct()
        .agg(
            F.count(F.lit(1)).alias("n_unique"),
            F.count_if(within).alias("n_within"),
            F.count_if(~within).alias("n_outside"),
        )
    )


def _section(number: int, lines: DataFrame) -> DataFrame:
    return lines.select(
        F.lit(number).alias("section_no"),
        F.lit(fixed.REPORT_SECTIONS[number]).alias("section"),
        F.col("pos").cast("int").alias("pos"),
        F.col("metric").cast("string").alias("metric"),
        F.col("value").cast("bigint").alias("value"),
    )


def _named(row: DataFrame, names: dict[str, str], first: int = 0) -> DataFrame:
    """One row of figures to a line per figure."""
    entries = [
        F.struct(F.lit(first + i).alias("pos"), F.lit(name).alias("metric"),
                 F.col(column).cast("bigint").alias("value"))
        for i, (column, name) in enumerate(names.items())
    ]
    return row.select(F.inline(F.array(*entries)))


def _numbered(histogram: DataFrame, metric: str, order: str) -> DataFrame:
    """Lines of a histogram in order; of any length, as statuses and types come from outside."""
    return numbered(histogram, [order]).select("pos", F.col(metric).alias("metric"), F.col("n").alias("value"))


def crawl_report(fetches: DataFrame, visits: DataFrame, url_rows: DataFrame, site: str) -> DataFrame:
    """The report as ``(section_no, section, pos, metric, value)``.

    The two histograms behind most sections are written first, so that each log is
    scanned once.
    """
    statuses = written(status_histogram(fetches), "statuses")
    summary = written(_visit_summary(visits), "visit-summary")
    fetch_lines = dict(zip(("attempted", "succeeded", "failed"), fixed.FETCH_LINES))
    unique_lines = dict(zip(("n_unique", "n_within", "n_outside"), fixed.URL_LINES[1:]))
    sections = [
        _section(0, _named(_fetch_counts(statuses), fetch_lines)),
        _section(1, _named(_total_links(summary), {"total_urls": fixed.URL_LINES[0]})),
        _section(1, _named(url_uniques(url_rows, site), unique_lines, first=1)),
        _section(2, _numbered(statuses, "status", "status")),
        _section(3, _numbered(_size_histogram(summary), "size_range", "bucket")),
        _section(4, _numbered(_content_type_histogram(summary), "content_type", "content_type")),
    ]
    report = sections[0]
    for section in sections[1:]:
        report = report.unionByName(section)
    return report


def report_lines(report: DataFrame, site: str | None = None, threads: int | None = None) -> DataFrame:
    """``(section_no, pos, value)``: title, rule and ``name: figure`` lines in text form.

    Lines with the crawled ``site`` and the number of ``threads`` come first where they are given.
    """
    given = [(name, value) for name, value in zip(fixed.REPORT_HEAD, (site, threads), strict=True) if value is not None]
    head = report.sparkSession.createDataFrame(
        [(-1, pos, f"{name}: {value}") for pos, (name, value) in enumerate(given)], "section_no int, pos int, value string"
    )
    titles = report.select("section_no", "section").distinct().select(
        "section_no",
        F.lit(-1).alias("pos"),
        F.concat(
            F.when((F.col("section_no") > 0) | F.lit(bool(given)), "\n").otherwise(""),
            F.col("section"), F.lit("\n"), F.repeat(F.lit("="), F.length("section")),
        ).alias("value"),
    )
    figures = report.select(
        "section_no", "pos", F.concat_ws(": ", "metric", F.col("value").cast("string")).alias("value")
    )
    return head.unionByName(titles).unionByName(figures)
