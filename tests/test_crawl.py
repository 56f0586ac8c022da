import pytest
from pyspark.sql import functions as F

from searchloom import fixed_values as fixed
from searchloom.operators import crawl_stats, links
from searchloom.plans import jobs
from searchloom.sources import csv_logs

HTML = (
    '<a href="/x">1</a><a href="/x#a">2</a><a href="/x">3</a><a href="//cdn.org/y.css">4</a>'
    '<a href="mailto:a@b">5</a><a href="">6</a>'
)
RESPONSES = [
    (1, "https://www.s.com/a", "200", "text/html; charset=utf-8", HTML),
    (2, "https://www.s.com/b.pdf", "200", "application/pdf", "x" * 1024),
    (3, "https://www.s.com/c", "404", "text/html", HTML),
    (4, "https://www.s.com/d", "200", "application/json", HTML),
    (5, "https://www.s.com/e", "301", None, ""),
    (6, "https://www.s.com/f", "200", None, HTML),
    (7, "https://www.s.com/g", fixed.FAILED_STATUS, None, None),
]


@pytest.fixture(scope="module")
def logs(spark):
    responses = spark.createDataFrame(
        RESPONSES, "page_id int, url string, status string, content_type string, html string"
    )
    return jobs.crawl_logs(responses, "https://www.s.com/")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_logs(logs):
    assert rows(logs.fetch) == sorted((r[1], r[2]) for r in RESPONSES)
    assert rows(logs.visit) == [
        ("https://www.s.com/a", len(HTML), 4, "text/html"),
        ("https://www.s.com/b.pdf", 1024, 0, "application/pdf"),
    ]
    assert rows(logs.urls) == sorted([
        ("https://www.s.com/x", "OK"), ("https://www.s.com/x#a", "OK"), ("https://www.s.com/x", "OK"),
        ("https://cdn.org/y.css", "N_OK"), ("mailto:a@b", "N_OK"),
    ])
    edges = rows(links.link_edges(logs.linked.where("page_id = 1")))
    assert len(edges) == 4 and all(src == "https://www.s.com/a" for src, _ in edges)


def test_logs_as_csv(spark, logs, tmp_path):
    odd = spark.createDataFrame([('https://x/"q",\\ y', "200"), (" b ", "FAILED"), ("", "999")], csv_logs.FETCH_LOG)
    csv_logs.write_log(odd, "fetch", str(tmp_path / "odd"))
    assert rows(csv_logs.read_log(spark, "fetch", str(tmp_path / "odd"))) == rows(odd)
    for kind, log in (("visit", logs.visit), ("urls", logs.urls)):
        csv_logs.write_log(log, kind, str(tmp_path / kind))
        assert rows(csv_logs.read_log(spark, kind, str(tmp_path / kind))) == rows(log)
    plain = tmp_path / "fetch.csv"
    plain.write_bytes(b'URL,Status\r\n"https://x/a,b",200\r\nhttps://x/""c,FAILED\r\n')
    assert rows(csv_logs.read_log(spark, "fetch", str(plain))) == [('https://x/""c', "FAILED"), ("https://x/a,b", "200")]


SITE = {
    "https://s.com/": ("200", "text/html", '<a href="/a">a</a><a href="b.html">b</a><a href="/x.css">x</a>', None),
    "https://s.com/a": ("301", None, "", "https://s.com/c"),
    "https://s.com/b.html": ("200", "text/html", '<a href="/">home</a><a href="/d">d</a>', None),
    "https://s.com/c": ("200", "text/html", '<a href="https://o.org/">o</a><a href="/e">e</a>', None),
    "https://s.com/e": ("200", "application/pdf", "pdf", None),
    "https://s.com/far": ("200", "text/html", "", None),
}


@pytest.mark.parametrize("depth, expected", [
    (0, {"https://s.com/": "200"}),
    (1, {"https://s.com/": "200", "https://s.com/a": "301", "https://s.com/b.html": "200", "https://s.com/c": "200"}),
    (2, {"https://s.com/": "200", "https://s.com/a": "301", "https://s.com/b.html": "200", "https://s.com/c": "200",
         "https://s.com/d": "FAILED", "https://s.com/e": "200"}),
])
def test_replay_follows_links_and_redirects(spark, depth, expected):
    rows_of = [(i, url, *site) for i, (url, site) in enumerate(SITE.items())]
    responses = spark.createDataFrame(
        rows_of, "page_id int, url string, status string, content_type string, html string, location string"
    )
    seeds = spark.createDataFrame([("https://s.com/",)], "url string")
    logs = jobs.replay_crawl(responses, seeds, "s.com", max_depth=depth)
    assert dict(rows(logs.fetch)) == expected
    assert {r.url for r in logs.visit.collect()} == {
        u for u, status in expected.items() if status == "200"
    }
    assert logs.urls.count() == {0: 3, 1: 7, 2: 7}[depth]


def fetches(spark, statuses):
    return spark.createDataFrame([(f"u{i}", s) for i, s in enumerate(statuses)], csv_logs.FETCH_LOG)


def test_fetch_statistics(spark):
    log = fetches(spark, ["200", "204", "404", "999", "FAILED", "301"])
    assert rows(crawl_stats.fetch_counts(log)) == [(6, 2, 4)]
    assert [r.status for r in crawl_stats.status_histogram(log).orderBy("status").collect()] == [
        "200", "204", "301", "404", "999", "FAILED",
    ]
    assert rows(crawl_stats.crawl_totals(log)) == [(6, 1, 4)]
    empty = log.where("false")
    assert rows(crawl_stats.fetch_counts(empty)) == [(0, 0, 0)]
    assert rows(crawl_stats.crawl_totals(empty)) == [(0, 0, 0)]


def test_size_edges(spark):
    sizes = [1023, 1024, 10239, 10240, 102400, 1048575, 1048576]
    df = spark.createDataFrame([(s,) for s in sizes], "size bigint")
    found = df.select("size", crawl_stats.size_bucket(F.col("size"))).orderBy("size").collect()
    assert [r[1] for r in found] == [0, 1, 1, 2, 3, 3, 4]


def test_unique_urls_by_substring_of_the_host(spark):
    urls = ["https://a.site.com/", "https://b.site.com/", "https://b.site.com/", "https://o.com/site", "site"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert rows(crawl_stats.url_uniques(df, "site")) == [(4, 2, 2)]
    assert rows(crawl_stats.url_uniques(df, "site", approximate=True)) == [(4, 2, 2)]


def test_report(spark, logs, tmp_path):
    report = crawl_stats.crawl_report(logs.fetch, logs.visit, logs.urls, "s.com")
    csv_logs.write_report(crawl_stats.report_lines(report), str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("part-*")
    text = part.read_text()
    assert text.splitlines()[:6] == [
        "Fetch Statistics", "================", "# fetches attempted: 7", "# fetches succeeded: 4",
        "# fetches failed or aborted: 3", "",
    ]
    figures = dict(line.rsplit(": ", 1) for line in text.splitlines() if ": " in line)
    assert figures["Total URLs extracted"] == "4"
    assert figures["# unique URLs extracted"] == "4"
    assert figures["# unique URLs within News Site"] == "2"
    assert figures["FAILED"] == "1" and figures["1KB ~ <10KB"] == "1" and figures["text/html"] == "1"
    # sums that must agree
    value = {(r.section_no, r.metric): r.value for r in report.collect()}
    assert value[0, fixed.FETCH_LINES[0]] == value[0, fixed.FETCH_LINES[1]] + value[0, fixed.FETCH_LINES[2]]
    assert sum(v for (s, _), v in value.items() if s == 2) == value[0, fixed.FETCH_LINES[0]]
    assert sum(v for (s, _), v in value.items() if s == 3) == sum(v for (s, _), v in value.items() if s == 4)
    assert value[1, fixed.URL_LINES[1]] == value[1, fixed.URL_LINES[2]] + value[1, fixed.URL_LINES[3]]


def test_report_with_its_head(spark, logs, tmp_path):
    report = crawl_stats.crawl_report(logs.fetch, logs.visit, logs.urls, "s.com")
    csv_logs.write_report(crawl_stats.report_lines(report, site="s.com", threads=4), str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("part-*")
    assert part.read_text().splitlines()[:5] == ["News site crawled: s.com", "Number of threads: 4", "", "Fetch Statistics", "================"]


def test_a_histogram_of_any_length_is_numbered_in_ranges(spark):
    from searchloom.operators.ordered import numbered

    names = [f"type/{k:05d}" for k in range(3000)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "content_type string, n int").repartition(6)
    assert sorted((r.pos, r.content_type) for r in numbered(df, ["content_type"]).collect()) == list(enumerate(names))
    assert numbered(df.where("false"), ["content_type"]).isEmpty()
    plan = crawl_stats._numbered(df, "content_type", "content_type")._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_range" in plan
