import json
import random

import pytest

from searchloom import fixed_values as fixed
from searchloom.operators import ranking
from searchloom.plans import jobs
from searchloom.sources import csv_logs, query_sets, ranked_lists
from pyspark.sql import functions as F

TEN = [f"https://x{i}.com" for i in range(10)]


def put(**at):
    urls = list(TEN)
    for name, place in at.items():
        urls[place] = f"https://{name}.com/"
    return urls


# first list, second list, percentage, correlation
CASES = {
    "no match": (["http://x.org"], TEN, 0.0, 0.0),
    "one match, same position": (["http://www.a.com"], put(a=0), 10.0, 1.0),
    "one match, other position": (["http://a.com"], put(a=1), 10.0, -1.0),
    "two matches, same order": (["http://a.com", "http://b.com"], put(a=0, b=1), 20.0, 1.0),
    "two matches, swapped": (["http://a.com", "http://b.com"], put(b=0, a=1), 20.0, -1.0),
    "two matches, far off": (["http://a.com", "http://b.com"], put(a=5, b=6), 20.0, -49.0),
    "empty": ([], TEN, 0.0, 0.0),
}


def lists(spark, side):
    rows = [(name, case[side]) for name, case in CASES.items()]
    return spark.createDataFrame(rows, "query string, urls array<string>")


def by_query(df):
    return {r["query"]: r for r in df.collect()}


@pytest.mark.parametrize("form", ["lists", "rows"])
def test_statistics(spark, form):
    a, b = lists(spark, 0), lists(spark, 1)
    if form == "lists":
        stats = ranking.compare_lists(a, b)
    else:
        stats = ranking.compare_rows(*[ranking.normalized(ranking.list_rows(x)) for x in (a, b)])
    found = by_query(stats)
    for name, (_, _, percent, rho) in CASES.items():
        row = found[name]
        assert (row.pct_overlap, row.rho) == (percent, rho), name
        assert row.n_overlap == row.n_matches == round(percent / 10)


def expected(a, b):
    def clean(url):
        return url.removeprefix("http://").removeprefix("https://").removeprefix("www.").rstrip("/")

    a, b = [clean(u) for u in a], [clean(u) for u in b]
    common = set(a) & set(b)
    n, d2 = len(common), sum((a.index(u) - b.index(u)) ** 2 for u in common)
    rho = 0.0 if n == 0 else (1.0 if d2 == 0 else -1.0) if n == 1 else 1 - 6 * d2 / (n * (n * n - 1))
    return n, n / len(b) * 100, rho


def test_both_forms_agree_with_brute_force_on_lists_with_duplicates(spark):
    rng = random.Random(7)
    def some_list(n):
        return [rng.choice(["http://", "https://www."]) + f"s{rng.randint(0, 12)}.com/" for _ in range(n)]

    data = {f"q{i}": (some_list(rng.randint(0, 12)), some_list(rng.randint(1, 12))) for i in range(60)}
    a = spark.createDataFrame([(q, x) for q, (x, _) in data.items()], "query string, urls array<string>")
    b = spark.createDataFrame([(q, y) for q, (_, y) in data.items()], "query string, urls array<string>")
    in_row = by_query(ranking.compare_lists(a, b))
    joined = by_query(ranking.compare_rows(*[ranking.normalized(ranking.list_rows(x)) for x in (a, b)]))
    for q, (x, y) in data.items():
        n, percent, rho = expected(x, y)
        for row in (in_row[q], joined[q]):
            assert (row.n_matches, row.pct_overlap) == (n, percent)
            assert row.rho == pytest.approx(rho)
            assert row.n_overlap == int(percent / 10)


def test_report_has_averages_last_and_keeps_repeated_queries(spark, tmp_path):
    queries = spark.createDataFrame([(q,) for q in [*CASES, "no match"]], "query string")
    report = jobs.ranking_report(queries, lists(spark, 0), lists(spark, 1))
    rows = report.orderBy("part", "query").collect()
    assert len(rows) == len(CASES) + 2
    last, body = rows[-1], rows[:-1]
    assert last["query"] == fixed.AVERAGES_LABEL
    assert last.pct_overlap == pytest.approx(sum(r.pct_overlap for r in body) / len(body))
    assert last.rho == pytest.approx(sum(r.rho for r in body) / len(body))
    assert last.n_overlap == pytest.approx(last.pct_overlap / 10)
    csv_logs.write_ranking_stats(report, str(tmp_path / "stats"))
    lines = [x for p in sorted((tmp_path / "stats").glob("part-*")) for x in p.read_text().splitlines()]
    assert lines[0] == ",".join(fixed.RANKING_STATS_HEADER)
    assert lines[-1].startswith("Averages,")


def test_missing_keys_and_key_join(spark):
    a = spark.createDataFrame([("p", ["u"]), ("q", ["v"])], "query string, urls array<string>")
    b = spark.createDataFrame([("p", ["w"])], "query string, urls array<string>")
    assert [tuple(r) for r in ranking.key_join(a, b).collect()] == [("p", ["u"], ["w"])]
    assert [r[0] for r in ranking.missing_keys(a, b).collect()] == ["q"]


def test_top_results_with_one_hot_query(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"q{i % 50}", rng.randint(0, 5), i, f"u{rng.randint(0, 40)}") for i in range(3000)]
    found = {}
    for r in ranking.top_results(spark.createDataFrame(rows, "query string, selector_no int, pos int, url string"), 10).collect():
        found.setdefault(r["query"], {})[r["rank"]] = r["url"]
    wanted = {}
    for query, _, _, url in sorted(rows, key=lambda r: r[1:3]):
        seen = wanted.setdefault(query, [])
        if url not in seen and len(seen) < 10:
            seen.append(url)
    assert found == {q: dict(enumerate(urls)) for q, urls in wanted.items()}


def test_results_from_pages(spark):
    page = (
        '<div class="result__title"><a href="/l/?uddg=https%3A%2F%2Fwww.b.com%2F">b</a></div>'
        '<div class="results"><a class="result__a" href="https://duckduckgo.com/l/?uddg=http%3A%2F%2Fa.com%2Fx&amp;rut=1">a</a>'
        '<a class="result__a" href="">none</a><a class="result__a" href="http://a.com/x/">again</a></div>'
    )
    pages = spark.createDataFrame([("q", page)], "query string, html string")
    rows = jobs.results_from_pages(pages).orderBy("rank").collect()
    assert [tuple(r) for r in rows] == [("q", 0, "a.com/x"), ("q", 1, "b.com")]


def test_first_seen(spark):
    rows = spark.createDataFrame([("q", 0, "a"), ("q", 1, "a"), ("q", 2, "b")], "query string, rank int, url string")
    assert sorted(tuple(r) for r in ranking.first_seen(rows).collect()) == [("q", "a", 0), ("q", "b", 2)]
    deduplicated = ranking.distinct_lists(
        spark.createDataFrame([("q", ["http://b.c/", "https://www.b.c", "a", ""])], "query string, urls array<string>")
    )
    assert deduplicated.first().urls == ["b.c", "a"]


def test_query_set_and_lists_files(spark, tmp_path):
    path = tmp_path / "queries.txt"
    path.write_text("  two  words \t\n\nplain\nplain\n")
    queries = query_sets.read_query_set(spark, str(path))
    rows = queries.select("query", query_sets.request_text(F.col("query")).alias("r")).collect()
    assert sorted(tuple(r) for r in rows) == [("", ""), ("plain", "plain"), ("plain", "plain"), ("two  words", "two+words")]

    given = {"a \"q\"": ["http://x/1", "http://x/2"], "é": [], "c": ["u"]}
    indented = tmp_path / "lists.json"
    indented.write_text(json.dumps(given, indent=2))
    back = ranked_lists.read_ranked_lists(spark, str(indented), one_object_per_file=True)
    assert {r["query"]: r["urls"] for r in back.collect()} == given
    ranked_lists.write_ranked_lists(back, str(tmp_path / "out"), queries_per_object=1)
    again = ranked_lists.read_ranked_lists(spark, str(tmp_path / "out"))
    assert {r["query"]: r["urls"] for r in again.collect()} == given


def test_the_last_run_of_a_query_wins(spark):
    runs = spark.createDataFrame(
        [(1, "q", ["old"]), (2, "q", ["new"]), (1, "p", ["only"])], "run int, query string, urls array<string>"
    )
    assert {r["query"]: r["urls"] for r in ranking.latest_lists(runs).collect()} == {"q": ["new"], "p": ["only"]}
