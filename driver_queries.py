"""Every operator and job on the given tables, next to the SQL it must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import driver_tables as given
from searchloom.functions import html, models, urls
from searchloom.operators import (
    cells, crawl_stats, fanout, links, rag, ranking, reach, textindex, vectors,
)
from searchloom.plans import jobs
from searchloom.sources import csv_logs, documents, index_text, query_sets, ranked_lists, records
from searchloom.storage import new_path, written
from searchloom.streaming import chat_memory, fetch_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def compared(sql: str | None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            ORACLES[query.__name__] = sql
        return query

    return register


# ---- inverted index -------------------------------------------------------

PHRASES = ("of the", "in the", "the the", "de la", "la de")
TOKENS_SQL = """words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents),
tokens AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, w[i] AS term
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)),
pairs AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, w[i] || ' ' || w[i + 1] AS term
  FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM words)),
counts AS (SELECT term, doc_id, count(*) AS n FROM tokens GROUP BY term, doc_id),
blocks AS (SELECT greatest(1, CAST(ceil(count(*) / 400.0) AS BIGINT)) AS b FROM documents)"""
DOCUMENTS_PER_BLOCK = 400


def _block(spark: SparkSession, sf_dir: str) -> Column:
    """A document's block, by a number that SQL can compute as well."""
    n_blocks = textindex.block_count(given.table(spark, sf_dir, "documents"), DOCUMENTS_PER_BLOCK)
    return F.pmod(F.col("doc_id"), F.lit(n_blocks))


def _word_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting blocks of the words of all documents."""
    docs = given.table(spark, sf_dir, "documents").select("doc_id", "text")
    words = textindex.tokenize(textindex.in_blocks(docs, _block(spark, sf_dir)), "block")
    return textindex.posting_blocks(textindex.term_counts(words, "block"), block=F.col("block"))


def _as_text(blocks: DataFrame) -> DataFrame:
    text = textindex.posting_text(F.col("postings"))
    return blocks.select("term", "block", "n_docs", text.alias("postings"))


def _postings_sql(counts: str) -> str:
    return f"""SELECT term, CAST(doc_id % b AS INTEGER) AS block, CAST(count(*) AS INTEGER) AS n_docs,
  string_agg(doc_id || ':' || n, ' ' ORDER BY doc_id) AS postings
FROM {counts}, blocks GROUP BY term, doc_id % b"""


@compared(f"WITH {TOKENS_SQL} SELECT doc_id, pos, term FROM tokens")
def idx_tokenize(spark, sf_dir):
    return textindex.tokenize(given.documents(spark, sf_dir))


@compared(f"WITH {TOKENS_SQL} SELECT doc_id, pos, term FROM pairs")
def idx_bigrams(spark, sf_dir):
    return textindex.bigrams(given.documents(spark, sf_dir))


@compared(f"WITH {TOKENS_SQL} SELECT term, doc_id, n FROM counts")
def idx_unigram(spark, sf_dir):
    return textindex.term_counts(textindex.tokenize(given.documents(spark, sf_dir)))


@compared(f"WITH {TOKENS_SQL} {_postings_sql('counts')}")
def idx_postings(spark, sf_dir):
    return _as_text(_word_blocks(spark, sf_dir))


@compared(f"""WITH {TOKENS_SQL}, phrase_counts AS (
  SELECT term, doc_id, count(*) AS n FROM pairs WHERE term IN {PHRASES} GROUP BY term, doc_id)
{_postings_sql('phrase_counts')}""")
def idx_phrase(spark, sf_dir):
    found = textindex.phrase_occurrences(given.documents(spark, sf_dir), PHRASES)
    return _as_text(textindex.posting_blocks(textindex.term_counts(found), block=_block(spark, sf_dir)))


@compared(f"WITH {TOKENS_SQL} SELECT term, CAST(doc_id AS VARCHAR) AS doc_id, n FROM counts")
def idx_parse(spark, sf_dir):
    path = new_path(spark, "index-text")
    index_text.write_index(_word_blocks(spark, sf_dir), path)
    return index_text.read_index(spark, path)


@compared("""SELECT CAST(doc_id AS VARCHAR) AS doc_id,
  lang || chr(9) || regexp_replace(text, '[\\r\\n\\t]', ' ', 'g') AS text FROM documents""")
def src_doc_tsv(spark, sf_dir):
    path = new_path(spark, "documents-tsv")
    docs = given.table(spark, sf_dir, "documents")
    line = F.concat_ws("\t", "doc_id", "lang", F.regexp_replace("text", "[\r\n\t]", " "))
    docs.select(F.explode(F.array(line, F.col("lang"))).alias("value")).write.text(path)
    return documents.read_documents(spark, path)


# ---- ranking comparison ---------------------------------------------------

RANKED_SQL = """customers AS (
  SELECT c.*, n_name AS query FROM customer c JOIN nation ON n_nationkey = c_nationkey),
a AS (
  SELECT query, CAST(r - 1 AS INTEGER) AS rank, 'http://www.shop.example.com/c/' || c_custkey || '/' AS url,
    'shop.example.com/c/' || c_custkey AS norm
  FROM (SELECT *, row_number() OVER (PARTITION BY query
    ORDER BY CAST(c_acctbal AS DECIMAL(18,2)) DESC, c_custkey) AS r FROM customers) WHERE r <= 10),
spent AS (
  SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY o_custkey),
b AS (
  SELECT query, CAST(r - 1 AS INTEGER) AS rank, 'https://shop.example.com/c/' || c_custkey AS url,
    'shop.example.com/c/' || c_custkey AS norm
  FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY v DESC, c_custkey) AS r
    FROM customers JOIN spent ON o_custkey = c_custkey) WHERE r <= 10),
sizes AS (SELECT query, count(*) AS b_size FROM b GROUP BY query),
found AS (
  SELECT a.query, count(*) AS n, sum((a.rank - b.rank) * (a.rank - b.rank)) AS d2
  FROM a JOIN b ON a.query = b.query AND a.norm = b.norm GROUP BY a.query),
stats AS (
  SELECT query, CAST(coalesce(n, 0) AS BIGINT) AS n_matches,
    CAST(trunc(coalesce(n, 0)::DOUBLE / b_size * 100 / 10) AS INTEGER) AS n_overlap,
    coalesce(n, 0)::DOUBLE / b_size * 100 AS pct_overlap,
    CASE WHEN n IS NULL THEN 0.0 WHEN n = 1 THEN CASE WHEN d2 = 0 THEN 1.0 ELSE -1.0 END
      ELSE 1 - 6 * d2::DOUBLE / (n::DOUBLE * (n::DOUBLE * n - 1)) END::DOUBLE AS rho
  FROM sizes LEFT JOIN found USING (query)),
means AS (SELECT avg(pct_overlap) AS pct_overlap, avg(rho) AS rho FROM stats)"""
STATS_TABLE_SQL = f"""WITH {RANKED_SQL}
SELECT 0 AS part, query, n_overlap::DOUBLE AS n_overlap, round(pct_overlap, 6) AS pct_overlap,
  round(rho, 6) AS rho FROM stats
UNION ALL SELECT 1, 'Averages', round(pct_overlap / 10, 6), round(pct_overlap, 6), round(rho, 6) FROM means"""


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        ranking.normalized(given.ranking_a(spark, sf_dir)),
        ranking.normalized(given.ranking_b(spark, sf_dir)),
    )


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


@compared("""SELECT c_mktsegment || ' ' || c_name AS query,
  replace(c_mktsegment || ' ' || c_name, ' ', '+') AS request FROM customer""")
def src_query_set(spark, sf_dir):
    path = new_path(spark, "query-set")
    line = F.concat(F.lit(" "), F.concat_ws(" ", "c_mktsegment", "c_name"), F.lit("  "))
    given.table(spark, sf_dir, "customer").select(line).write.text(path)
    queries = query_sets.read_query_set(spark, path)
    return queries.withColumn("request", query_sets.request_text(F.col("query")))


@compared(f"WITH {RANKED_SQL} SELECT query, rank, url FROM a")
def src_ranked_json(spark, sf_dir):
    path = new_path(spark, "ranked-lists")
    ranked_lists.write_ranked_lists(ranking.collect_lists(given.ranking_a(spark, sf_dir)), path, 7)
    return ranking.list_rows(ranked_lists.read_ranked_lists(spark, path))


@compared("""WITH v AS (SELECT page_id, url, CASE page_id % 5 WHEN 0 THEN 'x' ELSE '' END AS unit FROM pages),
r AS (SELECT url, page_id || unit || ',7,text/html' || CASE page_id % 7 WHEN 0 THEN ',more' ELSE '' END AS rest, page_id % 5 = 0 OR page_id % 7 = 0 AS bad, page_id FROM v)
SELECT 'visit' AS source, bad, CASE WHEN bad THEN url || ',' || rest ELSE url || ' ' || page_id END AS entry FROM r
UNION ALL SELECT 'lists', page_id % 5 = 0, CASE WHEN page_id % 5 = 0 THEN '{"' || page_id || '": ["' || url || '"' ELSE page_id || ' ' || url END FROM pages
UNION ALL SELECT 'lists', true, '{"n": ' || page_id || '}' FROM pages WHERE page_id % 7 = 0""")
def src_bad_rows(spark, sf_dir):
    """Logs and ranked lists with broken rows: what is read, and what is set aside."""
    n, url = F.col("page_id"), F.col("url")
    pages = given.table(spark, sf_dir, "pages")
    size = F.concat(n, F.when(n % 5 == 0, "x").otherwise(""))
    more = F.when(n % 7 == 0, ",more").otherwise("")
    visits, lists = new_path(spark, "bad-visits"), new_path(spark, "bad-lists")
    header = spark.createDataFrame([(",".join(csv_logs.VISIT_LOG.names),)], "value string").coalesce(1)
    rows = pages.select(F.concat(url, F.lit(","), size, F.lit(",7,text/html"), more).alias("value")).coalesce(1)
    header.unionByName(rows).coalesce(1).write.text(visits)
    broken = F.concat(F.lit('{"'), n, F.lit('": ["'), url, F.lit('"'), F.when(n % 5 == 0, "").otherwise("]}"))
    lines = F.array_compact(F.array(broken, F.when(n % 7 == 0, F.concat(F.lit('{"n": '), n, F.lit("}")))))
    pages.select(F.explode(lines)).write.text(lists)
    good = csv_logs.read_log(spark, "visit", visits, bad_rows="drop").select(F.concat_ws(" ", "url", "size"))
    ranked = ranking.list_rows(ranked_lists.read_ranked_lists(spark, lists, bad_rows="drop")).select(F.concat_ws(" ", "query", "url"))
    parts = [
        ("visit", False, good), ("visit", True, csv_logs.bad_log_rows(spark, "visit", visits).select("row")),
        ("lists", False, ranked), ("lists", True, ranked_lists.bad_ranked_lists(spark, lists).select("row")),
    ]
    named = [rows.toDF("entry").select(F.lit(source).alias("source"), F.lit(bad).alias("bad"), "entry") for source, bad, rows in parts]
    return reduce(DataFrame.unionByName, named)


@compared(f"""WITH {RANKED_SQL}
SELECT query, CAST(to_json(list(url ORDER BY rank)) AS VARCHAR) AS results FROM b GROUP BY query""")
def serp_collect(spark, sf_dir):
    runs = ranking.collect_lists(given.ranking_a(spark, sf_dir)).withColumn("run", F.lit(1)).unionByName(
        ranking.collect_lists(given.ranking_b(spark, sf_dir)).withColumn("run", F.lit(2))
    )
    return ranking.latest_lists(runs).select("query", F.to_json("urls").alias("results"))


@compared(f"""WITH {RANKED_SQL} SELECT query,
  string_agg(a.url, ' ' ORDER BY a.rank) AS a_urls, any_value(b_list) AS b_urls
FROM a JOIN (SELECT query, string_agg(url, ' ' ORDER BY rank) AS b_list FROM b GROUP BY query)
USING (query) GROUP BY query""")
def serp_key_join(spark, sf_dir):
    joined = ranking.key_join(
        ranking.collect_lists(given.ranking_a(spark, sf_dir)),
        ranking.collect_lists(given.ranking_b(spark, sf_dir)),
    )
    return joined.select(
        "query", F.array_join("a_urls", " ").alias("a_urls"), F.array_join("b_urls", " ").alias("b_urls")
    )


@compared("""SELECT DISTINCT c_custkey AS query FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def serp_missing_keys(spark, sf_dir):
    asked = given.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("query"))
    known = given.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return ranking.missing_keys(asked, known.select(F.col("o_custkey").alias("query")))


@compared(f"""WITH {RANKED_SQL}
SELECT query, n_matches, n_overlap, round(pct_overlap, 6) AS pct_overlap FROM stats""")
def serp_overlap(spark, sf_dir):
    stats = ranking.compare_rows(*_both(spark, sf_dir))
    return _rounded(stats.select("query", "n_matches", "n_overlap", "pct_overlap"), "pct_overlap")


@compared(f"WITH {RANKED_SQL} SELECT query, n_matches, round(rho, 6) AS rho FROM stats")
def serp_rank_correlation(spark, sf_dir):
    stats = ranking.compare_rows(*_both(spark, sf_dir))
    return _rounded(stats.select("query", "n_matches", "rho"), "rho")


@compared(f"""WITH {RANKED_SQL} SELECT round(pct_overlap / 10, 6) AS n_overlap,
  round(pct_overlap, 6) AS pct_overlap, round(rho, 6) AS rho FROM means""")
def serp_averages(spark, sf_dir):
    means = ranking.averages(ranking.compare_rows(*_both(spark, sf_dir)))
    return _rounded(means, "n_overlap", "pct_overlap", "rho")


@compared(STATS_TABLE_SQL)
def serp_stats_table(spark, sf_dir):
    table = ranking.stats_table(ranking.compare_rows(*_both(spark, sf_dir)))
    return _rounded(table, "pct_overlap", "rho", "n_overlap")


@compared(STATS_TABLE_SQL)
def serp_report(spark, sf_dir):
    queries = given.table(spark, sf_dir, "nation").select(F.col("n_name").alias("query"))
    report = jobs.ranking_report(
        queries,
        ranking.collect_lists(given.ranking_a(spark, sf_dir)),
        ranking.collect_lists(given.ranking_b(spark, sf_dir)),
    )
    return _rounded(report, "pct_overlap", "rho", "n_overlap")


@compared(f"""WITH {RANKED_SQL},
ordered AS (SELECT n_name AS query, row_number() OVER (ORDER BY n_regionkey, n_name DESC) - 1 AS row FROM nation)
SELECT row, query, n_overlap::DOUBLE AS n_overlap, round(pct_overlap, 6) AS pct_overlap, round(rho, 6) AS rho
FROM stats JOIN ordered USING (query)
UNION ALL SELECT (SELECT count(*) FROM nation), 'Averages', round(pct_overlap / 10, 6), round(pct_overlap, 6), round(rho, 6) FROM means""")
def serp_stats_csv(spark, sf_dir):
    """The CSV follows the query file, whatever the order of the lists."""
    query_file, stats_file = new_path(spark, "query-set"), new_path(spark, "ranking-stats")
    given.table(spark, sf_dir, "nation").orderBy("n_regionkey", F.desc("n_name")).select("n_name").coalesce(1).write.text(query_file)
    report = jobs.ranking_report(
        query_sets.read_query_set(spark, query_file, position=True),
        ranking.collect_lists(given.ranking_a(spark, sf_dir)),
        ranking.collect_lists(given.ranking_b(spark, sf_dir)),
    )
    csv_logs.write_ranking_stats(report, stats_file)
    return _rounded(csv_logs.read_ranking_stats(spark, stats_file), "pct_overlap", "rho", "n_overlap")


@compared(f"WITH {RANKED_SQL} SELECT query, norm AS url FROM a INTERSECT SELECT query, norm FROM b")
def serp_intersect(spark, sf_dir):
    return ranking.shared_urls(*_both(spark, sf_dir))


LINKS_SQL = """hrefs AS (
  SELECT page_id, url AS page_url, html, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages),
links AS (
  SELECT page_id, page_url, regexp_extract(page_url, '^[a-z]+://[^/?#]*') AS origin,
    regexp_extract(page_url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
    CAST(i - 1 AS INTEGER) AS pos, h[i] AS href
  FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM hrefs))"""
# the href of a page without a host, as a normalized URL: no slash at its end
NORM_HREF_SQL = "rtrim(regexp_extract(href, '^[^?#;]*'), '/')"


@compared(f"""WITH {LINKS_SQL}
SELECT page_id AS query, {NORM_HREF_SQL} AS url, min(pos) AS rank FROM links GROUP BY ALL""")
def serp_rank(spark, sf_dir):
    return ranking.first_seen(ranking.normalized(ranking.list_rows(given.page_lists(spark, sf_dir))))


@compared(f"""WITH {LINKS_SQL}, seen AS (
  SELECT page_id, {NORM_HREF_SQL} AS url, min(pos) AS pos FROM links GROUP BY ALL)
SELECT p.page_id AS query, CAST(count(s.url) AS INTEGER) AS n_urls,
  coalesce(string_agg(s.url, ' ' ORDER BY pos), '') AS urls
FROM pages p LEFT JOIN seen s ON s.page_id = p.page_id AND s.url <> '' GROUP BY p.page_id""")
def serp_first_seen_dedup(spark, sf_dir):
    lists = ranking.distinct_lists(given.page_lists(spark, sf_dir))
    return lists.select(
        "query", F.size("urls").alias("n_urls"), F.array_join("urls", " ").alias("urls")
    )


@compared("""WITH seen AS (
  SELECT l_suppkey AS query, 'shop.example.com/p/' || l_partkey AS url,
    min((CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) * 1000000000000
      + l_orderkey * 10 + l_linenumber) AS place
  FROM lineitem GROUP BY l_suppkey, l_partkey)
SELECT query, CAST(r - 1 AS INTEGER) AS rank, url
FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY place, url) AS r FROM seen) WHERE r <= 10""")
def serp_top10(spark, sf_dir):
    flag = F.col("l_returnflag")
    candidates = given.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("query"),
        F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("selector_no"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.concat(F.lit("shop.example.com/p/"), F.col("l_partkey")).alias("url"),
    )
    return ranking.top_results(candidates)


@compared(f"""WITH {LINKS_SQL}, seen AS (
  SELECT page_id AS query, 'search.example.com' || {NORM_HREF_SQL} AS url, min(pos) AS pos
  FROM links GROUP BY ALL)
SELECT query, CAST(r - 1 AS INTEGER) AS rank, url
FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY pos) AS r FROM seen) WHERE r <= 10""")
def serp_from_html(spark, sf_dir):
    stored = given.pages(spark, sf_dir).withColumnRenamed("page_id", "query")
    return jobs.results_from_pages(stored, ["nav a", "a"], host="search.example.com")


# ---- URLs and links -------------------------------------------------------

PAGE_URL_SQL = """u AS (
  SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '\\?([^#]*)', 1) AS query FROM pages)"""


@compared(f"""WITH {PAGE_URL_SQL}, n AS (
  SELECT *, regexp_replace(host, '^www\\.', '') AS bare,
    CASE WHEN query = '' THEN '' ELSE '?' || query END AS q FROM u)
SELECT page_id, unnest([url, split_part(url, ':', 2), url || '//', url || ';p=1#f', '']) AS url,
  unnest([bare || rtrim(path, '/') || q,
    bare || rtrim(path, '/') || q,
    bare || rtrim(path, '/') || CASE WHEN url LIKE '%#%' OR q = '' THEN q ELSE q || '//' END,
    bare || rtrim(path, '/') || CASE WHEN url LIKE '%#%' OR q = '' THEN q ELSE q || ';p=1' END,
    '']) AS normalized FROM n""")
def url_normalize(spark, sf_dir):
    url = F.col("url")
    variants = F.array(
        url, F.split_part(url, F.lit(":"), F.lit(2)), F.concat(url, F.lit("//")),
        F.concat(url, F.lit(";p=1#f")), F.lit(""),
    )
    rows = given.table(spark, sf_dir, "pages").select("page_id", F.explode(variants).alias("url"))
    return rows.withColumn("normalized", urls.normalize(F.col("url")))


@compared(f"WITH {PAGE_URL_SQL} SELECT page_id, url, host AS netloc FROM u")
def url_netloc(spark, sf_dir):
    return given.table(spark, sf_dir, "pages").select("page_id", "url", urls.netloc(F.col("url")).alias("netloc"))


@compared("""SELECT page_id, unnest(['absolute', 'rooted', 'network', 'plain', 'plus']) AS form,
  unnest([url, url, 'https://duckduckgo.com//duckduckgo.com/l/?uddg=' || url, url, url || '+%zz']) AS target
FROM pages""")
def url_unwrap_redirect(spark, sf_dir):
    url = F.col("url")
    wrapped = F.concat(F.lit("/l/?uddg="), F.url_encode(url))
    forms = {
        "absolute": F.concat(F.lit("https://duckduckgo.com"), wrapped, F.lit("&rut=1")),
        "rooted": wrapped,
        "network": F.concat(F.lit("//duckduckgo.com/l/?uddg="), url),
        "plain": url,
        "plus": F.concat(wrapped, F.lit("+%zz&rut=1")),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("form"), v.alias("link")) for k, v in forms.items()])
    rows = given.table(spark, sf_dir, "pages").select("page_id", F.inline(pairs))
    return rows.select("page_id", "form", urls.unwrap_redirect(F.col("link")).alias("target"))


@compared(f"WITH {LINKS_SQL} SELECT page_id, pos, href FROM links")
def links_extract(spark, sf_dir):
    return links.anchors(given.pages(spark, sf_dir))


@compared(f"""WITH {LINKS_SQL}, f AS (
  SELECT *, regexp_replace(path, '[^/]*$', '') AS folder, substr(href, 2) AS word FROM links)
SELECT page_id, pos, unnest(['rooted', 'relative', 'parent', 'here', 'query', 'network', 'phone']) AS form,
  unnest([origin || href, origin || folder || word,
    origin || regexp_replace(folder, '[^/]+/$', '') || word, origin || folder || word || '/',
    origin || path || '?q=' || word, regexp_extract(origin, '^[a-z]+:') || '//cdn.example.com' || href,
    'tel:' || page_id]) AS url FROM f""")
def links_resolve(spark, sf_dir):
    word = F.substr("href", F.lit(2))
    forms = {
        "rooted": F.col("href"),
        "relative": word,
        "parent": F.concat(F.lit("../"), word),
        "here": F.concat(F.lit("./"), word, F.lit("/x/..")),
        "query": F.concat(F.lit("?q="), word),
        "network": F.concat(F.lit("//cdn.example.com"), F.col("href")),
        "phone": F.concat(F.lit("tel:"), F.col("page_id")),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("form"), v.alias("link")) for k, v in forms.items()])
    hrefs = F.posexplode(html.anchor_hrefs(F.col("html"))).alias("pos", "href")
    found = given.pages(spark, sf_dir).select("page_id", F.col("url").alias("page_url"), hrefs)
    rows = found.select("page_id", "page_url", "pos", F.inline(pairs))
    return rows.select(
        "page_id", "pos", "form", urls.resolve(F.col("page_url"), F.col("link")).alias("url")
    )


def _valid_sql(url: str, seed: str) -> str:
    host = f"regexp_extract({url}, '^[a-z]+://([^/?#]*)', 1)"
    path = f"regexp_extract({url}, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
    return f"""CASE WHEN {host} <> '' AND suffix({host}, '{seed}') AND NOT contains({path}, '/tel:')
    AND split_part(lower({path}), '.', -1) NOT IN ('css', 'js', 'json', 'xml', 'svg', 'ico', 'gz')
    THEN 'OK' ELSE 'N_OK' END"""


@compared(f"""WITH {LINKS_SQL}, v AS (
  SELECT page_id, pos, unnest([origin || href, origin || href || '.JSON', origin || '/tel:' || pos,
    'tel:' || pos]) AS url FROM links)
SELECT page_id, pos, url, {_valid_sql('url', 'example.com')} AS valid FROM v""")
def links_validate(spark, sf_dir):
    rows = links.link_rows(links.page_links(given.pages(spark, sf_dir)))
    origin = F.regexp_extract("page_url", "^[a-z]+://[^/?#]*", 0)
    variants = F.array(
        F.col("url"), F.concat("url", F.lit(".JSON")),
        F.concat(origin, F.lit("/tel:"), F.col("pos")), F.concat(F.lit("tel:"), F.col("pos")),
    )
    links_of = rows.select("page_id", "pos", F.explode(variants).alias("url"))
    return links_of.withColumn("valid", links.validity(F.col("url"), "example.com"))


@compared(f"""WITH {LINKS_SQL}
SELECT page_id, page_url AS url, CAST(len(list_distinct(h)) AS INTEGER) AS out_links FROM hrefs""")
def page_outlinks(spark, sf_dir):
    linked = links.page_links(given.pages(spark, sf_dir))
    return linked.select("page_id", "url", links.distinct_links().alias("out_links"))


RESPONSES_SQL = f"""{LINKS_SQL},
responses AS (
  SELECT page_id, url, octet_length(encode(html)) AS size,
    CASE WHEN contains(url, 'cheap-pills') THEN '404' WHEN contains(url, '//m.') THEN '302' ELSE '200' END AS status,
    CASE WHEN contains(url, '.org/') THEN 'application/pdf' WHEN contains(url, '/de/') THEN 'application/json'
      ELSE 'text/html' END AS content_type FROM pages),
visits AS (
  SELECT page_id, url, CAST(size AS BIGINT) AS size, CAST(CASE WHEN content_type = 'text/html'
    THEN (SELECT count(DISTINCT href) FROM links l WHERE l.page_id = r.page_id) ELSE 0 END AS INTEGER) AS out_links,
    content_type
  FROM responses r WHERE status = '200' AND content_type IN ('text/html', 'application/pdf')),
url_rows AS (
  SELECT origin || href AS url FROM links JOIN visits USING (page_id) WHERE content_type = 'text/html'),
url_log AS (SELECT url, {_valid_sql('url', 'example.com')} AS valid FROM url_rows)"""


@compared(f"WITH {RESPONSES_SQL} SELECT url, size, out_links, content_type FROM visits")
def visit_log(spark, sf_dir):
    return links.visit_log(links.linked_responses(given.responses(spark, sf_dir)))


def _logs(spark: SparkSession, sf_dir: str) -> jobs.CrawlLogs:
    return jobs.crawl_logs(given.responses(spark, sf_dir), "https://example.com/")


def _long(fetch: DataFrame, visit: DataFrame, url_rows: DataFrame) -> DataFrame:
    def lines(log: DataFrame, name: str, *columns: str) -> DataFrame:
        return log.select(F.lit(name).alias("log"), "url", F.concat_ws(" ", *columns).alias("entry"))

    return (
        lines(fetch, "fetch", "status")
        .unionByName(lines(visit, "visit", "size", "out_links", "content_type"))
        .unionByName(lines(url_rows, "urls", "valid"))
    )


LOGS_SQL = f"""WITH {RESPONSES_SQL}
SELECT 'fetch' AS log, url, status AS entry FROM responses
UNION ALL SELECT 'visit', url, size || ' ' || out_links || ' ' || content_type FROM visits
UNION ALL SELECT 'urls', url, valid FROM url_log"""


@compared(LOGS_SQL)
def crawl_logs(spark, sf_dir):
    logs = _logs(spark, sf_dir)
    return _long(logs.fetch, logs.visit, logs.urls)


@compared(LOGS_SQL)
def src_crawl_logs(spark, sf_dir):
    logs = _logs(spark, sf_dir)
    back = []
    for kind, log in (("fetch", logs.fetch), ("visit", logs.visit), ("urls", logs.urls)):
        path = new_path(spark, f"csv-{kind}")
        csv_logs.write_log(log, kind, path)
        back.append(csv_logs.read_log(spark, kind, path))
    return _long(*back)


# ---- crawl statistics -----------------------------------------------------

FETCHES_SQL = """fetches AS (SELECT CASE event_type WHEN 'error' THEN '404' WHEN 'signup' THEN 'FAILED'
  WHEN 'purchase' THEN '301' WHEN 'view' THEN '204' ELSE '200' END AS status FROM events),
outcomes AS (SELECT status, CASE WHEN status = '200' THEN 'success' WHEN status IN ('301', '302') THEN 'redirect'
  WHEN status = 'FAILED' THEN 'failed' ELSE 'error' END AS outcome FROM fetches)"""


def _fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.fetches(given.table(spark, sf_dir, "events"))


@compared(f"""WITH {FETCHES_SQL} SELECT count(*) AS attempted,
  count(*) FILTER (status LIKE '2%') AS succeeded, count(*) FILTER (status NOT LIKE '2%') AS failed FROM fetches""")
def fetch_counts_(spark, sf_dir):
    return crawl_stats.fetch_counts(_fetches(spark, sf_dir))


@compared(f"WITH {FETCHES_SQL} SELECT status, count(*) AS n FROM fetches GROUP BY status")
def status_histogram(spark, sf_dir):
    return crawl_stats.status_histogram(_fetches(spark, sf_dir)).orderBy("status")


@compared(f"""WITH {FETCHES_SQL} SELECT outcome AS name, count(*) AS n FROM outcomes GROUP BY outcome
UNION ALL SELECT 'pages', count(*) FROM outcomes
UNION ALL SELECT 'successes', count(*) FROM outcomes WHERE outcome = 'success'
UNION ALL SELECT 'failures', count(*) FROM outcomes WHERE outcome IN ('failed', 'error')""")
def fetch_outcomes(spark, sf_dir):
    fetches = _fetches(spark, sf_dir)
    totals = crawl_stats.crawl_totals(fetches).unpivot([], ["pages", "successes", "failures"], "name", "n")
    counts = crawl_stats.outcome_counts(fetches).withColumnRenamed("outcome", "name")
    return counts.unionByName(totals)


@compared(f"""WITH {RESPONSES_SQL}, sized AS (
  SELECT CASE WHEN size < 1024 THEN 0 WHEN size < 10240 THEN 1 WHEN size < 102400 THEN 2
    WHEN size < 1048576 THEN 3 ELSE 4 END AS bucket FROM visits)
SELECT bucket, ['< 1KB', '1KB ~ <10KB', '10KB ~ <100KB', '100KB ~ <1MB', '>= 1MB'][bucket + 1] AS size_range,
  count(*) AS n FROM sized GROUP BY bucket""")
def size_histogram(spark, sf_dir):
    return crawl_stats.size_histogram(visit_log(spark, sf_dir))


@compared(f"WITH {RESPONSES_SQL} SELECT content_type, count(*) AS n FROM visits GROUP BY content_type")
def content_type_histogram(spark, sf_dir):
    return crawl_stats.content_type_histogram(visit_log(spark, sf_dir))


UNIQUES_SQL = """count(DISTINCT url) AS n_unique,
  count(DISTINCT url) FILTER (contains(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'example.com')) AS n_within,
  count(DISTINCT url) FILTER (NOT contains(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'example.com')) AS n_outside"""


@compared(f"WITH {LINKS_SQL}, x AS (SELECT origin || href AS url FROM links) SELECT {UNIQUES_SQL} FROM x")
def url_uniques(spark, sf_dir):
    linked = links.page_links(given.pages(spark, sf_dir))
    return crawl_stats.url_uniques(links.exploded_links(linked).withColumnRenamed("link", "url"), "example.com")


REPORT_SQL = f"""WITH {RESPONSES_SQL}, uniques AS (SELECT {UNIQUES_SQL} FROM url_rows),
sized AS (SELECT CASE WHEN size < 1024 THEN 0 WHEN size < 10240 THEN 1 WHEN size < 102400 THEN 2
    WHEN size < 1048576 THEN 3 ELSE 4 END AS bucket, count(*) AS n FROM visits GROUP BY ALL),
statuses AS (SELECT status, count(*) AS n FROM responses GROUP BY status),
types AS (SELECT content_type, count(*) AS n FROM visits GROUP BY content_type)
SELECT 0 AS section_no, 'Fetch Statistics' AS section, 0 AS pos, '# fetches attempted' AS metric, count(*) AS value FROM responses
UNION ALL SELECT 0, 'Fetch Statistics', 1, '# fetches succeeded', count(*) FROM responses WHERE status LIKE '2%'
UNION ALL SELECT 0, 'Fetch Statistics', 2, '# fetches failed or aborted', count(*) FROM responses WHERE status NOT LIKE '2%'
UNION ALL SELECT 1, 'Outgoing URLs:', 0, 'Total URLs extracted', CAST(sum(out_links) AS BIGINT) FROM visits
UNION ALL SELECT 1, 'Outgoing URLs:', 1, '# unique URLs extracted', n_unique FROM uniques
UNION ALL SELECT 1, 'Outgoing URLs:', 2, '# unique URLs within News Site', n_within FROM uniques
UNION ALL SELECT 1, 'Outgoing URLs:', 3, '# unique URLs outside News Site', n_outside FROM uniques
UNION ALL SELECT 2, 'Status Codes:', row_number() OVER (ORDER BY status) - 1, status, n FROM statuses
UNION ALL SELECT 3, 'File Sizes:', row_number() OVER (ORDER BY bucket) - 1,
  ['< 1KB', '1KB ~ <10KB', '10KB ~ <100KB', '100KB ~ <1MB', '>= 1MB'][bucket + 1], n FROM sized
UNION ALL SELECT 4, 'Content Types:', row_number() OVER (ORDER BY content_type) - 1, content_type, n FROM types"""


@compared(REPORT_SQL)
def crawl_report(spark, sf_dir):
    logs = _logs(spark, sf_dir)
    return crawl_stats.crawl_report(logs.fetch, logs.visit, logs.urls, "example.com")


@compared(f"""WITH report AS ({REPORT_SQL}), lines AS (
  SELECT -1 AS section_no, 0 AS pos, 0 AS part, 'News site crawled: example.com' AS line UNION ALL SELECT -1, 1, 0, 'Number of threads: 4'
  UNION ALL SELECT DISTINCT section_no, -1, unnest([0, 1, 2]), unnest(['', section, repeat('=', length(section))]) FROM report
  UNION ALL SELECT section_no, pos, 0, metric || ': ' || value FROM report)
SELECT row_number() OVER (ORDER BY section_no, pos, part) - 1 AS line_no, line FROM lines""")
def crawl_report_text(spark, sf_dir):
    """The report's text file, line by line."""
    path = new_path(spark, "report")
    lines = crawl_stats.report_lines(crawl_report(spark, sf_dir), site="example.com", threads=4)
    csv_logs.write_report(lines, path)
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))


# ---- reach ----------------------------------------------------------------

def _reach_sql(first_link_weight: int, depth: int, limit: str = "") -> str:
    return f"""WITH RECURSIVE {LINKS_SQL},
edges AS (SELECT page_url AS src, href AS dst, CASE WHEN pos = 0 THEN {first_link_weight} ELSE 1 END AS w FROM links
  UNION SELECT href, page_url, 1 FROM links),
reached AS (SELECT url, 0 AS depth FROM pages WHERE page_id = 0
  UNION SELECT dst, depth + w FROM reached JOIN edges ON src = url WHERE depth + w <= {depth}),
nearest AS (SELECT url, min(depth) AS depth FROM reached GROUP BY url)
SELECT url, depth FROM nearest ORDER BY depth, url {limit}"""


@compared(f"""WITH {RESPONSES_SQL}, targets AS (
  SELECT DISTINCT url FROM url_log WHERE valid = 'OK' AND url NOT IN (SELECT url FROM pages))
SELECT 'fetch' AS log, url, status AS entry FROM responses UNION ALL SELECT 'fetch', url, 'FAILED' FROM targets
UNION ALL SELECT 'visit', url, size || ' ' || out_links || ' ' || content_type FROM visits
UNION ALL SELECT 'urls', url, valid FROM url_log""")
def crawl_replay(spark, sf_dir):
    logs = jobs.replay_crawl(
        given.responses(spark, sf_dir), given.table(spark, sf_dir, "pages").select("url"), "example.com",
    )
    return _long(logs.fetch, logs.visit, logs.urls)


# Pages by number, each with its own links and links to two more; some redirect, some are missing, some aren't HTML.
WALK_SQL = f"""{LINKS_SQL},
site AS (SELECT page_id, 'https://www.example.com/page/' || page_id AS url,
    CASE WHEN page_id % 5 = 3 THEN '301' WHEN page_id % 11 = 10 THEN '404' ELSE '200' END AS status,
    CASE WHEN page_id % 7 = 6 THEN 'application/pdf' ELSE 'text/html' END AS content_type,
    CASE WHEN page_id % 5 <> 3 THEN NULL WHEN page_id % 4 = 0 THEN '/page/' || (page_id + 1)
      ELSE 'https://www.example.com/page/' || (page_id - page_id % 10 + 3 + page_id % 3 * 5) END AS location,
    octet_length(encode(html || '<a href="' || (2 * page_id + 1) || '"><a href="/page/' || (2 * page_id + 2) || '">')) AS size
  FROM pages),
site_links AS (SELECT page_id, 'https://www.example.com' || href AS dst FROM links
  UNION ALL SELECT page_id, 'https://www.example.com/page/' || (2 * page_id + unnest([1, 2])) FROM pages),
html_pages AS (SELECT * FROM site WHERE status = '200' AND content_type = 'text/html'),
walk_edges AS (SELECT url AS src, dst, 1 AS w FROM html_pages JOIN site_links USING (page_id)
  UNION SELECT url, location, 0 FROM site WHERE status = '301' AND location LIKE 'https:%')"""


@compared(f"""WITH RECURSIVE {WALK_SQL},
reached AS (SELECT url, 0 AS depth FROM site WHERE page_id IN (0, 3, 17)
  UNION SELECT dst, depth + w FROM reached JOIN walk_edges ON src = url WHERE depth + w <= 7),
crawled AS (SELECT DISTINCT r.url, site.page_id, coalesce(status, 'FAILED') AS status, content_type, size FROM reached r LEFT JOIN site USING (url))
SELECT 'fetch' AS log, url, status AS entry FROM crawled
UNION ALL SELECT 'visit', url, size || ' ' || CASE WHEN content_type = 'text/html'
  THEN (SELECT count(DISTINCT dst) FROM site_links l WHERE l.page_id = c.page_id) ELSE 0 END || ' ' || content_type FROM crawled c WHERE status = '200'
UNION ALL SELECT 'urls', dst, {_valid_sql('dst', 'www.example.com')} FROM crawled JOIN site_links USING (page_id)
  WHERE status = '200' AND content_type = 'text/html'""")
def crawl_walk(spark, sf_dir):
    """A walk from three seeds over stored pages, through redirects, some in circles, and relative ones that aren't followed."""
    seeds = given.table(spark, sf_dir, "pages").where("page_id IN (0, 3, 17)")
    seeds = seeds.select(F.concat(F.lit(given.WALKED), "page_id").alias("url"))
    logs = jobs.replay_crawl(given.walked_site(spark, sf_dir), seeds, "www.example.com", max_depth=7)
    return _long(logs.fetch, logs.visit, logs.urls)


@compared(_reach_sql(1, 6))
def bfs_reach(spark, sf_dir):
    return reach.reach(
        given.page_edges(spark, sf_dir).drop("weight"), given.seed_page(spark, sf_dir), max_depth=6
    )


@compared(_reach_sql(1, 4, "LIMIT 20"))
def bfs_cap(spark, sf_dir):
    """The cap falls inside a level."""
    edges = given.page_edges(spark, sf_dir).drop("weight")
    return reach.reach(edges, given.seed_page(spark, sf_dir), max_depth=4, max_pages=20)


@compared(_reach_sql(0, 3))
def redirect_follow(spark, sf_dir):
    edges = given.page_edges(spark, sf_dir, first_link_weight=0)
    return reach.reach(edges, given.seed_page(spark, sf_dir), max_depth=3)


# ---- vectors and retrieval ------------------------------------------------

def _slots_sql(source: str, key: str, text: str, dims: int) -> str:
    """Word counts by hash slot, as the stand-in vectorizer makes them."""
    return f"""SELECT {key}, slot, count(*) AS weight FROM (
  SELECT {key}, ('0x' || substr(md5(word), 1, 8))::BIGINT % {dims} AS slot
  FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[a-z]+')) AS word FROM {source}))
GROUP BY {key}, slot"""


@compared("SELECT p_name AS \"Title\", p_brand AS \"Artist\", p_type AS \"Subgenre\", p_size || ' units' AS \"Characteristics\" FROM part")
def src_records_json(spark, sf_dir):
    path = new_path(spark, "records-json")
    records.write_records(_part_records(spark, sf_dir), path, 500)
    return records.read_records(spark, path)


def _part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "part").select(
        F.col("p_name").alias("Title"), F.col("p_brand").alias("Artist"), F.col("p_type").alias("Subgenre"),
        F.concat("p_size", F.lit(" units")).alias("Characteristics"),
    )


@compared(f"""WITH r AS (SELECT p_partkey, p_name AS title, p_brand AS artist, p_type AS subgenre,
  p_size || ' units' AS characteristics FROM part),
t AS (SELECT *, title || ' ' || artist || ' ' || subgenre || ' ' || characteristics AS text FROM r),
s AS ({_slots_sql('t', 'p_partkey', 'text', 64)}),
v AS (SELECT p_partkey, sum(weight)::BIGINT AS n_words, sum(weight * weight)::DOUBLE AS squares FROM s GROUP BY p_partkey)
SELECT title, artist, subgenre, characteristics, coalesce(n_words, 0) AS n_words, coalesce(squares, 0) AS squares
FROM r LEFT JOIN v USING (p_partkey)""")
def vec_ingest(spark, sf_dir):
    table = records.replace_table(
        _part_records(spark, sf_dir), new_path(spark, "records"), models.hashed_terms(64)
    )
    vector = F.transform("vector", lambda x: x.cast("double"))
    return table.select(
        "title", "artist", "subgenre", "characteristics",
        F.aggregate(vector, F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("n_words"),
        F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x).alias("squares"),
    )


@compared(f"""WITH r AS (SELECT p_partkey AS id, p_name AS title, p_brand AS artist, p_type AS subgenre,
  p_size || ' units' AS characteristics FROM part),
t AS (SELECT *, title || ' ' || artist || ' ' || subgenre || ' ' || characteristics AS text FROM r),
q AS (SELECT DISTINCT p_type AS query_id, p_type AS text FROM part),
cv AS ({_slots_sql('t', 'id', 'text', 64)}),
qv AS ({_slots_sql('q', 'query_id', 'text', 64)}),
cn AS (SELECT id, sum(weight * weight) AS n FROM cv GROUP BY id),
qn AS (SELECT query_id, sum(weight * weight) AS n FROM qv GROUP BY query_id),
dots AS (SELECT query_id, id, sum(qv.weight * cv.weight) AS dot FROM qv JOIN cv USING (slot) GROUP BY query_id, id),
scored AS (SELECT query_id, id, round(coalesce(dot::DOUBLE / sqrt(qn.n::DOUBLE * cn.n::DOUBLE), 0), 12) AS score
  FROM q CROSS JOIN r LEFT JOIN dots USING (query_id, id) LEFT JOIN qn USING (query_id) LEFT JOIN cn USING (id)),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS n FROM scored)
SELECT query_id, CAST(n AS INTEGER) AS rank, title, artist, subgenre, characteristics, round(score, 6) AS score
FROM best JOIN r USING (id) WHERE n <= 3""")
def vec_text_search(spark, sf_dir):
    fields = ["title", "artist", "subgenre", "characteristics"]
    named = given.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("artist"),
        F.col("p_type").alias("subgenre"), F.concat("p_size", F.lit(" units")).alias("characteristics"),
    )
    stored = rag.embedded(named.withColumn("text", F.concat_ws(" ", *fields)), models.hashed_terms(64)).drop("text")
    questions = given.table(spark, sf_dir, "part").select(F.col("p_type").alias("query_id"), F.col("p_type").alias("text")).distinct()
    found = jobs.text_search(stored, questions, models.hashed_terms(64), fields, k=3)
    return _rounded(found, "score")


@compared(_slots_sql("documents", "doc_id", "text", 128))
def vec_embed(spark, sf_dir):
    vectors_of = rag.embedded(given.documents(spark, sf_dir), models.hashed_terms(128))
    slots = vectors_of.select("doc_id", F.posexplode_outer("vector").alias("slot", "weight"))
    return slots.where(F.col("weight") != 0).select(
        "doc_id", F.col("slot").cast("bigint").alias("slot"), F.col("weight").cast("bigint").alias("weight")
    )


def _vector_query(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All vectors, and as queries every row whose id is divisible by 50."""
    stored = given.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return stored, stored.where(F.col("id") % 50 == 0).select(F.col("id").alias("query_id"), "vector")


@compared("""WITH s AS (SELECT q.vec_id AS query_id, e.vec_id AS id,
    list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS score
  FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0 AND q.vec_id <> e.vec_id)
SELECT query_id, CAST(r AS INTEGER) AS rank, id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) AS r FROM s) WHERE r <= 3""")
def vec_topk(spark, sf_dir):
    found = vectors.nearest(*_vector_query(spark, sf_dir), k=3, exclude_self=True)
    return _rounded(found, "score")


@compared(None)
def vec_topk_lsh(spark, sf_dir):
    """The same questions, answered by the inverted file: approximate."""
    stored, asked = _vector_query(spark, sf_dir)
    return _rounded(cells.search(cells.build(stored), asked, k=3, exclude_self=True), "score")


CHUNKS_SQL = """words AS (SELECT doc_id,
    [x FOR x IN string_split_regex(text, '[ \\t\\n\\r\\f]+') IF x <> ''] AS w FROM documents),
chunks AS (SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, array_to_string(w[i * 150 + 1 : i * 150 + 200], ' ') AS text
  FROM (SELECT doc_id, w, unnest(range(0, CAST(ceil(greatest(len(w) - 200, 0) / 150.0) AS BIGINT) + 1)) AS i
    FROM words WHERE len(w) > 0))"""


@compared(f"""WITH {CHUNKS_SQL} SELECT doc_id, chunk_no,
  CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words, text FROM chunks""")
def rag_chunks(spark, sf_dir):
    return rag.chunks(given.documents(spark, sf_dir))


HISTORY_SQL = """past AS (SELECT conv_id, turn, role, text,
  list(role || ': ' || text) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS h
  FROM conversations)"""


@compared(f"""WITH {HISTORY_SQL} SELECT conv_id, turn, CAST(coalesce(len(h), 0) AS INTEGER) AS n_history,
  coalesce(array_to_string(h, chr(10)), '') AS history FROM past""")
def rag_history(spark, sf_dir):
    remembered = rag.history(given.table(spark, sf_dir, "conversations"), 4)
    lines = F.transform("history", lambda h: F.concat_ws(": ", h["role"], h["text"]))
    return remembered.select(
        "conv_id", "turn", F.size("history").alias("n_history"), F.array_join(lines, "\n").alias("history")
    )


@compared(f"""WITH {CHUNKS_SQL}, {HISTORY_SQL},
ids AS (SELECT doc_id * 1000000 + chunk_no AS id, text FROM chunks),
questions AS (SELECT conv_id || ':' || turn AS query_id, h, text FROM past WHERE role = 'user'),
cv AS ({_slots_sql('ids', 'id', 'text', 64)}),
qv AS ({_slots_sql('questions', 'query_id', 'text', 64)}),
cn AS (SELECT id, sum(weight * weight) AS n FROM cv GROUP BY id),
qn AS (SELECT query_id, sum(weight * weight) AS n FROM qv GROUP BY query_id),
dots AS (SELECT query_id, id, sum(qv.weight * cv.weight) AS dot FROM qv JOIN cv USING (slot) GROUP BY query_id, id),
scored AS (SELECT query_id, id, round(coalesce(dot::DOUBLE / sqrt(qn.n::DOUBLE * cn.n::DOUBLE), 0), 12) AS score
  FROM questions CROSS JOIN ids LEFT JOIN dots USING (query_id, id) LEFT JOIN qn USING (query_id) LEFT JOIN cn USING (id)),
best AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS r FROM scored),
found AS (SELECT query_id, count(*) AS n, string_agg(text, chr(10) ORDER BY r) AS texts
  FROM best JOIN ids USING (id) WHERE r <= 3 GROUP BY query_id)
SELECT query_id, CAST(coalesce(len(h), 0) AS INTEGER) AS n_history, CAST(coalesce(n, 0) AS INTEGER) AS n_retrieved,
  concat_ws(chr(10), CASE WHEN len(h) > 0 THEN array_to_string(h, chr(10)) END, texts, text) AS prompt
FROM questions LEFT JOIN found USING (query_id)""")
def rag_context(spark, sf_dir):
    return jobs.retrieval(
        given.documents(spark, sf_dir), given.table(spark, sf_dir, "conversations"), models.hashed_terms(64)
    )


@compared(None)
def rag_context_index(spark, sf_dir):
    """The same job with the inverted file in place of the exact search: approximate."""
    return jobs.retrieval(
        given.documents(spark, sf_dir), given.table(spark, sf_dir, "conversations"), models.hashed_terms(64), recall=0.95
    )


# ---- fan-out --------------------------------------------------------------

def _short_only(prompt: str) -> str:
    if len(prompt) > 250:
        raise ValueError("prompt too long")
    return str(len(prompt))


MODELS = {"lower": models.BatchModel(lambda prompts: [p.lower() for p in prompts], 16), "length": _short_only}
ANSWERS_SQL = """answers AS (
  SELECT item_id AS prompt_id, 'lower' AS model, lower(text) AS response, NULL AS error FROM benchmark WHERE text <> ''
  UNION ALL SELECT item_id, 'length', CASE WHEN length(text) <= 250 THEN length(text)::VARCHAR END,
    CASE WHEN length(text) > 250 THEN 'Error: prompt too long' END FROM benchmark WHERE text <> '')"""


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("prompt_id"), F.col("text").alias("prompt")
    )


@compared(f"WITH {ANSWERS_SQL} SELECT prompt_id, model, response, error FROM answers")
def model_fanout(spark, sf_dir):
    return models.answers(_prompts(spark, sf_dir), MODELS, concurrency=4)


@compared(f"""WITH {ANSWERS_SQL} SELECT prompt_id,
  max(response) FILTER (model = 'lower') AS lower_response, max(error) FILTER (model = 'lower') AS lower_error,
  max(response) FILTER (model = 'length') AS length_response, max(error) FILTER (model = 'length') AS length_error
FROM answers GROUP BY prompt_id""")
def model_side_by_side(spark, sf_dir):
    return jobs.prompt_fanout(_prompts(spark, sf_dir), MODELS)


# ---- streaming ------------------------------------------------------------

def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = given.table(spark, sf_dir, name).schema
    # as a pattern the path may be a folder of part files or a single file
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


@compared(f"WITH {FETCHES_SQL} SELECT outcome, count(*) AS n FROM outcomes GROUP BY outcome")
def stream_fetch_counts(spark, sf_dir):
    name = f"fetch_counts_{uuid.uuid4().hex}"
    fetches = given.fetches(_stream(spark, sf_dir, "events"))
    fetch_counts.start_running_counts(
        fetches, name, new_path(spark, "stream-state"), available_now=True
    ).awaitTermination()
    return spark.table(name)


@compared("""WITH last AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r,
  count(*) OVER (PARTITION BY conv_id) AS seen FROM conversations)
SELECT conv_id, seen, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS memory
FROM last WHERE r <= 4 GROUP BY conv_id, seen""")
def stream_chat_memory(spark, sf_dir):
    """In two runs on one checkpoint, the second after new turns have come, and read from a snapshot and what came after it."""
    arrived, path, state, snapshots = (new_path(spark, name) for name in ("turns", "chat-memory", "stream-state", "chat-snapshots"))
    turns = given.table(spark, sf_dir, "conversations")
    hour = None
    for half in (0, 1):
        turns.where(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(2)) == half).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(turns.schema).parquet(arrived)
        chat_memory.start_memory(stream, 4, path, state, available_now=True).awaitTermination()
        hour = hour or chat_memory.compact(spark, path, snapshots)
    lines = F.transform("memory", lambda t: F.concat_ws(": ", t["role"], t["text"]))
    current = chat_memory.latest_memory(spark, path, snapshots, hour)
    return current.select("conv_id", "seen", F.array_join(lines, "\n").alias("memory"))


# the statistic shares its name with the streaming module
QUERIES["fetch_counts"] = QUERIES.pop("fetch_counts_")
ORACLES["fetch_counts"] = ORACLES.pop("fetch_counts_")
