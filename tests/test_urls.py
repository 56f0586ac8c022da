import random
from urllib.parse import unquote, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from searchloom.functions import html, urls

NORMALIZED = [
    ("https://www.example.com/a/", "example.com/a"),
    ("https://WWW.Example.com/A/", "WWW.Example.com/A"),
    ("https://www.www.x.com/", "www.x.com"),
    ("www.example.com/a/", "www.example.com/a"),
    ("https://example.com/a;p=1?q=2#f", "example.com/a?q=2"),
    ("https://example.com/a//", "example.com/a"),
    ("https://example.com/a b|c", "example.com/a b|c"),
    ("host:8080/a", "8080/a"),
    ("", ""),
    (None, ""),
]
RESOLVED = [
    ("../x", "https://www.s.com/x"),
    ("?q=1", "https://www.s.com/a/b?q=1"),
    ("#f", "https://www.s.com/a/b#f"),
    ("//cdn.x/y", "https://cdn.x/y"),
    ("tel:123", "tel:123"),
    ("mailto:a@b", "mailto:a@b"),
    ("/tel:123", "https://www.s.com/tel:123"),
    ("x/./y/..", "https://www.s.com/a/x/"),
    ("../../../z", "https://www.s.com/z"),
    ("HTTPS://Other.com/Q", "https://Other.com/Q"),
    ("", "https://www.s.com/a/b"),
]
VALID = [
    ("https://www.s.com/x", True),
    ("https://s.com/x", False),
    ("https://blog.s.com/x", False),
    ("https://notwww.s.com/x", True),
    ("https://www.s.com/a.JSON", False),
    ("https://www.s.com/tel:123", False),
    ("tel:123", False),
    ("https://www.s.com/a.json/b", True),
    ("https://www.s.com/a.xml?x=1", False),
]


def column_of(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_normalize(spark):
    assert column_of(spark, [a for a, _ in NORMALIZED], urls.normalize) == [b for _, b in NORMALIZED]


def test_resolve(spark):
    base = F.lit("https://www.s.com/a/b")
    got = column_of(spark, [a for a, _ in RESOLVED], lambda h: urls.resolve(base, h))
    assert got == [b for _, b in RESOLVED]


def test_valid(spark):
    got = column_of(spark, [a for a, _ in VALID], lambda u: urls.is_valid_link(u, "www.s.com"))
    assert got == [b for _, b in VALID]


def test_unwrap_redirect(spark):
    cases = [
        ("https://duckduckgo.com/l/?uddg=https%3A%2F%2Fa.com%2Fx%2By%3Fq&rut=1", "https://a.com/x+y?q"),
        ("/l/?uddg=http%3A%2F%2Fb.com", "http://b.com"),
        ("//duckduckgo.com/l/?uddg=http%3A%2F%2Fb.com", "https://duckduckgo.com//duckduckgo.com/l/?uddg=http%3A%2F%2Fb.com"),
        ("https://duckduckgo.com/l?uddg=x", "https://duckduckgo.com/l?uddg=x"),
        ("https://duckduckgo.com/l/?uddg=one&uddg=two%zz", "two%zz"),
        ("https://c.com/l/?uddg=x", "https://c.com/l/?uddg=x"),
    ]
    assert column_of(spark, [a for a, _ in cases], urls.unwrap_redirect) == [b for _, b in cases]


PIECES = (
    "http", "https", "http://", "https://s.com/", "/a", "/b/", "ftp", "mailto", "tel", ":", "/", "//", "?", "#",
    ";", ".", "..", "./", "../", "a", "b.c", "www.", "www.s.com", "x y", "%20", "=", "&", "é", "index.html", "|",
    "\t", "+", "-",
)


def safe(function, *args):
    try:
        return function(*args)
    except ValueError:
        return None


@pytest.mark.parametrize("seed", [1, 2])
def test_columns_agree_with_the_standard_library(spark, seed):
    rng = random.Random(seed)

    def some_url():
        return "".join(rng.choices(PIECES, k=rng.randint(0, 9)))

    pairs = [(some_url(), some_url()) for _ in range(4000)]
    df = spark.createDataFrame(
        [(i, b, h) for i, (b, h) in enumerate(pairs)], "i int, base string, href string"
    ).select(
        "base", "href",
        urls.resolve(F.col("base"), F.col("href")).alias("joined"),
        urls.netloc(F.col("href")).alias("netloc"),
        urls.normalize(F.col("href")).alias("normal"),
        urls.percent_decode(F.col("href")).alias("decoded"),
    )
    for row in df.collect():
        parts = safe(urlparse, row.href)
        if parts is None or safe(urlparse, row.base) is None:
            continue
        joined = safe(urljoin, row.base, row.href)
        assert row.joined == joined, (row.base, row.href)
        assert row.netloc == parts.netloc
        assert row.decoded == unquote(row.href)
        host = parts.netloc[4:] if parts.netloc.startswith("www.") else parts.netloc
        assert row.normal == host + parts.path.rstrip("/") + (f"?{parts.query}" if parts.query else "")


def test_anchors(spark):
    page = (
        "<a href='/one'>1</a><!-- <a href=\"/no\"> --><script>x='<a href=\"/no\">'</script>"
        "<A class=x HREF=/two>2</A><a name=n>none</a><a title=\"see href=/no\" href=\"/three?a=1&amp;b=2\">"
        "<abbr href=/no>x</abbr><a\nhref = \"/four&#x2F;&#233;&amp;lt;&bogus;\" data-href='/no'><a href=''>"
        "<img alt='<a href=/no>'><a href=\"/five>5\">"
    )
    got = column_of(spark, [page], html.anchor_hrefs)[0]
    assert got == ["/one", "/two", "/three?a=1&b=2", "/four//é&lt;&bogus;".replace("//", "/"), "/five>5"]
    # the tag-tree parser sees the same links
    df = spark.createDataFrame([(1, page)], "id int, html string")
    rows = html.selected_hrefs(df, "id", "html", ["a"]).orderBy("pos").collect()
    assert [r.href for r in rows] == got


ODD_MARKUP = [
    "<!-- x <a href=/1>", "<script> <a href=/1>", "<textarea><a href=/1></textarea><a href=/2>",
    "<![CDATA[ <a href=/1> ]]><a href=/2>", "<style><a href=/1></script></style ><a href=/2>", "<!--><a href=/1>-->",
    "<a href=/1/>", '<a href="/1"/>', "<a href='/1'title=x>", "<a\x0chref=/1>", "<a/href=/1>", "</a href=/1>",
    "<a href=/x title=t href='/y'>", "<a href=/1", "<a href>x</a>", "<abbr href=/1>", "<a HREF = '/a\"b'>", "",
]


def test_odd_markup_gives_the_parser_s_anchors(spark):
    native = column_of(spark, ODD_MARKUP, html.anchor_hrefs)
    for page, links in zip(ODD_MARKUP, native):
        parser = html._SelectorMatcher(["a"])
        parser.feed(page)
        parser.close()
        assert links == parser.found[0], page


def test_very_long_tags(spark):
    many = " ".join(f"data-{i}='{i}'" for i in range(30_000))
    page = f"<p {many}>x</p><a {many} href=/deep>y</a><!--{'-' * 300_000}--><a = ' \" href='/end'>z</a>" + "<" * 100_000
    assert column_of(spark, [page], html.anchor_hrefs)[0][:1] == ["/deep"]


def test_numeric_references_out_of_range(spark):
    got = column_of(spark, ["a&#0;b&#xD800;c&#99999999999999999999;d&#65e"], html.unescape)[0]
    assert got == "a�b�c�dAe"


def test_selectors(spark):
    page = (
        '<div class="result__body x"><h2><a class="result__a" href="/1">t</a></h2><br></div>'
        '<div class="other"><a class="result__a" href="/2">t</a></div>'
        '<article class="result"><p><h2><a href="/3">t</a></h2></article><a href="/4">t</a>'
    )
    df = spark.createDataFrame([("q", page), ("empty", None)], "id string, html string")
    rows = html.selected_hrefs(
        df, "id", "html", ["div.result__body a.result__a", "a.result__a", "article.result h2 a"]
    ).collect()
    assert sorted((r.selector_no, r.pos, r.href) for r in rows) == [
        (0, 0, "/1"), (1, 0, "/1"), (1, 1, "/2"), (2, 0, "/3"),
    ]


@pytest.mark.parametrize("table", ["/root/testdata/sf0.001/pages.parquet"])
def test_stored_pages_give_the_parser_s_anchors(spark, table):
    pages = spark.read.parquet(table)
    native = pages.select("page_id", F.posexplode(html.anchor_hrefs(F.col("html"))).alias("pos", "href"))
    parsed = html.selected_hrefs(pages, "page_id", "html", ["a"]).select("page_id", "pos", "href")
    assert native.exceptAll(parsed).count() == 0
    assert parsed.exceptAll(native).count() == 0
