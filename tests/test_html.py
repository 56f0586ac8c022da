"""HTML functions against the standard library's parser, and their time on pages that are made to be slow."""

import random
import re
import time
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from searchloom.functions import html
from test_urls import column_of

PIECES = [
    "<a href=", "<a ", "<A HREF = ", "href=", "'", '"', "/x", "/y?a=1&copy=2", "&amp;", "&eacute;", "&#233", "&ampx", ">", "/>", " ", "\n",
    "<b>", "</b>", "</a>", "<div class=r>", "</div>", "<script>", "</script>", "<style/>", "<!-- c -->", "<!doctype html>", "<?p q?>", "</ x>",
    "title=t ", "=", "text", "<", "<1>", "<a>", "<a/>", "<a href>", "<ab href=/n>", "<img src=a>", "<![CDATA[ <a href=/c> ]]>",
]


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.hrefs = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href"):
            self.hrefs.append(dict(attrs)["href"])


def parsed(page):
    parser = Plain()
    parser.feed(page)
    parser.close()
    return parser.hrefs


def whole(page):
    """Comments end, and behind the last bare ``>`` no tag begins: elsewhere the HTML standard is followed, not this parser."""
    return page + "'\"><p>-->]]>"


def test_anchors_are_those_of_the_parser(spark):
    dice = random.Random(11)
    pages = [whole("".join(dice.choices(PIECES, k=dice.randrange(1, 14)))) for _ in range(6000)]
    pages = [page for page in pages if not re.search(r"=\s*=", page)]  # of an open quote behind two, the parser makes a value
    native = column_of(spark, pages, html.anchor_hrefs)
    wrong = [(page, links, parsed(page)) for page, links in zip(pages, native, strict=True) if links != parsed(page)]
    assert not wrong, wrong[:5]


def test_selected_links_are_those_of_a_plain_search(spark):
    """Against a search among all open tags for each link."""

    class Slow(HTMLParser):
        def __init__(self, steps):
            super().__init__()
            self.steps, self.open, self.found = [s.split(".") for s in steps.split()], [], []

        def fits(self, element, step):
            return (not step[0] or element[0] == step[0]) and set(step[1:]) <= set(element[1])

        def handle_starttag(self, tag, attrs):
            found = dict(attrs)
            element = (tag, (found.get("class") or "").split())
            if found.get("href") and self.fits(element, self.steps[-1]):
                around = iter(self.open)
                if all(any(self.fits(e, s) for e in around) for s in self.steps[:-1]):
                    self.found.append(found["href"])
            if tag != "br":
                self.open.append(element)

        def handle_endtag(self, tag):
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    del self.open[k:]
                    return

    dice, tags = random.Random(5), ["<div class='r s'>", "<div>", "<p class=r>", "</div>", "</p>", "<br>", "<h2>", "</h2>", "<a class=x href=/{}>t</a>"]
    selectors = ["div.r a.x", "div p.r a", ".r .r a", "h2 div a", "a"]
    for _ in range(400):
        page = "".join(t.format(k) for k, t in enumerate(dice.choices(tags, k=dice.randrange(1, 40))))
        found = html._SelectorMatcher(selectors).read(page)
        for steps, links in zip(selectors, found, strict=True):
            slow = Slow(steps)
            slow.feed(page)
            slow.close()
            assert links == slow.found, (page, steps)


def test_references_are_those_of_the_standard_library(spark):
    dice = random.Random(7)
    names = list(html5)
    texts = [f"x&{name}y&{name}" for name in names] + [f"&{name[:-1]}=2&{name[:-1]}" for name in names if name.endswith(";")]
    texts += [f"&#{n};&#x{n:x}&#{n}z" for n in (*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFE, 0x1FFFF, 0x10FFFF, 0x110000)]
    parts = ["&", "#", "x", "4", "0", "amp", ";", "not", "in", "it;", "&lt", " ", "\n", "a" * 40, "&#x0000000041;", "&#99999999999999999999", "É"]
    texts += ["".join(dice.choices(parts, k=dice.randrange(1, 9))) for _ in range(3000)]
    got = column_of(spark, texts, html.unescape)
    wrong = [(t, g, unescape(t)) for t, g in zip(texts, got, strict=True) if g != unescape(t)]
    assert not wrong, wrong[:5]


HOSTILE = {
    "unended tags": "<a ", "open quotes": "<a x=\"<a y='", "quoted ends": '<a x=">" ', "unended comments": "<!--x>", "unended sections": "<![if x>",
    "unknown sections": "<![foo x>", "equals": "<a ====", "scripts": "<script>", "slashes": "<a/////", "bare": "<", "declarations": "<!x",
}


def seconds(action):
    times = []
    for _ in range(3):
        began = time.perf_counter()
        action()
        times.append(time.perf_counter() - began)
    return min(times)


@pytest.mark.parametrize("kind", HOSTILE)
def test_hostile_pages_take_time_in_proportion(spark, kind):
    def native(n):
        page = spark.createDataFrame([(HOSTILE[kind] * n + "<a href=/end>",)], "html string").coalesce(1)
        return seconds(lambda: page.select(F.size(html.anchor_hrefs(F.col("html")))).collect())

    native(10)
    short, long = native(20_000), native(80_000)
    assert long < 0.5 + 8 * short  # 16 times if quadratic
    assert long < 5


@pytest.mark.parametrize("page", ["<div class=r>", "<a ", "<!--x>", "</p>", "<p></div>", "<a href=/x>", "<a x=\""])
def test_hostile_pages_and_selectors(page):
    def read(n):
        return seconds(lambda: html._SelectorMatcher(["div.r p a", "a"]).read("<div>" * n + page * n + "<a href=/end>"))

    assert read(40_000) < 0.3 + 7 * read(10_000)
