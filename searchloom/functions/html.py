"""Anchors of stored HTML pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html import unescape as unescape_text
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Loops are possessive: they do not recurse, and what one alternative has read no other reads again, so a page is read
# once however it is written. A tag that never ends takes the rest of the page.
_VALUE = r"""\s*+=++\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""  # a quote opens a value only where one is expected
_TAG_REST = r"(?:\s++|/(?!>)|[^\s/>][^\s/=>]*+(?:" + _VALUE + ")?+)*+"
# One pass over the page; only the opening <a ...> alternative fills group 2.
_MARKUP = (
    r"(?is)<(?:!--.*?(?:--\s*>|\z)"
    r"|!\[(?:cdata|temp|ignore|include|rcdata)\b.*?(?:\]\s*\]\s*>|\z)|!\[(?:if|else|endif)\b.*?(?:\]\s*>|\z)"
    r"|[/!?][^>]*+(?:>|\z)"
    r"|(script|style)(?=[\s/>])" + _TAG_REST + r"(?:/>|>.*?(?:</\s*\1\s*>|\z)|\z)"
    r"|a(?=[\s/>])(" + _TAG_REST + ")/?>"
    r"|[a-z][^\s/>]*+" + _TAG_REST + r"(?:/?>|\z))"
)
_CLOSED_VALUE = r"""("[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)"""
# group 1 is the value of the last href, with its quotes; a value whose quote stays open spoils the whole tag
_HREF = (
    r"(?is)\A(?:(?:[\s/]++|(?!href(?:[\s/=]|\z))[^\s/>][^\s/=>]*+(?:\s*+=++\s*+" + _CLOSED_VALUE.replace("(", "(?:", 1) + ")?+)*+"
    r"href(?:\s*+=++\s*+|(?=[\s/])|\z)" + _CLOSED_VALUE + ")++"
    r"(?:[\s/]++|(?!href(?:[\s/=]|\z))[^\s/>][^\s/=>]*+(?:\s*+=++\s*+" + _CLOSED_VALUE.replace("(", "(?:", 1) + r")?+)*+\z"
)

_HEX_REFERENCE = r"\A#[xX]([0-9a-fA-F]+);?"
_DECIMAL_REFERENCE = r"\A#([0-9]+);?"
_NAME = r"\A([^\t\n\f <&#;]{1,32};?)"
# The standard's names of characters; some of them also count without a semicolon, and then as a beginning of a word.
_OPEN_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
_OPEN = {name: html5[name] for name in _OPEN_NAMES}
_CLOSED_NAMES = {name: text for name, text in html5.items() if name.endswith(";")}
_OPEN_NAME = r"\A(" + "|".join(_OPEN_NAMES) + ")"
# Numbers that don't stand for the character of that number.
_OTHER_NUMBERS = {
    str(n): unescape_text(f"&#{n};")
    for n in (*range(160), *range(0xFDD0, 0xFDF0), *(plane + last for plane in range(0, 0x110000, 0x10000) for last in (0xFFFE, 0xFFFF)))
    if unescape_text(f"&#{n};") != chr(n)
}


def _lookup(table: dict[str, str], key: Column) -> Column:
    """A table's value, null where it has none; both sides of the table are one literal each."""
    keys, values = (F.split(F.lit("\x01".join(side)), "\x01") for side in (table.keys(), (f"={v}" for v in table.values())))
    return F.substr(F.try_element_at(F.map_from_arrays(keys, values), key), F.lit(2))


def _character(number: Column) -> Column:
    """The character of a number given in decimal digits without leading zeros."""
    code = number.try_cast("bigint")
    usable = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    plain = F.when(usable, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")
    special = (code < 160) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    return F.when(special, F.coalesce(_lookup(_OTHER_NUMBERS, number), plain)).otherwise(plain)


def unescape(text: Column) -> Column:
    """Decode character references as ``html.unescape`` does, in one pass."""

    def number(digits: Column) -> Column:
        return F.when(F.ltrim(digits, F.lit("0")) == "", "0").otherwise(F.ltrim(digits, F.lit("0")))

    def decode(piece: Column) -> Column:
        hexadecimal = F.regexp_extract(piece, _HEX_REFERENCE, 1)
        decimal = F.regexp_extract(piece, _DECIMAL_REFERENCE, 1)
        from_hex = F.when(F.length(F.ltrim(hexadecimal, F.lit("0"))) <= 8, F.conv(hexadecimal, 16, 10)).otherwise("4294967295")
        name, open_name = F.regexp_extract(piece, _NAME, 1), F.regexp_extract(piece, _OPEN_NAME, 1)
        named = F.when(name.endswith(";"), _lookup(_CLOSED_NAMES, name))
        return (
            F.when(piece.startswith("amp;"), F.concat(F.lit("&"), F.substr(piece, F.lit(5))))
            .when(hexadecimal != "", F.concat(_character(from_hex), F.regexp_replace(piece, _HEX_REFERENCE, "")))
            .when(decimal != "", F.concat(_character(number(decimal)), F.regexp_replace(piece, _DECIMAL_REFERENCE, "")))
            .when(named.isNotNull(), F.concat(named, F.substr(piece, F.length(name) + 1)))
            .when(open_name != "", F.concat(_lookup(_OPEN, open_name), F.substr(piece, F.length(open_name) + 1)))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    pieces = F.split(text, "&")
    decoded = F.concat(
        F.slice(pieces, 1, 1), F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decode)
    )
    return F.when(text.contains("&"), F.array_join(decoded, "")).otherwise(text)


def anchor_hrefs(html: Column) -> Column:
    """Non-empty ``href`` values of all ``<a>`` tags, in document order.

    Comments, scripts and styles are skipped. The whole page is read by one
    regular expression inside the JVM; no row leaves for a Python worker.
    """
    attributes = F.filter(
        F.regexp_extract_all(html, F.lit(_MARKUP), F.lit(2)), lambda a: a.ilike("%href%")
    )
    written = F.transform(attributes, lambda a: F.regexp_extract(a, _HREF, 1))
    values = F.transform(written, lambda v: unescape(F.regexp_replace(v, r"""(?s)\A(["'])(.*)\1\z""", "$2")))
    return F.filter(values, lambda v: v != "")


_NEVER_CLOSED = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


class _SelectorMatcher(HTMLParser):
    """Collects the links that each ``tag.class tag.class`` selector finds in a page.

    Every open tag carries, per selector, how many of its steps (but the last) the tags around it fulfil in order; a link
    looks at its parent's counts only. Open tags are also listed by name, so an end tag finds its own at once.
    """

    def __init__(self, selectors: Sequence[str]):
        super().__init__(convert_charrefs=True)
        self.selectors = [[(step.split(".")[0], frozenset(step.split(".")[1:])) for step in s.split()] for s in selectors]
        self.open_tags: list[tuple[str, tuple[int, ...]]] = []
        self.places: dict[str, list[int]] = {}
        self.found: list[list[str]] = [[] for _ in selectors]
        self.no_more_comments = False

    @staticmethod
    def _fits(tag: str, classes: frozenset[str], step: tuple[str, frozenset[str]]) -> bool:
        return (not step[0] or tag == step[0]) and classes >= step[1]

    def read(self, page: str) -> list[list[str]]:
        self.feed(page[: page.rfind(">") + 1])  # no tag ends behind that
        self.close()
        return self.found

    def parse_comment(self, i, report=1):
        end = -1 if self.no_more_comments else super().parse_comment(i, report)
        self.no_more_comments = end < 0  # then none that begins later ends either
        return end

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # of no known kind
            return self.parse_bogus_comment(i)

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        classes = frozenset((attributes.get("class") or "").split())
        href = attributes.get("href")
        fulfilled = self.open_tags[-1][1] if self.open_tags else (0,) * len(self.selectors)
        if href:
            for steps, done, links in zip(self.selectors, fulfilled, self.found, strict=True):
                if done == len(steps) - 1 and self._fits(tag, classes, steps[-1]):
                    links.append(href)
        if tag not in _NEVER_CLOSED:
            counts = tuple(
                done + (done < len(steps) - 1 and self._fits(tag, classes, steps[done]))
                for steps, done in zip(self.selectors, fulfilled, strict=True)
            )
            self.places.setdefault(tag, []).append(len(self.open_tags))
            self.open_tags.append((tag, counts))

    def handle_endtag(self, tag):
        if self.places.get(tag):
            depth = self.places[tag][-1]
            while len(self.open_tags) > depth:
                self.places[self.open_tags.pop()[0]].pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _NEVER_CLOSED:
            self.handle_endtag(tag)


def selected_hrefs(
    pages: DataFrame, key: str, html: str, selectors: Sequence[str]
) -> DataFrame:
    """``(key, selector_no, pos, href)`` for every link a CSS selector finds.

    Selectors look at the ancestors of a link, which needs the tag tree, so the
    pages go through the standard HTML parser in Arrow batches; no shuffle.
    """
    key_type = pages.schema[key].dataType.simpleString()
    wanted = list(selectors)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page_key, page in zip(batch[key], batch[html]):
                for number, links in enumerate(_SelectorMatcher(wanted).read(page or "")):
                    rows.extend((page_key, number, at, link) for at, link in enumerate(links))
            yield pd.DataFrame(rows, columns=[key, "selector_no", "pos", "href"])

    return pages.select(key, html).mapInPandas(
        parse, f"{key} {key_type}, selector_no int, pos int, href string"
    )
