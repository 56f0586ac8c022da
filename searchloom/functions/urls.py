"""URL handling as Column expressions.

The expressions follow Python's ``urllib.parse`` rather than SQL ``parse_url``,
which rejects blanks and other characters that real links contain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchloom import fixed_values as fixed

# scheme, netloc, path, query, fragment (the generic URI pattern of RFC 3986)
_SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
# the same in one match for addresses without ";": host without "www.", path without
# closing slashes, query
_SHORT_FORM = (
    r"(?s)\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://(?:www\.)?([^/?#]*))?([^?#]*?)/*(\?[^#]+)?\??(?:#.*)?\z"
)
# links that need no splitting: plain addresses, and plain paths from the root
_PLAIN_ADDRESS = r"\Ahttps?://[^/\x00-\x20?#;][^\x00-\x20?#;]*(?:\?[^\x00-\x20#]+)?\z"
_PLAIN_PATH = r"\A/(?!/)[^\x00-\x20?#;]*(?:\?[^\x00-\x20#]+)?\z"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once and written once in the plan."""
    return F.transform(F.array(value), body)[0]


def clean(url: Column) -> Column:
    """Drop leading control characters and blanks, and line breaks and tabs anywhere."""
    dirty = url.rlike(r"^[\x00-\x20]|[\t\r\n]")
    return F.when(dirty, F.regexp_replace(url, r"\A[\x00-\x20]+|[\t\r\n]", "")).otherwise(url)


def split_url(url: Column) -> Column:
    """Struct of scheme, netloc, path, params, query and fragment."""

    def generic(text: Column) -> Column:
        return F.struct(
            F.lower(F.regexp_extract(text, _SPLIT, 1)).alias("scheme"),
            F.regexp_extract(text, _SPLIT, 2).alias("netloc"),
            F.regexp_extract(text, _SPLIT, 3).alias("path"),
            F.regexp_extract(text, _SPLIT, 4).alias("query"),
            F.regexp_extract(text, _SPLIT, 5).alias("fragment"),
        )

    def with_params(u: Column) -> Column:
        path = u["path"]
        has_params = path.contains(";") & u["scheme"].isin(*fixed.SCHEMES_WITH_PARAMS)
        return F.struct(
            u["scheme"].alias("scheme"),
            u["netloc"].alias("netloc"),
            F.when(has_params, F.regexp_replace(path, r"(?s);[^/]*\z", "")).otherwise(path).alias("path"),
            F.when(has_params, F.regexp_extract(path, r"(?s);([^/]*)\z", 1)).otherwise("").alias("params"),
            u["query"].alias("query"),
            u["fragment"].alias("fragment"),
        )

    return _let(_let(clean(url), generic), with_params)


def netloc(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(clean(url), _SPLIT, 2), F.lit(""))


def normalize(url: Column) -> Column:
    """Host without one leading ``www.``, path without closing slashes, and the query.

    Scheme, ``;params`` and fragment go; letter case stays; null gives ``''``.
    """

    def split_form(u: Column) -> Column:
        return F.concat(
            F.regexp_replace(u["netloc"], r"\Awww\.", ""),
            F.rtrim(u["path"], F.lit("/")),
            F.when(u["query"] != "", F.concat(F.lit("?"), u["query"])).otherwise(""),
        )

    def short_form(text: Column) -> Column:
        return F.when(text.contains(";"), _let(split_url(text), split_form)).otherwise(
            F.regexp_replace(text, _SHORT_FORM, "$1$2$3")
        )

    return F.coalesce(_let(clean(url), short_form), F.lit(""))


def percent_decode(text: Column) -> Column:
    """Decode ``%xx``; a ``+`` stays a plus and a stray ``%`` stays as it is."""
    guarded = F.replace(
        F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B")
    )
    return F.when(text.contains("%"), F.try_url_decode(guarded)).otherwise(text)


def unwrap_redirect(
    link: Column,
    host: str = fixed.REDIRECT_HOST,
    path: str = fixed.REDIRECT_PATH,
    parameter: str = fixed.REDIRECT_PARAMETER,
) -> Column:
    """Give a link of a result page its host, and follow the engine's redirect link."""
    absolute = F.when(link.startswith("/"), F.concat(F.lit(f"https://{host}"), link)).otherwise(link)

    def follow(absolute: Column) -> Column:
        def target(u: Column) -> Column:
            value = F.substring_index(F.substring_index(u["query"], parameter, -1), "&", 1)
            wrapped = (u["netloc"] == host) & (u["path"] == path)
            return F.when(wrapped, percent_decode(value)).otherwise(absolute)

        return F.when(absolute.contains(host), _let(split_url(absolute), target)).otherwise(absolute)

    return _let(absolute, follow)


def _joined(u: Column, fragment: Column) -> Column:
    def address(tail: Column) -> Column:
        rooted = (tail == "") | tail.startswith("/")
        return (
            F.when(
                u["netloc"] != "",
                F.concat(F.lit("//"), u["netloc"], F.when(rooted, "").otherwise("/"), tail),
            )
            .when(tail.startswith("//") | ((u["scheme"] != "") & rooted), F.concat(F.lit("//"), tail))
            .otherwise(tail)
        )

    def after(mark: str, part: Column) -> Column:
        return F.when(part != "", F.concat(F.lit(mark), part)).otherwise("")

    return F.concat(
        F.when(u["scheme"] != "", F.concat(u["scheme"], F.lit(":"))).otherwise(""),
        _let(F.concat(u["path"], after(";", u["params"])), address),
        after("?", u["query"]),
        after("#", fragment),
    )


def _without_dot_segments(path: Column) -> Column:
    def step(kept: Column, segment: Column) -> Column:
        return (
            F.when(segment == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
            .when(segment == ".", kept)
            .otherwise(F.array_append(kept, segment))
        )

    def collapsed(segments: Column) -> Column:
        kept = F.aggregate(segments, F.array().cast("array<string>"), step)
        ends_in_folder = F.element_at(segments, -1).isin(".", "..")
        return F.array_join(
            F.concat(kept, F.when(ends_in_folder, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))),
            "/",
        )

    dotted = path.rlike(r"(?:\A|/)\.\.?(?:/|\z)")
    return F.when(dotted, _let(F.split(path, "/"), collapsed)).otherwise(path)


def resolve(base: Column, href: Column) -> Column:
    """The absolute form of ``href`` found on the page ``base``."""
    return _let(split_url(base), lambda parts: resolve_parts(base, parts, href))


def resolve_parts(base_url: Column, base: Column, href: Column) -> Column:
    """As :func:`resolve`, with the page URL already split (once per page, not per link)."""

    def target(scheme, host, path, params, query) -> Column:
        return F.struct(
            scheme.alias("scheme"), host.alias("netloc"), path.alias("path"),
            params.alias("params"), query.alias("query"),
        )

    def against_page(link: Column) -> Column:
        foreign = (
            (link["scheme"] != "") & (link["scheme"] != base["scheme"])
        ) | ~base["scheme"].isin(*fixed.SCHEMES_WITH_RELATIVE_LINKS)
        folder = F.when(base["path"] == "", F.lit("/")).otherwise(
            F.regexp_replace(base["path"], r"(?s)[^/]*\z", "")
        )
        path = _let(
            F.when(link["path"].startswith("/"), link["path"]).otherwise(
                F.regexp_replace(F.concat(folder, link["path"]), "/+", "/")
            ),
            _without_dot_segments,
        )
        same_page = (link["path"] == "") & (link["params"] == "")
        chosen = (
            F.when(
                link["netloc"] != "",
                target(base["scheme"], link["netloc"], link["path"], link["params"], link["query"]),
            )
            .when(
                same_page,
                target(
                    base["scheme"], base["netloc"], base["path"], base["params"],
                    F.when(link["query"] != "", link["query"]).otherwise(base["query"]),
                ),
            )
            .otherwise(
                target(
                    base["scheme"], base["netloc"],
                    _let(path, lambda p: F.when(p == "", F.lit("/")).otherwise(p)),
                    link["params"], link["query"],
                )
            )
        )
        return F.when(foreign, href).otherwise(
            _let(chosen, lambda u: _joined(u, link["fragment"]))
        )

    origin = F.concat(
        F.when(base["scheme"] != "", F.concat(base["scheme"], F.lit(":"))).otherwise(""),
        F.lit("//"), base["netloc"],
    )
    from_root = (
        (base["netloc"] != "")
        & base["scheme"].isin(*fixed.SCHEMES_WITH_RELATIVE_LINKS)
        & href.rlike(_PLAIN_PATH)
        & ~href.contains("/.")
    )
    return (
        F.when((F.coalesce(base_url, F.lit("")) == "") | href.rlike(_PLAIN_ADDRESS), href)
        .when(href == "", base_url)
        .when(from_root, F.concat(origin, href))
        .otherwise(_let(split_url(href), against_page))
    )


def is_valid_link(url: Column, seed_netloc: str) -> Column:
    """Worth crawling: host ends with the seed's, no ``/tel:``, no excluded extension."""

    def good_path(path: Column) -> Column:
        extension = F.substring_index(F.lower(path), ".", -1)
        return ~path.contains("/tel:") & ~extension.isin(*fixed.EXCLUDED_EXTENSIONS)

    def crawlable(text: Column) -> Column:
        host = F.regexp_extract(text, _SPLIT, 2)
        path = F.when(text.contains(";"), split_url(text)["path"]).otherwise(
            F.regexp_extract(text, _SPLIT, 3)
        )
        return _let(host, lambda h: (h != "") & h.endswith(seed_netloc)) & _let(path, good_path)

    return F.coalesce(_let(clean(url), crawlable), F.lit(False))
