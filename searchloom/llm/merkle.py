"""Document fingerprints: a Merkle tree over clauses, paragraphs and sections, in column expressions only.

* A paragraph is a line. Its leaves are clauses: they end, inside the line, after white space that follows a mark
  or one of a few letters, so where they end depends on the text around and not on what was cut before.
* A section is a run of paragraphs; it ends at each paragraph whose hash begins with 0 to 3, again by content.
* Each node hashes its children (SHA-256), the leaves hash their text, and the root all sections. White space
  belongs to the leaves, so roots are equal if, and only if, texts are.

A fingerprint is text: ``root|section ...|paragraph:leaf,leaf;paragraph:...``, nodes below the root cut to 32 bits.
``likeness`` compares leaves (Dice coefficient of their sets); ``differing_paragraphs`` goes down only where
sections differ.

Defined cases: null text is empty text, which has one empty leaf; rows with a null id come first in the
order of ids, rows with equal ids are ordered by text; a single document is its own next one; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF_END = r"(\s(?<=(?:[^\p{L}\p{N}\s]|[gGyYzZ])\s)\s*)(?=\S)"  # looks back at white space only
WORDS_IN_LEAF = r"((?:\S+\s+){8})(?=\S)"
SHOWN = 8  # hex digits of a node below the root
ROWS_PER_GROUP = 512
MOST_GROUPS = 65_536
CUTS_TOGETHER = 256
GROUPS_TOGETHER = 1024


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hash(value: Column) -> Column:
    return F.sha2(value, 256)


def _shown(value: Column) -> Column:
    return F.substring(value, 1, SHOWN)


def leaves(paragraph: Column) -> Column:
    """Hashes of a paragraph's clauses; one without an end of clause is cut after each eighth word."""
    cut = _let(
        F.regexp_replace(paragraph, LEAF_END, "$1\n"),
        lambda c: F.when(F.contains(c, F.lit("\n")), c).otherwise(F.regexp_replace(c, WORDS_IN_LEAF, "$1\n")),
    )
    return F.transform(F.split(cut, "\n"), _hash)


def tree(text: Column) -> Column:
    """The paragraphs of a text as structs of ``hash`` and ``leaves`` (hashes)."""
    below = F.transform(F.split(text, "\n"), leaves)
    return F.transform(below, lambda x: F.struct(_hash(F.array_join(x, "")).alias("hash"), F.transform(x, _shown).alias("leaves")))


def fingerprint(text: Column) -> Column:
    """A text's fingerprint."""

    def of_tree(paragraphs: Column) -> Column:
        marked = F.array_join(
            F.transform(paragraphs, lambda p: F.concat(p["hash"], F.when(F.substring(p["hash"], 1, 1) < "4", " ").otherwise(""))), ""
        )
        shown = F.transform(
            paragraphs, lambda p: F.concat(_shown(p["hash"]), F.lit(":"), F.array_join(p["leaves"], ","))
        )
        top = _let(
            F.transform(F.split(F.rtrim(marked), " "), _hash),
            lambda x: F.concat_ws("|", _hash(F.array_join(x, "")), F.array_join(F.transform(x, _shown), " ")),
        )
        return F.concat_ws("|", top, F.array_join(shown, ";"))

    return _let(tree(text), of_tree)


def leaf_set(print_: Column) -> Column:
    """The different leaves that a fingerprint holds."""
    below = F.regexp_replace(F.substring_index(print_, "|", -1), "[0-9a-f]+:", "")
    return F.array_distinct(F.split(below, "[,;]"))


def likeness(one: Column, other: Column, leaves_one: Column, leaves_other: Column) -> Column:
    """Dice coefficient of two fingerprints' leaves; 1 exactly for equal fingerprints and for those with equal leaves."""
    shared = F.size(F.array_intersect(leaves_one, leaves_other))
    return F.when(one == other, F.lit(1.0)).otherwise(
        2.0 * shared / (F.size(leaves_one) + F.size(leaves_other))
    ).cast("double")


def differing_paragraphs(one: Column, other: Column) -> Column:
    """Paragraph hashes of ``one`` that ``other`` lacks; equal roots are not looked into."""

    def hashes(print_: Column) -> Column:
        return F.transform(F.split(F.substring_index(print_, "|", -1), ";"), lambda p: F.substring_index(p, ":", 1))

    return F.when(
        F.substring_index(one, "|", 1) == F.substring_index(other, "|", 1), F.array().cast("array<string>")
    ).otherwise(F.array_except(hashes(one), hashes(other)))


def _cuts(docs: DataFrame, order: str, groups: int, null_groups: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Where the rows are cut in groups: pairs (id, spot) in order, for rows with an id, and spots for those without.

    The ids are approximate quantiles. One that recurs among them belongs to a great many rows; these, and those without
    an id, are cut at quantiles of how their texts begin.
    """
    def quantiles(column: str, n: int) -> Column:
        return F.percentile_approx(column, [k / n for k in range(1, n)], 20 * n)

    found = docs.agg(quantiles(order, groups)).first()[0] if groups > 1 else None
    times = Counter(found or [])
    many = max([null_groups, *times.values()])
    wanted = F.col(order).isin([v for v, n in times.items() if n > 1]) | F.col(order).isNull()
    inner = {}
    if many > 1:  # a row per id that recurs among the quantiles
        inner = dict(tuple(r) for r in docs.where(wanted).groupBy(order).agg(quantiles("spot", many)).collect())
    cuts = [(value, spot) for value in sorted(times) for spot in sorted({0, *inner.get(value, [])})]
    return cuts, sorted(set(inner.get(None, [])))


def _group(order: Column, spot: Column, cuts: list[tuple[int, int]], null_cuts: list[int]) -> Column:
    """The number of a row's group: how many cuts come before it; rows without an id have groups below 0.

    Every ``CUTS_TOGETHER``-th cut is compared first, then the ones behind the last of them that comes before the row.
    """

    def count(values: list, passed: Callable[[Column], Column]) -> Column:
        def before(places: Column) -> Column:
            return F.size(F.filter(places, passed))

        def behind(n: Column) -> Column:
            low = (n - 1) * CUTS_TOGETHER
            return low + before(F.sequence(low + 1, F.least(low + CUTS_TOGETHER, F.lit(len(values)))))

        if not values:
            return F.lit(0)
        tops = F.sequence(F.lit(1), F.lit(len(values)), F.lit(CUTS_TOGETHER))
        return _let(before(tops), lambda n: F.when(n == 0, 0).otherwise(behind(F.greatest(n, F.lit(1)))))

    def numbers(values: list[int]) -> Column:
        """One literal, however many there are."""
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    ids, spots, alone = (numbers(x) for x in ([c[0] for c in cuts], [c[1] for c in cuts], null_cuts))

    def passed(i: Column) -> Column:
        value = F.element_at(ids, i)
        return (value < order) | ((value == order) & (F.element_at(spots, i) <= spot))

    without = count(null_cuts, lambda i: F.element_at(alone, i) <= spot) - (len(null_cuts) + 1)
    return F.when(order.isNull(), without).otherwise(count(cuts, passed)).cast("long")


def with_next(
    docs: DataFrame, columns: list[str], order: str = "doc_id", derive: Callable[[DataFrame], DataFrame] = lambda x: x
) -> DataFrame:
    """Add ``next_<column>`` of the row that follows by ``order``; after the last row comes the first.

    ``docs`` has a column ``text`` without nulls, for the order of equal ids. Rows are grouped between quantiles of their ids
    (and, where an id recurs or is missing, of how texts begin), about ``ROWS_PER_GROUP`` rows each; nothing is computed
    with ids, so any are allowed. Each group also gets the first row of the next one, so that one shuffle of all rows is
    enough; first rows are found by a minimum, taken within the tasks first. ``derive`` adds columns of a row once those
    rows are chosen, before the shuffle. Rows with one id whose texts begin with the same seven bytes are one group.
    """
    beginning = F.rpad(F.hex(F.substring(F.col("text").cast("binary"), 1, 7)), 14, "0")
    docs = docs.withColumn("spot", F.conv(beginning, 16, 10).cast("bigint"))
    rows, known = docs.agg(F.count("*"), F.count(order)).first()
    groups = [max(1, min(MOST_GROUPS, -(-n // ROWS_PER_GROUP))) for n in (known, rows - known)]
    group = _group(F.col(order), F.col("spot"), *_cuts(docs, order, *groups))
    rest = [c for c in docs.columns if c not in (order, "text", "spot")]
    firsts = docs.withColumn("own", group).groupBy("own").agg(F.min(F.struct(order, "text", "spot", *rest)).alias("first")).withColumn(
        "range", F.floor(F.col("own") / GROUPS_TOGETHER)
    )
    by_range = Window.orderBy("range")  # one row per GROUPS_TOGETHER groups
    around = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = firsts.groupBy("range").agg(F.max("own").alias("last")).select(
        "range", F.coalesce(F.lag("last").over(by_range), F.max("last").over(around)).alias("last_before")
    )
    seen = firsts.withColumn("before", F.lag("own").over(Window.partitionBy("range").orderBy("own"))).join(ranges, "range").select(
        *(F.col(f"first.{c}").alias(c) for c in docs.columns), F.coalesce("before", "last_before").alias("group"), F.lit(1).alias("lent")
    )
    grouped = docs.withColumn("group", group)
    inside = Window.partitionBy("group").orderBy("lent", F.col(order).asc_nulls_first(), "text")
    rows_ = derive(grouped.withColumn("lent", F.lit(0)).unionByName(seen))
    linked = rows_.select(
        *(c for c in rows_.columns if c != "group"), *(F.lead(c).over(inside).alias(f"next_{c}") for c in columns)
    )
    return linked.where("lent = 0").drop("lent", "spot")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and ``fingerprint`` of every row."""
    return _fingerprinted(docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text")))


def _fingerprinted(texts: DataFrame) -> DataFrame:
    return texts.withColumn("fingerprint", fingerprint(F.col("text")))


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op8: each text against its edited form and against the next document."""
    n, quarter = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    source = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = with_next(source, ["text", "fingerprint"], derive=_fingerprinted).select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint"
    ).withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    for name in ("fingerprint", "edited_fingerprint", "next_fingerprint"):
        rows = rows.withColumn(f"{name}_leaves", leaf_set(F.col(name)))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        *(
            likeness(F.col("fingerprint"), F.col(other), F.col("fingerprint_leaves"), F.col(f"{other}_leaves")).alias(name)
            for name, other in (("near_edited", "edited_fingerprint"), ("near_next", "next_fingerprint"))
        ),
    )
