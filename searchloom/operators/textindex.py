"""Inverted index: words or phrases per document, folded into posting lists.

A posting list is kept in blocks of documents. A frequent word occurs in nearly
every document, so one list per word would put a large part of the collection
into one row; with blocks, a row never holds more documents than a block has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom import fixed_values as fixed
from searchloom.functions import text as words_of

DOCUMENTS_PER_BLOCK = 250_000


def tokenize(docs: DataFrame, *kept: str) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, pos, term)``, after the columns ``kept``."""
    return docs.select(*kept, "doc_id", F.posexplode(words_of.words(F.col("text"))).alias("pos", "term"))


def bigrams(docs: DataFrame) -> DataFrame:
    """``(doc_id, pos, term)`` for each pair of neighbouring words."""
    words = docs.select("doc_id", words_of.words(F.col("text")).alias("words"))
    pairs = words.select("doc_id", F.posexplode(words_of.neighbour_pairs(F.col("words"))).alias("pos", "pair"))
    return pairs.select("doc_id", "pos", F.concat_ws(" ", "pair.first", "pair.second").alias("term"))


def phrase_occurrences(
    docs: DataFrame, phrases: Sequence[str] | DataFrame = fixed.TARGET_PHRASES
) -> DataFrame:
    """Word pairs that are wanted phrases: a list, or a table with a ``term`` column."""
    if isinstance(phrases, DataFrame):
        return bigrams(docs).join(phrases.select("term"), "term", "left_semi").select("doc_id", "pos", "term")
    words = docs.select("doc_id", words_of.words(F.col("text")).alias("words"))
    numbered = F.transform(
        words_of.neighbour_pairs(F.col("words")),
        lambda pair, pos: F.struct(pos.alias("pos"), F.concat_ws(" ", pair["first"], pair["second"]).alias("term")),
    )
    wanted = F.filter(numbered, lambda x: x["term"].isin(*phrases))  # in the row: only wanted pairs become rows
    return words.select("doc_id", F.inline(wanted))


def term_counts(occurrences: DataFrame, *kept: str) -> DataFrame:
    """``(term, doc_id, n)``; counted on the map side first, so a shuffle row per posting.

    ``kept`` columns that follow from the document stay, too; rows that are dealt out by them aren't shuffled again.
    """
    return occurrences.groupBy(*kept, "term", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def block_count(
    docs: DataFrame,
    documents_per_block: int = DOCUMENTS_PER_BLOCK,
    n_documents: int | None = None,
) -> int:
    """How many blocks keep each one near ``documents_per_block`` documents.

    Counts ``docs`` unless a number is given.
    """
    n_documents = docs.count() if n_documents is None else n_documents
    return max(1, -(-n_documents // documents_per_block))


def in_blocks(docs: DataFrame, block: Column) -> DataFrame:
    """``docs`` with their ``block``, dealt out by it.

    The texts are shuffled once; counting (``kept="block"``) and folding the postings of a block need no other shuffle.
    """
    return docs.withColumn("block", block.cast("int")).repartition("block")


def posting_blocks(counts: DataFrame, n_blocks: int = 1, block: Column | None = None) -> DataFrame:
    """``(term, block, n_docs, postings)``, postings ordered by document.

    ``block`` assigns a document to a block; by default a hash of its id.
    """
    if block is None:
        block = F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks))
    return (
        counts.groupBy("term", block.cast("int").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "n"))).alias("postings"))
        .select("term", "block", F.size("postings").alias("n_docs"), "postings")
    )


def posting_text(postings: Column) -> Column:
    """``doc:count doc:count ...``"""
    return F.array_join(
        F.transform(
            postings,
            lambda p: F.concat(p["doc_id"].cast("string"), F.lit(":"), p["n"].cast("string")),
        ),
        " ",
    )


def parse_postings(lines: DataFrame) -> DataFrame:
    """Lines ``term TAB doc:count ...`` (column ``value``) to ``(term, doc_id, n)``.

    The count follows the last colon, so document ids may contain colons.
    """
    fields = F.split("value", "\t", 2)
    entries = lines.where(F.size(fields) == 2).select(
        fields[0].alias("term"), F.explode(F.split(fields[1], " ")).alias("entry")
    )
    return entries.select(
        "term",
        F.regexp_extract("entry", r"(?s)\A(.*):([0-9]+)\z", 1).alias("doc_id"),
        F.regexp_extract("entry", r"(?s)\A(.*):([0-9]+)\z", 2).cast("bigint").alias("n"),
    )
