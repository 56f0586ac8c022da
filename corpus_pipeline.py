"""Clean a corpus in stages: each takes the documents that the one before kept.

Quality classifier, line dedup, near-duplicate join, dedup of passages, packing. A stage is called as
``stage(spark, docs, sf_dir)``; all but the last return the columns of ``docs``. Where a stage changes texts, it
keeps the first copy of what repeats: the first document (by id) keeps a line or a passage, later ones lose it.

Defined cases: null, empty and blank texts pass the stages unchanged (the classifier judges them as empty texts) and are
packed as a lone end id; rows with a null id come after all others where the first counts, and are otherwise documents
like any other; repeated rows are one document for the near-copy stage, and keep alike what they hold first; ties go to the
smaller id, then to a hash of the text; very long texts are read whole; an empty table gives an empty result. Other
columns stay as they are, whatever their names; ``n_chars``, if there is one, follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from searchloom.llm import line_dedup, ngram_join, packing, qda, suffix_dedup
from searchloom.shipping import ship
from searchloom.storage import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels that aren't held out, doesn't reject."""
    ship(spark)
    return qda.without_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more stay in the first one only; documents without a word left go."""
    ship(spark)
    return line_dedup.without_repeated_lines(docs, keep_first=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: those that share 80 % of their 5-word shingles (op3 has its own values)."""
    ship(spark)
    return ngram_join.one_of_each_group(docs, k=5, percent=80)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that occur earlier are cut; documents without a word left go."""
    ship(spark)
    return suffix_dedup.without_later(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenized and packed."""
    ship(spark)
    return packing.digest(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", passages),
    ("packing", sequences),
]

#: The classifier's densities and the packing can't be expressed in SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again for the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
