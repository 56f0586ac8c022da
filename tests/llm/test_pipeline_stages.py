"""Stages of the pipeline in cases that the common fixture doesn't have."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)


def kept_by_brute_force(rows):
    """The first id of each group of texts that are linked by 80 % of their 5-word shingles."""
    sets = [{tuple(w[p : p + 5]) for p in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                group = [group[b] if g == group[a] else g for g in group]
    first = {}
    for (i, _), g in zip(rows, group, strict=True):
        first[g] = min(i, first.get(g, i))
    return set(first.values())


def test_near_copies_share_five_words(spark):
    """Blocks of 85 to 100 words replaced in 1000: over 0.8 of the 5-word, under 0.85 of the 4-word shingles."""
    rows = []
    for n, block in enumerate((75, 85, 100, 106, 107, 130)):
        words = [f"t{n}w{k}" for k in range(1000)]
        rows += [(10 * n + 1, " ".join(words)), (10 * n, " ".join(words[:400] + [f"new{n}x{k}" for k in range(block)] + words[400 + block :]))]
    want = kept_by_brute_force(rows)
    assert want == {0, 10, 20, 30, 40, 41, 50, 51}
    single = STAGES["n-gram Jaccard join"](spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in single.collect()} == want


@pytest.mark.parametrize("lines", [5, 1])
@pytest.mark.parametrize("times", [2, 12])
def test_a_repeated_row_keeps_the_lines_it_holds_first(spark, lines, times):
    """In one partition: of five frequent lines three at least are inside; a single one is at both ends."""
    common = [f"Common line {k}" for k in range(lines)]
    rows = [(1, "\n".join(common))] * times + [(2 + k, "\n".join([*common, f"own {k}"] if lines > 1 else common)) for k in range(11)]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = STAGES["line dedup"](spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    want = [(1, "\n".join(common))] * times + [(2 + k, f"own {k}") for k in range(11) if lines > 1]
    assert sorted((r.doc_id, r.text) for r in found) == want


def test_rows_without_an_id_or_with_the_same_one_stay_unless_linked(spark):
    """Unlinked rows are no copies of each other, whatever their ids; repeated rows are one document."""
    def words(name, n=60):
        return " ".join(f"{name}{k}" for k in range(n))

    rows = [(None, words("a")), (None, words("b")), (5, words("c")), (5, words("d")), (5, words("c")), (None, words("e") + " end"),
            (7, words("e")), (None, None), (None, " "), (8, ""), (None, words("f")), (None, words("f") + " end")]
    found = STAGES["n-gram Jaccard join"](spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    kept = [(r.doc_id, r.text) for r in found]
    f_rows = [x for x in kept if x[1] and x[1].startswith("f0")]
    assert len(f_rows) == 1
    assert sorted(map(str, (x for x in kept if x not in f_rows))) == sorted(map(str, [rows[i] for i in (0, 1, 2, 3, 6, 7, 8, 9)]))


def test_keys_of_rows_without_an_id_are_wide(spark):
    from pyspark.sql import functions as F

    from searchloom.llm.rows import texts_of

    docs = spark.range(300_000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    keyed = texts_of(docs)
    assert keyed.select("id", "tag").distinct().count() == keyed.select("id").distinct().count() == keyed.select("tag").distinct().count() == 300_000
    assert keyed.where(F.col("id") < 2**62).isEmpty()
