import random
import re
import sys
from collections import Counter
from pathlib import Path

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import driver_queries  # noqa: E402
from searchloom import fixed_values as fixed  # noqa: E402
from searchloom.functions import text  # noqa: E402
from searchloom.operators import textindex  # noqa: E402
from searchloom.plans import jobs  # noqa: E402
from searchloom.sources import documents, index_text  # noqa: E402


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, text string")


def postings_of(blocks):
    found = {}
    for row in blocks.collect():
        ids = [p.doc_id for p in row.postings]
        assert ids == sorted(ids) and len(ids) == row.n_docs
        for posting in row.postings:
            key = (row.term, posting.doc_id)
            assert key not in found
            found[key] = posting.n
    return found


def counted(rows, width=1):
    expected = Counter()
    for doc_id, body in rows:
        words = re.findall("[a-z]+", body.lower())
        for i in range(len(words) - width + 1):
            expected[" ".join(words[i:i + width]), doc_id] += 1
    return dict(expected)


def test_lines_with_tabs_and_without(spark, tmp_path):
    lines = ["d1\tIt's a test, a TEST", "no tab here", "d2\tone\ttwo one", "\t", "d:3\tx"]
    path = tmp_path / "docs.tsv"
    path.write_text("\n".join(lines) + "\n")
    docs = documents.read_documents(spark, str(path))
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == [
        ("", ""), ("d1", "It's a test, a TEST"), ("d2", "one\ttwo one"), ("d:3", "x"),
    ]
    assert postings_of(jobs.word_index(docs)) == {
        ("it", "d1"): 1, ("s", "d1"): 1, ("a", "d1"): 2, ("test", "d1"): 2,
        ("one", "d2"): 2, ("two", "d2"): 1, ("x", "d:3"): 1,
    }


def test_one_document_on_several_lines(spark):
    docs = docs_of(spark, [("d", "a b"), ("d", "b c"), ("e", "b")])
    assert postings_of(jobs.word_index(docs)) == {("a", "d"): 1, ("b", "d"): 2, ("c", "d"): 1, ("b", "e"): 1}


def test_pairs_cross_sentence_ends(spark):
    docs = docs_of(spark, [("d", " science. Information retrieval"), ("e", "one"), ("f", ""), ("g", None)])
    pairs = textindex.bigrams(docs).orderBy("pos").collect()
    assert [(p.doc_id, p.pos, p.term) for p in pairs] == [
        ("d", 0, "science information"), ("d", 1, "information retrieval"),
    ]


def test_phrases_as_list_and_as_table(spark):
    rows = [("d1", "Los Angeles, los-angeles! computer science"), ("d2", "the los angelesx los angeles")]
    docs = docs_of(spark, rows)
    wanted = {k: n for k, n in counted(rows, 2).items() if k[0] in fixed.TARGET_PHRASES}
    assert postings_of(jobs.phrase_index(docs)) == wanted
    table = spark.createDataFrame([(p,) for p in fixed.TARGET_PHRASES], "term string")
    assert postings_of(jobs.phrase_index(docs, table)) == wanted


def test_a_word_in_every_document_is_cut_into_blocks(spark):
    rng = random.Random(1)
    rows = [(f"d{i:04d}", "the " * rng.randint(1, 5) + f"w{i % 7}") for i in range(400)]
    blocks = jobs.word_index(docs_of(spark, rows), documents_per_block=50)
    assert postings_of(blocks) == counted(rows)
    sizes = [r.n_docs for r in blocks.where("term = 'the'").collect()]
    assert len(sizes) == 8 and max(sizes) < 100
    given = jobs.word_index(docs_of(spark, rows), documents_per_block=50, n_documents=100)
    assert given.where("term = 'the'").count() == 2


def test_text_form_goes_there_and_back(spark, tmp_path):
    rows = [(f"doc:{i}", "common word " + "rare " * (i % 3)) for i in range(60)]
    blocks = jobs.word_index(docs_of(spark, rows), documents_per_block=20)
    path = str(tmp_path / "index")
    index_text.write_index(blocks, path)
    back = {(r.term, r.doc_id): r.n for r in index_text.read_index(spark, path).collect()}
    assert back == counted(rows)
    parts = sorted((tmp_path / "index").glob("part-*"))
    assert 1 <= len(parts) <= fixed.INDEX_PART_FILES
    for part in parts:
        terms = [line.split("\t")[0] for line in part.read_text().splitlines()]
        assert terms == sorted(terms)


def test_reading_a_given_index(spark, tmp_path):
    path = tmp_path / "index.txt"
    path.write_text("bruce willis\td1:3 d2:4\nlos angeles\td1:2 d2:6 d3:3 d4:2 d5:13\n")
    totals = (
        index_text.read_index(spark, str(path)).groupBy("term")
        .agg(F.count("doc_id").alias("docs"), F.sum("n").alias("n")).orderBy("term").collect()
    )
    assert [tuple(r) for r in totals] == [("bruce willis", 2, 7), ("los angeles", 5, 26)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aAbZé1 .,\n\t'ßİ-", max_size=30), min_size=1, max_size=30))
def test_index_agrees_with_a_counter(spark, texts):
    rows = [(f"d{i % 11}", body) for i, body in enumerate(texts)]
    found = postings_of(jobs.word_index(docs_of(spark, rows), documents_per_block=4))
    expected = Counter()
    for row in rows:
        for key, n in counted([row]).items():
            expected[key] += n
    assert found == dict(expected)


def test_word_windows(spark):
    def windows(n, size, step):
        tokens = [str(i) for i in range(n)]
        df = spark.createDataFrame([(tokens,)], "w array<string>")
        return df.select(text.word_windows(F.col("w"), size, step)).first()[0]

    assert windows(0, 3, 2) is None
    assert windows(2, 3, 2) == ["0 1"]
    assert windows(3, 3, 2) == ["0 1 2"]
    assert windows(4, 3, 2) == ["0 1 2", "2 3"]
    assert windows(7, 3, 2) == ["0 1 2", "2 3 4", "4 5 6"]


def test_words_are_indexed_with_one_shuffle(spark, tmp_path):
    rows = [(n % 900, f"word{chr(97 + n % 26)} The the x{chr(97 + n % 7)}") for n in range(1000)] + [(3, "the"), (None, "the the"), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    blocks = driver_queries.idx_postings(spark, str(tmp_path))
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(block" in plan
    found = {}
    for row in blocks.collect():
        for posting in row.postings.split():
            doc, n = posting.split(":")
            assert (row.term, doc) not in found and row.block == int(doc) % 3
            found[row.term, doc] = int(n)
    known = [(str(doc), text) for doc, text in rows if doc is not None and text is not None]
    assert found == counted(known)
