"""The registered queries against their SQL, and the pipeline against brute force."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as contract  # noqa: E402
import check  # noqa: E402
import corpus_pipeline  # noqa: E402
from searchloom.llm import qda, queries  # noqa: E402
from test_operators import components, line_keys, shingles, words_of  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_its_sql(spark, tables, name):
    verdict = check.compare(spark, tables, SF_DIR, name)
    assert verdict.startswith("same"), verdict


def test_all_operators_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in queries.QUERIES}
    assert numbers == set(range(1, 14)) and "pipeline" in contract.queries()


def rows_of(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=lambda x: x[0])


def test_pipeline_stages(spark, rows, labels, tmp_path):
    known = list({i: (i, t, "x", len(t or "")) for i, t in rows if i is not None}.values())
    docs = spark.createDataFrame(known, "doc_id long, text string, keep string, n_chars long")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality classifier"](spark, docs, str(tmp_path))
    predicted = {r.doc_id: r.predicted for r in qda.quality(docs, labels).collect()}
    assert good.columns == docs.columns and rows_of(good) == sorted((i, t) for i, t, *_ in known if predicted[i])

    table = rows_of(docs)  # the others on all rows
    cut = stages["line dedup"](spark, docs, str(tmp_path))
    often = {}
    for i, text in table:
        for key in set(line_keys(text)) - {""}:
            often.setdefault(key, []).append(i)
    want = []
    for i, text in table:
        used, kept = set(), []
        for line, key in zip((text or "").split("\n"), line_keys(text), strict=True):
            if len(often.get(key, [])) < 10 or (min(often[key]) == i and key not in used):
                kept.append(line)
            used.add(key)
        new = "\n".join(kept) if text is not None else None
        if new == (text or "") or new == text or words_of(new):
            want.append((i, new if new != text else text))
    assert cut.columns == docs.columns and rows_of(cut) == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut.where("text IS NOT NULL").collect())

    single = stages["n-gram Jaccard join"](spark, docs, str(tmp_path))
    sets = [shingles(t) for _, t in table]
    roots = components(sets)
    first = {}
    for (i, _), root in zip(table, roots, strict=True):
        first[root] = min(i, first.get(root, i))
    assert single.columns == docs.columns
    assert rows_of(single) == [x for x, s, root in zip(table, sets, roots, strict=True) if not s or first[root] == x[0]]

    passages = stages["suffix-array dedup"](spark, docs, str(tmp_path))
    seen, want = set(), {}
    for i, text in table:
        w = words_of(text)
        gone = [False] * len(w)
        for p in range(len(w) - 49):
            run = tuple(w[p : p + 50])
            if run in seen:
                gone[p : p + 50] = [True] * 50
            seen.add(run)
        if not w or not all(gone):
            want[i] = [a for a, g in zip(w, gone, strict=True) if not g]
    assert passages.columns == docs.columns and {i: words_of(t) for i, t in rows_of(passages)} == want

    end = corpus_pipeline.run(spark, str(tmp_path))
    assert end.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    left = {i for i, *_ in known if predicted[i]}
    assert {r.doc_id for r in end.select("doc_id").distinct().collect()} <= left


def test_pipeline_of_an_empty_table(spark, labels, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
