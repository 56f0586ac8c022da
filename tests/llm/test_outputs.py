"""What the operators make, beside the figures that their queries show."""

import re

import numpy as np

from searchloom.llm import packing, quality_rules
from test_operators import ids_of


def test_quality_rules_return_the_text_without_bad_lines(spark, docs, rows):
    text = "Home | News | About\n\nA plain sentence, with marks.\n### $$$ wow\n \nAll rights reserved.\nIt ended there."
    made = spark.createDataFrame([(1, text), (2, None), (3, "one\n")], "doc_id long, text string")
    kept = {r.doc_id: r.kept_text for r in quality_rules.quality_rules(made).collect()}
    assert kept == {1: "\nA plain sentence, with marks.\n \nIt ended there.", 2: "", 3: "one\n"}
    texts = {(i, t or "") for i, t in rows}
    for r in quality_rules.quality_rules(docs).collect():
        assert sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", r.kept_text))) == r.kept_chars
        assert r.n_bad_lines or (r.doc_id, r.kept_text) in texts
    assert "kept_text" not in quality_rules.digest(docs).columns


def test_packed_sequences_hold_their_ids(docs, rows):
    sequences, found = {}, {}
    for r in packing.packed(docs, with_ids=True).orderBy("sequence_id", "offset").collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        held = sequences.setdefault(r.sequence_id, [])
        assert len(ids) == r.length and len(held) == r.offset
        held += ids
        found.setdefault(r.doc_id, {}).setdefault(r.start, []).append(ids)
    whole = {i: t for i, t in rows if [x for x, _ in rows].count(i) == 1}
    for i, text in whole.items():
        assert sum((found[i][s][0] for s in sorted(found[i])), []) == [*ids_of(text), 2]
    assert "ids" not in packing.digest(docs).columns
