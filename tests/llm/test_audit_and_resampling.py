"""Filter audit and importance resampling against brute force, on rows with nulls, repeats and ties."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from searchloom.llm import filter_audit, resampling
from test_operators import lower, words_of

FAILING = {
    "A": lambda t: len(words_of(t)) < 50,
    "B": lambda t: 100 * len(set(words_of(t))) < 65 * len(words_of(t)),
    "C": lambda t: 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
    "D": lambda t: re.search(r"[#$%&*|]", t) is not None,
}


def audit_by_brute_force(rows, good, toxic):
    """Rows (id, text, part) to {(part, order, step): the eight... counts}."""
    documents = []
    for i, text, part in rows:
        text = text or ""
        fails = {name for name, test in FAILING.items() if test(text)}
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            fails.add("E")
        documents.append((part or "", fails, i in good, i in toxic))
    result = {}
    for part in {d[0] for d in documents}:
        mine = [d for d in documents if d[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                out = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                shapley[name] += len(out)
                failing = sum(name in d[1] for d in mine)
                result[part, "".join(order), step] = [
                    len(left), len(out), failing - len(out), sum(d[1] == {name} for d in mine), sum(d[2] for d in out), sum(d[3] for d in out), name,
                ]
        for key, value in result.items():
            if key[0] == part:
                value[6] = shapley[value[6]]
    return {k: tuple(v) for k, v in result.items()}


def audited(frame):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in frame.collect()
    }


@pytest.fixture(scope="module")
def parted(rows):
    dice = random.Random(3)
    texts = [t for _, t in rows] + ["SHOUT " * 60, "a #b " * 30, "one " * 70, "xé" * 80]
    made = [(i, t, dice.choice(["hot", "hot", "hot", "b", None, ""])) for i, t in rows]
    return made + [(500 + k, dice.choice(texts), dice.choice(["hot", "b", "c d"])) for k in range(60)]


@pytest.mark.parametrize("most", [7, filter_audit.RANGE])
def test_filter_audit(spark, parted, labels, most):
    docs = spark.createDataFrame([(i, t, p, "k", 1) for i, t, p in parted], "doc_id long, text string, source string, part string, fails int")
    known = [r for r in labels.collect() if r.doc_id is not None]
    good, toxic = {r.doc_id for r in known if r.quality == 1}, {r.doc_id for r in known if r.toxic == 1}
    rows = filter_audit.judged(docs.repartition(4), labels.union(labels))
    ranges = filter_audit.posting_lists(rows, most).collect()
    assert sum(r.n for r in ranges) == len(parted) and max(r.n for r in ranges) <= most
    assert Counter(i for r in ranges for i in r.ids) == Counter(i for i, _, _ in parted)
    assert audited(filter_audit.audit(docs, labels, most=most)) == audit_by_brute_force(parted, good, toxic)


def test_filter_audit_of_no_documents(empty, labels):
    assert filter_audit.audit(empty, labels, part="gram").isEmpty()


def test_galloping_merges():
    dice = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.flatnonzero(dice.random(dice.integers(1, 60)) < dice.random()).astype(np.int32) for _ in range(2))
        assert filter_audit.union(a, b).tolist() == sorted({*a.tolist(), *b.tolist()})
        assert filter_audit.difference(a, b).tolist() == sorted({*a.tolist()} - {*b.tolist()})


def features_of(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    return words, [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]


def resampled_by_brute_force(rows, target):
    source, wanted = (
        Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in features_of(t)[1]) for texts in ([t for _, t in rows], target)
    )
    totals = sum(source.values()), sum(wanted.values())

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * (totals[0] + 10_000) / ((source[b] + 1) * (totals[1] + 10_000))))

    result, able = [], []
    for i, text in rows:
        words, features = features_of(text)
        weight = sum(gain(zlib.crc32(f.encode()) % 10_000) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        if len(words) >= 20:
            able.append((-score, i is None, i or 0, len(result)))
        result.append([i, len(features), weight, score, None])
    for rank, (*_, at) in enumerate(sorted(able)[: 25 * len(able) // 100], 1):
        result[at][4] = rank
    return result


def test_resampling(spark, docs, rows):
    target = [text for _, text in rows[3:6]] + [None, "", "Zwei étés 42"]
    found = resampling.resample(docs, spark.createDataFrame([(t, 1) for t in target], "text string, score int")).collect()
    want = resampled_by_brute_force(rows, target)
    assert Counter(map(tuple, (r[:4] for r in found))) == Counter(tuple(r[:4]) for r in want)
    ranked = {r.rank: (r.score, r.doc_id) for r in found if r.rank is not None}
    assert ranked == {r[4]: (r[3], r[0]) for r in want if r[4]} and sorted(ranked) == list(range(1, len(ranked) + 1))


def test_resampling_without_rows_or_target(spark, docs, empty):
    nothing = spark.createDataFrame([], "text string")
    assert resampling.resample(empty, docs).isEmpty()
    assert resampling.resample(docs, nothing).count() == docs.count()


@pytest.mark.parametrize("pivots", [1, 3, 31])
def test_quickselect_finds_every_place(spark, tmp_path, pivots):
    dice = random.Random(5)
    rows = [(dice.randrange(4), dice.choice([None, 1, 2, 3]), dice.randrange(3), k) for k in range(60)]
    spark.createDataFrame(rows, "score long, doc_id long, tag long, serial long").write.parquet(f"{tmp_path}/rows")
    table = spark.read.parquet(f"{tmp_path}/rows")
    order = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2], r[3]))
    for k in (1, 2, 17, 59, 60):
        assert tuple(resampling.kth_key(table, k, pivots).values()) == order[k - 1]
    assert resampling.kth_key(table, 0) is None


def test_long_words_hash_like_short_ones():
    import pyarrow as pa

    texts = ["x" * 47, "x" * 48, "x" * 49, "ab " + "y" * 500 + " cd", "中" * 40 + " z"]
    hashed, of, n = resampling.features(pa.array(texts), 10_000)
    for k, text in enumerate(texts):
        assert sorted(hashed[of == k].tolist()) == sorted(zlib.crc32(f.encode()) % 10_000 for f in features_of(text)[1])
    assert n.tolist() == [1, 1, 1, 3, 2]
