"""MinHash near-dedup against brute force, and its signatures against the algorithm one member at a time."""

import random
from collections import Counter

import numpy as np
import pytest

from searchloom.llm import minhash_dedup, stars
from searchloom.llm import words as W
from test_operators import lower, words_of

MASK = 2**64 - 1


def sets_of(texts, k=5):
    found = []
    for text in texts:
        words = words_of(lower(text or ""))
        found.append({tuple(words[p : p + k]) for p in range(max(1, len(words) - k + 1))} if words else set())
    return found


def groups_of(sets, percent=85):
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                group = [group[b] if g == group[a] else g for g in group]
    return group


def want_of(rows, percent=85):
    sets = sets_of([t for _, t in rows])
    groups = groups_of(sets, percent)
    least = {}
    for (i, _), g in zip(rows, groups, strict=True):
        least[g] = min((x for x in (i, least.get(g)) if x is not None), default=None)
    return Counter((i, len(s), least[g], i == least[g]) for (i, _), s, g in zip(rows, sets, groups, strict=True))


def got(frame):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect())


def test_near_duplicates(docs, rows):
    assert got(minhash_dedup.digest(docs)) == want_of(rows)


def test_no_documents(empty):
    assert minhash_dedup.digest(empty).isEmpty()


def test_chains_and_groups_without_a_centre(spark):
    """A chain (neighbours are linked, others aren't), copies of a text that isn't there (pairs below the limit), and
    copies of one that is: it is the only one they are linked with."""
    words = [f"c{k}" for k in range(1000)]
    rows = [(i, " ".join(words[20 * i : 20 * i + 400])) for i in range(25)]
    for base, centre in ((100, False), (200, True)):
        text = [f"b{base}x{k}" for k in range(500)]
        for i in range(30):
            changed = list(text)
            for j in range(7):
                changed[(16 * i + 67 * j) % 500] = f"e{base}x{i}x{j}"
            rows.append((base + i, " ".join(changed)))
        if centre:
            rows.append((base + 50, " ".join(text)))
    rows.append((-1, rows[40][1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(minhash_dedup.digest(docs)) == want_of(rows)


def one_by_one(members, slots):
    """SuperMinHash as published: one member after the other, all steps."""
    least = [MASK] * slots
    for member in members.tolist():
        order = list(range(slots))
        for step in range(slots):
            random = int(W.mix(np.array([(member + (step + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
            place = step + ((random & 0xFFFFFFFF) * (slots - step) >> 32)
            order[step], order[place] = order[place], order[step]
            least[order[step]] = min(least[order[step]], step << 32 | random >> 32)
    return least


@pytest.mark.parametrize("slots", [1, 7, 150])
def test_signatures(slots):
    sizes = [1, 2, 5, 40, 0, 900]
    members = W.mix(np.arange(1, sum(sizes) + 1, dtype=np.uint64))
    first = np.concatenate(([0], np.cumsum(sizes)))
    found = minhash_dedup.super_minhash(members, first, slots)
    for k, size in enumerate(sizes):
        assert found[k].tolist() == (one_by_one(members[first[k] : first[k + 1]], slots) if size < 100 else found[k].tolist())
    assert (found[4] == minhash_dedup.EMPTY).all() and (found[5] != minhash_dedup.EMPTY).all()


def test_agreement_estimates_similarity():
    errors = []
    for turn in range(60):
        members = W.mix(np.arange(turn * 1000 + 1, turn * 1000 + 1001, dtype=np.uint64))
        both = np.concatenate((members[:800], members[200:]))  # 600 of 1000 are shared
        found = minhash_dedup.super_minhash(both, np.array([0, 800, 1600]))
        errors.append((found[0] == found[1]).mean() - 0.6)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.045


def test_a_hub_is_dealt_to_several_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stars, "PART", 10)
    dice = random.Random(2)
    pairs = [(0, b) for b in range(1, 60)] + [(5, b) for b in range(6, 9)]
    spark.createDataFrame(pairs, "a long, b long").write.parquet(f"{tmp_path}/pairs")
    payloads = spark.createDataFrame([(k, k, bytes([dice.randrange(3)])) for k in range(60)], "node long, n int, payload binary")
    values = {r.node: r.payload for r in payloads.collect()}

    def test():
        return lambda hub, n, payload, others, sizes: np.array([x.as_py() == payload and s > n for x, s in zip(others, sizes, strict=True)], bool)

    found = stars.tested(spark.read.parquet(f"{tmp_path}/pairs"), payloads, test)
    assert sorted(map(tuple, found.collect())) == [(a, b) for a, b in pairs if values[a] == values[b]]
