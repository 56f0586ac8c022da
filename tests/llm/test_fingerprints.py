"""Fingerprints and likeness against an independent version, and next rows among ids of any kind."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from searchloom.llm import merkle
from test_operators import sha

IDS = {
    "extremes": [-(2**63), 0, 2**63 - 1],
    "hashed": sorted(int.from_bytes(hashlib.sha256(str(k).encode()).digest()[:8], "big", signed=True) for k in range(3000)),
    "dense and one far": [*range(2500), 10**15],
    "clustered": [c * 10**12 + k for c in range(5) for k in range(500)],
    "one id": [7] * 1500 + [8, 9],
    "many without": [None] * 1200 + list(range(900)),
    "single": [4],
}


@pytest.mark.parametrize("kind", IDS)
def test_next_rows_of_any_ids(spark, kind, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_PER_GROUP", 64)
    monkeypatch.setattr(merkle, "GROUPS_TOGETHER", 4)
    monkeypatch.setattr(merkle, "CUTS_TOGETHER", 3)
    dice = random.Random(3)
    rows = [(i, f"{dice.choice('abcdefghé ')}{dice.randrange(10**9)}") for i in IDS[kind]]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    dice.shuffle(rows)
    found = merkle.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), ["text"]).collect()
    want = [(*row, order[(k + 1) % len(order)][1]) for k, row in enumerate(order)]
    assert Counter((r.doc_id, r.text, r.next_text) for r in found) == Counter(want)


def test_groups_are_small_wherever_ids_lie(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_PER_GROUP", 64)
    for kind in ("hashed", "dense and one far", "clustered", "one id", "many without"):
        rows = [(i, hashlib.sha256(f"{kind}{n}".encode()).hexdigest()) for n, i in enumerate(IDS[kind])]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        spot = F.conv(F.rpad(F.hex(F.substring(F.col("text").cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
        docs = docs.withColumn("spot", spot)
        null = sum(i is None for i, _ in rows)
        groups = [max(1, -(-n // 64)) for n in (len(rows) - null, null)]
        sizes = docs.groupBy(merkle._group(F.col("doc_id"), F.col("spot"), *merkle._cuts(docs, "doc_id", *groups))).count().collect()
        assert max(r["count"] for r in sizes) <= 200, kind


def leaves_by_hand(paragraph):
    """Clauses end behind white space that follows a mark or one of six letters; else after each eighth word."""
    cut = re.sub(r"(\s(?<=[^\w\s]\s)\s*|\s(?<=_\s)\s*|\s(?<=[gGyYzZ]\s)\s*)(?=\S)", lambda m: m.group(0) + "\n", paragraph, flags=re.ASCII)
    if "\n" not in cut:
        cut = re.sub(r"((?:\S+\s+){8})(?=\S)", lambda m: m.group(0) + "\n", paragraph, flags=re.ASCII)
    return [sha(x) for x in cut.split("\n")]


def fingerprint_by_hand(text):
    paragraphs = [leaves_by_hand(p) for p in text.split("\n")]
    hashes = [sha("".join(leaves)) for leaves in paragraphs]
    sections, run = [], ""
    for h in hashes:
        run += h
        if h[0] < "4":
            sections.append(run)
            run = ""
    sections = [sha(s) for s in ([*sections, run] if run else sections)]
    shown = ";".join(f"{h[:8]}:{','.join(x[:8] for x in leaves)}" for h, leaves in zip(hashes, paragraphs, strict=True))
    return f"{sha(''.join(sections))}|{' '.join(s[:8] for s in sections)}|{shown}"


def leaf_set(fingerprint):
    return {x for p in fingerprint.rsplit("|", 1)[1].split(";") for x in p.split(":")[1].split(",")}


def test_fingerprints_and_likeness_by_hand(spark):
    dice = random.Random(8)
    words = ["song", "play", "quiz", "one", "two,", "three.", "(four)", "five", "six!", "a_b", "x-y", "seven", "EIGHT"]
    texts = ["", " ", "\n\n", "word"]
    texts += ["".join(dice.choice(words) + dice.choice([" ", " ", " ", "  ", "\n"]) for _ in range(dice.randrange(1, 120))) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in merkle.digest(docs).collect()}
    for k, text in enumerate(texts):
        following = texts[(k + 1) % len(texts)]
        quarter = len(text) // 4
        prints = [fingerprint_by_hand(t) for t in (text, text[: len(text) - quarter] + following[:quarter], following)]
        assert (rows[k].fingerprint, rows[k].edited_fingerprint) == (prints[0], prints[1]), text
        for near, other in ((rows[k].near_edited, prints[1]), (rows[k].near_next, prints[2])):
            a, b = leaf_set(prints[0]), leaf_set(other)
            assert near == (1.0 if prints[0] == other else 2 * len(a & b) / (len(a) + len(b)))
