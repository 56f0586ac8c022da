"""Each operator against a brute-force version, on one fixture with every odd case, and on an empty table."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from searchloom.llm import (
    bpe_automaton, id_coder, id_files, line_dedup, merkle, ngram_join, packing, qda, quality_rules, substring_dedup, suffix_dedup,
    vocabulary,
)
from searchloom.llm import words as W

WHITE = " \t\n\x0b\x0c\r"
LIBRARY = Tokenizer.from_file(vocabulary.WORD_BPE)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def got(frame, *columns):
    return Counter(map(tuple, frame.select(*columns).collect()))


def windows(lists, m):
    return Counter(tuple(w[p : p + m]) for w in lists for p in range(len(w) - m + 1))


def covered(words, repeated, m):
    gone = [False] * len(words)
    for p in range(len(words) - m + 1):
        if repeated[tuple(words[p : p + m])] > 1:
            gone[p : p + m] = [True] * m
    return gone


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_substring_dedup(docs, rows):
    lists = [words_of(t) for _, t in rows]
    repeated = windows(lists, 35)
    want = Counter()
    for (i, _), w in zip(rows, lists, strict=True):
        gone = covered(w, repeated, 35)
        want[i, len(w), sum(gone), sha(" ".join(a for a, g in zip(w, gone, strict=True) if not g))] += 1
    assert got(substring_dedup.digest(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want


@pytest.mark.parametrize("m", [2, 5, 36])
def test_substring_dedup_other_lengths(docs, rows, m):
    lists = [words_of(t) for _, t in rows]
    repeated = windows(lists, m)
    want = Counter((i, sum(covered(w, repeated, m))) for (i, _), w in zip(rows, lists, strict=True))
    assert got(substring_dedup.remove_repeated(docs, m), "doc_id", "n_removed") == want


def test_quality_rules(docs, rows):
    want = Counter()
    for i, text in rows:
        text = text or ""
        w, seen, duplicates = words_of(text), set(), 0
        for line in text.split("\n"):
            if words_of(line):
                duplicates += line in seen
                seen.add(line)
        repeats = sum(covered(w, windows([w], 3), 3))
        want[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), duplicates, repeats, len(w) < 50 or 100 * repeats > 50 * len(w)] += 1
    found = quality_rules.quality_rules(docs)
    assert got(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert found.where("kept AND base_failed").isEmpty()


def test_lines_fail_by_rule():
    def fails(line, repeated=False):
        return bool(quality_rules.line_fails(line, words_of(line), repeated))

    assert fails("### $$$ wow") and fails("12 34 -- 56 word") and fails("Home | News | About") and fails("See our Privacy Policy.")
    assert fails("Read more", True) and not fails("Read more") and not fails("It ended there.", True)
    assert not fails("A plain sentence, with marks; and a number: 7.")


def components(sets):
    parent = list(range(len(sets)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    return [root(a) for a in range(len(sets))]


def shingles(text):
    w = words_of(lower(text or ""))
    return {tuple(w[p : p + 4]) for p in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} - {()}


@pytest.mark.parametrize("tile", [512, 2])
def test_ngram_join(docs, rows, tile, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    sets = [shingles(t) for _, t in rows]
    roots = components(sets)
    smallest = {r: min((rows[k][0] for k in range(len(rows)) if roots[k] == r and rows[k][0] is not None), default=None) for r in roots}
    want = Counter((i, len(s), smallest[r] if s else i) for (i, _), s, r in zip(rows, sets, roots, strict=True))
    assert got(ngram_join.digest(docs), "doc_id", "n_shingles", "component_id") == want


def test_ngram_join_links_through_others(spark):
    """A chain: neighbours are similar, its ends aren't; and sets that meet at a common part without being similar."""
    base = [f"t{k}" for k in range(200)]
    chain = [(k, " ".join(base[: 200 - 8 * k] + [f"c{j}" for j in range(8 * k)])) for k in range(9)]
    apart = [(100 + k, " ".join(f"common{j}" for j in range(30)) + " " + " ".join(f"own{k}x{j}" for j in range(20 + k))) for k in range(30)]
    rows = chain + apart
    roots = components([shingles(t) for _, t in rows])
    want = {i: rows[r][0] for (i, _), r in zip(rows, roots, strict=True)}
    low = {r: min(i for i, q in want.items() if q == r) for r in want.values()}
    found = ngram_join.digest(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: low[r] for i, r in want.items()}


def test_bitmaps_bound_the_intersection():
    dice = np.random.default_rng(0)
    for n in (1, 10, 500, 3000):
        a = np.unique(dice.integers(0, 2**62, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: n // 2], dice.integers(0, 2**62, n).astype(np.uint64))))
        bound = ngram_join.most_shared(len(a), len(b), ngram_join.signature(a), ngram_join.signature(b))
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))


@pytest.mark.parametrize("n", [900, 3000, 40_000])
def test_bitmaps_tell_large_sets_apart(n):
    """A bitmap grows with its set, so it never fills up; the wider one is folded."""
    dice = np.random.default_rng(n)
    a, b = (np.unique(dice.integers(0, 2**62, size).astype(np.uint64)) for size in (n, n + n // 9))
    bits = [ngram_join.signature(x) for x in (a, b)]
    common, in_a, in_b = ngram_join.shared_bits(bits[0].tobytes(), np.concatenate((bits[1], bits[1])).tobytes(), 1, 2)
    bound = ngram_join.most_shared(len(a), len(b), *bits)
    assert bound == min(len(a) - in_a[0] + common[0, 1], len(b) - in_b[1] + common[0, 1]) and common[0, 0] == common[0, 1]
    assert not ngram_join._linked(bound, len(a), len(b), 80)
    assert ngram_join.most_shared(len(b), len(b), bits[1], bits[1]) == len(b)


def test_the_likeliest_pair_of_each_class_comes_first(spark):
    """Of a large group of near copies in a tile, one pair each, not all pairs, before components are known."""
    dice = np.random.default_rng(4)
    common, n = dice.integers(0, 2**62, 300), 60
    sets = [np.unique(np.concatenate((common, dice.integers(0, 2**62, 5 + k % 3))).astype(np.uint64)) for k in range(n)]
    rows = spark.createDataFrame([(7, k, k, len(x)) for k, x in enumerate(sets)], "shingle long, node long, root long, n int")
    bits = spark.createDataFrame([(k, ngram_join.signature(x).tobytes()) for k, x in enumerate(sets)], "node long, bits binary")
    every = {tuple(x) for x in ngram_join._tile_pairs(rows, bits, 85).collect()}
    first = {tuple(x) for x in ngram_join._tile_pairs(rows, bits, 85, nearest=True).collect()}
    assert len(every) == n * (n - 1) // 2 and first < every and len(first) <= 2 * n
    assert {x for pair in first for x in pair} == set(range(n))


def test_components_of_edges(spark):
    dice = random.Random(3)
    edges = [(dice.randrange(300), dice.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 440)]
    sets = defaultdict(set)
    for a, b in edges:
        sets[a].add(b)
        sets[b].add(a)
    want = {}
    for node in sets:
        seen, todo = {node}, [node]
        while todo:
            todo += (new := sets[todo.pop()] - seen)
            seen |= new
        if len(seen) > 1:
            want[node] = min(seen)
    found = ngram_join.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == want


def test_packing(docs, rows):
    table = packing.packed(docs).toPandas()
    for _, sequence in table.sort_values("offset").groupby("sequence_id"):
        lengths = sequence["length"].tolist()
        assert sequence["offset"].tolist() == [sum(lengths[:k]) for k in range(len(lengths))] and sum(lengths) <= 4096
    want = Counter()
    for i, text in rows:
        ids = np.array([*ids_of(text), 2], "<u4")
        for start in range(0, len(ids), 4096):
            part = ids[start : start + 4096]
            want[-1 if i is None else i, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    table["doc_id"] = table["doc_id"].fillna(-1).astype(int)
    assert Counter(map(tuple, table[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False))) == want


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(1).integers(1, 4096, 500)
    loads = np.bincount(packing.differencing(sizes, 40), sizes, minlength=40)
    assert loads.sum() == sizes.sum() and loads.max() - loads.min() < 60
    five = np.array([8, 7, 6, 5, 4])  # the textbook case: 8 - 7, 6 - 5, 4 - 1, 3 - 1
    assert sorted(np.bincount(packing.differencing(five, 2), five).tolist()) == [14, 16]
    window = packing.pack(sizes, 4096)
    assert np.bincount(window, sizes).max() <= 4096 and window.max() + 1 <= 1.04 * sizes.sum() / 4096 + 1
    assert packing.pack(np.array([], np.int64), 8).tolist() == [] and packing.pack(np.array([8, 8, 1]), 8).max() == 2


def test_classifier_learns_and_holds_out(spark):
    dice = random.Random(5)
    rows = []
    for k in range(400):
        good = k % 2
        words = [dice.choice(["alpha", "beta", "gamma", "delta"]) + str(dice.randrange(90)) * good for _ in range(60)]
        rows.append((k, ". ".join(words) if good else "### ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    held = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1}
    found = {r.doc_id: r for r in qda.quality(docs, labels).collect()}
    assert {k for k, r in found.items() if r.held_out} == held
    assert all(r.predicted == r.doc_id % 2 and r.predicted == (r.score >= 0.5) for r in found.values())
    flipped = spark.createDataFrame([(k, 1 - k % 2 if k in held else k % 2) for k, _ in rows], "doc_id long, quality int")
    assert all(abs(r.score - found[r.doc_id].score) < 1e-6 for r in qda.quality(docs, flipped).collect())


def test_density_is_the_gaussian_one():
    dice = np.random.default_rng(2)
    d = len(qda.NAMES)
    root = dice.normal(size=(2, d, d)) / 5 + np.eye(d)
    cov = root @ root.transpose(0, 2, 1)
    means, x = dice.normal(size=(2, d)), dice.normal(size=(7, d))
    model = qda.Model(means, np.linalg.cholesky(cov), np.log(np.linalg.det(cov)), np.log([0.3, 0.7]))
    density = [np.log(p) - 0.5 * (np.log(np.linalg.det(c)) + np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m))
               for p, c, m in zip([0.3, 0.7], cov, means, strict=True)]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(density[0] - density[1])))


def test_classifier_on_odd_rows(docs, rows, labels):
    found = qda.quality(docs, labels)
    assert found.count() == len(rows) and found.where("score IS NULL OR NOT score BETWEEN 0 AND 1").isEmpty()
    assert {r.score for r in qda.quality(docs, labels.limit(0)).collect()} == {0.5}


def test_id_files(docs, rows):
    documents = sorted((([-(10**9) if i is None else i][0], [*ids_of(t), 1]) for i, t in rows), key=lambda x: x[0])
    found = sorted(id_files.digest(docs).collect(), key=lambda r: r.start)
    assert [-(10**9) if r.doc_id is None else r.doc_id for r in found] == [i for i, _ in documents]
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens
    want = Counter((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for _, x in documents)
    assert Counter((r.n_tokens, r.ids_crc32) for r in found) == want


def test_coder_round_trip_and_damage():
    dice = np.random.default_rng(4)
    blocks = [dice.integers(0, 49408, n).astype(np.uint32) for n in (0, 1, 2, 700)]
    blocks += [np.full(9000, 7, np.uint32), (dice.zipf(1.3, 4000) % 49408).astype(np.uint32), np.tile(np.arange(50, dtype=np.uint32), 60)]
    coded = id_coder.encode(blocks, 49408)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, id_coder.decode(coded, 49408), strict=True))
    assert id_coder.decode([coded[5]], 49408)[0].tolist() == blocks[5].tolist()  # alone
    assert len(coded[4]) < 200 and len(coded[6]) < 600  # what is foreseen costs little
    broken = bytearray(coded[3])
    broken[40] ^= 1
    with pytest.raises(ValueError):
        id_coder.decode([bytes(broken)], 49408)


def test_id_files_are_decoded_once(docs):
    plan = id_files.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"MapInArrow open_\(", plan)) == 1


def test_coder_on_long_blocks_and_many():
    dice = np.random.default_rng(6)
    blocks = [dice.integers(0, 3, 40_000).astype(np.uint32), dice.integers(0, 1 << 20, 3000).astype(np.uint32)]
    blocks += [(dice.zipf(1.2, n) % 5000).astype(np.uint32) for n in dice.integers(0, 400, 1500)]
    found = id_coder.decode(id_coder.encode(blocks, 1 << 20), 1 << 20)
    assert all(a.tolist() == b.tolist() for a, b in zip(blocks, found, strict=True))
    with pytest.raises(ValueError):
        id_coder.encode(blocks, (1 << 20) + 1)


def test_coder_takes_few_steps_an_id():
    dice = np.random.default_rng(8)
    blocks = [(dice.zipf(1.3, 700) % 49408).astype(np.uint32) for _ in range(768)]
    took = []
    for _ in range(3):
        began = time.process_time()
        id_coder.decode(id_coder.encode(blocks, 49408), 49408)
        took.append((time.process_time() - began) / sum(map(len, blocks)))
    assert min(took) < 5e-6  # the older coder took some 10


def line_keys(text):
    return [lower(line.strip(WHITE)) for line in (text or "").split("\n")]


@pytest.mark.parametrize("keep_first", [False, True])
def test_line_dedup(docs, rows, keep_first):
    often = Counter(k for _, t in rows for k in set(line_keys(t)) - {""})
    order = sorted((0 if i is None else i, n) for n, (i, _) in enumerate(rows))
    first = {}
    for _, n in order:
        for k in line_keys(rows[n][1]):
            first.setdefault(k, 0 if rows[n][0] is None else rows[n][0])
    want = Counter()
    for i, text in rows:
        lines, kept, used = (text or "").split("\n"), [], set()
        for line, k in zip(lines, line_keys(text), strict=True):
            stays = often[k] < 10 or (keep_first and first[k] == (i or 0) and k not in used)
            used.add(k)
            if stays:
                kept.append(line)
        want[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    found = line_dedup.without_lines(line_dedup.keep_bitmaps(docs, keep_first=keep_first))
    assert got(found, "doc_id", "n_lines", "n_dropped", "kept") == want


def test_fingerprints(docs, rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    found = sorted(merkle.digest(docs).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want = Counter()
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        want[i, len(text), sha(edited), edited == text] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint == r.edited_fingerprint) for r in found) == want
    prints = defaultdict(set)
    for r in merkle.fingerprints(docs).collect():
        prints[r.text].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and len({min(p) for p in prints.values()}) == len(prints)
    assert all(0 <= x <= 1 for r in found for x in (r.near_edited, r.near_next))
    long = [r for r in found if r.n_chars > 1000 and r.doc_id not in (96, 97)]
    assert all(r.near_edited > 0.5 for r in long)


def test_fingerprint_finds_the_edit(spark):
    lines = [f"Line {k} says this, and that. It ends." for k in range(20)]
    other = list(lines)
    other[7] = "Line 7 says something else."
    a, b = "\n".join(lines), "\n".join(other)
    frame = merkle.fingerprints(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).orderBy("doc_id")
    one, two = [r.fingerprint for r in frame.collect()]
    pair = spark.createDataFrame([(one, two)], "one string, two string")
    from pyspark.sql import functions as F

    row = pair.select(merkle.differing_paragraphs(F.col("one"), F.col("two")).alias("x"), merkle.differing_paragraphs(F.col("one"), F.col("one")).alias("y")).first()
    paragraphs = [p.split(":")[0] for p in one.split("|")[2].split(";")]
    assert row.x == [paragraphs[7]] and row.y == []


def passages(rows, m=50):
    lists = [words_of(t) for _, t in rows]
    repeated = windows(lists, m)
    found = Counter()
    for (i, _), w in zip(rows, lists, strict=True):
        gone = covered(w, repeated, m)
        edges = [k for k in range(len(w) + 1) if (gone[k] if k < len(w) else False) != (gone[k - 1] if k else False)]
        found.update((i, a, b) for a, b in zip(edges[::2], edges[1::2], strict=True))
    return found


@pytest.mark.parametrize("bucket", [20_000, 1])
def test_suffix_dedup(docs, rows, bucket):
    assert got(suffix_dedup.repeated_passages(docs, bucket=bucket), "doc_id", "start_word", "end_word") == passages(rows)


def test_later_passages_are_cut(spark, rows):
    known = [(i, t) for i, t in dict((i, t) for i, t in rows if i is not None).items()]  # one row for each id
    seen, want = set(), {}
    for i, text in sorted(known):
        w = words_of(text)
        gone = [False] * len(w)
        for p in range(len(w) - 49):
            key = tuple(w[p : p + 50])
            if key in seen:
                gone[p : p + 50] = [True] * 50
            seen.add(key)
        if not w or not all(gone):
            want[i] = [a for a, g in zip(w, gone, strict=True) if not g]
    frame = spark.createDataFrame([(i, t, "x") for i, t in known], "doc_id long, text string, later string")
    found = suffix_dedup.without_later(frame)
    assert found.columns == frame.columns
    assert {r.doc_id: words_of(r.text) for r in found.collect()} == want
    texts = dict(known)
    assert all(r.text == texts[r.doc_id] for r in found.collect() if len(words_of(r.text)) == len(words_of(texts[r.doc_id])))


def test_automaton(docs, rows):
    want = Counter()
    for i, text in rows:
        ids = ids_of(text)
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))] += 1
    assert got(bpe_automaton.digest(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_automaton_and_library_agree_on_random_text():
    codec, by_library = bpe_automaton.Codec(vocabulary.read_vocabulary()), vocabulary.ChunkIds(vocabulary.read_vocabulary())
    dice = random.Random(1)
    pool = [*"abé́ßΩΣςİǅ1²½!_-$\x00\x7f\x85\xa0​ \x1c\x1f \n\t", "'s", "'LL", "中文", "😀", "ﬁ", "Å", "<|endoftext|>", "the", "ing", "が"]
    for k in range(4000):
        source = "abcdethinorsl" if k % 2 else pool
        text = "".join(dice.choice(source) for _ in range(dice.randint(1, 16)))
        ids = ids_of(text)
        assert codec.encode(text) == ids and codec.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False), text
        assert np.frombuffer(by_library(text.encode()), "<u4").tolist() == ids, text


def test_automaton_of_self_merges():
    """Merges of a symbol with itself apply from the left."""
    ids = {s: k for k, s in enumerate(["a", "b", "aa", "ab", "aaa", "aab"])}
    machine = bpe_automaton.Automaton(ids, [("a", "a"), ("a", "b"), ("aa", "a"), ("aa", "b")], "")
    names = {k: s for s, k in ids.items()}

    def merged(word):
        parts = list(word)
        for left, right in [("a", "a"), ("a", "b"), ("aa", "a"), ("aa", "b")]:
            k = 0
            while k < len(parts) - 1:
                if (parts[k], parts[k + 1]) == (left, right):
                    parts[k : k + 2] = [left + right]
                k += 1
        return parts

    for n in range(1, 9):
        for bits in range(2**n):
            word = "".join("ab"[bits >> k & 1] for k in range(n))
            assert [names[i] for i in machine.encode(word)] == merged(word), word


def test_memory_forgets_what_is_not_asked_for(monkeypatch):
    monkeypatch.setattr(vocabulary, "REMEMBERED", 3)
    made = []
    memory = vocabulary.Memory(lambda k: made.append(k) or k * 2)
    assert [memory[k] for k in "abcdabcaefghia"] == [k * 2 for k in "abcdabcaefghia"] and len(memory) + len(memory.former) <= 6


def test_ids_of_many_texts_look_each_piece_up_once(monkeypatch):
    """Different words and chunks are given to the model once, whatever texts they are in, and again only when forgotten."""
    import pyarrow as pa

    dice = random.Random(3)
    pieces = ["the", "The", "thing,", "don't", "été", "ÉTÉ.", "a1b2", "x--y", "中文", "it's", "<|endoftext|>", "\x1c", "", "\u00a0z"]
    texts = [None, "", *(" ".join(dice.choices(pieces, k=dice.randint(0, 30))) + dice.choice(["\n", "\x0b", ""]) for _ in range(300))]
    want = [np.array(ids_of(text or ""), "<u4").tobytes() for text in texts]
    given = pa.array([None if text is None else text.encode() for text in texts], pa.binary())
    by_library, asked = vocabulary.ChunkIds(vocabulary.read_vocabulary()), Counter()
    one = by_library._piece
    by_library._piece = lambda piece: asked.update([piece]) or one(piece)
    assert list(by_library.each(given)) == want
    assert max(asked.values()) == 1
    monkeypatch.setattr(vocabulary, "PART_BYTES", 40)
    monkeypatch.setattr(vocabulary, "PIECES_REMEMBERED", 6)
    assert list(by_library.each(given)) == want
    assert max(asked.values()) > 1 and len(by_library.known) == len(by_library.first) - 1 < 40


def test_the_automaton_reads_each_word_once(monkeypatch):
    """Texts are encoded a part at a time, and a word that was read is looked up; ids and labels are joined as the library has them."""
    import pyarrow as pa

    texts = [None, "", "the thing, the THE thing", "don't thing " * 3, "thing <|endoftext|> the", "été the\x1cthe thing"] * 3
    codec, read = bpe_automaton.Codec(vocabulary.read_vocabulary()), Counter()
    one = codec.automaton.encode
    codec.automaton.encode = lambda word: read.update([word]) or one(word)
    monkeypatch.setattr(vocabulary, "PART_BYTES", 50)
    ids = list(codec.each(pa.array([None if t is None else t.encode() for t in texts], pa.binary())))
    want = [ids_of(t or "") for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == want
    assert read["the"] == read["thing"] == 1 == max(read.values())
    counts, numbers, labels = (x.to_pylist() for x in codec.joined(ids))
    assert counts == list(map(len, want)) and numbers == [" ".join(map(str, x)) for x in want]
    assert labels == list(map(codec.decode, want)) and labels[0] == ""


def test_minimisers_are_in_every_run():
    dice = np.random.default_rng(6)
    import pyarrow as pa

    texts = [" ".join(f"v{x}" for x in dice.integers(0, 30, n)) for n in (0, 5, 35, 36, 300, 34)] + ["z " * 80]
    words = W.words_of(pa.array(texts))
    hashes = W.word_hashes(words)
    at = set(W.minimisers(words, W.window_hashes(hashes, 9), 9, 35).tolist())
    for low, high in zip(words.first, words.first[1:], strict=False):
        for p in range(low, high - 34):
            assert any(q in at for q in range(p, p + 27))
        assert high - low >= 35 or not any(low <= q < high for q in at)
    assert len({h for h, t in zip(hashes.tolist(), words.text, strict=True)}) == len({w for t in texts for w in t.split()})


def test_empty_tables(empty, labels):
    for frame in (
        substring_dedup.digest(empty), quality_rules.quality_rules(empty), ngram_join.digest(empty), packing.packed(empty),
        qda.quality(empty, labels), id_files.digest(empty), line_dedup.digest(empty), merkle.digest(empty),
        suffix_dedup.repeated_passages(empty), bpe_automaton.digest(empty),
    ):
        assert frame.isEmpty()
