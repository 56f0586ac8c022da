"""N-gram Jaccard join: which documents share 85 % of their 4-word shingles, and the groups they form.

A document's set is its different shingles, as 64-bit hashes. Equal sets are one class from the start (a 128-bit
hash of the set), with one row whatever the number of copies. Classes meet where they share a shingle of their
prefix: of a set of n, the first ``n - ceil(0.85 n) + 1`` in an order that is the same for all, since two linked
sets can't miss each other there. Any order is right; shingles that are frequent in a sample of the documents
come last, which keeps the meetings small. The sample is 1/64 of the documents and only sets this order; what is
kept of it is bounded by the threshold (shingles in 1/1000 of the documents: at most 1000 times the mean set size).

1. At each shared shingle every class is paired with the one of smallest id: as many pairs as rows.
2. Pairs are verified: size, then the bound by bitmaps (a bit a member, 1024 bits at least; a bit that only one set has is
   a member that the other lacks; the wider one is folded), then the intersection of the sorted arrays. Links make components.
3. Shingles at which several components still meet: their classes, sorted by size, are cut into tiles; only tiles
   whose size bands can hold linked sets are compared, all signatures of one with all of the other, and pairs of
   different components that the bit counts allow are verified as before: each class's likeliest partner in a tile first,
   then, with the components that this makes, all.

So all links count towards the components, though links inside a component needn't be spelt out. Sets are made once;
texts travel deflated, those of classes that may be linked alone, and a hub's once per few thousand of its partners
(:mod:`searchloom.llm.stars`); every meeting is counted before it is joined.

Defined cases: null text, empty text and text without words have an empty set, link with nothing and form their
own component; fewer than four words are one shingle; repeated rows are in one class; a row with a null id is linked
like any other, and null is never the smallest id; an empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchloom.llm import stars
from searchloom.llm import words as W
from searchloom.llm.rows import keys_of, texts_of, unused
from searchloom.llm.shingles import K, all_sets
from searchloom.storage import written

PERCENT = 85
SAMPLE = 64
HOT = 1000
BITS = 1024
BYTES_AT_ONCE = 512  # of the bitmaps of two tiles
TILE = 512
SET = ["n", "s1", "s2"]


def needed(size, percent: int):
    """Members that sets of this size must share to be linked."""
    return -(-percent * size // 100)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return W.signed(summed[first[1:]] - summed[first[:-1]])


def set_rows(texts: DataFrame, k: int, percent: int, hot) -> DataFrame:
    """``doc_id``, ``id``, ``tag``, the set's size ``n`` and hashes ``s1``, ``s2``, its prefix in the order given by ``hot`` (a
    broadcast of sorted shingles and their frequency) and its bitmap ``bits``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in W.pieces(batch.column(2)):
                values, first = all_sets(part, k)
                sizes = np.diff(first)
                own = batch.slice(row, len(part))
                columns = [
                    *own.columns[:2], own.column(3), pa.array(sizes.astype(np.int32)), pa.array(_sums(values, first)),
                    pa.array(_sums(W.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)),
                ]
                frequent, counts = hot.value
                text = np.repeat(np.arange(len(part)), sizes)
                count = np.zeros(len(values), np.int64)
                if len(frequent):
                    place = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
                    count = np.where(frequent[place] == values, counts[place], 0)
                lengths = np.where(sizes > 0, sizes - needed(sizes, percent) + 1, 0)
                order = np.lexsort((values, count, text))
                chosen = values[order][np.arange(len(values)) - first[text] < lengths[text]]
                wide = widths(sizes)
                low = np.concatenate(([0], np.cumsum(wide)))
                bits = np.zeros(low[-1], np.uint8)
                bits[low[text] + (values.view(np.int64) & (wide[text] - 1))] = 1
                bits, low = np.packbits(bits).tobytes(), (low // 8).tolist()
                ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                columns += [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(W.signed(chosen))),
                    pa.array([bits[a:b] for a, b in zip(low, low[1:], strict=False)], pa.binary()),
                ]
                yield pa.record_batch(columns, ["doc_id", "id", "tag", *SET, "prefix", "bits"])

    return texts.select("doc_id", "id", "text", "tag").mapInArrow(
        find, "doc_id long, id long, tag long, n int, s1 long, s2 long, prefix array<long>, bits binary"
    )


def frequent_shingles(texts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in 1/``HOT`` or more of a sample of the documents, sorted, and their counts there."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in W.pieces(batch.column(0)):
                yield pa.record_batch([pa.array(W.signed(all_sets(part, k)[0]))], ["shingle"])

    sample = texts.where(F.pmod(F.xxhash64("text", "id"), F.lit(SAMPLE)) == 0).select("text")
    least = max(3, sample.count() // HOT)
    found = sample.mapInArrow(members, "shingle long").groupBy("shingle").count().where(F.col("count") >= least).toArrow()
    shingles = found.column(0).to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], found.column(1).to_numpy()[order]


def widths(sizes: np.ndarray) -> np.ndarray:
    """Bits of the bitmaps of sets of these sizes: the next power of two, so that no bitmap fills up, and ``BITS`` at least."""
    return np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))


def signature(members: np.ndarray) -> np.ndarray:
    """The set's bitmap."""
    wide = int(widths(np.array([len(members)]))[0])
    bits = np.zeros(wide, np.uint8)
    bits[(members & np.uint64(wide - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.uint64)


def folded(bits: np.ndarray, n: int) -> np.ndarray:
    """Bitmaps (along the last axis), folded to ``n`` of their units."""
    return bits if bits.shape[-1] == n else np.bitwise_or.reduce(bits.reshape(*bits.shape[:-1], -1, n), axis=-2)


def most_shared(size_a, size_b, bits_a: np.ndarray, bits_b: np.ndarray):
    """An upper bound of the members that sets share, from their sizes and bitmaps."""
    least = min(bits_a.shape[-1], bits_b.shape[-1])
    bits_a, bits_b = folded(bits_a, least), folded(bits_b, least)
    only_a = np.bitwise_count(bits_a & ~bits_b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(bits_b & ~bits_a).sum(axis=-1, dtype=np.int64)
    return np.minimum(size_a - only_a, size_b - only_b)


def shared_bits(one: bytes, other: bytes, n_one: int, n_other: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits that each of ``n_one`` bitmaps has in common with each of ``n_other``, at the smaller width; and the bits of each."""
    a, b = np.frombuffer(one, np.uint8).reshape(n_one, -1), np.frombuffer(other, np.uint8).reshape(n_other, -1)
    wide = min(a.shape[1], b.shape[1])
    a, b = folded(a, wide), folded(b, wide)
    common = np.zeros((n_one, n_other), np.float32)
    for low in range(0, wide, BYTES_AT_ONCE):
        x, y = (np.unpackbits(m[:, low : low + BYTES_AT_ONCE], axis=1).astype(np.float32) for m in (a, b))
        common += x @ y.T
    return common.astype(np.int64), *(np.bitwise_count(m).sum(axis=1, dtype=np.int64) for m in (a, b))


def _linked(shared, size_a, size_b, percent: int):
    return 100 * shared >= percent * (size_a + size_b - shared)


def by_bitmap(percent: int):
    """A test of :func:`searchloom.llm.stars.tested`: whether sizes and bitmaps leave a link possible."""

    def make() -> stars.Test:
        def near(hub: int, n: int, payload: bytes, others: pa.Array, sizes: np.ndarray) -> np.ndarray:
            sizes, mine = sizes.astype(np.int64), np.frombuffer(payload, np.uint64)[None]
            near = 100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes)
            units = pc.binary_length(others).to_numpy() // 8
            for wide in np.unique(units[near]).tolist():
                rows = np.flatnonzero(near & (units == wide))
                theirs = np.frombuffer(b"".join(others.take(pa.array(rows)).to_pylist()), np.uint64).reshape(len(rows), wide)
                near[rows] = _linked(most_shared(n, sizes[rows], mine, theirs), n, sizes[rows], percent)
            return near

        return near

    return make


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that it is connected with, of all nodes that have an edge ``a``, ``b``."""
    edges = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    mapping = written(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0), "mapping")
    first = True
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "parents")
        while True:
            over = up.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = written(
                up.join(over, "root").select("node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "parents"
            )
            up = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if first:
            mapping, first = up, False
        else:
            over = up.select(F.col("node").alias("root"), F.col("root").alias("above"))
            mapping = written(
                mapping.join(over, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "mapping"
            )
        ends = [up.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b")]
        edges = written(
            edges.join(ends[0], "a").join(ends[1], "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
            .where("a <> b").distinct(), "edges",
        )
    return mapping


def _apart(met: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows ``shingle``, ``node``, ``n``, ``root`` of shingles at which several components meet; one of those met by the same classes."""
    with_roots = met.join(roots, "node", "left").select("shingle", "node", "n", F.coalesce("root", "node").alias("root"))
    with_roots = written(with_roots, "rooted")
    apart = with_roots.groupBy("shingle").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("count"),
        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("one"), F.sum(F.hash("node").cast("long")).alias("two"),
    ).where("low <> high").groupBy("count", "one", "two").agg(F.min("shingle").alias("shingle"))
    return with_roots.join(written(apart.select("shingle"), "apart"), "shingle", "left_semi")


def _tile_pairs(rows: DataFrame, signatures: DataFrame, percent: int, nearest: bool = False) -> DataFrame:
    """Pairs of different components among classes that meet at a shingle, which sizes and bitmaps allow.

    ``rows``: ``shingle``, ``node``, ``root``, ``n``; ``signatures``: ``node``, ``bits``. With ``nearest``, of each class's pairs
    in a tile only the likeliest one.
    """
    by_size = Window.partitionBy("shingle").orderBy("n", "node")
    tiled = written(
        rows.withColumn("tile", F.floor((F.row_number().over(by_size) - 1) / TILE).cast("int")), "tiled"
    )
    bands = tiled.groupBy("shingle", "tile").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    later = bands.select("shingle", F.col("tile").alias("tile_b"), F.col("least").alias("least_b"))
    compared = bands.join(later, "shingle").where(
        (F.col("tile_b") >= F.col("tile")) & (F.col("least_b") * percent <= F.col("most") * 100)
    ).select("shingle", "tile", "tile_b")
    members = tiled.join(signatures.select("node", "bits"), "node")
    left = members.join(compared, ["shingle", "tile"]).select(
        "shingle", "tile", "tile_b", F.lit(False).alias("second"), "node", "root", "n", "bits"
    )
    right = members.withColumnRenamed("tile", "tile_b").join(compared.where("tile <> tile_b"), ["shingle", "tile_b"]).select(
        "shingle", "tile", "tile_b", F.lit(True).alias("second"), "node", "root", "n", "bits"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            node, root, n = (table.column(i).to_numpy() for i in (4, 5, 6))
            second = table.column(3).to_numpy(zero_copy_only=False)
            maps = np.array(table.column(7).to_pylist(), object)
            units = pc.binary_length(table.column(7)).to_numpy().astype(np.int64)
            inside = table.column(1)[0].as_py() == table.column(2)[0].as_py()
            left, right = (np.arange(len(node)),) * 2 if inside else (np.flatnonzero(~second), np.flatnonzero(second))
            for x, y in product(np.unique(units[left]).tolist(), np.unique(units[right]).tolist()):
                one, other = left[units[left] == x], right[units[right] == y]
                n_one, n_other = n[one, None].astype(np.int64), n[None, other].astype(np.int64)
                allowed = (root[one, None] != root[None, other]) & (np.minimum(n_one, n_other) * 100 >= percent * np.maximum(n_one, n_other))
                if not allowed.any():
                    continue
                common, in_one, in_other = shared_bits(b"".join(maps[one]), b"".join(maps[other]), len(one), len(other))
                most = np.minimum(n_one - in_one[:, None] + common, n_other - in_other + common)
                allowed &= _linked(most, n_one, n_other, percent)
                if nearest:
                    like = np.where(allowed, most / (n_one + n_other - most), 0)
                    allowed &= (np.arange(len(other)) == like.argmax(axis=1)[:, None]) | (np.arange(len(one))[:, None] == like.argmax(axis=0))
                i, j = np.nonzero(allowed)
                a, b = node[one[i]], node[other[j]]
                once = a < b if inside else a != b
                yield pa.record_batch([pa.array(np.minimum(a, b)[once]), pa.array(np.maximum(a, b)[once])], ["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            keys = [batch.column(c).to_numpy() for c in (0, 1, 2)]
            cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            edges = [0, *cuts.tolist(), len(batch)]
            for low, high in zip(edges, edges[1:], strict=False):
                part = batch.slice(low, high - low)
                if held and any(held[-1].column(c)[0].as_py() != part.column(c)[0].as_py() for c in (0, 1, 2)):
                    yield from close()
                    held = []
                held.append(part)
        if held:
            yield from close()

    runs = left.unionByName(right).repartition("shingle", "tile", "tile_b").sortWithinPartitions("shingle", "tile", "tile_b")
    return runs.mapInArrow(compare, "a long, b long")


def similar_components(docs: DataFrame, k: int = K, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``id``, ``tag``, ``n_shingles``, ``component_id``, ``root``.

    ``component_id`` is the smallest id that links lead to, its own included; ``id`` and ``tag`` name the row as in
    :func:`searchloom.llm.rows.texts_of`; ``root`` names the component (null for empty sets).
    """
    texts = texts_of(docs, doc_id, text)
    hot = docs.sparkSession.sparkContext.broadcast(frequent_shingles(texts, k))
    sets = written(set_rows(texts, k, percent, hot), "set-rows")
    classes = sets.where("n > 0").groupBy(*SET).agg(
        F.min("doc_id").alias("first"), F.min(F.struct("id", "tag")).alias("row"), F.min("prefix").alias("prefix"), F.min("bits").alias("bits")
    )
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    signatures = classes.select("node", "n", F.col("bits").alias("payload"))

    def linked(near: DataFrame) -> DataFrame:
        nodes = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
        bodies = stars.bodies(texts, classes.join(nodes, "node").select("node", "n", "row.id", "row.tag"))
        return written(stars.tested(near, bodies, stars.by_members(k, percent)), "links")

    rows = classes.select("node", "n", F.explode("prefix").alias("shingle")).repartition("shingle")  # shuffled once, for both uses
    meeting = rows.groupBy("shingle").agg(F.count("*").alias("count"), F.min("node").alias("hub"), F.max("n").alias("most"))
    meeting = meeting.where("count > 1 AND most > 0")  # with all columns asked for, both uses are of one shuffle
    met = written(rows.join(meeting.select("shingle", "hub"), "shingle"), "met")
    pairs = written(met.where("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = linked(written(stars.tested(pairs, signatures, by_bitmap(percent)), "possible"))
    roots = components(links)

    rest = _apart(met, roots)
    if not rest.isEmpty():  # each class with the likeliest one of its tile first: what is nearly alike is one component before all pairs
        again = _tile_pairs(rest, classes.select("node", "bits"), percent, nearest=True).distinct()
        again = written(again.join(pairs, ["a", "b"], "left_anti"), "pairs")
        found = linked(again)
        if not found.isEmpty():
            links = written(links.unionByName(found), "links")
            roots = components(links)
            rest = _apart(met, roots)
        pairs = pairs.unionByName(again)
        more = written(_tile_pairs(rest, classes.select("node", "bits"), percent).distinct().join(pairs, ["a", "b"], "left_anti"), "tile-pairs")
        found = linked(more)
        if not found.isEmpty():
            links = links.unionByName(found)
            roots = components(links)

    named = classes.select(*SET, "node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(named.join(smallest, "root").select(*SET, "root", "component_id"), "named")
    return sets.select("doc_id", "id", "tag", *SET).join(named.hint("merge"), SET, "left").select(
        "doc_id", "id", "tag", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "root",
    )


def one_of_each_group(docs: DataFrame, k: int = K, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one of smallest id; all columns stay as they are.

    A component is named by its root, so rows without an id, or with the same one, are lost only to a row they are
    linked with. Repeated rows (same id and text) are one document; rows without a word all stay.
    """
    found = similar_components(docs, k, percent, doc_id, text).where("n_shingles > 0")
    id_, tag = unused(docs, "id", "tag")
    stays = written(found.groupBy("root").agg(F.min(F.struct("id", "tag")).alias("row")), "stays")
    stays = stays.select(F.col("row.id").alias(id_), F.col("row.tag").alias(tag))
    keys = docs.withColumns(dict(zip((id_, tag), keys_of(docs, doc_id, text), strict=True)))
    worded = F.coalesce(F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    chosen = keys.where(worded).join(stays.hint("merge"), [id_, tag], "left_semi").dropDuplicates([id_, tag])
    return chosen.unionByName(keys.where(~worded)).select(*(f"`{c}`" for c in docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op3."""
    return similar_components(docs).select("doc_id", "n_shingles", "component_id")
