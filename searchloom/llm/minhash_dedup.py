"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

A document's set is its different 5-word shingles. Every member is thrown once into each slot, by a random permutation
of its own, at step 0, 1, 2, ...; a slot keeps the least (step, random rank) that falls in it. So slots are
correlated, each member is drawn without replacement, and estimates vary less than those of independent hashes. All
members of a batch take a step together, hence a slot is settled in the first step that reaches it, and a
document stops as soon as all its slots are: long texts after one or two steps.

1. Signatures, one pass. Equal sets are one class (128-bit hash), whatever the number of copies.
2. Banding: ``BANDS`` hashes of ``ROWS`` slots each (two sets of similarity 0.85 share none with a chance of 2e-8).
3. Each class is paired with the smallest one of each of its buckets: as many pairs as rows. Agreement of signatures
   (far below what 0.85 allows: dropped) and then the full sets decide; links are united by pointer jumping.
4. Buckets in which several components are left: a second star around the class with the most links.
5. Where components still meet, their classes are compared in tiles of 512, all that aren't in the bucket's largest
   component with each other and with that one; signatures and bitmaps leave few pairs, whose full sets decide in the
   task. A pair of tiles returns at most as many links as it has rows.

No partner is dropped anywhere; the one inexact step is the banding. Hubs' partners are dealt to several tasks, and buckets are
counted with partial sums. The last join meets rows with classes on keys that may be hot (copies); Spark splits those.

Defined cases: null or empty text and text without words have an empty set, link with nothing and are kept; under five
words the sequence is one shingle; repeated rows are in one class; a row with a null id is linked like any other, its
component's id is the smallest that isn't null, and it is kept only if there is none; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.llm import stars
from searchloom.llm import words as W
from searchloom.llm.ngram_join import SET, components, most_shared
from searchloom.llm.rows import texts_of
from searchloom.llm.shingles import all_sets
from searchloom.storage import written

K = 5
PERCENT = 85
BANDS = 30
ROWS = 5
SLOTS = BANDS * ROWS
SLACK = 0.19  # agreement may fall short of the similarity by this much (chance under 1e-7)
DOCS_AT_ONCE = 4096
TILE = 512
BITS = 4096
EMPTY = np.uint64(2**64 - 1)


def super_minhash(members: np.ndarray, first: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (a row of ``slots`` numbers each) of sets of hashes, one set after the other from ``first`` on."""
    n_sets = len(first) - 1
    signature = np.full(n_sets * slots, EMPTY, np.uint64)
    seeds, of = members, np.repeat(np.arange(n_sets), np.diff(first))
    order = None  # permutations of the members that are still thrown
    for step in range(slots):
        random = W.mix(seeds + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % 2**64))
        place = step + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = place
        else:
            rows = np.arange(len(seeds))
            slot = order[rows, place].astype(np.int64)
            order[rows, place] = order[:, step]
        np.minimum.at(signature, of * slots + slot, np.uint64(step << 32) | random >> np.uint64(32))
        going = (signature.reshape(n_sets, slots) == EMPTY).any(axis=1)[of]
        if not going.any():
            break
        seeds, of = seeds[going], of[going]
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(seeds), 1))
            order[np.arange(len(seeds)), place[going]] = 0
        else:
            order = order[going]
    return signature.reshape(n_sets, slots)


def signed_rows(texts: DataFrame, k: int = K) -> DataFrame:
    """``doc_id``, ``id``, ``tag``, the set's size ``n`` and hashes ``s1``, ``s2``, its signature ``sig`` (16 bits a slot) and
    a bitmap of its members ``bits``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, piece in W.pieces(batch.column(3)):
                for low in range(0, len(piece), DOCS_AT_ONCE):
                    part = piece.slice(low, DOCS_AT_ONCE)
                    members, first = all_sets(part, k)
                    slots = W.mix(super_minhash(members, first)).astype("<u2")
                    checks = []
                    for values in (members, W.mix(members ^ np.uint64(0xA5A5A5A5A5A5A5A5))):
                        summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
                        checks.append(pa.array(W.signed(summed[first[1:]] - summed[first[:-1]])))
                    bits = np.zeros((len(part), BITS), np.uint8)
                    bits[np.repeat(np.arange(len(part)), np.diff(first)), (members & np.uint64(BITS - 1)).astype(np.int64)] = 1
                    own = batch.slice(row + low, len(part))
                    yield pa.record_batch(
                        [
                            *own.columns[:3], pa.array(np.diff(first).astype(np.int32)), *checks,
                            *(pa.array([x.tobytes() for x in rows], pa.binary()) for rows in (slots, np.packbits(bits, axis=1))),
                        ],
                        ["doc_id", "id", "tag", *SET, "sig", "bits"],
                    )

    return texts.select("doc_id", "id", "tag", "text").mapInArrow(
        sign, "doc_id long, id long, tag long, n int, s1 long, s2 long, sig binary, bits binary"
    )


def _slots(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), -1)


def bands(classes: DataFrame, rows: int = ROWS) -> DataFrame:
    """``bucket``, ``band`` (its number) and ``node``: one row per band of each signature."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = _slots(batch.column(1)).astype(np.uint64)
            count = slots.shape[1] // rows
            numbered = W.mix(slots + np.uint64(1)) * W.powers(rows, 5)[np.arange(slots.shape[1]) % rows]
            hashed = numbered.reshape(len(batch), count, rows).sum(axis=2, dtype=np.uint64) + np.arange(count, dtype=np.uint64)
            node = np.repeat(batch.column(0).to_numpy(), count)
            band = np.tile(np.arange(count, dtype=np.int32), len(batch))
            yield pa.record_batch([pa.array(W.signed(W.mix(hashed)).ravel()), pa.array(band), pa.array(node)], ["bucket", "band", "node"])

    return classes.select("node", "sig").mapInArrow(cut, "bucket long, band int, node long")


def _near(percent: int):
    """Whether sizes and agreement of 16-bit slots leave a link possible."""

    def allowed(n_a, n_b, agreeing, slots: int):
        return (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)) & (agreeing >= slots * (percent / 100 - SLACK))

    return allowed


def by_signature(percent: int):
    """A test of :func:`stars.tested` on signatures."""
    allowed = _near(percent)

    def make() -> stars.Test:
        def near(hub: int, n: int, payload: bytes, others: pa.Array, sizes: np.ndarray) -> np.ndarray:
            mine, theirs = np.frombuffer(payload, "<u2"), _slots(others)
            return allowed(n, sizes, (theirs == mine).sum(axis=1), len(mine))

        return near

    return make


def _apart(met: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows ``bucket``, ``band``, ``node``, ``root`` of the buckets in which several components meet; of those with the same
    classes the one of the first band."""
    rooted = met.select("bucket", "band", "node").join(roots, "node", "left").select("bucket", "band", "node", F.coalesce("root", "node").alias("root"))
    rooted = written(rooted, "rooted")
    several = rooted.groupBy("bucket", "band").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("count"),
        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("one"), F.sum(F.hash("node").cast("long")).alias("two"),
    ).where("low <> high").groupBy("count", "one", "two").agg(F.min(F.struct("band", "bucket")).alias("one_of"))
    return written(rooted.join(written(several.select("one_of.bucket"), "apart"), "bucket", "left_semi"), "apart-rows")


def _tile_links(rows: DataFrame, classes: DataFrame, bodies: DataFrame, k: int, percent: int) -> DataFrame:
    """Links ``a``, ``b`` between classes of different components that meet in a bucket: enough of them to unite those that are linked.

    ``rows``: ``bucket``, ``band``, ``node``, ``root``. In each bucket the largest component's classes are compared only with
    the others; a tile is a hash slice of either kind, and a pair of tiles one group. Two classes are looked at in the
    first band that they share; sizes, signatures and bitmaps (a bit that only one set has is a member that the other
    lacks) leave few pairs, whose full sets decide, unless links of the group unite them already.
    """
    sizes = rows.groupBy("bucket", "root").agg(F.count("*").alias("size"))
    major = sizes.groupBy("bucket").agg(
        F.max_by("root", F.struct("size", "root")).alias("major"), F.max("size").alias("many"), F.sum("size").alias("all")
    )
    kinds = rows.join(major, "bucket").withColumns({
        "few": F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("many")) / TILE)).cast("int"),
        "lots": F.ceil(F.col("many") / TILE).cast("int"), "rest": F.col("root") != F.col("major"),
    })
    tile = F.pmod(F.xxhash64("node"), F.when(F.col("rest"), F.col("few")).otherwise(F.col("lots"))).cast("int")

    def pair(x, y, second: bool):
        return F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), F.lit(second).alias("second"))

    def up_to(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    mine = F.col("tile")
    with_rest = F.concat(
        F.transform(F.sequence(mine, F.col("few") - 1), lambda y: pair(mine, y, False)),
        F.transform(up_to(mine), lambda x: pair(x, mine, True)),
        F.transform(up_to(F.col("lots")), lambda y: pair(mine, -1 - y, False)),
    )
    with_major = F.transform(up_to(F.col("few")), lambda x: pair(x, -1 - mine, True))
    groups = kinds.withColumn("tile", tile).withColumn("pairs", F.when(F.col("rest"), with_rest).otherwise(with_major))
    payloads = classes.select("node", "n", "sig", "bits").join(bodies.select("node", F.col("payload").alias("body")).hint("merge"), "node")
    sent = groups.select("bucket", "band", "node", "root", F.explode("pairs").alias("pair")).join(payloads.hint("merge"), "node").select(
        "bucket", "pair.x", "pair.y", "pair.second", "band", "node", "root", "n", "sig", "bits", "body"
    )
    allowed = _near(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: list[pa.RecordBatch] = []

        def close() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            second = table.column(3).to_numpy(zero_copy_only=False)
            band = table.column(4)[0].as_py()
            node, root, n = (table.column(i).to_numpy() for i in (5, 6, 7))
            slots = _slots(table.column(8))
            bits = np.frombuffer(b"".join(table.column(9).to_pylist()), np.uint64).reshape(len(node), -1)
            inside = table.column(1)[0].as_py() == table.column(2)[0].as_py()
            one = np.flatnonzero(~second)
            other = one if inside else np.flatnonzero(second)
            above = {r: r for r in root.tolist()}
            sets: dict[int, np.ndarray] = {}

            def top(r: int) -> int:
                while above[r] != r:
                    above[r] = r = above[above[r]]
                return r

            def members(i: int) -> np.ndarray:
                if i not in sets:
                    sets[i] = all_sets(pa.array([unpack(table.column(10)[i].as_py()).decode()]), k)[0]
                return sets[i]

            links: list[tuple[int, int]] = []
            for low in range(0, len(one), 64):
                left = one[low : low + 64]
                agreeing = (slots[left, None] == slots[None, other]).sum(axis=2)
                i, j = np.nonzero(allowed(n[left, None], n[None, other], agreeing, slots.shape[1]) & (root[left, None] != root[None, other]))
                a, b = left[i], other[j]
                shared = (slots[a] == slots[b]).reshape(len(a), slots.shape[1] // ROWS, ROWS).all(axis=2)
                first = (shared.argmax(axis=1) == band) & shared[np.arange(len(a)), band] & (~np.bool_(inside) | (a < b))
                a, b = a[first], b[first]
                most = most_shared(n[a].astype(np.int64), n[b].astype(np.int64), bits[a], bits[b])
                possible = 100 * most >= percent * (n[a] + n[b] - most)
                for x, y in zip(a[possible].tolist(), b[possible].tolist(), strict=True):
                    r, s = top(int(root[x])), top(int(root[y]))
                    if r != s:
                        both = len(np.intersect1d(members(x), members(y), assume_unique=True))
                        if 100 * both >= percent * (int(n[x]) + int(n[y]) - both):
                            above[max(r, s)] = min(r, s)
                            links.append((int(node[x]), int(node[y])))
            yield pa.record_batch([pa.array([x[c] for x in links], pa.int64()) for c in (0, 1)], ["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            keys = [batch.column(c).to_numpy() for c in (0, 1, 2)]
            edges = [0, *(np.flatnonzero(np.any([key[1:] != key[:-1] for key in keys], axis=0)) + 1).tolist(), len(batch)]
            for low, high in zip(edges, edges[1:], strict=False):
                part = batch.slice(low, high - low)
                if held and any(held[-1].column(c)[0].as_py() != part.column(c)[0].as_py() for c in (0, 1, 2)):
                    yield from close()
                    held = []
                held.append(part)
        if held:
            yield from close()

    runs = sent.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    return runs.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = K, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``id``, ``tag``, ``n_shingles``, ``component_id``, ``kept``.

    ``id`` and ``tag`` name the row as in :func:`searchloom.llm.rows.texts_of`.
    """
    texts = texts_of(docs, doc_id, text)
    rows = written(signed_rows(texts, k), "minhash-rows")
    classes = rows.where("n > 0").groupBy(*SET).agg(
        F.min("doc_id").alias("first"), F.min(F.struct("id", "tag")).alias("row"), F.min("sig").alias("sig"),
        F.min("bits").alias("bits"),
    )
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "minhash-classes")
    signatures = classes.select("node", "n", F.col("sig").alias("payload"))

    banded = bands(classes)
    meeting = banded.groupBy("bucket").agg(F.count("*").alias("count"), F.min("node").alias("hub")).where("count > 1")
    met = written(banded.join(meeting.select("bucket", "hub"), "bucket"), "minhash-buckets")
    pairs = written(met.where("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "minhash-pairs")

    def bodies_of(nodes: DataFrame) -> DataFrame:
        return stars.bodies(texts, classes.join(nodes.distinct(), "node").select("node", "n", "row.id", "row.tag"))

    def linked(pairs: DataFrame) -> DataFrame:
        near = written(stars.tested(pairs, signatures, by_signature(percent)), "minhash-near")
        nodes = near.select(F.col("a").alias("node")).union(near.select("b"))
        return written(stars.tested(near, bodies_of(nodes), stars.by_members(k, percent)), "minhash-links")

    links = linked(pairs)
    roots = components(links)
    rest = _apart(met, roots)
    if not rest.isEmpty():
        degrees = links.select(F.col("a").alias("node")).unionAll(links.select("b")).groupBy("node").agg(F.count("*").alias("degree"))
        ranked = rest.join(degrees, "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
        best = ranked.groupBy("bucket").agg(F.max_by(F.struct("node", "root"), F.struct("degree", "node")).alias("best"))
        second = rest.join(best, "bucket").where("root <> best.root").select(F.col("best.node").alias("a"), F.col("node").alias("b")).distinct()
        second = written(second.join(pairs, ["a", "b"], "left_anti"), "minhash-pairs")
        links = written(links.unionByName(linked(second)), "minhash-links")
        roots = components(links)
        rest = _apart(met, roots)
        if not rest.isEmpty():
            third = _tile_links(rest, classes, bodies_of(rest.select("node")), k, percent)
            links = links.unionByName(written(third, "minhash-links"))
            roots = components(links)

    named = classes.select(*SET, "node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(named.join(smallest, "root").select(*SET, "component_id"), "minhash-named")
    joined = rows.select("doc_id", "id", "tag", *SET).join(named.withColumn("found", F.lit(True)).hint("merge"), SET, "left")
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "id", "tag", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op12."""
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
