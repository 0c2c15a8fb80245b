"""Links between sets of word shingles: SimHash proposes, the exact similarity decides.

A set's fingerprint has ``WORDS`` words of 64 bits.  Two sets of the similarity
differ in a bit with a known chance, so a plan of masks and a limit find them
with a known chance too: ``plan`` takes as many masks as miss fewer than
``MISS`` of such pairs.  Masks have more bits the more sets there are, so that
groups of sets that are not alike stay small.

A shard of groups is one index in Gray order over each set's first two words.
Groups of more than ``GROUP`` are cut into chunks first.  Only components matter,
so not all pairs of a cluster are tried: a group with few pairs within the limit
gives them all and is done; in others each member goes with the member that has
most near ones, or with its nearest if that is not near.  The sets of groups that are then still apart
are linked exactly (``exact_links``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.components import connected_components
from lexmill.llm.exact_links import candidate_links
from lexmill.llm.gray import GrayIndex, fingerprints, runs, words_of
from lexmill.llm.shards import shards
from lexmill.llm.shingles import shingle_sets
from lexmill.storage import discard, materialize

WORDS = 10
#: Sets of a group that a plan aims at, and most that one task compares with each other.
WANTED, GROUP = 64, 2_048
MISS = 0.002
#: Sets from this size on differ in hardly more bits than the angle between them says.
LARGE = 64
#: A group with at most so many pairs a member gives all of them; in others a member gives a pair on one in so many masks.
FEW, SPARE = 2, 4
#: Pairs that a task keeps rather than search again.
KEPT = 1 << 21
#: Flags that tell which sets are on a pair.
SLOTS = 1 << 23


def bit_chance(similarity: float) -> float:
    """Chance that a fingerprint bit of two sets of the similarity differs.

    The angle between the sets over pi, and an eighth more for small sets.
    """
    return min(0.5, 1.125 * math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi)


def limit_for(bits: int, chance: float, miss: float) -> int:
    """Least limit that so many bits, each different with the chance, pass with a chance below ``miss``."""
    left, mass = 1.0, (1 - chance) ** bits
    for k in range(bits):
        left -= mass
        if left < miss:
            return k
        mass *= (bits - k) / (k + 1) * chance / (1 - chance)
    return bits


def plan(count: int, similarity: float) -> tuple[list[tuple[int, ...]], int, tuple[int, int]]:
    """Masks over the words' bits, and the limits on the first two words and, for small and large sets, on all."""
    chance = bit_chance(similarity)
    width = max(8, min(48, round(math.log2(max(2, count) / WANTED))))
    many = 1 if chance == 0 else math.ceil(math.log(MISS) / math.log(1 - (1 - chance) ** width))
    draw, bits, masks = np.random.default_rng(11), [], []
    while len(masks) < many:
        if len(bits) < width:
            bits = draw.permutation(64 * WORDS).tolist()
        masks.append(tuple(bits[:width]))
        bits = bits[width:]
    # The smallest sets that can differ, of four and five shingles, differ in more bits than the plan's chance.
    bits = 64 * WORDS
    return masks, limit_for(128, 1.1 * chance, MISS), (limit_for(bits, 1.1 * chance, MISS), limit_for(bits, chance / 1.125 * 1.03, MISS))


def may_be(one: np.ndarray, other: np.ndarray, sizes: np.ndarray, others: np.ndarray, similarity: float, whole: tuple[int, int]) -> np.ndarray:
    """Whether pairs of sets, by sizes and whole fingerprints, may have the similarity."""
    low, high = np.minimum(sizes, others), np.maximum(sizes, others)
    apart = np.zeros(len(one), np.int64)
    for k in range(WORDS):
        apart += np.bitwise_count(one[:, k] ^ other[:, k])
    return (low >= similarity * high - 1e-9) & (apart <= np.where(low >= LARGE, whole[1], whole[0]))


def _node(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes())


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def set_marks(source: DataFrame, shingle: int) -> DataFrame:
    """``place``, ``node``, ``size`` and ``fp`` of rows of ``place`` and ``text``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), shingle))
            yield pa.RecordBatch.from_arrays([batch.column(0), _signed([_node(x) for x in sets]), pa.array([len(x) for x in sets], pa.int32()), pa.array(fingerprints(sets, WORDS), pa.binary())], names=["place", "node", "size", "fp"])

    return source.mapInArrow(mark, "place struct<k:bigint,h:bigint>, node long, size int, fp binary")


def masked_rows(nodes: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """``bits`` (a mask and its pattern), ``node`` and the first two words, for each node and mask."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = words_of(batch.column(1).to_pylist(), WORDS)
            flat = np.unpackbits(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, 8 * WORDS), axis=1)
            own = [pa.array(values[:, k].copy().view(np.int64)) for k in (0, 1)]
            for number, mask in enumerate(masks):
                pattern = flat[:, mask].astype(np.uint64) @ (np.uint64(1) << np.arange(len(mask), dtype=np.uint64)) | np.uint64(number << 48)
                yield pa.RecordBatch.from_arrays([pa.array(pattern.view(np.int64)), batch.column(0), *own], names=["bits", "node", "w0", "w1"])

    return nodes.select("node", "fp").mapInArrow(key, "bits long, node long, w0 long, w1 long")


def _first_pairs(rows: DataFrame, limit: int) -> DataFrame:
    """Pairs ``a``, ``b`` of each chunk of a group, and ``open``, the ``bits`` of groups that may have more."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in shards(batches):
            part, bits, chunks, node, w0, w1 = (c.to_numpy() for c in columns)
            marks = np.stack([w0, w1], axis=1).view(np.uint64)
            firsts, group = runs(part)
            n, sizes = len(part), np.bincount(group)
            index = GrayIndex(marks, group)
            # First how many pairs each member has; then all of groups with few, and those chosen in others.
            degree = np.zeros(n, np.int64)
            kept: list | None = []  # all pairs, while there are not too many
            for who, found, apart in index.pairs(limit):
                np.add.at(degree, who, 1)
                np.add.at(degree, found, 1)
                if kept is not None:
                    kept.append((who, found, apart))
                    if sum(len(x[0]) for x in kept) > KEPT:
                        kept = None
            total = np.bincount(group, degree) / 2
            dense = total > FEW * sizes
            hub = np.zeros(len(sizes), np.int64)
            order = np.lexsort((np.arange(n), -degree, group))
            hub[group[order[::-1]]] = order[::-1]
            left, right, met = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.zeros(n, bool)
            nearest, distance = np.full(n, -1), np.full(n, 1 << 30)
            for who, found, apart in index.pairs(limit) if kept is None else kept:
                thin = ~dense[group[who]]
                # Most members of a cluster meet its hub on many masks; some of them are enough.
                turn = (np.where(hub[group[who]] == who, node[found], node[who]) + (bits[who] >> 48)) % SPARE == 0
                take = thin | (((hub[group[who]] == who) | (hub[group[who]] == found)) & turn)
                left.append(who[take])
                right.append(found[take])
                met[who[take]] = met[found[take]] = True
                who, found, apart = who[~thin], found[~thin], apart[~thin]
                for x, y in ((who, found), (found, who)):
                    by = np.lexsort((apart, x))[::-1]
                    best = np.full(n, -1)
                    best[x[by]] = by
                    some = np.flatnonzero(best >= 0)
                    nearer = some[apart[best[some]] < distance[some]]
                    distance[nearer], nearest[nearer] = apart[best[nearer]], y[best[nearer]]
            # A pair a member is enough here, and on some masks: groups that stay apart are linked exactly.
            some = np.flatnonzero((nearest >= 0) & ~met & ((node + (bits >> 48)) % SPARE == 0))
            x, y = node[np.concatenate([*left, some])], node[np.concatenate([*right, nearest[some]])]
            pairs = np.unique(np.stack([np.maximum(x, y), np.minimum(x, y)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), pa.nulls(len(pairs), pa.int64())], names=["a", "b", "open"])
            more = np.unique(bits[firsts[dense | (chunks[firsts] > 1)]])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(more), pa.int64()), pa.nulls(len(more), pa.int64()), pa.array(more)], names=["a", "b", "open"])

    counts = rows.groupBy("bits").agg(F.count("*").alias("n")).where(F.col("n") > GROUP)
    large = materialize(counts.select("bits", F.ceil(F.col("n") / GROUP).cast("int").alias("c")), "large-groups")
    dealt = rows.join(large, "bits", "left") if large.take(1) else rows.withColumn("c", F.lit(None).cast("int"))
    chunks = F.coalesce("c", F.lit(1))
    part = F.when(chunks == 1, F.col("bits")).otherwise(F.xxhash64("bits", F.pmod(F.xxhash64("node", "bits"), chunks)))
    dealt = dealt.select(part.alias("part"), "bits", chunks.alias("chunks"), "node", "w0", "w1")
    return dealt.repartition("part").sortWithinPartitions("part", "bits").mapInArrow(pair, "a long, b long, open long")


def _with_partners(rows: DataFrame, limit: int) -> DataFrame:
    """``node`` and ``root`` of rows ``bits, node, w0, w1, root`` that have a near one of another component in their group.

    Of a group that is larger than one task compares: all, unless it is one component.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in shards(batches):
            bits, node, w0, w1, root = (c.to_numpy() for c in columns[:5])
            wanted = columns[5].to_numpy(zero_copy_only=False).astype(bool)
            for who, found, _ in GrayIndex(np.stack([w0, w1], axis=1).view(np.uint64), runs(bits)[1]).pairs(limit):
                apart = root[who] != root[found]
                wanted[who[apart]] = wanted[found[apart]] = True
            node, at = np.unique(node[wanted], return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root[wanted][at])], names=["node", "root"])

    large = rows.groupBy("bits").agg(F.count("*").alias("n"), (F.min("root") < F.max("root")).alias("apart")).where(F.col("n") > GROUP).select("bits", "apart")
    dealt = rows.join(large, "bits", "left").withColumn("whole", F.coalesce("apart", F.lit(False)))
    # Members of a large group are dealt out by themselves: there is no search.
    alone = F.when(F.col("apart").isNotNull(), F.xxhash64("bits", "node")).otherwise(F.col("bits"))
    dealt = dealt.select(alone.alias("bits"), "node", "w0", "w1", "root", "whole").repartition("bits").sortWithinPartitions("bits")
    return dealt.mapInArrow(keep, "node long, root long").distinct()


def _near(pairs: DataFrame, nodes: DataFrame, similarity: float, whole: tuple[int, int]) -> DataFrame:
    """Less the pairs whose sizes or whole fingerprints rule the similarity out."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, others = (batch.column(k).to_numpy() for k in (2, 3))
            x, y = (words_of(batch.column(k).to_pylist(), WORDS) for k in (4, 5))
            yield batch.select(["a", "b"]).filter(pa.array(may_be(x, y, sizes, others, similarity, whole)))

    one, two = (nodes.select(F.col("node").alias(k), F.col("size").alias(f"{k}_size"), F.col("fp").alias(f"{k}_fp")) for k in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "a_size", "b_size", "a_fp", "b_fp").mapInArrow(test, "a long, b long")


def _sets(ends: DataFrame, nodes: DataFrame, source: DataFrame, shingle: int) -> DataFrame:
    """``node`` and ``hashes`` of the nodes in ``ends``, and a few others.

    Flags by a hash of the place, of fixed size, spare a shuffle of all texts.
    """
    slot = F.pmod(F.xxhash64("place.k", "place.h"), F.lit(SLOTS)).cast("int")
    used = nodes.join(ends, "node", "left_semi").select(F.col("first").alias("place")).select(slot.alias("slot")).distinct().toArrow()["slot"].to_numpy()
    flags = np.zeros(SLOTS, np.uint8)
    flags[used] = 1
    shared = source.sparkSession.sparkContext.broadcast(np.packbits(flags).tobytes())

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy()
            keep = np.flatnonzero(bits[at >> 3] >> (7 - (at & 7)) & 1)
            texts = batch.column(1).take(pa.array(keep))
            sets = list(shingle_sets(texts, shingle))
            yield pa.RecordBatch.from_arrays([_signed([_node(x) for x in sets]), pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "hashes"])

    return materialize(source.select(slot.alias("slot"), "text").mapInArrow(pick, "node long, hashes binary").dropDuplicates(["node"]), "sets-on-pairs")


def _true(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs whose sets have the similarity."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(shared / max(1, len(both) - shared) >= similarity)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = (sets.select(F.col("node").alias(k), F.col("hashes").alias(f"{k}_set")) for k in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "a_set", "b_set").mapInArrow(test, "a long, b long")


def links(source: DataFrame, nodes: DataFrame, *, shingle: int, similarity: float) -> DataFrame:
    """Links ``a``, ``b`` that connect the nodes of the similarity; a table.

    source: ``place`` and ``text`` of all documents.
    nodes: a table that can be read again, of distinct ``node`` with ``first`` (a place), ``size`` and ``fp``.
    """
    masks, limit, whole = plan(nodes.count(), similarity)
    rows = masked_rows(nodes, masks)

    def decided(pairs: DataFrame) -> DataFrame:
        sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, source, shingle)
        out = materialize(_true(pairs, sets, similarity), "links")
        discard(pairs, sets)
        return out

    first = materialize(_first_pairs(rows, limit), "first-pairs")
    opened = materialize(first.where("open is not null").select(F.col("open").alias("bits")).distinct(), "open-groups")
    found = decided(materialize(_near(first.where("open is null").select("a", "b").distinct(), nodes, similarity, whole), "near-pairs"))
    discard(first)
    if opened.take(1):
        # Sets of groups that are not yet one component are linked exactly, once for all their groups.
        rest = rows.join(opened, "bits", "left_semi").join(connected_components(found), "node", "left").withColumn("root", F.coalesce("root", "node"))
        rest = materialize(rest.select("bits", "node", "w0", "w1", "root"), "open-rows")
        left = _with_partners(rest, limit)
        left = materialize(left.join(nodes.select("node", "size"), "node"), "open-nodes")
        if left.take(1):
            sets = _sets(left.select("node"), nodes, source, shingle)
            pairs = candidate_links(sets.join(left.select("node"), "node", "left_semi"), left, similarity)
            more = materialize(_true(pairs, sets, similarity), "links")
            found, old = materialize(found.union(more), "links"), found
            discard(old, more, pairs, sets)
        discard(rest, left)
    discard(opened)
    return found
