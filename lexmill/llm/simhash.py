"""SimHash near-duplicates by a hierarchical index in Gray order.

Fingerprints that share a masked bit pattern meet in one group, and a shard of
many groups is one index (see ``gray``): masked patterns are its upper nodes,
below them fingerprints lie in Gray order, so neighbours agree on many bits.  A
search adds up, from its upper node down, the bits in which the query differs
from the patterns, and drops a node with all that lies below as soon as the sum
passes the limit.

``near_duplicates`` links fingerprints.  Its masks are ``max_bits + 1`` blocks of
bits: two fingerprints within the limit agree on a whole block.  A group of more
than ``GROUP`` distinct fingerprints is split before it is gathered, by finer
masks, blocks of the bits left, so no link is lost, until its size or the number
of bits left bounds it.  A group yields a link from each member to the least of
its local component, never all pairs; components across groups are joined on
executors.

``drop_near_duplicates`` links texts by the similarity of their shingles: see
``verified``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import verified
from lexmill.llm.components import connected_components
from lexmill.llm.gray import GrayIndex, fingerprint, local_components, runs, words_of
from lexmill.llm.names import unused
from lexmill.llm.shards import shards
from lexmill.llm.shingles import shingle_hashes
from lexmill.storage import discard, materialize

#: Most fingerprints of a group that is not split further.
GROUP = 2_048


def fingerprints(documents: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, words: int = 1) -> DataFrame:
    """``doc_id`` and binary ``fp`` of every whole text."""
    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(shingle_hashes(value.as_py(), shingle), words) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.binary())], names=["doc_id", "fp"])

    return source.mapInArrow(mark, "doc_id long, fp binary")


def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    cuts = [len(bits) * k // parts for k in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


class Masks:
    """The plan of group keys: first masks, and the finer ones of a mask whose group is too large.

    A mask is a tuple of bit positions, counted from the first word's most
    significant bit.
    """

    def __init__(self, words: int, limit: int) -> None:
        self.words, self.limit = words, limit

    def first(self) -> list[tuple[int, ...]]:
        bits = list(range(64 * self.words))
        return [tuple(b) for b in _blocks(bits, self.limit + 1)]

    def finer(self, mask: tuple[int, ...]) -> list[tuple[int, ...]]:
        rest = [b for b in range(64 * self.words) if b not in set(mask)]
        # No more than GROUP fingerprints differ only in so many bits.
        return [mask + tuple(b) for b in _blocks(rest, self.limit + 1)] if len(rest) > GROUP.bit_length() - 1 else []


def mask_words(mask: tuple[int, ...], words: int) -> np.ndarray:
    out = [0] * words
    for bit in mask:
        out[bit // 64] |= 1 << (63 - bit % 64)
    return np.array(out, np.uint64)


def masked(values: np.ndarray, mask: np.ndarray, number: int) -> np.ndarray:
    """A hash of the masked words and the mask's number."""
    bits = np.full(len(values), number, np.uint64)
    for k in np.flatnonzero(mask):
        bits = (bits ^ (values[:, k] & mask[k])) * np.uint64(0x9E3779B97F4A7C15)
        bits ^= bits >> np.uint64(29)
    return bits.view(np.int64)


def _keyed(rows: DataFrame, table: list[tuple[int, ...]], words: int, children: dict[int, list[int]] | None = None) -> DataFrame:
    """A row for each node and mask: the mask's number in ``table`` and a hash of the masked words.

    children: of each number in the rows' own ``mask`` column, the masks to use.
    """
    masks = [mask_words(m, words) for m in table]

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, marks = batch.column("node").to_numpy(), batch.column("fp")
            values = words_of(marks.to_pylist(), words)
            if children is None:
                parts = [(np.arange(len(node)), range(len(masks)))]
            else:
                of = batch.column("mask").to_numpy()
                parts = [(np.flatnonzero(of == number), children[number]) for number in np.unique(of).tolist()]
            for here, numbers in parts:
                nodes, fps = pa.array(node[here]), marks.take(pa.array(here))
                for number in numbers:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(here), number, np.int32)), pa.array(masked(values[here], masks[number], number)), nodes, fps], names=["mask", "bits", "node", "fp"])

    return rows.mapInArrow(key, "mask int, bits long, node long, fp binary")


def link_groups(keys: np.ndarray, rows: np.ndarray, limit: int) -> np.ndarray:
    """Component labels of rows that are sorted by group key."""
    label = np.arange(len(keys))
    left, right, held = [], [], 0
    for who, found, _ in GrayIndex(rows, runs(keys)[1]).pairs(limit):
        left.append(who)
        right.append(found)
        held += len(who)
        if held > 1 << 22:
            label = local_components(len(keys), np.concatenate([np.arange(len(keys)), *left]), np.concatenate([label, *right]))
            left, right, held = [], [], 0
    return local_components(len(keys), np.concatenate([np.arange(len(keys)), *left]), np.concatenate([label, *right]))


def _group_links(rows: DataFrame, words: int, limit: int) -> DataFrame:
    """Links ``a``, ``b`` of each member of a group to the least place of its component there."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bits, node, fp in shards(batches):
            node = node.to_numpy()
            label = link_groups(bits.to_numpy(), words_of(fp.to_pylist(), words), limit)
            at = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[label[at]])], names=["a", "b"])

    return rows.select("bits", "node", "fp").repartition("bits").sortWithinPartitions("bits").mapInArrow(link, "a long, b long")


def links(nodes: DataFrame, plan: Masks) -> DataFrame:
    """Links ``a``, ``b`` that connect all ``node``s whose fingerprints the plan finds within its limit.

    nodes: a table that can be read again, of distinct ``fp`` and their ``node``.
    """
    table, words = plan.first(), plan.words
    rows, out = _keyed(nodes, table, words), None
    while True:
        finer = {k: plan.finer(m) for k, m in enumerate(table)}
        large = rows.groupBy("mask", "bits").agg(F.count("*").alias("n")).where(F.col("n") > GROUP)
        large = materialize(large.where(F.col("mask").isin([k for k, m in finer.items() if m])), "large-groups")
        some = bool(large.take(1))
        found = _group_links(rows.join(large, ["mask", "bits"], "left_anti") if some else rows, words, plan.limit)
        out = found if out is None else out.union(found)
        if not some:
            return out
        held = rows.join(large, ["mask", "bits"])
        children, table, old = {}, [], table
        for k in range(len(old)):
            children[k] = [len(table) + i for i in range(len(finer[k]))]
            table += finer[k]
        rows = _keyed(held.drop("n"), table, words, children)


def near_duplicates(documents: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of every document.

    Documents are linked if their 64-bit fingerprints differ in at most
    ``max_bits`` bits; a component's id is the smallest key in it.  Every link
    counts.  A null or empty text has fingerprint zero and is linked like any
    other; a null key gets its component's id (null if that has no other key);
    repeated rows are in one component; an empty table gives an empty result.
    """
    marks = materialize(fingerprints(documents, key=key, text=text, shingle=shingle).withColumn("node", F.conv(F.hex("fp"), 16, -10).cast("long")), "fingerprints")
    distinct = materialize(marks.groupBy("node", "fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected_components(links(distinct.select("node", "fp"), Masks(1, max_bits)))
    rooted = distinct.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    named = rooted.select("node", "root").join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("node", "component_id")
    return marks.join(named, "node").select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(documents: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group of near duplicates, with all columns: that of the smallest key.

    Documents are linked if the Jaccard similarity of their sets of word shingles
    is ``similarity`` or more.  Candidates come from fingerprints in Gray order,
    which find such a pair with a chance of at least 0.98; each is decided by the
    exact similarity, so no pair below it is linked.  Documents without words are
    one group.  Of equal keys in one group the first by text stays once; a null
    key comes after all others.
    """
    own = unused(documents, "k", "h")
    k, h = F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)), F.xxhash64(F.col(text).cast("string"))
    marked = documents.withColumns({own[0]: k, own[1]: h})
    source = documents.select(F.struct(k.alias("k"), h.alias("h")).alias("place"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    marks = verified.set_marks(source, shingle).groupBy("node", "place").agg(F.count("*").alias("n"), F.min("size").alias("size"), F.min("fp").alias("fp"))
    firsts = marks.groupBy("node").agg(F.min(F.struct("place", "n", "size", "fp")).alias("f"))
    nodes = materialize(firsts.select("node", F.col("f.place").alias("first"), "f.n", "f.size", "f.fp"), "distinct-sets")
    found = verified.links(source, nodes, shingle=shingle, similarity=similarity)
    roots = connected_components(found)
    kept = nodes.select("node", "first", "n").join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min(F.struct("first", "n")).alias("f"))
    kept = materialize(kept.select(F.col("f.first.k").alias(own[0]), F.col("f.first.h").alias(own[1]), "f.n"), "kept-documents")
    discard(nodes, found)
    out = marked.join(kept.where("n = 1").drop("n"), own, "left_semi")
    repeated = kept.where("n > 1").drop("n")
    if repeated.take(1):
        out = out.union(marked.join(repeated, own, "left_semi").dropDuplicates(own))
    return out.drop(*own)
