"""Links between sets of a similarity, without comparing what only a template joins.

Where very many sets are near each other, most pairs share a template and little
else, and pairs just below the similarity can't be told by a sketch.  Here
hashes that more than about ``LIGHT`` of the sets hold are heavy, the others light,
and a global order puts light ones first.  A set's prefix are its first hashes in
that order, of which two sets of the similarity must share one.

* If they share a light one, they meet in that hash's group, of about ``LIGHT`` sets at most.
* If not, the prefixes of both go on beyond their light hashes, so they share no
  light hash at all: what they share follows from their heavy parts alone.  Sets
  of one heavy part are a class.  Whether two are linked then depends on their
  sizes only, and the smallest set of a class is linked if any of it is.

So of classes only the smallest sets are compared, by matrix products over chunks
of classes; other sets get one link, to the class that leaves most room for their
size.  Classes of one component are not compared with each other.  Rows grow with
the sets and with links between classes, never with pairs of a template's sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.shards import shards
from lexmill.storage import discard, materialize

LIGHT = 64
#: One set in so many tells which hashes are heavy; up to so many of these are broadcast (a megabyte), more are joined.
SHARE, BROADCAST = 8, 1 << 17
#: Classes of a chunk, and columns of their matrix that are multiplied at once.
CLASSES, COLUMNS = 512, 4_096
_NEAR = 1e-9


def _tokens(sets: DataFrame) -> DataFrame:
    """``token`` and ``node`` of every hash of the sets."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, hashes in zip(batch.column(0), batch.column(1), strict=True):
                values = np.frombuffer(hashes.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(np.full(len(values), node.as_py()))], names=["token", "node"])

    return sets.select("node", "hashes").mapInArrow(cut, "token long, node long")


def _heavy(sets: DataFrame) -> DataFrame:
    """``token`` of hashes that many sets hold, as one set in ``SHARE`` tells; a table.

    Which hashes are called heavy decides how a pair is found, never whether.
    """
    some = sets.where(F.pmod(F.xxhash64("node"), F.lit(SHARE)) == 0)
    counts = _tokens(some).groupBy("token").agg(F.count("*").alias("n"))
    return materialize(counts.where(F.col("n") > max(1, LIGHT // SHARE)).select("token"), "heavy-tokens")


def _split(sets: DataFrame, heavy: DataFrame) -> DataFrame:
    """``node, light, heavy``: each set's hashes of both kinds, sorted."""
    if heavy.count() > BROADCAST:
        of = lambda kind: F.array_sort(F.collect_list(F.when(kind, F.col("token"))))
        marked = _tokens(sets).join(heavy.withColumn("many", F.lit(True)), "token", "left")
        return marked.groupBy("node").agg(of(F.col("many").isNull()).alias("light"), of(F.col("many").isNotNull()).alias("heavy"))
    shared = sets.sparkSession.sparkContext.broadcast(np.sort(heavy.toArrow()["token"].to_numpy()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = shared.value
        for batch in batches:
            light, common = [], []
            for hashes in batch.column(1):
                values = np.sort(np.frombuffer(hashes.as_py(), np.int64))
                at = np.minimum(np.searchsorted(many, values), max(0, len(many) - 1))
                here = many[at] == values if len(many) else np.zeros(len(values), bool)
                light.append(values[~here])
                common.append(values[here])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(light, pa.list_(pa.int64())), pa.array(common, pa.list_(pa.int64()))], names=["node", "light", "heavy"])

    return sets.select("node", "hashes").mapInArrow(cut, "node long, light array<long>, heavy array<long>").where(F.size("light") + F.size("heavy") > 0)


def overlaps(ours: list[np.ndarray], theirs: list[np.ndarray]) -> np.ndarray:
    """How many hashes each of our sets shares with each of theirs.

    Hashes that the same sets hold are one column with a weight, so a template
    is one column however long it is.
    """
    out = np.zeros((len(ours), len(theirs)), np.float32)
    row = np.repeat(np.arange(len(ours) + len(theirs)), [len(x) for x in (*ours, *theirs)])
    if not len(row):
        return out
    column = np.unique(np.concatenate([*ours, *theirs]), return_inverse=True)[1]
    left = row < len(ours)
    both = (np.bincount(column, left) > 0) & (np.bincount(column, ~left) > 0)
    row, column = row[both[column]], column[both[column]]
    if not len(row):
        return out
    mark = np.random.default_rng(3).integers(1, 1 << 63, len(ours) + len(theirs), dtype=np.uint64)
    holders = np.zeros(len(both), np.uint64)
    np.add.at(holders, column, mark[row])
    _, first, alike, weight = np.unique(holders[both], return_index=True, return_inverse=True, return_counts=True)
    kept = np.flatnonzero(both)[first]
    place = np.full(len(both), -1)
    place[kept] = np.arange(len(kept))
    row, column = row[place[column] >= 0], place[column[place[column] >= 0]]
    for start in range(0, len(kept), COLUMNS):
        here = (column >= start) & (column < start + COLUMNS)
        cells = np.zeros((len(ours) + len(theirs), min(COLUMNS, len(kept) - start)), np.float32)
        cells[row[here], column[here] - start] = 1
        out += (cells[: len(ours)] * weight[start : start + COLUMNS].astype(np.float32)) @ cells[len(ours) :].T
    return out


def _joined(near: np.ndarray, label: np.ndarray, other: np.ndarray) -> Iterator[tuple[int, int]]:
    """Of the pairs, those that join components not yet joined; ``label`` and ``other`` hold components and are changed."""
    for i in np.flatnonzero(near.any(axis=1)).tolist():
        found = np.flatnonzero(near[i])
        for old, at in zip(*np.unique(other[found], return_index=True), strict=True):
            if old != label[i] and other[found[at]] != label[i]:
                yield i, int(found[at])
                new, gone = label[i], other[found[at]]
                label[label == gone] = new
                other[other == gone] = new


def class_links(classes: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: links between classes' smallest sets that join components; ``class, room, partner``: for a class of several components, whom its sets go with and up to what size.

    classes: a table of ``class, heavy, size, node, root, pure``.
    """
    share = similarity / (1 + similarity)
    spark = classes.sparkSession
    # Components with so many classes are few: at most one for each chunk.
    large = [(r["root"], -(-r["n"] // CLASSES)) for r in classes.where("pure").groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > CLASSES).orderBy("root").collect()]
    family, starts, total = [], [], 0
    for number, (root, parts) in enumerate(large):
        starts.append((root, total, parts))
        family += [number] * parts
        total += parts
    rest = classes.count() if not large else classes.join(spark.createDataFrame(starts, "root long, start int, parts int"), "root", "left").where("start IS NULL OR NOT pure").count()
    others = max(1, -(-rest // CLASSES))
    family += [-1] * others
    dealt = classes.join(spark.createDataFrame(starts, "root long, start int, parts int"), "root", "left")
    apart = F.col("start").isNotNull() & F.col("pure")
    dealt = dealt.withColumn("own", F.when(apart, F.col("start") + F.pmod(F.xxhash64("class"), F.col("parts"))).otherwise(F.lit(total) + F.pmod(F.xxhash64("class"), F.lit(others))).cast("int"))
    families = F.array(*[F.lit(f) for f in family])
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(len(family) - 1))))
    mine, its = F.element_at(families, F.col("own") + 1), F.element_at(families, F.col("other") + 1)
    dealt = dealt.where((mine < 0) | (mine != its))
    dealt = dealt.select((F.least("own", "other") * F.lit(len(family)).cast("long") + F.greatest("own", "other")).alias("part"), "own", "class", "size", "node", "root", "pure", "heavy")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in shards(batches, 2 * CLASSES):
            parts = columns[0].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for start, end in zip(edges, edges[1:], strict=False):
                own, key, size, node, root = (c.slice(start, end - start).to_numpy() for c in columns[1:6])
                pure = columns[6].slice(start, end - start).to_numpy(zero_copy_only=False)
                heavy = [np.array(x.values) for x in columns[7].slice(start, end - start)]
                low, high = (np.flatnonzero(own == c) for c in (own.min(), own.max()))
                one_chunk = own.min() == own.max()
                shared = overlaps([heavy[k] for k in low], [heavy[k] for k in high]).astype(np.float64)
                if one_chunk:
                    np.fill_diagonal(shared, -1.0)
                near = shared >= share * (size[low][:, None] + size[high]) - _NEAR
                label = np.unique(root, return_inverse=True)[1]
                mine, its = label[low], label[high]
                links = list(_joined(near, mine, mine if one_chunk else its))
                a, b = (node[side[[link[k] for link in links]]] if links else np.zeros(0, np.int64) for k, side in ((0, low), (1, high)))
                room = np.where(near, shared / share - size[high], -1.0)
                back = np.where(near, shared / share - size[low][:, None], -1.0)
                best = [(low, high, room)] if one_chunk else [(low, high, room), (high, low, back.T)]
                of, width, partner = [], [], []
                for ours, theirs, space in best:
                    if space.size:
                        to = space.argmax(axis=1)
                        told = np.flatnonzero(~pure[ours] & (space.max(axis=1) >= 0))
                        of.append(key[ours[told]])
                        width.append(space[told, to[told]])
                        partner.append(node[theirs[to[told]]])
                none = pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none[0], none[1], none[0]], names=["a", "b", "class", "room", "partner"])
                if of:
                    of, width, partner = (np.concatenate(c) for c in (of, width, partner))
                    empty = pa.nulls(len(of), pa.int64())
                    yield pa.RecordBatch.from_arrays([empty, empty, pa.array(of), pa.array(width), pa.array(partner)], names=["a", "b", "class", "room", "partner"])

    return dealt.repartition("part").sortWithinPartitions("part").mapInArrow(compare, "a long, b long, class long, room double, partner long")


def candidate_links(sets: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a``, ``b``, a table: all links of the similarity between components lie on paths of those that hold.

    sets: a table of ``node`` and ``hashes``.  nodes: ``node, size, root``, the component so far.
    """
    share = similarity / (1 + similarity)
    heavy = _heavy(sets)
    split = _split(sets, heavy)
    length = (F.col("size") - F.ceil(F.col("size") * similarity - _NEAR) + 1).cast("int")
    split = materialize(split.join(nodes.select("node", "size", "root"), "node").withColumn("prefix", length), "split-sets")

    asked = split.select("node", "size", "root", F.explode(F.slice("light", F.lit(1), F.col("prefix"))).alias("token"))
    groups = asked.groupBy("token").agg(F.collect_list(F.struct("node", "size", "root")).alias("own")).where(F.size("own") > 1)
    pairs = groups.select("own", F.posexplode("own").alias("i", "a")).select("a", F.explode(F.slice("own", F.col("i") + 2, F.size("own"))).alias("b"))
    fits = F.least("a.size", "b.size") >= F.greatest("a.size", "b.size") * similarity - _NEAR
    pairs = pairs.where((F.col("a.root") != F.col("b.root")) & fits).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))

    template = split.where(F.size("light") < F.col("prefix")).select(F.xxhash64("heavy").alias("class"), "node", "size", "root")
    classes = template.groupBy("class").agg(F.min(F.struct("size", "node")).alias("least"), F.min("root").alias("root"), (F.min("root") == F.max("root")).alias("pure"))
    classes = classes.select("class", F.col("least.size").alias("size"), F.col("least.node").alias("node"), "root", "pure")
    # A class of several components is told by its smallest set's.
    classes = materialize(classes.drop("root").join(split.select("node", "heavy", "root"), "node"), "classes")
    found = materialize(class_links(classes, similarity), "class-links")
    own = classes.where("NOT pure").select("class", (F.size("heavy") / share - F.col("size")).alias("room"), F.col("node").alias("partner"))
    best = own.unionByName(found.where("class IS NOT NULL").select("class", "room", "partner")).groupBy("class").agg(F.max(F.struct("room", "partner")).alias("best"))
    more = template.join(best, "class").where((F.col("size") <= F.col("best.room") + _NEAR) & (F.col("node") != F.col("best.partner"))).select(F.col("node").alias("a"), F.col("best.partner").alias("b"))

    every = pairs.union(found.where("a IS NOT NULL").select("a", "b")).union(more)
    out = materialize(every.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "candidate-links")
    discard(heavy, split, classes, found)
    return out
