"""Exact search for the highest inner products, by tiled matrix products.

Queries are dealt into blocks of a bounded size and candidates into shards, whose
number follows the cluster's cores.  A task holds one block of queries and their
best so far while the candidates of one shard pass by in tiles: a tile's
products with the block are one matrix product, of which only those are looked
at that reach a query's last place.  Each task gives one list for a query; lists
are merged in a tree, ``FAN`` of them at a time.

Each block meets each shard once, so candidates are copied once for ``BLOCK``
queries, and a query's lists are as many as there are shards, whatever the
number of rows.

Defined results: see ``integers`` for the rows that take no part; null keys take
no part; rows that repeat a key are each a candidate, but the key is one query,
with the least of its vectors (compared by components); a query never finds its
own key; equal scores rank by key; an empty table, or one without queries, gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.integers import integer_vectors, matrix, products
from lexmill.storage import discard, materialize

#: Bytes of queries a task holds; queries and candidates whose products are made at once.
BLOCK_BYTES = 1 << 23
TILE = 1_024, 2_048
FAN = 16
_LAST = np.iinfo(np.int64).max


class Best:
    """The best candidates of a block of queries: scores, and keys in the order of results."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, count: int) -> None:
        self.ids, self.rows = ids, rows
        self.scores = np.full((len(ids), count), -_LAST, np.int64)
        self.keys = np.full((len(ids), count), _LAST, np.int64)

    def meet(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Take in a tile of candidates."""
        for start in range(0, len(self.ids), TILE[0]):
            part = slice(start, start + TILE[0])
            scores = products(self.rows[part], rows)
            # Most tiles hold nothing that reaches a query's last place.
            hopeful = np.flatnonzero(scores.max(axis=1) >= self.scores[part, -1])
            for q in (hopeful + start).tolist():
                own = scores[q - start]
                near = np.flatnonzero((own >= self.scores[q, -1]) & (keys != self.ids[q]))
                count = self.scores.shape[1]
                if len(near) > count:
                    cut = np.partition(own[near], len(near) - count)[len(near) - count]
                    near = near[own[near] >= cut]
                every = np.concatenate((self.scores[q], own[near].astype(np.int64)))
                named = np.concatenate((self.keys[q], keys[near]))
                order = np.lexsort((named, -every))[:count]
                self.scores[q], self.keys[q] = every[order], named[order]

    def lists(self, group: int) -> pa.RecordBatch:
        held = self.keys != _LAST
        offsets = np.concatenate(([0], held.sum(axis=1).cumsum())).astype(np.int32)
        hits = pa.StructArray.from_arrays([pa.array(-self.scores[held]), pa.array(self.keys[held])], ["below", "vec_id"])
        return pa.RecordBatch.from_arrays([pa.array(self.ids), pa.array(np.full(len(self.ids), group, np.int32)), pa.ListArray.from_arrays(offsets, hits)], names=["query_id", "part", "hits"])


_LISTS = "query_id long, part int, hits array<struct<below: long, vec_id: long>>"


def _merged(lists: DataFrame, parts: int, count: int) -> DataFrame:
    """Lists of the parts of one query merged ``FAN`` at a time, until one is left."""
    while True:
        parts = -(-parts // FAN)
        lists = lists.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("query_id", "part")
        # A group has at most FAN lists of ``count`` hits.
        lists = lists.agg(F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, count).alias("hits"))
        if parts <= 1:
            return lists.select("query_id", "hits")


def highest_products(vectors: DataFrame, queries: Column, *, key: str = "vec_id", vector: str = "embedding", scale: int = 256, count: int = 5, shards: int | None = None, block: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``count`` highest integer inner products of each row that meets ``queries``.

    shards: into how many parts the candidates are dealt; by default two for each core.
    block: queries a task holds; by default as many as ``BLOCK_BYTES`` take.
    """
    spark = vectors.sparkSession
    if count < 1:
        raise ValueError("at least one is sought")
    rows, size = integer_vectors(vectors, vector, scale, id=F.col(key).cast("long"), asks=F.coalesce(queries, F.lit(False)))
    if not size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards = shards or 2 * spark.sparkContext.defaultParallelism
    block = block or max(256, BLOCK_BYTES // (8 * size))
    # Written once, so that a row's place, which deals it to a shard, is the same whenever it is read.
    entries = materialize(rows.where(F.col("id").isNotNull()), "entries")
    asked = materialize(entries.where("asks").groupBy("id").agg(F.min("v").alias("v")), "queries")
    blocks = asked.count() // block + 1

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Rows that repeat are dealt by their place.
    laid = entries.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"), F.lit(1).alias("turn"), "id", "v").select(every(blocks).alias("block"), "*")
    asking = asked.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("turn"), "id", "v").select("block", every(shards).alias("shard"), "turn", "id", "v")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block and shard the queries come first, then the candidates."""
        place, held, best = None, [], None
        for batch in batches:
            block_, shard, turn, ids = (batch.column(k).to_numpy() for k in range(4))
            changes = np.flatnonzero((np.diff(block_) != 0) | (np.diff(shard) != 0) | (np.diff(turn) != 0)) + 1
            for start, end in zip([0, *changes.tolist()], [*changes.tolist(), len(ids)], strict=True):
                if start == end:
                    continue
                if place != (block_[start], shard[start]):
                    if best is not None:
                        yield best.lists(int(place[1]))
                    place, held, best = (block_[start], shard[start]), [], None
                part = ids[start:end], matrix(batch.column(4).slice(start, end - start), size)
                if turn[start] == 0:
                    held.append(part)
                elif held or best is not None:
                    if best is None:
                        best, held = Best(np.concatenate([p[0] for p in held]), np.concatenate([p[1] for p in held]), count), []
                    for first in range(0, end - start, TILE[1]):
                        best.meet(part[0][first : first + TILE[1]], part[1][first : first + TILE[1]])
        if best is not None:
            yield best.lists(int(place[1]))

    both = asking.unionByName(laid).select("block", "shard", "turn", "id", "v")
    lists = both.repartitionById(blocks * shards, F.col("block") * shards + F.col("shard")).sortWithinPartitions("block", "shard", "turn").mapInArrow(search, _LISTS)
    found = materialize(_merged(lists, shards, count), "top-lists")
    discard(entries, asked)
    return found.select("query_id", F.posexplode("hits").alias("place", "hit")).select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.below")).alias("score"))
