"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the unit vectors are quantised separately by k-means, so k
centroids a half make k squared cells, their entries' counts known everywhere;
k grows with the square root of the table, up to ``MOST_CELLS``.  A query visits
cells by the summed distance of their two centroids, by a heap over the two
sorted lists, until it has met enough entries; these are reranked by their
cosine in double precision.

How many entries are enough depends on the data.  It is measured: for a bounded
sample of queries, exact neighbours are found against all rows, and the share
of the index is taken at which the visits reach all but ``MISS`` of them.

The codebooks are fitted on at most ``SAMPLE`` vectors; every vector is indexed.
Entries lie in chunks of about ``CHUNK``: small cells share one, a large cell has
several, so a very common vector is spread out.  A task holds one chunk, and the
queries that visit it pass by, whatever their number; more than ``BLOCK`` queries
are several tasks, and a chunk is copied only to those that ask for it.

Defined results: vectors that are null, zero, of another length than most, or
that hold a null or non-finite component take no part; null keys take no part;
rows that repeat a key are each a candidate, but the key is one query, with the
least of its vectors; a query never finds its own key.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.storage import materialize

MOST_CELLS = 1_024
SAMPLE = 20_000
PROBES = 128
MISS = 0.025
CHUNK, BLOCK = 4_096, 65_536
#: Cosines this close to the last one kept are compared by the exact formula.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest components near 1: no cosine changes, no square overflows."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True, initial=0))[1])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in an order of additions that is the same for equal rows."""
    a, b = scaled(a), scaled(b)
    dot, aa, bb = ((x * y).sum(axis=1) for x, y in ((a, b), (a, a), (b, b)))
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres * centres).sum(axis=1)


def k_means(rows: np.ndarray, count: int, *, rounds: int = 12, seed: int = 7) -> np.ndarray:
    draw = np.random.default_rng(seed)
    centres = rows[draw.permutation(len(rows))[:count]].copy()
    for _ in range(rounds):
        nearest = _distances(rows, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        many = np.bincount(nearest, minlength=len(centres))
        centres[many > 0] = sums[many > 0] / many[many > 0, None]
    return centres


def visits(first: np.ndarray, second: np.ndarray) -> Iterator[int]:
    """Cells by summed distance: a heap over pairs of places in the two sorted lists."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y, wide = first[a].tolist(), second[b].tolist(), len(second)
    row, column = (a * wide).tolist(), b.tolist()
    heap, reached = [(x[0] + y[0], 0, 0)], [0] * (len(x) + 1)
    while heap:
        _, i, j = heapq.heappop(heap)
        yield row[i] + column[j]
        reached[i] = j + 1
        # A pair follows when both the one to its left and the one above it have gone.
        if j + 1 < wide and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if i + 1 < len(x) and reached[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))


class MultiIndex:
    """Codebooks of the two halves, the cells' counts, and where cells lie in chunks."""

    def __init__(self, first: np.ndarray, second: np.ndarray) -> None:
        self.first, self.second = first, second
        self.half = first.shape[1]
        self.counts = np.zeros(len(first) * len(second), np.int64)
        self.chunk = self.parts = np.zeros(0, np.int64)

    def distances(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        units = unit(rows)
        return _distances(units[:, : self.half], self.first), _distances(units[:, self.half :], self.second)

    def cells(self, rows: np.ndarray) -> np.ndarray:
        a, b = self.distances(rows)
        return a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)

    def lay_out(self, counts: np.ndarray) -> None:
        self.counts = counts
        self.parts = np.maximum(1, -(-counts // CHUNK))
        self.chunk, chunk, held = np.zeros(len(counts), np.int64), 0, 0
        for cell, n in enumerate(counts.tolist()):
            if held and held + n > CHUNK:
                chunk, held = chunk + 1, 0
            self.chunk[cell] = chunk
            if self.parts[cell] > 1:
                chunk, held = chunk + int(self.parts[cell]), 0
            else:
                held += n

    def probed(self, a: np.ndarray, b: np.ndarray, enough: int) -> list[int]:
        out, met = [], 0
        for cell in visits(a, b):
            if self.counts[cell]:
                out.append(cell)
                met += int(self.counts[cell])
                if met >= enough:
                    break
        return out


def _best(ids: np.ndarray, rows: np.ndarray, query: np.ndarray, own: int, near: np.ndarray, count: int) -> list[tuple[int, float]]:
    """The nearest rows by the exact formula, among those near enough by a fast one."""
    allowed = near[ids[near] != own]
    if not len(allowed):
        return []
    near_rows, query = scaled(rows[allowed]), scaled(query[None])[0]
    fast = (near_rows @ query) / np.linalg.norm(near_rows, axis=1)
    fast /= np.linalg.norm(query)
    if len(allowed) > count:
        cut = np.partition(fast, len(fast) - count)[len(fast) - count]
        allowed = allowed[fast >= cut - SLACK]
    exact = cosines(np.broadcast_to(query, (len(allowed), len(query))), rows[allowed])
    order = np.lexsort((ids[allowed], -exact))[:count]
    return [(int(ids[allowed[k]]), float(exact[k])) for k in order]


_HIT = "query_id long, vec_id long, score double"


def _hits(rows: list[tuple[int, int, float]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 3
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)})


def _top(found: DataFrame, count: int) -> DataFrame:
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= count)


def exact_neighbours(entries: DataFrame, queries: list[tuple[int, np.ndarray]], size: int, count: int) -> DataFrame:
    """Neighbours of a bounded list of queries among all entries (``id``, ``v``), in blocks."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_numpy(), _matrix(batch.column(1), size)
            if len(ids):
                every = np.arange(len(ids))
                yield from _hits([(q, *hit) for q, v in queries for hit in _best(ids, rows, v, q, every, count)]).to_batches()

    return _top(entries.select("id", "v").mapInArrow(search, _HIT), count)


def _sample(table: DataFrame, most: int, there: int) -> pa.Table:
    """At most so many rows, by a hash of their place, so rows that repeat are told apart."""
    if there > most:
        share = max(0.5, most - 3 * most**0.5) / there
        table = table.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30)))
    return table.limit(most).toArrow()


def neighbours(vectors: DataFrame, queries: Column, *, key: str = "vec_id", vector: str = "embedding", count: int = 5, cells: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest found of each row that meets ``queries``.

    cells: centroids a half; by default by the table's size.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, total = common["size"], common["n"]
    rows = rows.where(F.size("v") == size)
    if cells is None:
        cells = min(MOST_CELLS, max(16, 1 << round(np.log2(1.3 * total**0.5))))

    fitted = unit(_matrix(_sample(rows.select("v"), SAMPLE, total)["v"], size))
    half = max(1, size // 2)
    # A vector of one component has an empty second half, in one cell.
    index = MultiIndex(k_means(fitted[:, :half], cells), k_means(fitted[:, half:], cells) if size > 1 else np.zeros((1, 0)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), size)
            cell = index.cells(x) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=["id", "v", "asks", "cell"])

    entries = materialize(rows.mapInArrow(assign, "id long, v array<double>, asks boolean, cell int"), "multi-index")
    # At most cells squared counts.
    met = entries.groupBy("cell").count().toArrow()
    counts = np.zeros(len(index.first) * len(index.second), np.int64)
    counts[met["cell"].to_numpy()] = met["count"].to_numpy()
    index.lay_out(counts)

    asked = entries.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    asking = asked.count()
    found = _sample(asked, PROBES, max(1, asking))
    probes = list(zip(found["id"].to_pylist(), _matrix(found["v"], size), strict=True))
    truth = exact_neighbours(entries, probes, size, count).join(entries.select(F.col("id").alias("vec_id"), "cell"), "vec_id").select("query_id", "cell").toArrow()
    by_query: dict[int, list[int]] = {}
    for q, cell in zip(truth["query_id"].to_pylist(), truth["cell"].to_pylist(), strict=True):
        by_query.setdefault(q, []).append(cell)
    needed: list[int] = []
    for q, v in probes:
        wanted, passed = set(by_query.get(q, [])), 0
        a, b = index.distances(v[None, :])
        for cell in visits(a[0], b[0]) if wanted else ():
            passed += int(counts[cell])
            if cell in wanted:
                needed += [passed] * by_query[q].count(cell)
                wanted.remove(cell)
                if not wanted:
                    break
    share = float(np.quantile(needed, 1 - MISS)) / total if needed else 1.0
    shared = spark.sparkContext.broadcast((index, max(int(np.ceil(share * total)), 4 * count)))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, most = shared.value
        for batch in batches:
            x = _matrix(batch.column(1), size)
            a, b = model.distances(x) if len(x) else ((), ())
            place, chunks, cells_ = [], [], []
            for k in range(len(x)):
                probed = np.array(model.probed(a[k], b[k], most), np.int64)
                # A large cell is in several chunks.
                parts = model.parts[probed]
                own = np.repeat(probed, parts)
                chunk = np.repeat(model.chunk[probed] - np.concatenate(([0], np.cumsum(parts)[:-1])), parts) + np.arange(len(own))
                order = np.argsort(chunk, kind="stable")
                firsts = np.flatnonzero(np.diff(chunk[order], prepend=-1))
                place += [k] * len(firsts)
                chunks += chunk[order][firsts].tolist()
                cells_ += [x.astype(np.int32) for x in np.split(own[order], firsts[1:])]
            take = pa.array(place, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), batch.column(0).take(take), batch.column(1).take(take), pa.array(cells_, pa.list_(pa.int32()))], names=["chunk", "id", "v", "cells"])

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = shared.value
        for batch in batches:
            cell, turn = (batch.column(k).to_numpy() for k in (2, 3))
            yield pa.RecordBatch.from_arrays([pa.array(model.chunk[cell] + turn % model.parts[cell]), *batch.columns[:3]], names=["chunk", "id", "v", "cell"])

    asks = asked.mapInArrow(visit, "chunk long, id long, v array<double>, cells array<int>").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(asking // BLOCK + 1)).cast("int"))
    asks = materialize(asks, "visits")
    laid = entries.select("id", "v", "cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 40)).alias("turn")).mapInArrow(lay, "chunk long, id long, v array<double>, cell int")
    laid = laid.join(asks.select("chunk", "block").distinct(), "chunk")
    both = laid.select("chunk", "block", F.lit(False).alias("asks"), "id", "v", F.array("cell").alias("cells")).union(asks.select("chunk", "block", F.lit(True), "id", "v", "cells"))

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each chunk and block the entries come first, then the queries."""
        place, held, open_ = None, [], False
        ids = cell = x = None
        for batch in batches:
            found = []
            chunk, block, asking = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            changes = np.flatnonzero((chunk[1:] != chunk[:-1]) | (block[1:] != block[:-1]) | (asking[1:] != asking[:-1])) + 1
            for first, last in zip([0, *changes.tolist()], [*changes.tolist(), len(chunk)], strict=True):
                if first == last:
                    continue
                part = batch.slice(first, last - first)
                if (chunk[first], block[first]) != place:
                    place, held, open_ = (chunk[first], block[first]), [], True
                if not asking[first]:
                    held.append((part.column(3).to_numpy(), _matrix(part.column(4), size), part.column(5).flatten().to_numpy()))
                    continue
                if open_:
                    ids, x, cell = (np.concatenate(c) for c in zip(*held, strict=True)) if held else (np.empty(0, np.int64), np.empty((0, size)), np.empty(0, np.int32))
                    open_ = False
                for q, v, own in zip(part.column(3).to_pylist(), _matrix(part.column(4), size), part.column(5), strict=True):
                    found += [(q, *hit) for hit in _best(ids, x, v, q, np.flatnonzero(np.isin(cell, own.values.to_numpy())), count)]
            yield from _hits(found).to_batches()

    hits = both.repartition("chunk", "block").sortWithinPartitions("chunk", "block", "asks").mapInArrow(rerank, _HIT)
    return _top(hits, count).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
