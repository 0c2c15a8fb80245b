"""Vector code compression: product codes by a delta-maintained Lloyd iteration.

Vectors of integers are cut into equal consecutive parts, and each part position
has a codebook of at most 256 entries.  A round assigns every part to the
nearest entry and replaces each entry by the mean of its parts, rounded down.

Rounds are incremental.  A table in the shared folder holds, of each row, the
codes of the round before; the driver holds a running count and integer sum for
each entry.  A round reads the table, assigns again, and writes the next table
in one pass: the rows with their new codes and, beside them, what each task adds
to and takes from an entry because a part changed its code.  Only these rows,
combined within a task, are shuffled: at most a row a task and entry in the first
round, and fewer as codes settle.  Since a task's rows and its changes are
committed together, a task that runs twice or is lost counts once.

Defined results: see ``integers`` for the rows that take no part; a null key is
kept and counts as the largest; rows that repeat a key are rows of their own,
among equal keys the smaller vector (compared by components) starts an entry;
with fewer rows than entries the codebooks are shorter; a length that the number
of parts does not divide is filled with zeros; labels may be null, and nulls are
one label; sums of errors that leave a long are null; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.integers import integer_vectors, matrix, products
from lexmill.storage import discard, materialize

ENTRIES = 256
_NONE = -1


class Codebooks:
    """Entries of each part position, with the running counts and sums of their parts."""

    def __init__(self, parts: np.ndarray) -> None:
        """parts: entry, part, component."""
        self.entries = np.ascontiguousarray(parts.transpose(1, 0, 2))
        self.counts = np.zeros(self.entries.shape[:2], np.int64)
        self.sums = np.zeros_like(self.entries)

    @property
    def shape(self) -> tuple[int, int, int]:
        return self.entries.shape

    def split(self, rows: np.ndarray) -> np.ndarray:
        """Rows as row, part, component."""
        parts, _, width = self.shape
        out = np.zeros((len(rows), parts * width), np.int64)
        out[:, : rows.shape[1]] = rows
        return out.reshape(len(rows), parts, width)

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the parts of split rows, and the squared distances summed over parts."""
        codes, error = np.zeros(rows.shape[:2], np.int64), np.zeros(len(rows), np.int64)
        for part, entries in enumerate(self.entries):
            own = rows[:, part]
            squares = (entries * entries).sum(axis=1)
            # Whole numbers throughout, so equal distances are equal and the lower index is taken.
            codes[:, part] = (squares - 2 * products(own, entries)).argmin(axis=1)
            gap = own - entries[codes[:, part]]
            error += (gap * gap).sum(axis=1)
        return codes, error

    def changes(self, rows: np.ndarray, before: np.ndarray, after: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
        """Add to ``counts`` and ``sums`` what parts of another code than before bring and take."""
        for part in range(self.shape[0]):
            moved = np.flatnonzero(before[:, part] != after[:, part])
            own = rows[moved, part]
            for codes, sign in ((after[moved, part], 1), (before[moved, part], -1)):
                there = codes != _NONE
                order = np.argsort(codes[there], kind="stable")
                if not len(order):
                    continue
                sorted_codes, sorted_rows = codes[there][order], own[there][order]
                first = np.flatnonzero(np.diff(sorted_codes, prepend=-1))
                counts[part, sorted_codes[first]] += sign * np.diff(np.append(first, len(order)))
                sums[part, sorted_codes[first]] += sign * np.add.reduceat(sorted_rows, first, axis=0)

    def move(self, counts: np.ndarray, sums: np.ndarray) -> None:
        """Take in a round's changes; entries without parts stay where they are."""
        self.counts += counts
        self.sums += sums
        used = self.counts > 0
        self.entries[used] = self.sums[used] // self.counts[used][:, None]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


_STATE = "vec_id long, label {label}, v array<int>, code binary, part int, entry int, n long, s array<long>"


def _assigned(state: DataFrame, books: Codebooks, label: str) -> DataFrame:
    """The rows with their codes under these codebooks, and below them each task's changes."""
    parts, entries, width = books.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        schema = None
        for batch in batches:
            schema = batch.schema
            if not batch.num_rows:
                continue
            values = batch.column(2)
            rows = books.split(matrix(values, len(values[0])))
            known = batch.column(3)
            before = np.frombuffer(b"".join(c.as_py() for c in known), np.uint8).reshape(-1, parts).astype(np.int64) if not known.null_count else np.full((len(rows), parts), _NONE)
            after, _ = books.assign(rows)
            books.changes(rows, before, after, counts, sums)
            packed = after.astype(np.uint8).tobytes()
            code = pa.array([packed[k : k + parts] for k in range(0, len(packed), parts)], pa.binary())
            none = [pa.nulls(len(rows), t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], code, *none], names=["vec_id", "label", "v", "code", "part", "entry", "n", "s"])
        if schema is not None:
            part, entry = np.nonzero((counts != 0) | (sums != 0).any(axis=2))
            none = [pa.nulls(len(part), schema.field(k).type) for k in range(3)]
            more = [pa.nulls(len(part), pa.binary()), pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*none, *more], names=["vec_id", "label", "v", "code", "part", "entry", "n", "s"])

    return state.select("vec_id", "label", "v", "code").mapInArrow(step, _STATE.format(label=label))


def product_codes(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 1024, parts: int = 4, entries: int = ENTRIES, rounds: int = 4) -> DataFrame:
    """``vec_id, label, code array<int>, error, label_error, codebooks_sha256``."""
    if not 1 <= entries <= ENTRIES:
        raise ValueError(f"a code takes a byte: 1 to {ENTRIES} entries")
    spark = vectors.sparkSession
    kind = vectors.schema[label].dataType.simpleString()
    rows, size = integer_vectors(vectors, vector, scale, vec_id=F.col(key).cast("long"), label=F.col(label))
    if not size:
        return spark.createDataFrame([], f"vec_id long, label {kind}, code array<int>, error long, label_error long, codebooks_sha256 string")
    first = np.array([r["v"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()], np.int64)
    width = -(-size // parts)
    filled = np.zeros((len(first), parts * width), np.int64)
    filled[:, :size] = first
    books = Codebooks(filled.reshape(len(first), parts, width))

    state = rows.withColumn("code", F.lit(None).cast("binary"))
    for _ in range(rounds):
        after = materialize(_assigned(state, books, kind), "codes")
        found = after.where(F.col("part").isNotNull()).groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("s")[k]).alias(f"s{k}") for k in range(width)))
        counts, sums = np.zeros_like(books.counts), np.zeros_like(books.sums)
        for r in found.collect():  # at most a row an entry
            counts[r["part"], r["entry"]] = r["n"]
            sums[r["part"], r["entry"]] = r[3:]
        books.move(counts, sums)
        discard(*[state] if hasattr(state, "_stored_at") else [])
        state = after.where(F.col("part").isNull())
        state._stored_at = after._stored_at

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes, error = books.assign(books.split(matrix(batch.column(2), size)))
                offsets = np.arange(len(codes) + 1, dtype=np.int32) * books.shape[0]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.ListArray.from_arrays(offsets, codes.astype(np.int32).ravel()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    done = materialize(state.select("vec_id", "label", "v").mapInArrow(last, f"vec_id long, label {kind}, code array<int>, error long"), "last-codes")
    discard(*[state] if hasattr(state, "_stored_at") else [])
    totals = materialize(done.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-errors")
    return done.join(totals.withColumnRenamed("label", "its"), F.col("label").eqNullSafe(F.col("its")), "left").select("vec_id", "label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
