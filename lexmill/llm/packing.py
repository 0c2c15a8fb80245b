"""Best-fit packing of documents into token sequences by minimum bin slack.

Each document becomes its token ids and one closing id; only documents longer
than a sequence are cut.  Packing needs nothing but how many pieces there are of
each length, a histogram of at most ``capacity`` counts whatever the corpus
size.  On it, minimum bin slack takes the longest piece left, finds by a bitset
subset-sum over the lengths still available the fullest combination that fits,
and removes that combination as often as the counts allow.  The combinations
(their number is bounded by the capacity, not by the corpus) are then dealt back
to the pieces by each piece's rank within its length.

Ranks are computed in buckets of a length, so a length that a third of the
pieces share is spread over many tasks; bucket counts give the offsets.

Defined results: a null text is an empty one and becomes one piece, the closing
id alone; a null key is kept; repeated rows are packed each on its own; an empty
table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.storage import materialize

CAPACITY = 2048
CLOSE = 0
#: Entries of each of a worker's two caches.
CACHED = 500_000
#: Pieces of one length share at least so many buckets, and one more for each so many pieces.
BUCKETS, BUCKET_ROWS = 256, 100_000

#: Chunks of these characters need no normalising but lower case.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: The tokenizer's own split rule on such chunks, once in lower case.
_UNITS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others come from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in kept)
    return {b: 256 + k for k, b in enumerate(others)}


class _Units(dict):
    """Ids, as little-endian bytes, of one unit of a chunk."""

    def __init__(self, model) -> None:
        self.model, self.letters = model, _byte_letters()

    def __missing__(self, unit: str) -> bytes:
        spelled = unit.encode().decode("latin-1").translate(self.letters)
        ids = np.array([t.id for t in self.model.tokenize(spelled)], dtype="<u4").tobytes()
        if len(self) >= CACHED:
            self.clear()
        self[unit] = ids
        return ids


class TokenBytes(dict):
    """Ids, as little-endian bytes, of a chunk without spaces or line feeds.

    The tokenizer drops white space and never looks across it, so a text's ids
    are those of its chunks in turn.  Chunks of other characters than plain ones
    go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.units = _Units(self.whole.model)
        self[""] = b""

    def __missing__(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            ids = b"".join([self.units[u] for u in _UNITS.findall(chunk.lower())])
        else:
            ids = np.array(self.whole.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self) >= CACHED:
            self.clear()
            self[""] = b""
        self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_encoders: dict[str, TokenBytes] = {}


def token_bytes(path: str) -> TokenBytes:
    """This process's encoder for the tokenizer file."""
    if path not in _encoders:
        _encoders[path] = TokenBytes(path)
    return _encoders[path]


def token_pieces(documents: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's pieces."""
    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, close, step = token_bytes(tokenizer), np.uint32(CLOSE).tobytes(), 4 * capacity
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(value.as_py() or "") + close
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return source.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths that leaves the least of ``room``."""
    reach, mask, taken = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            part = min(part, left)
            taken.append((length, part, reach))
            reach |= reach << (part * length) & mask
            left -= part
            part *= 2
        if reach >> room:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, part, before in reversed(taken):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + part
            at -= part * length
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths, and how many sequences hold each, that use up all counts."""
    left, bins = {n: c for n, c in counts.items() if c > 0}, []
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError("lengths must be from 1 to the capacity")
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest(left, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[n] // m for n, m in chosen.items())
        bins.append((chosen, times))
        for n, m in chosen.items():
            left[n] -= m * times
            if not left[n]:
                del left[n]
    return bins


def _slots(bins: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows of: first rank, pieces in a sequence, first sequence, first offset."""
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    first, used = 0, {}
    for chosen, times in bins:
        offset = 0
        for length, many in chosen.items():
            slots.setdefault(length, []).append((used.get(length, 0), many, first, offset))
            used[length] = used.get(length, 0) + many * times
            offset += many * length
        first += times
    return {n: np.array(rows, dtype=np.int64) for n, rows in slots.items()}


def pack_pieces(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces that can be read again.

    ``row`` numbers the pieces in any way: equal pieces are told apart by it.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(minimum_bin_slack(counts, capacity))
    buckets = max(BUCKETS, sum(counts.values()) // BUCKET_ROWS)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    before = (
        dealt.groupBy("length", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("n")
    )
    own = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = (
        dealt.withColumn("own", F.row_number().over(own) - 1)
        .join(before, ["length", "bucket"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("before")).alias("rank"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                here = np.flatnonzero(length == n)
                rows = slots[int(n)]
                slot = rows[np.searchsorted(rows[:, 0], rank[here], side="right") - 1]
                nth = rank[here] - slot[:, 0]
                sequence[here] = slot[:, 2] + nth // slot[:, 1]
                offset[here] = slot[:, 3] + nth % slot[:, 1] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(documents: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, cut and pack all documents into as few sequences as can be found.

    A row for each piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.  The offsets of a sequence's pieces run gapless from 0.
    """
    pieces = token_pieces(documents, tokenizer, key=key, text=text, capacity=capacity).withColumn("row", F.monotonically_increasing_id())
    pieces = materialize(pieces, "pieces")
    return pack_pieces(pieces, capacity=capacity)
