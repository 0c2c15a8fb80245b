"""Substring deduplication by hashing lines or paragraphs.

A text is cut into units: lines by default, or paragraphs.  Units are normalised
(lower case, single spaces) and hashed to 128 bits.  Digests are grouped
globally; the occurrence of the smallest rank (key, then place) stays, and all
later ones are removed, with their offsets in code points of the original text.

Two parameters suit corpora in which short lines repeat by chance.  ``min_words``
keeps what stands together in runs of fewer words.  With ``kind="sentence"`` a line is hashed by its
sentences, so a passage is found wherever in a line it stands: sentences of fewer
than ``MIN_UNIT`` words join the next one of their line, and what is left of a
line is a unit that is told by the one before it too.

The count and the least rank of a digest are combined before the shuffle, so a
passage in a third of all documents costs a row a task.  Its occurrences meet
that one row in a join, which can be split anywhere, and are never gathered.

Defined results: null and empty texts have no units; a text of any length is cut
whole; a null key ranks last; rows that repeat key and text are alike, all first
or none; an empty table gives no spans; other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.names import unused
from lexmill.storage import discard, materialize

MIN_UNIT = 4
_SENTENCE = re.compile(r"[^\n.!?]+[.!?]*|[.!?]+")
_LINE = re.compile(r"[^\n]+")
_PARAGRAPH = re.compile(r"[^\n]+(?:\n(?!\s*\n)[^\n]+)*")
_LAST = (1 << 63) - 1


def units(text: str | None, kind: str = "line") -> list[tuple[int, int, int, bytes]]:
    """Start, end, number of words and digest of each unit."""
    if not text:
        return []
    if kind == "sentence":
        spans, open_at, words = [], None, 0
        for m in _SENTENCE.finditer(text):
            start = m.start() if open_at is None else open_at
            words += len(m[0].split())
            if words >= MIN_UNIT:
                spans.append((start, m.end(), words))
                open_at, words = None, 0
            else:
                open_at = start
            if words and (m.end() == len(text) or text[m.end()] == "\n"):
                spans.append((open_at, m.end(), words))
            if m.end() < len(text) and text[m.end()] == "\n":
                open_at, words = None, 0
    else:
        pattern = {"line": _LINE, "paragraph": _PARAGRAPH}[kind]
        spans = [(m.start(), m.end(), len(m[0].split())) for m in pattern.finditer(text)]
    out, before = [], ""
    for start, end, words in spans:
        if words:
            part = text[start:end]
            start += len(part) - len(part.lstrip())
            plain = " ".join(part.lower().split())
            # A few words are repeated by chance: they count with the unit before.
            whole = f"{before}\n{plain}" if kind == "sentence" and words < MIN_UNIT else plain
            out.append((start, end, words, xxhash.xxh3_128_digest(whole.encode())))
            before = plain
    return out


def _units_of(documents: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    source = documents.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("k"), F.xxhash64(F.col(text)).alias("h"), F.col(text).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [units(value.as_py(), kind) for value in batch.column(2)]
            many = np.array([len(x) for x in found], np.int64)
            flat = [u for x in found for u in x]
            starts, ends, words, digests = zip(*flat, strict=True) if flat else ((), (), (), ())
            of = np.repeat(np.arange(len(found)), many)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(words, pa.int32()), pa.array([n for x in found for n in range(len(x))], pa.int32())], names=["digest", "k", "h", "start", "end", "words", "no"])

    return source.mapInArrow(cut, "digest binary, k long, h long, start int, end int, words int, no int")


def repeated_spans(documents: DataFrame, *, key: str = "doc_id", text: str = "text", kind: str = "line", min_words: int = 1) -> DataFrame:
    """Stretches to remove: ``doc_id, start, end, n_words, first_doc_id, text_hash``.

    ``first_doc_id`` is the document that holds the first occurrence of the
    stretch's first unit; ``text_hash`` tells rows apart that share a key.
    """
    # Written first, so texts are cut once, and the planner can split the join where a digest is very frequent.
    found = materialize(_units_of(documents, key, text, kind), "units")
    first = materialize(found.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("k", "start")).alias("first")).where("n > 1").drop("n"), "repeated-units")
    later = found.join(first, "digest").where(F.struct("k", "start") > F.col("first")).select("k", "h", "start", "end", "words", F.col("first.k").alias("first_k"), "no")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None
        last = 0

        def table(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            none = lambda values: [None if v == _LAST else v for v in values]
            arrays = [pa.array(none(columns[0]), pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()), pa.array(none(columns[4]), pa.int64()), pa.array(columns[5], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "end", "n_words", "first_doc_id", "text_hash"])

        for batch in batches:
            rows = []
            for k, h, start, end, words, origin, no in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Only white space is between units that follow each other; repeated rows repeat the same unit.
                if held and held[0] == k and held[1] == h and no <= last + 1:
                    if no > last:
                        held[3], held[4], last = end, held[4] + words, no
                else:
                    if held and held[4] >= min_words:
                        rows.append((held[0], *held[2:], held[1]))
                    held, last = [k, h, start, end, words, origin], no
            yield table(rows)
        if held and held[4] >= min_words:
            yield table([(held[0], *held[2:], held[1])])

    # Rows that repeat key and text have the same units: one of each is enough, so no text's units are more than it has.
    later = later.groupBy("k", "h", "start").agg(*[F.first(c).alias(c) for c in ("end", "words", "first_k", "no")]).select(*later.columns)
    ordered = later.repartition("k", "h").sortWithinPartitions("k", "h", "start")
    spans = materialize(ordered.mapInArrow(merge, "doc_id long, start int, end int, n_words long, first_doc_id long, text_hash long"), "repeated-spans")
    discard(found, first)
    return spans


def remove_spans(documents: DataFrame, spans: DataFrame, *, key: str = "doc_id", text: str = "text", kept: str = "kept") -> DataFrame:
    """The documents without the spans, and in a column ``kept`` the original start and end of each stretch that stays.

    A span belongs to the rows of its key, null included, and of its text, told
    by ``text_hash``: rows that share a key but not a text keep theirs.  Spans
    that overlap or touch are one.  A null text stays null and keeps nothing; a
    row without spans keeps its whole text; columns of any other name stay, and
    one called ``kept`` is an error.
    """
    if kept.lower() in {c.lower() for c in documents.columns}:
        raise ValueError(f"{kept} is a column already: name another")
    own_key, own_hash, lists, gone, bounds = unused(documents, "key", "hash", "spans", "gone", "kept")
    by_text = spans.groupBy(F.coalesce("doc_id", F.lit(_LAST)).alias(own_key), F.col("text_hash").alias(own_hash)).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(lists))
    keyed = documents.withColumns({own_key: F.coalesce(F.col(key).cast("long"), F.lit(_LAST)), own_hash: F.xxhash64(F.col(text))})
    joined = keyed.join(by_text, [own_key, own_hash], "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    # Overlapping spans are joined: a span that begins within the one before extends it.
    merged = F.aggregate(
        F.coalesce(F.col(lists), none),
        none,
        lambda held, s: F.when((F.size(held) > 0) & (F.element_at(held, -1)["end"] >= s["start"]), F.concat(F.slice(held, 1, F.size(held) - 1), F.array(F.struct(F.element_at(held, -1)["start"].alias("start"), F.greatest(F.element_at(held, -1)["end"], s["end"]).alias("end"))))).otherwise(F.concat(held, F.array(s))),
    )
    joined = joined.withColumn(gone, F.when(F.size(F.coalesce(F.col(lists), none)) > 1, merged).otherwise(F.coalesce(F.col(lists), none)))
    whole = F.length(F.coalesce(F.col(text), F.lit("")))
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda s: s["end"]))
    ends = F.concat(F.transform(gone, lambda s: s["start"]), F.array(whole))
    stay = F.filter(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda s: s["end"] > s["start"])
    joined = joined.withColumn(bounds, F.transform(stay, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    pieces = F.array_join(F.transform(F.col(bounds), lambda s: F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"])), "")
    cut = F.when(F.col(text).isNull() | (F.size(gone) == 0), F.col(text)).otherwise(pieces)
    return joined.select(*[cut.alias(c) if c.lower() == text.lower() else F.col(c) for c in documents.columns], F.col(bounds).alias(kept))
