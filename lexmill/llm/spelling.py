"""Spelling variants: words that differ by one code point, found by two-dimensional range reporting.

Words of one length are points: their rank in forward order against their rank
when read backwards.  Words that differ from a word only at one place share what
stands before it, a range of forward ranks, and what stands after it, a range of
reverse ranks, so they are the points of a rectangle, which a wavelet tree
reports.  A word with one more code point is found the same way among the words
of the next length.

The words are not in one tree.  Of a pair, either the first or the second half
holds the difference, so the other is the same in both: each word goes into a
group by what stands outside the first half, and one by what stands outside the
second.  A group that is still large (a common beginning or ending) is split
again by halves of the region that may differ, down to a region of one place,
where a group has a word for each letter at most.  So a pair meets exactly once,
in the region that holds its difference, and no group grows with the corpus.

A word's form is its near word of largest count (ties: the smallest), if that is
``ratio`` times its own or more; its root is reached by following forms.

Defined results: null and empty texts have no words; a text of any length is read
whole; a null key reads as ``null`` where a run's hash asks for it; rows that
repeat are counted each; an empty table gives no rows; other columns play no
part.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.wavelet import WaveletTree
from lexmill.storage import discard, materialize

RUN = r"[A-Za-zÀ-ÿ]+"
#: A group of more words, or of more bytes in several words, is split; a task takes about so many bytes.
GROUP, GROUP_BYTES, SEVERAL, TASK_BYTES = 50_000, 32 << 20, 256, 8 << 20
#: Rectangles that are reported together.
RECTANGLES = 1 << 18


def words(documents: DataFrame, *, key: str = "doc_id", text: str = "text", min_length: int = 7, min_count: int = 2, noise: int | None = None) -> DataFrame:
    """``word, n``: runs of letters in lower case (A to Z only) with how often they occur.

    noise: in one of so many pairs of document and run, by a hash, the run loses
    a code point, as a slip of the pen would do.
    """
    runs = documents.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("k"), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= min_length).select("k", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    if noise:
        runs = runs.withColumn("h", F.crc32(F.concat("k", F.lit(":"), "run"))).withColumn("at", (F.col("h") % F.length("run")).cast("int"))
        slip = F.concat(F.substring("run", F.lit(1), F.col("at")), F.substring("run", F.col("at") + 2, F.length("run")))
        runs = runs.select(F.when(F.col("h") % noise == 0, slip).otherwise(F.col("run")).alias("run"))
    return runs.where(F.length("run") >= min_length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """With the group: words that are the same outside the region [a, b) of words of ``size``.

    A word that is one shorter lacks a code point of the region.
    """
    tail = F.col("b") + 1 - (F.col("size") - F.length("word"))
    around = F.xxhash64("size", "a", "b", F.substring("word", F.lit(1), F.col("a")), F.substring("word", tail, F.length("word")))
    return rows.withColumn("group", around)


def _split(rows: DataFrame, middle: Column) -> DataFrame:
    halves = F.explode(F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b").alias("b"))))
    return _keyed(rows.select("word", "n", "size", halves.alias("half")).select("word", "n", "size", F.col("half.a").alias("a"), F.col("half.b").alias("b")))


def _grouped(found: DataFrame) -> tuple[list[DataFrame], int]:
    """Rows of ``word, n, size, a, b, group`` with no large group, and their bytes."""
    rows = found.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("size"))
    rows = _split(rows.withColumns({"a": F.lit(0), "b": F.col("size")}), F.floor(F.col("size") / 2).cast("int"))
    done, total = [], 0
    while True:
        rows = materialize(rows, "spelling-groups")
        total += rows.agg(F.sum(F.length("word") + 40)).first()[0] or 0
        weight = F.sum(F.length("word") + 40)
        many = rows.where(F.col("b") - F.col("a") > 1).groupBy("group").agg(F.count("*").alias("rows"), weight.alias("bytes"))
        large = materialize(many.where((F.col("rows") > GROUP) | ((F.col("rows") > SEVERAL) & (F.col("bytes") > GROUP_BYTES))).select("group"), "large-groups")
        if large.isEmpty():
            return [*done, rows], total
        done.append(rows.join(large, "group", "left_anti"))
        # A group's region may be one place wide where another of the same hash is wider.
        wide = rows.join(large, "group", "left_semi")
        done.append(_keyed(wide.where(F.col("b") - F.col("a") == 1).select("word", "n", "size", "a", "b")))
        rows = _split(wide.where(F.col("b") - F.col("a") > 1), F.floor((F.col("a") + F.col("b")) / 2).cast("int"))


def _letters(column: list[str], size: int, width: int) -> np.ndarray:
    """Words of one size as rows of code points, which are below 256; filled with zeros to ``width``."""
    out = np.zeros((len(column), width), np.uint8)
    out[:, :size] = np.frombuffer("".join(column).encode("latin-1"), np.uint8).reshape(len(column), size)
    return out


class _Order:
    """Rows in order; for each length of a beginning, the range of ranks of ``points`` that share it."""

    def __init__(self, rows: np.ndarray, points: np.ndarray) -> None:
        self.order = np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")
        self.rank = np.empty(len(rows), np.int64)
        self.rank[self.order] = np.arange(len(rows))
        ordered = rows[self.order]
        differs = ordered[1:] != ordered[:-1]
        self.common = np.concatenate(([-1], np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1]), [-1]))
        self.before = np.concatenate(([0], np.cumsum(points[self.order])))
        #: How much of its beginning each row shares with another.
        self.shared = np.maximum(self.common[:-1], self.common[1:])[self.rank]

    def ranges(self, rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        edges = np.flatnonzero(self.common < length)
        own = np.searchsorted(edges, self.rank[rows], side="right")
        return self.before[edges[own - 1]], self.before[edges[own]]


def near_words(full: list[str], short: list[str], size: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that differ by one code point at a place of [a, b): places in ``full + short``, each pair both ways, and the words' order.

    full: distinct words of ``size``; short: of one less.
    """
    none = np.zeros(0, np.int64)
    rows = np.concatenate((_letters(full, size, size), _letters(short, size - 1, size)))
    points = np.arange(len(rows)) < len(full)
    backwards = np.zeros_like(rows)
    backwards[: len(full)] = rows[: len(full), ::-1]
    backwards[len(full) :, : size - 1] = rows[len(full) :, : size - 1][:, ::-1]
    forward, reverse = _Order(rows, points), _Order(backwards, points)
    by_forward, by_reverse = forward.order[points[forward.order]], reverse.order[points[reverse.order]]
    rank = np.empty(len(full), np.int64)
    rank[by_reverse] = np.arange(len(full))
    tree = WaveletTree(rank[by_forward])

    # Where a word shares too little of its beginning or ending with any other, its rectangle is empty.
    first, last = np.maximum(a, size - 1 - reverse.shared), np.minimum(b - 1, forward.shared)
    hopeful = np.flatnonzero(first <= last)
    turns = np.zeros(b + 2 - a, np.int64)
    np.add.at(turns, first[hopeful] - a, 1)
    np.add.at(turns, last[hopeful] + 1 - a, -1)
    left, right, waiting, held = [none], [none], [], 0

    def ask() -> None:
        nonlocal held
        own, at, low, high, least, most = (np.concatenate(c) for c in zip(*waiting, strict=True))
        which, value = tree.report(low, high, least, most)
        one, other, place = own[which], by_reverse[value], at[which]
        same_size = points[one]
        # A letter put in beside equal ones is counted where they begin.
        begins = (place == 0) | (rows[other, place - 1] != rows[other, place])
        found = np.where(same_size, one != other, begins)
        one, other, same_size = one[found], other[found], same_size[found]
        left.extend((one, other[~same_size]))
        right.extend((other, one[~same_size]))
        waiting.clear()
        held = 0

    for place in (np.flatnonzero(np.cumsum(turns) > 0) + a).tolist():
        own = hopeful[(first[hopeful] <= place) & (place <= last[hopeful])]
        for start in range(0, len(own), RECTANGLES):
            part = own[start : start + RECTANGLES]
            waiting.append((part, np.full(len(part), place), *forward.ranges(part, place), *reverse.ranges(part, size - 1 - place)))
            held += len(part)
            if held >= RECTANGLES:
                ask()
    if waiting:
        ask()
    return np.concatenate(left), np.concatenate(right), forward.rank


_PARTIAL = "word string, n long, n_near long, form_n long, form string"


def _reported(found: list[pa.RecordBatch], size: int, a: int, b: int) -> pa.RecordBatch:
    """For the words of a class, how many near ones it has and the best of them."""
    table = pa.Table.from_batches(found).combine_chunks()
    names = table.column(0).to_pylist()
    full = np.array([len(w) == size for w in names], bool)
    order = np.concatenate((np.flatnonzero(full), np.flatnonzero(~full)))
    names = [names[k] for k in order.tolist()]
    n = table.column(1).to_numpy()[order]
    at = int(full.sum())
    one, other, rank = near_words(names[:at], names[at:], size, a, b) if at else (np.zeros(0, np.int64),) * 3
    many = np.bincount(one, minlength=len(names))
    best = np.full(len(names), -1)
    if len(one):
        by = np.lexsort((rank[other], -n[other], one))
        starts = np.flatnonzero(np.diff(one[by], prepend=-1))
        best[one[by][starts]] = other[by][starts]
    # Every word is told where it is whole; where it is the shorter, if something is near.
    told = np.flatnonzero((np.arange(len(names)) < at) | (many > 0))
    none = best[told] < 0
    word = pa.array(names, pa.string())
    chosen = pa.array(best[told], pa.int64(), mask=none)
    return pa.RecordBatch.from_arrays([word.take(pa.array(told)), pa.array(n[told]), pa.array(many[told]), pa.array(n).take(chosen), word.take(chosen)], names=["word", "n", "n_near", "form_n", "form"])


def near_counts(found: DataFrame) -> DataFrame:
    """``word, n, n_near, form_n, form``: how many words are near, and the one of largest count."""
    spark = found.sparkSession
    parts, total = _grouped(found)
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = [], None
        for batch in batches:
            size, a, b = (batch.column(k).to_numpy() for k in (2, 3, 4))
            changes = np.flatnonzero((np.diff(size) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)) + 1
            for start, end in zip([0, *changes.tolist()], [*changes.tolist(), len(size)], strict=True):
                if start == end:
                    continue
                own = int(size[start]), int(a[start]), int(b[start])
                if held and own != place:
                    yield _reported(held, *place)
                    held = []
                place = own
                held.append(batch.slice(start, end - start))
        if held:
            yield _reported(held, *place)

    dealt = rows.select("word", "n", "size", "a", "b", "group").repartition(tasks, "group").sortWithinPartitions("size", "a", "b")
    partial = dealt.select("word", "n", "size", "a", "b").mapInArrow(search, _PARTIAL)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("below"), F.col("form").alias("form"))))
    counted = partial.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return counted.select("word", "n", "n_near", (-F.col("best.below")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain that ``word, form`` begins; chains must end.

    Each round doubles the steps taken, so rounds grow with the logarithm of the longest chain.
    """
    reached = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = materialize(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(reached)
        reached = after
        if after.where("moved").isEmpty():
            return after.select("word", "root")


def spelling_variants(found: DataFrame, *, ratio: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a table ``word, n`` of distinct words of code points below 256."""
    near = materialize(near_counts(materialize(found.select("word", F.col("n").cast("long").alias("n")), "words")), "near-words")
    variant = F.col("form_n") >= F.col("n") * ratio
    near = near.select("word", "n", "n_near", F.when(variant, F.col("form_n")).alias("form_n"), F.when(variant, F.col("form")).alias("form"))
    ends = roots(near.where(F.col("form").isNotNull()).select("word", "form"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
