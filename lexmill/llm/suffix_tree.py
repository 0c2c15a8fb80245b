"""Language-model scores by a probabilistic suffix tree.

Symbols are all tokens (words between ASCII white space, A to Z in lower case)
and an end sign; a context is up to ``DEPTH`` symbols of
one text, read backwards.  Every context seen at least ``MIN_CONTEXT`` times is a
candidate, so the tree grows with the corpus.  Of its next symbols, seen at least
``MIN_NEXT`` times there, those are kept of which there are so many more than the
context one symbol shorter lets expect that half the Poisson deviance passes half the
logarithm of the context's count n.  A context is retained if its distribution
diverges from the shorter one's: if the summed log ratio of the kept symbols, and
of all others as one, passes half the logarithm of n for each of them.  Suffixes
of retained contexts are retained.

A distribution is smoothed by the shorter context's: each kept next symbol of
count m has (m - DISCOUNT) / n, and what is left, ``back``, is shared out as the
shorter context does.  The empty context has (c + 1) / (N + V + 1), like the base score.
A token is scored from the longest retained suffix of what is before it.

Counts cover the whole corpus, level by level: the grams of a level are counted
only after candidates, which the level before has counted.  Tokens and contexts
are known by 64-bit hashes.  Most grams consist of the ``HEAD`` most frequent words
alone, whose numbers are broadcast: such a gram travels as one number, the difference
to the one before it; the others as hashes.  Either are dealt by what they are to
buckets that grow in number with the corpus, and are added up there.

The tree is a table, and so is the vocabulary; a block of texts of about
``BLOCK_BYTES`` asks for each key it needs once, many in one row, and what answers
holds a range of keys.  The ``HEAD`` most frequent keys are broadcast: nearly every
block would ask for them, so what is asked for is rare.  Flags of fixed size
(``FLAGS`` bits) spare most questions without an answer; flags that are set by chance
only cost.

Texts are scored in ``ROUNDS``.  A round's scores are written and its shuffle files
go before the next begins.

Defined results: a null text counts as an empty one, which is the end sign
alone; a null key is scored and learned from; repeated rows count each time; no
limit on a text's length; without training documents both scores are those of
the one unknown symbol, 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.packed import pack, unpack
from lexmill.llm.tokens import chain, distinct, slices, token_hashes
from lexmill.storage import discard, materialize, release

DEPTH = 3
MIN_CONTEXT, MIN_NEXT = 128, 4
DISCOUNT = 0.5
BLOCK_BYTES = 32 << 20
#: Blocks of a round that even a small input has, if it has so many bytes for each.
LEAST_BLOCKS, LEAST_BYTES = 12, 1 << 16
#: Tokens for each bucket of grams; buckets that any input has, an odd number.
BUCKET_TOKENS, LEAST_BUCKETS = 1 << 21, 65
HEAD = 1 << 17
FLAGS = 1 << 26
ROUNDS = 2
#: Seconds until no event of a query that has ended holds its plan.
SETTLE = 1.0
#: Tokens that a task takes at once; distinct grams that it holds.
CHUNK, HELD = 1 << 18, 1_200_000
#: Symbols that are no word's hash: any next symbol, and the end sign.
ANY, END = 0, 1


_ROOT = np.zeros(1, np.uint64)


def gram_keys(contexts: np.ndarray, following: np.ndarray | int) -> np.ndarray:
    """The key of a context with a next symbol: Spark's xxhash64 of both."""
    return chain(chain(np.full(1, 42, np.uint64), contexts), np.asarray(following, np.uint64))


def context_codes(stream: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each length from 1, the code of the context before each symbol of a text after its first, which is an end sign.

    0 where the text has no context of that length; the end sign may begin one.
    """
    n, out, code, alive = len(stream) - 1, [], np.broadcast_to(_ROOT, (len(stream) - 1,)), np.ones(max(0, len(stream) - 1), bool)
    for lag in range(1, depth + 1):
        before = np.full(n, END, np.uint64)
        before[lag - 1 :] = stream[: max(0, n - lag + 1)]
        alive = alive & (np.arange(n) >= lag - 1)
        if lag > 1:
            alive[lag - 1 :] &= stream[1 : max(1, n - lag + 2)][: max(0, n - lag + 1)] != END
        code = np.where(alive, chain(code, before), 0)
        out.append(code)
    return out


def flagged(flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's flag is set."""
    at = keys & np.uint64(FLAGS - 1)
    return (flags[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def flags_of(keys: DataFrame, column: str) -> np.ndarray:
    """Flags of the column's keys, made by executors."""
    slot = F.col(column).bitwiseAND(F.lit(FLAGS - 1)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).toArrow()
    size = 4096
    out = np.zeros(max(FLAGS // 8, size), np.uint8)
    for part, bits in zip(parts["part"].to_pylist(), parts["bits"].to_pylist(), strict=True):
        out[(part - 1) * size : part * size] = np.frombuffer(bits, np.uint8)
    return out


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts the keys, and where in it runs of equal ones begin."""
    order = np.argsort(keys)
    keys = keys[order]
    return order, np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else order


class _Counts:
    """Counts of grams, combined as they grow.  The columns ``by`` tell a gram."""

    def __init__(self, by: slice) -> None:
        self.by, self.parts, self.size = by, [], 0

    def add(self, *columns: np.ndarray, n: np.ndarray | None = None) -> None:
        if len(columns[0]):
            self.parts.append(self._combined(columns, np.ones(len(columns[0]), np.int64) if n is None else n))
            self.size += len(self.parts[-1][-1])

    def _combined(self, columns: tuple[np.ndarray, ...], n: np.ndarray) -> tuple[np.ndarray, ...]:
        told = columns[self.by]
        order, firsts = _grouped(told[0] if len(told) == 1 else gram_keys(*told))
        return (*(c[order[firsts]] for c in columns), np.add.reduceat(n[order], firsts))

    def combine(self) -> None:
        if len(self.parts) > 1:
            *columns, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            self.parts = []
            self.parts = [self._combined(tuple(columns), n)]
            self.size = len(self.parts[0][-1])

    def take(self) -> tuple[np.ndarray, ...] | None:
        """All columns and the counts, combined; they are given up here."""
        self.combine()
        out, self.parts, self.size = self.parts[0] if self.parts else None, [], 0
        return out


class Words:
    """Numbers from 1 of frequent words, the most frequent first; 0 for all others."""

    def __init__(self, hashes: np.ndarray) -> None:
        order = np.argsort(hashes)
        self.hashes, self.sorted, self.numbers = hashes, hashes[order], order + 1

    def __call__(self, symbols: np.ndarray, bits: int) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(symbols), np.int64)
        at = np.minimum(np.searchsorted(self.sorted, symbols), len(self.sorted) - 1)
        found = np.where(self.sorted[at] == symbols, self.numbers[at], 0)
        return np.where(found < 1 << bits, found, 0)


def _bits(depth: int) -> int:
    """Bits of a word's number in the number of a gram: a context's words, the nearest last, and the next symbol, 0 for any."""
    return min(17, 62 // (depth + 1))


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Symbols of whole texts, many at once, each text ended by an end sign; one comes first too.  The text is the first column."""
    held, size = [np.array([END], np.uint64)], 1
    for batch in batches:
        for data, bounds in slices(batch.column(0)):
            hashes, counts = token_hashes(data, bounds)
            own = np.full(len(hashes) + len(counts), END, np.uint64)
            own[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes
            held.append(own)
            size += len(own)
            if size >= CHUNK:
                yield np.concatenate(held)
                held, size = [np.array([END], np.uint64)], 1
    if size > 1:
        yield np.concatenate(held)


def gram_counts(texts: DataFrame, depth: int, candidates: np.ndarray, wanted: np.ndarray, words: Words, total: int, min_context: int) -> DataFrame:
    """``context, parent, next, n`` of contexts of one length that are seen often enough, and of their next symbols that are.

    candidates: flags of the contexts' keys in the level before: of the context
    but for its last symbol with that symbol next, or of words.  wanted: flags of
    next symbols that are frequent enough to matter.  ``next`` is ``ANY`` for the
    context's own count.  total: the texts' tokens.
    """
    shared = texts.sparkSession.sparkContext.broadcast((candidates, wanted, words))
    bits, buckets = _bits(depth), LEAST_BUCKETS + 2 * (total // (2 * BUCKET_TOKENS))

    def deal(at: np.ndarray, columns: tuple[np.ndarray, ...], kind: int) -> Iterator[pa.RecordBatch]:
        """Rows of each bucket, where the first column ascends."""
        order = np.argsort(at, kind="stable")
        bounds = np.searchsorted(at[order], np.arange(buckets + 1))
        columns = tuple(c[order] for c in columns)
        here = np.flatnonzero(np.diff(bounds))
        blobs = [pack(*(c[bounds[k] : bounds[k + 1]] for c in columns)) for k in here.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(here.astype(np.int32)), pa.array(np.full(len(here), kind, np.int32)), pa.array(np.diff(bounds)[here].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "kind", "size", "grams"])

    def emit(numbered: _Counts, hashed: _Counts) -> Iterator[pa.RecordBatch]:
        if found := numbered.take():
            codes, n = found
            yield from deal(codes % buckets, (codes // buckets, n), 0)
        if found := hashed.take():
            order = np.argsort(found[0])
            found = tuple(c[order] for c in found)
            yield from deal((gram_keys(found[0], found[2]) % np.uint64(buckets)).astype(np.int64), found, 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, enough, head = shared.value
        numbered, hashed = _Counts(slice(0, 1)), _Counts(slice(0, 3, 2))
        for stream in _streams(batches):
            codes = context_codes(stream, depth)
            # The context before a symbol was, one symbol earlier, a shorter context and its next symbol.
            keys = stream[:-1] if depth == 1 else np.concatenate((_ROOT, gram_keys(codes[-2][:-1], stream[1:-1])))
            here = np.flatnonzero(flagged(flags, keys) & (codes[-1] != 0))
            # Numbers of all symbols, or only of those around contexts where there are few.
            all_ = head(stream, bits) if len(here) * (depth + 1) > len(stream) else None
            known, code = np.ones(len(here), bool), np.zeros(len(here), np.int64)
            for lag in range(depth - 1, -2, -1):
                following = head(stream[here - lag], bits) if all_ is None else all_[here - lag]
                if lag >= 0:
                    known &= following > 0
                    code = code << bits | following
            both = known & (following > 0)
            numbered.add(code[known] << bits)
            numbered.add(code[both] << bits | following[both])
            parents = codes[-2] if depth > 1 else np.zeros(len(codes[-1]), np.uint64)
            for at, symbols in ((here[~known], None), (here[~both], stream[1:][here[~both]])):
                if symbols is not None:
                    some = flagged(enough, symbols)
                    at, symbols = at[some], symbols[some]
                hashed.add(codes[-1][at], parents[at], np.full(len(at), ANY, np.uint64) if symbols is None else symbols)
            for counts in (numbered, hashed):
                if counts.size > HELD:
                    counts.combine()
            if max(numbered.size, hashed.size) > HELD:
                yield from emit(numbered, hashed)
        yield from emit(numbered, hashed)

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        head, bucket = shared.value[2].hashes, key[0].as_py()
        counts = (_Counts(slice(0, 1)), _Counts(slice(0, 3, 2)))
        for kind, size, grams in zip(*(rows.column(c).to_pylist() for c in ("kind", "size", "grams")), strict=True):
            *columns, n = unpack(grams, size, 4 if kind else 2)
            counts[kind].parts.append((*columns, n.view(np.int64)))
        out = []
        for kind, held in enumerate(counts):
            if (found := held.take()) is None:
                continue
            least = np.where((found[0] * np.uint64(buckets) + np.uint64(bucket)) & np.uint64((1 << bits) - 1) == 0 if kind == 0 else found[2] == ANY, min_context, MIN_NEXT)
            found = tuple(c[found[-1] >= least] for c in found)
            if kind == 0:
                code = (found[0] * np.uint64(buckets) + np.uint64(bucket)).astype(np.int64)
                symbol = [np.concatenate(([np.uint64(ANY)], head))[code >> (bits * k) & ((1 << bits) - 1)] for k in range(depth + 1)]
                context = parent = np.zeros(len(code), np.uint64)
                for one in symbol[1:]:
                    parent, context = context, chain(context, one)
                found = (context, parent, symbol[0], found[-1])
            out.append(found)
        return pa.table({name: np.concatenate([np.empty(0, np.int64), *(x[k].view(np.int64) for x in out)]) for k, name in enumerate(("context", "parent", "next", "n"))})

    rows = texts.select("text").mapInArrow(count, "bucket int, kind int, size int, grams binary")
    return rows.groupBy("bucket").applyInArrow(add, "context long, parent long, next long, n long")


def vocabulary(texts: DataFrame) -> DataFrame:
    """``next``, a token's hash or the end sign, and its count ``n`` in the column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def emit() -> Iterator[pa.RecordBatch]:
            keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            n = np.bincount(place, np.concatenate([c for _, c in held])).astype(np.int64)
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["next", "n"])

        for stream in _streams(batches):
            order, firsts = _grouped(stream[1:])
            held.append((stream[1:][order[firsts]], np.diff(np.concatenate((firsts, [len(order)])))))
            if sum(len(k) for k, _ in held) > HELD:
                yield from emit()
        if held:
            yield from emit()

    return texts.select("text").mapInArrow(count, "next long, n long").repartition("next").groupBy("next").agg(F.sum("n").alias("n"))


def _level(counts: DataFrame, above: DataFrame, on: list[str], min_context: int) -> tuple[DataFrame, DataFrame]:
    """Contexts (``context, parent, n, back, kept``) and their grams (``context, parent, next, n, p, own``) of one length.

    above: chances ``q`` of next symbols by the shorter context, to be joined on
    ``on``.  own: whether the context keeps the symbol; the others' chance is the
    shorter context's share of what is left.
    """
    total = counts.where((F.col("next") == ANY) & (F.col("n") >= min_context)).select("context", "parent", F.col("n").alias("total"))
    grams = counts.where((F.col("next") != ANY) & (F.col("n") >= MIN_NEXT)).join(total.drop("parent"), "context").join(above, on)
    n, all_, q = F.col("n").cast("double"), F.col("total").cast("double"), F.col("q")
    own = (n > all_ * q) & (n * F.log(n / (all_ * q)) - n + all_ * q >= F.log(all_) / 2)
    grams = materialize(grams.select("context", "parent", "next", "n", "total", "q", own.alias("own")), "grams")
    sums = grams.where("own").groupBy("context").agg(F.sum(n).alias("seen"), F.count("*").alias("kinds"), F.sum("q").alias("q"), F.sum(n * F.log(n / all_ / q)).alias("gain"))
    rest = all_ - F.col("seen")
    # What is not among the kept symbols is one more kind.
    gain = F.col("gain") + F.when(rest > 0, rest * F.log(rest / all_ / F.greatest(1 - q, F.lit(1e-12)))).otherwise(0.0)
    kept = F.coalesce(gain >= (F.col("kinds") + 1) * F.log(all_) / 2, F.lit(False))
    back = F.coalesce(1 - (F.col("seen") - DISCOUNT * F.col("kinds")) / all_, F.lit(1.0))
    contexts = materialize(total.join(sums, "context", "left").select("context", "parent", F.col("total").alias("n"), back.alias("back"), kept.alias("kept")), "contexts")
    p = F.col("back") * q + F.when(F.col("own"), (n - DISCOUNT) / all_).otherwise(0.0)
    chances = materialize(grams.join(contexts.select("context", "back"), "context").select("context", "parent", "next", "n", p.alias("p"), "own"), "chances")
    discard(grams)
    return contexts, chances


def learn(texts: DataFrame, words: DataFrame, total: int, kinds: int, *, depth: int = DEPTH, min_context: int = MIN_CONTEXT) -> DataFrame:
    """The tree of the column ``text`` as a table ``key, v, n``.

    key: that of a retained context and a next symbol, whose chance has the
    logarithm v; of a retained context and 0, the logarithm of its ``back``.
    """
    flags, wanted = (flags_of(words.where(F.col("n") >= least), "next") for least in (min_context, MIN_NEXT))
    above, on = words.where(F.col("n") >= MIN_NEXT).select("next", ((F.col("n") + 1) / F.lit(float(total + kinds + 1))).alias("q")), ["next"]
    often = words.where(F.col("n") >= MIN_NEXT)
    often = often.where(_frequent(often)).toArrow()
    head = Words(often["next"].to_numpy().view(np.uint64)[np.argsort(-often["n"].to_numpy(), kind="stable")])
    levels: list[tuple[DataFrame, DataFrame]] = []
    for length in range(1, depth + 1):
        counts = materialize(gram_counts(texts, length, flags, wanted, head, total, min_context), "gram-counts")
        release(texts.sparkSession, settle=SETTLE)
        levels.append(_level(counts, above, on, min_context))
        discard(counts)
        chances = levels[-1][1]
        frequent = chances.where((F.col("n") >= min_context) & (F.col("next") != END))
        if length == depth or not frequent.take(1):
            break
        flags = flags_of(frequent.select(F.xxhash64("context", "next").alias("key")), "key")
        above, on = chances.select(F.col("context").alias("parent"), "next", F.col("p").alias("q")), ["parent", "next"]
    out, longer = None, None
    for contexts, chances in reversed(levels):
        kept = contexts.where("kept") if longer is None else contexts.join(longer, "context", "left").where(F.col("kept") | F.col("needed").isNotNull())
        longer = kept.select(F.col("parent").alias("context")).distinct().withColumn("needed", F.lit(True))
        own = kept.select(F.xxhash64("context", F.lit(ANY).cast("long")).alias("key"), F.log10("back").alias("v"), "n")
        own = own.union(chances.where("own").join(kept.select("context"), "context", "left_semi").select(F.xxhash64("context", "next").alias("key"), F.log10("p").alias("v"), "n"))
        out = own if out is None else out.union(own)
    out = materialize(out, "suffix-tree")
    for level in levels:
        discard(*level)
    return out


class Lookup:
    """Values of sorted keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The key's value, or not a number."""
        if not len(self.keys):
            return np.full(len(keys), np.nan)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.nan)


class Tree:
    """Scores by what two tables of keys, the frequent and a block's own, know."""

    def __init__(self, head: Lookup, flags: np.ndarray, total: int, kinds: int, depth: int) -> None:
        self.head, self.flags, self.total, self.kinds, self.depth = head, flags, total, kinds, depth

    def find(self, keys: np.ndarray, own: Lookup) -> np.ndarray:
        """Values of the keys; only those with a flag are looked up."""
        out = np.full(len(keys), np.nan)
        here = np.flatnonzero(flagged(self.flags, keys))
        order, firsts = _grouped(keys[here])
        once = keys[here[order[firsts]]]
        found = self.head(once)
        gaps = np.flatnonzero(np.isnan(found))
        found[gaps] = own(once[gaps])
        out[here[order]] = np.repeat(found, np.diff(np.concatenate((firsts, [len(order)]))))
        return out

    def questions(self, stream: np.ndarray) -> np.ndarray:
        """Distinct keys that the symbols need, the head does not have, and the tables may have."""
        out, here = [stream[1:]], np.arange(len(stream) - 1)
        for code in context_codes(stream, self.depth):
            here = here[code[here] != 0]
            keys = gram_keys(code[here], ANY)
            some = flagged(self.flags, keys)  # a context is in the tables only if its suffixes are
            here = here[some]
            out += [keys[some], gram_keys(code[here], stream[1:][here])]
        found = np.empty(0, np.uint64)
        for keys in out:
            keys = distinct(keys[flagged(self.flags, keys)])
            found = np.concatenate((found, keys[np.isnan(self.head(keys))]))
        return distinct(found)

    def score(self, stream: np.ndarray, own: Lookup) -> tuple[np.ndarray, np.ndarray]:
        """Counts, and log10 chances from the longest retained suffix, of each symbol after the first."""
        counts = np.nan_to_num(self.find(stream[1:], own))
        best = np.log10((counts + 1) / (self.total + self.kinds + 1))
        here = np.arange(len(counts))
        for code in context_codes(stream, self.depth):
            here = here[code[here] != 0]
            back = self.find(gram_keys(code[here], ANY), own)
            some = ~np.isnan(back)  # retained, and so are all its suffixes
            here, back = here[some], back[some]
            p = self.find(gram_keys(code[here], stream[1:][here]), own)
            best[here] = np.where(np.isnan(p), best[here] + back, p)
        return counts, best


def _frequent(rows: DataFrame) -> Column:
    """Whether a row is of the most frequent by ``n``: as many steps of the binary logarithm as fit in ``HEAD``."""
    step = F.floor(F.log2("n") * 16).cast("int")
    steps, held, least = {r["step"]: r["rows"] for r in rows.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()}, 0, None
    for at in sorted(steps, reverse=True):
        held += steps[at]
        if held > HEAD:
            break
        least = at
    return F.lit(False) if least is None else step >= least


def _packed(blocks: np.ndarray | int, parts: np.ndarray, columns: list[tuple[np.ndarray, ...]]) -> pa.Table:
    """Rows of ``_PACKED``."""
    arrays = [np.array(np.broadcast_to(np.asarray(blocks, np.int32), len(parts))), parts.astype(np.int32), np.array([len(x[0]) for x in columns], np.int32)]
    return pa.table([*map(pa.array, arrays), pa.array([pack(*x) for x in columns], pa.binary())], names=["blk", "part", "size", "found"])


_PACKED = "blk int, part int, size int, found binary"
_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(documents: DataFrame, *, learn_from: Column | None = None, key: str = "doc_id", text: str = "text", min_context: int = MIN_CONTEXT) -> DataFrame:
    """Scores of all whole texts.

    learn_from: a condition on the documents to learn from (by default all).
    Columns: the key as ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (unigrams, add one), ``score`` (the tree's
    log10 probability).
    """
    training = F.lit(True) if learn_from is None else F.coalesce(learn_from, F.lit(False))
    source = documents.select(F.col(key).cast("long").alias("doc_id"), training.alias("training"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    learned = source.where("training").select("text")
    words = materialize(vocabulary(learned), "vocabulary")
    sums = words.agg(F.count("*").alias("kinds"), F.sum("n").alias("n")).first()
    total, kinds = sums["n"] or 0, sums["kinds"]
    tree = learn(learned, words, total, kinds, min_context=min_context)
    known = materialize(tree.union(words.select(F.col("next").alias("key"), F.col("n").cast("double").alias("v"), "n")), "known-keys")
    discard(tree, words)
    frequent = _frequent(known)
    head = known.where(frequent).select("key", "v").toArrow()
    model = Tree(Lookup(head["key"].to_numpy().view(np.uint64), head["v"].to_numpy()), flags_of(known, "key"), total, kinds, DEPTH)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(size // (BLOCK_BYTES * ROUNDS), min(LEAST_BLOCKS, size // (LEAST_BYTES * ROUNDS))) + 1
    # As many ranges of keys, in bits: both what is known and what is asked for in one then stay as large as they are.
    span = max(6, (4 * blocks).bit_length())

    def ask(key: tuple, block: pa.Table) -> pa.Table:
        tree, found, fresh = shared.value, np.empty(0, np.uint64), []
        for stream in _streams(block.select(["text"]).to_batches()):
            fresh.append(tree.questions(stream))
            if sum(map(len, fresh)) > max(len(found), HELD):
                found, fresh = distinct(np.concatenate((found, *fresh))), []
        found = distinct(np.concatenate((found, *fresh)))
        bounds = np.searchsorted((found >> np.uint64(64 - span)).astype(np.int64), np.arange((1 << span) + 1))
        here = np.flatnonzero(np.diff(bounds))
        return _packed(key[0].as_py(), here, [(found[bounds[k] : bounds[k + 1]],) for k in here.tolist()])

    def answer(asked: pa.Table, rows: pa.Table) -> pa.Table:
        own, out = Lookup(rows.column("key").to_numpy().view(np.uint64), rows.column("v").to_numpy()), []
        for size, keys in zip(asked.column("size").to_pylist(), asked.column("found").to_pylist(), strict=True):
            (keys,) = unpack(keys, size, 1)
            values = own(keys)
            some = ~np.isnan(values)
            out.append((keys[some], values[some]))
        return _packed(asked.column("blk").to_numpy().astype(np.int32), asked.column("part").to_numpy(), out)

    def rate(block: pa.Table, found: pa.Table) -> pa.Table:
        known = [np.empty((2, 0), np.uint64), *(unpack(x, n, 2) for n, x in zip(found.column("size").to_pylist(), found.column("found").to_pylist(), strict=True))]
        keys, values = np.concatenate(known, axis=1)
        tree, own = shared.value, Lookup(keys, values.view(np.float64))
        del known, keys, values
        columns: list[list[np.ndarray]] = [[np.empty(0, t)] for t in (np.int64, np.int64, np.float64, np.float64)]
        for stream in _streams(block.select(["text"]).to_batches()):
            counts, chances = tree.score(stream, own)
            ends = np.flatnonzero(stream[1:] == END)
            firsts = np.concatenate(([0], ends[:-1] + 1))
            base = np.log10((counts + 1) / (tree.total + tree.kinds + 1))
            for column, values in zip(columns, (np.diff(np.concatenate(([-1], ends))), np.add.reduceat((counts > 0).astype(np.int64), firsts), np.add.reduceat(base, firsts), np.add.reduceat(chances, firsts)), strict=True):
                column.append(values)
        many, n_known, base, chances = (np.concatenate(c) for c in columns)
        arrays = [block.column("doc_id").combine_chunks(), pa.array(~block.column("training").to_numpy(zero_copy_only=False).astype(bool)), pa.array(many), pa.array(n_known), pa.array(np.full(len(many), tree.total)), pa.array(base), pa.array(chances)]
        return pa.table(dict(zip(["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"], arrays, strict=True)))

    # Only keys that are not broadcast are asked for.
    rare = known.where(~frequent).select(F.shiftrightunsigned("key", 64 - span).cast("int").alias("part"), "key", "v")
    rounds = []
    for turn in range(ROUNDS):
        # The round is told by what a row holds, so every row has one; its place in the input deals it to a block, so rows that repeat are spread.
        own = source.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == turn)
        dealt = own.withColumn("blk", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")).repartition("blk")
        asked = dealt.groupBy("blk").applyInArrow(ask, _PACKED)
        answers = asked.groupBy("part").cogroup(rare.groupBy("part")).applyInArrow(answer, _PACKED)
        rounds.append(materialize(dealt.groupBy("blk").cogroup(answers.groupBy("blk")).applyInArrow(rate, _SCHEMA), "suffix-scores"))
        del own, dealt, asked, answers
        release(documents.sparkSession, settle=SETTLE)
    discard(known)
    return reduce(DataFrame.union, rounds)
