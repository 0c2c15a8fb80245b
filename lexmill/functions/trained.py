"""A segmenter that learns abbreviations and sentence starters from raw text.

Whether a full stop ends a sentence depends on the word before it.  A word that
stands before a full stop far more often than chance has it, by Dunning's
log-likelihood ratio, is an abbreviation, the more so the shorter it is and the
more stops it holds inside; how often it stands without a stop counts against it
(Kiss and Strunk, 2006).  After an abbreviation a sentence begins only with a
word that starts sentences far more often than chance has it.

Counts are sums over texts, so they are learned on executors, a language at a
time; what travels are the words of a language that pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import stretches
from lexmill.storage import discard, materialize

# The bounds of the published method.
ABBREVIATION, STARTER = 0.3, 30.0
#: Words seen fewer times before a stop teach nothing.
SEEN = 3
#: Different tokens that a task holds.
HELD = 1 << 18
_EDGE = "\"'“”‘’«»()[]{}"
_EDGES = re.escape(_EDGE)
#: What follows a token that ends with another sign than a stop, that holds edges alone, or that ends its line.
_SURE = re.compile(rf"[!?\n{_EDGES}](?:(?<=[!?])[{_EDGES}]*\s+|(?<=\S\n)\s*|(?<=[{_EDGES}])(?<!\S.)[{_EDGES}]*\s+)(?=(\S+))")
_NEXT = re.compile(r"\S+")
_STOP = re.compile(r"([.!?؟。！？।॥]+)[\"'»”’)\]}]*(?=\s|$)")


def log_likelihood(together: float, first: float, second: float, total: float) -> float:
    """Twice the logarithm of how much likelier two things go together at their own rate than at the rate of the second; 0 where they go less."""
    if not first or together / first <= second / total:
        return 0.0

    def likelihood(k: float, n: float, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n - k else 0.0)

    p = min(second / total, 1 - 1e-12)
    return 2 * (likelihood(together, first, min(together / first, 1 - 1e-12)) - likelihood(together, first, p))


def tokens_of(text: str) -> tuple[list[str], list[str]]:
    """All tokens as they stand, and those after a sign that surely ends a sentence, which the first is too."""
    tokens = text.split()
    return tokens, tokens[:1] + _SURE.findall(text)


def folded(tokens: Counter, begins: Counter) -> dict[str, list[int]]:
    """How often each word stands before a stop, otherwise, and after a sign that surely ends a sentence."""
    out: dict[str, list[int]] = {}
    for counts, first in ((tokens, False), (begins, True)):
        for raw, n in counts.items():
            token = raw.strip(_EDGE)
            if first and token[:1].islower():
                continue
            word = token.rstrip(".!?,;:").casefold()
            if word.isalpha() or any(map(str.isalpha, word)):
                out.setdefault(word, [0, 0, 0])[2 if first else not token.endswith(".")] += n
    return out


def word_counts(text: str) -> Counter:
    """``(kind, word)`` by count: ``.`` before a stop, ``-`` otherwise, ``>`` after a sign that surely ends a sentence, ``#`` for those and all words."""
    tokens, begins = tokens_of(text)
    out: Counter = Counter()
    for word, (stopped, free, begun) in folded(Counter(tokens), Counter(begins)).items():
        out.update({(".", word): stopped, ("-", word): free, (">", word): begun, ("#", "words"): stopped + free, ("#", "stops"): stopped, ("#", "starts"): begun})
    return +out


@dataclass(frozen=True)
class Learned:
    """What a language's texts taught."""

    abbreviations: frozenset[str]
    starters: frozenset[str]


def abbreviation_score(word: str, stopped: int, free: int, words: int, stops: int) -> float:
    """The likelihood ratio, less for long words and those that also stand without a stop, more for stops inside."""
    inner = word.count(".")
    letters = len(word) - inner
    return log_likelihood(stopped, stopped + free, stops, words) * math.exp(-letters) * (inner + 1) * math.exp(-free * math.log(letters)) if letters else 0.0


def train(texts: DataFrame, *, text: str = "text", language: str = "lang") -> dict[str, Learned]:
    """Abbreviations and starters by language.

    Null and empty texts teach nothing; a null language is that of the empty name.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tokens as they stand are counted whole; only different ones are taken apart.
        held: dict[str, tuple[Counter, Counter]] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for name, both in held.items():
                words = folded(*both)
                counts = np.array(list(words.values()), np.int64).reshape(-1, 3)
                # All words together come as a row without a word.
                counts = np.concatenate((counts, counts.sum(axis=0, keepdims=True)))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(counts)), pa.array([*words, None], pa.string()), *(pa.array(c) for c in counts.T.copy())], names=["l", "word", "stopped", "free", "begins"])
            held.clear()

        for batch in batches:
            for at, size in stretches(batch.column(0)):
                part = batch.slice(at, size)
                for value, name in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for counts, found in zip(held.setdefault(name, (Counter(), Counter())), tokens_of(value), strict=True):
                        counts.update(found)
                if sum(len(c) for both in held.values() for c in both) > HELD:
                    yield from emit()
        yield from emit()

    source = texts.where(F.col(text).isNotNull()).select(F.col(text).alias("t"), F.coalesce(language, F.lit("")).alias("l"))
    counted = source.mapInArrow(count, "l string, word string, stopped long, free long, begins long").groupBy("l", "word").agg(*(F.sum(c).alias(c) for c in ("stopped", "free", "begins")))
    # Read twice, counted once.
    counted = materialize(counted.where(F.col("word").isNull() | (F.col("stopped") >= SEEN) | (F.col("begins") >= SEEN)), "word-counts")
    totals = counted.where("word is null").select("l", (F.col("stopped") + F.col("free")).alias("words"), F.col("stopped").alias("stops"), F.col("begins").alias("starts"))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                seen = r.stopped + r.free
                if r.stopped >= SEEN and abbreviation_score(r.word, r.stopped, r.free, r.words, r.stops) >= ABBREVIATION:
                    out.append((r.l, "abbreviation", r.word))
                if r.begins >= SEEN and log_likelihood(r.begins, seen, r.starts, r.words) >= STARTER:
                    out.append((r.l, "starter", r.word))
            yield pd.DataFrame(out, columns=["l", "what", "word"])

    table = counted.where("word is not null").join(totals, "l")
    found: dict[str, dict[str, set[str]]] = {}
    for r in table.mapInPandas(judge, "l string, what string, word string").collect():
        found.setdefault(r["l"], {"abbreviation": set(), "starter": set()})[r["what"]].add(r["word"])
    discard(counted)
    return {name: Learned(frozenset(w["abbreviation"]), frozenset(w["starter"])) for name, w in found.items()}


_NOTHING = Learned(frozenset(), frozenset())


def split(text: str, learned: Learned = _NOTHING) -> list[str]:
    """The sentences of a text, without the white space between them; a line that ends ends one."""
    out = []
    for line in text.split("\n"):
        since = 0
        for end in _STOP.finditer(line):
            rest = _NEXT.search(line, end.end())
            if not rest:
                continue
            following = rest[0].strip(_EDGE)
            if following[:1].islower():
                continue
            if end[1] == ".":
                before = line[since : end.start()].rsplit(maxsplit=1)
                word = before[-1].strip(_EDGE).casefold() if before else ""
                starts = following.rstrip(".!?,;:").casefold() in learned.starters
                if (word in learned.abbreviations or (len(word) == 1 and word.isalpha())) and not starts:
                    continue
            out.append(line[since : end.end()].strip())
            since = end.end()
        out.append(line[since:].strip())
    return out


class TrainedSegmenter:
    """What ``train`` gives, as a segmenter; languages that were not learned have no abbreviations but initials."""

    def __init__(self, learned: dict[str, Learned]) -> None:
        self.learned = learned

    def __call__(self, texts: Sequence[str], languages: Sequence[str]) -> list[list[str]]:
        return [split(t, self.learned.get(x, _NOTHING)) for t, x in zip(texts, languages, strict=True)]
