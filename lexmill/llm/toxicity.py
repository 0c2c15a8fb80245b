"""Toxicity by a counterfactually regularised classifier.

The model is a logistic regression on words and word beginnings, hashed to
``BUCKETS`` numbers.  Besides the loss on labels it penalises the squared change
of its logit between a labelled sentence that names a group and two kinds of
counterfactuals: the same sentence with that name swapped for another, and
without it.  So neither which group is named nor that one is named at all moves
a score, and a neutral mention is not taken for toxic.

Statistics for choosing features, and the features of the training rows, come
from executors, which are sent the labelled texts alone.  The labelled rows to
fit on are bounded by ``max_rows``, a documented parameter; within it the choice
is by hash, alike at every size.  What is broadcast is bounded by ``max_rows`` and
``BUCKETS``.

Defined results: a null text counts as an empty one, whose score is the model's
bias alone; a text of any length is scored whole; a null key is scored and never
trains; rows labelled null are ignored and a key labelled twice is toxic if one
label says so; of rows that repeat a key the one of the least text trains; with
no labelled rows of a class every score is that of the other class (0 without
labels); repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.storage import discard, materialize

THRESHOLD = 0.7
MAX_ROWS = 20_000
BUCKETS = 1 << 20
MIN_ROWS = 3
#: Words, and beginnings, whose numbers a worker keeps.
CACHED = 500_000

# Names of groups that are swapped for one another, by language.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("gay", "straight"), ("lesbian", "heterosexual"), ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("african", "european", "american", "mexican", "chinese", "indian", "arab"), ("immigrants", "citizens", "refugees", "natives"), ("disabled", "blind", "deaf", "elderly", "young"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("noirs", "blancs"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("negros", "blancos"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("schwarze", "weiße"),
)
_GROUP = {term: group for group in IDENTITY_GROUPS for term in group}
_WORDS = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (3, 4, 5, 6)


def words(text: str | None) -> set[str]:
    return set(_WORDS.findall(text.lower())) if text else set()


_beginnings: dict[str, int] = {}


def word_features(word: str) -> list[int]:
    """Numbers of the word and its beginnings; a group's name has no beginnings."""
    out = [xxhash.xxh3_64_intdigest(word) % BUCKETS]
    if word in _GROUP:
        return out
    for n in _BEGINNINGS:
        if len(word) <= n:
            break
        # Many words share a beginning, so these numbers are kept.
        own = _beginnings.get(part := word[:n])
        if own is None:
            if len(_beginnings) >= CACHED:
                _beginnings.clear()
            own = _beginnings[part] = xxhash.xxh3_64_intdigest(f"{part}-") % BUCKETS
        out.append(own)
    return out


def counterfactuals(found: set[str]) -> list[set[str]]:
    """The words of the text with one group's name swapped for each other of its kind, and without it."""
    out = []
    for term in sorted(found & _GROUP.keys()):
        rest = found - {term}
        out += [rest, *(rest | {other} for other in _GROUP[term] if other not in found)]
    return out


def swaps(found: set[str], held: Counter) -> Iterator[tuple[int | None, int | None]]:
    """Of each counterfactual the feature that goes and the one that comes, in the order of ``counterfactuals``.

    A name has one feature.  It goes unless another word has it too, and comes
    unless a word has it already.  held: by feature, how many words have it.
    """
    for term in sorted(found & _GROUP.keys()):
        (own,) = word_features(term)
        last = held[own] == 1
        yield (own if last else None), None
        for other in _GROUP[term]:
            if other not in found:
                (its,) = word_features(other)
                yield (own if last and its != own else None), (None if held[its] else its)


def in_fold(key: Column, modulus: int, part: int) -> Column:
    """Whether crc32 of the key's text leaves ``part``; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == part, F.lit(False))


class Model:
    """Weights by feature, and the bias."""

    def __init__(self, weights: dict[int, float], bias: float) -> None:
        self.weights, self.bias = weights, bias
        self._known: dict[str, tuple[int, ...]] = {}

    def __getstate__(self) -> tuple:
        return self.weights, self.bias

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def features(self, found: set[str]) -> set[int]:
        """The features that count."""
        active: set[int] = set()
        for word in found:
            own = self._known.get(word)
            if own is None:
                own = tuple([f for f in word_features(word) if f in self.weights])
                if len(self._known) >= CACHED:
                    self._known.clear()
                self._known[word] = own
            active.update(own)
        return active

    def logit(self, found: set[str]) -> float:
        return self.bias + sum([self.weights[f] for f in sorted(self.features(found))])

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-min(max(self.logit(words(text)), -40), 40)))


class Examples:
    """Labelled rows as flat arrays: features by row, and by pair what only the text (+1) or only its counterfactual (-1) has."""

    def __init__(self, labels: np.ndarray, row_of: np.ndarray, feature: np.ndarray, pair_of: np.ndarray, pair_feature: np.ndarray, sign: np.ndarray, pairs: int) -> None:
        self.labels, self.row_of, self.feature = labels.astype(np.float64), row_of, feature
        self.pair_of, self.pair_feature, self.sign, self.pairs = pair_of, pair_feature, sign, pairs

    @classmethod
    def of_rows(cls, rows: list[tuple[int, list[int], list[list[int]]]]) -> Examples:
        """rows: label, features, and the features of each counterfactual."""
        pair_of, pair_feature, sign, pairs = [], [], [], 0
        for _, own, others in rows:
            for other in others:
                for f, s in [(f, 1.0) for f in set(own) - set(other)] + [(f, -1.0) for f in set(other) - set(own)]:
                    pair_of.append(pairs)
                    pair_feature.append(f)
                    sign.append(s)
                pairs += 1
        row_of = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
        return cls(np.array([r[0] for r in rows]), row_of, np.array([f for r in rows for f in r[1]], np.int64), np.array(pair_of, np.int64), np.array(pair_feature, np.int64), np.array(sign), pairs)

    @classmethod
    def of_table(cls, table: pa.Table) -> Examples:
        """Of columns ``label, own, gone, new``; a pair's -1 stands for no feature."""
        table = table.combine_chunks()
        label, own, gone, new = (c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns)
        row_of = np.repeat(np.arange(len(label)), own.value_lengths().to_numpy())
        left, came = (c.flatten().to_numpy().astype(np.int64) for c in (gone, new))
        pair = np.concatenate((np.flatnonzero(left >= 0), np.flatnonzero(came >= 0)))
        sign = np.repeat([1.0, -1.0], [int((left >= 0).sum()), int((came >= 0).sum())])
        return cls(label.to_numpy(), row_of, own.flatten().to_numpy().astype(np.int64), pair, np.concatenate((left[left >= 0], came[came >= 0])), sign, len(left))


def fit(rows: Examples | list, size: int, *, penalty: float = 1e-5, counterfactual: float = 1.0, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the objective, by the limited-memory BFGS method.

    The objective is the mean logistic loss, half the penalty times the squared
    weights, and ``counterfactual`` times the mean squared change of the logit
    over the pairs.
    """
    if isinstance(rows, list):
        rows = Examples.of_rows(rows)
    labels, row_of, feature = rows.labels, rows.row_of, rows.feature
    pair_of, pair_feature, sign, pairs = rows.pair_of, rows.pair_feature, rows.sign, rows.pairs
    count = len(labels)
    n = max(1, count)

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        """The objective and its slope; the bias is the last entry."""
        w = x[:-1]
        logit = x[-1] + np.bincount(row_of, w[feature], count)
        error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels) / n
        loss = (np.logaddexp(0, logit) - labels * logit).sum() / n + penalty / 2 * (w @ w)
        slope = np.bincount(feature, error[row_of], size) + penalty * w
        if pairs:
            change = np.bincount(pair_of, sign * w[pair_feature], pairs)
            loss += counterfactual / pairs * (change @ change)
            slope += 2 * counterfactual / pairs * np.bincount(pair_feature, sign * change[pair_of], size)
        return loss, np.append(slope, error.sum())

    prior = np.clip(labels.mean() if count else 0.0, 1e-4, 1 - 1e-4)
    x = np.append(np.zeros(size), np.log(prior / (1 - prior)))
    now, slope = value(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.abs(slope).max(initial=0.0) < 1e-7:
            break
        way, left = -slope, []
        for moved, turned, scale in reversed(past):
            left.append(scale * (moved @ way))
            way -= left[-1] * turned
        if past:
            moved, turned, scale = past[-1]
            way /= scale * (turned @ turned)
        for (moved, turned, scale), share in zip(past, reversed(left), strict=True):
            way += (share - scale * (turned @ way)) * moved
        fall, step = slope @ way, 1.0 if past else 1.0 / max(1.0, np.linalg.norm(slope))
        new, new_slope = value(x + step * way)
        while new > now + 1e-4 * step * fall and step > 1e-10:
            step /= 2
            new, new_slope = value(x + step * way)
        if new >= now:
            break
        moved, turned = step * way, new_slope - slope
        if moved @ turned > 1e-18:
            past = [*past[-9:], (moved, turned, 1 / (moved @ turned))]
        x, now, slope = x + moved, new, new_slope
    return x[:-1], float(x[-1])


def _choose(counts: DataFrame, positives: int, negatives: int) -> np.ndarray:
    """Features more unevenly spread over the classes than one in a thousand is by chance, by their chi-square statistic."""
    total, p, n = positives + negatives, F.col("positive"), F.col("negative")
    seen = p + n
    cross = (p * negatives - n * positives).cast("double")
    chi2 = cross * cross * total / (seen * (F.lit(total) - seen + 1) * float(max(positives, 1)) * max(negatives, 1))
    return np.sort(counts.where((seen >= MIN_ROWS) & (chi2 >= 10.83)).select("feature").toArrow()["feature"].to_numpy())


def _labelled(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_rows: int) -> DataFrame:
    """``label`` and ``text`` of the documents to learn from, a table of at most ``max_rows`` rows."""
    chosen = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).cast("long").alias("doc_id")).agg(F.max((F.col(label) > 0).cast("int")).alias("label"))
    there = chosen.count()
    if there > max_rows:
        # Aim a little lower, as the number of hashes below a bound varies; the limit is the proof.
        share = max(0.5, max_rows - 4 * max_rows**0.5) / there
        chosen = chosen.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(max_rows)
    chosen = materialize(chosen, "chosen-labels")
    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # At most max_rows pairs of a key and a label are broadcast.
    rows = source.join(F.broadcast(chosen), "doc_id")
    if rows.groupBy("doc_id").count().where("count > 1").take(1):
        rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    found = materialize(rows.select("label", "text"), "labelled-texts")
    discard(chosen)
    return found


def train(documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", learn: Column | None = None, max_rows: int = MAX_ROWS, counterfactual: float = 1.0) -> Model:
    """Fit on labelled documents.

    learn: a condition on the label table's rows; ``max_rows`` bounds those used.
    """
    source = _labelled(documents, labels if learn is None else labels.where(learn), key, text, label, max_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for mark, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = words(value.as_py())
                seen[mark, list({f for w in found for f in word_features(w)})] += 1
        used = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[1, used].astype(np.int64)), pa.array(seen[0, used].astype(np.int64))], names=["feature", "positive", "negative"])

    by_class = {r["label"]: r["count"] for r in source.groupBy("label").count().collect()}
    positives, negatives = by_class.get(1, 0), by_class.get(0, 0)
    if not positives or not negatives:
        discard(source)
        return Model({}, 40.0 if positives else -40.0)
    counts = source.mapInArrow(count, "feature long, positive long, negative long").groupBy("feature").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
    chosen = np.unique(np.concatenate([_choose(counts, positives, negatives), [f for term in _GROUP for f in word_features(term)]])).astype(np.int64)
    index = documents.sparkSession.sparkContext.broadcast(chosen)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {f: i for i, f in enumerate(index.value.tolist())}
        for batch in batches:
            own, gone, new = [], [], []
            for value in batch.column(1):
                found = words(value.as_py())
                held = Counter(f for w in found for f in word_features(w) if f in place)
                own.append([place[f] for f in sorted(held)])
                pairs = list(swaps(found, held))
                gone.append([place[f] if f is not None else -1 for f, _ in pairs])
                new.append([place[f] if f is not None else -1 for _, f in pairs])
            lists = [pa.array(c, pa.list_(pa.int32())) for c in (own, gone, new)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), *lists], names=["label", "own", "gone", "new"])

    # At most max_rows lists of numbers, and two numbers for each swap of a name.
    rows = Examples.of_table(source.mapInArrow(describe, "label int, own array<int>, gone array<int>, new array<int>").toArrow())
    discard(source)
    weights, bias = fit(rows, len(chosen), counterfactual=counterfactual)
    return Model({int(f): float(x) for f, x in zip(chosen, weights, strict=True) if abs(x) > 1e-9}, bias)


def score_column(model: Model, documents: DataFrame, text: str = "text") -> Column:
    """The score, from 0 to 1, of the whole text alone."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.score(value) for value in texts], dtype="float64")

    return rate(documents[text].cast("string"))


def score(documents: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every document."""
    scored = documents.select(F.col(key).cast("long").alias("doc_id"), score_column(model, documents, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(documents: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score less than the threshold, with all their columns."""
    return documents.where(score_column(model, documents, text) < threshold)
