"""Normalising sentences and finding their boundaries.

NFC and the letter classes of Unicode have no built-in in Spark, so these are
Arrow UDFs over plain functions that are tested by themselves.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
_DROPPED = "\u200b\u2060\ufeff"
_TERMINALS = "?!؟。！？।॥."
_CLOSERS = "\"'»”’)]}"
_ARABIC_LANGUAGES = frozenset({"ar", "fa", "ps", "ur"})
_ARABIC_BLOCKS = ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))
#: Characters on either side of a full stop, and of any other sign; letters of the word before a full stop.
_STOP_SIDE, _SIGN_SIDE, _STOP_WORD = 12, 2, 3
#: Bytes of texts that a worker takes apart at once.
STRETCH = 1 << 20

_CONTROL = re.compile(r"[\x00-\x1f\x7f-\x9f]")
_SPACES, _GAP = re.compile(r"\s+"), re.compile(r"\s*")
_OPENERS = re.compile(r"[(\[{<\"']*")
#: Edit markers at the start: brackets that close within 120 characters and hold a bar.
_MARKERS = re.compile(r"(?:\s*\[(?=[^\]|]*\|)[^\]]{0,118}\])+")
_END = re.compile(rf"([{re.escape(_TERMINALS)}])[{re.escape(_CLOSERS)}]*")


def normalize(text: str) -> str:
    """NFC, no zero-width marks, control characters and white space as single spaces, no edit markers."""
    text = unicodedata.normalize("NFC", text)
    for mark in _DROPPED:
        text = text.replace(mark, "")
    text = " ".join(_CONTROL.sub(" ", text).split())
    if marked := _MARKERS.match(text):
        text = " ".join(text[marked.end() :].split())
    return text


def primary_language(tag: str) -> str:
    return re.split("[-_]", tag.casefold(), maxsplit=1)[0]


def _letter(sign: str) -> bool:
    return unicodedata.category(sign)[0] == "L"


def _arabic(sign: str) -> bool:
    return _letter(sign) and any(a <= ord(sign) <= b for a, b in _ARABIC_BLOCKS)


class _Urls:
    """Tells whether a place is inside the token of a URL; places must be asked for in order, so a text is read once."""

    def __init__(self, text: str) -> None:
        self.text, self.token, self.scheme, self.www = text, 0, text.find("://"), self._begins_www(text, 0)
        self.spaces = _SPACES.finditer(text)
        self.space = next(self.spaces, None)

    @staticmethod
    def _begins_www(text: str, at: int) -> int:
        """Where a token's ``www.`` ends, or past the text."""
        first = _OPENERS.match(text, at).end()
        return first + 4 if text[first : first + 4].casefold() == "www." else len(text) + 1

    def __contains__(self, at: int) -> bool:
        token = self.token
        while self.space and self.space.end() <= at:
            token, self.space = self.space.end(), next(self.spaces, None)
        if token != self.token:
            self.token, self.www = token, self._begins_www(self.text, token)
            if -1 < self.scheme < token:
                self.scheme = self.text.find("://", token)
        return -1 < self.scheme <= at - 3 or self.www <= at


def _long_word_before(text: str, at: int) -> bool:
    """Whether the word right before, white space between aside, has enough letters and marks."""
    while at and text[at - 1].isspace():
        at -= 1
    return at >= _STOP_WORD and all(unicodedata.category(c)[0] in "LM" for c in text[at - _STOP_WORD : at])


def boundaries(text: str, language: str) -> list[int]:
    """Ends of sentences inside a text of which there is no doubt.

    What lies left of a sign begins at the boundary accepted before it.  The text
    is read by places, never copied, so the time grows with its length.
    """
    arabic, found, urls = primary_language(language) in _ARABIC_LANGUAGES, [], None
    since, last = len(text) - len(text.lstrip()), len(text.rstrip())
    for end in _END.finditer(text):
        begins = _GAP.match(text, end.end()).end()
        if begins >= len(text) or not _letter(text[begins]):
            continue
        if end[1] == ".":
            sure = (not arabic or _arabic(text[begins])) and not text[begins].islower() and _long_word_before(text, end.start())
            side = _STOP_SIDE
        else:
            if end[1] == "?" and urls is None:
                urls = _Urls(text)
            sure = end[1] != "?" or end.start() not in urls
            side = _SIGN_SIDE
        if sure and min(end.end() - since, last - begins) >= side:
            found.append(end.end())
            since = begins
    return found


def refine(segments: Iterable[str], language: str) -> list[str]:
    """Segments split at their boundaries; a blank segment without any stays, to be counted."""
    out: list[str] = []
    for segment in segments:
        cuts = boundaries(segment, language)
        parts = [segment[a:b].strip() for a, b in zip([0, *cuts], [*cuts, len(segment)], strict=True)]
        out += [p for p in parts if p] or ([] if cuts else [segment])
    return out


Segmenter = Callable[[Sequence[str], Sequence[str]], Sequence[Sequence[str]]]


def split_lines(texts: Sequence[str], languages: Sequence[str]) -> list[list[str]]:
    """The rule-based segmenter: a segment a line."""
    return [text.split("\n") for text in texts]


class LazySegmenter:
    """A segmenter made on first use in each worker, so a model need not travel; texts are put to it by language.

    make: returns a function from texts of one language, and the language, to
    their segments.
    """

    def __init__(self, make: Callable[[], Callable[[Sequence[str], str], Sequence[Sequence[str]]]]) -> None:
        self.make, self._model = make, None

    def __getstate__(self) -> dict:
        return {"make": self.make, "_model": None}

    def __call__(self, texts: Sequence[str], languages: Sequence[str]) -> list[list[str]]:
        if self._model is None:
            self._model = self.make()
        out: list[list[str]] = [[] for _ in texts]
        for language in dict.fromkeys(languages):
            places = [k for k, x in enumerate(languages) if x == language]
            for k, segments in zip(places, segmented(lambda t, _, language=language: self._model(t, language), [texts[k] for k in places], [language] * len(places)), strict=True):
                out[k] = segments
        return out


def segmented(segmenter: Segmenter, texts: Sequence[str], languages: Sequence[str]) -> list[list[str]]:
    """Call a segmenter and hold it to its contract."""
    if not texts:
        return []
    out = segmenter(texts, languages)
    if len(out) != len(texts):
        raise ValueError(f"the segmenter returned {len(out)} groups for {len(texts)} texts")
    for group in out:
        if isinstance(group, str) or not all(isinstance(s, str) for s in group):
            raise ValueError("the segmenter must return sequences of strings")
    return [list(group) for group in out]


def normalized(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(normalize, na_action="ignore")

    return run(text)


def stretches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and number of rows of parts of about ``STRETCH`` bytes of text, at least a row each, of all rows in order."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    at = 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + STRETCH, "right")))
        yield at, to - at
        at = to


def boundary_offsets(text: Column, language: Column) -> Column:
    @F.arrow_udf("array<int>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, languages in batches:
            for at, n in stretches(texts):
                both = zip(texts.slice(at, n).to_pylist(), languages.slice(at, n).to_pylist(), strict=True)
                yield pa.array([None if t is None else boundaries(t, lang or "") for t, lang in both], pa.list_(pa.int32()))

    return run(text, language)


PREPARED = "struct<sentences:array<struct<raw:string,normalized:string>>,emitted:bigint,dropped_raw:bigint,dropped_normalized:bigint>"


def prepare(segments: Iterable[str], language: str) -> tuple[list[tuple[str, str]], int, int, int]:
    """Sentences that stay, how many there were, and how many were blank before and after normalising."""
    pieces = refine(segments, language)
    raw = [s for p in pieces if (s := p.strip())]
    both = [(s, n) for s in raw if (n := normalize(s))]
    return both, len(pieces), len(pieces) - len(raw), len(raw) - len(both)


def _prepared_array(rows: list[tuple[list[tuple[str, str]], int, int, int]]) -> pa.Array:
    """What ``prepare`` gave for each row, as an array of ``PREPARED``."""
    ends = np.concatenate(([0], np.cumsum([len(r[0]) for r in rows]))).astype(np.int32)
    raw, normal = (pa.array([s[k] for r in rows for s in r[0]], pa.string()) for k in (0, 1))
    sentences = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([raw, normal], ["raw", "normalized"]))
    counts = [pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3)]
    return pa.StructArray.from_arrays([sentences, *counts], ["sentences", "emitted", "dropped_raw", "dropped_normalized"])


def prepared(text: Column, language: Column, segmenter: Segmenter = split_lines) -> Column:
    """A section's sentences and counts; one call of the segmenter for each stretch of texts, so a worker holds the sentences of one."""

    @F.arrow_udf(PREPARED)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for every_text, every_language in batches:
            for at, n in stretches(every_text):
                texts, languages = ([x or "" for x in column.slice(at, n).to_pylist()] for column in (every_text, every_language))
                yield _prepared_array([prepare(g, x) for g, x in zip(segmented(segmenter, texts, languages), languages, strict=True)])

    # Else the planner infers a filter on an exploded result, and segments every text once more for it.
    return run.asNondeterministic()(text, language)
