"""Personal data in whole texts, also where it is disguised, at its place in the source.

Base identifiers come from plain patterns.  For disguised ones the text passes a
chain of transducers, each of which rewrites some stretches and keeps, for every
character it puts out, the stretch of source characters that it came from:

1. homoglyphs: compatibility forms, digits of any script, look-alike letters,
   invisible characters;
2. at and dot disguises, in brackets or as words between parts of an address;
3. spelled digits (four languages) in runs of three or more, or fewer that make
   the run an identifier, and letters that stand for digits inside a number.

The same patterns then run over the output, and what they find maps back through
the kept stretches.  A found identifier is added unless it lies within a base one
of its kind; one that a look-alike letter cut short is added whole.  Base ones
always stay.

Defined results: a null text counts as an empty one, which has no identifiers; a
null key is kept; repeated rows give equal rows; an empty table an empty result.
Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# Inside a run of digits a match can only begin at its start, as runs are taken whole.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, sign in enumerate(reversed(digits)):
        value = ord(sign) - 48
        if place % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def _digits(match: str) -> str:
    return "".join(_DIGIT.findall(match))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each sign ``@``: the whole run of local signs before it, then the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def detect(text: str) -> list[Span]:
    """Identifiers by the plain patterns: by kind, then by place; a match that fails its check is dropped."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(int(p[-4:]) <= 255 and (len(p) <= 4 or not p[:-4].strip("0")) for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if 13 <= m.end() - m.start() <= 37 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ԝ": "w", "х": "x", "г": "r", "п": "n",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w", "η": "n",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "օ": "o", "ո": "n", "ս": "u", "հ": "h",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "｡": ".", "⓪": "0",
}
_INVISIBLE = frozenset("­᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿")
# Names of digits.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
}

_AT_NAMES, _DOT_NAMES = "at|arroba|arobase|chiocciola|klammeraffe", "dot|punto|point|punkt|period"
# White space is taken whole and only from where it begins, so long runs of it are read once.
_BRACKET_AT = re.compile(rf"[\[({{<][ \t]*+(?:{_AT_NAMES}|@)[ \t]*+[\])}}>]", re.I)
_BRACKET_DOT = re.compile(rf"[\[({{<][ \t]*+(?:{_DOT_NAMES}|\.)[ \t]*+[\])}}>]", re.I)
_WORD_DOT = re.compile(rf"(?<![ \t])[ \t]++(?:{_DOT_NAMES})[ \t]++", re.I)
_WORD_AT = re.compile(rf"(?<![ \t])(?:[ \t]++(?:{_AT_NAMES})[ \t]++|[ \t]++@[ \t]*+|@[ \t]++)", re.I)
# Words that begin a phrase, not a host, after "at".
_ARTICLES = frozenset("the a an this that le la les el los las der die das".split())
_NAME = re.compile(r"[A-Za-z0-9_%+-]++(?:\.[A-Za-z0-9_%+-]++)++")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_ANY_DOT = re.compile(rf"[ \t]++(?:{_DOT_NAMES}|\.)[ \t]++|\.", re.I)
_NUMBER_DOT = re.compile(rf"(?<=[0-9])[ \t]++(?:{_DOT_NAMES})[ \t]++(?=[0-9])", re.I)
_WORD_DIGIT_DOT = re.compile(rf"(?<=[0-9a-zéü])[ \t]++(?:{_DOT_NAMES})[ \t]++(?=[0-9a-zéü])", re.I)
_NAMES = "|".join(sorted(SPELLED, key=lambda n: (-len(n), n)))
_RUN = re.compile(rf"(?:(?<![^\W_])plus[ \t]++)?(?<![^\W_])(?:{_NAMES}|[0-9]++)(?![^\W\d_])(?:[ ,.()\t-]{{1,3}}(?:(?:{_NAMES})(?![^\W_])|[0-9]++(?![^\W\d_])))+", re.I)
_ITEM = re.compile(rf"plus|{_NAMES}|[0-9]+", re.I)
_SPELLED_RUN = re.compile(rf"(?<![^\W_])(?:{_NAMES})[ ,.()\t-]{{1,3}}(?:{_NAMES}|[0-9])|[0-9][ ,.()\t-]{{1,3}}(?:{_NAMES})(?![^\W_])", re.I)
_LETTER_DIGITS = re.compile(r"(?<![A-Za-z0-9])(?=[OoIl]*[0-9])[0-9OoIl]{2,}(?![A-Za-z0-9])")
_HIDDEN = re.compile(rf"(?<![^\W_])(?:{_DOT_NAMES})(?![^\W_])|[\[({{<][ \t]*+(?:{_AT_NAMES}|@|\.)[ \t]*+[\])}}>]|[ \t]@|@[ \t]|[ \t](?:{_AT_NAMES})[ \t]", re.I)
_AS_DIGIT = str.maketrans("OoIl", "0011")


class Tape:
    """Text with the stretch of source characters behind each of its characters."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> None:
        self.text = text
        self.starts = np.arange(len(text)) if starts is None else starts
        self.ends = np.arange(1, len(text) + 1) if ends is None else ends

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replace stretches, in order and apart; each new character stands for its whole stretch."""
        if not edits:
            return self
        text, at = [], 0
        # For each piece of the new text the stretch it comes from: kept ones go character by character.
        firsts, lasts, many = [], [], []
        for a, b, new in edits:
            text += [self.text[at:a], new]
            firsts += [at, a]
            lasts += [-1, b - 1]
            many += [a - at, len(new)]
            at = b
        text.append(self.text[at:])
        firsts, lasts, many = np.array([*firsts, at]), np.array([*lasts, -1]), np.array([*many, len(self.text) - at])
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        first, last = np.repeat(firsts, many), np.repeat(lasts, many)
        first = np.where(last < 0, first + inside, first)
        return Tape("".join(text), self.starts[first], self.ends[np.where(last < 0, first, last)])

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


_forms: dict[str, str | None] = {}


def _form(sign: str) -> str | None:
    """What a character outside ASCII is rewritten to; None: it stays."""
    if sign not in _forms:
        digit = unicodedata.decimal(sign, None)
        plain = unicodedata.normalize("NFKC", sign)
        if sign in _INVISIBLE:
            new = ""
        elif digit is not None:
            new = str(digit)
        elif sign in LOOKALIKES:
            new = LOOKALIKES[sign]
        elif unicodedata.category(sign) == "Zs":
            new = " "
        else:
            new = plain if plain.isascii() and plain != sign and sign not in "ªº¨¯´¸" else None
        _forms[sign] = new
    return _forms[sign]


def homoglyphs(tape: Tape) -> Tape:
    if tape.text.isascii():
        return tape
    odd = {c: new for c in set(tape.text) if ord(c) > 127 and (new := _form(c)) is not None}
    if not odd:
        return tape
    return tape.rewrite([(m.start(), m.end(), odd[m[0]]) for m in re.finditer(f"[{re.escape(''.join(odd))}]", tape.text)])


def _bracketed(pattern: re.Pattern, text: str, sign: str) -> list[tuple[int, int, str]]:
    """The pattern's matches with the blanks around them."""
    edits: list[tuple[int, int, str]] = []
    done = 0
    for m in pattern.finditer(text):
        a, b = m.span()
        while a > done and text[a - 1] in " \t":
            a -= 1
        while b < len(text) and text[b] in " \t":
            b += 1
        edits.append((a, b, sign))
        done = b
    return edits


def _address_edits(text: str) -> list[tuple[int, int, str]]:
    """Worded at and dot signs of addresses: a local part, an at, labels with at least one dot."""
    edits: list[tuple[int, int, str]] = []
    done = 0
    for at in _WORD_AT.finditer(text):
        if at.start() < done or not at.start() or text[at.start() - 1] not in _LOCAL_SIGNS:
            continue
        label, dots = _LABEL.match(text, at.end()), []
        if label and label[0].lower() in _ARTICLES:
            continue
        while label and (dot := _ANY_DOT.match(text, label.end())) and (after := _LABEL.match(text, dot.end())):
            dots.append(dot)
            label = after
        worded = [d for d in dots if d[0] != "."]
        # The plain word "at" is common: it disguises an address only beside a disguised dot or a dotted name.
        if not dots or "@" not in at[0] and not worded and not _dotted_name(text, at.start(), label):
            continue
        edits += [*_local_dots(text, at.start(), done), (at.start(), at.end(), "@"), *((d.start(), d.end(), ".") for d in worded)]
        done = label.end()
    return edits


def _local_dots(text: str, end: int, done: int) -> list[tuple[int, int, str]]:
    """Worded dots of the local part that ends here, after ``done``."""
    found: list[tuple[int, int, str]] = []
    while (dot := _last_word_dot(text, end)) and dot.start() >= done:
        found.append((dot.start(), dot.end(), "."))
        end = dot.start()
    return found[::-1]


def _dotted_name(text: str, end: int, last: re.Match) -> bool:
    """Whether the local signs that end here are names with dots between, and the last label is one of letters."""
    start = end
    while start and text[start - 1] in _LOCAL_SIGNS:
        start -= 1
    return bool(_NAME.fullmatch(text, start, end)) and len(last[0]) > 1 and last[0].isalpha()


def _last_word_dot(text: str, end: int) -> re.Match | None:
    """A worded dot right before the run of local signs that ends here."""
    start = end
    while start and text[start - 1] in _LOCAL_SIGNS:
        start -= 1
    window = text[max(0, start - 24) : start]
    for dot in _WORD_DOT.finditer(window):
        if dot.end() == len(window):
            found = _WORD_DOT.match(text, start - len(window) + dot.start())
            if found and found.end() == start and found.start() and text[found.start() - 1] in _LOCAL_SIGNS:
                return found
    return None


def addresses(tape: Tape) -> Tape:
    if not _HIDDEN.search(tape.text):
        return tape
    edits: list[tuple[int, int, str]] = []
    for at in _bracketed(_BRACKET_AT, tape.text, "@"):  # vouches for worded dots on both sides
        edits += [*_local_dots(tape.text, at[0], edits[-1][1] if edits else 0), at]
    tape = tape.rewrite(edits)
    tape = tape.rewrite(_bracketed(_BRACKET_DOT, tape.text, "."))
    tape = tape.rewrite([(m.start(), m.end(), ".") for m in _NUMBER_DOT.finditer(tape.text)])
    text = tape.text
    if "@" in text:
        edits, done = [], 0
        at = text.find("@")
        while at >= 0:
            label = _LABEL.match(text, at + 1)
            while label and (dot := _ANY_DOT.match(text, label.end())) and (after := _LABEL.match(text, dot.end())):
                if dot[0] != "." and dot.start() >= done:
                    edits.append((dot.start(), dot.end(), "."))
                label = after
            done = label.end() if label else at + 1
            at = text.find("@", max(at + 1, done))
        tape = tape.rewrite(edits)
    return tape.rewrite(_address_edits(tape.text))


def _digit_edits(text: str, run: re.Match) -> list[tuple[int, int, str]]:
    """Digits for a run's digit names; a run of fewer than three names must be an identifier then."""
    items = list(_ITEM.finditer(text, run.start(), run.end()))
    spelled = [not m[0][0].isdigit() for m in items]
    edits: list[tuple[int, int, str]] = []
    for k, m in enumerate(items):
        name = m[0].lower()
        if name == "plus":
            edits.append((m.start(), m.end(), "+"))
        elif spelled[k]:
            edits.append((m.start(), m.end(), SPELLED[name]))
        if k + 1 < len(items) and (spelled[k] or spelled[k + 1]):
            gap = text[m.end() : items[k + 1].start()]
            edits.append((m.end(), items[k + 1].start(), "." if "." in gap else ""))
    if sum(spelled) >= 3 or not edits:
        return edits
    at = run.start() - text.startswith("+", run.start() - 1, run.start())
    plain = Tape(text[at : run.end()]).rewrite([(a - at, b - at, new) for a, b, new in edits]).text
    return edits if any(plain[b:].strip(" ().-") == "" == plain[:a].strip(" ().-") for _, a, b in detect(plain)) else []


def digits(tape: Tape) -> Tape:
    if _SPELLED_RUN.search(tape.text):
        tape = tape.rewrite([(m.start(), m.end(), ".") for m in _WORD_DIGIT_DOT.finditer(tape.text)])
        edits: list[tuple[int, int, str]] = []
        for run in _RUN.finditer(tape.text):
            own = _digit_edits(tape.text, run)
            if own:
                edits += own
        tape = tape.rewrite(edits)
    edits = [(m.start(), m.end(), m[0]) for m in _LETTER_DIGITS.finditer(tape.text) if not m[0].isdigit()]
    if edits:
        tape = tape.rewrite([(a + k, a + k + 1, c.translate(_AS_DIGIT)) for a, _, old in edits for k, c in enumerate(old) if not c.isdigit()])
    return tape


TRANSDUCERS: tuple[Callable[[Tape], Tape], ...] = (homoglyphs, addresses, digits)


def disguised(text: str) -> bool:
    """Whether any transducer would find something to rewrite."""
    return (not text.isascii() and any(ord(c) > 127 and _form(c) is not None for c in set(text))) or bool(_HIDDEN.search(text) or _SPELLED_RUN.search(text) or (_DIGIT.search(text) and any(not m[0].isdigit() for m in _LETTER_DIGITS.finditer(text))))


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base identifiers, and all with the disguised ones; each by kind, then place."""
    text = text or ""
    base = detect(text)
    if not disguised(text):
        return base, base
    tape = Tape(text)
    for transducer in TRANSDUCERS:
        tape = transducer(tape)
    added = []
    starts, ends = ({k: [s[at] for s in base if s[0] == k] for k in KINDS} for at in (1, 2))
    for kind, a, b in detect(tape.text) if tape.text != text else []:
        start, end = tape.source(a, b)
        # Base spans of a kind lie apart: only the last that begins no later can hold this one.
        before = bisect_right(starts[kind], start) - 1
        if before < 0 or end > ends[kind][before]:
            added.append((kind, start, end))
    return base, sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def spell(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{a}:{b}" for kind, a, b in spans])


def redact(text: str | None, mark: str = "[{}]") -> str | None:
    """The text with each found stretch replaced by its kind."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in sorted(find(text)[1], key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], mark.format(kind)]
            at = b
    return "".join([*out, text[at:]])


def identifiers(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans, in code points, of all identifiers in every whole text.

    Columns: the key as ``doc_id``; ``n_email``, ``n_ip``, ``n_card`` and
    ``n_phone`` of all spans; ``base_sha256`` of the base spans; ``spans``, all of
    them as ``kind:start:end``; ``n_added`` of the disguised ones.
    """
    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                base, spans = find(value.as_py())
                kinds = [k for k, _, _ in spans]
                rows.append((*map(kinds.count, KINDS), hashlib.sha256(spell(base).encode()).hexdigest(), spell(spans), len(spans) - len(base)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            types = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return source.mapInArrow(search, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redacted(documents: DataFrame, *, text: str = "text") -> DataFrame:
    """The documents with all identifiers in their texts replaced; other columns stay."""

    @F.pandas_udf("string")
    def replace(texts: pd.Series) -> pd.Series:
        return texts.map(redact)

    return documents.withColumn(text, replace(F.col(text).cast("string")))
