import time
import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import sentences as N


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("Café  x", "Café x"),
        ("a​b⁠c﻿d", "abcd"),
        ("a b c　d", "a b c d"),
        ("a\x00b\x1fc\x85d", "a b c d"),
        ("नम‍स‌ते", "नम‍स‌ते"),
        ("[edit | source] Text", "Text"),
        ("[a|b] [c|d]x", "x"),
        ("[edit] Text", "[edit] Text"),
        ("[a|b][c] x", "[c] x"),
        ("[" + "x" * 117 + "|] y", "y"),
        ("[" + "x" * 118 + "|] y", "[" + "x" * 118 + "|] y"),
        ("[a|b]", ""),
        ("  ", ""),
    ],
)
def test_normalize(raw, clean):
    assert X.normalize(raw) == clean


@given(st.text(max_size=40))
def test_normalize_twice_is_once(text):
    once = X.normalize(text)
    assert once == once.strip() and "  " not in once


@pytest.mark.parametrize(
    ("text", "language", "parts"),
    [
        ("This is the first. This is the second.", "en", 2),
        ("This is the first. this is the same one.", "en", 1),
        ("Call Dr. Smith about the problem.", "en", 1),
        ("It costs 3.50 euros in the city.", "en", 1),
        ("Short. Yes it is too short here.", "en", 1),
        ("Really? Yes! No.", "en", 3),
        ("See http://a.b/c?Query now please.", "en", 1),
        ("See www.a.b/c?Query now please.", "en", 1),
        ('He said "I will go there." Then he left us.', "en", 2),
        ("هذه هي الجملة الأولى. هذه هي الجملة الثانية.", "ar", 2),
        ("هذه هي الجملة الأولى. This is Latin text here.", "ar-EG", 1),
        ("第一句。第二句话。", "zh", 2),
        ("", "en", 0),
    ],
)
def test_refine(text, language, parts):
    out = X.refine([text], language)
    assert len(out) == (parts or 1)
    assert "".join("".join(out).split()) == "".join(text.split())


def plain_boundaries(text, language):
    """The rules word by word, on copies of the text's parts."""
    arabic, found, since = X.primary_language(language) in X._ARABIC_LANGUAGES, [], 0
    for end in X._END.finditer(text):
        rest = text[end.end() :].lstrip()
        if not rest or not X._letter(rest[0]):
            continue
        left, right = text[since : end.end()].strip(), rest.rstrip()
        before = text[: end.start()]
        if end[1] == ".":
            word = before.rstrip()
            many = next((k for k, c in enumerate(reversed(word)) if unicodedata.category(c)[0] not in "LM"), len(word))
            sure = (not arabic or X._arabic(rest[0])) and not rest[0].islower() and many >= 3
        else:
            token = before[len(before) - next((k for k, c in enumerate(reversed(before)) if c.isspace()), len(before)) :].casefold()
            sure = end[1] != "?" or not ("://" in token or token.lstrip("([{<\"'").startswith("www."))
        if sure and min(len(left), len(right)) >= (12 if end[1] == "." else 2):
            found.append(end.end())
            since = len(text) - len(rest)
    return found


PIECES = ["word", "Abc", "Longer text", ".", "?", "!", " ", "\n", "\u3000", "http://x", "://", "WWW.", "www.a", "(", "'", ")", "é", "第", "。", "هذه", "؟", "ab", "X"]


@given(st.lists(st.sampled_from(PIECES), max_size=30), st.sampled_from(["en", "ar-EG", "zh"]))
def test_boundaries_equal_the_plain_rules(pieces, language):
    text = "".join(pieces)
    assert X.boundaries(text, language) == plain_boundaries(text, language)


@pytest.mark.parametrize("unit", ["This is a longer sentence. ", "a?B", "http://a?B", ". ", "Word ?Word", " ", "((www.a?B", "?)"])
def test_boundaries_of_long_texts(unit):
    text = unit * (2_000_000 // len(unit))
    began = time.perf_counter()
    X.boundaries(text, "en")
    assert time.perf_counter() - began < 20


def test_blank_segments_are_counted():
    kept, emitted, raw, normal = X.prepare(["", "  ", "[a|b]", "Text"], "en")
    assert (kept, emitted, raw, normal) == ([("Text", "Text")], 4, 2, 1)


def test_segmenter_contract():
    with pytest.raises(ValueError, match="groups"):
        X.segmented(lambda t, _: [], ["a"], ["en"])
    with pytest.raises(ValueError, match="sequences"):
        X.segmented(lambda t, _: ["a"], ["a"], ["en"])
    assert X.segmented(lambda t, _: 1 / 0, [], []) == []


def test_lazy_segmenter_is_made_once_and_called_by_language():
    made = []

    def make():
        made.append([])

        def model(texts, language):
            made[-1].append((list(texts), language))
            return [[f"{language}:{t}"] for t in texts]

        return model

    lazy = X.LazySegmenter(make)
    assert lazy(["a", "b", "c"], ["en", "fr", "en"]) == [["en:a"], ["fr:b"], ["en:c"]]
    assert lazy(["d"], ["en"]) == [["en:d"]] and made == [[(["a", "c"], "en"), (["b"], "fr"), (["d"], "en")]]
    with pytest.raises(ValueError, match="groups"):
        X.LazySegmenter(lambda: lambda t, _: [])(["a"], ["en"])


def test_a_worker_takes_long_texts_apart_in_stretches(spark):
    def segmenter(texts, languages):
        if len(texts) > 1 and sum(map(len, texts)) > X.STRETCH:
            raise ValueError("too much at once")
        return X.split_lines(texts, languages)

    texts = [("One sentence here. " * 5 + "\n") * (k * 300) for k in range(20)] + [None, "", "x" * (2 * X.STRETCH)]
    rows = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "k long, text string, lang string").coalesce(1)
    found = rows.select("k", X.prepared(F.col("text"), F.col("lang"), segmenter).alias("p"), X.boundary_offsets(F.col("text"), F.col("lang")).alias("o")).orderBy("k").collect()
    for r, t in zip(found, texts, strict=True):
        kept, emitted, raw, normal = X.prepare((t or "").split("\n"), "en")
        assert [tuple(s) for s in r["p"]["sentences"]] == kept and tuple(r["p"])[1:] == (emitted, raw, normal)
        assert r["o"] == (None if t is None else X.boundaries(t, "en"))


def test_texts_are_segmented_once(spark):
    rows = spark.createDataFrame([("a\nb", "en")], "text string, lang string")
    sentences = N.explode_sentences(N.prepare_sections(rows, "text", "lang"))
    assert sentences._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [r["sentence_text_raw"] for r in sentences.collect()] == ["a", "b"]
