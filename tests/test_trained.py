import math
import random
import re
from collections import Counter

import pytest

from lexmill.functions import trained as T

ABBREVIATIONS = {"en": ("dr", "approx", "e.g", "vol"), "de": ("bzw", "str", "z.b"), "fr": ("mme", "env"), "es": ("sra", "av")}
WORDS = {lang: [lang + "".join(random.Random(k).choices("abcdefghiklmnoprstu", k=5)) for k in range(60)] for lang in ABBREVIATIONS}
STARTERS = {"en": "The", "de": "Der", "fr": "Les", "es": "Los"}


def sentence(draw, lang):
    words = draw.choices(WORDS[lang], k=draw.randint(5, 9))
    cuts = 0
    if draw.random() < 0.5:
        k = draw.randrange(1, len(words) - 1)
        words[k : k + 1] = [draw.choice(ABBREVIATIONS[lang]) + ".", draw.choice(WORDS[lang]).title()]
        cuts = 1
    first = STARTERS[lang] if draw.random() < 0.6 else words[0].title()
    return " ".join([first, *words[1:]]) + draw.choice([".", ".", "!", "?"]), cuts


def documents(seed, count=120):
    draw, out = random.Random(seed), []
    for k in range(count):
        lang = list(ABBREVIATIONS)[k % 4]
        out.append((lang, [sentence(draw, lang)[0] for _ in range(12)]))
    return out


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(" ".join(parts), lang, "x") for lang, parts in documents(1)] + [(None, "en", "x"), ("", "en", "x"), ("Text without a language.", None, "x")]
    return T.train(spark.createDataFrame(rows, "text string, lang string, words string").repartition(3))


def test_abbreviations_and_starters_are_found(learned):
    for lang, wanted in ABBREVIATIONS.items():
        assert set(wanted) <= learned[lang].abbreviations and not learned[lang].abbreviations & set(WORDS[lang])
        assert STARTERS[lang].casefold() in learned[lang].starters


def test_training_equals_a_plain_version(learned):
    for lang in ABBREVIATIONS:
        counts = Counter()
        for name, parts in documents(1):
            if name == lang:
                counts.update(T.word_counts(" ".join(parts)))
        words, stops = counts["#", "words"], counts["#", "stops"]
        plain = set()
        for kind, word in list(counts):
            if kind == "." and counts[".", word] >= T.SEEN:
                stopped, free = counts[".", word], counts["-", word]
                n, p, q = stopped + free, stops / words, stopped / (stopped + free)
                ratio = 0.0
                if q > p:
                    q = min(q, 1 - 1e-12)
                    ratio = 2 * (stopped * math.log(q / p) + (n - stopped) * math.log((1 - q) / (1 - p)))
                letters = len(word.replace(".", ""))
                if ratio * math.exp(-letters) * (word.count(".") + 1) / letters**free >= T.ABBREVIATION:
                    plain.add(word)
        assert plain == learned[lang].abbreviations


def test_fewer_wrong_cuts_than_without_training(learned):
    segmenter, rule = T.TrainedSegmenter(learned), T.TrainedSegmenter({})
    wrong = {"trained": 0, "rule": 0}
    missed = total = 0
    for lang, parts in documents(2, 80):
        text = " ".join(parts)
        for name, s in (("trained", segmenter), ("rule", rule)):
            (found,) = s([text], [lang])
            assert " ".join(found) == text
            wrong[name] += len(set(found) - set(parts))
        total += len(parts)
        missed += len(set(parts) - set(segmenter([text], [lang])[0]))
    assert wrong["trained"] < 0.05 * wrong["rule"] and missed < 0.03 * total


def plain_counts(text):
    """Token by token, as the method says it."""
    out, sure = Counter(), True
    for found in re.finditer(r"\S+", text):
        token = found[0].strip(T._EDGE)
        word = token.rstrip(".!?,;:").casefold()
        if any(c.isalpha() for c in word):
            out["." if token.endswith(".") else "-", word] += 1
            out["#", "words"] += 1
            out["#", "stops"] += token.endswith(".")
            if sure and not token[:1].islower():
                out[">", word] += 1
                out["#", "starts"] += 1
        sure = token.endswith(("!", "?")) or text[found.end() : found.end() + 1] == "\n" or not token
    return out


def test_counts_equal_those_taken_token_by_token():
    draw = random.Random(8)
    for _ in range(5000):
        text = "".join(draw.choices("aBÉß.!?,: \n\t\"'»”)(\x0b\x1c\x85\xa01", k=draw.randint(0, 25)))
        assert T.word_counts(text) == plain_counts(text), repr(text)


def test_a_token_is_taken_apart_once_for_a_task_and_texts_are_read_once(spark, monkeypatch, tmp_path):
    seen = str(tmp_path / "tokens")

    def count(tokens, begins, fold=T.folded):
        with open(seen, "a") as f:
            f.write(f"{len(tokens)} {sum(tokens.values())}\n")
        return fold(tokens, begins)

    monkeypatch.setattr(T, "folded", count)
    df = spark.createDataFrame([("the cat sat. The dog ran.", "en")] * 500, "text string, lang string").coalesce(1)
    T.train(df)
    with open(seen) as f:
        assert [line.split() for line in f] == [["6", "3000"]]


def test_rules():
    learned = T.Learned(frozenset({"dr", "etc"}), frozenset({"the"}))
    assert T.split("I saw Dr. Smith. He left etc. The end.", learned) == ["I saw Dr. Smith.", "He left etc.", "The end."]
    assert T.split("By J. Doe! (Yes.) No? so it is.\n\nNext line", learned) == ["By J. Doe!", "(Yes.)", "No? so it is.", "", "Next line"]
    assert T.split("", learned) == [""]
    assert T.log_likelihood(0, 0, 5, 10) == 0 and T.log_likelihood(1, 10, 5, 10) == 0 and T.log_likelihood(10, 10, 10, 1000) > 80
