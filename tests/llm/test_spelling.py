import re
import zlib
from collections import Counter

import numpy as np

from lexmill.llm import spelling
from lexmill.llm.queries import op13_spelling
from lexmill.llm.wavelet import WaveletTree


def test_wavelet_tree_reports_every_point():
    draw = np.random.default_rng(1)
    for n in (1, 2, 3, 64, 65, 500):
        values = draw.permutation(n)
        tree = WaveletTree(values)
        first, last = np.sort(draw.integers(0, n + 1, (200, 2)), axis=1).T
        least, most = np.sort(draw.integers(0, n + 1, (200, 2)), axis=1).T
        which, value = tree.report(first, last, least, most)
        wanted = sorted((k, v) for k in range(200) for v in values[first[k] : last[k]].tolist() if least[k] <= v < most[k])
        assert sorted(zip(which.tolist(), value.tolist(), strict=True)) == wanted
    assert WaveletTree(np.zeros(0, np.int64)).report(*[np.zeros(1, np.int64)] * 4)[0].size == 0


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(counts, ratio=10):
    out, forms = {}, {}
    for w, n in counts.items():
        others = sorted((-counts[o], o) for o in counts if near(w, o))
        best = others[0] if others and -others[0][0] >= ratio * n else None
        forms[w] = best and best[1]
        out[w] = (n, len(others), best and -best[0])
    found = set()
    for w, (n, many, best) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        found.add((w, forms[w], root, n, many, best))
    return found


def counted(spark, counts, **options):
    df = spark.createDataFrame([(n, "x", w) for w, n in counts.items()], "n int, form string, word string")
    rows = spelling.spelling_variants(df, **options).collect()
    assert len(rows) == len(counts)
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def some_words(draw, letters, sizes, count):
    return {"".join(draw.choice(list(letters), draw.integers(*sizes))): int(10 ** draw.uniform(0.4, 4)) for _ in range(count)}


def test_equals_brute_force(spark):
    draw = np.random.default_rng(2)
    counts = some_words(draw, "ab", (1, 9), 300) | some_words(draw, "abÿ÷", (3, 7), 300)
    assert counted(spark, counts) == variants(counts)


def test_large_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(spelling, "GROUP", 20)
    monkeypatch.setattr(spelling, "RECTANGLES", 50)
    draw = np.random.default_rng(3)
    tails = some_words(draw, "abc", (3, 7), 400)
    counts = {f"common{w}": n for w, n in tails.items()} | {f"{w}ending": n + 1 for w, n in tails.items()} | {"a" * k: k for k in range(1, 60)}
    assert counted(spark, counts, ratio=2) == variants(counts, ratio=2)


def test_chains_of_forms(spark):
    counts = {"chained": 100_000_000, "chainedx": 1_000_000, "chainedxy": 10_000, "chainedxyz": 100, "chainedxyzw": 2, "alonewords": 5}
    got = {r[0]: r[2] for r in counted(spark, counts)}
    assert got == {w: "alonewords" if w == "alonewords" else "chained" for w in counts}


def test_ties_take_the_smallest_word(spark):
    counts = {"wordlike": 2, "wordlikez": 50, "wordlikea": 50, "wordlik": 50, "xordlike": 50}
    assert next(r for r in counted(spark, counts) if r[0] == "wordlike") == ("wordlike", "wordlik", "wordlik", 2, 4, 50)


def test_long_words(spark):
    long = "ab" * 20_000
    counts = {long: 30, long + "b": 2, long[:100] + "c" + long[100:]: 2, long[:-1] + "x": 300, "q" * 30_000: 4}
    assert counted(spark, counts) == variants(counts)


def test_no_words(spark):
    assert counted(spark, {}) == set()


def plain_words(docs, noise=31):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return Counter({w: n for w, n in counts.items() if n >= 2})


def documents(draw, count):
    base = ["".join(draw.choice(list("abcdeéÉÿXY"), draw.integers(5, 12))) for _ in range(60)]
    return [(int(k), " ".join(draw.choice(base, 30)) + "1ŁX–abcdefgh×ß") for k in range(count)]


def test_words_are_counted_as_stated(spark):
    docs = [*documents(np.random.default_rng(4), 80), (None, "Nullable nullable"), (100, None), (101, ""), (102, "x" * 300_000 + " " + "longish " * 100_000), (5, "repeated repeated"), (5, "repeated repeated")]
    df = spark.createDataFrame([(k, t, "w", 1) for k, t in docs], "doc_id long, text string, word string, n int")
    for noise in (None, 2, 31):
        assert {r["word"]: r["n"] for r in spelling.words(df, noise=noise).collect()} == plain_words(docs, noise)
    assert spelling.words(df.limit(0)).count() == 0


def test_query(spark, tmp_path):
    docs = documents(np.random.default_rng(5), 150)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in op13_spelling(spark, str(tmp_path)).collect()}
    assert got == variants(plain_words(docs))
    assert any(form for _, form, *_ in got)
