import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lexmill.llm import suffix_tree as S
from lexmill.llm import tokens


def corpus(seed, count=300):
    """Words follow each other by a chain, so contexts tell much."""
    draw = random.Random(seed)
    words = [f"W{i}" for i in range(40)]
    out = []
    for k in range(count):
        at, text = draw.randrange(40), []
        for _ in range(draw.randint(0, 80)):
            text.append(words[at] if draw.random() < 0.95 else f"rare{draw.randrange(500)}")
            at = (at * 7 + draw.randrange(3)) % 40
        out.append((k, " ".join(text)))
    return out


def words_of(text):
    return (text or "").encode().lower().split()


def test_tokens_are_cut_and_hashed_as_plain_ones():
    draw = random.Random(3)
    texts = ["", " \t\x0b ", "One", " ONE two\x0cthree\r\n", "é Ü\x1cx \xa0y", "ab" * 200 + " ab", "a\0b a", *("".join(draw.choices("ABab é\n\t\0", k=draw.randint(0, 40))) for _ in range(300))]
    array = pa.array(["skipped", *texts]).slice(1)
    for size in (1 << 22, 50):
        tokens.BYTES, before = size, tokens.BYTES
        stream = np.concatenate(list(S._streams(iter([pa.record_batch([array], names=["text"])]))))
        tokens.BYTES = before
        plain = [w for t in texts for w in (*words_of(t), None)]
        assert stream[0] == S.END and len(stream) == len(plain) + 1
        of = {}
        for w, h in zip(plain, stream[1:].tolist(), strict=True):
            assert of.setdefault(w, h) == h
        assert len(set(of.values())) == len(of) and of[None] == S.END


def training(k):
    return zlib.crc32(str(k).encode()) % 7 != 2


def brute_tree(texts, depth, least):
    """Retained contexts and the chance of each next symbol, straight from the definition."""
    unigrams = Counter(w for t in texts for w in (*t, None))
    total, kinds = sum(unigrams.values()), len(unigrams)
    counts = {}
    for t in texts:
        line = [None, *t, None]
        for i in range(1, len(line)):
            for n in range(1, min(i, depth) + 1):
                counts.setdefault(tuple(line[i - n : i]), Counter())[line[i]] += 1
    stats = {}

    def chance(context, x):
        while context and context not in stats:
            context = context[1:]
        if not context:
            return (unigrams[x] + 1) / (total + kinds + 1)
        n, seen, back = stats[context]
        return (seen[x] - S.DISCOUNT if x in seen else 0) / n + back * chance(context[1:], x)

    kept = set()
    for context in sorted(counts, key=len):
        n = sum(counts[context].values())
        if n < least:
            continue
        expected = {x: n * chance(context[1:], x) for x in counts[context]}
        seen = {x: m for x, m in counts[context].items() if m >= S.MIN_NEXT and m > expected[x] and m * math.log(m / expected[x]) - m + expected[x] >= math.log(n) / 2}
        stats[context] = (n, seen, 1 - (sum(seen.values()) - S.DISCOUNT * len(seen)) / n)
        rest = n - sum(seen.values())
        gain = sum(m * math.log(m / expected[x]) for x, m in seen.items())
        if rest and seen:
            gain += rest * math.log(rest / n / max(1 - sum(expected[x] for x in seen) / n, 1e-12))
        if seen and gain >= (len(seen) + 1) * math.log(n) / 2:
            kept |= {context[k:] for k in range(len(context))}
    return kept, chance, unigrams


def test_hashes_are_those_of_spark(spark):
    draw = np.random.default_rng(1)
    pairs = draw.integers(-(2**63), 2**63, (50, 2), np.int64)
    rows = spark.createDataFrame(pairs.tolist(), "c long, x long").select(F.xxhash64("c", "x")).collect()
    assert S.gram_keys(pairs[:, 0].copy().view(np.uint64), pairs[:, 1].copy().view(np.uint64)).view(np.int64).tolist() == [r[0] for r in rows]
    assert S.gram_keys(pairs[:, 0].copy().view(np.uint64), S.ANY).view(np.int64).tolist() == [r[0] for r in spark.createDataFrame(pairs.tolist(), "c long, x long").select(F.xxhash64("c", F.lit(0).cast("long"))).collect()]


def test_contexts_stop_at_the_beginning_of_a_text():
    stream = np.array([S.END, 5, 6, S.END, 7, 8, 9, S.END], np.uint64)
    spelled = {}
    for symbols in ([S.END], [5], [6], [7], [8], [9], [S.END, 5], [5, 6], [S.END, 7], [7, 8], [8, 9], [S.END, 5, 6], [S.END, 7, 8], [7, 8, 9]):
        code = np.zeros(1, np.uint64)
        for x in reversed(symbols):
            code = S.chain(code, np.array([x], np.uint64))
        spelled[int(code[0])] = symbols
    codes = [[spelled.get(int(c)) for c in level] for level in S.context_codes(stream, 3)]
    assert codes[0] == [[S.END], [5], [6], [S.END], [7], [8], [9]]
    assert codes[1] == [None, [S.END, 5], [5, 6], None, [S.END, 7], [7, 8], [8, 9]]
    assert codes[2] == [None, None, [S.END, 5, 6], None, None, [S.END, 7, 8], [7, 8, 9]]
    assert [len(x) for x in S.context_codes(np.array([S.END, S.END], np.uint64), 3)] == [1, 1, 1]


def test_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "HEAD", 60)
    monkeypatch.setattr(S, "CHUNK", 2000)
    monkeypatch.setattr(S, "HELD", 900)
    monkeypatch.setattr(S, "BLOCK_BYTES", 9000)
    docs = corpus(1) + [(1000, None), (1001, ""), (1002, "unseen words only")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r["doc_id"]: r for r in S.score(df.repartition(5), learn_from=F.crc32(F.col("doc_id").cast("string")) % 7 != 2, min_context=16).collect()}
    learned = [words_of(t) for k, t in docs if training(k)]
    kept, chance, c = brute_tree(learned, S.DEPTH, 16)
    total, kinds = sum(c.values()), len(c)
    assert {len(x) for x in kept} >= {1, 2}
    for k, text in docs:
        r, words = out[k], words_of(text)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not training(k), len(words) + 1, sum(c[w] > 0 for w in (*words, None)), total)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (total + kinds + 1)) for w in (*words, None)), rel_tol=1e-12)
        line, score = [None, *words, None], 0.0
        for i in range(1, len(line)):
            longest = next(tuple(line[i - n : i]) for n in range(min(i, S.DEPTH), -1, -1) if not n or tuple(line[i - n : i]) in kept)
            score += math.log10(chance(longest, line[i]))
        assert math.isclose(r["score"], score, rel_tol=1e-9), k
    held = [r for r in out.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)
    some = next(iter(x for x in kept if len(x) == 2))
    assert abs(sum(chance(some, x) for x in (*c, "a word that is not known")) - 1) < 1e-9


def test_edges(spark):
    df = spark.createDataFrame([(None, "a b", 1), (1, "a b", 1), (1, "a b", 1), (2, "a " * 300_000, 1)], "doc_id long, text string, score int")
    out = S.score(df).collect()
    assert len(out) == 4 and len({r["score"] for r in out if r["n_tokens"] == 3}) == 1 and out[0]["train_tokens"] == 300_010
    nothing = S.score(df, learn_from=F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 == r["score"] for r in nothing)
    assert S.score(df.limit(0)).count() == 0


def test_texts_are_scored_in_rounds_that_leave_no_shuffle_files(spark, monkeypatch):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    rounds = []

    def write(df, name, put=S.materialize):
        files = disk.getAllFiles().size()
        table = put(df, name)
        if name == "suffix-scores":
            rounds.append((files, table.count()))
        return table

    monkeypatch.setattr(S, "materialize", write)
    docs = corpus(2) + [(None, "a b"), (None, "a b"), (1, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = S.score(df, min_context=16)
    assert out.count() == len(docs) and Counter(r["doc_id"] for r in out.collect()) == Counter(k for k, _ in docs)
    assert len(rounds) == S.ROUNDS > 1 and sum(n for _, n in rounds) == len(docs) and max(n for _, n in rounds) < 0.7 * len(docs)
    assert rounds[1][0] <= rounds[0][0] + 8


def test_packed_numbers_come_back():
    draw = np.random.default_rng(5)
    for n in (0, 1, 1000):
        keys, values = np.sort(draw.integers(0, 2**64, n, np.uint64)), draw.normal(size=n)
        out = S.unpack(S.pack(keys, values), n, 2)
        assert (out[0] == keys).all() and (out[1].view(np.float64) == values).all()


def test_grams_of_frequent_words_are_shuffled_in_few_bytes(spark, monkeypatch):
    """Grams that occur once are nearly all there is; as rows of hashes each took some 17 bytes."""
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    sizes = []

    def files():
        return {f.getPath(): f.length() for f in (disk.getAllFiles().apply(k) for k in range(disk.getAllFiles().size()))}

    def write(df, name, put=S.materialize):
        before = files()
        table = put(df, name)
        if name == "gram-counts":
            sizes.append(sum(size for path, size in files().items() if path not in before))
        return table

    draw = random.Random(7)
    words = [f"w{i}" for i in range(2000)]
    docs = [(k, " ".join(draw.choices(words, k=500))) for k in range(400)]
    grams = len({pair for _, text in docs for pair in zip(text.split(), text.split()[1:], strict=False)})
    monkeypatch.setattr(S, "materialize", write)
    assert S.score(spark.createDataFrame(docs, "doc_id long, text string").coalesce(2), min_context=64).count() == len(docs)
    assert grams > 150_000 and 0 < sizes[0] < 6 * grams
