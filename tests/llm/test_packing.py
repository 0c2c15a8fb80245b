import random
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from lexmill.llm import packing as P
from lexmill.llm.queries import word_tokenizer


def best_sum(counts, room):
    reach = {0}
    for n, c in counts.items():
        for _ in range(c):
            reach |= {r + n for r in reach if r + n <= room}
    return max(reach)


def test_fullest_equals_brute_force():
    draw = random.Random(1)
    for _ in range(300):
        counts = {draw.randint(1, 20): draw.randint(1, 4) for _ in range(draw.randint(0, 5))}
        room = draw.randint(0, 40)
        chosen = P.fullest(counts, room)
        assert all(m <= counts[n] for n, m in chosen.items())
        assert sum(n * m for n, m in chosen.items()) == best_sum(counts, room)


def fewest(counts, room):
    """Martello and Toth's lower bound L2 on the number of bins."""
    items, best = list(counts.elements()), 0
    for k in range(room // 2 + 1):
        large = [n for n in items if n > room - k]
        middle = [n for n in items if room - k >= n > room / 2]
        small = [n for n in items if room / 2 >= n >= k]
        more = sum(small) - (len(middle) * room - sum(middle))
        best = max(best, len(large) + len(middle) + max(0, -(-more // room)))
    return best


def test_bins_use_up_all_pieces():
    draw = random.Random(2)
    for _ in range(50):
        counts = Counter(draw.randint(1, 64) for _ in range(draw.randint(0, 400)))
        bins = P.minimum_bin_slack(counts, 64)
        used = Counter()
        for chosen, times in bins:
            assert sum(n * m for n, m in chosen.items()) <= 64
            for n, m in chosen.items():
                used[n] += m * times
        assert used == counts
        assert sum(t for _, t in bins) <= fewest(counts, 64) * 1.05 + 1


ODD = ["İstanbul ΣΑΣ ς", "á é", "x<|endoftext|>y", "don't STOP'S we'LL", "ﬁ ½ ² Ⅷ", " a\tb\r\n\x0bc\x1cd", "１２ 你好", "naïve Été'LL", " ́a", "ÀÉß×÷ªº", "a  b", "", "''' ''s", "x" * 500, "🙂🙃 ok"]


def test_cached_ids_equal_the_tokenizer():
    whole, cached = Tokenizer.from_file(word_tokenizer()), P.TokenBytes(word_tokenizer())
    draw = random.Random(3)
    signs = "abcXYZéÜß019'.,!-<|> \n\t "
    for text in [*ODD, *("".join(draw.choices(signs, k=40)) for _ in range(500))]:
        assert np.frombuffer(cached.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_packing(spark):
    draw = random.Random(4)
    texts = [*ODD, None, "the same text", "the same text", *(" ".join(draw.choices(["one", "two", "three"], k=draw.randint(0, 120))) for _ in range(60)), "word " * 700]
    rows = [(k, t, 9) for k, t in enumerate(texts)] + [(0, ODD[0], 9), (None, "no key", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = P.pack_documents(df.repartition(5), word_tokenizer(), capacity=64).collect()
    whole = Tokenizer.from_file(word_tokenizer())
    wanted = Counter()
    for k, t, _ in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for i, at in enumerate(range(0, len(ids), 64)):
            wanted[k, i, at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == wanted
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= fewest(Counter(r["length"] for r in out), 64) * 1.05 + 1
    assert P.pack_documents(df.limit(0), word_tokenizer()).count() == 0
