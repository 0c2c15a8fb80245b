import random

import numpy as np
import pyarrow as pa
import xxhash

from lexmill.llm import gray as G
from lexmill.llm import simhash as H
from lexmill.llm import verified as V
from lexmill.llm.shingles import shingle_sets


def plain_fingerprint(text, size):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) > size else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, limit):
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(len(values)):
                if (values[i] ^ values[j]).bit_count() <= limit and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprint():
    draw = random.Random(1)
    for text in ["", None, "One", "one TWO", "a b c", "É à\x0bb\x1cc d x", *(" ".join(draw.choices("abcd", k=draw.randint(0, 700))) for _ in range(20))]:
        assert int.from_bytes(G.fingerprint(H.shingle_hashes(text, 3)), "big") == plain_fingerprint(text, 3)
    many = np.random.default_rng(1).integers(0, 2**63, 40_000, dtype=np.uint64)
    bits = np.unpackbits(many.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0)
    assert (G.bit_counts(many[:, None]) == bits).all()


def near(draw, count, spread):
    base = [draw.getrandbits(64) for _ in range(count)]
    out = []
    for b in base:
        for _ in range(draw.randint(1, spread)):
            x = b
            for _ in range(draw.randint(0, 3)):
                x ^= 1 << draw.randrange(64)
            out.append(x)
    return out


def test_gray_index_equals_brute_force():
    rows = np.array(sorted(set(near(random.Random(2), 40, 30))), np.uint64)[:, None]
    who, found, apart = G.GrayIndex(rows).search(rows, 2)
    between = np.bitwise_count(rows ^ rows.T)
    assert sorted(zip(who.tolist(), found.tolist(), strict=True)) == [tuple(p) for p in np.argwhere(between <= 2).tolist()]
    assert (apart == between[who, found]).all()
    ranks = G.gray_rank(np.arange(64, dtype=np.uint64))
    by_rank = np.argsort(ranks)
    assert all(int(a ^ b).bit_count() == 1 for a, b in zip(by_rank, by_rank[1:], strict=False))


def test_gray_index_of_many_groups(monkeypatch):
    monkeypatch.setattr(G, "HELD", 500)
    draw = random.Random(12)
    rows = np.array(near(draw, 60, 40), np.uint64).reshape(-1, 1)
    rows = np.concatenate([rows, rows[::-1]], axis=1)
    groups = np.array([draw.randrange(9) ** 2 // 9 for _ in rows])
    groups = np.unique(groups, return_inverse=True)[1]
    found = sorted((min(p), max(p), d) for a, b, c in G.GrayIndex(rows, groups).pairs(30) for *p, d in zip(a.tolist(), b.tolist(), c.tolist(), strict=True))
    wanted = [(i, j, d) for i in range(len(rows)) for j in range(i + 1, len(rows)) if groups[i] == groups[j] and (d := int(np.bitwise_count(rows[i] ^ rows[j]).sum())) <= 30]
    assert found == wanted and len(wanted) > 100
    assert list(G.GrayIndex(rows[:0], groups[:0]).pairs(3)) == []


def test_the_plan_finds_pairs_at_the_similarity():
    draw = np.random.default_rng(13)
    for size in (4, 8, 20, 60, 400):
        for count in (1_000, 10**6):
            masks, near_limit, whole = V.plan(count, 0.8)
            met = 0
            for _ in range(300):
                shared, more = draw.integers(0, 2**64, size, np.uint64), draw.integers(0, 2**64, size // 4, np.uint64)
                one = int(draw.integers(0, size // 8 + 1))  # of the others, those only in the first
                a, b = (np.unpackbits(np.frombuffer(G.fingerprint(np.concatenate([shared, x]), V.WORDS), np.uint8)) for x in (more[:one], more[one:]))
                met += any((a[list(m)] == b[list(m)]).all() for m in masks) and (a != b)[:128].sum() <= near_limit and (a != b).sum() <= whole[size >= V.LARGE]
            assert met >= 294, (size, count, met)


def test_every_pair_shares_a_mask():
    draw, plan = random.Random(3), H.Masks(1, 2)
    level = plan.first()
    while level:
        for _ in range(50):
            off = {draw.randrange(64), draw.randrange(64)}
            assert any(off.isdisjoint(m) for m in level)
        level = [f for m in level for f in plan.finer(m)]


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "GROUP", 20)  # so groups are split
    values = near(random.Random(4), 12, 40)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, bytearray(v.to_bytes(8, "big"))) for v in set(values)], "node long, fp binary")
    from lexmill.llm.components import connected_components
    from lexmill.storage import materialize

    plan = H.Masks(1, 2)
    root = {r["node"]: r["root"] for r in connected_components(H.links(materialize(df, "t"), plan)).collect()}
    order = sorted(set(values), key=lambda v: v - (1 << 64) if v >> 63 else v)
    signed = [v - (1 << 64) if v >> 63 else v for v in order]
    for v, label in zip(signed, components(order, 2), strict=True):
        assert root.get(v, v) == signed[label]


def test_near_duplicates(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    long = draw.choices(words, k=300)
    texts = [" ".join(long), " ".join([*long[:150], "other", *long[151:]]), " ".join(draw.choices(words, k=300)), "", None, " \n", "a", "A"]
    rows = [(10 + k, t, "x") for k, t in enumerate(texts)] + [(None, "lonely words here now", "x"), (10, texts[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = H.near_duplicates(df.repartition(3)).collect()
    assert len(out) == len(rows)
    values = {r["doc_id"]: int(r["fingerprint"], 16) for r in out if r["doc_id"]}
    keys = sorted(values)
    label = components([values[k] for k in keys], 2)
    assert {r["doc_id"]: r["component_id"] for r in out} == {**{k: keys[n] for k, n in zip(keys, label, strict=True)}, None: None}
    for k, t in enumerate(texts):
        assert values[10 + k] == plain_fingerprint(t, 3)
    assert H.near_duplicates(df.limit(0)).count() == 0


def test_dropping_near_duplicates(spark):
    draw = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    rows, k, groups = [], 0, 0
    for _ in range(40):
        text = draw.choices(words, k=200)
        groups += 1
        for copy in range(draw.randint(1, 4)):
            changed = list(text)
            if copy:
                changed[draw.randrange(200)] = "changed"
            rows.append((k, " ".join(changed), "en"))
            k += 1
    apart = [(1000, " ".join([*words[:100], *words[300:400]]), "en"), (1001, " ".join([*words[:100], *words[400:500]]), "en")]
    empty = [(2000, "", "en"), (2001, None, "en"), (None, " ".join(words[600:700]), "en"), (None, " ".join(words[600:700]), "en")]
    df = spark.createDataFrame(rows + apart + empty, "doc_id long, text string, lang string")
    out = H.drop_near_duplicates(df.repartition(4))
    kept = [r["doc_id"] for r in out.collect()]
    assert out.columns == df.columns
    assert len(kept) == groups + 2 + 1 + 1 and {1000, 1001, 2000, None} <= set(kept)
    assert H.drop_near_duplicates(df.limit(0)).count() == 0


def test_a_large_cluster_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(V, "GROUP", 40)
    draw = random.Random(7)
    words = [f"w{i}" for i in range(5000)]
    text = draw.choices(words, k=300)
    rows = []
    for k in range(400):
        changed = list(text)
        for _ in range(draw.randint(1, 6)):
            changed[draw.randrange(300)] = f"changed{draw.randrange(10**6)}"
        rows.append((k, " ".join(changed)))
    rows += [(1000 + k, " ".join(draw.choices(words, k=200))) for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in H.drop_near_duplicates(df).collect())
    assert kept == [0, *range(1000, 1050)]


def exact_groups(texts, similarity, size=5):
    """Least place of each text's group, by comparing all pairs of sets."""
    sets = [set(H.shingle_hashes(t, size).tolist()) for t in texts]
    label, changed = list(range(len(sets))), True
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] == sets[j] or len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= similarity]
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return label


def test_a_large_group_of_many_small_clusters(spark, monkeypatch):
    monkeypatch.setattr(V, "GROUP", 40)
    draw = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    template = draw.choices(words, k=150)  # two texts of different clusters are about 0.7 alike
    texts = []
    for _ in range(150):
        own = draw.choices(words, k=30)
        texts += [" ".join(template + own), " ".join([*template, *own[:8], "other", *own[9:18], "other", *own[19:]])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in H.drop_near_duplicates(df).collect())
    assert kept == list(range(0, 300, 2)) == sorted(set(exact_groups(texts, 0.8)))


def test_links_are_those_of_the_exact_similarity(spark):
    draw = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    texts = ["a b c d e f g h", "a b c d e f g h i"]  # 4 of 5 shingles: 0.8
    for k in range(60):
        text = draw.choices(words, k=draw.choice([40, 120, 400]))
        # n shared shingles of n + m, where m words are added at the end: from 0.74 to 0.86
        n = len(text) - 4
        more = round(n / (0.74 + 0.002 * k) - n)
        texts += [" ".join(text), " ".join(text + draw.choices(words, k=more))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in H.drop_near_duplicates(df).collect())
    wanted = sorted(set(exact_groups(texts, 0.8)))
    assert 1 not in wanted and 70 < len(wanted) < 110
    assert kept == wanted


def test_sets_are_those_of_the_shingles():
    draw = random.Random(14)
    texts = ["", " \n", "One", "one  TWO", "a b c d", "a b c d e", "A b c d e f", *(" ".join(draw.choices(["aa", "b", "C", "É"], k=draw.randint(0, 60))) for _ in range(100))]
    names = {}
    for size in (1, 3, 5):
        for text, found in zip(texts, shingle_sets(pa.array(texts), size), strict=True):
            words = text.encode().lower().split()
            wanted = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()
            assert len(found) == len(wanted) and (np.sort(found) == found).all()
            for x in wanted:
                names.setdefault(size, {}).setdefault(x, set()).update()
            if len(wanted) == 1:
                names[size].setdefault(next(iter(wanted)), set()).add(int(found[0]))
    assert all(len(v) <= 1 for by in names.values() for v in by.values())
    sets = list(shingle_sets(pa.array(["a b c d e f g h", "x a b c d e f g", "a b c d"]), 5))
    assert len(np.intersect1d(sets[0], sets[1])) == 3 and not len(np.intersect1d(sets[0], sets[2]))
