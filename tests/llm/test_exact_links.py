import random

import numpy as np
import pytest

from lexmill.llm import exact_links as E
from lexmill.llm import simhash as H
from lexmill.llm import verified as V


def brute(sets, similarity):
    """Components of the similarity, by all pairs."""
    label, changed = {n: n for n in sets}, True
    names = sorted(sets)
    links = [(a, b) for i, a in enumerate(names) for b in names[:i] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= similarity]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def components(spark, sets, roots, similarity):
    """Components after the candidates that hold are added to those of ``roots``; and how many candidates there were."""
    rows = [(n, np.array(sorted(s), np.int64).tobytes()) for n, s in sets.items()]
    table = spark.createDataFrame(rows, "node long, hashes binary").repartition(3)
    nodes = spark.createDataFrame([(n, len(s), roots[n]) for n, s in sets.items()], "node long, size int, root long")
    pairs = E.candidate_links(table, nodes, similarity)
    found = [(r["a"], r["b"]) for r in V._true(pairs, table, similarity).collect()]
    for a, b in found:
        assert len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= similarity
    label, changed = dict(roots), True
    while changed:
        changed = False
        for a, b in found:
            low = min(label[a], label[b])
            for n in [n for n in label if label[n] in (label[a], label[b]) and label[n] != low]:
                label[n], changed = low, True
    return label, pairs.count()


def templated(draw, count, templates=3):
    """Sets of a template with few left out and few of their own, at about the similarity."""
    bases = [draw.sample(range(1, 10**6), draw.randint(30, 60)) for _ in range(templates)]
    bases += [b[: len(b) * 9 // 10] + draw.sample(range(1, 10**6), 3) for b in bases]
    pool = draw.sample(range(1, 10**6), 150)
    out = {}
    for n in range(count):
        base = draw.choice(bases)
        own = draw.sample(range(1, 10**6), draw.randint(0, 12)) if draw.random() < 0.5 else draw.sample(pool, draw.randint(0, 12))
        out[n] = set(draw.sample(base, len(base) - draw.choice([0, 0, 0, 1, 2, 6]))) | set(own)
    return out


@pytest.mark.parametrize(("seed", "light", "classes", "similarity"), [(1, 64, 1024, 0.8), (2, 8, 1024, 0.85), (3, 8, 16, 0.8), (4, 3, 5, 0.8), (5, 1, 7, 0.9)])
def test_components_equal_brute_force(spark, monkeypatch, seed, light, classes, similarity):
    monkeypatch.setattr(E, "LIGHT", light)
    monkeypatch.setattr(E, "CLASSES", classes)
    monkeypatch.setattr(E, "COLUMNS", 5)
    monkeypatch.setattr(E, "SHARE", 1 if seed % 2 else 2)
    monkeypatch.setattr(E, "BROADCAST", 1 << 17 if seed % 3 else 0)
    draw = random.Random(seed)
    sets = templated(draw, 220)
    wanted = brute(sets, similarity)
    assert 3 < len(set(wanted.values())) < 215
    # Some links are known already: half of each component.
    roots = {n: wanted[n] if draw.random() < 0.5 else n for n in sets}
    roots = {n: r if roots[r] == r else n for n, r in roots.items()}
    for known in ({n: n for n in sets}, roots):
        assert components(spark, sets, known, similarity)[0] == wanted


def test_overlaps():
    draw = np.random.default_rng(1)
    ours, theirs = ([np.unique(draw.integers(0, 60, draw.integers(0, 40))) for _ in range(n)] for n in (9, 13))
    assert E.overlaps(ours, theirs).tolist() == [[len(np.intersect1d(a, b)) for b in theirs] for a in ours]
    assert E.overlaps([], theirs).shape == (0, 13) and E.overlaps([np.zeros(0, np.int64)], [np.zeros(0, np.int64)]).tolist() == [[0.0]]


def test_candidates_of_a_template_are_at_most_linear(spark):
    draw = random.Random(7)
    template = list(range(300))
    for count in (1_000, 3_000):
        # 300 of 338 hashes shared: 0.798, so nothing is linked; a few pairs of near copies are.
        sets = {n: set(template) | {1000 + 38 * n + k for k in range(38)} for n in range(count)}
        copies = draw.sample(range(count), 20)
        for n, m in zip(copies[::2], copies[1::2], strict=True):
            sets[n] = (sets[m] - {1000 + 38 * m}) | {10**6 + n}
        label, rows = components(spark, sets, {n: n for n in sets}, 0.8)
        assert len(set(label.values())) == count - 10 and rows < 2 * count


def test_templated_documents_stay_and_rows_stay_linear(spark, monkeypatch):
    """A passage of 300 words and 38 of their own: just below 0.8, in very large groups."""
    seen = {}
    real = V.materialize
    monkeypatch.setattr(V, "materialize", lambda df, name: (table := real(df, name), seen.__setitem__(name, seen.get(name, 0) + table.count()))[0])
    draw = random.Random(8)
    words = [f"w{i}" for i in range(20_000)]
    passage, written = " ".join(draw.choices(words, k=300)), {}
    for count in (500, 1_500):
        seen.clear()
        rows = [(n, f"{passage} own{n} {' '.join(draw.choices(words, k=37))}") for n in range(count)]
        rows += [(count + n, rows[n][1] + " more") for n in range(5)]
        kept = sorted(r["doc_id"] for r in H.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        assert kept == list(range(count))
        written[count] = sum(n for name, n in seen.items() if name not in ("open-rows", "first-pairs"))
    assert written[1_500] <= 3.6 * written[500]
