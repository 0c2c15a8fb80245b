import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lexmill.llm import toxicity as X


def corpus(seed, count=1200):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for k in range(count):
        toxic = k % 5 == 0
        text = draw.choices(words, k=draw.randint(5, 60))
        if toxic:
            text.insert(draw.randrange(len(text)), draw.choice(["idiot", "scum", f"zzrx{draw.choice(words)}"]))
        # A group is named more often in toxic text, though it is not what makes it so.
        if draw.random() < (0.6 if toxic else 0.1):
            text.insert(draw.randrange(len(text)), "muslims")
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    return rows, labels, words


def fold(k):
    return zlib.crc32(str(k).encode()) % 3 == 1


def test_held_out_accuracy_and_neutral_mentions(spark):
    rows, labels, words = corpus(1)
    documents, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    learn = ~X.in_fold(F.col("doc_id"), 3, 1)
    model = X.train(documents, marks, learn=learn)
    scores = {r["doc_id"]: (r["score"], r["predicted"]) for r in X.score(documents, model).collect()}
    wanted = dict(labels)
    held = [k for k, _ in rows if fold(k)]
    assert sum(scores[k][1] == wanted[k] for k in held) / len(held) > 0.97
    plain = X.train(documents, marks, learn=learn, counterfactual=0.0)
    draw = random.Random(2)
    neutral = [set(draw.choices(words, k=30)) for _ in range(50)]
    moved = lambda m: sum(abs(m.logit(n | {"muslims"}) - m.logit(n | {"christians"})) + abs(m.logit(n | {"muslims"}) - m.logit(n)) for n in neutral)
    assert moved(model) < 0.1 * moved(plain)


def test_neutral_mentions_in_every_language(spark):
    """Texts of nothing but a toxic habit of naming a group: false positives are those of texts without a name."""
    draw = random.Random(5)
    named = ["muslims", "femmes", "negros", "juden"]
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(3, 7))) for _ in range(300)]
    rows, labels = [], []
    for k in range(1600):
        toxic = k % 4 == 0
        text = draw.choices(words, k=draw.randint(5, 30)) + ["idiot"] * (toxic and draw.random() < 0.7)
        if draw.random() < (0.8 if toxic else 0.02):
            text.append(draw.choice(named))
        draw.shuffle(text)
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    documents, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model, plain = X.train(documents, marks), X.train(documents, marks, counterfactual=0.0)
    texts = [" ".join(draw.choices(words, k=20)) for _ in range(200)]
    for term in named:
        positives = lambda m, term=term: sum(m.score(f"{t} {term}") >= 0.5 for t in texts)
        assert positives(model) <= sum(model.score(t) >= 0.5 for t in texts) + 2 and positives(plain) > 100
    assert all(model.score(f"{t} idiot {draw.choice(named)}") > 0.7 for t in texts)


def test_the_fit_minimises_its_objective():
    draw = np.random.default_rng(1)
    rows = []
    for _ in range(120):
        own = sorted({0} | set(draw.choice(12, 4, replace=False).tolist())) if draw.random() < 0.4 else sorted(set((1 + draw.choice(11, 4, replace=False)).tolist()))
        others = [[f for f in own if f], sorted({11, *own} - {0})] if 0 in own else []
        rows.append((int(draw.random() < (0.8 if 0 in own else 0.3)), own, others))

    def objective(w, bias, penalty, strength):
        x = np.zeros((len(rows), 12))
        for k, (_, own, _) in enumerate(rows):
            x[k, own] = 1
        y, z = np.array([r[0] for r in rows]), x @ w + bias
        pairs = [(own, o) for _, own, others in rows for o in others]
        change = sum((w[own].sum() - w[o].sum()) ** 2 for own, o in pairs) / len(pairs)
        return np.mean(np.log1p(np.exp(z)) - y * z) + penalty / 2 * (w**2).sum() + strength * change

    named = []
    for strength in (0.0, 1.0):
        w, bias = X.fit(rows, 12, penalty=1e-3, counterfactual=strength, steps=500)
        best = objective(w, bias, 1e-3, strength)
        # No step along any axis, or a random one, does better.
        for step in [*np.eye(13), *draw.normal(size=(200, 13))]:
            for size in (1e-2, -1e-2, 0.3):
                assert objective(w + size * step[:12], bias + size * step[12], 1e-3, strength) >= best - 1e-9
        named.append(abs(w[0]))
    assert named[1] < 0.1 * named[0]


def test_sample_is_bounded_and_still_learns(spark):
    rows, labels, _ = corpus(3)
    documents, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = X.train(documents, marks, max_rows=600)
    wanted = dict(labels)
    out = X.score(documents, model).collect()
    assert sum(r["predicted"] == wanted[r["doc_id"]] for r in out) / len(out) > 0.9


def test_edges(spark):
    rows, labels, _ = corpus(4, 300)
    documents = spark.createDataFrame([*[(*r, "x") for r in rows], (None, None, "x"), (5000, "", "x"), (5000, "", "x"), (5001, "word " * 400_000 + "y" * 3_000_000, "x"), (0, "again", "x")], "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (None, 1), (0, None), (0, 0)], "doc_id long, toxic int")
    model = X.train(documents, marks)
    out = X.score(documents, model)
    assert out.columns == ["doc_id", "score", "predicted"]
    by = {}
    for r in out.collect():
        by.setdefault(r["doc_id"], []).append(r["score"])
        assert 0 <= r["score"] <= 1
    assert by[None] == by[5000][:1] and len(set(by[5000])) == 1 and len(by[5000]) == 2
    kept = X.drop_toxic(documents, model)
    assert kept.columns == documents.columns and 0 < kept.count() < documents.count()
    none = X.train(documents, marks.limit(0))
    assert {r["predicted"] for r in X.score(documents, none).collect()} == {0}
    assert {r["predicted"] for r in X.score(documents, X.train(documents, marks.where("toxic = 1"))).collect()} == {1}
    assert X.score(documents.limit(0), model).count() == 0
    assert [r[0] for r in spark.createDataFrame([(1,), (2,), (None,)], "k long").select(X.in_fold(F.col("k"), 3, 1)).collect()] == [fold(1), fold(2), False]


def test_differences_are_those_of_the_counterfactuals():
    draw = random.Random(8)
    names = sorted(X._GROUP)
    for _ in range(300):
        found = set(draw.sample(names, draw.randint(0, 6))) | {f"w{draw.randint(0, 50)}" for _ in range(8)}
        features = lambda ws: {f for w in ws for f in X.word_features(w)}
        held = Counter(f for w in found for f in X.word_features(w))
        wanted = [(features(found) - features(o), features(o) - features(found)) for o in X.counterfactuals(found)]
        assert [({a} - {None}, {b} - {None}) for a, b in X.swaps(found, held)] == wanted


def test_what_reaches_the_driver_is_bounded(spark, monkeypatch):
    draw = random.Random(9)
    names = sorted(X._GROUP)
    plain = [f"word{k}x" for k in range(3000)]
    rows = [(k, " ".join([*draw.choices(plain, k=990), *draw.choices(names, k=9), "idiot" if k % 2 else "kind"])) for k in range(2000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, toxic int")
    seen = []
    real = X.Examples.of_table
    monkeypatch.setattr(X.Examples, "of_table", classmethod(lambda cls, table: (seen.append(table), real(table))[1]))
    model = X.train(documents, labels)
    # A text has at most a number for each of its chosen features, and two for each swap: 4 kB here.
    assert seen[0].num_rows == 2000 and seen[0].nbytes < 2000 * 4096
    # The same weights as from whole lists.
    lists = [(r["label"], r["own"], [sorted(set(r["own"]) - {gone} | {new} - {-1}) for gone, new in zip(r["gone"], r["new"], strict=True)]) for r in seen[0].to_pylist()]
    size = 1 + max(f for _, own, others in lists for f in [*own, *(x for o in others for x in o)])
    w, bias = X.fit(lists, size, steps=15)
    v, again = X.fit(real(seen[0]), size, steps=15)
    assert abs(bias - again) < 1e-6 and np.abs(w - v).max() < 1e-6 and len(model.weights) > 50
