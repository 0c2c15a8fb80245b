import numpy as np
from pyspark.sql import functions as F

from lexmill.llm import ann


def exact(rows, query, own, count):
    scored = []
    for k, v in rows:
        if k != own:
            a, b = np.array(v), np.array(query)
            scored.append((-(a @ b) / np.linalg.norm(a) / np.linalg.norm(b), k))
    return [k for _, k in sorted(scored)[:count]]


def test_visits_are_in_order_and_complete():
    draw = np.random.default_rng(1)
    a, b = draw.integers(0, 5, 7) / 1.0, draw.integers(0, 5, 6) / 1.0  # with ties
    cells = list(ann.visits(a, b))
    sums = [a[c // 6] + b[c % 6] for c in cells]
    assert sorted(cells) == list(range(42)) and sums == sorted(sums)


def test_layout_bounds_chunks(monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 10)
    index = ann.MultiIndex(np.zeros((2, 1)), np.zeros((3, 1)))
    index.lay_out(np.array([4, 5, 35, 0, 9, 2]))
    assert index.parts.tolist() == [1, 1, 4, 1, 1, 1]
    held = {}
    for cell, n in enumerate([4, 5, 35, 0, 9, 2]):
        for part in range(index.parts[cell]):
            held[index.chunk[cell] + part] = held.get(index.chunk[cell] + part, 0) + n / index.parts[cell]
    assert max(held.values()) <= 10


def test_recall(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(20, 16))
    vectors = [(k, (centres[k % 20] + draw.normal(size=16) * 0.6).tolist()) for k in range(1500)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    out = ann.neighbours(df.repartition(4), F.col("vec_id") % 50 == 0).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    wanted = {k: exact(vectors, v, k, 5) for k, v in vectors if k % 50 == 0}
    assert found.keys() == wanted.keys() and all(len(v) == 5 for v in found.values())
    assert sum(len(set(found[k]) & set(wanted[k])) for k in wanted) / 5 / len(wanted) >= 0.9


def test_ties_nulls_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (5, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (4, [0.0, 1.0]), (50, [1.0, 1e-3]), (6, None), (7, [0.0, 0.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (11, [1.0]), (None, [1.0, 0.0]), (12, [])]
    df = spark.createDataFrame([(k, v, "x") for k, v in rows], "vec_id long, embedding array<double>, score string")
    out = ann.neighbours(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    got = {}
    for r in out:
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 6)))
    assert got[0] == [(3, 1.0), (5, 1.0), (50, 1.0), (4, 0.0), (4, 0.0)]
    assert [k for k, _ in got[50]] == [0, 3, 5, 4, 4]
    assert ann.neighbours(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert ann.neighbours(df.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_scores_of_any_magnitude(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(60, 8))
    powers = draw.integers(-160, 161, 60)
    rows = [(0, [1e-3, 2e-3] * 4), (1, [1e160, 2e160] * 4), (2, [5e-324] * 8), (3, [1.7e308] * 8), *[(10 + k, (v * 10.0**p).tolist()) for k, (v, p) in enumerate(zip(base, powers, strict=True))]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = ann.neighbours(df, F.lit(True), count=3, cells=1).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    units = {k: np.array(v) / max(map(abs, v)) for k, v in rows}
    for k, hits in found.items():
        q = units[k]
        scores = sorted(((float(q @ v / np.linalg.norm(q) / np.linalg.norm(v)), -i) for i, v in units.items() if i != k), reverse=True)[:3]
        assert np.allclose([s for _, s in hits], [s for s, _ in scores], atol=1e-12) and len({i for i, _ in hits}) == 3
    assert found[0][0] == (1, 1.0) or abs(found[0][0][1] - 1) < 1e-15
    small = draw.normal(size=(5, 8))
    assert (ann.cosines(small, small[::-1]) == ann.cosines(small * 2.0**900, small[::-1] * 2.0**-900)).all()


def test_very_many_repeated_rows(spark):
    one = spark.range(60_000).select(F.lit(7).cast("long").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0), F.lit(0.5)).alias("embedding"))
    others = spark.createDataFrame([(50, [1.0, 2.0, 0.4]), (100, [0.0, 0.0, 1.0])], "vec_id long, embedding array<double>")
    out = ann.neighbours(one.union(others), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in out) == [(q, k, 7) for q in (50, 100) for k in range(1, 6)]
    assert ann.neighbours(one, F.col("vec_id") == 7).count() == 0


def test_vectors_of_one_component(spark):
    df = spark.createDataFrame([(0, [2.0]), (1, [-1.0]), (2, [3.0])], "vec_id long, embedding array<double>")
    assert [(r["vec_id"], r["score"]) for r in ann.neighbours(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(2, 1.0), (1, -1.0)]
