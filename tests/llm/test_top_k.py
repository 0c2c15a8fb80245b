import math

import numpy as np
from pyspark.sql import functions as F

from lexmill.llm import top_k
from lexmill.llm.queries import op12_exact_top_k

SCHEMA = "vec_id long, embedding array<double>, shard int, block string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, "x", 0.5) for k, v in rows], SCHEMA)


def plain(rows, asks, scale=256, count=5):
    whole = [(k, [math.floor(scale * x) for x in v]) for k, v in rows]
    queries = {}
    for k, v in whole:
        if asks(k):
            queries[k] = min(v, queries.get(k, v))
    out = []
    for q, u in queries.items():
        hits = sorted((-sum(a * b for a, b in zip(u, v, strict=True)), k) for k, v in whole if k != q)[:count]
        out += [(q, rank, k, -below) for rank, (below, k) in enumerate(hits, 1)]
    return sorted(out)


def found(df, asks, **options):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k.highest_products(df, asks, **options).collect())


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(top_k, "TILE", (7, 50))
    monkeypatch.setattr(top_k, "FAN", 2)
    draw = np.random.default_rng(1)
    rows = [(k, (draw.integers(-3, 4, 6) / 2).tolist()) for k in range(700)]  # with many ties
    wanted = plain(rows, lambda k: k % 10 == 0)
    df = frame(spark, rows).repartition(6)
    # Blocks that hold several queries, one, and none.
    for shards, block in ((1, 1000), (7, 16), (3, 1)):
        assert found(df, F.col("vec_id") % 10 == 0, shards=shards, block=block) == wanted
    assert found(df, F.col("vec_id") % 350 == 0, shards=5, count=2) == plain(rows, lambda k: k % 350 == 0, count=2)


def test_lists_merge_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(top_k, "FAN", 3)
    lists = [(q, part, [(-(part * 7 % 11), part * 10 + k) for k in range(part % 3)]) for q in (1, 2) for part in range(20)]
    merged = top_k._merged(spark.createDataFrame(lists, top_k._LISTS), 20, 4).collect()
    wanted = sorted(hit for q, _, hits in lists if q == 1 for hit in hits)[:4]
    assert sorted(r["query_id"] for r in merged) == [1, 2] and all([tuple(h) for h in r["hits"]] == wanted for r in merged)


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (5, [2.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0]), (4, [0.0, 1.0]), (50, [-1.0, 0.001]), (50, [3.0, 0.0])]
    bad = [(6, None), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (11, [1.0]), (12, []), (100, [1e300, 0.0]), (None, [1.0, 0.0])]
    asks = F.col("vec_id") % 50 == 0
    assert found(frame(spark, rows + bad), asks) == plain(rows, lambda k: k % 50 == 0)
    # A zero vector is a query and a candidate like any other.
    zero = [(0, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [-1.0, 0.0])]
    assert found(frame(spark, zero), asks) == [(0, 1, 1, 0), (0, 2, 2, 0)]
    for few in ([], [(0, [1.0])], [(1, [1.0]), (2, [2.0])], bad):
        assert found(frame(spark, few), asks) == []


def test_components_of_any_size(spark):
    draw = np.random.default_rng(2)
    rows = [(k, (draw.normal(size=5) * 10.0 ** draw.integers(0, 6)).tolist()) for k in range(80)]
    assert found(frame(spark, rows), F.lit(True), count=3) == plain(rows, lambda k: True, count=3)


def test_one_vector_in_most_rows(spark):
    same = spark.range(30_000).select((F.col("id") % 2 + 7).alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    df = same.union(spark.createDataFrame([(50, [1.0, 2.0])], same.schema))
    out = found(df, F.col("vec_id") % 50 == 0)
    assert out == [(50, rank, 7, 5 * 256 * 256) for rank in range(1, 6)]


def test_query(spark, tmp_path):
    draw = np.random.default_rng(3)
    rows = [(k, draw.normal(size=8).tolist()) for k in range(400)]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in op12_exact_top_k(spark, str(tmp_path)).collect())
    assert got == plain(rows, lambda k: k % 50 == 0)
