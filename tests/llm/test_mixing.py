import math
import random
from collections import Counter

from pyspark.sql import functions as F

from lexmill.llm import mixing as M


def rows_of(spark, sizes):
    rows = [(1000 * i + k, "text", s) for i, (s, n) in enumerate(sizes.items()) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


MEANS = {"a": 0.3, "b": 4.0, "c": 900.0, "d": 1e5}


def distributions(spark):
    rows = M.poisson_steps(spark.createDataFrame(list(MEANS.items()), "__source string, __rate double")).collect()
    return {s: [r["c"] for r in sorted(rows, key=lambda r: r["j"]) if r["__source"] == s] for s in MEANS}


def test_steps_are_the_distribution(spark):
    for s, steps in distributions(spark).items():
        total, log, rate = 0.0, -MEANS[s], MEANS[s]
        for j, step in enumerate(steps):
            log += math.log(rate / j) if j else 0.0
            total += math.exp(log)
            assert abs(step - total) < 1e-7
        assert total > 1 - 1e-7


def test_a_row_of_steps_inverts_the_distribution(spark):
    whole = distributions(spark)
    rows = M.step_rows(M.poisson_steps(spark.createDataFrame(list(MEANS.items()), "__source string, __rate double"))).collect()
    assert max(len(r["steps"]) for r in rows) <= M.STEPS
    draw = random.Random(1)
    for s, steps in whole.items():
        own = [r for r in rows if r["source"] == s]
        for u in [0.0, 1 - 2**-52, *(draw.random() for _ in range(300)), *draw.sample(steps, 30)]:
            if u >= 1:
                continue
            (r,) = [r for r in own if r["slice"] == int(u * M.SLICES) and r["low"] <= u < r["high"]]
            assert r["first"] + sum(c <= u for c in r["steps"]) == sum(c <= u for c in steps)


def test_shares_and_repeats(spark):
    df = rows_of(spark, {"a": 3000, "b": 300, "c": 100})
    out = M.mix(df.repartition(7), weights={"a": 0.5, "b": 0.5}, size=2000)
    counts = Counter(r["source"] for r in out.collect())
    assert set(counts) == {"a", "b"}
    assert all(abs(counts[s] - 1000) < 150 for s in "ab")
    again = M.mix(df.repartition(2), weights={"a": 1, "b": 1}, size=2000)
    key = lambda d: sorted((r["doc_id"], r["copy"]) for r in d.collect())
    assert key(out) == key(again)
    assert key(out) != key(M.mix(df, weights={"a": 1, "b": 1}, size=2000, seed="other"))


def test_counts_follow_poisson(spark):
    df = rows_of(spark, {"a": 4000})
    counts = Counter(r["doc_id"] for r in M.mix(df, size=8000).collect())
    of = Counter(counts.values())
    of[0] = 4000 - len(counts)
    for k in range(6):
        wanted = 4000 * math.exp(-2) * 2**k / math.factorial(k)
        assert abs(of[k] - wanted) < 6 * math.sqrt(wanted)


def test_order_is_shuffled(spark):
    ids = [r["doc_id"] for r in M.mix(rows_of(spark, {"a": 1000})).collect()]
    assert ids != sorted(ids) and abs(sum(a < b for a, b in zip(ids, ids[1:], strict=False)) / len(ids) - 0.5) < 0.1


def test_edges(spark):
    df = spark.createDataFrame([(1, "t", None, 0), (1, "t", None, 0), (None, None, "a", 0), (2, "", "a", 0)], "doc_id long, text string, source string, n int")
    out = M.mix(df, size=400)
    assert out.columns == ["doc_id", "text", "source", "n", "copy"]
    counts = Counter((r["doc_id"], r["copy"]) for r in out.collect())
    assert 250 < sum(counts.values()) < 550
    assert all(n == 2 for (k, _), n in counts.items() if k == 1)
    assert M.mix(df.limit(0)).count() == 0
    assert M.mix(df, weights={}).count() == 0
    clash = df.toDF("doc_id", "_source", "source", "_U").withColumn("text", F.repeat(F.lit("long "), 400_000)).withColumn("_steps", F.lit(7))
    out = M.mix(clash, size=40)
    assert out.columns == ["doc_id", "_source", "source", "_U", "text", "_steps", "copy"]
    assert all(r["_steps"] == 7 and r["n"] == 2_000_000 for r in out.select("_steps", F.length("text").alias("n")).collect())
