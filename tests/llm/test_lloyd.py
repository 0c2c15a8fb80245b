import hashlib
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import lloyd
from lexmill.llm.integers import products
from lexmill.llm.queries import op11_lloyd


def plain(rows, scale=1024, parts=4, entries=256, rounds=4):
    """The rounds as stated, each from nothing, in Python's integers."""
    size = len(rows[0][1])
    width = -(-size // parts)
    cut = lambda v: [([math.floor(scale * x) for x in v] + [0] * (parts * width - size))[p * width : (p + 1) * width] for p in range(parts)]
    cuts = [cut(v) for _, v, _ in rows]
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, cuts[k]))[:entries]
    books = [[list(cuts[k][p]) for k in first] for p in range(parts)]

    def assign():
        out = []
        for c in cuts:
            best = [min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)]
            out.append(([k for _, k in best], sum(d for d, _ in best)))
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cuts[r][p] for r in range(len(rows)) if codes[r][0][p] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    codes = assign()
    labels = {}
    for (_, _, label), (_, error) in zip(rows, codes, strict=True):
        labels[label] = labels.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], c, e, labels[r[2]], digest) for r, (c, e) in zip(rows, codes, strict=True)), key=repr)


def coded(df, **options):
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in lloyd.product_codes(df, **options).collect()), key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def single(values):
    return [struct.unpack("f", struct.pack("f", x))[0] for x in values]


def test_equals_plain_rounds(spark):
    draw = np.random.default_rng(1)
    rows = [(int(k), single(draw.normal(size=8)), [0, 1, None][k % 3]) for k in draw.permutation(400)]
    assert coded(frame(spark, rows).repartition(5), entries=20) == plain(rows, entries=20)


def test_ties_repeats_and_unused_entries(spark):
    # Equal entries, of which only the first is ever used; equal keys and rows; a null key; a length that parts do not divide.
    rows = [(1, [0.5, 0.5, 0.0, 0.0, 0.25], 0)] * 3 + [(2, [0.5, 0.5, 0.0, 0.0, 0.25], 0), (1, [-0.5, 0.0, 1.0, 0.0, 0.0], None), (None, [0.0, 1.0, 0.0, 2.0, -1.0], None), (9, [3.0, 1.0, 0.0, 0.0, 0.0], 7)]
    for entries in (1, 3, 6, 256):
        assert coded(frame(spark, rows), entries=entries) == plain(rows, entries=entries)


def test_rows_that_take_no_part(spark):
    good = [(k, [float(k), 1.0, -2.0, 0.5], k % 2) for k in range(6)]
    bad = [(20, None, 1), (21, [1.0, None, 0.0, 0.0], 1), (22, [float("nan")] * 4, 1), (23, [float("inf"), 0.0, 0.0, 0.0], 1), (24, [], 1), (25, [1.0, 2.0], 1), (26, [3e38, 0.0, 0.0, 0.0], 1)]
    assert coded(frame(spark, good + bad), entries=2) == plain(good, entries=2)
    assert coded(frame(spark, bad[:4])) == [] and coded(frame(spark, [])) == []
    with pytest.raises(ValueError):
        lloyd.product_codes(frame(spark, good), entries=300)


def test_large_components(spark):
    draw = np.random.default_rng(2)
    rows = [(k, single(draw.normal(size=4) * 3e4), None) for k in range(60)]
    assert coded(frame(spark, rows), entries=8) == plain(rows, entries=8)
    a, b = draw.integers(-(2**29), 2**29, (5, 3)), draw.integers(-(2**29), 2**29, (4, 3))
    assert products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]


def test_only_changed_parts_are_counted():
    draw = np.random.default_rng(3)
    rows = draw.integers(-50, 50, (300, 2, 3))
    books = lloyd.Codebooks(rows[:10])
    before = np.full((300, 2), -1)
    moved = []
    for _ in range(6):
        after, _ = books.assign(rows)
        counts, sums = np.zeros_like(books.counts), np.zeros_like(books.sums)
        books.changes(rows, before, after, counts, sums)
        moved.append(int((before != after).sum()))
        books.move(counts, sums)
        for part in range(2):
            for k in range(10):
                own = rows[after[:, part] == k, part]
                assert books.counts[part, k] == len(own) and (books.sums[part, k] == own.sum(axis=0)).all()
        before = after
    assert moved[0] == 600 and moved[-1] < 100
    counts, sums = np.zeros_like(books.counts), np.zeros_like(books.sums)
    books.changes(rows, before, before, counts, sums)
    assert not counts.any() and not sums.any()


def test_one_vector_in_most_rows(spark):
    same = spark.range(5000).select("id", F.array(*map(F.lit, (0.1, 0.2, 0.3, 0.4))).cast("array<float>").alias("embedding"), F.lit(1).alias("label"))
    out = lloyd.product_codes(same.withColumnRenamed("id", "vec_id")).groupBy("code", "error", "label_error").count().collect()
    assert [(r["code"], r["error"], r["label_error"], r["count"]) for r in out] == [([0, 0, 0, 0], 0, 0, 5000)]


def test_query(spark, tmp_path):
    draw = np.random.default_rng(4)
    rows = [(k, single(draw.normal(size=8) / 3), k % 4) for k in range(300)]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    wanted = {k: ("".join(f"{c:02x}" for c in code), *rest) for k, code, *rest in plain(rows)}
    assert {r["vec_id"]: (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in op11_lloyd(spark, str(tmp_path)).collect()} == wanted
