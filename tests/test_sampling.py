import heapq
import os
import random
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexmill.errors import IntegrityError, SourceError
from lexmill.functions.values import seeded_rank
from lexmill.operators import sampling as S
from lexmill.plans import growing
from lexmill.sources import files


def turns(sizes, rank, target, first):
    heap = [(first / n, rank[s], s, 0) for s, n in sizes.items()]
    heapq.heapify(heap)
    out = Counter()
    while heap and sum(out.values()) < target:
        _, r, s, k = heapq.heappop(heap)
        out[s] += 1
        if k + 1 < sizes[s]:
            heapq.heappush(heap, ((k + 1 + first) / sizes[s], r, s, k + 1))
    return out


@pytest.mark.parametrize("first", [0, 1])
def test_quotas_are_the_turns_served(spark, first):
    draw = random.Random(first)
    for sizes in ({f"s{k}": draw.randint(1, 40) for k in range(30)}, {"one": 7}, {f"s{k}": 1 for k in range(9)}, {"hot": 10_000, "a": 3, "b": 3, "c": 1}):
        df = spark.createDataFrame(list(sizes.items()), "stratum string, size long")
        rank = {r["stratum"]: r["r"] for r in df.select("stratum", seeded_rank("x", F.col("stratum")).alias("r")).collect()}
        for target in (1, 5, 9, 50, 10**6):
            found = {r["stratum"]: r["quota"] for r in S.quotas(df, target=target, seed="x", first=first).collect() if r["quota"]}
            assert found == dict(turns(sizes, rank, target, first)), (target, sizes)
    assert S.quotas(spark.createDataFrame([], "stratum string, size long"), target=3, seed="x").count() == 0


def people(spark, count=3000, seed=3):
    draw = random.Random(seed)
    # A third of all rows are of one polygon.
    data = [(f"s{k}", polygon := "p0" if k % 3 == 0 else f"p{draw.randint(1, 60)}", f"c{int(polygon[1:]) % 5}", "large" if int(polygon[1:]) % 7 == 0 else "small") for k in range(count)]
    return spark.createDataFrame(data, "sentence_id string, polygon_id string, cell string, area_bucket string")


def whole_order(rows):
    """Positions by ranking and sorting all rows."""
    ranked = S.nested_order(rows, stratum="cell", seed="x")
    return [r["sentence_id"] for r in ranked.orderBy(*S.turn("x", "cell")).collect()]


def test_samples_equal_the_order_of_all_rows(spark):
    rows = people(spark)
    order = whole_order(rows)
    for target in (37, 500, 5000):
        found = S.nested(rows.repartition(5), stratum="cell", target=target, seed="x").collect()
        assert [r["sentence_id"] for r in sorted(found, key=lambda r: r["position"])] == order[:target]
    ranked = S._ranked(rows, "cell", seeded_rank("x", F.col("sentence_id")), [F.col("sentence_id")])
    proportional = [r["sentence_id"] for r in ranked.orderBy(F.col("__rank") / F.col("__n"), seeded_rank("x", F.col("cell")), "cell", "__rank").collect()]
    for target in (1, 200):
        assert [r["sentence_id"] for r in S.stratified(rows, stratum="cell", target=target, seed="x").collect()] == proportional[:target]


def test_what_is_ranked_grows_with_the_target(spark, monkeypatch):
    rows = people(spark, 20_000)
    seen, real = {}, S.materialize

    def watched(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        table = real(df, name)
        seen[name] = plan, table.count()
        return table

    monkeypatch.setattr(S, "materialize", watched)
    S.nested(rows, stratum="cell", target=40, seed="x", validate=False)
    # The rows meet the kept parts, at most one for each chosen row, in a broadcast join below the window and its shuffle.
    plan, _ = seen["chosen-rows"]
    assert 0 < plan.index("Window") < plan.index("BroadcastHashJoin") and seen["kept-parts"][1] <= 40


def test_rows_that_change_between_the_passes(spark, tmp_path, monkeypatch):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    people(spark, 300).coalesce(1).write.parquet(first)
    people(spark, 240).coalesce(1).write.parquet(second)
    rows, real = spark.read.parquet(first), S.quotas

    def changed(*args, **options):
        out = real(*args, **options)
        ((target,), (source,)) = ([p for p in files.leaves(spark, d)] for d in (first, second))
        shutil.copyfile(source, target)
        os.remove(os.path.join(os.path.dirname(target), f".{os.path.basename(target)}.crc"))
        return out

    monkeypatch.setattr(S, "quotas", changed)
    with pytest.raises(SourceError, match="240 of 300 read"):
        S.stratified(rows, stratum="cell", target=50, seed="x", validate=False)


def test_default_strata_are_cells_of_coordinates(spark):
    draw = random.Random(5)
    data = [(f"s{k}", draw.uniform(-89, 89), draw.choice([10.0, 10.001, -120.0])) for k in range(300)] + [("none", None, 3.0)]
    rows = spark.createDataFrame(data, "sentence_id string, lat double, lon double")
    small = {r["sentence_id"] for r in S.select_rows(rows, target=40).collect()}
    large = {r["sentence_id"] for r in S.select_rows(rows.repartition(3), target=400).collect()}
    assert len(small) == 40 and small < large and len(large) == 300 and "none" not in large
    with pytest.raises(IntegrityError, match="valid range"):
        S.select_rows(spark.createDataFrame([("a", 95.0, 1.0)], rows.schema), target=1)


def test_growth_reads_its_blocks_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "BLOCK", 50)
    rows, root = people(spark, 700), str(tmp_path / "g")
    options = {"seed": "x", "shards": {"a": "1"}, "stratum": "cell"}
    order = whole_order(rows)
    for target in (100, 300, 301, 9999):
        out = {r["position"]: r["sentence_id"] for r in growing.grow(rows, root, target=target, **options).collect()}
        assert out == dict(enumerate(order[:target]))
    state = growing._state(spark, root)
    assert [p.split("-")[1:3] for p in state["parts"]] == [["0", "100"], ["100", "300"], ["300", "301"], ["301", "700"]]
    scan = growing.next_keys(spark, root, state["order"], 100, 300)
    assert {path.split("block=")[1].split("/")[0] for path in scan.inputFiles()} >= {"2", "3", "4", "5"}
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan and "(block" in plan and ">= 2)" in plan and "<= 5)" in plan
    assert len(files.children(spark, f"{root}/{state['order']['path']}")) >= 14
