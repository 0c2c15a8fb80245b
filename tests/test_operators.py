import heapq
import hashlib

import pytest
from pyspark.sql import functions as F

from lexmill.errors import IntegrityError
from lexmill.operators import analytics as A
from lexmill.operators import integrity as I
from lexmill.operators import joins as J
from lexmill.operators import sampling as S
from lexmill.operators import sentences as N


def sha(seed, value):
    return hashlib.sha256(f"{seed}\0{value}".encode()).hexdigest()


def test_integrity(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, -1)], "k string, i int")
    checks = {"empty": I.empty_keys(rows, "k"), "repeats": I.duplicate_keys(rows, "k"), "index": I.bad_indexes(rows, "i"), "orphan": I.orphans(rows, "k", rows.where("k = ''"), "k")}
    found = {r["check"]: (r["n"], r["samples"]) for r in I.summary(checks).collect()}
    assert found == {"empty": (2, ["", "(null)"]), "repeats": (1, ["a"]), "index": (1, ["-1"]), "orphan": (1, ["a"])}
    with pytest.raises(IntegrityError, match="empty"):
        I.assert_all(checks)
    I.assert_all({"fine": I.empty_keys(rows.where("k = 'a'"), "k")})


@pytest.mark.parametrize("parts", [1, 7, 32])
def test_schedule_equals_serving_the_least_served(spark, parts):
    sizes = {"a": 7, "b": 3, "c": 1, "d": 12}
    heap, wanted = [(0.0, sha("s", k), k, 0) for k in sizes], []
    heapq.heapify(heap)
    while heap and len(wanted) < 15:
        _, rank, k, n = heapq.heappop(heap)
        wanted.append((k, n))
        if n + 1 < sizes[k]:
            heapq.heappush(heap, ((n + 1) / sizes[k], rank, k, n + 1))
    df = spark.createDataFrame(list(sizes.items()), "stratum string, size long").repartition(parts)
    assert [(r["stratum"], r["served"]) for r in S.weighted_schedule(df, seed="s", limit=15).orderBy("position").collect()] == wanted


def test_samples_are_nested_and_do_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([(f"s{i}", f"p{i % 13}", f"c{i % 13 % 4}" if i % 9 else None, "large" if i % 13 == 0 else "small") for i in range(200)], "sentence_id string, polygon_id string, cell string, area_bucket string")
    rows = rows.where("cell IS NOT NULL")
    small = [r["sentence_id"] for r in S.nested(rows, stratum="cell", target=20, seed="x").orderBy("position").collect()]
    large = [r["sentence_id"] for r in S.nested(rows.repartition(7), stratum="cell", target=60, seed="x").orderBy("position").collect()]
    assert large[:20] == small
    a = {r["sentence_id"] for r in S.stratified(rows, stratum="cell", target=20, seed="x").collect()}
    b = {r["sentence_id"] for r in S.stratified(rows.repartition(5), stratum="cell", target=60, seed="x").collect()}
    assert len(a) == 20 and a < b
    with pytest.raises(IntegrityError):
        S.nested(rows.union(rows), stratum="cell", target=1, seed="x")


def test_covering_canary(spark):
    rows = spark.createDataFrame([(i, f"s{i % 3}", f"l{i % 5}") for i in range(60)], "doc_id long, source string, language string")
    out = S.covering_canary(rows, 8, key="doc_id").collect()
    assert len(out) == 8 and {r["source"] for r in out} == {"s0", "s1", "s2"} and len({r["language"] for r in out}) == 5


def test_context_then_dedup(spark):
    cells = [("p", "wikivoyage", "en", "d2", "s", 0, "x"), ("p", "wikipedia", "en", "d1", "s", 0, "a"), ("p", "wikipedia", "en", "d1", "s", 1, "x"), ("p", "wikipedia", "en", "d1", "s", 2, "b"), ("p", "wikipedia", "de", "d1", "t", 0, "x")]
    rows = spark.createDataFrame(cells, "polygon_id string, source string, language string, document_id string, section_id string, sentence_index int, sentence_text_normalized string").withColumn("section_index", F.lit(0))
    for n in (1, 6):
        out = {(r["language"], r["sentence_text_normalized"]): r for r in N.deduplicate(N.add_context(rows.repartition(n))).collect()}
        x = out["en", "x"]
        assert (x["source"], x["previous_sentence"], x["next_sentence"], x["duplicate_occurrence_count"], x["duplicate_sources"]) == ("wikipedia", "a", "b", 2, ["wikipedia", "wikivoyage"])
        assert len(out) == 4
    assert N.finalization_report(N.deduplicate(rows)).first().asDict() == {"input_rows": 5, "output_rows": 4, "removed_rows": 1, "cross_source_groups": 1}


def test_analytics(spark):
    rows = spark.createDataFrame([("p1", "en", "yes", "yes"), ("p1", None, "yes", "no"), (None, "fr", "uncertain", "yes"), (" ", "fr", "no", "no")], "polygon_id string, language string, a string, b string")
    counts = {(r["a"], r["b"]): (r["n"], r["share"]) for r in A.joint_label_counts(rows, "a", "b").collect()}
    assert len(counts) == 9 and counts["yes", "yes"] == (1, 0.25) and counts["no", "yes"] == (0, 0.0)
    assert list(A.coverage_funnel(rows, "polygon_id", "a", "b").first()) == [1, 1, 1, 1]
    out = A.slice_yields(rows, "a", "b", ("language",), 2).collect()
    assert [(r["value"], r["sample_size"], r["both_yes_rate"], r["uncertain_rate"]) for r in out] == [("fr", 2, 0.0, 0.5)]
    top = A.top_and_other(spark.createDataFrame([(c,) for c in "aaabbcd"], "x string"), "x", 2).collect()
    assert [(r["value"], r["n"]) for r in top] == [("a", 3), ("b", 2), ("Other", 2)]
    assert A.top_and_other(spark.createDataFrame([("a",)], "x string"), "x", 2).count() == 1


def test_inventory(spark):
    a = spark.createDataFrame([("a", 1), ("b", 1), ("c", None)], "k string, v int")
    b = spark.createDataFrame([("b", 2), ("c", None), ("d", 1)], "k string, v int")
    assert {r["k"]: r["status"] for r in J.inventory_diff(a, b, "k", "v").collect()} == {"a": "removed", "b": "changed", "c": "unchanged", "d": "added"}
