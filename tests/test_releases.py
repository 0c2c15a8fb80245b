import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lexmill.errors import CheckpointError, IntegrityError, PublicationError, SchemaError
from lexmill.functions import values as V
from lexmill.operators import analytics as A
from lexmill.operators import geometry as G
from lexmill.operators import joins as J
from lexmill.operators import sampling as S
from lexmill.plans import card, growing, labelling, releases
from lexmill.sources import export, files
from lexmill.streaming import batches as B

RUN = {"model": "m", "revision": "r1"}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"s{k:02d}", f"p{k % 4}", ["north", "south"][k % 2], "en", f"Sentence number {k} stands here.", float(k), 1.0) for k in range(20)]
    return spark.createDataFrame(data, "sentence_id string, polygon_id string, region string, language string, sentence_text_raw string, lat double, lon double")


def two_labels(rows, **other):
    fields = {"landuse_relevance": "yes", "polygon_relevance": "no", "landuse_reason": "explicit_land_use", "polygon_reason": "unrelated_fact", "evidence": "stands", **other}
    return rows.select("sentence_id", *[F.lit(v).alias(k) for k, v in fields.items()])


def scores(rows):
    yes, no = F.col("yes_logprob"), F.col("no_logprob")
    base = rows.select("sentence_id", (-F.rand(1)).alias("yes_logprob"), F.lit(-0.5).alias("no_logprob"))
    return base.select("sentence_id", F.when(yes > no, "yes").otherwise("no").alias("place_relevance"), yes, no, V.logit_margin(yes, no).alias("logit_margin"), V.two_class_probability(yes, no).alias("two_class_probability"))


def outlines(spark, count=4):
    return spark.createDataFrame([(f"p{k}", f'{{"type":"Polygon","coordinates":[{k}]}}', "x") for k in range(count)], "polygon_id string, geometry string, more string")


def test_batches(spark, rows, tmp_path):
    root, worked = str(tmp_path / "b"), []

    def work(part):
        worked.append(part.count())
        if len(worked) == 3:
            raise RuntimeError("broke off")
        return part.select("sentence_id", F.upper("language").alias("label"))

    with pytest.raises(RuntimeError):
        B.run_batches(rows, root, RUN, work, batches=4)
    assert B.read_batches(spark, root, RUN).count() == sum(worked[:2])
    told = []
    out = B.run_batches(rows, root, RUN, work, batches=4, progress=told.append)
    assert out.count() == 20 and sum(worked) - worked[2] == 20 and told[-1]["remaining"] == 0
    assert B.run_batches(rows, root, RUN, work, batches=4).count() == 20 and len(worked) == 5
    with pytest.raises(CheckpointError, match="another run"):
        B.read_batches(spark, root, {"model": "other"})
    with pytest.raises(CheckpointError, match="is there"):
        B.write_batch(out, root, 0, RUN)
    B.write_batch(out.limit(1), root, 9, RUN)
    with pytest.raises(CheckpointError, match="share keys"):
        B.read_batches(spark, root, RUN)
    with pytest.raises(CheckpointError, match="empty"):
        B.write_batch(out.limit(0), str(tmp_path / "e"), 0, RUN)
    with pytest.raises(IntegrityError, match="repeats"):
        B.write_batch(out.union(out), str(tmp_path / "d"), 0, RUN)
    changed = str(tmp_path / "c")
    B.write_batch(out, changed, 0, RUN)
    out.withColumn("label", F.lit("x")).write.mode("overwrite").parquet(f"{changed}/batch=000000/data")
    with pytest.raises(CheckpointError, match="differs"):
        B.read_batches(spark, changed, RUN)
    files.write_text(spark, f"{changed}/note", "x")
    with pytest.raises(CheckpointError, match="holds note"):
        B.read_batches(spark, changed, RUN)
    assert B.read_batches(spark, str(tmp_path / "none"), RUN) is None
    assert B.run_batches(rows.limit(0), str(tmp_path / "n"), RUN, work, batches=2).count() == 0


def test_timing():
    B.check_timing({"initial_inference_seconds": 1.0, "repair_inference_seconds": 0.5, "inference_seconds": 1.5})
    for wrong in ({}, {"initial_inference_seconds": 1.0, "repair_inference_seconds": 0.5, "inference_seconds": 1.6}, {"initial_inference_seconds": -1, "repair_inference_seconds": 1, "inference_seconds": 0}):
        with pytest.raises(CheckpointError):
            B.check_timing(wrong)


def test_a_release_of_two_labels(spark, rows, tmp_path):
    target = str(tmp_path / "r")
    said = releases.finalize(rows, two_labels(rows), target, kind="two_labels", name="places", identity=RUN, regions=(2, 9))
    assert said["statistics"]["row_count"] == 20 and said["statistics"]["positive_languages"] == [{"language": "en", "n": 20}]
    assert releases.validate(spark, target)["content_sha256"] == said["content_sha256"]
    with pytest.raises(FileExistsError):
        releases.finalize(rows, two_labels(rows), target, kind="two_labels", name="places", identity=RUN)
    with pytest.raises(PublicationError, match="another run"):
        releases.finalize(rows, two_labels(rows), target, kind="two_labels", name="places", identity={"model": "n"}, overwrite=True)
    fewer = rows.limit(5)
    with pytest.raises(PublicationError, match="larger"):
        releases.finalize(fewer, two_labels(fewer), target, kind="two_labels", name="places", identity=RUN, overwrite=True)
    with pytest.raises(PublicationError, match="regions"):
        releases.finalize(rows, two_labels(rows), str(tmp_path / "x"), kind="two_labels", name="places", identity=RUN, regions=(1, 1))
    with pytest.raises(IntegrityError, match="no label"):
        releases.finalize(rows, two_labels(fewer), str(tmp_path / "x"), kind="two_labels", name="places", identity=RUN)
    for wrong in ({"landuse_reason": "no_landuse_or_cover"}, {"evidence": "is not there"}, {"polygon_relevance": "maybe"}, {"evidence": None}):
        with pytest.raises(IntegrityError, match="contract"):
            releases.finalize(rows, two_labels(rows, **wrong), str(tmp_path / "x"), kind="two_labels", name="places", identity=RUN)
    with pytest.raises(ValueError, match="name"):
        releases.finalize(rows, two_labels(rows), str(tmp_path / "x"), kind="two_labels", name=" places", identity=RUN)
    files.write_text(spark, f"{target}/README.md", "other")
    with pytest.raises(PublicationError, match="page"):
        releases.validate(spark, target)
    spark.read.parquet(f"{target}/data").where("sentence_id > 's00'").write.parquet(f"{target}/more")
    with pytest.raises(PublicationError, match="holds"):
        releases.validate(spark, target)
    files.remove(spark, f"{target}/data")
    files.rename(spark, f"{target}/more", f"{target}/data")
    with pytest.raises(PublicationError, match="statistics differ"):
        releases.validate(spark, target)


def test_a_release_of_scores(spark, rows, tmp_path):
    made = scores(rows).cache()
    target = str(tmp_path / "r")
    said = releases.finalize(rows, made, target, kind="place", name="world", identity=RUN, polygons=outlines(spark))
    assert said["geometry"] == "GeoJSON" and said["statistics"]["coordinates"] == [{"with_coordinates": 20, "without_coordinates": 0}]
    assert releases.validate(spark, target)["statistics"]["totals"][0]["row_count"] == 20
    off = made.withColumn("logit_margin", F.col("logit_margin") + 1e-9)
    with pytest.raises(IntegrityError, match="log-probabilities"):
        releases.finalize(rows, off, str(tmp_path / "x"), kind="place", name="world", identity=RUN)
    with pytest.raises(PublicationError, match="20 scores"):
        labelling.check_scores(off)
    with pytest.raises(IntegrityError, match="polygon"):
        releases.finalize(rows, made, str(tmp_path / "x"), kind="place", name="world", identity=RUN, polygons=outlines(spark, 3))


def test_geometry(spark, rows, tmp_path):
    once = G.add_geometry(rows, outlines(spark))
    assert once.columns == [*[c for c in once.columns if c != "geometry"], "geometry"] and once.where("geometry IS NULL").count() == 0
    assert sorted(G.add_geometry(once, outlines(spark)).select(*once.columns).collect()) == sorted(once.collect())
    with pytest.raises(IntegrityError, match="differs"):
        G.add_geometry(once.withColumn("geometry", F.lit("{}")), outlines(spark))
    with pytest.raises(IntegrityError, match="outline"):
        G.add_geometry(rows, outlines(spark).withColumn("geometry", F.lit('{"type":"Point","coordinates":[1]}')))
    path = str(tmp_path / "g.parquet")
    G.write_geometry(once.coalesce(1), path, group=7)
    (part,) = files.leaves(spark, path)
    footer = pq.ParquetFile(part).metadata
    assert [footer.row_group(k).num_rows for k in range(footer.num_row_groups)] == [7] * (footer.num_rows // 7) + [footer.num_rows % 7] * (footer.num_rows % 7 > 0)
    assert G.read_geometry(spark, path).columns == ["polygon_id", "geometry"] and G.read_geometry(spark, path).count() == 20
    with pytest.raises(Exception, match="exists"):
        G.write_geometry(once, path)


def test_a_sample_grows(spark, tmp_path):
    draw = random.Random(1)
    data = [(f"s{k}", f"p{k % 9}", draw.choice(["large", "small"]) if k % 9 < 5 else "small", f"c{k % 3}") for k in range(200)]
    data = [(s, p, "large" if p in ("p1", "p2") else "small", c) for s, p, _, c in data]
    rows = spark.createDataFrame(data, "sentence_id string, polygon_id string, area_bucket string, cell string")
    root, options = str(tmp_path / "g"), {"seed": "x", "shards": {"a": "1"}, "stratum": "cell"}
    small = {r["sentence_id"]: r["position"] for r in growing.grow(rows, root, target=30, **options).collect()}
    large = {r["sentence_id"]: r["position"] for r in growing.grow(rows, root, target=80, **options).collect()}
    assert len(small) == 30 and len(large) == 80 and small.items() <= large.items()
    assert large == {r["sentence_id"]: r["position"] for r in S.nested(rows, stratum="cell", target=80, seed="x").collect()}
    with pytest.raises(PublicationError, match="shrink"):
        growing.grow(rows, root, target=79, **options)
    with pytest.raises(CheckpointError, match="seed"):
        growing.grow(rows, root, target=80, **(options | {"seed": "y"}))
    with pytest.raises(CheckpointError, match="shards"):
        growing.grow(rows, root, target=80, **(options | {"shards": {"a": "2"}}))


def test_canaries_and_dispatch(spark):
    data = [(k, f"k{k * 7 % 50:02d}", ["b", "a", None][k % 3], ["en", "fr", "de", None][k // 3 % 4], "one") for k in range(50)]
    rows = spark.createDataFrame(data, "place int, sentence_id string, source string, language string, region string")
    first = S.covering_canary(rows, 6, order=["place"], region="region").collect()
    assert [r["place"] for r in first] == sorted(r["place"] for r in first) and len(first) == 6
    assert {r["source"] for r in first} == {"a", "b", None} and {r["language"] for r in first} == {"en", "fr", "de", None}
    # By source name: None first in a language not yet seen, and so on; first rows by place.
    assert {0, 1, 3} & {r["place"] for r in first}
    with pytest.raises(IntegrityError, match="more than one"):
        S.covering_canary(rows, 6, region="source")
    assert [r["place"] for r in S.canary(rows, 10, order=["place"]).collect()] == sorted(r["place"] for r in S.canary(rows, 10).collect())
    assert S.canary(rows, 0).count() == 50 and S.select_rows(rows).count() == 50
    with pytest.raises(ValueError, match="negative"):
        S.canary(rows, -1)
    assert S.select_rows(rows, row_limit=6, order=["place"]).collect() == first
    sample = S.select_rows(rows, target=12, stratum="language", order=["place"]).collect()
    assert [r["place"] for r in sample] == sorted(r["place"] for r in sample) and len(sample) == 12


def test_label_batches_ask_only_for_what_is_missing(spark, rows, tmp_path):
    asked = rows.select("sentence_id", F.col("sentence_text_raw").alias("prompt"), F.col("sentence_text_raw").alias("target"))
    answer = '{"landuse_relevance":"yes","polygon_relevance":"no","landuse_reason":"explicit_land_use","polygon_reason":"unrelated_fact","evidence":"stands"}'
    root = str(tmp_path / "l")
    out = labelling.label_batches(asked, "prompt", "target", lambda p: [answer] * len(p), root, RUN, batches=2)
    assert out.count() == 20 and out.where("failure IS NOT NULL").count() == 0

    def never(prompts):
        raise RuntimeError("asked again")

    assert labelling.label_batches(asked, "prompt", "target", never, root, RUN, batches=2).count() == 20
    rows.write.parquet(str(tmp_path / "in"))
    with pytest.raises(SchemaError, match="area_bucket"):
        labelling.load_input(spark, str(tmp_path / "in"), "place_input")


def test_small_operators(spark, tmp_path):
    df = spark.createDataFrame([(1, {"b": "2", "a": "1"})], "k int, tags map<string,string>")
    listed = export.without_maps(df)
    assert [tuple(t) for t in listed.first()["tags"]] == [("a", "1"), ("b", "2")] and listed.columns == df.columns
    with pytest.raises(SchemaError, match="tags"):
        V.tag_pairs(F.col("k"), df.schema["k"].dataType)
    assert J.with_columns_or_null(df, k="string", more="double").dtypes[-1] == ("more", "double")
    export.write_file(df.select("k"), str(tmp_path / "one.parquet"))
    export.write_file(df.select("k"), str(tmp_path / "one.parquet"))
    assert (tmp_path / "one.parquet").is_file() and spark.read.parquet(str(tmp_path / "one.parquet")).count() == 1
    ties = spark.createDataFrame([(k, v) for k, v in enumerate("bbaacd")], "at int, v string")
    assert [tuple(r) for r in A.top_and_other(ties, "v", 2, order=["at"]).collect()] == [("b", 2), ("a", 2), ("Other", 2)]
    assert card.yaml_text('a "b"\\\n\x07é') == '"a \\"b\\"\\\\\\n\\U00000007é"'
    places = spark.createDataFrame([(k, v) for k, v in enumerate([1, 2, 2, 5, 4, 6, 7, 7])], "at long, v int")
    for size in (100, 2, 1):
        assert sorted(r["at"] for r in card.out_of_order(places, "v", order="at", slice_rows=size).collect()) == [2, 4, 7]
    one = spark.createDataFrame([("\t",), ("　x\x1c",), (None,), (" ok",)], "t string")
    assert [r[0] for r in one.select(V.or_missing(F.col("t"))).collect()] == ["(missing)", "x", "(missing)", "ok"]
    assert [r[0] for r in spark.createDataFrame([("a" * 64,), ("a" * 64 + "\n",), (None,)], "t string").select(V.has_form(F.col("t"), "sha256")).collect()] == [True, False, False]


def test_checks_of_batches_deal_keys_to_as_many_tasks_as_they_need(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "KEYS", 100)
    rows = spark.range(950).selectExpr("id AS sentence_id", "id * 2 AS v")
    assert B._one_sided(rows, rows.limit(0), "sentence_id", 950)._jdf.queryExecution().toString().count("hashpartitioning(offender") and B._dealt(rows, "sentence_id", 950).rdd.getNumPartitions() == 10
    out = B.run_batches(rows, str(tmp_path / "b"), {"run": 1}, lambda part: part, batches=2)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(IntegrityError, match="no result"):
        B.run_batches(rows, str(tmp_path / "c"), {"run": 1}, lambda part: part.where("sentence_id <> 7"), batches=2)
    with pytest.raises(IntegrityError, match="repeats"):
        B.run_batches(rows, str(tmp_path / "d"), {"run": 1}, lambda part: part.union(part.where("sentence_id = 7")), batches=2)
