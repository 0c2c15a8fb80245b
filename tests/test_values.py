import hashlib
import json

from pyspark.sql import functions as F

from lexmill.functions import values as V


def one(spark, column, **values):
    columns = [F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)]
    return spark.range(1).select(*columns).select(column.alias("x")).first()["x"]


def test_hashes(spark):
    h = hashlib.sha256("é\n".encode()).hexdigest()
    assert one(spark, V.content_hash(F.lit("é\n"))) == h
    body = json.dumps({"language": "fr", "polygon_id": 'a"b', "sentence_content_hash": h, "version": 1}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert one(spark, V.sentence_id(F.lit('a"b'), F.lit("fr"), F.lit(h))) == hashlib.sha256(body.encode()).hexdigest()
    assert one(spark, V.seeded_rank("s", F.lit("x"))) == hashlib.sha256(b"s\0x").hexdigest()


def test_strict_json(spark):
    rows = spark.createDataFrame([('["a"]',), ('[1,"a"]',), ("['a']",), ('["a"] x',), ("null",), (None,), ("[]",)], "t string")
    assert [r[0] for r in rows.select(V.string_list(F.col("t"))).collect()] == [["a"], None, None, None, None, None, []]
    rows = spark.createDataFrame([('{"b":"2","a":"1"}',), ('{"a":1}',), ("[]",), ("{}",)], "t string")
    assert [r[0] for r in rows.select(V.sorted_tags(V.string_map(F.col("t")))).collect()] == [[("a", "1"), ("b", "2")], None, None, []]


def test_identifier_sets(spark):
    rows = spark.createDataFrame([("Q1", "Q1"), ("Q1; Q2", "Q2"), ("Q2", " Q1;Q2 "), ("Q1;Q3", "Q1;Q2"), ("", "Q1"), (None, None)], "a string, b string")
    assert [r[0] for r in rows.select(V.qids_match(F.col("a"), F.col("b"))).collect()] == [True, True, True, False, False, False]


def test_area_buckets(spark):
    cases = [(0.00005, "<100m2", "tiny"), (0.05, "10k_m2-100k_m2", "tiny"), (0.1, "0.1-1km2", "small"), (1.0, "1-10km2", "medium"), (10.0, "10-100km2", "large"), (500.0, ">100km2", "large"), (0.1, "tiny", None), (-1.0, "tiny", None), (float("nan"), "tiny", None), (1.0, "huge", None)]
    rows = spark.createDataFrame([(a, b) for a, b, _ in cases], "a double, b string")
    assert [r[0] for r in rows.select(V.area_bucket(F.col("a"), F.col("b"))).collect()] == [c for *_, c in cases]


def test_probability_never_overflows(spark):
    assert one(spark, V.two_class_probability(F.lit(-1e4), F.lit(0.0))) == 0.0
    assert one(spark, V.two_class_probability(F.lit(0.0), F.lit(-1e4))) == 1.0
    assert one(spark, V.two_class_probability(F.lit(-1.0), F.lit(-1.0))) == 0.5


def test_label_failures(spark):
    good = {"landuse_relevance": "yes", "polygon_relevance": "no", "landuse_reason": "explicit_land_use", "polygon_reason": "unrelated_fact", "evidence": "a field"}
    cases = [(good, None), ({**good, "evidence": "elsewhere"}, "evidence is not"), ({**good, "evidence": "x" * 241}, "evidence exceeds"), ({**good, "landuse_reason": "no_landuse_or_cover"}, "reason is"), ({**good, "landuse_reason": "made_up"}, "response violates"), ({**good, "evidence": 3}, "response violates"), ({**good, "x": "y"}, "response violates"), ([], "response violates")]
    rows = spark.createDataFrame([(json.dumps(r),) for r, _ in cases] + [("no json",)], "r string")
    found = [r[0] for r in rows.select(V.label_failure(F.col("r"), F.lit("there is a field"))).collect()]
    for value, wanted in zip(found, [w for _, w in cases] + ["response violates"], strict=True):
        assert (value is None) == (wanted is None) and (value or "").startswith(wanted or "")


def test_geometry(spark):
    rows = spark.createDataFrame([('{"type":"Polygon","coordinates":[]}',), ('{"type":"Point","coordinates":[0,0]}',), ("x",), ("",), (None,)], "g string")
    assert [r[0] for r in rows.select(V.is_area(F.col("g"))).collect()] == [True, False, False, False, False]


def test_sentence_prompt(spark):
    tags = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in (("b", "2"), ("a", 'x"'))])
    fields = dict.fromkeys(("polygon_name", "region", "osm_primary_tag", "language", "page_title", "section", "previous", "target", "next"), F.lit(None).cast("string"))
    out = one(spark, V.sentence_prompt(tags, **{**fields, "target": F.lit("A field."), "region": F.lit("north")}))
    assert '[{"key":"a","value":"x\\""},{"key":"b","value":"2"}]' in out
    assert out.startswith("Target polygon:\n- Name: unknown\n- Country/region: north\n- OSM primary tag: none\n")
    assert out.endswith("<target>A field.</target>\n\nNext sentence:\n<next></next>") and "- Section title: none" in out
