import json

import pytest
from pyspark.sql import functions as F

from lexmill.errors import IntegrityError, PublicationError, SchemaError, SourceError
from lexmill.operators import integrity as I
from lexmill.operators import joins as J
from lexmill.plans import card, dataset, labelling
from lexmill.schemas import contract
from lexmill.sources import export, files, shards
from lexmill.streaming import incremental


def filled(spark, table, rows):
    """Rows of a contract from the columns given; other texts are empty, other values null."""
    schema = contract(table)
    for f in schema:
        f.nullable = True
    text = {f.name: "" for f in schema if f.dataType.simpleString() == "string"}
    return spark.createDataFrame([[{**text, **r}.get(n) for n in schema.names] for r in rows], schema)


def write_shard(spark, root, key, *, travel=True, bad_link=False):
    p, q, same = f"{key}:p1", "Q1", {"language": "en", "site": "s", "page_id": 1, "revision_id": 2}
    put = lambda table, folder, rows: filled(spark, table, rows).coalesce(1).write.mode("overwrite").parquet(f"{root}/{folder}/{key}.parquet")
    put("polygons", "polygons", [{"polygon_id": p, "wikidata": q, "name": "Place", "tags": '{"b":"2","a":"1"}', "region": key, "lat": 1.0, "lon": 2.0}])
    put("polygon_documents", "polygon_articles", [{"polygon_id": p, "document_id": "nowhere" if bad_link else f"{key}-d1", "project": "wikipedia", "wikidata": q, **same}, {"polygon_id": p, "document_id": "other", "project": "wikivoyage", "wikidata": q, **same}])
    put("wikipedia_documents", "wikipedia/documents", [{"document_id": f"{key}-d1", "article_id": f"{key}-a1", "wikidata": q, "title": "T", **same}])
    put("sections", "wikipedia/sections", [{"section_id": f"{key}-s1", "document_id": f"{key}-d1", "article_id": f"{key}-a1", "wikidata": q, "section_index": 0, "section_path": '["A"]', "text": "This is the first one. This is the second one.\n\nShared.", **same}])
    if travel:
        put("wikivoyage_documents", "wikivoyage/documents", [{"document_id": f"{key}-v1", "wikidata": q, "title": "V", **same}])
        put("sections", "wikivoyage/sections", [{"section_id": f"{key}-t1", "document_id": f"{key}-v1", "wikidata": q, "section_index": 0, "section_path": "[]", "text": "Shared.", **same}])


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shards"))
    write_shard(spark, path, "north")
    write_shard(spark, path, "south", travel=False)
    return path


def test_discovery(spark, root, tmp_path):
    assert list(shards.discover(spark, root)) == ["north", "south"]
    assert shards.discover(spark, str(tmp_path)) == {}
    write_shard(spark, str(tmp_path), "x")
    files.remove(spark, f"{tmp_path}/wikivoyage/sections/x.parquet")
    with pytest.raises(SourceError, match="pair"):
        shards.discover(spark, str(tmp_path))
    files.remove(spark, f"{tmp_path}/polygons/x.parquet")
    with pytest.raises(SourceError, match="polygons"):
        shards.discover(spark, str(tmp_path))


def test_loading(spark, root):
    found = shards.discover(spark, root)
    df = shards.load(spark, [found["north"]["polygons"]], "polygons", ["polygon_id"])
    assert df.columns == ["polygon_id", "shard_key"] and df.first()["shard_key"] == "north"
    with pytest.raises(SchemaError, match="missing"):
        shards.load(spark, [found["north"]["polygons"]], "links")
    with pytest.raises(SchemaError, match="nothing"):
        shards.load(spark, [found["north"]["polygons"]], "polygons", ["nothing"])


def test_build_and_publish(spark, root, tmp_path):
    built = dataset.build(spark, root, revision="r", version="1")
    rows = {(r["region"], r["sentence_text_normalized"]): r for r in built.rows.collect()}
    # Both shards share an identifier, so the north's travel document is an occurrence in the south too.
    assert {t for _, t in rows} == {"This is the first one.", "This is the second one.", "Shared."}
    shared = rows["north", "Shared."]
    assert (shared["source"], shared["duplicate_sources"], shared["previous_sentence"]) == ("wikipedia", ["wikipedia", "wikivoyage"], "This is the second one.")
    assert [tuple(t) for t in shared["osm_tags"]] == [("a", "1"), ("b", "2")] and shared["section_path"] == ["A"]
    assert built.segmentation["wikipedia"]["dropped_raw"] == 2
    again = dataset.build(spark, root, revision="r", version="1", resume=(str(tmp_path / "run"), {"run": 1}, 2))
    assert sorted(r["sentence_id"] for r in again.rows.collect()) == sorted(r["sentence_id"] for r in rows.values()) and again.segmentation == built.segmentation
    target = str(tmp_path / "out")
    said = dataset.publish(built, target)
    assert said["row_count"] == 6 and said["profile"]["residual_boundaries"] == 0 and said["profile"]["example"]["sentence_id"]
    with pytest.raises(FileExistsError):
        dataset.publish(built, target)
    dataset.publish(built, target, overwrite=True)
    dataset.validate(spark, target, boundaries=True)
    said["statistics"]["polygons"] = 7
    files.write_text(spark, f"{target}/manifest.json", json.dumps(said))
    with pytest.raises(PublicationError, match="page"):
        dataset.validate(spark, target)
    files.write_text(spark, f"{target}/README.md", card.card(said))
    with pytest.raises(PublicationError, match="polygons"):
        dataset.validate(spark, target)


def change(value):
    """Another value of the same kind."""
    if isinstance(value, bool) or value is None:
        return "x"
    if isinstance(value, (int, float)):
        return value + 1
    if isinstance(value, str):
        return value + "x"
    if isinstance(value, list):
        return value[1:] if value else ["x"]
    return {**value, "more": 1}


def test_every_field_of_the_manifest_is_recomputed(spark, root, tmp_path):
    target = str(tmp_path / "out")
    said = dataset.publish(dataset.build(spark, root, revision="r", version="1"), target)
    fields = [(k,) for k in said] + [(k, f) for k in ("statistics", "profile", "finalization") for f in said[k]] + [("segmentation", "wikipedia", f) for f in ("emitted", "retained", "dropped_raw")]
    for path in fields:
        tampered = json.loads(json.dumps(said))
        place = tampered
        for step in path[:-1]:
            place = place[step]
        place[path[-1]] = change(place[path[-1]])
        files.write_text(spark, f"{target}/manifest.json", json.dumps(tampered))
        try:
            files.write_text(spark, f"{target}/README.md", card.card(tampered))
        except (AttributeError, KeyError, TypeError):
            pass  # a page can't be made of it; the old one differs then, if it shows the field
        with pytest.raises((PublicationError, AttributeError, TypeError)):
            dataset.validate(spark, target)
    for missing in said:
        files.write_text(spark, f"{target}/manifest.json", json.dumps({k: v for k, v in said.items() if k != missing}))
        with pytest.raises(PublicationError, match=missing):
            dataset.validate(spark, target)
    # Rows out of order, with all else as it was.
    files.write_text(spark, f"{target}/manifest.json", export.canonical_json(said))
    files.write_text(spark, f"{target}/README.md", card.card(said))
    dataset.validate(spark, target)
    rows = spark.read.parquet(f"{target}/data")
    held, schema = rows.orderBy(F.desc("sentence_id")).collect(), rows.schema
    files.remove(spark, f"{target}/data")
    spark.createDataFrame(held, schema).coalesce(1).write.parquet(f"{target}/data")
    with pytest.raises(PublicationError, match="order"):
        dataset.validate(spark, target)


def test_counters_are_taken_while_rows_are_written(spark, root, tmp_path):
    found = shards.discover(spark, root)
    table = {name: shards.load_all(spark, found, name) for name in shards.FOLDERS}
    rows, counters = J.counted_occurrences(*(table[n] for n in ("polygons", "links", "wikipedia_documents", "wikipedia_sections")), (table["wikivoyage_documents"], table["wikivoyage_sections"]))
    rows.write.parquet(str(tmp_path / "rows"))
    counts = counters.counts()
    assert list(counts) == list(J.COUNTERS)
    written = spark.read.parquet(str(tmp_path / "rows"))
    assert counts["total_occurrence_count"] == written.count() == counts["wikipedia_occurrence_count"] + counts["wikivoyage_occurrence_count"]
    for name, counter in zip(("polygons", "links", "wikipedia_documents", "wikipedia_sections", "wikivoyage_documents", "wikivoyage_sections"), [c for c in J.COUNTERS if "occurrence" not in c], strict=True):
        assert counts[counter] == table[name].count()
    rows, counters = J.counted_occurrences(*(table[n] for n in ("polygons", "links", "wikipedia_documents", "wikipedia_sections")))
    rows.write.parquet(str(tmp_path / "core"))
    assert counters.counts()["wikivoyage_section_count"] == 0 and counters.counts()["total_occurrence_count"] == 2


def test_a_polygon_outside_its_shards_namespace(spark, root, tmp_path):
    write_shard(spark, str(tmp_path), "north")
    files.rename(spark, f"{tmp_path}/polygons/north.parquet", f"{tmp_path}/polygons/east.parquet")
    for folder in ("polygon_articles", "wikipedia/documents", "wikipedia/sections", "wikivoyage/documents", "wikivoyage/sections"):
        files.rename(spark, f"{tmp_path}/{folder}/north.parquet", f"{tmp_path}/{folder}/east.parquet")
    with pytest.raises(IntegrityError, match="namespace"):
        dataset.occurrences(spark, str(tmp_path))


def test_a_single_file_is_replaced_in_one_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "one.parquet")
    export.write_file(spark.range(3).toDF("k"), path)
    with pytest.raises(OSError, match="broke off"):
        with monkeypatch.context() as m:
            m.setattr(files, "replace", lambda *a: (_ for _ in ()).throw(OSError("broke off")))
            export.write_file(spark.range(5).toDF("k"), path)
    assert spark.read.parquet(path).count() == 3
    export.write_file(spark.range(7).toDF("k"), path)
    assert spark.read.parquet(path).count() == 7 and [n for n, _, _ in files.children(spark, str(tmp_path)) if not n.startswith(".")] == ["one.parquet"]


def test_names_of_any_white_space_are_none(spark):
    from lexmill.operators.analytics import dataset_profile, top_and_other

    rows = spark.createDataFrame([(n, "t", 1, ["a"], 1.0, 1.0) for n in ("x", "\t\n", "\u00a0", " ", None)], "polygon_name string, sentence_text_normalized string, duplicate_occurrence_count long, duplicate_sources array<string>, lat double, lon double")
    assert dataset_profile(rows).first()["named"] == 1
    counts = spark.createDataFrame([(v,) for v in "aaaabbcde"], "v string")
    assert [tuple(r) for r in top_and_other(counts, "v", 2, resort=True).collect()] == [("a", 4), ("Other", 3), ("b", 2)]
    assert [tuple(r) for r in top_and_other(counts.withColumn("n", F.monotonically_increasing_id()), "v", 2, order=["n"]).collect()] == [("a", 4), ("b", 2), ("Other", 3)]


def test_broken_reference(spark, tmp_path):
    write_shard(spark, str(tmp_path), "x", bad_link=True)
    with pytest.raises(IntegrityError, match="no document"):
        dataset.occurrences(spark, str(tmp_path))


def test_scores_and_resume(spark):
    def engine(prompts):
        return [json.dumps({"choices": [{"logprobs": {"content": [{"top_logprobs": [{"token": "yes", "logprob": -0.1 if "field" in p else -3.0}, {"token": " No", "logprob": -1.0}]}]}}]}) for p in prompts]

    rows = spark.createDataFrame([("a", "a field"), ("b", "a king")], "sentence_id string, prompt string")
    out = labelling.scored(rows, "prompt", engine)
    labelling.check_scores(out)
    assert {r["sentence_id"]: r["place_relevance"] for r in out.collect()} == {"a": "yes", "b": "no"}
    assert [r["sentence_id"] for r in labelling.resume(rows, out.where("sentence_id = 'a'")).collect()] == ["b"]


def test_repair(spark):
    def engine(prompts):
        out = []
        for p in prompts:
            evidence = "field" if "good" in p or "Repair attempt 1" in p and "slow" in p else "elsewhere"
            out.append("{}" if "broken" in p else json.dumps({"landuse_relevance": "yes", "polygon_relevance": "no", "landuse_reason": "explicit_land_use", "polygon_reason": "unrelated_fact", "evidence": evidence}))
        return out

    rows = spark.createDataFrame([(k, k, "a field") for k in ("good", "slow", "never", "broken")], "sentence_id string, p string, t string")
    out = {r["sentence_id"]: r for r in labelling.labelled(rows, "p", "t", engine, repairs=2).collect()}
    assert (out["good"]["repairs"], out["slow"]["repairs"], out["never"]["repairs"]) == (0, 1, 2)
    assert (out["good"]["evidence"], out["never"]["evidence"], out["never"]["failure"]) == ("field", "", None)
    assert out["broken"]["failure"] and out["broken"]["landuse_relevance"] is None


def test_incremental(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    one.write.parquet(source)
    run = lambda: incremental.run_available(spark, source, one.schema, target, str(tmp_path / "state"), lambda df: df.withColumn("w", F.upper("v")))
    run()
    run()
    spark.createDataFrame([(2, "b")], "k int, v string").write.mode("append").parquet(source)
    run()
    assert sorted((r["k"], r["w"]) for r in incremental.read_batches(spark, target).collect()) == [(1, "A"), (2, "B")]


def test_changed_shards(spark, root):
    now = shards.inventory(spark, shards.discover(spark, root))
    assert {r["status"] for r in incremental.changed_shards(None, now).collect()} == {"added"}
    assert {r["status"] for r in incremental.changed_shards(now, now).collect()} == {"unchanged"}
    before = now.withColumn("state", F.when(F.col("shard_key") == "north", "old").otherwise(F.col("state")))
    assert {r["shard_key"]: r["status"] for r in incremental.changed_shards(before, now).collect()} == {"north": "changed", "south": "unchanged"}


def test_card_rules(spark):
    assert card.scope([None, " ", "new_south-wales-latest"]) == "New South Wales"
    assert (card.scope([]), card.scope(["a", "b"])) == ("Dataset", "Global")
    assert card.scope_of(spark.createDataFrame([("a",), (" a ",), (None,)], "region string")) == "A"
    assert card.cell("a|b\\\n&") == "a&#124;b&#92;&#10;&amp;"
    assert card.tree_url("https://x", "o/r", "a/b#") == "https://x/datasets/o/r/tree/a%2Fb%23"
    assert card.padded(0.0, 100.0) == (-5.0, 105.0) and card.padded(1.0, 1.0) == (0.9, 1.1)
    assert card.check_target(None, 5) is False and card.check_target(5, 6) is True
    with pytest.raises(PublicationError):
        card.check_target(6, 5)
    rows = spark.createDataFrame([(0, "a", 1), (1, "a", 2), (2, "a", 2), (3, "b", 0)], "n int, k string, v int")
    assert [r["n"] for r in card.out_of_order(rows, "k", "v", order="n").collect()] == [2]


def test_review_sample(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i}", f"t{i}") for i in range(9)], "sentence_id string, t string")
    scores = spark.createDataFrame([(f"s{i}", float(i)) for i in range(9)], "sentence_id string, score double")
    export.write_sample(rows, scores, str(tmp_path / "sample"), limit=3)
    assert [(r["sentence_id"], r["score"]) for r in spark.read.json(str(tmp_path / "sample")).collect()] == [("s0", 0.0), ("s1", 1.0), ("s2", 2.0)]
    with pytest.raises(IntegrityError, match="no score"):
        export.write_sample(rows, scores.where("score > 5"), str(tmp_path / "other"))


def test_labels_are_the_rows(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "sentence_id string")
    with pytest.raises(IntegrityError, match="no label"):
        I.assert_all(J.label_checks(rows, rows.where("sentence_id = 'a'")))
    I.assert_all(J.label_checks(rows, rows))
    named = spark.createDataFrame([("north:1", "north"), ("south:2", "north")], "polygon_id string, shard_key string")
    assert [r[0] for r in I.outside_namespace(named, "polygon_id", "shard_key").collect()] == ["south:2"]


def test_only_given_shards_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.write_shards(spark.createDataFrame([(1, "a"), (2, "b")], "v int, shard_key string"), path)
    incremental.write_shards(spark.createDataFrame([(3, "b")], "v int, shard_key string"), path)
    assert sorted((r["v"], r["shard_key"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]
