import os
import shutil

import pytest
from pyspark.sql import functions as F

from lexmill.errors import IntegrityError, SchemaError
from lexmill.operators import joins as J
from lexmill.plans import dataset
from lexmill.schemas import contract
from lexmill.sources import files, shards

from test_plans import filled, write_shard


def rewrite(spark, path, change):
    df = change(spark.read.parquet(path))
    rows, schema = df.collect(), df.schema
    files.remove(spark, path)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


def link_by_article(spark, root, key):
    same = {"language": "en", "page_id": 1, "revision_id": 2}
    files.remove(spark, f"{root}/polygon_articles/{key}.parquet")
    filled(spark, "polygon_articles", [{"polygon_id": f"{key}:p1", "article_id": f"{key}-a1", "wikidata": "Q1", **same}]).coalesce(1).write.parquet(f"{root}/polygon_articles/{key}.parquet")


@pytest.fixture
def root(spark, tmp_path):
    for key in ("north", "south"):
        write_shard(spark, str(tmp_path), key)
    return str(tmp_path)


def test_a_second_shard_that_lacks_columns_is_found(spark, root):
    path = f"{root}/wikipedia/sections/south.parquet"
    rewrite(spark, path, lambda df: df.drop("text", "wikidata"))
    with pytest.raises(SchemaError, match=r"1 of 2 files .*south.*missing text, wikidata"):
        dataset.occurrences(spark, root)


def test_a_second_shard_of_wrong_types_is_found(spark, root):
    path = f"{root}/polygons/south.parquet"
    rewrite(spark, path, lambda df: df.withColumns({"lat": F.col("lat").cast("string"), "osm_id": F.lit(1)}))
    with pytest.raises(SchemaError, match="lat is string, not double.*|osm_id is int, not bigint"):
        shards.load_all(spark, shards.discover(spark, root), "polygons")


def test_one_part_of_a_folder_is_checked_too(spark, root):
    path = f"{root}/polygons/south.parquet"
    spark.read.parquet(path).drop("lat").coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(SchemaError, match="missing lat"):
        shards.load(spark, [path], "polygons")


def test_more_columns_and_other_orders_are_aligned(spark, root):
    path = f"{root}/polygons/south.parquet"
    rewrite(spark, path, lambda df: df.select(F.lit("x").alias("extra"), *reversed(df.columns)))
    table = shards.load_all(spark, shards.discover(spark, root), "polygons")
    assert table.columns == [*contract("polygons").names, "shard_key"]
    assert {(r["shard_key"], r["polygon_id"], r["lat"]) for r in table.collect()} == {("north", "north:p1", 1.0), ("south", "south:p1", 1.0)}
    assert {len(f.schema) for f in shards.footers(spark, [path, f"{root}/polygons/north.parquet"], "polygons")} == {len(contract("polygons")), len(contract("polygons")) + 1}


def test_both_layouts_of_links_in_one_run(spark, root):
    one = dataset.build(spark, root, revision="r", version="1")
    link_by_article(spark, root, "south")
    found = shards.discover(spark, root)
    layouts = shards.load_links(spark, found)
    assert {name: [r["shard_key"] for r in df.collect()] for name, df in layouts.items()} == {"polygon_articles": ["south"], "polygon_documents": ["north", "north"]}
    with pytest.raises(SchemaError, match="several layouts"):
        shards.load_all(spark, found, "links")
    both = dataset.build(spark, root, revision="r", version="1")
    assert sorted(r["sentence_id"] for r in both.rows.collect()) == sorted(r["sentence_id"] for r in one.rows.collect())


def test_a_link_in_both_layouts_is_an_error(spark, root):
    link_by_article(spark, root, "south")
    same = {"language": "en", "page_id": 1, "revision_id": 2, "wikidata": "Q1", "project": "wikipedia"}
    files.remove(spark, f"{root}/polygon_articles/north.parquet")
    rows = [{"polygon_id": f"{key}:p1", "document_id": f"{key}-d1", **same} for key in ("north", "south")]
    filled(spark, "polygon_documents", rows).coalesce(1).write.parquet(f"{root}/polygon_articles/north.parquet")
    with pytest.raises(IntegrityError, match="both layouts"):
        dataset.occurrences(spark, root)


def test_shards_are_told_by_their_bytes(spark, root):
    before = shards.inventory(spark, shards.discover(spark, root), content=True)
    held = {r["shard_key"]: r["state"] for r in before.collect()}
    assert held.keys() == {"north", "south"}
    source, copy = f"{root}/polygons/south.parquet", f"{root}/copy"
    files.rename(spark, source, copy)
    # The same bytes, written again under other names.
    (part,) = files.leaves(spark, copy)
    os.makedirs(source)
    shutil.copyfile(part, f"{source}/part-other.parquet")
    again = shards.inventory(spark, shards.discover(spark, root), content=True)
    assert {r["shard_key"]: r["state"] for r in again.collect()} == held
    # One byte changed, with the old size and time.
    target, stat = f"{source}/part-other.parquet", os.stat(f"{source}/part-other.parquet")
    data = bytearray(open(target, "rb").read())
    data[len(data) // 2] ^= 1
    open(target, "wb").write(data)
    os.utime(target, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    now = shards.inventory(spark, shards.discover(spark, root), content=True)
    changes = {r["shard_key"]: r["status"] for r in J.inventory_diff(spark.createDataFrame(list(held.items()), "shard_key string, state string"), now, "shard_key", "state").collect()}
    assert changes == {"north": "unchanged", "south": "changed"}
