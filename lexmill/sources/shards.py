"""Shards: the files of one region, which share a name over the tables' folders."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexmill.errors import SchemaError, SourceError
from lexmill.schemas import contract, faults, links_table
from lexmill.sources import files

# Folders of the tables below the root.
FOLDERS = {"polygons": "polygons", "links": "polygon_articles", "wikipedia_documents": "wikipedia/documents", "wikipedia_sections": "wikipedia/sections", "wikivoyage_documents": "wikivoyage/documents", "wikivoyage_sections": "wikivoyage/sections"}
PAIR = frozenset({"wikivoyage_documents", "wikivoyage_sections"})
CORE = FOLDERS.keys() - PAIR
#: Footers that are read at once; files that an error names.
FOOTERS, SHOWN = 16, 5


def discover(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """Path of each table of each shard, by key; a shard has the core tables, and both or neither of the pair."""
    shards: dict[str, dict[str, str]] = {}
    for table, folder in FOLDERS.items():
        for name, _, _ in files.children(spark, f"{root}/{folder}"):
            if name.endswith(".parquet"):
                shards.setdefault(name.removesuffix(".parquet"), {})[table] = f"{root}/{folder}/{name}"
    for key, tables in sorted(shards.items()):
        if missing := sorted(CORE - tables.keys()):
            raise SourceError(f"{key}: no {', '.join(missing)}")
        if len(PAIR & tables.keys()) == 1:
            raise SourceError(f"{key}: only {', '.join(PAIR & tables.keys())} of a pair")
    return dict(sorted(shards.items()))


@dataclass(frozen=True)
class Footer:
    """What a file's own metadata says: its columns, and whether they are what the contract asks for."""

    path: str
    schema: StructType
    contract: str
    faults: tuple[str, ...]


def _contract_of(schema: StructType, table: str) -> str:
    if table == "links":
        return links_table(schema.names)
    return "sections" if table.endswith("_sections") else table


def footers(spark: SparkSession, paths: Sequence[str], table: str) -> list[Footer]:
    """The footer of every file, also of each part of a folder, held against the contract.

    Each is read by Spark in a task of its own, so any store will do that Spark
    reads; ``FOOTERS`` tasks run at once, and no rows are read.
    """

    def one(path: str) -> Footer:
        schema = spark.read.parquet(path).schema
        name = _contract_of(schema, table)
        return Footer(path, schema, name, tuple(faults(schema, name)))

    with ThreadPoolExecutor(FOOTERS) as pool:
        files_ = [path for found in pool.map(lambda p: files.leaves(spark, p), paths) for path in found]
        return list(pool.map(one, files_))


def check_footers(found: Sequence[Footer]) -> None:
    """All files that break their contract are counted, and the first few named."""
    if wrong := [f for f in found if f.faults]:
        named = "; ".join(f"{f.path}: {f.contract}: {', '.join(f.faults)}" for f in wrong[:SHOWN])
        raise SchemaError(f"{len(wrong)} of {len(found)} files break their contract: {named}")


def _aligned(spark: SparkSession, found: Sequence[Footer], columns: Sequence[str] | None) -> DataFrame:
    """Files of one contract; those of one physical schema are read together, and all give the contract's columns in its order."""
    wanted = contract(found[0].contract)
    if unknown := sorted(set(columns or ()) - set(wanted.names)):
        raise SchemaError(f"{found[0].contract} has no {', '.join(unknown)}")
    groups: dict[tuple, list[Footer]] = {}
    for f in found:
        groups.setdefault(tuple(sorted((c.name, c.dataType.simpleString()) for c in f.schema)), []).append(f)
    key = F.regexp_replace(F.col("_metadata.file_name"), r"\.parquet$", "")
    # A folder of part files is a shard too.
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.parquet/[^/]+$", 1)
    tables = [spark.read.schema(own[0].schema).parquet(*[f.path for f in own]).select(*(columns or wanted.names), F.when(folder != "", folder).otherwise(key).alias("shard_key")) for own in groups.values()]
    return reduce(DataFrame.unionByName, tables)


def load(spark: SparkSession, paths: Sequence[str], table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Files of a table, each checked by its own footer, with the contract's columns (or those named) and ``shard_key``.

    Links must all be of one layout; ``load_layouts`` takes both.
    """
    found = footers(spark, paths, table)
    check_footers(found)
    if not found:
        raise SourceError(f"{table}: no files")
    if len(layouts := {f.contract for f in found}) > 1:
        raise SchemaError(f"{table}: files of several layouts: {', '.join(sorted(layouts))}")
    return _aligned(spark, found, columns)


def load_layouts(spark: SparkSession, paths: Sequence[str], table: str) -> dict[str, DataFrame]:
    """The files of a table by the layout that each has."""
    found = footers(spark, paths, table)
    check_footers(found)
    return {name: _aligned(spark, [f for f in found if f.contract == name], None) for name in sorted({f.contract for f in found})}


def _paths(shards: dict[str, dict[str, str]], table: str) -> list[str]:
    return [t[table] for t in shards.values() if table in t]


def load_all(spark: SparkSession, shards: dict[str, dict[str, str]], table: str) -> DataFrame | None:
    """A table of all shards; None if none has it."""
    paths = _paths(shards, table)
    return load(spark, paths, table) if paths else None


def load_links(spark: SparkSession, shards: dict[str, dict[str, str]]) -> dict[str, DataFrame]:
    """The links of all shards by layout: shards of one run may differ."""
    return load_layouts(spark, _paths(shards, "links"), "links")


def inventory(spark: SparkSession, shards: dict[str, dict[str, str]], *, content: bool = False) -> DataFrame:
    """``shard_key`` and the state of its files, to decide which shards changed.

    The state is sizes and times, or with ``content`` the SHA-256 of each file's
    bytes, which tasks compute: a file that is written again with the same bytes
    is then unchanged, and one that differs is changed whatever its size and time.
    """
    places = sorted((key, table, path) for key, tables in shards.items() for table, path in tables.items())
    folders = {path.rsplit("/", 1)[0] for _, _, path in places}
    listed = {folder: {name: (size, changed) for name, size, changed in files.children(spark, folder)} for folder in folders}
    if not content:
        state: dict[str, list[str]] = {}
        for key, table, path in places:
            folder, name = path.rsplit("/", 1)
            size, changed = listed[folder][name]
            state.setdefault(key, []).append(f"{table}:{size}:{changed}")
        return spark.createDataFrame([(key, ",".join(s)) for key, s in state.items()], "shard_key string, state string")
    whole = spark.read.format("binaryFile").load([leaf for _, _, path in places for leaf in files.leaves(spark, path)])
    hashed = whole.select(F.regexp_replace("path", "^[a-z0-9]+:/*", "/").alias("path"), F.sha2("content", 256).alias("sha256"))
    # A part belongs to the shard whose path it begins with; the name of a part plays no part, as every write makes new ones.
    folder = F.regexp_replace("path", r"^(.*\.parquet)/[^/]+$", "$1")
    per_table = hashed.groupBy(folder.alias("file")).agg(F.array_join(F.array_sort(F.collect_list("sha256")), "+").alias("sha256"))
    named = spark.createDataFrame([(key, table, re.sub("^[a-z0-9]+:/*", "/", path)) for key, table, path in places], "shard_key string, table string, file string")
    return named.join(per_table, "file").groupBy("shard_key").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "table", "sha256"))), ",").alias("state"))
