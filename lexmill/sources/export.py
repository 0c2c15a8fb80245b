"""Writing a dataset whole or not at all."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lexmill.errors import SchemaError
from lexmill.schemas import contract
from lexmill.sources import files


def canonical_json(data: dict) -> str:
    return json.dumps(data, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n"


def _content_sums(columns: list[str]) -> list[Column]:
    row = F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(row, 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")).alias(f"p{k}") for k in range(8)]
    return [F.count("*").alias("n"), *parts]


def _content_digest(sums: Sequence) -> str:
    return hashlib.sha256(":".join(str(x) for x in sums).encode()).hexdigest()


def content_hash(df: DataFrame) -> str:
    """A hash of the rows that does not depend on their order or files."""
    return _content_digest(df.agg(*_content_sums(df.columns)).first())


def content_hashes(df: DataFrame, by: str) -> dict:
    """The same of the rows of each value of a column, without that column, in one job; the values are few."""
    return {r[0]: _content_digest(r[1:]) for r in df.groupBy(by).agg(*_content_sums([c for c in df.columns if c != by])).collect()}


def check_output(df: DataFrame, table: str = "sentences") -> DataFrame:
    """Columns in the contract's order and types, no null where the contract has none."""
    wanted = contract(table)
    missing, more = sorted(set(wanted.names) - set(df.columns)), sorted(set(df.columns) - set(wanted.names))
    if missing or more:
        raise SchemaError(f"{table}: missing {missing}, unknown {more}")
    kinds = dict(df.dtypes)
    if wrong := [f"{f.name} is {kinds[f.name]}" for f in wanted if kinds[f.name] != f.dataType.simpleString()]:
        raise SchemaError(f"{table}: {', '.join(wrong)}")
    needed = [f.name for f in wanted if not f.nullable]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in needed]).first()
    if found := [c for c in needed if nulls[c]]:
        raise SchemaError(f"{table}: null in {', '.join(found)}")
    return df.select(*wanted.names)


def write_file(df: DataFrame, path: str) -> None:
    """One zstd Parquet file, there whole or not at all; for tables of which one task can hold the rows.

    A file of the name stays until the new one takes its place in one rename.
    """
    spark, staged = df.sparkSession, f"{path}.{uuid.uuid4().hex}.new"
    try:
        df.coalesce(1).write.option("compression", "zstd").parquet(staged)
        (part,) = [n for n, _, _ in files.children(spark, staged) if n.startswith("part-")]
        files.replace(spark, f"{staged}/{part}", path)
    finally:
        files.remove(spark, staged)


def without_maps(df: DataFrame) -> DataFrame:
    """Maps of strings as lists of key and value, by key, which every reader of Parquet shows; other columns as they are."""
    from lexmill.functions.values import sorted_tags

    return df.withColumns({f.name: sorted_tags(F.col(f.name)) for f in df.schema if isinstance(f.dataType, MapType)})


def swap(df: DataFrame, target: str, *, overwrite: bool = False, **texts: str) -> None:
    """Write ``data`` and text files beside the target, then move them into place in one rename.

    What was there before is kept until the new one stands.
    """
    spark = df.sparkSession
    if files.exists(spark, target) and not overwrite:
        raise FileExistsError(target)
    staged, old = f"{target}.{uuid.uuid4().hex}.new", f"{target}.{uuid.uuid4().hex}.old"
    try:
        df.write.option("compression", "zstd").parquet(f"{staged}/data")
        for name, text in texts.items():
            files.write_text(spark, f"{staged}/{name.replace('_', '.')}", text)
        if files.exists(spark, target):
            files.rename(spark, target, old)
        try:
            files.rename(spark, staged, target)
        except OSError:
            if files.exists(spark, old):
                files.rename(spark, old, target)
            raise
        files.remove(spark, old)
    finally:
        files.remove(spark, staged)


def write_sample(rows: DataFrame, scores: DataFrame, path: str, *, limit: int = 100, key: str = "sentence_id") -> None:
    """The first rows by key, with their scores, as lines of JSON for review."""
    from lexmill.operators.integrity import assert_all, duplicate_keys, orphans

    first = rows.orderBy(key).limit(limit)
    assert_all({"a score repeats": duplicate_keys(scores, key), "a sampled row has no score": orphans(first, key, scores, key)})
    first.join(scores, key).orderBy(key).coalesce(1).write.json(path)
