"""Results in numbered batches that a run which broke off finds again.

A batch is a folder of rows and a text of what it is: the run's identity, the
number of rows and a hash of them.  The text is written last, so a folder
without one is a batch that broke off, and is written again.  Batches are read
as one table after all texts have been compared with the rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.errors import CheckpointError
from lexmill.operators import integrity as I
from lexmill.operators import joins as J
from lexmill.sources import export, files
from lexmill.storage import discard, materialize

_BATCH = re.compile(r"batch=([0-9]{6})")
#: Keys that a task compares.
KEYS = 1 << 18


def _dealt(rows: DataFrame, key: str, count: int) -> DataFrame:
    """Rows dealt out by key, about ``KEYS`` to a task: what a task holds does not grow with the table."""
    return rows.repartition(count // KEYS + 1, key)


def _one_sided(rows: DataFrame, out: DataFrame, key: str, count: int) -> DataFrame:
    """Keys, as text and without nulls, that only one of two tables has."""
    side = lambda df, k: df.select(F.col(key).cast("string").alias("offender"), F.lit(k).alias("side"))
    both = side(rows, 1).union(side(out, 2)).where("offender IS NOT NULL")
    return _dealt(both, "offender", 2 * count).groupBy("offender").agg(F.min("side").alias("least"), F.max("side").alias("most")).where("least = most")


def _names(spark: SparkSession, root: str) -> list[int]:
    out = []
    for name, _, _ in files.children(spark, root):
        if not (found := _BATCH.fullmatch(name)):
            raise CheckpointError(f"{root} holds {name}")
        out.append(int(found[1]))
    return out


def _said(spark: SparkSession, root: str, number: int) -> dict | None:
    path = f"{root}/batch={number:06d}/batch.json"
    return json.loads(files.read_text(spark, path)) if files.exists(spark, path) else None


def write_batch(rows: DataFrame, root: str, number: int, identity: dict, *, key: str = "sentence_id") -> dict:
    """Write one batch; an empty one, one with a repeated or empty key, and one that is there are refused."""
    spark, path = rows.sparkSession, f"{root}/batch={number:06d}"
    if _said(spark, root, number) is not None:
        raise CheckpointError(f"batch {number} is there")
    files.remove(spark, path)
    rows.write.option("compression", "zstd").parquet(f"{path}/data")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/data")
    count = stored.count()
    I.assert_all({"a key is empty": I.empty_keys(stored, key), "a key repeats in its batch": I.duplicate_keys(_dealt(stored.select(key), key, count), key)})
    said = {"identity": identity, "row_count": count, "content_sha256": export.content_hash(stored), "columns": [list(x) for x in stored.dtypes]}
    if not said["row_count"]:
        files.remove(spark, path)
        raise CheckpointError(f"batch {number} is empty")
    files.write_text(spark, f"{path}/batch.json", export.canonical_json(said))
    return said


def read_batches(spark: SparkSession, root: str, identity: dict, *, key: str = "sentence_id") -> DataFrame | None:
    """All whole batches as one table, with ``batch``; None if there is none.

    Every batch must be of this run, hold the rows it says, and share no key with
    another.
    """
    said = {number: found for number in _names(spark, root) if (found := _said(spark, root, number)) is not None}
    if not said:
        return None
    own = json.loads(export.canonical_json(identity))
    first = min(said)
    for number, found in said.items():
        if found["identity"] != own:
            raise CheckpointError(f"batch {number} is of another run")
        if found["columns"] != said[first]["columns"]:
            raise CheckpointError(f"batch {number} has other columns")
    # One table with the batch as a partition, however many there are; a file without a column shows in the hash.
    schema = ", ".join(f"`{name}` {kind}" for name, kind in [*said[first]["columns"], ("batch", "int")])
    rows = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/batch={number:06d}/data" for number in sorted(said)])
    hashes = export.content_hashes(rows, "batch")
    if wrong := sorted(number for number, found in said.items() if hashes.get(number) != found["content_sha256"]):
        raise CheckpointError(f"batch {wrong[0]} differs from what it says")
    keys = _dealt(rows.select(key, "batch"), key, sum(found["row_count"] for found in said.values()))
    if shared := J.repeated_across(keys, key, "batch").orderBy(key).limit(I.SHOWN).collect():
        raise CheckpointError(f"batches share keys: {[r[key] for r in shared]}")
    return rows


def run_batches(rows: DataFrame, root: str, identity: dict, work: Callable[[DataFrame], DataFrame], *, batches: int, key: str = "sentence_id", progress: Callable[[dict], None] | None = None) -> DataFrame:
    """Put all rows through ``work`` in batches, by a hash of their key; batches that stand are not worked again.

    work: from rows to a result for each key.  progress is told the counts after each batch.
    """
    spark = rows.sparkSession
    total, done = rows.count(), 0
    dealt = rows.withColumn("__batch", F.pmod(F.xxhash64(key), F.lit(batches)).cast("int"))
    there = {number: _said(spark, root, number) for number in range(batches)}
    if missing := [number for number, said in there.items() if said is None]:
        # Dealt out once, so a batch reads its own rows alone.
        dealt = materialize(dealt.where(F.col("__batch").isin(missing)), "dealt", by="__batch")
    for number, said in there.items():
        if said is None:
            own = dealt.where(F.col("__batch") == number).drop("__batch")
            if not own.take(1):
                continue
            said = write_batch(work(own), root, number, identity, key=key)
        done += said["row_count"]
        if progress:
            progress({"batch": number, "completed": done, "remaining": total - done})
    if missing:
        discard(dealt)
    out = read_batches(spark, root, identity, key=key)
    if out is None:
        return work(rows).limit(0)
    out = out.drop("batch")
    if not _one_sided(rows, out, key, total).isEmpty():
        I.assert_all({"a row has no result": I.orphans(rows, key, out, key), "a result has no row": I.orphans(out, key, rows, key)})
    return out


def check_timing(timing: dict, *, slack: float = 1e-6) -> None:
    """Parts of a run's time are not negative and sum up."""
    parts = [timing.get(f"{name}_seconds") for name in ("initial_inference", "repair_inference", "inference")]
    if any(x is None or float(x) < 0 for x in parts) or abs(parts[2] - parts[0] - parts[1]) > slack:
        raise CheckpointError(f"times don't sum up: {timing}")
