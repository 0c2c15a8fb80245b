"""A nested sample that grows: its order is fixed once, and later runs take more of it.

The folder of a sample holds its state, the order of all rows' keys, written as a
table in blocks of positions when the sample is begun, and the rows taken so far.  A run with the same seed and the same
shards may ask for the same number of rows or for more, never for fewer.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.errors import CheckpointError, SourceError
from lexmill.operators import integrity as I
from lexmill.operators import sampling as S
from lexmill.plans.card import check_target
from lexmill.sources import export, files
from lexmill.storage import discard, materialize

#: Positions in one folder of the order.
BLOCK = 65_536
_ORDER = "key {kind}, position long, block int"


def _state(spark: SparkSession, root: str) -> dict | None:
    path = f"{root}/state.json"
    return json.loads(files.read_text(spark, path)) if files.exists(spark, path) else None


def _put(spark: SparkSession, root: str, state: dict) -> None:
    files.write_text(spark, f"{root}/state.json", export.canonical_json(state))


def _write_order(rows: DataFrame, path: str, *, stratum: str, seed: str, key: str, **names: str) -> int:
    """Keys with their position, in folders of ``BLOCK`` positions; how many there are.

    The order is sorted once, by ranges.  A row's position is its place in its
    range and the sizes of the ranges before, of which there are as many as tasks.
    """
    turns = S.turn(seed, stratum)
    placed = S.nested_order(rows, stratum=stratum, seed=seed, key=key, **names).select(F.col(key).alias("key"), *[c.alias(f"o{k}") for k, c in enumerate(turns)])
    place = F.monotonically_increasing_id()
    ranges = materialize(placed.orderBy(*[f"o{k}" for k in range(len(turns))]).select("key", F.shiftright(place, 33).cast("int").alias("range"), place.bitwiseAND((1 << 33) - 1).alias("at")), "sample-order")
    before, starts = 0, []
    for r in ranges.groupBy("range").count().orderBy("range").collect():
        starts.append((r["range"], before))
        before += r["count"]
    numbered = ranges.join(F.broadcast(rows.sparkSession.createDataFrame(starts, "range int, start long")), "range").select("key", (F.col("start") + F.col("at")).alias("position"))
    numbered.withColumn("block", F.floor(F.col("position") / BLOCK).cast("int")).repartitionByRange("block").sortWithinPartitions("block", "position").write.partitionBy("block").parquet(path)
    discard(ranges)
    return before


def next_keys(spark: SparkSession, root: str, order: dict, first: int, last: int) -> DataFrame:
    """``key, position`` of positions in [first, last): only their blocks are read."""
    found = spark.read.schema(_ORDER.format(kind=order["key"])).parquet(f"{root}/{order['path']}")
    blocks = F.col("block").between(first // BLOCK, max(first, last - 1) // BLOCK)
    return found.where(blocks & (F.col("position") >= first) & (F.col("position") < last)).select("key", "position")


def grow(rows: DataFrame, root: str, *, target: int, seed: str, shards: dict[str, str], stratum: str, key: str = "sentence_id", **names: str) -> DataFrame:
    """The first ``target`` rows of the sample's order, with their ``position``.

    shards: what identifies each shard that the rows come from.  A growth looks
    up the positions that are new in their blocks, fetches those rows and writes
    them beside the ones before.  What is written before the state names it does
    not count, so a run that broke off starts its step again.
    """
    if target < 1 or not seed:
        raise ValueError("the target must be positive and the seed not empty")
    spark, state = rows.sparkSession, _state(rows.sparkSession, root)
    if state is None:
        I.assert_all({f"{key} repeats": I.duplicate_keys(rows, key)})
        path = f"order-{uuid.uuid4().hex}"
        total = _write_order(rows, f"{root}/{path}", stratum=stratum, seed=seed, key=key, **names)
        kind = dict(rows.dtypes)[key]
        state = {"seed": seed, "shards": shards, "target": 0, "order": {"path": path, "key": kind, "rows": total}, "parts": []}
        _put(spark, root, state)
    if state["seed"] != seed:
        raise CheckpointError("the sample was begun with another seed")
    if state["shards"] != shards:
        raise CheckpointError("the sample was begun with other shards")
    if check_target(state["target"], target):
        had, there = min(state["target"], state["order"]["rows"]), min(target, state["order"]["rows"])
        if there > had:
            part = f"rows-{had}-{there}-{uuid.uuid4().hex}"
            more = rows.join(next_keys(spark, root, state["order"], had, there).withColumnRenamed("key", key), key)
            more.write.parquet(f"{root}/{part}")
            if (found := spark.read.parquet(f"{root}/{part}").count()) != there - had:
                raise SourceError(f"the rows changed since the sample was begun: {found} of {there - had} found")
            state["parts"] = [*state["parts"], part]
        state = state | {"target": target}
        _put(spark, root, state)
    if not state["parts"]:
        return rows.where(F.lit(False)).withColumn("position", F.lit(0).cast("long"))
    return spark.read.parquet(*[f"{root}/{p}" for p in state["parts"]]).where(F.col("position") < target)
