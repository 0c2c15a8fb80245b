"""Canonical rows kept up to date over batches.

What ``deduplicate`` keeps of a group, its first row, its count and its sources,
merges: the same of two parts is that of the whole.  So the state is a table of
partial results, in buckets by a hash of the group's key.  A batch is reduced to
partial results, which are written as a further part of each bucket that it
touches; whoever reads the rows merges the parts of a group.  Only a bucket that
would have more than ``PARTS`` is merged and written anew, so a row is not
written again with each batch.  A text names the parts of each bucket and the
last batch; it is replaced in one step after all is written, so a batch that
broke off leaves the state before it, and one that comes again changes nothing.

After any split of a table into batches the rows are those of ``deduplicate``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexmill.errors import CheckpointError
from lexmill.operators import sentences as N
from lexmill.sources import export, files

BUCKETS, PARTS = 64, 8
_OWN = ("__rank", "__first", "__n", "__sources")


class CanonicalState:
    """The state of one folder.  keys, order and source: as for ``deduplicate``."""

    def __init__(self, spark: SparkSession, root: str, *, keys: Sequence[str] = N.GROUP, order: Sequence[Column] | None = None, source: str = "source", buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.keys, self.order, self.source = spark, root, tuple(keys), order, source
        found = self._said()
        if found and (found["keys"], found["buckets"]) != (list(self.keys), buckets):
            raise CheckpointError(f"{root} was begun with keys {found['keys']} in {found['buckets']} buckets")
        self.buckets = buckets

    def _said(self) -> dict | None:
        path = f"{self.root}/state.json"
        return json.loads(files.read_text(self.spark, path)) if files.exists(self.spark, path) else None

    def _put(self, said: dict) -> None:
        staged = f"{self.root}/{uuid.uuid4().hex}.new"
        files.write_text(self.spark, staged, export.canonical_json(said))
        files.replace(self.spark, staged, f"{self.root}/state.json")

    def _partial(self, rows: DataFrame) -> DataFrame:
        order = self.order or N.first_order(self.source)
        ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate([*order, *N.stable(rows, *self.keys, "previous_sentence", "next_sentence")])])
        rest = F.struct(*[c for c in rows.columns if c not in self.keys])
        reduced = rows.groupBy(*self.keys).agg(F.min_by(rest, ranked).alias("__first"), F.min(ranked).alias("__rank"), F.count("*").alias("__n"), F.array_sort(F.collect_set(self.source)).alias("__sources"))
        return reduced.select(*self.keys, *_OWN, self._bucket().alias("bucket"))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, schema: dict, paths: Sequence[str], *, new: bool = False) -> DataFrame:
        """Partial results of some parts; new: with ``__new``, which merged parts hold."""
        kind = StructType.fromJson(schema)
        return self.spark.read.schema(kind.add("__new", "boolean") if new else kind).parquet(*[f"{self.root}/{path}" for path in paths])

    def _told_new(self, schema: dict, before: Sequence[str], new: Sequence[str]) -> DataFrame:
        """Merged partial results, with ``__new`` where one of the new parts holds the group."""
        parts = self._read(schema, new).withColumn("__new", F.lit(True))
        return self._merged(self._read(schema, before).withColumn("__new", F.lit(False)).unionByName(parts)) if before else parts

    def _merged(self, parts: DataFrame) -> DataFrame:
        """One partial result of each group; ``__new``, if there, tells whether any part is new."""
        new = [F.max("__new").alias("__new")] if "__new" in parts.columns else []
        # Of a group there are PARTS + 1 rows at most.
        return parts.groupBy(*self.keys).agg(F.min_by("__first", "__rank").alias("__first"), F.min("__rank").alias("__rank"), F.sum("__n").alias("__n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("__sources")))).alias("__sources"), *new)

    def _write(self, partial: DataFrame, batch: int) -> dict[str, str]:
        """Write partial results; the folder of each bucket that has any."""
        folder = f"part-{batch:09d}-{uuid.uuid4().hex}"
        partial.write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        return {name.removeprefix("bucket="): f"{folder}/{name}" for name, _, _ in files.children(self.spark, f"{self.root}/{folder}") if name.startswith("bucket=")}

    def update(self, rows: DataFrame, batch: int) -> DataFrame | None:
        """Take in a batch; the groups that it changed, as ``rows`` gives them, or None if it was taken in before."""
        said = self._said() or {"keys": list(self.keys), "buckets": self.buckets, "batch": -1, "paths": {}, "schema": None}
        if batch <= said["batch"]:
            return None
        part = self._partial(rows)
        schema = json.loads(part.drop("bucket").schema.json())
        if said["schema"] is not None and [(f["name"], f["type"]) for f in said["schema"]["fields"]] != [(f["name"], f["type"]) for f in schema["fields"]]:
            raise CheckpointError(f"batch {batch} has other columns than the state")
        new = self._write(part, batch)
        paths, full = said["paths"], [b for b in new if len(said["paths"].get(b, [])) >= PARTS]
        rest = [b for b in new if b not in full]
        changed = [self._told_new(schema, [p for b in rest for p in paths.get(b, [])], [new[b] for b in rest])] if rest else []
        kept, old = {b: [*paths.get(b, []), new[b]] for b in rest}, [p for b in full for p in [*paths[b], new[b]]]
        if full:
            whole = self._write(self._told_new(schema, [p for b in full for p in paths[b]], [new[b] for b in full]).withColumn("bucket", self._bucket()), batch)
            kept |= {b: [path] for b, path in whole.items()}
            changed.append(self._read(schema, list(whole.values()), new=True))
        self._put(said | {"batch": batch, "schema": said["schema"] or schema, "paths": paths | kept})
        for path in old:
            files.remove(self.spark, f"{self.root}/{path}")
        if not changed:
            return rows.limit(0).transform(lambda df: self._shown(self._partial(df)))
        return self._shown(reduce(DataFrame.unionByName, changed).where("__new"))

    def _shown(self, stored: DataFrame) -> DataFrame:
        rest = stored.schema["__first"].dataType.names
        return stored.select(*self.keys, *[F.col(f"__first.{c}").alias(c) for c in rest], F.col("__n").alias("duplicate_occurrence_count"), F.col("__sources").alias("duplicate_sources"))

    def rows(self) -> DataFrame | None:
        """The canonical rows so far; None before the first batch."""
        said = self._said()
        paths = said["paths"].values() if said else []
        if not any(paths):
            return None
        stored = self._read(said["schema"], [path for own in paths for path in own])
        return self._shown(self._merged(stored) if any(len(own) > 1 for own in paths) else stored)

    def run(self, source: DataFrame, checkpoint: str) -> None:
        """Take in all that a stream has, batch by batch; a run that broke off goes on."""
        stream = source.writeStream.foreachBatch(lambda df, n: self.update(df, n)).option("checkpointLocation", checkpoint)
        stream.trigger(availableNow=True).start().awaitTermination()
