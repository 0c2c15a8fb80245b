"""Ordered output in parts, which a run that broke off goes on with.

A folder beside the target holds the state.  Rows are dealt into ranges of their
order first, by bounds from a bounded sample; that table and the bounds are
recorded.  Then ranges are sorted and written a few at a time, each with a text
of its rows and their hash, written last.  A second run of the same identity
keeps what is recorded and writes only ranges without a text; one of another
identity begins anew.  When all ranges stand and hold what was dealt, they
become the target in one rename: until then the old target stays as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lexmill.errors import CheckpointError
from lexmill.sources import export, files

#: Rows that bounds are taken from, for each range; ranges that one job writes.
SAMPLE, WAVE = 200, 8


def _bounds(rows: DataFrame, order: Sequence[str], parts: int) -> list[list]:
    """Keys that part the rows into ranges of about equal size: quantiles of at most ``SAMPLE`` rows a range, chosen by hash."""
    count = rows.count()
    share = min(1.0, SAMPLE * parts / max(1, count))
    chosen = rows.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(1 << 30)) < int(share * (1 << 30)))
    keys = [list(r) for r in chosen.orderBy(*order).limit(4 * SAMPLE * parts).collect()]
    cuts = [keys[len(keys) * k // parts] for k in range(1, parts)] if keys else []
    return [k for n, k in enumerate(cuts) if not n or k != cuts[n - 1]]


def _range_of(order: Sequence[str], bounds: list[list], kinds: dict[str, str]) -> Column:
    """How many bounds a row's key reaches."""
    key = F.struct(*order)
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(order, b, strict=True)]) for b in bounds])
    return F.size(F.filter(held, lambda b: b <= key))


def finalize_in_parts(rows: DataFrame, target: str, identity: dict, *, order: Sequence[str], parts: int = 64, overwrite: bool = False) -> dict:
    """Write ``rows`` in order as ``target/data``, with ``manifest.json``, which is returned.

    identity: what the rows come from; it must change when they do.  order:
    columns of plain values, as JSON holds them, that tell rows apart.
    """
    spark, root = rows.sparkSession, f"{target}.parts"
    if files.exists(spark, target) and not overwrite:
        raise FileExistsError(target)
    own = json.loads(export.canonical_json(identity))
    path = f"{root}/plan.json"
    plan = json.loads(files.read_text(spark, path)) if files.exists(spark, path) else None
    if plan is None or plan["identity"] != own:
        files.remove(spark, root)
        bounds, dealt = _bounds(rows, order, parts), f"dealt-{uuid.uuid4().hex}"
        part = _range_of(order, bounds, dict(rows.dtypes)).cast("int").alias("part")
        rows.select("*", part).write.partitionBy("part").parquet(f"{root}/{dealt}")
        stored = spark.read.schema(StructType([*rows.schema, StructField("part", IntegerType())])).parquet(f"{root}/{dealt}")
        plan = {"identity": own, "ranges": len(bounds) + 1, "dealt": dealt, "columns": [list(x) for x in rows.dtypes], "counts": {str(r["part"]): r["count"] for r in stored.groupBy("part").count().collect()}}
        files.write_text(spark, path, export.canonical_json(plan))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in [*plan["columns"], ["part", "int"]])
    dealt = spark.read.schema(schema).parquet(f"{root}/{plan['dealt']}")
    columns = [name for name, _ in plan["columns"]]

    def said(part: int) -> dict | None:
        text = f"{root}/said/{part:06d}.json"
        return json.loads(files.read_text(spark, text)) if files.exists(spark, text) else None

    there = [p for p in range(plan["ranges"]) if str(p) in plan["counts"]]
    missing = [p for p in there if said(p) is None]
    for start in range(0, len(missing), WAVE):
        wave = missing[start : start + WAVE]
        staged = f"{root}/wave-{uuid.uuid4().hex}"
        # One task a range; its rows are those of a bounded share of the order.
        turn = F.array_position(F.array(*map(F.lit, wave)), F.col("part")) - 1
        dealt.where(F.col("part").isin(wave)).repartitionById(len(wave), turn.cast("int")).sortWithinPartitions("part", *order).write.option("compression", "zstd").partitionBy("part").parquet(staged)
        written = spark.read.schema(schema).parquet(staged)
        hashes = export.content_hashes(written, "part")
        counts = {r["part"]: r["count"] for r in written.groupBy("part").count().collect()}
        for p in wave:
            if counts.get(p) != plan["counts"][str(p)]:
                raise CheckpointError(f"range {p} has {counts.get(p)} of {plan['counts'][str(p)]} rows")
            (name,) = [n for n, _, _ in files.children(spark, f"{staged}/part={p}") if n.startswith("part-")]
            files.remove(spark, f"{root}/data/part-{p:06d}.parquet")
            files.make_folder(spark, f"{root}/data")
            files.make_folder(spark, f"{root}/said")
            files.rename(spark, f"{staged}/part={p}/{name}", f"{root}/data/part-{p:06d}.parquet")
            files.write_text(spark, f"{root}/said/{p:06d}.json", export.canonical_json({"rows": counts[p], "content_sha256": hashes[p]}))
        files.remove(spark, staged)
    facts = {f"part-{p:06d}.parquet": said(p) for p in there}
    if not there:
        dealt.select(*columns).limit(0).write.parquet(f"{root}/data")
    manifest = {"identity": own, "order": list(order), "row_count": sum(f["rows"] for f in facts.values()), "files": facts}
    files.write_text(spark, f"{root}/manifest.json", export.canonical_json(manifest))
    old = f"{target}.{uuid.uuid4().hex}.old"
    for name in (plan["dealt"], "said", "plan.json"):
        files.remove(spark, f"{root}/{name}")
    if files.exists(spark, target):
        files.rename(spark, target, old)
    files.rename(spark, root, target)
    files.remove(spark, old)
    return manifest
