"""Nested stratified samples that do not depend on partitioning.

Serving again and again the stratum with the least served share merges streams
of priorities that never fall, so the order it gives is one global sort by
priority and the stratum's rank; a prefix of it is a sample.

A sample takes two passes.  The first counts: strata, and within each the parts
of its order.  From the strata's sizes follows what each one gives (``quotas``),
without the rows.  The second pass reads the rows again and drops those of parts
that begin beyond their stratum's share before anything is shuffled, so what is
ranked and sorted grows with the target, not with the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lexmill.errors import IntegrityError, SourceError
from lexmill.functions.spatial import bad_coordinates, with_cell
from lexmill.functions.values import seeded_rank
from lexmill.operators.integrity import assert_all, duplicate_keys
from lexmill.storage import discard, materialize

#: Leading hexadecimal digits of a hash that part a stratum.
PART_DIGITS = 2
#: The same for a sample, of which only the last part of each stratum is read in vain.
SAMPLE_DIGITS = 3
#: Parts that a sample broadcasts at most, whatever the planner's limit; beyond it the planner decides.
FEW_PARTS = 1 << 17


def weighted_schedule(sizes: DataFrame, *, seed: str, limit: int, stratum: str = "stratum", size: str = "size") -> DataFrame:
    """``position``, ``stratum`` and ``served`` of the first turns; sizes of strata in, positive."""
    turns = sizes.where(F.col(size) > 0).select(F.col(stratum).alias("stratum"), F.col(size).cast("long").alias("n"))
    # No stratum gets more than ``limit`` of the first ``limit`` turns.
    turns = turns.select("stratum", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.least("n", F.lit(limit).cast("long")) - 1)).alias("served"))
    order = [F.col("served") / F.col("n"), seeded_rank(seed, F.col("stratum")), F.col("stratum")]
    first = turns.orderBy(*order).limit(limit)
    return first.withColumn("position", F.row_number().over(Window.orderBy(*order)) - 1).select("position", "stratum", "served")


def _ranked(rows: DataFrame, stratum: str, rank: Column, order: list[Column], first: list[Column] | None = None) -> DataFrame:
    """Add ``__rank``, from 1, within the stratum by ``first``, hash ``rank`` and ``order``, and the stratum's size ``__n``.

    Ranks are counted in parts, those of equal ``first`` and leading digits of the
    hash, and parts' sizes give the offsets: a stratum that holds a third of all
    rows is spread over as many tasks as it has parts.
    """
    part = F.struct(*[c.alias(f"f{i}") for i, c in enumerate(first or [])], F.substring(rank, 1, PART_DIGITS).alias("digits"))
    parted = rows.withColumns({"__part": part, "__hash": rank})
    own = Window.partitionBy(stratum)
    sizes = parted.groupBy(stratum, "__part").agg(F.count("*").alias("__size"))
    sizes = sizes.withColumns({"__before": F.coalesce(F.sum("__size").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "__n": F.sum("__size").over(own)}).drop("__size")
    placed = parted.withColumn("__own", F.row_number().over(Window.partitionBy(stratum, "__part").orderBy("__hash", *order)))
    return placed.join(sizes, [stratum, "__part"]).withColumn("__rank", F.col("__own") + F.col("__before")).drop("__part", "__hash", "__own", "__before")


def quotas(sizes: DataFrame, *, target: int, seed: str, first: int = 0, stratum: str = "stratum", size: str = "size") -> DataFrame:
    """``stratum``, ``n`` and ``quota``: how many of the first ``target`` turns each stratum has.

    The k-th turn of a stratum (from 0) has the priority (k + first) / size.  By
    the sum of sizes, the last turn's priority is known within the number of
    strata: turns below it are counted, and only those about it are sorted, one
    or two a stratum.
    """
    strata = sizes.where(F.col(size) > 0).select(F.col(stratum).alias("stratum"), F.col(size).cast("long").alias("n"))
    total, many = strata.agg(F.sum("n"), F.count("*")).first()
    if not total or target >= total:
        return strata.withColumn("quota", F.col("n"))
    if first:
        # floor(n * x) turns have a priority of at most x.
        low, high = F.floor(F.col("n") * (target / total)) - 1, F.floor(F.col("n") * ((target + many) / total)) + 1
    else:
        # ceil(n * x) turns have a priority below x.
        low, high = F.ceil(F.col("n") * ((target - many) / total)) - 1, F.ceil(F.col("n") * (target / total)) + 1
    sure = strata.select("stratum", "n", F.least(F.greatest(low, F.lit(0)), "n").cast("long").alias("sure"), F.least(high, "n").cast("long").alias("most"))
    left = target - sure.agg(F.sum("sure")).first()[0]
    open_ = sure.where("most > sure").select("stratum", "n", F.explode(F.sequence("sure", F.col("most") - 1)).alias("k"))
    turns = open_.orderBy((F.col("k") + first) / F.col("n"), seeded_rank(seed, F.col("stratum")), "stratum", "k").limit(left)
    more = turns.groupBy("stratum").agg(F.count("*").alias("more"))
    return sure.join(more, "stratum", "left").select("stratum", "n", (F.col("sure") + F.coalesce("more", F.lit(0))).alias("quota"))


def chosen(rows: DataFrame, *, stratum: str, rank: Column, order: list[Column], target: int, seed: str, within: list[Column] | None = None, first: int = 0) -> DataFrame:
    """The rows of the first ``target`` turns, with ``__rank`` in their stratum and its size ``__n``.

    Within a stratum rows come by ``within``, hash ``rank`` and ``order``.  The
    kept parts have a chosen row each, so they are ``target`` at most.  Rows that
    differ between the passes are an error.
    """
    group = F.struct(*[c.alias(f"f{i}") for i, c in enumerate(within or [F.lit(0)])])
    parted = rows.withColumns({"__group": group, "__digits": F.substring(rank, 1, SAMPLE_DIGITS), "__hash": rank})
    sizes = materialize(parted.groupBy(stratum, "__group", "__digits").agg(F.count("*").alias("__size")), "part-sizes")
    shares = quotas(sizes.groupBy(stratum).agg(F.sum("__size").alias("size")), target=target, seed=seed, first=first, stratum=stratum)
    earlier = lambda by, *keys: F.coalesce(F.sum("__size").over(Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # First the groups that begin within the share, then their parts.
    groups = sizes.groupBy(stratum, "__group").agg(F.sum("__size").alias("__size")).withColumn("__start", earlier("__group", stratum))
    groups = groups.join(shares.where("quota > 0").withColumnRenamed("stratum", stratum), stratum).where(F.col("__start") < F.col("quota")).drop("__size")
    kept = sizes.join(groups, [stratum, "__group"]).withColumn("__before", F.col("__start") + earlier("__digits", stratum, "__group"))
    kept = materialize(kept.where(F.col("__before") < F.col("quota")).select(stratum, "__group", "__digits", "__before", F.col("n").alias("__n"), F.col("quota").alias("__quota")), "kept-parts")
    total = sizes.agg(F.sum("__size")).first()[0] or 0
    seen, taken = Observation(), Observation()
    parts = F.broadcast(kept) if target <= FEW_PARTS else kept
    near = parted.observe(seen, F.count(F.lit(1)).alias("n")).join(parts, [stratum, "__group", "__digits"])
    ranked = near.withColumn("__rank", F.col("__before") + F.row_number().over(Window.partitionBy(stratum, "__group", "__digits").orderBy("__hash", *order)))
    found = ranked.where(F.col("__rank") <= F.col("__quota")).drop("__group", "__digits", "__hash", "__before", "__quota")
    out = materialize(found.observe(taken, F.count(F.lit(1)).alias("n")), "chosen-rows")
    # An empty side may spare Spark the scan that would be counted.
    if total and (taken.get["n"], seen.get["n"]) != (min(target, total), total):
        raise SourceError(f"the rows changed while they were sampled: {taken.get['n']} of {min(target, total)} chosen, {seen.get['n']} of {total} read")
    discard(sizes, shares, kept)
    return out


def stratified(rows: DataFrame, *, stratum: str, target: int, seed: str, key: str = "sentence_id", validate: bool = True, order: Sequence[str] = ()) -> DataFrame:
    """Up to ``target`` rows in proportion over strata; rows without a stratum are never chosen.

    A stratum's next row has the priority (served + 1) / size.  order: columns by
    which the input is ordered, which the result is then too.
    """
    if validate:
        assert_all({f"{key} repeats": duplicate_keys(rows, key)})
    found = chosen(rows.where(F.col(stratum).isNotNull()), stratum=stratum, rank=seeded_rank(seed, F.col(key)), order=[F.col(key)], target=target, seed=seed, first=1)
    if order:
        return found.drop("__rank", "__n").orderBy(*order)
    return found.orderBy(F.col("__rank") / F.col("__n"), seeded_rank(seed, F.col(stratum)), stratum, "__rank").drop("__rank", "__n")


def polygon_order(rows: DataFrame, *, stratum: str, seed: str, polygon: str = "polygon_id", bucket: str = "area_bucket") -> DataFrame:
    """``__order`` of each polygon: large ones by rank, then the others in proportion over cells."""
    polygons = rows.where(F.col(stratum).isNotNull()).select(polygon, bucket, stratum).distinct()
    large, rank = F.col(bucket) == "large", seeded_rank(seed, F.col(polygon))
    own = Window.partitionBy(stratum, large)
    share = (F.row_number().over(own.orderBy(rank, polygon)) - 1) / F.count("*").over(own)
    return polygons.select(polygon, F.struct(F.when(large, 0).otherwise(1).alias("late"), F.when(large, 0.0).otherwise(share).alias("share"), F.when(large, rank).otherwise(seeded_rank(seed, F.col(stratum))).alias("rank"), F.col(polygon).alias("id")).alias("__order"))


def in_polygon_order(rows: DataFrame, *, stratum: str, seed: str, polygon: str = "polygon_id", bucket: str = "area_bucket") -> DataFrame:
    """Rows with a stratum, with the ``__order`` of their polygon."""
    return rows.where(F.col(stratum).isNotNull()).join(polygon_order(rows, stratum=stratum, seed=seed, polygon=polygon, bucket=bucket), polygon)


def nested_order(rows: DataFrame, *, stratum: str, seed: str, key: str = "sentence_id", **names: str) -> DataFrame:
    """Rows with a stratum, with their rank and the size of their stratum, by which ``turn`` orders them."""
    placed = in_polygon_order(rows, stratum=stratum, seed=seed, **names)
    return _ranked(placed, stratum, seeded_rank(seed, F.col(key)), [F.col(key)], [F.col("__order")])


def turn(seed: str, stratum: str) -> list[Column]:
    """Strata are served by served / size, then by their hash."""
    return [(F.col("__rank") - 1) / F.col("__n"), seeded_rank(seed, F.col(stratum)), F.col(stratum), F.col("__rank")]


def numbered(rows: DataFrame, order: list[Column], target: int) -> DataFrame:
    """The first ``target`` rows with their ``position``; only these meet in one task."""
    return rows.orderBy(*order).limit(target).withColumn("position", F.row_number().over(Window.orderBy(*order)) - 1)


def nested(rows: DataFrame, *, stratum: str, target: int, seed: str, key: str = "sentence_id", validate: bool = True, **names: str) -> DataFrame:
    """The first ``target`` rows of a fixed order, with their ``position``.

    Polygons are ordered first, rows follow their polygons within a stratum, and
    strata are served by served / size.  A larger target extends the same order.
    names: the columns ``polygon`` and ``bucket``.
    """
    if target < 1:
        raise ValueError("target must be positive")
    if validate:
        assert_all({f"{key} repeats": duplicate_keys(rows, key)})
    placed = in_polygon_order(rows, stratum=stratum, seed=seed, **names)
    found = chosen(placed, stratum=stratum, rank=seeded_rank(seed, F.col(key)), order=[F.col(key)], target=target, seed=seed, within=[F.col("__order")])
    return numbered(found, turn(seed, stratum), target).drop("__rank", "__n", "__order")


def _in_order(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return rows.orderBy(*order) if order else rows


def canary(rows: DataFrame, limit: int, *, key: str = "sentence_id", order: Sequence[str] = ()) -> DataFrame:
    """The ``limit`` rows whose keys have the least SHA-256, in the input's order; all for a limit of 0.

    order: columns by which the input is ordered; by default the result comes by hash.
    """
    if limit == 0:
        return _in_order(rows, order)
    if limit < 1:
        raise ValueError("the limit must not be negative")
    return _in_order(rows.orderBy(F.sha2(F.col(key).cast("string"), 256), key).limit(limit), order)


def covering_canary(rows: DataFrame, limit: int, *, key: str = "sentence_id", source: str = "source", language: str = "language", order: Sequence[str] = (), region: str | None = None) -> DataFrame:
    """A row of each source (of a language not yet seen if there is one), then of each language, then by hash.

    order: columns by which the input is ordered, by default the key; first rows
    are those, and the result comes so.  region: a column that must hold one value.
    The sources and languages go to the driver, as each choice depends on those
    before; of each source and language at most ``limit`` values can matter, so
    no more are taken.
    """
    if limit < 1:
        raise ValueError("the limit must be positive")
    if region is not None and len(found := rows.select(region).distinct().limit(2).collect()) > 1:
        raise IntegrityError(f"{region} holds more than one value", [str(r[0]) for r in found])
    place = F.struct(*(order or (key,)))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    pairs = rows.groupBy(text(source).alias("s"), text(language).alias("l")).agg(F.min(F.struct(place.alias("place"), F.col(key).alias("k"))).alias("first"))
    pairs = pairs.select("s", "l", F.col("first.place").alias("place"), F.col("first.k").alias("k"))
    # Of the sources in order the first ``limit`` are served; one is served by its first row in a language not yet seen.
    own = pairs.withColumn("r", F.row_number().over(Window.partitionBy("s").orderBy("place")))
    sources = pairs.select("s").distinct().orderBy("s").limit(limit)
    chosen: list = []
    seen: set[str] = set()

    def take(k: object, lang: str) -> None:
        if k not in chosen and len(chosen) < limit:
            chosen.append(k)
            seen.add(lang)

    by_source: dict[str, list] = {}
    for r in own.where(F.col("r") <= limit + 1).join(sources, "s").collect():
        by_source.setdefault(r["s"], []).append(r)
    for s in sorted(by_source):
        candidates = sorted(by_source[s], key=lambda r: r["r"])
        best = next((r for r in candidates if r["l"] not in seen), candidates[0])
        take(best["k"], best["l"])
    languages = pairs.groupBy("l").agg(F.min(F.struct("place", "k")).alias("first"))
    for r in languages.orderBy(F.sha2("l", 256), "l").limit(2 * limit).collect():
        take(r["first"]["k"], r["l"])
    for r in canary(rows.select(key), limit, key=key).collect():
        take(r[key], "")
    return _in_order(rows.where(F.col(key).isin(chosen)), order)


def select_rows(rows: DataFrame, *, row_limit: int = 0, target: int | None = None, seed: str = "sentence-relevance", stratum: str | None = None, key: str = "sentence_id", order: Sequence[str] = (), **canary_options) -> DataFrame:
    """What a run labels: a covering canary of ``row_limit`` rows, or all without a target, or a stratified sample.

    Without a ``stratum`` rows are stratified by the cell of their coordinates.
    """
    if row_limit:
        return covering_canary(rows, row_limit, key=key, order=order, **canary_options)
    if not target:
        return _in_order(rows, order)
    if stratum is not None:
        return stratified(rows, stratum=stratum, target=target, seed=seed, key=key, order=order)
    assert_all({"a coordinate is outside the valid range": bad_coordinates(rows)})
    return stratified(with_cell(rows, name="__cell"), stratum="__cell", target=target, seed=seed, key=key, order=order).drop("__cell")
