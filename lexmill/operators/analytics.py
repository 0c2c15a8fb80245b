"""Counts and shares that are published beside a dataset and recomputed to check it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.values import MISSING, or_missing, stripped

LABELS = ("yes", "no", "uncertain")
MIN_SLICE = 100
SLICES = ("language", "source", "osm_primary_tag")


def dataset_statistics(rows: DataFrame) -> DataFrame:
    """One row: totals and distinct counts; nulls are not counted as values."""
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return rows.agg(
        F.count("*").alias("row_count"),
        F.countDistinct("sentence_id").alias("sentences"),
        F.countDistinct("polygon_id").alias("polygons"),
        F.countDistinct("wikidata").alias("wikidata_ids"),
        F.countDistinct(F.struct("source", "site", "language", "document_id")).alias("documents"),
        F.count_if(placed).alias("with_coordinates"),
        F.count_if(~placed).alias("without_coordinates"),
    )


def breakdown(rows: DataFrame, *dimensions: str) -> DataFrame:
    """``dimension, value, n`` of several columns in one pass; nulls are left out."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])
    return rows.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("dimension", "value").agg(F.count("*").alias("n"))


def dataset_profile(rows: DataFrame) -> DataFrame:
    """One row: extents, lengths, duplicates."""
    text, placed = F.col("sentence_text_normalized"), F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return rows.agg(
        F.count("*").alias("row_count"),
        F.min(F.when(placed, F.col("lat"))).alias("min_lat"),
        F.max(F.when(placed, F.col("lat"))).alias("max_lat"),
        F.min(F.when(placed, F.col("lon"))).alias("min_lon"),
        F.max(F.when(placed, F.col("lon"))).alias("max_lon"),
        F.count_if(stripped(F.col("polygon_name")) != "").alias("named"),
        F.min(F.length(text)).alias("min_length"),
        F.avg(F.length(text)).alias("mean_length"),
        F.max(F.length(text)).alias("max_length"),
        F.sum("duplicate_occurrence_count").alias("occurrences"),
        F.count_if(F.size(F.array_distinct("duplicate_sources")) > 1).alias("cross_source"),
    )


def joint_label_counts(rows: DataFrame, a: str, b: str) -> DataFrame:
    """All nine pairs of labels with their counts and shares, zeros included."""
    pairs = [(x, y) for x in LABELS for y in LABELS]
    cells = rows.sparkSession.createDataFrame(pairs, f"{a} string, {b} string")
    counts = rows.groupBy(or_missing(F.col(a)).alias(a), or_missing(F.col(b)).alias(b)).agg(F.count("*").alias("n"))
    out = cells.join(counts, [a, b], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy())  # nine rows
    return out.withColumn("share", F.when(total > 0, F.col("n") / total).otherwise(0.0))


def coverage_funnel(rows: DataFrame, polygon: str, landuse: str, place: str) -> DataFrame:
    """One row: polygons, and those with a sentence of each kind; a missing polygon counts for none."""
    p = F.nullif(or_missing(F.col(polygon)), F.lit(MISSING))
    land, pol = F.col(landuse) == "yes", F.col(place) == "yes"
    one = lambda name, c: F.countDistinct(F.when(c, p)).alias(name)
    return rows.agg(F.countDistinct(p).alias("all_polygons"), one("polygon_relevant_polygons", pol), one("landuse_relevant_polygons", land), one("both_yes_polygons", land & pol))


def slice_yields(rows: DataFrame, landuse: str, place: str, dimensions: tuple[str, ...] = SLICES, least: int = MIN_SLICE) -> DataFrame:
    """Rates of each value of each dimension that has enough rows."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), or_missing(F.col(d)).alias("value")) for d in dimensions])
    flags = rows.select((F.col(landuse) == "yes").alias("a"), (F.col(place) == "yes").alias("b"), ((F.col(landuse) == "uncertain") | (F.col(place) == "uncertain")).alias("u"), F.inline(pairs))
    return (
        flags.groupBy("dimension", "value")
        .agg(F.count("*").alias("sample_size"), F.count_if(F.col("a") & F.col("b")).alias("both"), F.count_if("u").alias("unsure"))
        .where(F.col("sample_size") >= least)
        .select("dimension", "value", "sample_size", (F.col("both") / F.col("sample_size")).alias("both_yes_rate"), (F.col("unsure") / F.col("sample_size")).alias("uncertain_rate"))
    )


def histogram(rows: DataFrame, column: str, name: str = "value") -> DataFrame:
    """Values, missing ones by name, with counts and shares."""
    counts = rows.groupBy(or_missing(F.col(column)).alias(name)).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.withColumn("share", F.col("n") / total.scalar())


def top_and_other(rows: DataFrame, column: str, top: int = 15, *, order: list[str] | None = None, resort: bool = False) -> DataFrame:
    """The most frequent values and the sum of all others, by count, then name.

    order: columns of the input's order; equally frequent values then come by
    their first row.  resort: the others' sum takes its place by count and name
    instead of the last.
    """
    tie = F.min(F.struct(*order)) if order else F.first(F.col(column))
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"), tie.alias("tie"))
    first = counts.orderBy(F.desc("n"), "tie").limit(top).drop("tie")
    rest = counts.join(first.select("value"), counts["value"].eqNullSafe(first["value"]), "left_anti").agg(F.sum("n").alias("n")).where("n IS NOT NULL").select(F.lit("Other").alias("value"), "n")
    both = first.unionByName(rest)
    return both.orderBy(F.desc("n"), "value") if resort else both


def coordinates(rows: DataFrame) -> DataFrame:
    """One row: rows with both coordinates and rows without."""
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return rows.agg(F.count_if(placed).alias("with_coordinates"), F.count_if(~placed).alias("without_coordinates"))


def first_seen(rows: DataFrame, key: str, order: list[str], *columns: str) -> DataFrame:
    """Columns of each key's first row that has them all, as a combined minimum."""
    whole = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    return whole.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("f")).select(key, *[F.col(f"f.{c}").alias(c) for c in columns])


def binary_analytics(rows: DataFrame, label: str = "place_relevance", cell: str = "cell") -> DataFrame:
    """One row; a null polygon or language counts as one value."""
    distinct = lambda c: (F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(f"distinct_{c}")
    return rows.agg(F.count("*").alias("row_count"), distinct("polygon_id"), distinct("language"), F.count_if(F.col(label) == "yes").alias("yes"), F.count_if(F.col(label) == "no").alias("no"), F.countDistinct(cell).alias("cells"), F.count_if(F.col(cell).isNull()).alias("without_cell"))
