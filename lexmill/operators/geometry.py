"""Outlines of places on labelled sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import values as V
from lexmill.operators import integrity as I
from lexmill.operators import joins as J


def read_geometry(spark: SparkSession, *paths: str) -> DataFrame:
    """``polygon_id`` and ``geometry`` of polygon shards; no other column is read."""
    return spark.read.parquet(*paths).select("polygon_id", "geometry")


def geometry_checks(rows: DataFrame, polygons: DataFrame) -> dict[str, DataFrame]:
    """Each row has one polygon with an outline, and an outline that a row has already is the same."""
    needed = J.among(polygons, rows, "polygon_id")
    checks = {
        "a sentence repeats": I.duplicate_keys(rows, "sentence_id"),
        "a polygon has no key": I.empty_keys(polygons, "polygon_id"),
        "a polygon's geometry is no outline": needed.where(~V.is_area(F.col("geometry"))).select(F.col("polygon_id").cast("string").alias("offender")),
        "a row has no polygon": I.empty_keys(rows, "polygon_id"),
    }
    return checks | J.unmatched(rows, polygons, "polygon_id", "geometry")


def add_geometry(rows: DataFrame, polygons: DataFrame, *, validate: bool = True) -> DataFrame:
    """The rows with their polygons' ``geometry``; again on its own result it changes nothing."""
    outlines = polygons.select("polygon_id", "geometry")
    if validate:
        I.assert_all(geometry_checks(rows, outlines))
    return J.enrich(rows, outlines, "polygon_id", "geometry")


def write_geometry(rows: DataFrame, path: str, *, level: int = 19, group: int = 256) -> None:
    """Parquet for long texts that hardly repeat: strong zstd, no dictionary, row groups and pages of ``group`` rows; refuses to overwrite."""
    options = {"compression": "zstd", "parquet.compression.codec.zstd.level": str(level), "parquet.enable.dictionary": "false"}
    counts = dict.fromkeys(("parquet.block.row.count.limit", "parquet.page.row.count.limit", "parquet.page.size.row.check.min", "parquet.page.size.row.check.max"), str(group))
    rows.write.mode("error").options(**options, **counts).parquet(path)
