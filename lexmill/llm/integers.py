"""Vectors as integers: each component times a power of two, rounded down.

Rows that are null or hold a null, NaN or infinite component are left out, as
are empty ones, those of another length than most, and those whose integers'
squares sum to ``TOO_LONG`` or more, since sums of products would leave a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOO_LONG = 2.0**58
#: Whole numbers up to here are exact in double precision.
EXACT = 2.0**52


def finite(vector: Column) -> Column:
    """Whether a vector has components and all are finite numbers."""
    infinity = F.lit(float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < infinity), F.lit(False))), F.lit(False))


def integer_vectors(vectors: DataFrame, vector: str, scale: int, **kept: Column) -> tuple[DataFrame, int]:
    """``kept`` columns and ``v array<int>``, all of the returned length; 0 if no row stays."""
    rows = vectors.select(F.col(vector).cast("array<double>").alias("x"), *(c.alias(name) for name, c in kept.items())).where(finite(F.col("x")))
    rows = rows.withColumn("x", F.transform("x", lambda x: F.floor(x * F.lit(float(scale))).cast("double")))
    rows = rows.where(F.aggregate("x", F.lit(0.0), lambda total, x: total + x * x) < TOO_LONG)
    common = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    if common is None:
        return rows.select(*kept, F.col("x").cast("array<int>").alias("v")), 0
    return rows.where(F.size("x") == common["size"]).select(*kept, F.col("x").cast("array<int>").alias("v")), common["size"]


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of integers, without rounding: in double precision where it can't round."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] >= EXACT:
        return a @ b.T
    return a.astype(np.float64) @ b.astype(np.float64).T
