"""Integrity checks: lazy tables of offenders, and one job that asserts many of them.

A check's result has one column, ``offender``.  Keys are compared null-safe, as
two missing values agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.errors import IntegrityError

SHOWN = 5


def _text(*columns: Column) -> Column:
    return F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("(null)")) for c in columns]).alias("offender")


def empty_keys(df: DataFrame, key: str) -> DataFrame:
    k = F.col(key)
    return df.where(k.isNull() | (k.cast("string") == "")).select(_text(k))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys, without nulls, of more than one row."""
    whole = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return whole.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(_text(*[F.col(k) for k in keys]))


def bad_indexes(df: DataFrame, index: str) -> DataFrame:
    i = F.col(index)
    return df.where(i.isNull() | (i < 0)).select(_text(i))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Children's keys that no parent has."""
    own = child.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("__k")).distinct()
    return own.join(parent.select(F.col(parent_key).cast("string").alias("__k")), "__k", "left_anti").select(_text(F.col("__k")))


def mismatches(joined: DataFrame, agrees: Column, *shown: Column) -> DataFrame:
    """Rows of a join of two tables that don't agree."""
    return joined.where(~F.coalesce(agrees, F.lit(False))).select(_text(*shown))


def outside(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    c = F.col(column)
    return df.where(c.isNull() | ~c.isin(*allowed)).select(_text(c))


def inconsistent(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Keys whose rows differ in columns that should be the key's own."""
    own = F.struct(*columns)
    return df.groupBy(key).agg(F.min(own).alias("__a"), F.max(own).alias("__b")).where(~F.col("__a").eqNullSafe(F.col("__b"))).select(_text(F.col(key)))


def outside_namespace(df: DataFrame, key: str, shard: str) -> DataFrame:
    return df.where(~F.coalesce(F.startswith(F.col(key), F.concat(F.col(shard), F.lit(":"))), F.lit(False))).select(_text(F.col(key)))


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    """``check``, ``n`` and up to five sorted ``samples`` of each check that fails, in one job."""
    parts = [df.select(F.lit(name).alias("check"), "offender") for name, df in checks.items()]
    every = reduce(DataFrame.unionByName, parts)
    # Distinct offenders are ranked before they are listed, so a check that all rows fail gathers five.
    counted = every.groupBy("check", "offender").agg(F.count("*").alias("n"))
    total = counted.groupBy("check").agg(F.sum("n").alias("n"))
    first = counted.withColumn("r", F.row_number().over(Window.partitionBy("check").orderBy("offender"))).where(F.col("r") <= SHOWN)
    return total.join(first.groupBy("check").agg(F.array_sort(F.collect_list("offender")).alias("samples")), "check")


def assert_all(checks: dict[str, DataFrame]) -> None:
    """Raise for the first check, in the order given, that has offenders."""
    if not checks:
        return
    failed = {r["check"]: r for r in summary(checks).collect()}
    for name in checks:
        if name in failed:
            raise IntegrityError(f"{name} ({failed[name]['n']} rows)", failed[name]["samples"])
