"""Connected components of an edge table, all on executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.storage import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, of every node on an edge.

    edges: long columns ``a`` and ``b``.  Alternates large-star and small-star
    steps, which shorten every path, until the edges are stars; each round is a
    table in the shared folder.  Minima are combined before the shuffle, and a
    node with very many edges is joined, never gathered.
    """

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(table: DataFrame) -> tuple:
        row = table.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).alias("s")).first()
        return row["n"], row["s"]

    now = materialize(ordered(edges), "edges")
    before = mark(now)
    while before[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now, old = materialize(ordered(small), "edges"), now
        discard(old)
        after = mark(now)
        if after == before:
            break
        before = after
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.union(now.select("b", "b").distinct())
