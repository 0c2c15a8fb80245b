"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the output over its
share of the input.  Each document's count inverts the Poisson distribution of
that mean at a uniform number hashed from seed and key; the document is
exploded by its count and all copies are shuffled globally by a second hash.
No state is shared between rows, so the result does not depend on partitioning.

The distribution function is a table of ``STEPS`` steps a row; a row is found by
its source and one of ``SLICES`` slices of the unit interval, so no row grows
with the mean.  It joins the documents without their being gathered; the planner
broadcasts it only if its measured size allows, and splits a source that holds a
third of all rows otherwise.  The second hash is uniform, so equal ranges of it
are the output's partitions: nothing need be sampled.

Defined results: a null source is a source of its own; a null key counts as the
text ``null``; rows that repeat a key get the same count each; null, empty and
very long texts are documents like any other; a source without a target weight,
or with weight 0, is left out; an empty table gives an empty result; all columns
stay, but for one named ``copy``, which is replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.names import unused
from lexmill.storage import materialize

SEED = "mix-1"
#: Without target weights, sources weigh by their size to this power, which brings up small ones.
TEMPER = 0.7
STEPS, SLICES = 16, 64


def uniform(seed: str, *parts: Column) -> Column:
    """A number from 0 (included) to 1 by MD5: 52 bits, an exact double."""
    text = F.concat_ws("\x1f", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(documents: DataFrame, *, source: str = "source", weights: Mapping[str, float] | None = None, size: int | None = None) -> DataFrame:
    """``__source`` (a null-safe form) and ``__rate`` of each source.

    weights: target shares, of any sum; size: documents wanted, by default as many as there are.
    """
    counts = documents.groupBy(_safe(source).alias("__source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighed = counts.withColumn("w", F.pow("n", F.lit(TEMPER)))
    else:
        table = F.create_map(*[x for k, v in weights.items() for x in (F.lit("" if k is None else f"s{k}"), F.lit(float(v)))]) if weights else None
        weighed = counts.withColumn("w", F.lit(0.0) if table is None else F.coalesce(table[F.col("__source")], F.lit(0.0)))
    totals = weighed.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    if not totals["w"]:
        return weighed.where(F.lit(False)).select("__source", F.lit(0.0).alias("__rate"))
    wanted = totals["n"] if size is None else size
    return weighed.where("w > 0").select("__source", (F.col("w") / F.lit(float(totals["w"])) * F.lit(float(wanted)) / F.col("n")).alias("__rate"))


def _safe(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit(""))


def poisson_steps(table: DataFrame) -> DataFrame:
    """``__source, j, c``: the distribution function ``c`` at 0, 1, ... until it is 1 in doubles.

    Terms are summed in logarithms, so a mean of any size works.
    """
    last = (F.col("__rate") + 12 * F.sqrt("__rate") + 40).cast("int")
    term = table.withColumn("j", F.explode(F.sequence(F.lit(0), last)))
    own = Window.partitionBy("__source").orderBy("j")
    logs = term.withColumn("lf", F.sum(F.when(F.col("j") > 0, F.log(F.col("j").cast("double"))).otherwise(0.0)).over(own))
    mass = logs.withColumn("p", F.exp(F.col("j") * F.log("__rate") - F.col("__rate") - F.col("lf")))
    return mass.select("__source", "j", F.sum("p").over(own).alias("c"))


def step_rows(steps: DataFrame) -> DataFrame:
    """Rows ``source, slice, low, high, first, steps`` of up to ``STEPS`` steps each.

    A number u from low to below high is inverted by the row: to ``first`` and as
    many of its steps as are at most u.
    """
    rows = steps.groupBy("__source", F.floor(F.col("j") / STEPS).alias("part")).agg(F.array_sort(F.collect_list("c")).alias("steps"), F.max("c").alias("high"), F.min("j").alias("first"))
    own = Window.partitionBy("__source").orderBy("part")
    rows = rows.withColumn("low", F.lag("high", 1, 0.0).over(own)).withColumn("high", F.when(F.lead("part").over(own).isNull(), F.lit(2.0)).otherwise(F.col("high")))
    slice_of = lambda u: F.least(F.floor(u * SLICES), F.lit(SLICES - 1)).cast("int")
    return rows.where("low < high").select(F.col("__source").alias("source"), F.explode(F.sequence(slice_of(F.col("low")), slice_of(F.col("high")))).alias("slice"), "low", "high", "first", "steps")


def mix(documents: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", weights: Mapping[str, float] | None = None, size: int | None = None, seed: str = SEED) -> DataFrame:
    """The documents, each as often as its count, in globally shuffled order.

    All columns stay; ``copy`` counts a document's copies from 0 and replaces a
    column of that name.
    """
    # Written first: with a known size the planner need not shuffle the texts by source.
    steps = materialize(step_rows(poisson_steps(rates(documents, source=source, weights=weights, size=size))), "poisson-steps")
    kept = [c for c in documents.columns if c.lower() != "copy"]
    own, u, n, place = unused(documents, "source", "u", "n", "order")
    table = steps.toDF(*(names := unused(documents.withColumns({x: F.lit(0) for x in (own, u, n, place)}), *steps.columns)))
    of, slice_, low, high, first, values = (F.col(x) for x in names)
    drawn = documents.select(*kept, _safe(source).alias(own), uniform(seed, F.col(key)).alias(u))
    here = (F.col(own) == of) & (F.floor(F.col(u) * SLICES).cast("int") == slice_) & (F.col(u) >= low) & (F.col(u) < high)
    count = first + F.size(F.filter(values, lambda c: c <= F.col(u)))
    replicated = drawn.join(table, here).withColumn(n, count).where(F.col(n) > 0).select(*kept, F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int"))).alias("copy"))
    order = F.xxhash64(F.lit(seed), F.col(key), F.col("copy"), F.length(text))
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The top 31 bits of the hash, from the least number on, are the share of the range below it.
    part = F.shiftright((F.shiftright(F.col(place), 33) + (1 << 30)) * parts, 31).cast("int")
    return replicated.withColumn(place, order).repartitionById(parts, part).sortWithinPartitions(place).drop(place)
