"""Line deduplication by the number of distinct sites a line stands on.

Each line's digest gets a HyperLogLog sketch of its sites; sketches merge by
aggregation.  A line whose estimate is so near the threshold that the sketch's
error could decide is counted exactly.  Lines on at least ``min_sites`` sites
are boilerplate: their first occurrence stays and all others go.

A line that occurs fewer times than the sites wanted needs no sketch, which
leaves few lines.  Counts, first places and sketches are combined before the
shuffle; occurrences of a frequent line meet its one row in a join that can be
split, and are never gathered.

Defined results: null and empty texts stay as they are; a text of any length is
taken whole; blank lines are never removed; a null site is a site of its own; a
null key ranks last; rows that repeat key and text are alike; documents stay even
if all their lines go; other columns may have any names; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.names import unused
from lexmill.storage import discard, materialize

MIN_SITES = 5
#: Sketches of 2**10 registers; estimates are off by more than 4 x 3.3 % in one of 15,000 lines.
SKETCH_BITS, ERROR = 10, 4 * 1.04 / 32
_LAST = (1 << 63) - 1


def normalise(line: str) -> str:
    return " ".join(line.lower().split())


def _lines(documents: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """``digest, k, h, line, site`` of every line that is not blank; ``line`` counts from 0."""
    source = documents.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("k"), F.xxhash64(F.col(text)).alias("h"), F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("")).alias("site"), F.col(text).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, of, places = [], [], []
            for row, value in enumerate(batch.column(3)):
                for place, line in enumerate((value.as_py() or "").split("\n")):
                    if plain := normalise(line):
                        digests.append(xxhash.xxh3_128_digest(plain.encode()))
                        of.append(row)
                        places.append(place)
            take = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column(0).take(take), batch.column(1).take(take), pa.array(places, pa.int32()), batch.column(2).take(take)], names=["digest", "k", "h", "line", "site"])

    return source.mapInArrow(cut, "digest binary, k long, h long, line int, site string")


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """``digest`` and ``first`` (key and line) of the lines on at least so many sites."""
    frequent = materialize(lines.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("k", "line")).alias("first")).where(F.col("n") >= min_sites).drop("n"), "frequent-lines")
    own = lines.select("digest", "site").join(frequent.select("digest"), "digest", "left_semi")
    sketched = materialize(own.groupBy("digest").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites")), "line-sites")
    low, high = min_sites * (1 - ERROR) - 1, min_sites * (1 + ERROR) + 1
    sure = sketched.where(F.col("sites") > high).select("digest")
    near = sketched.where(F.col("sites").between(low, high)).select("digest")
    exact = own.join(near, "digest", "left_semi").distinct().groupBy("digest").count().where(F.col("count") >= min_sites).select("digest")
    return frequent.join(sure.union(exact), "digest")


def drop_spread_lines(documents: DataFrame, *, key: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, places: str | None = None) -> DataFrame:
    """The documents without repeated lines that stand on at least ``min_sites`` sites.

    All columns stay.  places: the name of a column to add, or to replace, with
    the places, from 0, of removed lines (null if none went).
    """
    lines = materialize(_lines(documents, key, text, site), "lines")
    spread = spread_lines(lines, min_sites)
    k, h, gone, split = own = unused(documents, "k", "h", "gone", "split")
    removed = lines.join(spread, "digest").where(F.struct("k", "line") > F.col("first")).groupBy(F.col("k").alias(k), F.col("h").alias(h)).agg(F.array_sort(F.collect_set("line")).alias(gone))
    removed = materialize(removed, "removed-lines")
    discard(lines)
    marked = documents.withColumns({k: F.coalesce(F.col(key).cast("long"), F.lit(_LAST)), h: F.xxhash64(F.col(text))})
    all_, at = F.col(split), F.col(gone)
    # A column of its own, so a text is split once.
    joined = marked.join(removed, [k, h], "left").withColumn(split, F.when(at.isNotNull(), F.split(F.col(text), "\n", -1)))

    def between(i: Column) -> Column:
        """The lines from after the removed one before place i of the list to before the one at it."""
        first = F.coalesce(F.get(at, i - 1) + 1, F.lit(0))
        return F.slice(all_, first + 1, F.coalesce(F.get(at, i), F.size(all_)) - first)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(at)), between)), "\n")
    joined = joined.withColumn(text, F.when(at.isNotNull(), kept).otherwise(F.col(text)))
    return (joined if places is None else joined.withColumn(places, at)).drop(*own)
