"""The page that describes a published dataset, and small rules around it."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.errors import PublicationError
from lexmill.functions.values import stripped

_CELL = {ord(c): f"&#{ord(c)};" for c in "|\\\r\n\t"} | {ord("&"): "&amp;"}


def cell(text: str) -> str:
    """Text that can't break a Markdown table."""
    return text.translate(_CELL)


def code(text: str) -> str:
    """Text that can't break inline code either."""
    return text.translate(_CELL | {ord("`"): "&#96;"})


def tree_url(host: str, dataset: str, revision: str) -> str:
    """A revision's page: slashes part the dataset's name, but not the revision's."""
    return f"{host}/datasets/{quote(dataset, safe='/')}/tree/{quote(revision, safe='')}"


def scope(regions: Collection[str | None]) -> str:
    """A dataset's region as a title; "Global" for several, "Dataset" for none."""
    names = {r.strip() for r in regions if r and r.strip()}
    if len(names) != 1:
        return "Global" if names else "Dataset"
    return names.pop().removesuffix("-latest").translate({ord("_"): " ", ord("-"): " "}).title() or "Dataset"


def scope_of(rows: DataFrame, column: str = "region") -> str:
    """``scope`` of a table; at most two regions reach the driver."""
    named = rows.select(stripped(F.col(column)).alias("r")).where("r <> ''").distinct().limit(2)
    return scope([r["r"] for r in named.collect()])


def padded(low: float, high: float) -> tuple[float, float]:
    """An extent with a margin of a twentieth, or of 0.1 at least."""
    margin = max((high - low) / 20, 0.1)
    return low - margin, high + margin


def shard_key(region: str) -> str:
    return region if region.endswith("-latest") else f"{region}-latest"


def check_target(recorded: int | None, asked: int) -> bool:
    """Whether a sample grows; a recorded target never shrinks."""
    if recorded is not None and asked < recorded:
        raise PublicationError(f"the sample has {recorded} rows already and can't shrink to {asked}")
    return recorded is not None and asked > recorded


def out_of_order(rows: DataFrame, *columns: str, order: str, slice_rows: int = 1_000_000) -> DataFrame:
    """Rows, by their place ``order``, that don't come strictly after the one before.

    order: a whole number for each row, rising through the file.  Rows are compared in slices of it, and
    each slice's first row with the last of the slice before it, so no task holds more than a slice.
    """
    whole = F.struct(*columns)
    sliced = rows.withColumn("__slice", F.floor(F.col(order) / slice_rows))
    ends = sliced.groupBy("__slice").agg(F.max_by(whole, order).alias("__last"))
    # A row for each slice.
    ends = ends.withColumn("__last", F.lag("__last").over(Window.orderBy("__slice")))
    inside = F.lag(whole).over(Window.partitionBy("__slice").orderBy(order))
    before = F.coalesce(F.col("__inside"), F.col("__last"))
    found = sliced.withColumn("__inside", inside).join(ends, "__slice").where(before.isNotNull() & ~(whole > before))
    return found.drop("__inside", "__last", "__slice")


def yaml_text(text: str) -> str:
    """A text as a double-quoted YAML scalar."""
    return '"' + "".join({'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t"}.get(c, c if c.isprintable() else f"\\U{ord(c):08X}") for c in text) + '"'


def _counts(title: str, counts: Mapping[str, int]) -> str:
    if not counts:
        return f"### {title}\n\n_No values._\n"
    return f"### {title}\n\n| Value | Rows |\n| --- | --- |\n" + "".join(f"| {cell(k)} | {n} |\n" for k, n in sorted(counts.items()))


def card(manifest: Mapping) -> str:
    """The page; the same manifest always gives the same bytes."""
    facts, profile = manifest["statistics"], manifest["profile"]
    rows = [
        ("Sentences", facts["row_count"]),
        ("Occurrences before removing duplicates", manifest["finalization"]["input_rows"]),
        ("Duplicates removed", manifest["finalization"]["removed_rows"]),
        ("Places", facts["polygons"]),
        ("Documents", facts["documents"]),
        ("With coordinates", facts["with_coordinates"]),
        ("Longest sentence", profile["max_length"]),
    ]
    parts = [f"# {cell(scope(list(facts.get('counts_by_region', {}))))} sentences\n", "| Fact | Value |\n| --- | --- |\n" + "".join(f"| {k} | {v} |\n" for k, v in rows)]
    parts += [_counts(name.capitalize(), facts.get(f"counts_by_{name}", {})) for name in ("source", "language", "region")]
    return "\n".join(parts) + f"\nContent hash: `{code(manifest['content_sha256'])}`\n"
