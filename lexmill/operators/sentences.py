"""From sections to unique sentences with context and stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions import values as V

SECTION = ("polygon_id", "source", "document_id", "section_id")
GROUP = ("polygon_id", "language", "sentence_text_normalized")
SOURCE_ORDER = ("wikipedia", "wikivoyage")


def prepare_sections(sections: DataFrame, text: str, language: str, segmenter: T.Segmenter = T.split_lines) -> DataFrame:
    """Add ``prepared``: a section's sentences and counts of what was dropped."""
    return sections.withColumn("prepared", T.prepared(F.col(text), F.col(language), segmenter))


def explode_sentences(prepared: DataFrame) -> DataFrame:
    """A row for each sentence, with its place among those that stayed."""
    return prepared.select("*", F.posexplode("prepared.sentences").alias("place", "sentence")).select(
        *[c for c in prepared.columns if c != "prepared"],
        F.col("place").cast("long").alias("sentence_index"),
        F.col("sentence.raw").alias("sentence_text_raw"),
        F.col("sentence.normalized").alias("sentence_text_normalized"),
    )


def segmentation_report(prepared: DataFrame, source: str = "source") -> DataFrame:
    """Counts by source; their sums are the whole's."""
    p = "prepared"
    return prepared.groupBy(source).agg(
        F.count("*").alias("sections"),
        F.sum(f"{p}.emitted").alias("emitted"),
        F.sum(F.size(f"{p}.sentences")).cast("long").alias("retained"),
        F.sum(f"{p}.dropped_raw").alias("dropped_raw"),
        F.sum(f"{p}.dropped_normalized").alias("dropped_normalized"),
    )


def observed_report(prepared: DataFrame, sources: tuple[str, ...] = SOURCE_ORDER, source: str = "source") -> tuple[DataFrame, Observation]:
    """The rows, and an observation of ``segmentation_report``'s counts by source that the job which writes them fills."""
    seen, counts = Observation(), []
    for k, name in enumerate(sources):
        of = lambda value, k=k, name=name: F.sum(F.when(F.col(source) == name, value).otherwise(0))
        values = {"sections": F.lit(1), "emitted": F.col("prepared.emitted"), "retained": F.size("prepared.sentences"), "dropped_raw": F.col("prepared.dropped_raw"), "dropped_normalized": F.col("prepared.dropped_normalized")}
        counts += [of(v).cast("long").alias(f"{what}_{k}") for what, v in values.items()]
    return prepared.observe(seen, *counts), seen


def reported(seen: Observation, sources: tuple[str, ...] = SOURCE_ORDER) -> dict[str, dict]:
    """The counts of each source that has sections."""
    found = seen.get
    kinds = ("sections", "emitted", "retained", "dropped_raw", "dropped_normalized")
    return {name: {"source": name} | {what: found[f"{what}_{k}"] for what in kinds} for k, name in enumerate(sources) if found[f"sections_{k}"]}


def stable(rows: DataFrame, *but: str) -> list[Column]:
    """All columns by name: a total order of rows that are equal in all else.  Maps, which have none, go as JSON."""
    kinds = dict(rows.dtypes)
    return [F.to_json(c) if "map<" in kinds[c] else F.col(c) for c in sorted(rows.columns) if c not in but]


def add_context(rows: DataFrame, keys: tuple[str, ...] = SECTION, index: str = "sentence_index", text: str = "sentence_text_normalized") -> DataFrame:
    """The sentences before and after in the section; do it before removing duplicates."""
    own = Window.partitionBy(*keys).orderBy(index, *stable(rows, *keys, index))
    return rows.withColumn("previous_sentence", F.lag(text).over(own)).withColumn("next_sentence", F.lead(text).over(own))


def source_rank(source: str = "source"):
    return F.when(F.col(source) == SOURCE_ORDER[0], 0).otherwise(1)


def first_order(source: str = "source") -> list[Column]:
    """By which the first occurrence of a group is chosen."""
    return [source_rank(source), F.col("document_id"), F.col("section_index"), F.col("section_id"), F.col("sentence_index")]


def deduplicate(rows: DataFrame, keys: tuple[str, ...] = GROUP, order: list | None = None, source: str = "source") -> DataFrame:
    """The first occurrence of each group, with how many there were and from which sources.

    The choice is an aggregate minimum, combined before the shuffle: a sentence
    that occurs very often costs a row a task, not a sorted group in one task.
    """
    order = order or first_order(source)
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate([*order, *stable(rows, *keys, "previous_sentence", "next_sentence")])])
    rest = [c for c in rows.columns if c not in keys]
    grouped = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), ranked).alias("first"), F.count("*").alias("duplicate_occurrence_count"), F.array_sort(F.collect_set(source)).alias("duplicate_sources"))
    return grouped.select(*keys, *[F.col(f"first.{c}").alias(c) for c in rest], "duplicate_occurrence_count", "duplicate_sources")


def add_ids(rows: DataFrame, text: str = "sentence_text_normalized") -> DataFrame:
    hashed = rows.withColumn("sentence_content_hash", V.content_hash(F.col(text)))
    return hashed.withColumn("sentence_id", V.sentence_id(F.col("polygon_id"), F.col("language"), F.col("sentence_content_hash")))


def finalization_report(unique: DataFrame) -> DataFrame:
    """Rows in, out and removed, and groups that both sources share."""
    n = "duplicate_occurrence_count"
    cross = F.array_contains("duplicate_sources", SOURCE_ORDER[0]) & F.array_contains("duplicate_sources", SOURCE_ORDER[1])
    return unique.agg(F.coalesce(F.sum(n), F.lit(0)).alias("input_rows"), F.count("*").alias("output_rows"), F.coalesce(F.sum(F.col(n) - 1), F.lit(0)).alias("removed_rows"), F.count_if(cross).alias("cross_source_groups"))
