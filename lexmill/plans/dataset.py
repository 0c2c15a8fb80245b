"""From input shards to a published dataset of sentences."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.errors import PublicationError, SourceError
from lexmill.functions import text as X
from lexmill.functions import values as V
from lexmill.operators import analytics as A
from lexmill.operators import integrity as I
from lexmill.operators import joins as J
from lexmill.operators import sentences as N
from lexmill.plans.card import card, out_of_order
from lexmill.schemas import contract
from lexmill.sources import export, files, shards
from lexmill.storage import materialize
from lexmill.streaming.batches import run_batches

MANIFEST_VERSION = 3
MANIFEST = frozenset({"manifest_version", "row_count", "schema", "finalization", "segmentation", "statistics", "profile", "content_sha256"})
#: How published rows are ordered, strictly.
ORDER = ("polygon_id", "language", "sentence_id")
_BREAKDOWNS = ("source", "language", "region")


@dataclass
class Sentences:
    rows: DataFrame
    segmentation: dict
    finalization: dict


def occurrences(spark: SparkSession, root: str, *, validate: bool = True) -> DataFrame:
    """Joined sections of all shards, after the checks on keys and references."""
    found = shards.discover(spark, root)
    if not found:
        raise SourceError(f"no shards below {root}")
    table = {name: shards.load_all(spark, found, name) for name in shards.FOLDERS if name != "links"}
    layouts = shards.load_links(spark, found)
    checks, parts = J.layout_checks([*layouts.values()], table["wikipedia_documents"]), []
    # Shards may link by document or by article: each layout is joined by its own key.
    for name, links in layouts.items():
        core = (table["polygons"], links, table["wikipedia_documents"], table["wikipedia_sections"])
        checks |= {f"{what} ({name})" if len(layouts) > 1 else what: offenders for what, offenders in J.encyclopedia_checks(*core).items()}
        parts.append(J.encyclopedia_occurrences(*core))
    if table["wikivoyage_documents"] is not None:
        travel = (table["polygons"], table["wikivoyage_documents"], table["wikivoyage_sections"])
        checks |= J.travel_checks(*travel)
        parts.append(J.travel_occurrences(*travel))
    if validate:
        checks["a polygon is outside its shard's namespace"] = I.outside_namespace(table["polygons"], "polygon_id", "shard_key")
        I.assert_all(checks)
    return J.compose(*parts)


def segment(joined: DataFrame, segmenter: X.Segmenter = X.split_lines, *, validate: bool = True, resume: tuple[str, dict, int] | None = None) -> tuple[DataFrame, dict]:
    """Sentences of joined sections, and the counts of what was dropped.

    resume: a folder, the run's identity and a number of batches; a run that
    broke off goes on after the batches that are there.
    """
    parsed = joined.withColumns({"section_path": V.string_list(F.col("section_path_raw")), "osm_tags": V.string_map(F.col("osm_tags_raw"))})
    if validate:
        I.assert_all({
            "section_path is no list of strings": parsed.where("section_path IS NULL").select(F.col("section_id").alias("offender")),
            "osm_tags is no map of strings": parsed.where("osm_tags IS NULL").select(F.col("polygon_id").alias("offender")),
        })
    work = lambda part: N.prepare_sections(part, "section_text_raw", "language", segmenter)
    if resume is None:
        rows, seen = N.observed_report(work(parsed))
        prepared = materialize(rows, "prepared")
        counts = N.reported(seen)
    else:
        root, identity, batches = resume
        keyed = parsed.withColumn("occurrence", F.to_json(F.struct(*N.SECTION)))
        prepared = run_batches(keyed, root, identity, work, batches=batches, key="occurrence").drop("occurrence")
        counts = {r["source"]: r.asDict() for r in N.segmentation_report(prepared).collect()}
    return N.explode_sentences(prepared).select(*contract("segmented_sentences").names), counts


def finalize(segmented: DataFrame, *, revision: str, version: str) -> DataFrame:
    """Context, then unique sentences with ids, in the output's columns."""
    unique = N.add_ids(N.deduplicate(N.add_context(segmented)))
    return unique.withColumns({"osm_tags": V.sorted_tags(F.col("osm_tags")), "input_dataset_revision": F.lit(revision), "pipeline_version": F.lit(version)}).select(*contract("sentences").names)


def build(spark: SparkSession, root: str, *, revision: str, version: str, segmenter: X.Segmenter = X.split_lines, validate: bool = True, resume: tuple[str, dict, int] | None = None) -> Sentences:
    """The whole run.  Duplicates are removed over all shards at once."""
    segmented, counts = segment(occurrences(spark, root, validate=validate), segmenter, validate=validate, resume=resume)
    if validate:
        I.assert_all({"source is unknown": I.outside(segmented, "source", J.SOURCES)})
    rows = materialize(finalize(segmented, revision=revision, version=version), "sentences")
    return Sentences(rows, counts, N.finalization_report(rows).first().asDict())


def statistics(rows: DataFrame) -> dict:
    """Everything the manifest says about the rows, recomputed from them."""
    facts = A.dataset_statistics(rows).first().asDict()
    for r in A.breakdown(rows, *_BREAKDOWNS).orderBy("dimension", "value").collect():
        facts.setdefault(f"counts_by_{r['dimension']}", {})[r["value"]] = r["n"]
    return facts


def identities(facts: dict) -> None:
    """Sums that must hold in any dataset."""
    n = facts["row_count"]
    wrong = [f"{k} is {facts[k]} of {n}" for k in ("sentences", "polygons", "wikidata_ids", "documents") if facts[k] > n]
    if facts["with_coordinates"] + facts["without_coordinates"] != n:
        wrong.append("coordinates don't sum up")
    wrong += [f"{d} doesn't sum up" for d in _BREAKDOWNS if sum(facts.get(f"counts_by_{d}", {}).values()) != n]
    if facts["sentences"] != n:
        wrong.append("sentence ids repeat")
    if wrong:
        raise PublicationError("; ".join(wrong))


def profile(rows: DataFrame) -> dict:
    """Extents, lengths, boundaries that are left, and the first row in order."""
    first = rows.orderBy(*ORDER).limit(1).select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})).first()
    return {**A.dataset_profile(rows).first().asDict(), "residual_boundaries": residual_boundaries(rows), "example": json.loads(first[0]) if first else None}


def manifest(built: Sentences) -> dict:
    facts = statistics(built.rows)
    identities(facts)
    schema = [[f.name, f.dataType.simpleString()] for f in built.rows.schema]
    return {"manifest_version": MANIFEST_VERSION, "row_count": facts["row_count"], "schema": schema, "finalization": built.finalization, "segmentation": built.segmentation, "statistics": facts, "profile": profile(built.rows), "content_sha256": export.content_hash(built.rows)}


def publish(built: Sentences, target: str, *, overwrite: bool = False) -> dict:
    """Write rows in order with their manifest, then check what stands there."""
    rows = export.check_output(built.rows)
    data = manifest(built)
    ordered = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    export.swap(ordered, target, overwrite=overwrite, manifest_json=export.canonical_json(data), README_md=card(data))
    validate(rows.sparkSession, target)
    return data


def residual_boundaries(rows: DataFrame) -> int:
    """Boundaries of which there is no doubt that are still inside sentences; 0 in a good dataset."""
    offsets = X.boundary_offsets(F.col("sentence_text_normalized"), F.col("language"))
    return rows.agg(F.sum(F.size(offsets))).first()[0] or 0


def accounting(said: dict) -> None:
    """What segmentation put out is what finalization took in."""
    whole = {name: sum(c[name] for c in said["segmentation"].values()) for name in ("emitted", "retained", "dropped_raw", "dropped_normalized")}
    if whole["emitted"] != whole["retained"] + whole["dropped_raw"] + whole["dropped_normalized"]:
        raise PublicationError(f"segmentation doesn't sum up: {whole}")
    if whole["retained"] != said["finalization"]["input_rows"]:
        raise PublicationError(f"segmentation kept {whole['retained']} sentences, finalization took {said['finalization']['input_rows']}")


def file_order(rows: DataFrame) -> DataFrame:
    """Rows of a table of part files, with their ``place`` in the order of files and rows."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-([0-9]+)", 1).cast("long")
    return rows.withColumn("place", F.shiftleft(number, 33) + F.col("_metadata.row_index"))


def _differing(name: str, said: dict, found: dict) -> None:
    """Compare part by part, as the manifest's JSON has them."""
    found = json.loads(export.canonical_json(found))
    if wrong := sorted(k for k in found.keys() | said.keys() if found.get(k) != said.get(k)):
        raise PublicationError(f"{name} differ{'s' if name == 'profile' else ''}: {wrong}")


def validate(spark: SparkSession, target: str, *, boundaries: bool = True) -> None:
    """Recompute from the published rows all that their manifest says.

    What the rows no longer hold, how sentences were cut, must agree with what
    they hold: the sentences kept are the occurrences before duplicates went.
    """
    names = {n for n, _, _ in files.children(spark, target)}
    if names != {"data", "manifest.json", "README.md"}:
        raise PublicationError(f"{target} holds {sorted(names)}")
    said = json.loads(files.read_text(spark, f"{target}/manifest.json"))
    if wrong := sorted(said.keys() ^ MANIFEST):
        raise PublicationError(f"the manifest lacks or adds {wrong}")
    if said["manifest_version"] != MANIFEST_VERSION:
        raise PublicationError(f"the manifest is of version {said['manifest_version']}")
    if files.read_text(spark, f"{target}/README.md") != card(said):
        raise PublicationError("the page differs from the manifest")
    rows = spark.read.parquet(f"{target}/data")
    schema = [[f.name, f.dataType.simpleString()] for f in rows.schema]
    if schema != said["schema"] or schema != [[f.name, f.dataType.simpleString()] for f in contract("sentences")]:
        raise PublicationError("the rows' columns differ from the manifest's or the contract's")
    facts = statistics(rows)
    _differing("statistics", said["statistics"], facts)
    identities(facts)
    if rows.select("input_dataset_revision", "pipeline_version").distinct().limit(2).count() > 1:
        raise PublicationError("rows are of more than one revision or version")
    if said["row_count"] != facts["row_count"] or said["content_sha256"] != export.content_hash(rows):
        raise PublicationError("rows differ from the manifest")
    _differing("finalization counts", said["finalization"], N.finalization_report(rows).first().asDict())
    accounting(said)
    found = profile(rows)
    _differing("profile", said["profile"], found)
    if boundaries and found["residual_boundaries"]:
        raise PublicationError(f"{found['residual_boundaries']} boundaries are left inside sentences")
    if misplaced := out_of_order(file_order(rows), *ORDER, order="place").select("sentence_id").limit(I.SHOWN).collect():
        raise PublicationError(f"rows are not in order: {[r[0] for r in misplaced]}")
