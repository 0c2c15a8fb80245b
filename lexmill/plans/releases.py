"""Labelled releases: rows with their labels, what is counted on them, and both checked again.

There are two kinds.  ``two_labels`` has the five fields of the two-label
contract; ``place`` has a binary label with its log-probabilities, and may have
outlines.  A release is a folder of data, manifest and page that is written whole
or not at all; its check recomputes everything from the data.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.errors import PublicationError
from lexmill.functions import values as V
from lexmill.operators import analytics as A
from lexmill.operators import geometry as G
from lexmill.operators import integrity as I
from lexmill.operators import joins as J
from lexmill.plans.labelling import score_faults
from lexmill.schemas import contract
from lexmill.sources import export, files
from lexmill.streaming.batches import check_timing

KINDS = {"two_labels": "labels", "place": "scores"}
OPTIONAL = {"polygon_id": "string", "source": "string", "osm_primary_tag": "string", "language": "string"}
LABELS = ("landuse_relevance", "polygon_relevance")
REASONS = ("landuse_reason", "polygon_reason")


def label_faults(rows: DataFrame) -> DataFrame:
    """Rows whose labels are unknown, whose reasons don't go with them, or whose evidence is too long or not in the sentence."""
    bad = F.lit(False)
    for name in ("landuse", "polygon"):
        fits = F.lit(False)
        for mark, reasons in V.REASONS[name].items():
            fits = fits | ((F.col(f"{name}_relevance") == mark) & F.col(f"{name}_reason").isin(*reasons))
        bad = bad | ~F.coalesce(fits, F.lit(False))
    evidence = F.col("evidence")
    bad = bad | evidence.isNull() | (F.length(evidence) > V.LONGEST_EVIDENCE)
    if "sentence_text_raw" in rows.columns:
        bad = bad | ((evidence != "") & ~F.coalesce(F.contains(F.col("sentence_text_raw"), evidence), F.lit(False)))
    return rows.where(bad).select(F.col("sentence_id").cast("string").alias("offender"))


def label_tables(rows: DataFrame, least: int = A.MIN_SLICE) -> dict[str, DataFrame]:
    """What is shown of two-label rows: pairs of labels, the funnel of places, reasons, slices, languages of positives."""
    rows = J.with_columns_or_null(rows, **OPTIONAL)
    reasons = [A.histogram(rows, c, "reason").select(F.lit(c).alias("field"), "reason", "n", "share") for c in REASONS]
    positive = rows.where(F.col("landuse_relevance") == "yes")
    return {
        "joint": A.joint_label_counts(rows, *LABELS),
        "coverage": A.coverage_funnel(rows, "polygon_id", *LABELS),
        "reasons": reasons[0].unionByName(reasons[1]),
        "slices": A.slice_yields(rows, *LABELS, least=least),
        "positive_languages": A.histogram(positive, "language", "language").select("language", "n"),
    }


def score_tables(rows: DataFrame, cell: str = "cell") -> dict[str, DataFrame]:
    rows = J.with_columns_or_null(rows, area_bucket="string", lat="double", lon="double", **{cell: "string"})
    return {"totals": A.binary_analytics(rows, cell=cell), "area_buckets": A.histogram(rows, "area_bucket", "area_bucket"), "coordinates": A.coordinates(rows)}


def _facts(rows: DataFrame, kind: str) -> dict:
    tables = label_tables(rows) if kind == "two_labels" else score_tables(rows)
    out = {name: sorted((r.asDict() for r in df.collect()), key=lambda r: json.dumps(r, sort_keys=True)) for name, df in tables.items()}
    return json.loads(export.canonical_json({"row_count": rows.count(), **out}))


def _checks(rows: DataFrame, kind: str) -> dict[str, DataFrame]:
    checks = {"a sentence has no key": I.empty_keys(rows, "sentence_id"), "a sentence repeats": I.duplicate_keys(rows, "sentence_id")}
    if kind == "two_labels":
        checks["a label breaks the contract"] = label_faults(rows)
    else:
        checks["a score doesn't fit its log-probabilities"] = score_faults(rows)
    if "geometry" in rows.columns:
        checks["a geometry is no outline"] = rows.where(~V.is_area(F.col("geometry"))).select(F.col("sentence_id").alias("offender"))
    return checks


def page(manifest: dict) -> str:
    """The page of a release, from its manifest alone."""
    facts = manifest["statistics"]
    lines = [f"# {manifest['name']}", "", f"{facts['row_count']} labelled sentences, revision {manifest['identity'].get('revision', 'unknown')}.", ""]
    for name in sorted(k for k, v in facts.items() if isinstance(v, list) and v):
        columns = sorted(facts[name][0])
        lines += [f"## {name}", "", "| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
        lines += ["| " + " | ".join(str(r[c]).replace("|", "\\|").replace("\n", " ") for c in columns) + " |" for r in facts[name]] + [""]
    return "\n".join(lines)


def finalize(rows: DataFrame, results: DataFrame, target: str, *, kind: str, name: str, identity: dict, timing: dict | None = None, regions: tuple[int, int] | None = None, polygons: DataFrame | None = None, overwrite: bool = False) -> dict:
    """Join each row with its one result, count, write, and check what stands there.

    regions: least and most distinct regions, as a release is of one region or of
    the world.  polygons: outlines to add.  A release that stands is replaced only
    by one of the same identity that has no fewer rows.
    """
    if not name or name != name.strip():
        raise ValueError("the name is blank or has white space around it")
    if timing is not None:
        check_timing(timing)
    spark = rows.sparkSession
    I.assert_all(J.label_checks(rows, results))
    table = J.join_labels(rows, results.select(*contract(KINDS[kind]).names))
    if polygons is not None:
        table = G.add_geometry(table, polygons)
    if regions is not None:
        found = table.where(F.col("region").isNotNull() & (V.stripped(F.col("region")) != "")).select(F.regexp_replace(V.stripped(F.col("region")), "-latest$", "")).distinct().limit(regions[1] + 1).count()
        if not regions[0] <= found <= regions[1]:
            raise PublicationError(f"{found} regions, not {regions[0]} to {regions[1]}")
    I.assert_all(_checks(table, kind))
    manifest = {"kind": kind, "name": name, "identity": identity, "timing": timing, "statistics": _facts(table, kind), "content_sha256": export.content_hash(table), "geometry": "GeoJSON" if "geometry" in table.columns else None}
    if overwrite and files.exists(spark, target):
        old = json.loads(files.read_text(spark, f"{target}/manifest.json"))
        if old["identity"] != json.loads(export.canonical_json(identity)) or old["statistics"]["row_count"] > manifest["statistics"]["row_count"]:
            raise PublicationError("what stands there is of another run or larger")
    ordered = table.repartitionByRange("sentence_id").sortWithinPartitions("sentence_id")
    export.swap(ordered, target, overwrite=overwrite, manifest_json=export.canonical_json(manifest), README_md=page(json.loads(export.canonical_json(manifest))))
    validate(spark, target)
    return manifest


def validate(spark: SparkSession, target: str) -> dict:
    """Recompute a release's manifest and page from its data."""
    names = {n for n, _, _ in files.children(spark, target)}
    if names != {"data", "manifest.json", "README.md"}:
        raise PublicationError(f"{target} holds {sorted(names)}")
    said = json.loads(files.read_text(spark, f"{target}/manifest.json"))
    rows = spark.read.parquet(f"{target}/data")
    if said.get("kind") not in KINDS:
        raise PublicationError(f"unknown kind {said.get('kind')!r}")
    if missing := sorted(set(contract(KINDS[said["kind"]]).names) - set(rows.columns)):
        raise PublicationError(f"columns are missing: {missing}")
    if said["geometry"] != ("GeoJSON" if "geometry" in rows.columns else None):
        raise PublicationError("the geometry is not what the manifest says")
    if said["timing"] is not None:
        check_timing(said["timing"])
    I.assert_all(_checks(rows, said["kind"]))
    facts = _facts(rows, said["kind"])
    if differing := sorted(k for k in facts.keys() | said["statistics"].keys() if facts.get(k) != said["statistics"].get(k)):
        raise PublicationError(f"statistics differ: {differing}")
    if said["content_sha256"] != export.content_hash(rows):
        raise PublicationError("rows differ from the manifest")
    if files.read_text(spark, f"{target}/README.md") != page(said):
        raise PublicationError("the page differs from the manifest")
    return said
