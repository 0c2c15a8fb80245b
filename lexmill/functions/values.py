"""Hashes, strict JSON, tags, scores, buckets: built-in functions only unless they say otherwise."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.errors import SchemaError

MISSING = "(missing)"
#: Area buckets in km2: name and upper bound.
BUCKETS = (("tiny", 0.1), ("small", 1.0), ("medium", 10.0), ("large", float("inf")))
# Labels in use upstream, with their ranges in km2.
SOURCE_RANGES = {
    "<100m2": (0.0, 0.0001), "100m2-1k_m2": (0.0001, 0.001), "1k_m2-10k_m2": (0.001, 0.01), "10k_m2-100k_m2": (0.01, 0.1),
    "0.1-1km2": (0.1, 1.0), "1-10km2": (1.0, 10.0), "10-100km2": (10.0, 100.0), ">100km2": (100.0, float("inf")),
    "tiny": (0.0, 0.1), "small": (0.1, 1.0), "medium": (1.0, 10.0), "large": (10.0, float("inf")),
}


#: All that counts as white space at the ends of a value, as in Python.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def content_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def sentence_id(polygon_id: Column, language: Column, hash_: Column) -> Column:
    """SHA-256 of the canonical JSON of what makes a sentence what it is."""
    body = F.struct(language.alias("language"), polygon_id.alias("polygon_id"), hash_.alias("sentence_content_hash"), F.lit(1).alias("version"))
    return F.sha2(F.to_json(body), 256)


def seeded_rank(seed: str, value: Column) -> Column:
    """A uniform, stable order: SHA-256 of seed, NUL, value."""
    return F.sha2(F.concat(F.lit(f"{seed}\0"), value.cast("string")), 256)


def or_missing(value: Column) -> Column:
    text = stripped(value.cast("string"))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(MISSING))


def qids(value: Column) -> Column:
    """The set in a list of identifiers separated by semicolons."""
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), ";"), lambda x: stripped(x)), lambda x: x != "")


def qids_match(a: Column, b: Column) -> Column:
    """Neither is empty, and one holds the other."""
    x, y = qids(a), qids(b)
    return (F.size(x) > 0) & (F.size(y) > 0) & ((F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0))


def sorted_tags(tags: Column) -> Column:
    """A map as a list of key and value, by key."""
    return F.array_sort(F.map_entries(tags))


def tag_pairs(tags: Column, kind: T.DataType) -> Column:
    """Tags in any of their forms as a list of key and value, by key; see ``bad_tags``.

    kind: the column's type: a map, a struct of named tags, or a list of pairs
    whose fields have any names.  Other types, and pairs of other than strings,
    are an error.
    """
    text = T.StringType()
    if isinstance(kind, T.MapType) and kind.keyType == kind.valueType == text:
        return sorted_tags(tags)
    if isinstance(kind, T.StructType) and all(f.dataType == text for f in kind):
        pairs = [F.when(tags[n].isNotNull(), F.struct(F.lit(n).alias("key"), tags[n].alias("value"))) for n in kind.names]
        return F.when(tags.isNotNull(), F.array_sort(F.filter(F.array(*pairs), lambda x: x.isNotNull())))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        names = kind.elementType.names
        key, value = ("key", "value") if {"key", "value"} <= set(names) else (names + [""])[:2]
        if kind.elementType[key].dataType == kind.elementType[value].dataType == text and (len(names) == 2 or key == "key"):
            return F.array_sort(F.transform(tags, lambda x: F.struct(x[key].alias("key"), x[value].alias("value"))))
    raise SchemaError(f"tags can't be {kind.simpleString()}")


def bad_tags(pairs: Column) -> Column:
    """Whether a list of ``tag_pairs`` has a missing key or value."""
    return F.coalesce(F.exists(pairs, lambda x: x.isNull() | x["key"].isNull() | x["value"].isNull()), F.lit(False))


# The form of keys and hashes.
FORMS = {"sha256": "[0-9a-f]{64}", "run_id": "[0-9a-f]{20}", "shard_key": "[a-z0-9]+(?:[-_][a-z0-9]+)*"}


def has_form(text: Column, form: str) -> Column:
    """Whether the whole text is of one of ``FORMS``; false for null."""
    return F.coalesce(text.rlike(f"^(?:{FORMS[form]})\\z"), F.lit(False))


def is_label(text: Column) -> Column:
    """Whether a revision or name is neither blank nor has white space around it."""
    return F.coalesce((text != "") & (text == stripped(text)), F.lit(False))


def _strict(value: object, kind: type) -> object:
    """The JSON text's value if it is of the kind and holds only strings, else null."""
    try:
        found = json.loads(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return None
    inner = found.values() if isinstance(found, dict) else found if isinstance(found, list) else (None,)
    return found if isinstance(found, kind) and all(isinstance(x, str) for x in inner) else None


def string_list(text: Column) -> Column:
    """A JSON array of strings, strictly; null for anything else.  An Arrow UDF, as from_json is lenient."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _strict(t, list))

    return run(text)


def string_map(text: Column) -> Column:
    """A JSON object of strings, strictly and by key; null for anything else.  An Arrow UDF."""

    @F.pandas_udf("map<string,string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if (m := _strict(t, dict)) is None else dict(sorted(m.items())))

    return run(text)


def last_section(path: Column) -> Column:
    return F.coalesce(F.try_element_at(path, F.lit(-1)), F.lit("none"))


def area_bucket(area: Column, recorded: Column) -> Column:
    """The sampling bucket of an area in km2; null if the area is invalid or doesn't lie in the recorded label's range."""
    low = F.create_map(*[F.lit(x) for k, (a, _) in SOURCE_RANGES.items() for x in (k, a)])[recorded]
    high = F.create_map(*[F.lit(x) for k, (_, b) in SOURCE_RANGES.items() for x in (k, b)])[recorded]
    value = area.cast("double")
    fine = (value >= 0) & (value < float("inf")) & (low <= value) & (value < high)
    bucket = F.lit(BUCKETS[-1][0])
    for name, top in reversed(BUCKETS[:-1]):
        bucket = F.when(value < top, name).otherwise(bucket)
    return F.when(fine, bucket)


def logit_margin(yes: Column, no: Column) -> Column:
    return yes - no


def two_class_probability(yes: Column, no: Column) -> Column:
    """The sigmoid of the margin, without overflow on either side."""
    m = logit_margin(yes, no)
    small = F.exp(-F.abs(m))
    return F.when(m >= 0, 1 / (1 + small)).otherwise(small / (1 + small))


def is_area(geometry: Column) -> Column:
    """Whether a text is GeoJSON of a polygon or several, by its shape."""
    kind = F.get_json_object(geometry, "$.type")
    return F.coalesce((stripped(geometry) != "") & kind.isin("Polygon", "MultiPolygon") & F.get_json_object(geometry, "$.coordinates").isNotNull(), F.lit(False))


def grid_cell(lat: Column, lon: Column, degrees: float = 1.0) -> Column:
    """A cell of a plain grid; null without valid coordinates.  Not H3: the samplers take any cell column."""
    fine = lat.between(-90, 90) & lon.between(-180, 180)
    row, column = F.floor(lat / degrees).cast("string"), F.floor(lon / degrees).cast("string")
    return F.when(fine, F.concat(F.lit("g"), row, F.lit("_"), column))


def escaped(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(plain), F.lit(safe))
    return out


# The frames of both prompts.
def place_prompt(title: Column, section: Column, before: Column, target: Column, after: Column) -> Column:
    """The data part of the binary prompt, with each text escaped and in its own element."""

    def part(head: str, tag: str, text: Column) -> Column:
        return F.concat(F.lit(f"{head}:\n<{tag}>"), escaped(text), F.lit(f"</{tag}>"))

    return F.concat_ws("\n\n", part("Page title", "page_title", title), part("Section title", "section_title", section), part("Previous sentence", "previous", before), part("TARGET SENTENCE", "target", target), part("Next sentence", "next", after))


def sentence_prompt(tags: Column, **fields: Column) -> Column:
    """The data part of the two-label prompt.

    fields: polygon_name, region, osm_primary_tag, language, page_title,
    section, previous, target, next; a missing one shows as the form says.
    """

    def value(name: str, missing: str = "") -> Column:
        return F.coalesce(F.nullif(fields[name], F.lit("")), F.lit(missing))

    listed = F.to_json(F.array_sort(tags))
    parts = [
        "Target polygon:\n- Name: ", value("polygon_name", "unknown"), "\n- Country/region: ", value("region"), "\n- OSM primary tag: ", value("osm_primary_tag", "none"), "\nAll OSM tags:\n", listed,
        "\n\nArticle:\n- Language: ", value("language"), "\n- Page title: ", value("page_title"), "\n- Section title: ", value("section", "none"),
        "\n\nPrevious sentence:\n<previous>", value("previous"), "</previous>\n\nTARGET SENTENCE:\n<target>", value("target"), "</target>\n\nNext sentence:\n<next>", value("next"), "</next>",
    ]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


_CHOICES = "struct<choices:array<struct<logprobs:struct<content:array<struct<top_logprobs:array<struct<token:string,logprob:double>>>>>>>>"


def first_token_scores(response: Column) -> Column:
    """``yes`` and ``no`` log-probabilities of a completion's first token; null unless it has both.  The last of a kind counts."""
    body = F.from_json(response, _CHOICES)
    top = F.get(F.get(body["choices"], F.lit(0))["logprobs"]["content"], F.lit(0))["top_logprobs"]

    def last(name: str) -> Column:
        own = F.filter(top, lambda e: (F.lower(stripped(e["token"])) == name) & e["logprob"].isNotNull() & ~F.isnan(e["logprob"]) & (F.abs(e["logprob"]) < float("inf")))
        return F.try_element_at(own, F.lit(-1))["logprob"]

    yes, no = last("yes"), last("no")
    return F.when(yes.isNotNull() & no.isNotNull(), F.struct(yes.alias("yes"), no.alias("no")))


# Reasons that go with each label.
REASONS = {
    "landuse": {"yes": ("explicit_land_use", "explicit_land_cover", "built_or_managed_feature"), "no": ("no_landuse_or_cover",), "uncertain": ("insufficient_evidence",)},
    "polygon": {"yes": ("direct_polygon_reference", "context_resolved_reference", "place_description"), "no": ("nearby_or_broader_area", "navigation_or_reference_text", "unrelated_fact"), "uncertain": ("insufficient_evidence",)},
}
FIELDS = ("landuse_relevance", "polygon_relevance", "landuse_reason", "polygon_reason", "evidence")
LONGEST_EVIDENCE = 240


# The texts of what is wrong.
def label_failure(response: Column, target: Column) -> Column:
    """What is wrong with a label response; null if nothing is."""
    keys = F.json_object_keys(response)
    value = {f: F.get_json_object(response, f"$.{f}") for f in FIELDS}
    kind = F.schema_of_variant(F.try_parse_json(response))
    checks = F.when(kind.isNull() | ~kind.startswith("OBJECT") | (F.array_sort(keys) != F.array(*[F.lit(f) for f in sorted(FIELDS)])) | (F.size(F.regexp_extract_all(kind, F.lit(": STRING"), 0)) != len(FIELDS)), "response violates the structured label contract")
    for name in ("landuse", "polygon"):
        label, reason = value[f"{name}_relevance"], value[f"{name}_reason"]
        known = [r for rs in REASONS[name].values() for r in rs]
        fits = F.lit(False)
        for mark, rs in REASONS[name].items():
            fits = fits | ((label == mark) & reason.isin(*rs))
        checks = checks.when(~label.isin(*REASONS[name]) | ~reason.isin(*known), "response violates the structured label contract").when(~fits, "reason is inconsistent with the relevance label")
    evidence = value["evidence"]
    return checks.when(F.length(evidence) > LONGEST_EVIDENCE, "evidence exceeds the 240-character limit").when((evidence != "") & ~F.contains(target, evidence), "evidence is not an exact substring of target sentence")
