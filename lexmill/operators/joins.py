"""Occurrences: the sections of documents, at each place the documents are linked to.

Joins are plain equi-joins without hints: the planner broadcasts places or
documents where their measured size allows and splits skewed keys elsewhere.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexmill.functions.values import qids_match
from lexmill.operators import integrity as I
from lexmill.schemas import links_table
from lexmill.sources.row_groups import opened, parquet_file
from lexmill.storage import materialize

# Columns by table, and the order of rows.
_PLACE = ("name", "osm_primary_tag", "tags", "region", "lat", "lon")
_PLACE_NAMES = {"name": "polygon_name", "osm_primary_tag": "osm_primary_tag", "tags": "osm_tags_raw", "region": "region", "lat": "lat", "lon": "lon"}
_DOCUMENT = ("document_id", "article_id", "wikidata", "language", "site", "title", "url", "page_id", "revision_id", "revision_timestamp", "content_hash")
_SECTION = ("document_id", "section_id", "section_index", "section_path", "text", "content_hash")
ORDER = ("polygon_id", "source", "language", "document_id", "section_index", "section_id")
SOURCES = ("wikipedia", "wikivoyage")
#: Parts of an identifier's sections; least ranges of polygons that are put in order; rows of a batch of those.
SPREAD, RANGES, ROWS = 16, 24, 8192
#: Bytes of a row group of stored travel sections, and of those that a task holds.
GROUP_BYTES, HELD_BYTES = 4 << 20, 256 << 20


def _links(links: DataFrame) -> DataFrame:
    return links.where(F.col("project") == SOURCES[0]) if "project" in links.columns else links


def _key(links: DataFrame) -> str:
    return "document_id" if links_table(links.columns) == "polygon_documents" else "article_id"


def _sections(sections: DataFrame) -> DataFrame:
    return sections.select(*[F.col(c).alias(f"s_{c}") for c in _SECTION])


def _occurrences(joined: DataFrame, source: str) -> DataFrame:
    """The output's columns of rows that have those of place, document and section (``p_``, ``d_`` and ``s_``)."""
    article = F.col("d_article_id") if source == SOURCES[0] else F.nullif(F.col("d_article_id"), F.lit(""))
    return joined.select(
        "polygon_id",
        F.col("d_wikidata").alias("wikidata"),
        F.col("d_document_id").alias("document_id"),
        article.alias("article_id"),
        F.lit(source).alias("source"),
        *[F.col(f"d_{a}").alias(b) for a, b in (("language", "language"), ("site", "site"), ("title", "page_title"), ("url", "url"), ("page_id", "page_id"), ("revision_id", "revision_id"), ("revision_timestamp", "revision_timestamp"), ("content_hash", "document_content_hash"))],
        *[F.col(f"s_{a}").alias(b) for a, b in (("section_id", "section_id"), ("section_index", "section_index"), ("section_path", "section_path_raw"), ("text", "section_text_raw"), ("content_hash", "section_content_hash"))],
        *[F.col(f"p_{a}").alias(b) for a, b in _PLACE_NAMES.items()],
    )


def _places(polygons: DataFrame, *more: str) -> DataFrame:
    return polygons.select("polygon_id", *[F.col(c).alias(f"p_{c}") for c in (*_PLACE, *more)])


def _documents(documents: DataFrame) -> DataFrame:
    return documents.select(*[F.col(c).alias(f"d_{c}") for c in _DOCUMENT])


def encyclopedia_occurrences(polygons: DataFrame, links: DataFrame, documents: DataFrame, sections: DataFrame) -> DataFrame:
    """Places, by their links, with documents and sections; a document's identifier is the occurrence's."""
    links, key = _links(links), _key(links)
    linked = links.select("polygon_id", F.col(key).alias("__key")).join(_places(polygons), "polygon_id").join(_documents(documents), F.col("__key") == F.col(f"d_{key}"))
    return _occurrences(linked.join(_sections(sections), F.col("d_document_id") == F.col("s_document_id")), SOURCES[0])


def travel_occurrences(polygons: DataFrame, documents: DataFrame, sections: DataFrame) -> DataFrame:
    """Every place that shares a document's identifier, with its sections.

    Rows multiply in the last join alone, so none that did is shuffled, and what
    depends on the section alone is made before it.  An identifier's sections
    are dealt into ``SPREAD`` parts, as there may be few identifiers; the places,
    which are short, are there for each part.  Parts go to as many tasks as the
    session has shuffle partitions: few bytes make many rows here, so partitions
    are not put together by their bytes.
    """
    tasks = int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = {"polygon_id", *_PLACE_NAMES.values()}
    told = _occurrences(_told(documents, sections).select("*", *[F.lit(None).cast(t).alias(n) for n, t in _places(polygons).dtypes]), SOURCES[1])
    dealt = told.drop(*own).withColumn("__part", F.pmod(F.xxhash64("section_id", "document_id"), F.lit(SPREAD))).repartition(tasks, "wikidata", "__part")
    places = polygons.select(F.col("wikidata").alias("p_wikidata"), "polygon_id", *[F.col(a).alias(b) for a, b in _PLACE_NAMES.items()])
    places = places.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long")))).repartition(tasks, "p_wikidata", "__part")
    return dealt.join(places, (F.col("wikidata") == F.col("p_wikidata")) & (dealt["__part"] == places["__part"])).select(*told.columns)


def _told(documents: DataFrame, sections: DataFrame) -> DataFrame:
    """Sections with their documents."""
    return _sections(sections).join(_documents(documents), F.col("s_document_id") == F.col("d_document_id"))


def _bounds(polygons: DataFrame, ranges: int) -> list[str]:
    """The first polygon of each of at most so many ranges of about as many, but for the first."""
    dealt = polygons.select("polygon_id").distinct().repartitionByRange(ranges, "polygon_id")
    first = dealt.groupBy(F.spark_partition_id()).agg(F.min("polygon_id").alias("first"))
    return sorted(r["first"] for r in first.collect() if r["first"] is not None)[1:]


def ordered_occurrences(polygons: DataFrame, links: DataFrame, documents: DataFrame, sections: DataFrame, travel: tuple[DataFrame, DataFrame], columns: Sequence[str]) -> DataFrame:
    """The columns given of all occurrences, by ``ORDER``.

    What is shuffled and sorted are the encyclopedia's occurrences, the places
    and the travel sections, each once: all grow with the input.  The sections
    are stored by identifier, each place knows where its own stand, and tasks
    read them there as a range's rows are handed out, place by place.  The
    product of places and sections, which grows with the input's square, is made
    only then.  Of stores that tasks do not open, each range is sent the sections.
    """
    ranges = max(RANGES, int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = _bounds(polygons, ranges)
    part = F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<string>"), lambda b: b <= F.col("polygon_id"))) if bounds else F.lit(0)
    part = F.when(F.col("polygon_id").isNull(), 0).otherwise(part)
    wanted = list(dict.fromkeys([*columns, *ORDER, "wikidata"]))
    core = encyclopedia_occurrences(polygons, links, documents, sections)
    kinds = dict(core.dtypes)
    empty = lambda names: [F.lit(None).cast(kinds[c]).alias(c) for c in names]
    of_place = {"polygon_id", *_PLACE_NAMES.values()}
    own = [c for c in wanted if c not in of_place]
    told = _occurrences(_told(*travel).select("*", *empty(["polygon_id"]), *[F.lit(None).cast(t).alias(n) for n, t in _places(polygons).dtypes if n != "polygon_id"]), SOURCES[1])
    told = materialize(told.where("wikidata IS NOT NULL").select(*own).orderBy("wikidata", *ORDER[2:]), "travel-sections", **{"parquet.block.size": GROUP_BYTES})
    places = polygons.where("wikidata IS NOT NULL").select("polygon_id", "wikidata", *[F.col(a).alias(b) for a, b in _PLACE_NAMES.items()])
    places = places.join(_spans(told), "wikidata")
    at = "array<struct<file string, first bigint, n bigint>>"
    rows = [
        core.select(part.alias("__range"), F.lit(1).alias("__kind"), F.col("polygon_id").alias("__key"), *wanted, F.lit(None).cast(at).alias("__spans")),
        places.select(part.alias("__range"), F.lit(2).alias("__kind"), F.col("polygon_id").alias("__key"), *[c for e in wanted for c in ([e] if e in of_place or e == "wikidata" else empty([e]))], "__spans"),
    ]
    there = told._stored_at if opened(told._stored_at) else None
    if there is None:
        asked = places.select(part.alias("__range"), "wikidata").distinct()
        # Sections are known by their identifier, and come before all places.
        rows.append(told.join(asked, "wikidata").select("__range", F.lit(0).alias("__kind"), F.col("wikidata").alias("__key"), *[c for e in wanted for c in (empty([e]) if e in of_place else [e])], F.lit(None).cast(at).alias("__spans")))
    dealt = reduce(DataFrame.union, rows).repartitionById(ranges, F.col("__range"))
    # A place's own sections come before its travel sections.
    ordered = dealt.sortWithinPartitions(F.col("__kind") > 0, "__key", "__kind", "language", "document_id", "section_index", "section_id").drop("__range", "__key")
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    return ordered.mapInArrow(_unfolding(list(columns), own, of_place, there), schema)


def _spans(told: DataFrame) -> DataFrame:
    """Where the rows of each identifier stand in the files of a table in its order: ``__spans``."""
    placed = told.select("wikidata", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    spans = placed.groupBy("wikidata", "file").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    return spans.groupBy("wikidata").agg(F.sort_array(F.collect_list(F.struct("file", "first", "n"))).alias("__spans"))


class _Stored:
    """Rows of the files in a folder; the row groups read last are held, up to ``HELD_BYTES``."""

    def __init__(self, folder: str, columns: list[str]) -> None:
        self.folder, self.columns, self.size = folder, columns, 0
        self.files: dict[str, tuple[pq.ParquetFile, np.ndarray]] = {}
        self.groups: OrderedDict[tuple[str, int], pa.Table] = OrderedDict()

    def _group(self, name: str, k: int) -> pa.Table:
        if (name, k) in self.groups:
            self.groups.move_to_end((name, k))
            return self.groups[name, k]
        table = self.files[name][0].read_row_group(k, columns=self.columns, use_threads=False).combine_chunks()
        self.groups[name, k] = table
        self.size += table.nbytes
        while self.size > HELD_BYTES and len(self.groups) > 1:
            self.size -= self.groups.popitem(last=False)[1].nbytes
        return table

    def rows(self, name: str, first: int, n: int) -> Iterator[pa.Table]:
        if name not in self.files:
            file = parquet_file(f"{self.folder}/{name}")
            self.files[name] = file, np.cumsum([0, *(file.metadata.row_group(k).num_rows for k in range(file.num_row_groups))])
        begins = self.files[name][1]
        k = int(np.searchsorted(begins, first, "right")) - 1
        while n > 0:
            part = self._group(name, k).slice(first - int(begins[k]), n)
            yield part
            first, n, k = first + len(part), n - len(part), k + 1


def _unfolding(columns: list[str], own: list[str], of_place: set[str], folder: str | None):
    """From a range's own occurrences and places, in order, to all occurrences in order.

    folder: of the travel sections; without one they come before the range's other rows.
    """
    sort = [("language", "ascending"), ("document_id", "ascending"), ("section_index", "ascending"), ("section_id", "ascending")]
    wanted = list(dict.fromkeys([*columns, *(c for c, _ in sort)]))

    def sent(batches: list[pa.RecordBatch], schema: pa.Schema) -> dict[str, pa.Table]:
        told = pa.Table.from_batches(batches, schema)
        names = told.column("wikidata").to_numpy()
        begins = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1]))) if len(names) else np.empty(0, np.int64)
        return {names[a]: told.slice(a, b - a) for a, b in zip(begins, np.append(begins, len(names))[1:], strict=True)}

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        told: dict[str, pa.Table] | None = None
        stored = _Stored(folder, own) if folder else None
        schema: pa.Schema | None = None
        pending: list[dict] = []

        def of(place: dict) -> Iterator[pa.Table]:
            found = (t for s in place["__spans"] for t in stored.rows(s["file"], s["first"], s["n"])) if stored else iter([told[place["wikidata"]]])
            for rows in found:
                made = [pa.repeat(pa.scalar(place[f.name], f.type), len(rows)) if f.name in of_place else rows.column(f.name).cast(f.type) for f in schema]
                yield pa.Table.from_arrays(made, schema=schema)

        def pended() -> Iterator[pa.Table]:
            """Occurrences of the rows of one polygon; there is more than one only if polygons repeat."""
            if len(pending) == 1:
                yield from of(pending[0])
            elif pending:
                whole = pa.concat_tables([t for place in pending for t in of(place)])
                yield whole.take(pa.compute.sort_indices(whole, sort_keys=sort, null_placement="at_start"))
            pending.clear()

        for batch in batches:
            schema = schema or pa.schema([batch.schema.field(c) for c in wanted])
            kind = batch.column("__kind").to_numpy()
            first = int(np.searchsorted(kind > 0, True))
            if first:
                held.append(batch.slice(0, first))
            if first == len(kind):
                continue
            if told is None:
                told = sent(held, batch.schema) if folder is None else {}
            table = pa.Table.from_batches([batch])
            cuts = np.flatnonzero(np.diff(kind[first:]) != 0) + first + 1
            for a, b in zip([first, *cuts], [*cuts, len(kind)], strict=True):
                if kind[a] == 1:
                    yield from pended()
                    yield table.slice(a, b - a).select(wanted)
                    continue
                for place in table.slice(a, b - a).select([*(c for c in wanted if c in of_place), *{"polygon_id", "wikidata", "__spans"} - (set(wanted) & of_place)]).to_pylist():
                    if pending and pending[0]["polygon_id"] != place["polygon_id"]:
                        yield from pended()
                    pending.append(place)
        yield from pended()

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for table in parts(batches):
            table = table.select(columns)
            if size and (size + len(table) >= ROWS):
                yield from pa.concat_tables(held).combine_chunks().to_batches(ROWS)
                held, size = [], 0
            if len(table) >= ROWS:
                yield from table.to_batches(ROWS)
            else:
                held.append(table)
                size += len(table)
        if size:
            yield from pa.concat_tables(held).combine_chunks().to_batches(ROWS)

    return unfold


def compose(*occurrences: DataFrame) -> DataFrame:
    """All occurrences; sort by ``ORDER`` where they are written in order."""
    out = occurrences[0]
    for more in occurrences[1:]:
        out = out.unionByName(more)
    return out


def _same(a: str, b: str, *columns: str):
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def encyclopedia_checks(polygons: DataFrame, links: DataFrame, documents: DataFrame, sections: DataFrame) -> dict[str, DataFrame]:
    """Keys, references and identities that the join relies on; assert them before it."""
    links, key = _links(links), _key(links)
    l, p, d, s = (df.alias(n) for df, n in ((links, "l"), (polygons, "p"), (documents, "d"), (sections, "s")))  # noqa: E741
    to_place = l.join(p, F.col("l.polygon_id") == F.col("p.polygon_id"))
    to_document = l.join(d, F.col(f"l.{key}") == F.col(f"d.{key}"))
    of_document = s.join(d, F.col("s.document_id") == F.col("d.document_id"))
    article = (F.col("s.article_id") == "") | F.col("s.article_id").eqNullSafe(F.col("d.article_id"))
    return {
        "polygons.polygon_id is empty": I.empty_keys(polygons, "polygon_id"),
        "polygons.polygon_id repeats": I.duplicate_keys(polygons, "polygon_id"),
        "links.polygon_id is empty": I.empty_keys(links, "polygon_id"),
        f"links.{key} is empty": I.empty_keys(links, key),
        "documents.document_id is empty": I.empty_keys(documents, "document_id"),
        "documents.document_id repeats": I.duplicate_keys(documents, "document_id"),
        "documents.article_id is empty": I.empty_keys(documents, "article_id"),
        "documents.article_id repeats": I.duplicate_keys(documents, "article_id"),
        "sections.section_id is empty": I.empty_keys(sections, "section_id"),
        "sections.section_id repeats": I.duplicate_keys(sections, "section_id"),
        "sections.document_id is empty": I.empty_keys(sections, "document_id"),
        "sections.section_index is invalid": I.bad_indexes(sections, "section_index"),
        "a link repeats": I.duplicate_keys(links, "polygon_id", key),
        "a link has no polygon": I.orphans(links, "polygon_id", polygons, "polygon_id"),
        "a link has no document": I.orphans(links, key, documents, key),
        "a section has no document": I.orphans(sections, "document_id", documents, "document_id"),
        "a link's wikidata is not its polygon's": I.mismatches(to_place, qids_match(F.col("p.wikidata"), F.col("l.wikidata")), F.col("l.wikidata")),
        "a link's wikidata is not its document's": I.mismatches(to_document, qids_match(F.col("d.wikidata"), F.col("l.wikidata")), F.col("l.wikidata")),
        "a link is not its document's": I.mismatches(to_document, _same("l", "d", "language", "page_id", "revision_id"), F.col(f"l.{key}")),
        "a section's wikidata is not its document's": I.mismatches(of_document, qids_match(F.col("d.wikidata"), F.col("s.wikidata")), F.col("s.section_id")),
        "a section is not its document's": I.mismatches(of_document, _same("s", "d", "language", "site", "page_id", "revision_id") & article, F.col("s.section_id")),
    }


def layout_checks(layouts: list[DataFrame], documents: DataFrame) -> dict[str, DataFrame]:
    """No polygon and document are linked by shards of both layouts."""
    pairs = [_links(links).join(documents.select("document_id", "article_id"), _key(links)).select("polygon_id", "document_id").distinct() for links in layouts]
    return {"a link is there in both layouts": I.duplicate_keys(reduce(DataFrame.unionByName, pairs), "polygon_id", "document_id")} if len(pairs) > 1 else {}


def travel_checks(polygons: DataFrame, documents: DataFrame, sections: DataFrame) -> dict[str, DataFrame]:
    d, s = documents.alias("d"), sections.alias("s")
    of_document = s.join(d, F.col("s.document_id") == F.col("d.document_id"))
    article = (F.col("s.article_id") == "") | F.col("s.article_id").eqNullSafe(F.col("d.article_id"))
    return {
        "travel documents.document_id is empty": I.empty_keys(documents, "document_id"),
        "travel documents.document_id repeats": I.duplicate_keys(documents, "document_id"),
        "travel documents.wikidata is empty": I.empty_keys(documents, "wikidata"),
        "a travel document has no polygon": I.orphans(documents, "wikidata", polygons, "wikidata"),
        "travel sections.section_id is empty": I.empty_keys(sections, "section_id"),
        "travel sections.section_id repeats": I.duplicate_keys(sections, "section_id"),
        "travel sections.section_index is invalid": I.bad_indexes(sections, "section_index"),
        "a travel section has no document": I.orphans(sections, "document_id", documents, "document_id"),
        "a travel section is not its document's": I.mismatches(of_document, _same("s", "d", "wikidata", "language", "site", "page_id", "revision_id") & article, F.col("s.section_id")),
    }


def join_report(occurrences: DataFrame) -> DataFrame:
    """One row of counts of composed occurrences."""
    one = lambda name, s: F.count_if(F.col("source") == s).alias(name)
    return occurrences.agg(F.count("*").alias("occurrences"), one("encyclopedia", SOURCES[0]), one("travel", SOURCES[1]), F.countDistinct("polygon_id").alias("polygons"), F.countDistinct("document_id").alias("documents"), F.countDistinct("section_id").alias("sections"))


def _shared(polygons: DataFrame, documents: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Travel sections with the number ``n`` of places that share their identifier, and those places: a row each, never their product."""
    told = _told(documents, sections)
    places = polygons.select("polygon_id", "wikidata")
    counted = places.groupBy("wikidata").agg(F.count("*").alias("n"))
    with_n = told.join(counted, F.col("d_wikidata") == F.col("wikidata")).select("n", F.col("d_document_id").alias("document_id"), F.col("s_section_id").alias("section_id"))
    return with_n, places.join(told.select(F.col("d_wikidata").alias("wikidata")).distinct(), "wikidata", "left_semi")


def occurrence_report(polygons: DataFrame, links: DataFrame, documents: DataFrame, sections: DataFrame, travel: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``join_report`` of all occurrences, without the product of places and travel sections."""
    one = F.lit(1).cast("long")
    core = encyclopedia_occurrences(polygons, links, documents, sections)
    own, places = _shared(polygons, *travel)
    # Numbers and names go apart: a distinct name is counted in a table of its own.
    numbers = core.select(one.alias("e"), (one - 1).alias("t")).union(own.select(one - 1, "n")).agg(F.coalesce(F.sum(F.col("e") + F.col("t")), F.lit(0)).alias("occurrences"), F.coalesce(F.sum("e"), F.lit(0)).alias("encyclopedia"), F.coalesce(F.sum("t"), F.lit(0)).alias("travel"))
    out = numbers
    for name, column, more in (("polygons", "polygon_id", places), ("documents", "document_id", own), ("sections", "section_id", own)):
        out = out.crossJoin(core.select(column).union(more.select(column)).distinct().agg(F.count(column).alias(name)))
    return out


def occurrence_counters(polygons: DataFrame, links: DataFrame, documents: DataFrame, sections: DataFrame, travel: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``COUNTERS`` in one row, without the product of places and travel sections."""
    parts = [(polygons, None), (links, None), (documents, None), (sections, None), (encyclopedia_occurrences(polygons, links, documents, sections), None), (travel[0], None), (travel[1], None), (_shared(polygons, *travel)[0], "n")]
    counts = [df.agg((F.coalesce(F.sum(n), F.lit(0)) if n else F.count("*")).alias("n")).select(F.lit(name).alias("name"), "n") for (df, n), name in zip(parts, COUNTERS, strict=False)]
    own = lambda name: F.sum(F.when(F.col("name") == name, F.col("n")))
    return reduce(DataFrame.union, counts).agg(*[own(name).alias(name) for name in COUNTERS[:-1]], (own(COUNTERS[4]) + own(COUNTERS[7])).alias(COUNTERS[-1]))


#: Counters of a run's join, in order.
COUNTERS = ("polygon_count", "polygon_article_count", "wikipedia_document_count", "wikipedia_section_count", "wikipedia_occurrence_count", "wikivoyage_document_count", "wikivoyage_section_count", "wikivoyage_occurrence_count", "total_occurrence_count")


class Counters:
    """Numbers of rows, counted while a job passes them; there once it has run."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, rows: DataFrame, name: str) -> DataFrame:
        self._seen[name] = Observation()
        return rows.observe(self._seen[name], F.count(F.lit(1)).alias("n"))

    def counts(self) -> dict[str, int]:
        """Of all counters; those that nothing was watched for are 0."""
        return {name: self._seen[name].get["n"] if name in self._seen else 0 for name in COUNTERS}


def counted_occurrences(polygons: DataFrame, links: DataFrame, documents: DataFrame, sections: DataFrame, travel: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, Counters]:
    """All occurrences, and counters that whatever job writes them fills: no other job counts anything.

    travel: documents and sections of the second source.  The rows must be written whole.
    """
    c = Counters()
    core = [c.watch(df, name) for df, name in zip((polygons, links, documents, sections), COUNTERS, strict=False)]
    parts = [c.watch(encyclopedia_occurrences(*core), "wikipedia_occurrence_count")]
    if travel is not None:
        own = [c.watch(df, name) for df, name in zip(travel, ("wikivoyage_document_count", "wikivoyage_section_count"), strict=True)]
        parts.append(c.watch(travel_occurrences(polygons, *own), "wikivoyage_occurrence_count"))
    return c.watch(compose(*parts), "total_occurrence_count"), c


def enrich(rows: DataFrame, attributes: DataFrame, key: str, *columns: str) -> DataFrame:
    """Add a parent's columns; parents that are missing show as null, see ``unmatched``."""
    return rows.drop(*[c for c in columns if c in rows.columns]).join(attributes.select(key, *columns), key, "left")


def unmatched(rows: DataFrame, attributes: DataFrame, key: str, *columns: str) -> dict[str, DataFrame]:
    """Checks for ``enrich``: parents are unique and there, and columns already on the rows agree."""
    checks = {f"{key} repeats": I.duplicate_keys(attributes, key), f"a row's {key} is unknown": I.orphans(rows, key, attributes, key)}
    both = rows.alias("a").join(attributes.alias("b"), key)
    for c in columns:
        if c in rows.columns:
            checks[f"{c} differs"] = I.mismatches(both, F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.col(key))
    return checks


def join_labels(rows: DataFrame, labels: DataFrame, key: str = "sentence_id") -> DataFrame:
    return rows.join(labels, key)


def label_checks(rows: DataFrame, labels: DataFrame, key: str = "sentence_id") -> dict[str, DataFrame]:
    """Rows and labels are the same set, each once."""
    return {f"rows: {key} repeats": I.duplicate_keys(rows, key), f"labels: {key} repeats": I.duplicate_keys(labels, key), "a row has no label": I.orphans(rows, key, labels, key), "a label has no row": I.orphans(labels, key, rows, key)}


def pending(rows: DataFrame, done: DataFrame, key: str = "sentence_id") -> DataFrame:
    return rows.join(done.select(key), key, "left_anti")


def inventory_diff(before: DataFrame, now: DataFrame, key: str, *columns: str) -> DataFrame:
    """``key`` and ``status``: added, removed, changed or unchanged."""
    state = F.struct(*columns)
    a = before.select(F.col(key), state.alias("a"), F.lit(True).alias("in_a"))
    b = now.select(F.col(key), state.alias("b"), F.lit(True).alias("in_b"))
    status = F.when(F.col("in_a").isNull(), "added").when(F.col("in_b").isNull(), "removed").when(F.col("a").eqNullSafe(F.col("b")), "unchanged").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def with_columns_or_null(rows: DataFrame, **kinds: str) -> DataFrame:
    """Add columns that are absent as nulls of the types given; those there stay."""
    return rows.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in rows.columns})


def among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is one of a table's keys."""
    return rows.join(keys.select(key), key, "left_semi")


def inventory_checks(expected: DataFrame, actual: DataFrame, key: str) -> dict[str, DataFrame]:
    """Two inventories hold the same keys."""
    return {f"{key} is missing": I.orphans(expected, key, actual, key), f"{key} is unexpected": I.orphans(actual, key, expected, key)}


def repeated_across(rows: DataFrame, key: str, batch: str) -> DataFrame:
    """``key`` and ``batches`` of keys that more than one batch holds."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(batch).alias("batches")).where("batches > 1")
