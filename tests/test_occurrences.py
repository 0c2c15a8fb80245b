"""Occurrences of many places that share identifiers: no product of places and sections is shuffled, or made for counts."""

import random

import pytest
from pyspark.sql import functions as F

from lexmill.operators import joins as J

COLUMNS = ("polygon_id", "source", "language", "document_id", "section_index", "section_id", "wikidata", "article_id", "section_text_raw", "polygon_name", "lat")


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(5)
    # Some places repeat, some have no identifier or one that no document has.
    names = [f"p{k}" for k in range(90)] + ["p3", "p3", "p40"]
    places = [(p, draw.choice(["Q1", "Q2", "Q3", "Q9", None]), f"n{k}", "tag", "{}", "r", float(k), 0.0) for k, p in enumerate(names)]
    polygons = spark.createDataFrame(places, "polygon_id string, wikidata string, name string, osm_primary_tag string, tags string, region string, lat double, lon double")
    kind = "document_id string, article_id string, wikidata string, language string, site string, title string, url string, page_id long, revision_id long, revision_timestamp string, content_hash string"
    document = lambda name, q, lang: (name, f"a{name}" if name[0] == "d" else "", q, lang, "s", "t", "", 1, 1, "", "")
    part = "document_id string, section_id string, section_index long, section_path string, text string, content_hash string"
    core = [document(f"d{k}", "Q1", draw.choice(["en", "fr"])) for k in range(40)]
    more = [document(f"v{k}", draw.choice(["Q1", "Q2", "Q7", None]), draw.choice(["de", "en", None])) for k in range(30)]
    lines = lambda docs: [(d[0], f"{d[0]}:{n}", n, "[]", f"text {n} of {d[0]}", "") for d in docs if d[0] not in ("d7", "v7") for n in range(draw.randint(1, 12))]
    links = [(draw.choice(names), d[0], "wikipedia", d[2], d[3], 1, 1) for d in core for _ in range(2)]
    frame = spark.createDataFrame
    return polygons, frame(links, "polygon_id string, document_id string, project string, wikidata string, language string, page_id long, revision_id long"), frame(core, kind), frame(lines(core), part), (frame(more, kind), frame(lines(more), part))


@pytest.fixture(scope="module")
def whole(tables):
    return J.compose(J.encyclopedia_occurrences(*tables[:4]), J.travel_occurrences(tables[0], *tables[4]))


def test_rows_come_in_order_without_a_sort_of_the_product(tables, whole):
    ordered = J.ordered_occurrences(*tables, COLUMNS)
    found, wanted = ordered.collect(), whole.select(*COLUMNS).orderBy(*J.ORDER).collect()
    assert [tuple(r)[:6] for r in found] == [tuple(r)[:6] for r in wanted]
    assert sorted(map(str, found)) == sorted(map(str, wanted)) and len(found) > 2000
    plan = ordered._jdf.queryExecution().optimizedPlan().toString()
    # The last step hands the rows out; what is sorted below it are the sections, places and the encyclopedia's rows.
    assert plan.strip().startswith("MapInArrow")


def test_nothing_is_shuffled_after_places_multiply_rows(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = J.travel_occurrences(tables[0], *tables[4])
        plan = rows._jdf.queryExecution().executedPlan().toString()
        # The first join of the plan is the one with places, and takes shuffled inputs; no exchange lies above it.
        assert "p_wikidata" in plan[plan.index("Join") : plan.index("Join") + 200] and "Exchange" not in plan[: plan.index("Join")]
        assert rows.count() == sum(1 for p in tables[0].collect() for d in tables[4][0].collect() if p["wikidata"] and p["wikidata"] == d["wikidata"] for s in tables[4][1].collect() if s["document_id"] == d["document_id"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_reports_without_the_product(tables, whole):
    assert J.occurrence_report(*tables).first() == J.join_report(whole).first()
    counts = J.occurrence_counters(*tables).first()
    core = J.encyclopedia_occurrences(*tables[:4]).count()
    assert tuple(counts) == (*(t.count() for t in tables[:4]), core, *(t.count() for t in tables[4]), whole.count() - core, whole.count())
    assert list(counts.asDict()) == list(J.COUNTERS)


def test_reports_of_nothing(tables):
    empty = [t.limit(0) for t in tables[:4]], tuple(t.limit(0) for t in tables[4])
    assert set(J.occurrence_report(*empty[0], empty[1]).first()) == {0} and set(J.occurrence_counters(*empty[0], empty[1]).first()) == {0}
    assert J.ordered_occurrences(*empty[0], empty[1], COLUMNS).count() == 0


def _shuffled_last(rows) -> int:
    """Rows that the plan's last shuffle took, once the plan has run."""
    node = rows._jdf.queryExecution().executedPlan().executedPlan()
    while "Exchange" not in node.nodeName():
        node = node.plan() if "QueryStage" in node.nodeName() else node.children().head()
    return node.metrics().apply("shuffleRecordsWritten").value()


def test_travel_sections_are_not_copied_for_each_range(tables):
    ordered = J.ordered_occurrences(*tables, COLUMNS)
    ordered.collect()
    assert _shuffled_last(ordered) <= J.encyclopedia_occurrences(*tables[:4]).count() + tables[0].count()


@pytest.mark.parametrize("held", [1, 256 << 20])
def test_stored_sections_are_read_whole_from_small_row_groups(spark, tmp_path, held, monkeypatch):
    monkeypatch.setattr(J, "HELD_BYTES", held)
    path = str(tmp_path / "told")
    spark.range(5000).selectExpr("id", "cast(id as string) AS text").coalesce(1).write.option("parquet.block.size", "4096").option("parquet.page.size.row.check.min", "10").parquet(path)
    name = next(p.name for p in (tmp_path / "told").iterdir() if p.suffix == ".parquet")
    stored = J._Stored(f"file:{path}", ["id", "text"])
    for first, n in ((0, 5000), (4990, 10), (17, 3000), (17, 1), (100, 0), (0, 5000)):
        assert [x for t in stored.rows(name, first, n) for x in t.column("id").to_pylist()] == list(range(first, first + n))
    assert len(stored.files[name][1]) > 3 and (held > 1 or len(stored.groups) == 1) and stored.size == sum(t.nbytes for t in stored.groups.values())


def test_a_store_that_tasks_do_not_open_gives_the_same_rows(tables, whole, monkeypatch):
    monkeypatch.setattr(J, "opened", lambda path: False)
    found, wanted = J.ordered_occurrences(*tables, COLUMNS).collect(), whole.select(*COLUMNS).orderBy(*J.ORDER).collect()
    assert [tuple(r)[:6] for r in found] == [tuple(r)[:6] for r in wanted] and sorted(map(str, found)) == sorted(map(str, wanted))


def test_places_multiply_rows_in_as_many_tasks_as_the_session_sets(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = J.travel_occurrences(tables[0], *tables[4])
        # Two identifiers of few bytes: their parts are not put together in a task or two.
        assert rows.select(F.spark_partition_id()).distinct().count() >= 6
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "nullif" not in plan[: plan.index("Join")] and "CASE" not in plan[: plan.index("Join")] and "if (" not in plan[: plan.index("Join")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
