"""Places, documents, sections and sentences made from the driver's tables.

Each maker has its SQL beside it, so a query and its oracle start from the same
rows.  Whole tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A supplier is a place; its nation is its identifier.
PLACES_SQL = """places AS (
  SELECT 'p' || s_suppkey AS polygon_id, 'Q' || s_nationkey AS wikidata, s_name AS name, 'tag' || (s_suppkey % 7) AS osm_primary_tag, '{}' AS tags,
         'r' || s_nationkey AS region, (s_suppkey % 170 - 85)::DOUBLE AS lat, (s_suppkey * 7 % 360 - 180)::DOUBLE AS lon
  FROM supplier)"""


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("p"), k).alias("polygon_id"), F.concat(F.lit("Q"), F.col("s_nationkey")).alias("wikidata"), F.col("s_name").alias("name"), F.concat(F.lit("tag"), k % 7).alias("osm_primary_tag"), F.lit("{}").alias("tags"),
        F.concat(F.lit("r"), F.col("s_nationkey")).alias("region"), (k % 170 - 85).cast("double").alias("lat"), (k * 7 % 360 - 180).cast("double").alias("lon"),
    )


#: Each document belongs to a supplier and takes over its identifier; its lines are sections.
DOCUMENTS_SQL = """docs AS (
  SELECT 'd' || doc_id AS document_id, 'a' || doc_id AS article_id, 'Q' || s_nationkey AS wikidata, lang AS language, lang || '.example' AS site,
         't' || doc_id AS title, 'p' || s_suppkey AS polygon_id, doc_id AS page_id, doc_id AS revision_id, text
  FROM (SELECT d.*, doc_id % n + first_key AS owner FROM documents d CROSS JOIN (SELECT count(*) AS n, min(s_suppkey) AS first_key FROM supplier)) JOIN supplier ON owner = s_suppkey
), sections AS (
  SELECT document_id || ':' || (n - 1) AS section_id, document_id, article_id, wikidata, language, site, page_id, revision_id, n - 1 AS section_index, lines[n] AS text
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS n FROM (SELECT *, string_split(text, chr(10)) AS lines FROM docs)))"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = read(spark, sf_dir, "supplier")
    keys = suppliers.agg(F.count("*").alias("n"), F.min("s_suppkey").alias("first")).first()
    d = F.col("doc_id")
    return read(spark, sf_dir, "documents").join(suppliers, d % keys["n"] + keys["first"] == F.col("s_suppkey")).select(
        F.concat(F.lit("d"), d).alias("document_id"), F.concat(F.lit("a"), d).alias("article_id"), F.concat(F.lit("Q"), F.col("s_nationkey")).alias("wikidata"), F.col("lang").alias("language"),
        F.concat(F.col("lang"), F.lit(".example")).alias("site"), F.concat(F.lit("t"), d).alias("title"), F.concat(F.lit("p"), F.col("s_suppkey")).alias("polygon_id"), d.alias("page_id"), d.alias("revision_id"),
        F.lit("").alias("url"), F.lit("").alias("revision_timestamp"), F.lit("").alias("content_hash"), F.lit("wikipedia").alias("project"), "text",
    )


def links(docs: DataFrame) -> DataFrame:
    return docs.select("polygon_id", "document_id", "project", "wikidata", "language", "page_id", "revision_id")


def sections(docs: DataFrame) -> DataFrame:
    lines = docs.select("*", F.posexplode(F.split("text", "\n", -1)).alias("n", "line"))
    return lines.select(
        F.concat("document_id", F.lit(":"), F.col("n")).alias("section_id"), "document_id", "article_id", "wikidata", "language", "site", "page_id", "revision_id",
        F.col("n").cast("long").alias("section_index"), F.lit('["lines"]').alias("section_path"), F.col("line").alias("text"), F.lit("").alias("content_hash"),
    )


#: A conversation is a travel document, its turns are sections.
TRAVEL_SQL = """travel_docs AS (
  SELECT DISTINCT 'v' || conv_id AS document_id, '' AS article_id, 'Q' || (conv_id % 25) AS wikidata, 'en' AS language, 'en.travel' AS site, 't' || conv_id AS title, conv_id AS page_id FROM conversations
), travel_sections AS (
  SELECT 'v' || conv_id || ':' || turn AS section_id, 'v' || conv_id AS document_id, turn AS section_index, text FROM conversations)"""


def travel_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    return read(spark, sf_dir, "conversations").select("conv_id").distinct().select(
        F.concat(F.lit("v"), c).alias("document_id"), F.lit("").alias("article_id"), F.concat(F.lit("Q"), c % 25).alias("wikidata"), F.lit("en").alias("language"), F.lit("en.travel").alias("site"), F.concat(F.lit("t"), c).alias("title"),
        F.lit("").alias("url"), c.alias("page_id"), c.alias("revision_id"), F.lit("").alias("revision_timestamp"), F.lit("").alias("content_hash"),
    )


def travel_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    return read(spark, sf_dir, "conversations").select(F.concat(F.lit("v"), c, F.lit(":"), F.col("turn")).alias("section_id"), F.concat(F.lit("v"), c).alias("document_id"), F.lit("").alias("article_id"), F.col("turn").alias("section_index"), F.lit("[]").alias("section_path"), "text", F.lit("").alias("content_hash"))


#: A line of a document is a sentence of its place.
LINES_SQL = """rows AS (
  SELECT source AS polygon_id, CASE WHEN doc_id % 2 = 0 THEN 'wikipedia' ELSE 'wikivoyage' END AS source, lang AS language, doc_id AS document_id, n - 1 AS sentence_index, trim(lines[n]) AS sentence
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS n FROM (SELECT *, string_split(text, chr(10)) AS lines FROM documents)) WHERE trim(lines[n]) <> '')"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = read(spark, sf_dir, "documents").select("*", F.posexplode(F.split("text", "\n", -1)).alias("n", "line"))
    return exploded.where(F.trim("line") != "").select(
        F.col("source").alias("polygon_id"), F.when(F.col("doc_id") % 2 == 0, "wikipedia").otherwise("wikivoyage").alias("source"), F.col("lang").alias("language"),
        F.col("doc_id").alias("document_id"), F.col("n").cast("long").alias("sentence_index"), F.trim("line").alias("sentence"),
    )


#: Labelled documents as labelled sentences.
LABELLED_SQL = """labelled AS (
  SELECT d.doc_id AS sentence_id, d.source AS polygon_id, d.lang AS language, d.source, 'tag' || (d.doc_id % 3) AS osm_primary_tag,
         CASE l.quality WHEN 1 THEN 'yes' WHEN 0 THEN 'no' ELSE 'uncertain' END AS landuse_relevance,
         CASE l.toxic WHEN 1 THEN 'yes' WHEN 0 THEN 'no' ELSE 'uncertain' END AS polygon_relevance
  FROM documents d JOIN labels l USING (doc_id))"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = lambda c: F.when(F.col(c) == 1, "yes").when(F.col(c) == 0, "no").otherwise("uncertain")
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id").select(F.col("doc_id").alias("sentence_id"), F.col("source").alias("polygon_id"), F.col("lang").alias("language"), "source", F.concat(F.lit("tag"), F.col("doc_id") % 3).alias("osm_primary_tag"), word("quality").alias("landuse_relevance"), word("toxic").alias("polygon_relevance"))


#: Customers as sentences of their nation, whose region is the cell.
CUSTOMERS_SQL = """people AS (
  SELECT c_custkey::VARCHAR AS sentence_id, 'n' || c_nationkey AS polygon_id, 'r' || n_regionkey AS cell, CASE WHEN c_nationkey % 4 = 0 THEN 'large' ELSE 'small' END AS area_bucket, c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_nationkey")
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), n == F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("sentence_id"), F.concat(F.lit("n"), n).alias("polygon_id"), F.concat(F.lit("r"), F.col("n_regionkey")).alias("cell"), F.when(n % 4 == 0, "large").otherwise("small").alias("area_bucket"), F.col("c_mktsegment").alias("segment"))
