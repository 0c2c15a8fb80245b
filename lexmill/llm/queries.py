"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import ann, line_spread, lloyd, media, mixing, packing, pii, simhash, spelling, sql, substring_dedup, suffix_tree, top_k, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    """Place of the public word-level vocabulary, which every executor has at the same path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.identifiers(table(spark, sf_dir, "documents"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer())


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Passages also begin within lines, and short lines repeat by chance.
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"), kind="sentence", min_words=20).drop("text_hash")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_spread.drop_spread_lines(table(spark, sf_dir, "documents"), places="removed")
    n_removed = F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed"))
    return kept.select("doc_id", n_removed.cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"), "text")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", F.col("copy").cast("long").alias("copy"), "text")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = toxicity.in_fold(F.col("doc_id"), 3, 1)
    model = toxicity.train(documents, labels, learn=~held_out)
    return toxicity.score(documents, model).withColumn("held_out", held_out).select("doc_id", "held_out", "score", "predicted")


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn_from = ~toxicity.in_fold(F.col("doc_id"), 7, 2)
    return suffix_tree.score(table(spark, sf_dir, "documents"), learn_from=learn_from)


def op11_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = lloyd.product_codes(table(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select("vec_id", code.alias("code"), "error", "label_error", "codebooks_sha256")


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.highest_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.words(table(spark, sf_dir, "documents"), noise=31))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_multi_index": op1_multi_index,
        "op2_pii": op2_pii,
        "op3_media": op3_media,
        "op4_packing": op4_packing,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_simhash": op6_simhash,
        "op7_line_spread": op7_line_spread,
        "op8_mixing": op8_mixing,
        "op9_toxicity": op9_toxicity,
        "op10_suffix_tree": op10_suffix_tree,
        "op11_lloyd": op11_lloyd,
        "op12_exact_top_k": op12_exact_top_k,
        "op13_spelling": op13_spelling,
    }


#: Lines in lower case with single spaces; all but the first occurrence of those on five sources go.
LINE_SPREAD_SQL = r"""
WITH parts AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, source, n - 1 AS place, lines[n] AS line,
         trim(regexp_replace(lower(lines[n]), '\s+', ' ', 'g')) AS plain
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS n FROM parts)
), spread AS (
  SELECT plain, min((doc_id, place)) AS first_place FROM lines
  WHERE plain <> '' GROUP BY plain HAVING count(DISTINCT coalesce('s' || source, '')) >= 5
), marked AS (
  SELECT l.*, (s.plain IS NOT NULL AND (l.doc_id, l.place) > s.first_place) AS gone
  FROM lines l LEFT JOIN spread s ON l.plain = s.plain
), done AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
         string_agg(place::VARCHAR, ',' ORDER BY place) FILTER (gone) AS removed,
         string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id
)
SELECT p.doc_id, coalesce(d.n_removed, 0)::BIGINT AS n_removed, d.removed,
       CASE WHEN p.text IS NULL THEN NULL ELSE coalesce(d.kept, '') END AS text
FROM parts p LEFT JOIN done d USING (doc_id)
"""

#: A document's count is the number of steps of its source's Poisson distribution up to a hashed number.
MIXING_SQL = r"""
WITH counts AS (
  SELECT coalesce('s' || source, '') AS safe, count(*) AS n, pow(count(*), 0.7) AS w FROM documents GROUP BY 1
), rates AS (
  SELECT safe, w / sum(w) OVER () * sum(n) OVER () / n AS rate FROM counts
), terms AS (
  SELECT safe, rate, j, sum(CASE WHEN j > 0 THEN ln(j::DOUBLE) ELSE 0.0 END) OVER (PARTITION BY safe ORDER BY j) AS lf
  FROM (SELECT safe, rate, unnest(range(0, (rate + 12 * sqrt(rate) + 40)::INT + 1)) AS j FROM rates)
), steps AS (
  SELECT safe, j, sum(exp(j * ln(rate) - rate - lf)) OVER (PARTITION BY safe ORDER BY j) AS c FROM terms
), drawn AS (
  SELECT doc_id, source, text, coalesce('s' || source, '') AS safe,
         ('0x' || substr(md5('mix-1' || chr(31) || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents
), counted AS (
  SELECT d.doc_id, d.source, d.text, (SELECT count(*) FROM steps s WHERE s.safe = d.safe AND s.c <= d.u) AS many FROM drawn d
)
SELECT doc_id, source, unnest(range(0, many)) AS copy, text FROM counted WHERE many > 0
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_line_spread": LINE_SPREAD_SQL, "op8_mixing": MIXING_SQL, **sql.oracle_sql()}
