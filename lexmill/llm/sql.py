"""SQL for DuckDB of the queries on integer vectors and spelling."""

from __future__ import annotations

_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

#: All pairs of queries and candidates.
TOP_K_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings WHERE {_FINITE}
), q AS (
  SELECT vec_id AS query_id, min(v) AS qv FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id
), scored AS (
  SELECT query_id, vec_id, list_sum(list_transform(range(1, len(v) + 1), lambda k: v[k] * qv[k]))::BIGINT AS score FROM q JOIN v ON vec_id <> query_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def lloyd_sql(rounds: int = 4, parts: int = 4, entries: int = 256, scale: int = 1024) -> str:
    """The rounds written out: each assigns all parts anew and averages them."""
    steps = [
        f"""v AS (
  SELECT vec_id, label, len(embedding) // {parts} AS w, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v FROM embeddings WHERE {_FINITE}
), p AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * w + 1:(part + 1) * w] AS x FROM v, (SELECT unnest(range({parts})) AS part)
), c0 AS MATERIALIZED (
  SELECT part, entry, x AS c FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {entries}) USING (vec_id)
)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (
  SELECT vec_id, label, part, x, entry, list_sum(list_transform(range(1, len(x) + 1), lambda k: (x[k] - c[k]) * (x[k] - c[k])))::BIGINT AS gap FROM p JOIN c{r} USING (part)
), a{r} AS MATERIALIZED (
  SELECT vec_id, label, part, x, min((gap, entry))[2] AS entry, min(gap) AS gap FROM d{r} GROUP BY ALL
)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT part, entry, list(m ORDER BY k) AS c FROM (
    SELECT part, entry, k, (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS m FROM (SELECT part, entry, unnest(x) AS y, unnest(range(len(x))) AS k FROM a{r}) GROUP BY part, entry, k
  ) GROUP BY part, entry
), c{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.c, c{r}.c)::BIGINT[] AS c FROM c{r} LEFT JOIN m{r} AS m USING (part, entry)
)""")
    return f"""
WITH {', '.join(steps)}, rows AS (
  SELECT vec_id, label, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(gap)::BIGINT AS error FROM a{rounds} GROUP BY vec_id, label
), books AS (
  SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, k)) AS h FROM (SELECT part, entry, unnest(c) AS y, unnest(range(len(c))) AS k FROM c{rounds})
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT h FROM books) AS codebooks_sha256 FROM rows
"""


#: Near words share a row of what stays when one code point is left out.  CRC-32 (polynomial edb88320) goes byte by byte.
SPELLING_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b::BIGINT], range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(3988292384::BIGINT, x >> 1) ELSE x >> 1 END) AS c FROM (SELECT unnest(range(256)) AS b))
), runs AS (
  SELECT k, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT coalesce(doc_id::VARCHAR, 'null') AS k, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL
), bytes AS (
  SELECT k, run, times, flatten(list_transform(string_split(k || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)) AS bytes FROM runs
), hashed AS (
  SELECT run, times, xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda x, b: xor(t[(xor(x, b) & 255) + 1], x >> 8)), 4294967295::BIGINT) AS h FROM bytes, steps
), slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word, times FROM hashed
), words AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), less AS MATERIALIZED (
  SELECT word, n, i, word[1:i] || word[i + 2:] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), found AS (
  SELECT word, count(*) AS n_near, min((-near_n, near)) AS best FROM pairs GROUP BY word
), forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(f.n_near, 0) AS n_near, CASE WHEN -best[1] >= 10 * w.n THEN best[2] END AS form, CASE WHEN -best[1] >= 10 * w.n THEN -best[1] END AS form_n FROM words w LEFT JOIN found f USING (word)
), chain AS (
  SELECT word, word AS reached, 0 AS step FROM forms
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON f.word = c.reached WHERE f.form IS NOT NULL
), ends AS (
  SELECT word, max((step, reached))[2] AS root FROM chain GROUP BY word
)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms JOIN ends USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_lloyd": lloyd_sql(), "op12_exact_top_k": TOP_K_SQL, "op13_spelling": SPELLING_SQL}
