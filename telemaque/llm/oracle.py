"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from itertools import permutations

_LETTERS = "ABCDE"
_ORDERS = ",\n  ".join(f"('{''.join(p)}')" for p in permutations(_LETTERS))

AUDIT = rf"""WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), judged AS (
  SELECT doc_id, part, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, text,
    min(doc_id) OVER (PARTITION BY text) AS first_id
  FROM texts
), failed AS (
  SELECT part,
    len(words) < 50 AS a,
    100 * len(list_distinct(words)) < 65 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    first_id IS NOT NULL AND (doc_id IS NULL OR doc_id > first_id) AS e,
    coalesce((SELECT max(quality = 1) FROM labels l WHERE l.doc_id = judged.doc_id), false) AS good,
    coalesce((SELECT max(toxic = 1) FROM labels l WHERE l.doc_id = judged.doc_id), false) AS toxic
  FROM judged
), kinds AS (
  SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
    || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails,
    count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM failed GROUP BY ALL
), orders(filter_order) AS (VALUES
  {_ORDERS}
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, range(1, 6) AS s(step)
), outcomes AS (
  SELECT *, contains(fails, letter) AS failing, translate(fails, earlier, '') <> fails AS gone
  FROM kinds, steps
), totals AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND failing THEN n_good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND failing THEN n_toxic ELSE 0 END) AS toxic_lost
  FROM outcomes GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM totals"""


def _codebooks(rounds: int) -> str:
    """Assignment and averaging, one pair of common table expressions a round, by brute force."""
    out = []
    for r in range(rounds + 1):
        out.append(
            f"""near{r} AS MATERIALIZED (
  SELECT vec_id, label, p, q, best.e AS entry, best.d AS d FROM (
    SELECT vec_id, label, row_no, p, any_value(cut.q) AS q,
      min({{'d': (list_inner_product(cut.q, cut.q) + b.norm - 2 * list_inner_product(cut.q, b.c))::BIGINT, 'e': b.entry}}) AS best
    FROM cut JOIN book{r} b USING (p) GROUP BY vec_id, label, row_no, p)
)"""
        )
        if r < rounds:
            out.append(
                f"""sums{r} AS (
  SELECT p, entry, place, sum(x::BIGINT)::BIGINT AS total, count(*) AS n
  FROM (SELECT p, entry, unnest(q) AS x, unnest(range(len(q))) AS place FROM near{r}) GROUP BY p, entry, place
), means{r} AS (
  SELECT p, entry, list(((total - ((total % n) + n) % n) // n)::DOUBLE ORDER BY place) AS c FROM sums{r} GROUP BY p, entry
), book{r + 1} AS MATERIALIZED (
  SELECT p, entry, c, list_inner_product(c, c) AS norm
  FROM (SELECT b.p, b.entry, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN means{r} m ON b.p = m.p AND b.entry = m.entry)
)"""
            )
    return ",\n".join(out)


CODES = f"""WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY vec_id, v) - 1 AS row_no FROM whole
), cut AS MATERIALIZED (
  SELECT vec_id, label, row_no, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS q FROM numbered, range(4) AS t(p)
), book0 AS MATERIALIZED (
  SELECT p, row_no AS entry, q AS c, list_inner_product(q, q) AS norm FROM cut WHERE row_no < 256
),
{_codebooks(4)},
digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT::VARCHAR), ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM book4
), coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM near4 GROUP BY vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest"""

ORACLE_SQL: dict[str, str] = {
    "op11_filter_interaction_audit": AUDIT,
    "op12_vector_code_compression": CODES,
}
