"""DuckDB statements of the queries whose results SQL can express, each written on its own."""

from __future__ import annotations

from tunelake.llm.license_scan import NOTICES, PHRASES, Template

OP11_SQL = r"""
WITH given AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
               lambda c, b: list_reduce(
                   list_prepend(xor(c, b), range(8)), lambda d, k: xor(d >> 1, (d & 1) * 3988292384)
               )
           ), 4294967295) AS h
    FROM documents
), sized AS (
    SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM given
), places AS (
    SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM sized
), words AS (
    SELECT doc_id, n, i, CASE WHEN h % 10 = 0 AND i >= a
        THEN w[1 + a + (i - a) % (1 + (n - a) // (3 + g % 8))] ELSE w[1 + i] END AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM places)
), apart AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y
        ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 3
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM apart)
    GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), left_over AS (
    SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS text
    FROM words w ANTI JOIN dropped d ON w.doc_id = d.doc_id AND w.i = d.i GROUP BY w.doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing
    FROM runs GROUP BY doc_id
), best AS (
    SELECT * FROM runs
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(l.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN left_over l USING (doc_id)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _templates(templates: list[Template]) -> str:
    return ", ".join(
        f"({number}, {_quoted(t.label)}, {str(t.exact).lower()}, {_quoted(t.text)})" for number, t in enumerate(templates)
    )


_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP12_SQL = f"""
WITH templates AS (
    SELECT t, label, exact, {_WORDS} AS v FROM (VALUES {_templates([*PHRASES, *NOTICES])}) AS x(t, label, exact, text)
), template_grams AS (
    SELECT t, label, exact, size, least(size, 3) AS k, p, v[p + 1:p + least(size, 3)] AS gram
    FROM (SELECT *, len(v) AS size, unnest(range(len(v) - least(len(v), 3) + 1)) AS p FROM templates)
), docs AS (
    SELECT doc_id, {_WORDS} AS w FROM documents
), words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM docs
), grams AS (
    SELECT doc_id, i, word AS w0, lead(word) OVER following AS w1, lead(word, 2) OVER following AS w2
    FROM words WINDOW following AS (PARTITION BY doc_id ORDER BY i)
), hits AS (
    SELECT DISTINCT doc_id, t, label, exact, size, k, i, p
    FROM grams JOIN template_grams ON w0 = gram[1] AND w1 = gram[2] AND (k = 2 OR w2 = gram[3])
), apart AS (
    SELECT doc_id, t, i - p AS diagonal,
           coalesce(i - p - lag(i - p) OVER (PARTITION BY doc_id, t ORDER BY i - p)
               > CASE WHEN any_value(exact) THEN 0 ELSE any_value(size) // 5 END, true) AS new_span
    FROM hits GROUP BY doc_id, t, i - p
), chained AS (
    SELECT *, sum(new_span::INT) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS chain FROM apart
), spans AS (
    SELECT h.doc_id, label, exact, size, min(i) AS first, max(i + k) AS behind,
           len(list_distinct(flatten(list(range(p, p + k))))) AS covered
    FROM hits h JOIN chained c ON h.doc_id = c.doc_id AND h.t = c.t AND h.i - h.p = c.diagonal
    GROUP BY h.doc_id, h.t, label, exact, size, chain
), notices AS (
    SELECT * FROM spans
    WHERE covered >= size * CASE WHEN exact THEN 1.0 ELSE 0.8 END AND behind - first <= size * 1.25
), found AS (
    SELECT doc_id, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word,
           max(first) FILTER (exact) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(covered / size) AS score
    FROM notices GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN found USING (doc_id)
"""

#: The vectors as whole numbers, every anchor against all others.
OP13_SQL = """
WITH given AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM given a JOIN given b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
    AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""
