"""DuckDB SQL for the rows of queries whose method needs more than a line of it."""

from __future__ import annotations

import string

from ledgerloom.llm.license_scan import Template, default_templates

LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), {LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY lang
), placed AS (
  SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
  FROM words, (VALUES (1), (2), (3), (4)) AS v(size)
), f AS (
  SELECT lang, size, ws[i:i + size - 1] AS g, count(*) AS f FROM placed GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r,
         (2000000::HUGEINT * c.f) // (l.f::HUGEINT + r.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1) c
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:k]
  JOIN f r ON r.lang = c.lang AND r.g = c.g[k + 1:]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), starts AS (
  SELECT lang, f, g, size, unnest(range(1, size)) AS i FROM f WHERE size > 2
), parts AS (
  SELECT lang, f, g, i, unnest(range(i + 1, size + 1)) AS j, size FROM starts
), inside AS (
  SELECT lang, g[i:j] AS g, max(f) AS longer FROM parts WHERE j - i + 1 < size GROUP BY ALL
), kept AS (
  SELECT o.*, array_to_string(o.g, ' ') AS phrase FROM lowest o LEFT JOIN inside s ON s.lang = o.lang AND s.g = o.g
  WHERE s.longer IS NULL OR 100::HUGEINT * s.longer < 80::HUGEINT * o.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
       CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

# CRC-32 as in zlib: reflected polynomial 0xEDB88320, one byte of the text at a time.
_STEP = "CASE WHEN {x} & 1 = 1 THEN xor({x} >> 1, 3988292384) ELSE {x} >> 1 END"

SPELLING = rf"""
WITH RECURSIVE bits(b, c, i) AS (
  SELECT b, b, 0 FROM (SELECT unnest(range(256))::BIGINT AS b)
  UNION ALL
  SELECT b, {_STEP.format(x="c")}, i + 1 FROM bits WHERE i < 8
), crc AS (
  SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8
), found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS k FROM found GROUP BY ALL
), bytes AS (
  SELECT run, k, list_concat([4294967295::BIGINT], flatten(list_transform(
           string_split(concat(doc_id, ':', run), ''),
           lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))) AS bs
  FROM counted WHERE length(run) >= 5
), hashed AS (
  SELECT run, k, xor(list_reduce(bs, lambda acc, b: xor(acc >> 8, t[xor(acc & 255, b) + 1])), 4294967295) AS h
  FROM bytes, crc
), spelt AS (
  SELECT CASE WHEN h % 97 = 0 THEN concat(run[:h % length(run)], run[h % length(run) + 2:]) ELSE run END AS word, k FROM hashed
), words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), less AS (
  SELECT word, n, length(word) AS len, i, concat(word[:i - 1], word[i + 1:]) AS part
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.part = b.part AND a.i = b.i AND a.len = b.len
  WHERE a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.part = b.word
  UNION
  SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.part = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n FROM near GROUP BY word
), judged AS (
  SELECT w.word, w.n, CAST(coalesce(b.n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN b.form_n >= 2 * w.n THEN b.form END AS form, CASE WHEN b.form_n >= 2 * w.n THEN b.form_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain(word, here, depth) AS (
  SELECT word, word, 0 FROM judged
  UNION ALL
  SELECT c.word, j.form, depth + 1 FROM chain c JOIN judged j ON j.word = c.here WHERE j.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(here, depth) AS root FROM chain GROUP BY word
)
SELECT word, n, n_near, form, form_n, root FROM judged JOIN ends USING (word)
"""


def licenses(templates: list[Template] | None = None) -> str:
    """Every word of every template joined to every word of every text."""
    rows = [f"({k}, '{t.label}', {t.base}, {len(t.words)}, {t.need}, {len(t.must)}, {p}, '{w}', {int(p in t.must)})"
            for k, t in enumerate(default_templates() if templates is None else templates) for p, w in enumerate(t.words)]
    return rf"""
WITH t(k, label, base, n, need, n_must, pos, word, must) AS (VALUES {", ".join(rows)}
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), placed AS (
  SELECT r, len(ws) AS n_words, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM d
), stands AS (
  SELECT r, k, label, base, i - pos AS start, count(*) / n AS coverage
  FROM placed JOIN t USING (word)
  WHERE i - pos >= 0 AND i - pos + n <= n_words
  GROUP BY r, k, label, base, n, need, n_must, i - pos HAVING count(*) >= need AND sum(must) = n_must
), found AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
  FROM stands GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN found USING (r)
"""
