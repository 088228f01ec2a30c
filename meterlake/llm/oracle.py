"""DuckDB SQL of the queries that SQL can express, over the same whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)
"""

OP7 = f"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), firsts AS (
    SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
    SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id > f.owner, false) AS gone
    FROM keyed k LEFT JOIN firsts f ON k.key = f.key AND length(k.key) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP8 = f"""
WITH norm AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
groups AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM norm JOIN groups USING (norm)
"""

_WORDS = """regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

OP9 = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(len(w), 13) AS size,
        array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
    FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
    FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
          FROM docs, sizes WHERE len(w) >= size)
), hits AS (SELECT doc_id, i, size, item FROM places JOIN windows USING (size, win)),
hit_words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS place FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP11 = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
    FROM (SELECT lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
), grams AS (
    SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
    FROM (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
          FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(w) >= size)
), totals AS (SELECT lang, count(*) AS n FROM grams WHERE size = 1 GROUP BY lang),
counted AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE size > 1),
cuts AS (
    SELECT c.lang, c.size, c.phrase, c.a, t.n, k, x.a AS l, y.a AS r,
        CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
    FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM candidates) c
    JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
    JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 :], ' ')
    JOIN totals t ON t.lang = c.lang
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
    SELECT DISTINCT lang, a, array_to_string(w[i : i + part - 1], ' ') AS phrase
    FROM (SELECT lang, a, w, part, unnest(generate_series(1, size - part + 1)) AS i
          FROM candidates, (SELECT unnest([2, 3, 4]) AS part) WHERE part < size)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM inner_phrases i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a >= 100 * b.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_jaccard_join": OP4,
        "op7_line_dedup": OP7,
        "op8_exact_dedup": OP8,
        "op9_decontamination": OP9,
        "op11_phrase_mining": OP11,
    }
