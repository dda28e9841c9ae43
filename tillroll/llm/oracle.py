"""DuckDB SQL of the registered queries that SQL can express.

The others need a tokenizer, XXH64, binomial bounds, zstandard or a walk over
HTML; tests/llm compares those with brute-force versions.
"""

from __future__ import annotations

_TURNS = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *,
        length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e')) AS text_size,
        length(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\e'), ':', '\c')) AS role_size
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('### ') + role_size + length(': ') + text_size + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_WORDS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

_LEAKS = f"""
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark
), starts AS (
    SELECT item, words, unnest(range(1, greatest(2, len(words) - 8))) AS i FROM items WHERE len(words) > 0
), keys AS (
    SELECT DISTINCT item, least(10, len(words)) AS size, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS key
    FROM starts
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents
), sizes AS (
    SELECT DISTINCT size FROM keys
), places AS (
    SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, sizes WHERE len(words) >= size
), hits AS (
    SELECT p.r, p.i, p.size, k.item
    FROM (SELECT r, i, size, array_to_string(words[i:i + size - 1], ' ') AS key FROM places) p
    JOIN keys k ON k.size = p.size AND k.key = p.key
), covered AS (
    SELECT r, count(DISTINCT w) AS n_hit
    FROM (SELECT r, unnest(range(i, i + size)) AS w FROM (SELECT DISTINCT r, i, size FROM hits)) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
    coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c ON c.r = d.r LEFT JOIN named n ON n.r = d.r
"""

_COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), lists AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang
), places AS (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM lists, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size
), counts AS (
    SELECT lang, w[i:i + size - 1] AS p, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM counts WHERE len(p) > 1
), scored AS (
    SELECT c.lang, c.p, c.a, c.k, l.f AS l, r.f AS r, t.n,
        CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
    FROM cuts c JOIN counts l ON l.lang = c.lang AND l.p = c.p[1:c.k]
        JOIN counts r ON r.lang = c.lang AND r.p = c.p[c.k + 1:len(c.p)] JOIN totals t ON t.lang = c.lang
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), parts AS (
    SELECT lang, p, f, size, unnest(range(1, len(p) - size + 2)) AS i
    FROM counts, (SELECT unnest(range(2, 5)) AS size) WHERE len(p) > size
), covered AS (
    SELECT DISTINCT x.lang, x.p[x.i:x.i + x.size - 1] AS p FROM parts x
    JOIN counts c ON c.lang = x.lang AND c.p = x.p[x.i:x.i + x.size - 1] WHERE x.f >= c.f
), kept AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM lowest ANTI JOIN covered USING (lang, p)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""

SQL: dict[str, str] = {"op4_chat_tree": _TURNS, "op10_decontaminate": _LEAKS, "op11_collocations": _COLLOCATIONS}
