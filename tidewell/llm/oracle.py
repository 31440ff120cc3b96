"""The SQL that the queries of the text operators must agree with."""

from __future__ import annotations

BLANK_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE = {
    "op3_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
            FROM documents),
        keyed AS (
            SELECT doc_id, n, line, translate(trim(line, {BLANK_CHARS}), {LOWER}) AS key FROM lines),
        common AS (
            SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        judged AS (
            SELECT k.doc_id, n, line, c.key IS NOT NULL AND k.doc_id <> c.last AS dropped
            FROM keyed k LEFT JOIN common c ON k.key = c.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op7_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, d.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_language_id": """
        WITH crcs AS (
            SELECT doc_id, lang, text, xor(4294967295, list_reduce(
                [4294967295] || list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: ascii(c)),
                lambda h, b: list_reduce(
                    [xor(h, b)] || range(8),
                    lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 4 = 2 AS held_out
            FROM documents),
        signs AS (
            SELECT row_number() OVER () AS id, doc_id, lang, held_out, text IS NOT NULL AND regexp_matches(text, '\\p{L}') AS letters,
                   ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{M}]+', ' ', 'g')) || ' ' AS t
            FROM crcs),
        words AS (
            SELECT id, word, count(*) AS times
            FROM (SELECT id, unnest(string_split(trim(t), ' ')) AS word FROM signs WHERE trim(t) <> '') GROUP BY id, word),
        vocabulary AS (SELECT DISTINCT word, ' ' || word || ' ' AS t FROM words),
        places AS (
            SELECT word, t, n, unnest(range(1, length(t) + 2 - n)) AS i
            FROM vocabulary, (SELECT unnest([1, 2, 3]) AS n)),
        pieces AS (SELECT word, substr(t, i, n) AS g, count(*) AS inside FROM places GROUP BY ALL),
        kept AS (SELECT * FROM pieces WHERE NOT (g = ' ' OR length(g) = 3 AND substr(g, 2, 1) = ' ')),
        counted AS (SELECT id, g, sum(times * inside) AS times FROM words JOIN kept USING (word) GROUP BY id, g),
        own AS (
            SELECT id, g, row_number() OVER (PARTITION BY id ORDER BY times DESC, length(g), g) AS r FROM counted),
        taught AS (
            SELECT lang, g, sum(times) AS times FROM counted JOIN signs USING (id)
            WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, g),
        profiles AS (
            SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY times DESC, length(g), g) AS r FROM taught),
        listed AS (SELECT * FROM profiles WHERE r <= 300),
        near AS (SELECT id, g, r FROM own WHERE r <= 300),
        lengths AS (SELECT id, count(*) AS n FROM near GROUP BY id),
        met AS (
            SELECT id, lang, sum(abs(near.r - listed.r) - 300) AS saved FROM near JOIN listed USING (g) GROUP BY id, lang),
        apart AS (
            SELECT l.id, n, s.lang, n * 300 + coalesce(saved, 0) AS d
            FROM lengths l CROSS JOIN (SELECT DISTINCT lang FROM listed) s LEFT JOIN met ON met.id = l.id AND met.lang = s.lang),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, lang) AS place,
                   coalesce(lead(d) OVER (PARTITION BY id ORDER BY d, lang), n * 300) AS second
            FROM apart)
        SELECT doc_id, held_out, CASE WHEN letters AND p.lang IS NOT NULL THEN p.lang ELSE 'und' END AS lang_pred,
               CASE WHEN NOT letters OR p.lang IS NULL THEN 0.0 WHEN d + second = 0 THEN 0.5
                    ELSE CAST(second AS DOUBLE) / CAST(d + second AS DOUBLE) END AS score
        FROM signs LEFT JOIN placed p ON p.id = signs.id AND place = 1
    """,
}
