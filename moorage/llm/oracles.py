"""SQL for the queries whose rows it can express."""

from __future__ import annotations

from moorage.llm import spelling

# Tables of the driver are small there: every pair of sets with a common shingle is counted, and links are followed to the end.
JACCARD = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sets AS (
    SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS set_id FROM shingles GROUP BY doc_id
), one AS (
    SELECT set_id, min(doc_id) AS doc_id, any_value(n) AS n FROM sets GROUP BY set_id
), own AS (
    SELECT o.doc_id, o.n, s.s FROM one o JOIN shingles s USING (doc_id)
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common
    FROM own a JOIN own b ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL
), links AS (
    SELECT a, b FROM shared WHERE 100 * common >= 80 * (na + nb - common)
), reach AS (
    SELECT doc_id AS id, doc_id AS other FROM one
    UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (
    SELECT id, min(other) AS component_id FROM reach GROUP BY id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(least.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sets s USING (doc_id) LEFT JOIN one USING (set_id) LEFT JOIN least ON least.id = one.doc_id
"""

CHAT = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
), sized AS (
    SELECT *, 14 + length(regexp_replace(role, '(\\|###|</turn>|<\||:)', '_\1', 'g')) + length(regexp_replace(text, '(\\|###|</turn>|<\|)', '_\1', 'g')) AS n
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLES = {"op5_jaccard": JACCARD, "op7_chat": CHAT, "op11_spelling": spelling.SQL}
