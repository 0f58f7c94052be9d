"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations


def _state(of: str, cost: str, edit: str, line: str = "''") -> str:
    """SQL of the state that follows ``of`` by an edit; ``line``: what is added to the repaired rows."""
    return f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{edit}', 'b': {of}.b || {line}}}"


def _least(*states: str) -> str:
    """SQL of the cheapest state, then the one with the ASCII-least audit."""
    return f"list_min([{', '.join(states)}])"


_FAR = "1000000000000"
_USER, _ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"


def _kept(of: str, initial: str) -> str:
    return _state(of, f"CASE WHEN initial = '{initial}' THEN keep ELSE {_FAR} END", "K", "chr(10) || role || ':' || text")


def _rerole(of: str, role: str) -> str:
    return _state(of, "keep + 1", "R", f"{role} || text")


#: Damage, faults and a forward search over states (nothing yet, after s, u, a) that keeps each state's best edits so far.
REPAIR = f"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n] || [0, 0, 0, 0, 0, 0, 0, 0],
               lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS bytes),
kinds AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce([4294967295] || list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                                                          lambda x: CAST(ascii(x) AS BIGINT)),
                           lambda c, b: xor(c >> 8, bytes[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS kind
    FROM conversations, crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM kinds JOIN (VALUES (1), (2)) AS c(copy) ON copy = 1 OR kind = 3 WHERE kind <> 0),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again
    FROM (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)),
judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'clean' END AS fault,
           CASE fault WHEN 'clean' THEN 0 WHEN 'truncated' THEN 5 ELSE {_FAR} END AS keep,
           lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS next_initial
    FROM numbered),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (next_initial IS NOT NULL AND initial || next_initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM judged GROUP BY conv_id),
steps AS (
    SELECT conv_id, n, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'b': ''}} AS s0, {{'c': {_FAR}, 'a': '', 'b': ''}} AS s1,
           {{'c': CAST(5 AS BIGINT), 'a': 'I', 'b': {_USER}}} AS s2, {{'c': CAST(10 AS BIGINT), 'a': 'II', 'b': {_USER} || {_ASSISTANT}}} AS s3
    FROM counts
    UNION ALL
    SELECT conv_id, n, i, s0, s1, s2, {_least('s3', _state('s2', '5', 'I', _ASSISTANT))} FROM (
        SELECT conv_id, n, i, s0, s1, s3, {_least('s2', *(_state(q, '5', 'I', _USER) for q in ('s0', 's1', 's3')))} AS s2 FROM (
            SELECT s.conv_id, s.n, j.i, {_state('s0', '2', 'D')} AS s0,
                   {_least(_state('s1', '2', 'D'), _kept('s0', 's'))} AS s1,
                   {_least(_state('s2', '2', 'D'), *(_kept(q, 'u') for q in ('s0', 's1', 's3')), *(_rerole(q, _USER) for q in ('s0', 's1', 's3')))} AS s2,
                   {_least(_state('s3', '2', 'D'), _kept('s2', 'a'), _rerole('s2', _ASSISTANT))} AS s3
            FROM steps s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.i = s.i + 1))),
ends AS (SELECT conv_id, {_least('s0', 's3')} AS s FROM steps WHERE i = n)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(s.c, 0) AS cost, coalesce(s.a, '') AS audit, sha256(coalesce(substr(s.b, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

SQL: dict[str, str] = {
    "op4_tool_call_linking": """
WITH RECURSIVE calls AS (
    SELECT conv_id, turn, conv_id || ':' || turn AS call_id, conv_id || ':' || (turn - 2) AS after, text
    FROM conversations WHERE role = 'user'),
results AS (
    SELECT conv_id, turn, conv_id || ':' || (turn - 1) AS call_id, text AS content
    FROM conversations WHERE role = 'assistant'),
levels AS (
    SELECT call_id, 0::BIGINT AS level FROM calls WHERE after NOT IN (SELECT call_id FROM calls)
    UNION ALL
    SELECT c.call_id, l.level + 1 FROM levels l JOIN calls c ON c.after = l.call_id),
checked AS (
    SELECT c.*, l.level, r.call_id IS NOT NULL AS answered,
           concat_ws('; ', CASE WHEN length(text) < 20 THEN 'text: below 20' END,
                     CASE WHEN length(text) > 300 THEN 'text: above 300' END) AS errors
    FROM calls c JOIN levels l USING (call_id) LEFT JOIN results r USING (call_id))
SELECT conv_id, turn, 'call' AS kind, call_id, 2 * level AS step,
       CASE WHEN answered THEN 'linked' ELSE 'unanswered' END AS status, errors = '' AS valid, errors,
       '{"arguments":{"text":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '},"id":"' || call_id || '","name":"reply","role":"call"}' AS json
FROM checked
UNION ALL
SELECT r.conv_id, r.turn, 'result', r.call_id, 2 * c.level + 1,
       CASE WHEN c.call_id IS NULL THEN 'orphan' ELSE 'linked' END, TRUE, '',
       '{"content":' || CAST(to_json(content) AS VARCHAR) || ',"id":"' || r.call_id || '","role":"result"}'
FROM results r LEFT JOIN checked c USING (call_id)
UNION ALL
SELECT conv_id, turn, 'message', NULL, NULL, 'plain', TRUE, '',
       '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
""",
    "op5_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op12_hard_negative_mining": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
near AS (
    SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM near p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
""",
    "op13_conversation_repair": REPAIR,
}
