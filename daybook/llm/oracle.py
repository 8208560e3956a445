"""SQL twins of the operator queries, where SQL can express them."""

from __future__ import annotations

from daybook.llm.warc import ALPHABET

ORACLE: dict[str, str] = {}

ORACLE["op6_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM sources
), room AS (
  SELECT *, 3.0::DOUBLE * source_size / weight AS room FROM weighed
), shares AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE - 3.0::DOUBLE * coalesce((sum(source_size) OVER (ORDER BY room, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::DOUBLE, 0.0))
    / (sum(weight) OVER (ORDER BY room, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS share FROM room
), targets AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * (max(share) OVER ())) AS target FROM shares
), rated AS (
  SELECT d.doc_id, d.text, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), drawn AS (
  SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '') || '/7'), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS chance FROM rated
)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate)::BIGINT + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""

_LETTERS = ", ".join(
    f"substr('{ALPHABET}', ((('0x' || substr(h, {at // 4 * 5 + 1}, 5))::INTEGER >> {15 - at % 4 * 5}) & 31) + 1, 1)"
    for at in range(32)
)
ORACLE["op7_revisit_archives"] = f"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS original FROM hashed
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, concat({_LETTERS}) AS payload_digest,
  CASE WHEN original > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original > page_id THEN original END AS refers_to
FROM grouped
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))
ORACLE["op9_benchmark_passages"] = f"""
WITH item_words AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, pos, pos + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS pos FROM item_words WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM item_windows),
doc_words AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), doc_windows AS (
  SELECT doc_id, pos, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, (len(w) - n + 2)::BIGINT)) AS pos FROM doc_words, lengths WHERE len(w) >= n)
), hits AS (
  SELECT d.doc_id, d.pos, d.n, i.item_id FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.win = i.win
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(l.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(l.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id
"""

ORACLE["op1_maxscore_search"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS d FROM vectors
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.d = c.d AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
  GROUP BY q.vec_id, c.vec_id
), ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# The parse row by row: the best way to each of the four stack tops, from the best ways before.
ORACLE["op11_conversation_repair"] = r"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
), bits AS (
  SELECT *, flatten(list_transform(string_split(key, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS ops FROM plain
), hashed AS (
  SELECT *, xor(list_reduce(ops, lambda c, o: CASE WHEN o >= 0 THEN xor(c, o)
    ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END, 4294967295::BIGINT), 4294967295) % 20 AS fault FROM bits
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fault = 0 THEN 0 WHEN fault = 3 THEN 2 ELSE 1 END))
  FROM hashed
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged
), judged AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
    CASE WHEN body = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault
  FROM numbered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) AS n,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND (before || initial) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM judged) GROUP BY conv_id
), inserts(top, reached, k, audit, lines) AS (
  VALUES ('', '', 0, '', ''), ('', 'u', 1, 'I', E'user:\n'), ('', 'a', 2, 'II', E'user:\nassistant:\n'),
    ('s', 's', 0, '', ''), ('s', 'u', 1, 'I', E'user:\n'), ('s', 'a', 2, 'II', E'user:\nassistant:\n'),
    ('u', 'u', 0, '', ''), ('u', 'a', 1, 'I', E'assistant:\n'), ('a', 'a', 0, '', ''), ('a', 'u', 1, 'I', E'user:\n')
), edits(letter, price) AS (
  VALUES ('D', 2), ('K', 0), ('R', 1)
), parse(conv_id, i, top, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, '', 0::BIGINT, '', '' FROM judged
  UNION ALL
  SELECT conv_id, i, top, cost, audit, lines FROM (
    SELECT conv_id, i, top, cost, audit, lines, row_number() OVER (PARTITION BY conv_id, top ORDER BY cost, audit) AS place FROM (
      SELECT p.conv_id, r.i,
        CASE WHEN e.letter = 'D' THEN s.reached WHEN e.letter = 'K' THEN r.initial WHEN s.reached = 'u' THEN 'a' ELSE 'u' END AS top,
        p.cost + 5 * s.k + e.price + CASE WHEN e.letter <> 'D' AND r.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
        p.audit || s.audit || e.letter AS audit,
        p.lines || s.lines || CASE WHEN e.letter = 'D' THEN '' ELSE
          CASE WHEN e.letter = 'K' THEN r.role WHEN s.reached = 'u' THEN 'assistant' ELSE 'user' END || ':' || r.text || chr(10) END AS lines
      FROM parse p JOIN judged r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1 JOIN inserts s ON s.top = p.top CROSS JOIN edits e
      WHERE e.letter = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND (e.letter = 'R'
        OR (r.initial = 's' AND s.reached = '') OR r.initial = CASE WHEN s.reached = 'u' THEN 'a' ELSE 'u' END))
    )
  ) WHERE place = 1
), ended AS (
  SELECT p.conv_id, p.cost + 5 * s.k AS cost, p.audit || s.audit AS audit, p.lines || s.lines AS lines,
    row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + 5 * s.k, p.audit || s.audit) AS place
  FROM parse p JOIN counted c ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.n JOIN inserts s ON s.top = p.top
  WHERE s.reached = 'a' OR s.reached = ''
), best AS (
  SELECT c.*, e.cost, e.audit, e.lines FROM counted c JOIN ended e ON c.conv_id IS NOT DISTINCT FROM e.conv_id WHERE e.place = 1
)
SELECT o.conv_id, coalesce(b.gaps, 0)::BIGINT AS gaps, coalesce(b.blank, 0)::BIGINT AS blank,
  coalesce(b.duplicate, 0)::BIGINT AS duplicate, coalesce(b.truncated, 0)::BIGINT AS truncated,
  coalesce(b.illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit,
  sha256(regexp_replace(coalesce(b.lines, ''), '\n$', '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
"""
