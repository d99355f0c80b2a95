"""DuckDB SQL of the queries that SQL can express.

The others are fitted or use tokenizers, vectors or a search, which SQL has not (or not at
a bearable cost): the tests compare them with brute force.
"""

from __future__ import annotations

EXACT_DEDUP = """
WITH digests AS (
  SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       text_sha256
FROM digests
WINDOW same AS (PARTITION BY text_sha256)
"""

WARC = """
WITH payloads AS (
  SELECT page_id,
         octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT *,
         min(page_id) OVER (PARTITION BY payload_digest) AS first_id,
         payload_bytes >= 100 AND page_id <> min(page_id) OVER (PARTITION BY payload_digest) AS again
  FROM payloads
)
SELECT page_id,
       CAST(payload_bytes AS BIGINT) AS payload_bytes,
       payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to
FROM firsts
"""

# Marks of a turn take 13 characters; marked characters in roles and texts take one more.
CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *,
         13 + length(role) + length(text)
            + length(regexp_replace(role || text, '[^\\<\[|]', '', 'g')) AS chars,
         CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned
  FROM turns
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(length(learned)) AS BIGINT) AS loss_chars,
       sha256(string_agg(learned, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized
GROUP BY conv_id
"""

# The cheapest edits, state by state; of equally cheap ones the least in ASCII. DuckDB has no crc32.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
           list_concat([CAST(i AS UBIGINT)], list_transform(range(8), lambda z: CAST(0 AS UBIGINT))),
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END)) AS entries
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), drawn AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(
           list_concat([CAST(4294967295 AS UBIGINT)],
                       list_transform(range(1, length(key) + 1), lambda i: CAST(ord(substr(key, i, 1)) AS UBIGINT))),
           lambda c, b: xor(c >> 8, entries[CAST(xor(c, b) & 255 AS INTEGER) + 1])), CAST(4294967295 AS UBIGINT)) % 20 AS kind
  FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM drawn WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place FROM damaged
), judged AS (
  SELECT *, substr(role, 1, 1) AS initial,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault
  FROM numbered
), inserts(p, added, r, turns) AS (
  VALUES (0, '', 0, []), (1, '', 1, []), (2, '', 2, []), (3, '', 3, []),
         (0, 'I', 2, ['user:']), (1, 'I', 2, ['user:']), (3, 'I', 2, ['user:']), (2, 'I', 3, ['assistant:']),
         (0, 'II', 3, ['user:', 'assistant:']), (1, 'II', 3, ['user:', 'assistant:']),
         (3, 'II', 3, ['user:', 'assistant:']), (2, 'II', 2, ['assistant:', 'user:'])
), steps(r, letter, initial, q) AS (
  VALUES (0, 'D', NULL, 0), (1, 'D', NULL, 1), (2, 'D', NULL, 2), (3, 'D', NULL, 3),
         (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
         (0, 'R', NULL, 2), (1, 'R', NULL, 2), (3, 'R', NULL, 2), (2, 'R', NULL, 3)
), paths AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS place, 0 AS state, {'cost': 0, 'audit': '', 'turns': CAST([] AS VARCHAR[])} AS best
  FROM damaged
  UNION ALL
  SELECT p.conv_id, j.place, s.q,
         min({'cost': p.best.cost + 5 * length(i.added)
                      + CASE s.letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
                      + CASE WHEN s.letter <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END,
              'audit': p.best.audit || i.added || s.letter,
              'turns': list_concat(list_concat(p.best.turns, i.turns), CASE s.letter WHEN 'D' THEN []
                WHEN 'K' THEN [j.role || ':' || j.text]
                ELSE [CASE s.q WHEN 2 THEN 'user:' ELSE 'assistant:' END || j.text] END)})
  FROM paths p
  JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.place = p.place + 1
  JOIN inserts i ON i.p = p.state
  JOIN steps s ON s.r = i.r AND (s.letter = 'D' OR j.fault NOT IN ('blank', 'duplicate'))
              AND (s.initial IS NULL OR s.initial = j.initial)
  GROUP BY p.conv_id, j.place, s.q
), counted AS (
  SELECT conv_id, count(*) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (place > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), ended AS (
  SELECT c.conv_id,
         min({'cost': p.best.cost + 5 * length(i.added), 'audit': p.best.audit || i.added,
              'turns': list_concat(p.best.turns, i.turns)}) AS best
  FROM counted c JOIN paths p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.place = c.n
  JOIN inserts i ON i.p = p.state AND (i.r = 3 OR i.r = 0)
  GROUP BY c.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
       CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost, coalesce(e.best.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.best.turns, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), cells AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term
  GROUP BY ALL
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), sizes AS (
  SELECT lang, source, sum(n) AS n FROM cells GROUP BY lang, source
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS count,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (coalesce(s.n, 0) + v.v) AS p
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang
  LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), whole AS (
  SELECT c.lang, c.term,
         1 + (CAST(1000000000 AS HUGEINT) * (sum(c.n) + 1)) // (any_value(t.n) + any_value(v.v)) AS q
  FROM cells c JOIN v ON v.lang = c.lang JOIN (SELECT lang, sum(n) AS n FROM cells GROUP BY lang) t ON t.lang = c.lang
  GROUP BY c.lang, c.term
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, ((s.p - w.q) * (s.p - w.q)) // w.q
  FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term
  WHERE s.count > 0 AND s.p > w.q
), ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_chat_format": CHAT_FORMAT,
        "op8_warc": WARC,
        "op9_exact_dedup": EXACT_DEDUP,
        "op11_conversation_repair": CONVERSATION_REPAIR,
        "op12_source_divergence": SOURCE_DIVERGENCE,
    }
