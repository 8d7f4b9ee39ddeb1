"""Checking SQL of the operators that SQL can express; the others are tested against brute force."""

from ledgerline.llm.warc import BLANKS, CONTROL, CUTS, DERIVED_DATE, ENTITIES, PAGE_HEADERS

OP1_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(replace(replace(text, '\', '\b'), '<', '\l'))
    + length(replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g')) + length('<turn role=></turn>') + 1 AS size
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _text(value: str) -> str:
    """A string literal."""
    parts = ["'" + part.replace("'", "''") + "'" for part in value.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


def _plain(column: str) -> str:
    for pattern, replacement in CUTS:
        column = f"regexp_replace({column}, {_text(pattern)}, {_text(replacement)}, 'g')"
    for entity, char in ENTITIES:
        column = f"replace({column}, {_text(entity)}, {_text(char)})"
    return f"trim({column})"


def _uuid(text: str) -> str:
    parts = " || '-' || ".join(f"substr(sha256({text}), {at}, {size})" for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('<urn:uuid:' || {parts} || '>')"


def _uri(column: str) -> str:
    for code in CONTROL:
        column = f"replace({column}, chr({code}), '%{code:02X}')"
    return column


def _one_line(text: str) -> str:
    return f"trim(regexp_replace({text}, '{BLANKS}', ' ', 'g'))"


_TITLE = _one_line("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1)")
_HEADERS = "".join(f" || 'source-header: {line}' || crlf" for line in PAGE_HEADERS.split("\r\n") if line)

OP8_WARC = rf"""
WITH page AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, chr(13) || chr(10) AS crlf FROM pages
), source AS (
  SELECT *, {_uuid("'response|' || coalesce(page_id::VARCHAR, '') || '|' || url || '|' || html")} AS refers_to,
    'sha256:' || sha256(html) AS source_digest
  FROM page
), made AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
    'source-payload-digest: ' || source_digest || crlf || 'source-payload-length: ' || strlen(html) || crlf {_HEADERS}
    || 'title: ' || {_TITLE} || crlf
    || 'language: ' || regexp_extract(html, '(?i)<html[^>]*\blang=["'']?([A-Za-z-]+)', 1) || crlf
    || 'outlinks: ' || (len(regexp_split_to_array(html, '(?i)<a\s[^>]*href=')) - 1) || crlf
    || 'conversion: ' || {_uuid("refers_to || '|conversion'")} || crlf AS block
  FROM source
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', {_plain("html")} FROM source
)
SELECT page_id, record_type, {_uuid("refers_to || '|' || record_type")} AS record_id, refers_to, {_uri('url')} AS target_uri,
  '{DERIVED_DATE}' AS refers_to_date, '{DERIVED_DATE}' AS date, source_digest, content_type,
  strlen(block)::BIGINT AS content_length, 'sha256:' || sha256(block) AS block_digest, block
FROM made
"""

# The cheapest edits row by row, for each state the least (cost, edits, repaired rows) that reaches it; written apart from
# the operator, which works on blocks of rows from the end.
OP12_REPAIR = r"""
WITH RECURSIVE original AS (
  SELECT row_number() OVER (ORDER BY conv_id NULLS FIRST) AS k, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)
), keyed AS (
  SELECT o.k, c.turn, coalesce(c.role, ' ') AS role, coalesce(c.text, ' ') AS text,
    coalesce(c.conv_id::VARCHAR, ' ') || ':' || coalesce(c.turn::VARCHAR, ' ') AS key
  FROM conversations c JOIN original o ON o.conv_id IS NOT DISTINCT FROM c.conv_id
), kinds AS (
  SELECT key, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda bits, i: xor(bits >> 1, 3988292384 * (bits & 1)))), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT key FROM keyed)
), changed AS (
  SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed JOIN kinds USING (key)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM changed
), faults AS (
  SELECT *, left(role, 1) AS mark, lag(left(role, 1)) OVER (PARTITION BY k ORDER BY i) AS mark_before,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut
  FROM placed
), rows AS (
  SELECT k, i, role, text, CASE WHEN mark IN ('s', 'u', 'a') THEN mark ELSE '-' END AS mark,
    blank OR seen AS must_go, CASE WHEN cut THEN 1 ELSE 0 END AS fault FROM faults
), counts AS (
  SELECT k, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen) AS duplicate,
    count(*) FILTER (NOT blank AND NOT seen AND cut) AS truncated,
    count(*) FILTER (mark_before IS NOT NULL AND mark_before || mark NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY k
), inserts AS (
  SELECT * FROM (VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 2, 'I', ['user:']), (0, 3, 4, 'II', ['user:', 'assistant:']),
    (1, 1, 0, '', []), (1, 2, 2, 'I', ['user:']), (1, 3, 4, 'II', ['user:', 'assistant:']),
    (2, 2, 0, '', []), (2, 3, 2, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 2, 'I', ['user:'])
  ) AS v(q, q2, c, edits, lines)
), edits AS (
  SELECT * FROM (VALUES (0, 's', 'K', 0, 1, NULL), (0, 'u', 'K', 0, 2, NULL), (1, 'u', 'K', 0, 2, NULL), (2, 'a', 'K', 0, 3, NULL),
    (3, 'u', 'K', 0, 2, NULL), (0, '*', 'R', 2, 2, 'user'), (1, '*', 'R', 2, 2, 'user'), (2, '*', 'R', 2, 3, 'assistant'),
    (3, '*', 'R', 2, 2, 'user'), (0, '*', 'D', 3, 0, NULL), (1, '*', 'D', 3, 1, NULL), (2, '*', 'D', 3, 2, NULL), (3, '*', 'D', 3, 3, NULL)
  ) AS v(q, mark, edit, c, q2, role)
), best(k, i, q, b) AS (
  SELECT k, 0::BIGINT, 0, {'c': 0, 'a': '', 'r': []::VARCHAR[]} FROM original
  UNION ALL
  SELECT s.k, r.i, e.q2, min({
      'c': s.b.c + n.c + e.c + CASE WHEN e.edit = 'D' THEN 0 ELSE r.fault END, 'a': s.b.a || n.edits || e.edit,
      'r': list_concat(s.b.r, n.lines, CASE WHEN e.edit = 'D' THEN [] ELSE [coalesce(e.role, r.role) || ':' || r.text] END)})
  FROM best s JOIN rows r ON r.k = s.k AND r.i = s.i + 1 JOIN inserts n ON n.q = s.q
  JOIN edits e ON e.q = n.q2 AND (e.mark = '*' OR e.mark = r.mark) AND (e.edit = 'D' OR NOT r.must_go)
  GROUP BY s.k, r.i, e.q2
), closed AS (
  SELECT s.k, min({'c': s.b.c + n.c, 'a': s.b.a || n.edits, 'r': list_concat(s.b.r, n.lines)}) AS b
  FROM best s LEFT JOIN counts c ON c.k = s.k JOIN inserts n ON n.q = s.q AND n.q2 IN (0, 3)
  WHERE s.i = coalesce(c.n, 0) GROUP BY s.k
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, b.c::BIGINT AS cost, b.a AS audit,
  sha256(array_to_string(b.r, chr(10))) AS repaired_sha256
FROM original o JOIN closed USING (k) LEFT JOIN counts c USING (k)
"""
