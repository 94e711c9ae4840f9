"""SQL that gives the same rows as some of the queries, over the same tables."""

from __future__ import annotations

import string

from claimloom.llm.merkle import ENDS, SHORT

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

#: Links by counting shared shingles, components by following links from every document.
NEAR_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a
  JOIN shingles b ON a.t = b.t AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS id, doc_id AS low FROM sets UNION SELECT sides.b, low FROM reached JOIN sides ON sides.a = reached.id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(low) AS component_id, doc_id = min(low) AS kept
FROM sets JOIN reached ON id = doc_id GROUP BY doc_id, s
"""


def _pieces(paragraph: str) -> str:
    ends = "".join(ENDS)
    return f"regexp_extract_all({paragraph}, '[^{ends}]*[{ends}]|[^{ends}]+')"


def _mark(text: str) -> str:
    """The fingerprint of a text expression."""
    pieces = f"list_transform({_pieces('p')}, lambda x: md5(x))"
    paragraphs = "list_transform(string_split(s, chr(10)), lambda p: {})"
    sections = f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: {{}})"
    joined = "array_to_string({}, '{}')"
    root = joined.format(sections.format(f"md5({joined.format(paragraphs.format(f'md5({joined.format(pieces, ",")})'), ',')})"), ",")
    short = f"list_transform({_pieces('p')}, lambda x: substr(md5(x), 1, {SHORT}))"
    listed = joined.format(sections.format(joined.format(paragraphs.format(joined.format(short, ",")), ".")), "/")
    return f"md5({root}) || ':' || {listed}"


def _set(mark: str) -> str:
    return f"list_filter(list_distinct(string_split(replace(replace(substr({mark}, 34), '.', ','), '/', ','), ',')), lambda x: x <> '')"


def _like(mine: str, other: str) -> str:
    shared = f"2.0::DOUBLE * len(list_intersect({_set(mine)}, {_set(other)})) / greatest(1, len({_set(mine)}) + len({_set(other)}))"
    return f"CASE WHEN {mine} = {other} THEN 1.0::DOUBLE ELSE {shared} END"


MERKLE_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id), '') AS next FROM documents
), edits AS (
  SELECT *, length(text) AS n, substr(text, 1, length(text) - length(text) // 4) || substr(next, 1, length(text) // 4) AS edited FROM texts
), marks AS (
  SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, {_mark("text")} AS fingerprint, {_mark("edited")} AS edited_fingerprint,
    {_mark("next")} AS next_fingerprint FROM edits
)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  {_like("fingerprint", "edited_fingerprint")} AS near_edited, {_like("fingerprint", "next_fingerprint")} AS near_next
FROM marks
"""


def _escaped(text: str) -> str:
    text = f"replace({text}, chr(92), chr(92) || chr(92))"
    for control in ("turn>", "body>", "/turn>", "|endoftext|>"):
        text = f"replace({text}, '<{control}', '<' || chr(92) || '{control}')"
    return text


CHAT_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), '') AS loss,
    sum(19 + length({_escaped("role")}) + length({_escaped("text")}))::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM whole
"""


_QUINT = "translate(to_base(('0x' || substr(sha1(html), 5 * i + 1, 5))::BIGINT, 32, 4), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"
WARC_SQL = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
placed AS (
  SELECT *, row_number() OVER same = 1 AS first, first_value(page_id) OVER same AS head FROM p
  WINDOW same AS (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST)
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, array_to_string(list_transform(range(8), lambda i: {_QUINT}), '') AS payload_digest,
  CASE WHEN first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN NOT first THEN head END AS refers_to
FROM placed
"""
