"""DuckDB statements for the queries that SQL can express."""

from .licenses import COPYRIGHT_LINE, HEADING, KNOWN_DIGESTS, KNOWN_TEXTS, PHRASES, SPELLINGS, UNLICENSE_HTTP, WARRANTY

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, payload, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d
"""


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lines(text: str) -> str:
    low = f"lower(coalesce({text}, ''))"
    low = f"regexp_replace({low}, {_quote(COPYRIGHT_LINE)}, '', 'g')"
    low = rf"regexp_replace({low}, '[^a-z0-9\n]+', ' ', 'g')"
    low = rf"regexp_replace({low}, ' ?\n *\n[ \n]*', ' ' || chr(12) || ' ', 'g')"
    low = rf"' ' || regexp_replace({low}, ' ?\n ?', ' ' || chr(10) || ' ', 'g') || ' '"
    for old, new in SPELLINGS:
        low = f"replace({low}, ' {old} ', ' {new} ')"
    return low


def _told(line: str) -> str:
    for pattern, phrase in PHRASES:
        line = f"regexp_replace({line}, '{pattern}', '{phrase}', 'g')"
    return line


def _whole(source: str, columns: str) -> str:
    """The canonical form of whole texts from the canonical lines of a source."""
    plain = rf"' ' || trim(regexp_replace(regexp_replace(lines, {_quote(HEADING)}, ''), '[ \n\f]+', ' ', 'g')) || ' '"
    return f"SELECT {columns}, trim(CASE WHEN contains(line, '{WARRANTY}') THEN {_told('line')} ELSE line END) AS whole FROM (SELECT *, {plain} AS line FROM {source})"


_KNOWN = ", ".join(f"({_quote(k)}, {_quote(t)})" for k, t in [*sorted(KNOWN_TEXTS.items()), ("Unlicense", UNLICENSE_HTTP)])
_DIGESTS = ", ".join(f"('{d}', '{k}')" for d, k in sorted(KNOWN_DIGESTS.items()))
LICENSE_SQL = rf"""
WITH texts AS (SELECT licence, {_lines("t")} AS lines FROM (VALUES {_KNOWN}) v(licence, t)),
known AS (SELECT digest, min(licence) AS licence FROM (SELECT sha256(whole) AS digest, licence FROM ({_whole("texts", "licence")}) UNION ALL SELECT digest, licence FROM (VALUES {_DIGESTS}) v(digest, licence)) GROUP BY 1),
d AS (SELECT doc_id, {_lines("text")} AS lines, row_number() OVER () AS r FROM documents),
w AS (SELECT r, doc_id, lines, CASE WHEN whole <> '' THEN sha256(whole) END AS whole FROM ({_whole("d", "r, doc_id, lines")})),
p AS (SELECT r, regexp_replace(unnest(string_split(lines, chr(12))), '^[ 
]+|[ 
]+$', '', 'g') AS x FROM w),
l AS (SELECT r, trim(unnest(string_split(replace(lines, chr(12), chr(10)), chr(10)))) AS line FROM w UNION ALL SELECT r, replace(x, ' ' || chr(10) || ' ', ' ') FROM p WHERE contains(x, chr(10))),
h AS (SELECT r, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS names FROM l JOIN known ON known.digest = sha256(line) WHERE line <> '' GROUP BY r)
SELECT w.doc_id, w.whole AS canonical_sha256, known.licence AS licence, coalesce(h.n, 0) AS n_lines, coalesce(h.names, '') AS line_licences
FROM w LEFT JOIN known ON known.digest = w.whole LEFT JOIN h ON h.r = w.r
"""
