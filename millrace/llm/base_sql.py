"""DuckDB's SQL for the columns of op2, op4 and op5 that SQL can express.

The fixed kinds of spans are found again by plain regular expressions: the texts between the
matches and the matches themselves give the places by running sums of their lengths. The
likeness of versions is counted on the paragraphs themselves, without digests or sketches.
"""

from __future__ import annotations

from .fingerprints import PIECE

#: Patterns of the contract (fixed values); the words of the first in either case.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(rank: int, kind: str, pattern: str, holds: str) -> str:
    """SELECT of (doc_id, rank, kind, place, upto) of the matches m for which ``holds``."""
    p = _text(pattern)
    return f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, place, place + length(m) AS upto FROM (
    SELECT doc_id, m, CAST(sum(length(apart) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS BIGINT) AS place FROM (
      SELECT doc_id, unnest(ms) AS m, unnest(parts[1:len(ms)]) AS apart, unnest(range(len(ms))) AS i FROM (
        SELECT doc_id, regexp_extract_all(text, {p}) AS ms, string_split_regex(text, {p}) AS parts FROM d) AS q) AS r) AS s
  WHERE {holds}"""


def _base(kinds: list[tuple[str, str, str]], order: str) -> str:
    """The counts and the digest of all spans by ``order``: one row per document, ids being unique."""
    found = " UNION ALL ".join(_spans(i, *kind) for i, kind in enumerate(kinds))
    counts = ", ".join(f"count(*) FILTER (s.kind = '{k}') AS n_{k}" for k, _, _ in kinds)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({found})
SELECT d.doc_id, {", ".join(f"CAST(n_{k} AS BIGINT) AS n_{k}" for k, _, _ in kinds)}, sha256(coalesce(spans, '')) AS base_sha256
FROM (SELECT d.doc_id, {counts}, string_agg(s.kind || ':' || s.place || ':' || s.upto, ',' ORDER BY {order}) AS spans
      FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id) AS d
"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
#: Every second digit from the right is doubled, and 9 taken off where that is above 9.
_LUHN = f"""list_sum(list_transform(range(length({_DIGITS})), lambda i: CASE WHEN i % 2 = 0 THEN CAST({_DIGITS}[length({_DIGITS}) - i] AS INTEGER)
    ELSE CAST({_DIGITS}[length({_DIGITS}) - i] AS INTEGER) * 2 - CASE WHEN CAST({_DIGITS}[length({_DIGITS}) - i] AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""

SECRETS_SQL = _base(
    [("assign", ASSIGN, f"length(regexp_extract(m, {_text(ASSIGN)}, 2)) >= 12"), ("access", ACCESS, "length(m) >= 18"), ("hex", HEX, "length(m) >= 16")],
    "s.place, s.rank",
)

PII_SQL = _base(
    [
        ("email", EMAIL, "true"),
        ("ip", IP, "list_bool_and(list_transform(string_split(m, '.'), lambda x: CAST(x AS DOUBLE) <= 255))"),
        ("card", CARD, f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}"),
        ("phone", PHONE, f"length({_DIGITS}) BETWEEN 8 AND 15"),
    ],
    "s.rank, s.place",
)

VERSIONS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, length(text) AS n_chars, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text FROM d WINDOW o AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT *, substr(text, 1, n_chars - n_chars // 3) || substr(next_text, 1, n_chars // 3) AS edited FROM n),
p AS (SELECT doc_id, n_chars, edited, {", ".join(f"list_distinct(regexp_extract_all({t}, {_text(PIECE)})) AS {a}" for t, a in (("text", "t"), ("edited", "e"), ("next_text", "x")))} FROM e),
c AS (SELECT *, len(list_intersect(t, e)) AS both_e, len(list_intersect(t, x)) AS both_x FROM p)
SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
       CASE WHEN len(t) + len(e) = 0 THEN 1.0::DOUBLE ELSE CAST(both_e AS DOUBLE) / (len(t) + len(e) - both_e) END AS near_edited,
       CASE WHEN len(t) + len(x) = 0 THEN 1.0::DOUBLE ELSE CAST(both_x AS DOUBLE) / (len(t) + len(x) - both_x) END AS near_next
FROM c
"""
