"""SQL with the same rows as the queries that SQL can express, for an engine with lists and RE2 patterns.

It follows the definitions and not the plans: windows are counted one by one and blocks are compared
with every template.
"""

from __future__ import annotations

from tidemark.llm import licenses, secret_scan

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _places(kind: str, pattern: str, keep: str) -> str:
    """Rows (k, kind, start, finish, value) of the matches of a pattern: what lies between tells where they are."""
    return f"""
  SELECT k, {secret_scan.KINDS.index(kind)} AS kind, start, start + length(value) AS finish, value FROM (
    SELECT k, value, sum(length(gap)) OVER w + sum(length(value)) OVER w - length(value) AS start FROM (
      SELECT k, unnest(gaps[:len(found)]) AS gap, unnest(found) AS value, generate_subscripts(found, 1) AS pos
      FROM (SELECT k, string_split_regex(text, {_quoted(pattern)}) AS gaps, regexp_extract_all(text, {_quoted(pattern)}) AS found FROM texts)
    ) WINDOW w AS (PARTITION BY k ORDER BY pos)
  ) WHERE {keep}"""


def _secrets() -> str:
    s = secret_scan
    head = s.ASSIGN.rsplit("(", 1)[0].replace("(password", "(?:password")
    run = f"[{s._KEY}]{{{s.WINDOW},}}"
    word = f"(?i:[0-9a-z]*(?:{s.ALLOWED_WORDS})[0-9a-z]*)"
    date = "^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    bits = " ".join(f"WHEN regexp_matches(run, {_quoted(p)}) THEN CAST({b} AS DOUBLE)" for p, b in s.CLASSES)
    entropy = f"list_max([list_aggregate(string_split(substr(run, i + 1, {s.WINDOW}), ''), 'entropy') FOR i IN range(0, length(run) - {s.WINDOW - 1})])"
    names = " ".join(f"WHEN {k} THEN {_quoted(name)}" for k, name in enumerate(s.KINDS))
    spelled = f"string_agg(CASE kind {names} END || ':' || start || ':' || finish, ',' ORDER BY start, kind)"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
base AS (
  {_places("assign", s.ASSIGN.replace("(password", "(?:password"), f"length(regexp_replace(value, {_quoted('^' + head)}, '')) >= {s.ASSIGN_LENGTH}")}
  UNION ALL {_places("access", s.ACCESS, f"length(value) >= {s.ACCESS_LENGTH}")}
  UNION ALL {_places("hex", s.HEX.replace("+", f"{{{s.HEX_LENGTH},}}"), "true")}
),
candidates AS ({_places("entropy", run, "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')")}),
left_over AS (
  SELECT k, start, finish, unnest(string_split(
    CASE WHEN regexp_matches(value, {_quoted(s.IDENTIFIER)}) THEN ''
         WHEN regexp_matches(value, {_quoted(date)}) THEN ' ' || regexp_replace(substr(value, 11), {_quoted("([^0-9A-Za-z])" + word)}, '\\1 ', 'g')
         ELSE regexp_replace(value, {_quoted("(^|[^0-9A-Za-z])" + word)}, '\\1 ', 'g') END, ' ')) AS run
  FROM candidates
),
high AS (
  SELECT DISTINCT k, {s.KINDS.index("entropy")} AS kind, start, finish FROM left_over
  WHERE length(run) >= {s.WINDOW} AND regexp_matches(run, '[0-9]') AND regexp_matches(run, '[A-Za-z]')
    AND {entropy} >= CASE {bits} END
),
spans AS (
  SELECT k, kind, start, finish FROM base
  UNION ALL
  SELECT * FROM high h WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.k = h.k AND h.start < b.finish AND b.start < h.finish)
),
spelled AS (
  SELECT k, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         {spelled} FILTER (kind < 3) AS base, {spelled} AS spans
  FROM spans GROUP BY k
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN spelled USING (k)"""


def _licenses() -> str:
    s = licenses
    word = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
    half = s.block_words(s.TEMPLATES) // 2
    phrases = ", ".join(f"({k}, {_quoted(label)}, string_split({_quoted(phrase)}, ' '))" for k, (phrase, label) in enumerate(s.PHRASES))
    templates = ", ".join(f"({k}, {_quoted(label)}, list_distinct(string_split({_quoted(text)}, ' ')))" for k, (label, text) in enumerate(s.TEMPLATES))
    return f"""
WITH phrases(p, label, tokens) AS (VALUES {phrases}),
templates(t, label, tokens) AS (VALUES {templates}),
texts AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER}, {_quoted(word)}) AS words FROM documents),
places AS (
  SELECT k, label, i AS pos FROM texts, phrases, range(0, len(words)) AS r(i)
  WHERE words[i + 1] = tokens[1] AND words[i + 1 : i + len(tokens)] = tokens
),
base AS (
  SELECT k, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_distinct(list(label)) AS base FROM places GROUP BY k
),
blocks AS (
  SELECT k, list_distinct(words[b * {half} + 1 : b * {half} + {2 * half}]) AS held
  FROM texts, range(0, greatest(0, (len(words) - 1) // {half} - 1) + 1) AS r(b)
),
matched AS (
  SELECT k, label, len(list_intersect(held, tokens)) AS shared, len(tokens) AS size
  FROM blocks, templates WHERE len(list_intersect(held, tokens)) >= ceil({s.THRESHOLD} * len(tokens) - 1e-9)
),
best AS (
  SELECT k, list_distinct(list(label)) AS found, max(shared / size) AS score FROM matched GROUP BY k
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(score, 0) END AS score
FROM texts LEFT JOIN base USING (k) LEFT JOIN best USING (k)"""


ORACLES = {"op1_license_scan": _licenses(), "op7_secret_scan": _secrets()}
