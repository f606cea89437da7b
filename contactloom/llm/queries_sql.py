"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from contactloom.llm import chat, licenses, line_dedup, ngram_join, quality_rules

WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def _quality() -> str:
    bits = " + ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, (_, cond) in enumerate(quality_rules.RULES))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS ws,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, p, array_to_string(ws[p:p + 7], ' ') AS win
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS p FROM w WHERE len(ws) >= 8)),
r AS (SELECT doc_id, p FROM g WHERE (doc_id, win) IN (SELECT doc_id, win FROM g GROUP BY doc_id, win HAVING count(*) > 1)),
c AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM r) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclamations,
    length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1]))::BIGINT AS n_stutters,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
b AS (SELECT *, ({bits})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & {quality_rules.BASE.mask}) <> 0 AS base_failed, (fail_bits & {quality_rules.STRICT.mask}) = 0 AS kept, fail_bits
FROM b"""


def _licences() -> str:
    known = "[" + ", ".join(f"'{s}'" for _, s in licenses.SENTENCES) + "]"
    codes = "".join(c for c, _ in licenses.SENTENCES)
    rules = "|".join(r for _, r in licenses.RULES)
    names = "[" + ", ".join(f"'{n}'" for n, _ in licenses.RULES) + "]"
    keys = "[" + ", ".join(f"'{r}'" for _, r in licenses.RULES) + "]"
    bad = "[" + ", ".join(f"'{r}'" for r in licenses.RESTRICTED) + "]"

    def letters(cut: str) -> str:
        plain = f"list_filter(list_transform({cut}, lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '')"
        one = f"list_transform({plain}, lambda s: coalesce(nullif('{codes}'[coalesce(list_position({known}, s), 0)::INT], ''), '.'))"
        return f"regexp_replace(array_to_string({one}, ''), '\\.+', '.', 'g')"

    found = "list_transform(regexp_extract_all({0}, '" + rules + "'), lambda m: " + names + "[list_position(" + keys + ", m)])"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
c AS (SELECT doc_id, {letters(f"string_split_regex(text, '{licenses.STOPS}|' || chr(10))")} AS by_line,
        {letters(f"string_split_regex(replace(text, chr(10), ' '), '{licenses.STOPS}')")} AS joined FROM t),
l AS (SELECT *, list_sort(list_distinct(list_concat({found.format('by_line')}, {found.format('joined')}))) AS ls FROM c)
SELECT doc_id, by_line, joined, array_to_string(ls, ',') AS licences, list_has_any(ls, {bad}) AS restricted FROM l"""


def _chats() -> str:
    esc = "replace(coalesce(text, ''), chr(92), chr(92) || chr(92))"
    for mark in chat.CONTROL:
        esc = f"replace({esc}, '{mark}', '{mark[0]}' || chr(92) || '{mark[1:]}')"
    fixed = len(chat.START) + 1 + len(chat.END) + 1
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({fixed} + length(role) + length({esc}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""


EXACT = f"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{WS}+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)"""

NEAR = f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws
  FROM documents),
g AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(ws[p:p + 2], ' ') AS s
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS p FROM w WHERE len(ws) > 0))),
n AS MATERIALIZED (SELECT doc_id, count(*)::BIGINT AS n FROM g GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE {ngram_join.SHARE_OF} * o >= {ngram_join.SHARE} * (na.n + nb.n - o)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id"""

LINES = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS MATERIALIZED (
  SELECT doc_id, p, line,
    translate(regexp_replace(line, '^{WS}+|{WS}+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM s)),
f AS MATERIALIZED (SELECT k FROM l WHERE length(k) >= {line_dedup.MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {line_dedup.AT_LEAST}),
m AS (SELECT l.*, f.k IS NOT NULL AS hit FROM l LEFT JOIN f ON f.k = l.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (hit)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT hit), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


ORACLES = {
    "op1_quality_rules": _quality(),
    "op4_license_scan": _licences(),
    "op6_chat_formatting": _chats(),
    "op8_exact_dedup": EXACT,
    "op9_ngram_jaccard_join": NEAR,
    "op12_line_dedup": LINES,
}
