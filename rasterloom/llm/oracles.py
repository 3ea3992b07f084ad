"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .secret_scan import RULES



_Q1 = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, CAST(source AS VARCHAR) AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
      list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT k, i, list_slice(words, i, i + 4) AS g FROM w, unnest(range(1, greatest(len(words) - 3, 1))) AS u(i)),
r AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT k, count(DISTINCT i + j) AS n FROM r, (VALUES (0), (1), (2), (3), (4)) AS v(j) GROUP BY k),
m AS (SELECT w.k, doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
      CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep ON w.k = rep.k),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT host, count(*) AS n, CAST(sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS BIGINT) AS f FROM b WHERE host IS NOT NULL GROUP BY host),
s AS (SELECT CAST(sum(n) AS DOUBLE) AS n, sum(f) / CAST(sum(n) AS DOUBLE) AS p, sum(CAST(n AS DOUBLE) * n) AS nn, count(*) AS hosts,
      sum(f * (f / CAST(n AS DOUBLE))) AS fp FROM h),
v AS (SELECT *, CASE WHEN n - nn / n > 0 THEN (fp - n * p * p - p * (1 - p) * (hosts - 1)) / (n - nn / n) ELSE 0 END AS var FROM s),
a AS (SELECT p, least(greatest(CASE WHEN var > 0 THEN p * (1 - p) / var - 1 ELSE 10000 END, 1), 10000) AS q FROM v),
z AS (SELECT host, n, f, (f + p * q) / (n + q) AS rate FROM h, a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(rate > 0.5, FALSE) AS kept, n AS host_docs, f AS host_failed, round(rate, 6) AS host_rate
FROM b LEFT JOIN z ON b.host = z.host
"""


def _letters(regex: str) -> str:
    """(?i:...) written out as classes of both cases, as the engine's own folding goes beyond ASCII."""
    while "(?i:" in regex:
        a = regex.index("(?i:")
        b = regex.index(")", a)
        body = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in regex[a + 4 : b])
        regex = regex[:a] + "(" + "?:" + body + ")" + regex[b + 1 :]
    return regex.replace("'", "''")


def _kind(k: int, rule) -> str:
    regex = _letters(rule.regex)
    return f"""SELECT k, {k} AS o, '{rule.kind}' AS kind, st, st + length(m) AS en FROM (
  SELECT k, unnest(list_transform(range(1, len(ms) + 1), lambda i: struct_pack(m := ms[i], v := vs[i],
    st := CAST(coalesce(list_sum(list_transform(ps[:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[:i-1], lambda x: length(x))), 0) AS BIGINT))), recursive := true)
  FROM (SELECT k, regexp_extract_all(t, '{regex}') AS ms, regexp_extract_all(t, '{regex}', {rule.group}) AS vs, regexp_split_to_array(t, '{regex}') AS ps FROM d WHERE regexp_matches(t, '{regex}'))
) WHERE length(v) >= {rule.min_chars}"""


_BASE = ", ".join(f"'{r.kind}'" for r in RULES if r.base)
_Q3 = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(_kind(k, r) for k, r in enumerate(RULES))}),
g AS (SELECT k, {', '.join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES if r.base)},
  string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, o) FILTER (kind IN ({_BASE})) AS base,
  string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, o) AS spans FROM s GROUP BY k)
SELECT doc_id, {', '.join(f"CAST(coalesce(n_{r.kind}, 0) AS BIGINT) AS n_{r.kind}" for r in RULES if r.base)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g ON d.k = g.k
"""

# From the contract and the grammar: a turn takes 22 characters besides role and text, and one more for each of ~, < and [ where it holds a token.
_Q6 = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
x AS (SELECT *, regexp_matches(role || chr(0) || text, '<s>|<x>|</s>|\\[/?INST\\]') AS holds, length(regexp_replace(role || text, '[^~<\\[]', '', 'g')) AS more FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(length(role) + length(text) + 22 + CASE WHEN holds THEN more ELSE 0 END) AS BIGINT) AS formatted_chars,
  0 AS level, TRUE AS identical
FROM x GROUP BY conv_id
"""

ORACLES = {"op1_quality_rules": _Q1, "op3_secret_scan": _Q3, "op6_chat_format": _Q6}
