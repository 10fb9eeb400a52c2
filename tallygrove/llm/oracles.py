"""SQL that the registered queries of this folder must agree with."""

from __future__ import annotations

from tallygrove.llm.license_scan import LOWER, TEMPLATES, UPPER
from tallygrove.llm.url_filter import RULES, TRACKING


def licence_sql(least: float = 0.8) -> str:
    """Join the words of all texts with the words of all templates and count per beginning."""
    rows = ", ".join(
        f"({number}, '{t.label}', {str(t.base).lower()}, {len(t.words)}, {i}, '{word}', "
        f"{int(any(b <= i < e for b, e in t.keys))})"
        for number, t in enumerate(TEMPLATES)
        for i, word in enumerate(t.words)
    )
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH templates(t, label, base, size, i, word, is_key) AS (VALUES {rows}),
keys AS (SELECT t, sum(is_key) AS n_keys FROM templates GROUP BY t),
texts AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{word}') AS words
  FROM documents),
placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM texts),
found AS (
  SELECT doc_id, t, label, base, place - i AS begins, count(*)::DOUBLE / size::DOUBLE AS score
  FROM placed JOIN templates USING (word) JOIN keys USING (t)
  GROUP BY doc_id, t, label, base, size, n_keys, place - i
  HAVING sum(is_key) = n_keys AND count(*)::DOUBLE / size::DOUBLE >= {least}),
summed AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(begins) FILTER (base) AS first_word,
    max(begins) FILTER (base) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(score) AS score
  FROM found GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM texts LEFT JOIN summed USING (doc_id)
"""


def url_sql() -> str:
    """Rules and list membership without a filter: a plain semi-join of canonical forms."""
    rest = "substr(url, instr(url, '://') + 3)"
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
    spam = "(^|\\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\\."
    return f"""
WITH rules(rule_host, rule_path, says) AS (VALUES {rules}),
split AS (
  SELECT page_id, coalesce(instr(url, '://') > 0, false) AS has,
    CASE WHEN has THEN translate(regexp_extract({rest}, '^[^/?#]*'), '{UPPER}', '{LOWER}') ELSE '' END AS host,
    CASE WHEN has THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
    CASE WHEN has THEN list_sort(list_filter(
      string_split(regexp_extract({rest}, '^[^?#]*\\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}'))) END AS more
  FROM pages),
formed AS (
  SELECT page_id, host, path, CASE WHEN has THEN
    regexp_replace(regexp_replace(regexp_replace(
      regexp_replace(host, '^[^@]*@', ''), ':(80|443)?$', ''), '^www\\.', ''), '\\.$', '')
    || regexp_replace(regexp_replace(
      regexp_replace(path, '/+', '/', 'g'), '/index\\.html?$', '/'), '/$', '')
    || CASE WHEN len(more) > 0 THEN '?' || array_to_string(more, '&') ELSE '' END END AS canonical
  FROM split),
listed AS (SELECT DISTINCT canonical FROM formed WHERE regexp_matches(host, '{spam}')),
fitting AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(says, length(rule_host || rule_path)) AS says
  FROM formed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule,
  coalesce(says, CASE WHEN l.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
  f.canonical AS canonical, l.canonical IS NOT NULL AS listed
FROM formed f LEFT JOIN fitting USING (page_id) LEFT JOIN listed l ON l.canonical = f.canonical
"""


ORACLES: dict[str, str] = {"op2_license_scan": licence_sql(), "op12_url_filter": url_sql()}
