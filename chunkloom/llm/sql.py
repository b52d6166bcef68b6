"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_GAP = "'[\\x20\\x09-\\x0D]+'"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), {_GAP}), lambda x: x <> '')"


def _windows(w: str, k: int) -> str:
    return f"list_transform(range(1, len({w}) - {k - 2}), lambda i: array_to_string({w}[i:i + {k - 1}], ' '))"


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op1_line_dedup": f"""WITH ln AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
w AS (SELECT doc_id, i, line, doc_id * 1000000 + i AS pos, list_sort(list_distinct({_words("line")})) AS k FROM ln),
sets AS (SELECT k, len(k) AS n, min(pos) AS first FROM w WHERE len(k) > 0 GROUP BY k),
tok AS (SELECT first AS id, n, unnest(k) AS t FROM sets),
df AS (SELECT t, count(*) AS c FROM tok GROUP BY t),
pre AS (SELECT id, n, t FROM tok JOIN df USING (t) QUALIFY row_number() OVER (PARTITION BY id ORDER BY c, t) <= n - ceil(0.8 * n - 1e-9) + 1),
cand AS (SELECT DISTINCT a.id AS x, b.id AS y FROM pre a JOIN pre b USING (t) WHERE a.id > b.id AND a.n >= 0.8 * b.n - 1e-9 AND b.n >= 0.8 * a.n - 1e-9),
late AS (SELECT DISTINCT x FROM cand JOIN sets a ON a.first = x JOIN sets b ON b.first = y
  WHERE len(list_intersect(a.k, b.k)) >= 0.8 * (a.n + b.n - len(list_intersect(a.k, b.k))) - 1e-9),
g AS (SELECT w.*, coalesce(pos > first OR first IN (SELECT x FROM late), false) AS gone FROM w LEFT JOIN sets USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM g GROUP BY doc_id""",
    "op5_benchmark_decontamination": f"""WITH d AS (SELECT doc_id, {_words(_LOWER.format("text"))} AS w FROM documents),
b AS (SELECT item_id, {_words(_LOWER.format("text"))} AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, unnest({_windows("w", 5)}) AS g FROM b),
n AS (SELECT item_id, count(*) AS item_shingles FROM i GROUP BY 1),
s AS (SELECT DISTINCT doc_id, unnest({_windows("w", 5)}) AS g FROM d)
SELECT doc_id, item_id, item_shingles, count(*) AS shared, count(*) / CAST(item_shingles AS DOUBLE) AS containment
FROM s JOIN i USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id, item_shingles HAVING count(*) >= 0.8 * item_shingles""",
    "op7_substring_dedup": f"""WITH d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
g AS (SELECT doc_id, unnest({_windows("w", 35)}) AS g, unnest(range(1, len(w) - 33)) AS i FROM d),
twice AS (SELECT g FROM g GROUP BY g HAVING count(*) > 1),
hits AS (SELECT DISTINCT doc_id, i FROM g JOIN twice USING (g)),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM hits, range(0, 35) AS r(k)),
spans AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM gone) WHERE q IS NULL OR q < p - 1 GROUP BY doc_id),
lists AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY words.p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(lists.n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256, CAST(coalesce(spans.n, 0) AS INTEGER) AS n_spans
FROM d LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)""",
    "op10_quality_rules": f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_words("text")} AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, unnest({_windows("w", 3)}) AS g, unnest(range(1, len(w) - 1)) AS i FROM d),
hits AS (SELECT doc_id, i FROM g JOIN (SELECT doc_id, g FROM g GROUP BY ALL HAVING count(*) > 1) USING (doc_id, g)),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM hits, range(0, 3) AS r(k) GROUP BY doc_id),
m AS (SELECT doc_id, t, len(w) AS n_words, length(regexp_replace(t, {_GAP}, '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, length(t) AS n_chars,
  length(t) - length(replace(t, '!', '')) AS marks, length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS capitals
  FROM d LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 5 * marks > n_words OR 10 * capitals > 3 * n_chars OR 2 * n_dup_lines > n_lines
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept FROM f""",
}
