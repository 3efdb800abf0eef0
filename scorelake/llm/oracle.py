"""The results in SQL for DuckDB, of the operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLAIN_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# Lines with their tokens, the templates of each line, and the first and last document of each template.
LINE_TEMPLATES = """
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(range(len(parts))) AS no, unnest(parts) AS line FROM split WHERE text IS NOT NULL),
tokens AS (SELECT doc_id, no, line, list_transform(list_filter(regexp_split_to_array(line, '[ \\t\\x0B\\f\\r]+'), lambda t: t <> ''),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS w FROM lines),
leaves AS (SELECT *, len(w) AS n, len(w) // 3 AS k, concat(len(w), ' ', array_to_string(w[1:3], ' ')) AS leaf FROM tokens WHERE len(w) >= 4),
keys AS (SELECT doc_id, no, unnest(CASE WHEN n >= 9 THEN [
      concat(leaf, chr(10), '0', chr(10), array_to_string(w, ' ')),
      concat(leaf, chr(10), '1', chr(10), array_to_string(w[k + 1 :], ' ')),
      concat(leaf, chr(10), '2', chr(10), array_to_string(w[1 : k], ' '), chr(10), array_to_string(w[2 * k + 1 :], ' ')),
      concat(leaf, chr(10), '3', chr(10), array_to_string(w[1 : 2 * k], ' '))]
    ELSE [concat(leaf, chr(10), '0', chr(10), array_to_string(w, ' '))] END) AS template FROM leaves),
ends AS (SELECT template, min(doc_id) AS first, max(doc_id) AS last FROM keys GROUP BY template),
gone AS (SELECT DISTINCT doc_id, no FROM keys JOIN ends USING (template) WHERE first < last AND doc_id > first),
kept AS (SELECT doc_id, count(*) AS n_lines, count(gone.no) AS n_dropped,
    string_agg(line, chr(10) ORDER BY no) FILTER (WHERE gone.no IS NULL) AS text
  FROM lines LEFT JOIN gone USING (doc_id, no) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, coalesce(n_lines, 0)::INT AS n_lines,
  coalesce(n_dropped, 0)::INT AS n_dropped FROM documents d LEFT JOIN kept k USING (doc_id)
"""

# Windows of the pairs that share enough shingles, and the best one of each pair.
CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {PLAIN_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k FROM (SELECT item_id, {PLAIN_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
items AS (SELECT item_id, n, k, unnest(list_transform(range(1, n - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s FROM b),
counts AS (SELECT item_id, n, k, s, count(*) AS c FROM items GROUP BY ALL),
grams AS (SELECT doc_id, len(w) AS size, k, unnest(range(0, len(w) - k + 1)) AS p,
    unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s
  FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k),
pairs AS (SELECT doc_id, size, item_id, n, k FROM grams JOIN counts USING (k, s) GROUP BY ALL
  HAVING count(*) >= ceil(0.8 * (n - k + 1) - 1e-9)),
windows AS (SELECT *, unnest(range(0, greatest(1, size - n + 1))) AS start, least(n, size) - k + 1 AS span FROM pairs),
held AS (SELECT doc_id, item_id, n, k, size, start, span, g.s, count(*) AS c
  FROM windows w JOIN grams g USING (doc_id, k, size) WHERE g.p >= start AND g.p < start + span GROUP BY ALL),
shared AS (SELECT doc_id, item_id, n, size, start, sum(least(h.c, i.c)) AS inside, any_value(span + n - k + 1) AS summed
  FROM held h JOIN counts i USING (item_id, n, k, s) GROUP BY ALL),
scores AS (SELECT *, inside::DOUBLE / (summed - inside)::DOUBLE AS similarity FROM shared)
SELECT doc_id, item_id, start::INT AS start, least(n, size)::INT AS n_words, similarity FROM scores WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

ORACLE: dict[str, str] = {"op9_line_templates": LINE_TEMPLATES, "op10_contamination": CONTAMINATION}
