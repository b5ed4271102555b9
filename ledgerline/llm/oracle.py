"""DuckDB SQL of the operators that SQL can express."""

LINE_DEDUP = r"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
runs AS (
  SELECT doc_id, i, k, lines[i:i + k - 1] AS run, k = len(lines) AND text <> '' AS whole
  FROM docs, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(lines) - k + 2)) AS t(i)
),
later AS (
  SELECT doc_id, i, k FROM (
    SELECT doc_id, i, k, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS n
    FROM runs
    WHERE k = 3 OR whole OR len(regexp_extract_all(array_to_string(run, chr(10)), '[^\x20\x09-\x0D]+')) >= 50
  ) WHERE n > 1
),
gone AS (SELECT doc_id, list(DISTINCT i + j) AS at FROM later, unnest([0, 1, 2]) AS t(j) WHERE j < k GROUP BY doc_id)
SELECT d.doc_id,
       CAST(coalesce(len(d.lines), 0) AS INTEGER) AS n_lines,
       CAST(coalesce(len(g.at), 0) AS INTEGER) AS n_removed,
       CASE WHEN g.at IS NULL THEN d.text
            ELSE array_to_string(list_filter(d.lines, lambda l, j: NOT list_contains(g.at, j)), chr(10)) END AS text
FROM docs d LEFT JOIN gone g ON d.doc_id = g.doc_id
"""

SUBSTRING_DEDUP = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS w FROM docs, unnest(range(1, len(words) - 48)) AS t(i)
),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS first FROM windows) WHERE doc_id > first
),
gone AS (
  SELECT doc_id, list(j) AS at
  FROM (SELECT DISTINCT doc_id, i + k AS j FROM later, unnest(range(50)) AS t(k))
  GROUP BY doc_id
)
SELECT d.doc_id,
       CAST(len(d.words) AS BIGINT) AS n_words,
       CAST(coalesce(len(g.at), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(
         CASE WHEN g.at IS NULL THEN d.words ELSE list_filter(d.words, lambda w, j: NOT list_contains(g.at, j)) END, ' '
       )) AS kept_sha256
FROM docs d LEFT JOIN gone g ON d.doc_id = g.doc_id
"""

DECONTAMINATION = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'i', item_id, text FROM benchmark
),
words AS (
  SELECT side, id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM texts WHERE text IS NOT NULL AND id IS NOT NULL
),
shingles AS (
  SELECT DISTINCT side, id, array_to_string(w[i:i + 4], ' ') AS s FROM words, unnest(range(1, len(w) - 3)) AS t(i)
),
sizes AS (SELECT id AS item_id, count(*) AS n FROM shingles WHERE side = 'i' GROUP BY id),
pairs AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS common
  FROM shingles d JOIN shingles i ON d.s = i.s
  WHERE d.side = 'd' AND i.side = 'i' GROUP BY d.id, i.id
)
SELECT doc_id, item_id, common AS n_common, n AS n_shingles, common / n AS containment
FROM pairs JOIN sizes USING (item_id) WHERE common >= ceil(0.8 * n - 1e-9)
"""

FILTER_AUDIT = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
failures AS (
  SELECT d.part, coalesce(m.good, false) AS good, coalesce(m.bad, false) AS bad,
         [len(words) < 100,
          100 * len(list_distinct(words)) < 80 * len(words),
          100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 10 * length(body),
          regexp_matches(body, '[#$%&*|]'),
          coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY body), false)] AS f
  FROM docs d LEFT JOIN marks m ON d.doc_id = m.doc_id
),
groups AS (SELECT part, good, bad, f, count(*) AS n FROM failures GROUP BY ALL),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
),
steps AS (
  SELECT array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, s AS step,
         o[1:s - 1] AS earlier, o[s] AS own
  FROM orders, unnest([1, 2, 3, 4, 5]) AS t(s)
),
judged AS (
  SELECT part, filter_order, step, own, n, good, bad, f[own] AS fails,
         len(list_filter(earlier, lambda i: f[i])) > 0 AS gone,
         len(list_filter(f, lambda x: x)) = 1 AS single
  FROM groups, steps
),
sums AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant,
         coalesce(sum(n) FILTER (fails AND single), 0) AS unique_fails,
         coalesce(sum(n) FILTER (NOT gone AND fails AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (NOT gone AND fails AND bad), 0) AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM sums
"""

ORACLE = {
    "op1_line_dedup": LINE_DEDUP,
    "op3_substring_dedup": SUBSTRING_DEDUP,
    "op6_decontamination": DECONTAMINATION,
    "op13_filter_interaction_audit": FILTER_AUDIT,
}

#: Of the variants in queries.VARIANTS.
VARIANT_ORACLE = {"op1_line_dedup_short": LINE_DEDUP}
