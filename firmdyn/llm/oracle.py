"""DuckDB SQL of the queries that SQL can express over whole tables."""

BLOOM_DEDUP = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha AS text_sha256
FROM d WINDOW w AS (PARTITION BY sha)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]
                        FOR i IN range(1, len(words) - 1)]) END AS shingles FROM w),
e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM e a JOIN e b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM shared JOIN s sx ON sx.doc_id = x JOIN s sy ON sy.doc_id = y
  WHERE 100 * n >= 85 * (len(sx.shingles) + len(sy.shingles) - n)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s
  UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON reach.other = link.x)
SELECT s.doc_id, len(shingles) AS n_shingles, c.component AS component_id,
       s.doc_id = c.component AS kept
FROM s JOIN (SELECT doc_id, min(other) AS component FROM reach GROUP BY 1) c USING (doc_id)
"""

RULE_CASCADE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
g AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS gram
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    len([x FOR x IN words IF regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')]) AS alpha_words,
    len([x FOR x IN words IF regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')]) AS upper_words,
    len([i FOR i IN range(2, len(words) + 1) IF words[i] = words[i - 1]]) AS echo_words
  FROM w LEFT JOIN covered c USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR (n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines) OR 10 * echo_words > 3 * n_words
       OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * alpha_words < 7 * n_words
       OR 2 * upper_words > n_words) AS kept
FROM b
"""

CHAT_SNAPSHOTS = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations),
n AS (
  SELECT conv_id, row_number() OVER w AS nth, role, text,
    count(*) OVER (PARTITION BY conv_id) AS length,
    string_agg(coalesce('r' || length(role) || role, '-') || coalesce('t' || length(text) || text, '-'), '')
      OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
            ROWS UNBOUNDED PRECEDING) AS so_far
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
whole AS (
  SELECT so_far, min(conv_id) AS conv_id, count(*) AS n_equal FROM n WHERE nth = length
  GROUP BY so_far HAVING so_far NOT IN (SELECT so_far FROM n WHERE nth < length))
SELECT conv_id, nth, '<|im_start|>' || coalesce(replace(regexp_replace(regexp_replace(
    role, '<(\\*)\|', '<\1\\|', 'g'), '<(\\*)n>', '<\1\\n>', 'g'), chr(10), '<n>'), 'unknown') || chr(10)
  || coalesce(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'), '')
  || '<|im_end|>' || chr(10) AS segment, n_equal
FROM n JOIN whole USING (conv_id)
"""

FILL_IN_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
h AS (
  SELECT doc_id, text, n, [('0x' || substr(digest, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS h FROM d),
c AS (
  SELECT doc_id, text, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || substr(text, 1, low) || '<S>' || substr(text, high + 1) || '<M>' || substr(text, low + 1, high - low)
    ELSE '<S>' || substr(text, high + 1) || '<P>' || substr(text, 1, low) || '<M>' || substr(text, low + 1, high - low)
    END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
"""

REPEATED_STRINGS = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS raw FROM documents),
w AS (
  SELECT r, doc_id, i, raw[i:i + 49] AS s
  FROM (SELECT r, doc_id, raw, unnest(range(1, octet_length(raw) - 48)) AS i FROM d)),
least AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING count(*) > 1),
hit AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before
  FROM w JOIN least USING (s) WHERE least < doc_id),
span AS (
  SELECT r, min(i) AS a, max(i) + 50 AS b
  FROM (SELECT r, i, count(*) FILTER (before IS NULL OR i > before + 50) OVER (PARTITION BY r ORDER BY i) AS nth FROM hit)
  GROUP BY r, nth),
keep AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 1) AS rest FROM span),
cut AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS rest,
    string_agg(hex(raw[rest:a - 1]), '' ORDER BY a) AS front
  FROM keep JOIN d USING (r) GROUP BY r)
SELECT doc_id, octet_length(raw) AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN n_spans IS NULL THEN raw ELSE unhex(front || hex(raw[rest:])) END) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

SQL: dict[str, str] = {"op4_rule_cascade": RULE_CASCADE,
                       "op5_bloom_exact_dedup": BLOOM_DEDUP,
                       "op8_chat_snapshots": CHAT_SNAPSHOTS,
                       "op9_coordinate_minhash": NEAR_DUPLICATES,
                       "op11_fim_arrow": FILL_IN_MIDDLE,
                       "op13_suffix_dedup": REPEATED_STRINGS}
