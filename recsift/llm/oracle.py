"""DuckDB SQL for the operators that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH base AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
pos AS (
  SELECT row, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS w FROM base),
win AS (
  SELECT row, i, w, lead(w, 1) OVER p AS w1, lead(w, 2) OVER p AS w2 FROM pos WINDOW p AS (PARTITION BY row ORDER BY i)),
hit AS (
  SELECT row, i, CASE WHEN w2 IS NOT NULL AND count(*) OVER (PARTITION BY row, w, w1, w2) > 1 THEN 1 ELSE 0 END AS h FROM win),
cov AS (
  SELECT row, max(h) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM hit),
rep AS (SELECT row, sum(c) AS n FROM cov GROUP BY row),
line AS (
  SELECT row, doc_id, host, raw, regexp_extract_all({LOWER.format("raw")}, '[^\x20\x09-\x0D]+') AS ws
  FROM (SELECT row, doc_id, host, unnest(string_split(text, chr(10))) AS raw FROM base)),
worded AS (
  SELECT row, doc_id, host, raw, regexp_replace(array_to_string(ws, ' '), '[0-9]', '0', 'g') AS line, len(ws) AS n FROM line WHERE len(ws) > 0),
dup AS (SELECT row, count(*) - count(DISTINCT raw) AS n FROM worded GROUP BY row),
often AS (SELECT host, line FROM worded GROUP BY host, line HAVING count(DISTINCT doc_id) > 50),
lost AS (SELECT row, sum(n) AS n FROM worded JOIN often USING (host, line) GROUP BY row),
all_ AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS removed_words
  FROM base LEFT JOIN rep USING (row) LEFT JOIN dup USING (row) LEFT JOIN lost USING (row))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * removed_words <= 50 * n_words AS kept
FROM all_"""

OP3 = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length('<|turn:') + length('|>') + length('<|end|>') + 2
      + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), '>', '&gt;'))
      + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n
  FROM t),
grown AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM sized)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars,
  count(*) FILTER (WHERE role = 'assistant' OR i = n) AS n_examples
FROM grown GROUP BY conv_id"""

OP11 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l USING (doc_id)),
n AS (SELECT part, fails, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || x.c || y.c || z.c AS filter_order
  FROM letter a, letter b, letter x, letter y, letter z
  WHERE len(list_distinct([a.c, b.c, x.c, y.c, z.c])) = 5),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, substr(filter_order, s, 1) AS own, '[' || substr(filter_order, 1, s - 1) || '0]' AS before FROM orders, range(1, 6) r(s)),
told AS (
  SELECT part, filter_order, step, own, contains(fails, own) AS hit, regexp_matches(fails, before) AS gone, fails = own AS alone, docs, good, toxic FROM n, steps),
summed AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(docs) FILTER (WHERE NOT hit AND NOT gone), 0) AS kept, coalesce(sum(docs) FILTER (WHERE hit AND NOT gone), 0) AS removed,
    coalesce(sum(docs) FILTER (WHERE hit AND gone), 0) AS redundant, coalesce(sum(docs) FILTER (WHERE alone), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE hit AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE hit AND NOT gone), 0) AS toxic_lost
  FROM told GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed"""

#: Distinct rows whose vector has neither nulls nor non-finite components, scaled.
SCALED = """
  SELECT DISTINCT vec_id, {label} list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

OP12 = f"""
WITH own AS ({SCALED.format(scale=64, label="")}),
met AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM own q JOIN own c ON q.vec_id <> c.vec_id OR q.v <> c.v WHERE q.vec_id % 20 = 0),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM met)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 20"""

OP13 = f"""
WITH raw AS ({SCALED.format(scale=256, label="label,")} AND label IS NOT NULL),
own AS (SELECT DISTINCT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM raw),
met AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM own a JOIN own c ON a.vec_id <> c.vec_id OR a.v <> c.v OR a.label <> c.label WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM met WHERE same) WHERE r <= 5),
neg AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM pos JOIN met USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5"""

ORACLE = {
    "op2_line_frequency": OP2,
    "op3_chat_prefix": OP3,
    "op11_filter_audit": OP11,
    "op12_pivot_search": OP12,
    "op13_hard_negatives": OP13,
}
