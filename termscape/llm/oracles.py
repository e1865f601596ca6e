"""SQL counterparts of the registered queries, where SQL can express them. States its own fixed values."""

from __future__ import annotations

_OP1 = r"""
WITH RECURSIVE counted AS MATERIALIZED (
  SELECT doc_id, source,
    md5(concat_ws(chr(31), coalesce('v' || CAST(doc_id AS VARCHAR), 'n'), coalesce('v' || text, 'n'))) AS row_key,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens
  FROM documents),
totals AS MATERIALIZED (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM counted GROUP BY source),
whole AS MATERIALIZED (
  SELECT sum(tokens) AS total, max(tokens) AS most, min(tokens) FILTER (tokens > 0) AS least, count(*) FILTER (tokens > 0) AS n,
    list(tokens / (SELECT CAST(sum(tokens) AS DOUBLE) FROM totals)) FILTER (tokens > 0) AS p
  FROM totals),
-- the largest exponent that has the entropy, the smallest that keeps the repetitions, each by 40 halvings
halved AS (
  SELECT 0 AS step, 0.0::DOUBLE AS elo, 1.0::DOUBLE AS ehi, 0.0::DOUBLE AS rlo, 1.0::DOUBLE AS rhi
  UNION ALL
  SELECT step + 1, CASE WHEN short THEN elo ELSE emid END, CASE WHEN short THEN emid ELSE ehi END,
    CASE WHEN fits THEN rlo ELSE rmid END, CASE WHEN fits THEN rmid ELSE rhi END
  FROM (
    SELECT *, (elo + ehi) / 2 AS emid, (rlo + rhi) / 2 AS rmid,
      ln(list_sum(list_transform(p, lambda x: pow(x, (elo + ehi) / 2))))
        - (elo + ehi) / 2 * list_sum(list_transform(p, lambda x: pow(x, (elo + ehi) / 2) * ln(x)))
        / list_sum(list_transform(p, lambda x: pow(x, (elo + ehi) / 2))) < 0.98 * ln(n) AS short,
      pow(CAST(most AS DOUBLE) / least, 1 - (rlo + rhi) / 2) <= 2.0 AS fits
    FROM halved, whole WHERE step < 40)),
chosen AS MATERIALIZED (
  SELECT greatest(elo, CASE WHEN CAST(most AS DOUBLE) / least <= 2.0 THEN 0.0 ELSE rhi END) AS a FROM halved, whole WHERE step = 40),
raised AS MATERIALIZED (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(tokens / CAST(total AS DOUBLE), a) ELSE 0.0 END AS r FROM totals, whole, chosen),
budget AS MATERIALIZED (
  SELECT sum(r) AS z, any_value(most) / (pow(any_value(most) / CAST(any_value(total) AS DOUBLE), any_value(a)) / sum(r)) AS b
  FROM raised, whole, chosen),
weighed AS MATERIALIZED (
  SELECT source, tokens, greatest(CAST(round(r / z * b) AS BIGINT), tokens) AS quota FROM raised, budget),
epochs AS (SELECT *, greatest(CAST(ceil(quota / CAST(greatest(tokens, 1) AS DOUBLE)) AS INTEGER), 1) AS epochs FROM weighed),
drawn AS (
  SELECT c.*, e.tokens, e.quota, CAST(unnest(range(e.epochs)) AS INTEGER) AS epoch
  FROM counted c JOIN epochs e ON c.source IS NOT DISTINCT FROM e.source),
placed AS (
  SELECT *, epoch * tokens + coalesce(sum(n_tokens) OVER (
      PARTITION BY source, epoch ORDER BY md5(concat_ws(':', '17', epoch, row_key)), doc_id, n_tokens
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM drawn),
blocked AS (
  SELECT *, CAST(least(floor(CAST(start AS DOUBLE) / CAST(greatest(quota, 1) AS DOUBLE) * n_blocks), n_blocks - 1) AS BIGINT) AS block
  FROM placed, (SELECT greatest(1.0, ceil(round(b) / 262144)) AS n_blocks FROM budget)
  WHERE start < quota OR (n_tokens = 0 AND epoch = 0))
SELECT doc_id, source, n_tokens, epoch, block, CAST(row_number() OVER (
    PARTITION BY block ORDER BY md5(concat_ws(':', '17', block, epoch, row_key)), doc_id, n_tokens) AS INTEGER) AS position
FROM blocked
"""

_OP2 = r"""
WITH parsed AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM pages),
decided AS (
  SELECT *, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
    CASE
      WHEN contains(low, '/wp-login.') THEN '/wp-login.'
      WHEN contains(low, '/wp-admin/') THEN '/wp-admin/'
      WHEN contains(low, '/cgi-bin/') THEN '/cgi-bin/'
      WHEN contains(low, '.casino.') THEN '.casino.'
      WHEN contains(low, '.porn.') THEN '.porn.'
      WHEN contains(low, '.xxx/') THEN '.xxx/'
      WHEN regexp_matches(low, '/login/.*[?]redirect=', 's') THEN '/login/*?redirect='
      WHEN contains(low, '/cart/add/') THEN '/cart/add/' END AS pattern_rule
  FROM parsed)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN pattern_rule END AS pattern,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
       WHEN rule IS NOT NULL THEN 'allow'
       WHEN pattern_rule IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM decided
"""

_OP6 = r"""
WITH templates(number, license, text) AS (VALUES
    (0, 'Apache-2.0', 'Licensed under the Apache License, Version 2.0.'),
    (1, 'BSD-2-Clause', 'Licensed under the BSD 2-Clause License.'),
    (2, 'BSD-3-Clause', 'Licensed under the BSD 3-Clause License.'),
    (3, 'CC-BY-4.0', 'Licensed under CC BY 4.0.'),
    (4, 'CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0.'),
    (5, 'CC-BY-SA-4.0', 'Licensed under CC BY-SA 4.0.'),
    (6, 'CC0-1.0', 'Dedicated to the public domain under CC0 1.0 Universal.'),
    (7, 'GPL-2.0', 'This work is licensed under the GNU General Public License, version 2.'),
    (8, 'GPL-3.0', 'This work is licensed under the GNU General Public License, version 3.'),
    (9, 'LGPL-3.0', 'This work is licensed under the GNU Lesser General Public License, version 3.'),
    (10, 'MIT', 'Released under the MIT License.'),
    (11, 'MIT', 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.'),
    (12, 'MPL-2.0', 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.'),
    (13, 'proprietary', 'All rights reserved.')),
files AS (
  SELECT row_number() OVER () AS file, doc_id, concat_ws('/', source, lang, doc_id || '.txt') AS path, coalesce(text, '') AS text,
    regexp_replace(concat_ws('/', source, lang, doc_id || '.txt'), '/[^/]*$', '') AS dir FROM documents),
size AS (SELECT count(*) AS n FROM files),
words AS (SELECT number, license, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')) AS token FROM templates),
units AS (
  SELECT file, false AS is_whole, unnest(string_split(text, chr(10))) AS unit FROM files
  UNION SELECT file, true, text FROM files),
held AS MATERIALIZED (
  SELECT unit, token, count(*) AS times FROM (
    SELECT unit, unnest(regexp_extract_all(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')) AS token
    FROM (SELECT DISTINCT unit FROM units)) GROUP BY ALL),
df AS (SELECT token, count(DISTINCT file) AS df FROM units u JOIN held h ON u.is_whole AND u.unit = h.unit WHERE token IN (SELECT token FROM words) GROUP BY token),
idf AS MATERIALIZED (
  SELECT token, ln((1 + n) / CAST(1 + coalesce(df, 0) AS DOUBLE)) + 1 AS idf FROM (SELECT DISTINCT token FROM words) LEFT JOIN df USING (token), size),
shares AS (
  SELECT number, license, token, times * idf / sqrt(sum(times * idf * times * idf) OVER (PARTITION BY number)) AS share
  FROM (SELECT number, license, token, count(*) AS times FROM words GROUP BY ALL) JOIN idf USING (token)),
weighed AS (SELECT unit, token, times * coalesce(idf, ln(1 + n) + 1) AS weight FROM held LEFT JOIN idf USING (token), size),
norms AS (SELECT unit, sqrt(sum(weight * weight)) AS norm FROM weighed GROUP BY unit),
scores AS (
  SELECT unit, license, round(sum(weight * share) / any_value(norm), 6) AS score
  FROM weighed JOIN shares USING (token) JOIN norms USING (unit) GROUP BY unit, number, license),
best AS (SELECT unit, license, score FROM scores WHERE score >= 0.8 QUALIFY row_number() OVER (PARTITION BY unit ORDER BY score DESC, license) = 1),
own AS (
  SELECT file, license AS own_license, score AS own_score FROM units JOIN best USING (unit) WHERE NOT is_whole
  QUALIFY row_number() OVER (PARTITION BY file ORDER BY score DESC, license) = 1),
whole AS (SELECT file, license AS whole_license, score AS whole_score FROM units JOIN best USING (unit) WHERE is_whole),
placed AS (
  SELECT doc_id, path, dir, coalesce(own_license, whole_license) AS own_license, coalesce(own_score, whole_score) AS own_score, whole_license, whole_score
  FROM files LEFT JOIN own USING (file) LEFT JOIN whole USING (file)),
granted AS (
  SELECT dir AS above, whole_license FROM placed WHERE whole_license IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY whole_score DESC, path, whole_license) = 1),
nearest AS (
  SELECT dir, above, whole_license FROM (SELECT DISTINCT dir FROM placed) JOIN granted ON above = '' OR dir = above OR starts_with(dir, above || '/')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(above) DESC) = 1)
SELECT doc_id, path, own_license, own_score,
  CASE WHEN own_license IS NULL THEN n.whole_license END AS inherited_license,
  CASE WHEN own_license IS NULL THEN above END AS inherited_from,
  coalesce(own_license, n.whole_license) AS license
FROM placed p LEFT JOIN nearest n USING (dir)
"""

_OP10 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn ') + length(role) + length(text) + length('></turn>') + 1
    + length(role || text) - length(translate(role || text, '\<>', ''))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_OP12 = r"""
WITH marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
read AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(words) < 100,
     100 * len(list_distinct(words)) < 80 * len(words),
     100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body),
     regexp_matches(body, '[#$%&*|]'),
     coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)] AS fails
  FROM read LEFT JOIN marks USING (doc_id)),
counted AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY ALL),
letters(l, i) AS (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS seq
  FROM letters a JOIN letters b ON b.i <> a.i JOIN letters c ON c.i NOT IN (a.i, b.i)
    JOIN letters d ON d.i NOT IN (a.i, b.i, c.i) JOIN letters e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
-- every order run over every kind of document: the step at which it goes, 0 if never
run AS (
  SELECT part, filter_order, fails, n, good, toxic, coalesce(list_position(list_transform(seq, lambda f: fails[f]), true), 0) AS gone
  FROM counted, orders),
steps AS (SELECT filter_order, seq, unnest(range(1, 6)) AS step FROM orders),
reported AS (
  SELECT part, filter_order, step, seq[step] AS f, sum(n) FILTER (gone = 0 OR gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
    sum(n) FILTER (fails[seq[step]] AND gone <> step) AS redundant,
    sum(n) FILTER (fails[seq[step]] AND len(list_filter(fails, lambda x: x)) = 1) AS unique_fails,
    sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
  FROM run JOIN steps USING (filter_order) GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM reported
"""

_OP13 = r"""
WITH RECURSIVE crc_steps AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, run, sum(n) AS n FROM (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL)
  WHERE length(run) >= 5 GROUP BY ALL),
summed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(named)), lambda k: CAST('0x' || substr(hex(encode(named)), CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc_steps),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM summed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
shortened AS MATERIALIZED (
  SELECT word, length(word) AS size, spot, substr(word, 1, spot) || substr(word, spot + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS spot FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS near FROM shortened a JOIN shortened b ON a.rest = b.rest AND a.spot = b.spot AND a.size = b.size AND a.word <> b.word
  UNION SELECT s.word, w.word FROM shortened s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word FROM shortened s JOIN words w ON s.rest = w.word),
best AS (
  SELECT r.word, count(*) AS n_near, arg_min(near, (-w.n, near)) AS form, max(w.n) AS form_n
  FROM near r JOIN words w ON r.near = w.word GROUP BY r.word),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain(word, root, step) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT word, form, arg_max(root, step) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
FROM formed JOIN chain USING (word) GROUP BY word, form
"""

ORACLES: dict[str, str] = {
    "op1_temperature_mixing": _OP1,
    "op2_url_filters": _OP2,
    "op6_license_scan": _OP6,
    "op10_chat_formatting": _OP10,
    "op12_filter_audit": _OP12,
    "op13_spelling_variants": _OP13,
}
