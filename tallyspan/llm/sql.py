"""DuckDB SQL for the queries that SQL can express."""

OP2 = """
WITH named(key, action, category, day) AS (
  VALUES ('cheap-pills.example.com', 'add', 'pharma', 30), ('spam-farm.example.org', 'add', 'spam', 0),
         ('spam-farm.example.org', 'remove', 'spam', 365), ('spam-farm.example.org', 'add', 'spam', 500),
         ('adult-x.example.net', 'add', 'adult', 10), ('free-bets.example.com', 'add', 'gambling', 90),
         ('casino-win.example.org', 'add', 'gambling', 100), ('casino-win.example.org', 'remove', 'gambling', 600),
         ('ads-track.example.org', 'add', 'tracking', 200)),
captures AS (
  SELECT page_id, url, TIMESTAMP '2023-01-01' + to_seconds((page_id * 86477) % 63072000) AS fetched,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\\[[^\\]/?#]*\\]|[^/?#:]+)', 1)), '\\.+$', ''), '') AS host
  FROM pages),
hosts AS (
  SELECT host AS key, md5(host) AS h FROM (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL)
  WHERE substr(md5(host), 1, 1) IN ('0', '1')),
entries AS (
  SELECT * FROM named
  UNION ALL SELECT key, 'add', 'listed', ('0x' || substr(h, 3, 2))::INT FROM hosts
  UNION ALL SELECT key, 'remove', 'listed', ('0x' || substr(h, 5, 2))::INT + 256 FROM hosts
  UNION ALL SELECT key, 'add', 'relisted', ('0x' || substr(h, 7, 2))::INT + 450 FROM hosts WHERE substr(h, 2, 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e')),
dated AS (SELECT DISTINCT key, action, category, TIMESTAMP '2023-01-01' + to_days(day) AS since FROM entries),
spans AS (
  SELECT key, action, category, since AS valid_from,
         coalesce(lead(since) OVER (PARTITION BY key, category ORDER BY since, action), TIMESTAMP '9999-12-31') AS valid_to
  FROM dated),
labels AS (SELECT page_id, host, fetched, string_split(host, '.') AS l FROM captures WHERE host IS NOT NULL),
keyed AS (
  SELECT page_id, host, fetched, array_to_string(l[i:len(l)], '.') AS key
  FROM labels, unnest(range(1, CASE WHEN host LIKE '[%' OR regexp_full_match(host, '\\d{1,3}(\\.\\d{1,3}){3}') THEN 2 ELSE greatest(len(l) - 1, 1) + 1 END)) AS t(i)),
met AS (
  SELECT page_id, count(*) AS n_active, array_to_string(list_sort(list(DISTINCT category)), ',') AS categories,
         max_by(keyed.key, (length(keyed.key), keyed.key)) AS matched_key
  FROM keyed JOIN spans ON keyed.key = spans.key AND action = 'add' AND fetched >= valid_from AND fetched < valid_to
  GROUP BY page_id)
SELECT page_id, url, fetched, host, coalesce(n_active, 0)::BIGINT AS n_active, coalesce(categories, '') AS categories,
       matched_key, coalesce(n_active, 0) > 0 AS blocked
FROM captures LEFT JOIN met USING (page_id)
"""

OP9 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.other)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM words w LEFT JOIN sizes USING (doc_id) JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) c ON c.id = w.doc_id
"""



def _licence_templates() -> str:
    from tallyspan.llm.licenses import _templates

    text = lambda x: "'" + x + "'"
    return ", ".join(f"({no}, {text(label)}, {base}, {text(phrase)}, {text(word)}, {rel}, {key})" for no, label, base, phrase, word, rel, key in _templates())


OP3 = (
    r"""
WITH t(template, label, base, phrase, word, rel, key) AS (VALUES """
    + _licence_templates()
    + r"""),
d AS (
  SELECT row_number() OVER () AS uid, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
p AS (
  SELECT uid, i - 1 AS pos, w[i] AS word, array_to_string(w[i:i + 15], ' ') AS here
  FROM d, unnest(range(1, len(w) + 1)) AS r(i) WHERE w[i] IN (SELECT word FROM t)),
df AS (SELECT word, count(DISTINCT uid) AS df FROM p GROUP BY word),
idf AS (
  SELECT v.word, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (coalesce(df, 0) + 0.5)) AS idf
  FROM (SELECT DISTINCT word FROM t) v LEFT JOIN df ON df.word = v.word),
l AS (
  SELECT t.*, idf, row_number() OVER (PARTITION BY template ORDER BY key DESC, idf DESC, rel) = 1 AS anchor, sum(idf) OVER (PARTITION BY template) AS total
  FROM t JOIN idf ON idf.word = t.word),
places AS (
  SELECT uid, template, pos - rel AS place, any_value(label) AS label, any_value(base) AS base, sum(idf) / any_value(total) AS coverage
  FROM p JOIN l ON l.word = p.word GROUP BY 1, 2, 3
  HAVING bool_or(anchor) AND bool_or(rel = 0 AND starts_with(here || ' ', phrase || ' ')) AND (any_value(base) OR sum(idf) / any_value(total) >= 0.5)),
found AS (
  SELECT uid, count(*) FILTER (WHERE base) AS n_base, min(place) FILTER (WHERE base) AS first_word, max(place) FILTER (WHERE base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base)), ',') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels,
         round(least(1.0::DOUBLE, max(coverage)), 6) AS score
  FROM places GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN found ON found.uid = d.uid
"""
)

OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS copy
  FROM documents),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         map {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w), 'C': 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
              'D': regexp_matches(t, '[#$%&*|]'), 'E': copy} AS fails
  FROM d LEFT JOIN known ON known.doc_id = d.doc_id),
n AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM l a, l b, l c, l d, l e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
steps AS (SELECT o, s, o[s] AS x, o[1:s - 1] AS earlier FROM orders, range(1, 6) AS r(s)),
met AS (
  SELECT part, o, s, x, good, toxic, n, fails[x] AS fail,
         len(list_filter(map_keys(fails), lambda k: fails[k] AND contains(earlier, k))) > 0 AS gone,
         len(list_filter(map_keys(fails), lambda k: fails[k])) = 1 AS single
  FROM n, steps),
got AS (
  SELECT part, o AS filter_order, s::INT AS step, x, coalesce(sum(n) FILTER (WHERE NOT fail AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE fail AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE fail AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE fail AND single), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (WHERE fail AND NOT gone AND good), 0)::BIGINT AS good_lost, coalesce(sum(n) FILTER (WHERE fail AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM got
"""

ORACLE_SQL = {"op13_filter_audit": OP13, "op3_licenses": OP3, "op2_url_lists": OP2, "op9_minhash": OP9}
