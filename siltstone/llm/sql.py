"""SQL for the results of operators, where it can express them."""

LINKED_VECTORS = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS n, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), usable AS (
  SELECT * FROM vectors WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.n AS a, b.n AS b, b.vec_id AS id FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.n <> b.n
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.93
), reached AS (
  SELECT n AS a, n AS b, vec_id AS id FROM vectors
  UNION
  SELECT r.a, l.b, l.id FROM reached r JOIN links l ON r.b = l.a
), classes AS (SELECT a, min(id) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors JOIN classes ON classes.a = n LEFT JOIN counts ON counts.a = n
"""

REPEATED_WORDS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT n, i, md5(array_to_string(list_slice(words, i, i + 34), ' ')) AS win
  FROM docs, unnest(range(1, len(words) - 33)) AS t(i)
), repeated AS (SELECT win FROM windows GROUP BY win HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT n, p FROM windows JOIN repeated USING (win), unnest(range(i, i + 35)) AS t(p)
), words AS (
  SELECT n, p, words[p] AS word FROM docs, unnest(range(1, len(words) + 1)) AS t(p)
), kept AS (
  SELECT n, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (n, p) GROUP BY n
), counts AS (SELECT n, count(*) AS n_removed FROM gone GROUP BY n)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (n) LEFT JOIN counts USING (n)
"""

CONTAMINATION = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), wanted AS (
  SELECT DISTINCT item, least(len(words), 10) AS size, array_to_string(list_slice(words, i, i + 9), ' ') AS win
  FROM items, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(i) WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM wanted), distinct_wanted AS (SELECT DISTINCT size, win FROM wanted),
windows AS (
  SELECT n, i, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS win
  FROM docs, sizes, unnest(range(1, len(words) - size + 2)) AS t(i)
), found AS (SELECT n, i, size, win FROM windows SEMI JOIN distinct_wanted USING (size, win)),
hits AS (SELECT n, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + size)) AS t(p) GROUP BY n),
named AS (SELECT DISTINCT n, item FROM found JOIN wanted USING (size, win) WHERE item IS NOT NULL),
lists AS (SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM named GROUP BY n)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (n) LEFT JOIN lists USING (n)
"""

CHATS = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), said AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, md5(text)) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, md5(text)), '') AS learned,
    sum(length('<s>[INST] ' || role || ' [/INST]' || chr(10) || text || chr(10) || '</s>')
      + len(regexp_extract_all(role, '</?s>|\[/?INST\]')) + len(regexp_extract_all(text, '</?s>|\[/?INST\]'))) AS chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
  sha256(learned) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM said
"""

_CRC32 = """
  list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: xor(crc >> 8, crc_of.bytes[(xor(crc, byte) & 255) + 1]))
"""
_CRC_TABLE = """crc_of AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS bytes
)"""

PERIODIC_RUNS = r"""
WITH ${table}, numbered AS (
  SELECT row_number() OVER () AS d, doc_id, xor(${crc}, 4294967295) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents, crc_of
), placed AS (
  SELECT d, doc_id, words, len(words) AS n, h, h // 10 AS g, (h // 10) % greatest(len(words), 1) AS a FROM numbered
), docs AS (
  SELECT d, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: words[CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END + 1])
    ELSE words END AS words FROM placed
), tokens AS (
  SELECT d, n, i, words[i + 1] AS word FROM docs, unnest(range(n)) AS t(i)
), same AS (
  SELECT x.d, x.i, y.i - x.i AS p FROM tokens x JOIN tokens y ON x.d = y.d AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 3 <= x.n
), streaks AS (
  SELECT d, p, i, i - row_number() OVER (PARTITION BY d, p ORDER BY i) AS streak FROM same
), stretches AS (
  SELECT d, p, min(i) AS a, count(*) + p AS size FROM streaks GROUP BY d, p, streak HAVING count(*) + p >= greatest(24, 3 * p)
), runs AS (SELECT d, a, size, min(p) AS p FROM stretches GROUP BY d, a, size),
listed AS (
  SELECT d, count(*) AS n_runs, string_agg(a || ',' || size || ',' || p || chr(10), '' ORDER BY a, p) AS lines FROM runs GROUP BY d
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY d ORDER BY size / CAST(p AS DOUBLE) DESC, a, p) = 1
), gone AS (SELECT DISTINCT d, i FROM runs, unnest(range(a + p, a + size)) AS t(i)),
kept AS (SELECT d, string_agg(word, ' ' ORDER BY i) AS kept FROM tokens ANTI JOIN gone USING (d, i) GROUP BY d)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, a AS start, size AS length, p AS period, 1000 * size // p AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (d) LEFT JOIN best USING (d) LEFT JOIN kept USING (d)
""".replace("${table}", _CRC_TABLE).replace("${crc}", _CRC32.format(id="doc_id"))

FILTER_ORDERS = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), failing AS (
  SELECT part, coalesce(list_contains(l.good, 1), false) AS good, coalesce(list_contains(l.bad, 1), false) AS toxic,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END ||
    CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END ||
    CASE WHEN min(d.doc_id) OVER (PARTITION BY text) < d.doc_id THEN 'E' ELSE '' END AS fails
  FROM docs d LEFT JOIN (SELECT doc_id, list(quality) AS good, list(toxic) AS bad FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id
), counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
  SELECT '' AS filter_order
  UNION ALL
  SELECT filter_order || letter FROM orders, letters WHERE NOT contains(filter_order, letter)
), steps AS (
  SELECT filter_order, step, filter_order[step] AS filter, filter_order[1:step - 1] AS earlier
  FROM orders, unnest([1, 2, 3, 4, 5]) AS t(step) WHERE length(filter_order) = 5
), met AS (
  SELECT part, filter_order, step, filter, n, good, toxic, contains(fails, filter) AS failed, fails = filter AS alone,
    length(translate(earlier, fails, '')) < length(earlier) AS gone
  FROM counted, steps
), summed AS (
  SELECT part, filter_order, step, filter,
    coalesce(sum(n) FILTER (NOT gone AND NOT failed), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND failed), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND failed), 0) AS redundant, coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND failed), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND failed), 0) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, filter
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM summed
"""

REPEATED_LINES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, md5(coalesce(text, '')) AS fp,
    CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents
), filled AS (
  SELECT n, doc_id, fp, lines, i, lead(i) OVER (PARTITION BY n ORDER BY i) AS j
  FROM docs, unnest(range(1, len(lines) + 1)) AS t(i) WHERE lines[i] <> ''
), placed AS (
  SELECT n, i, j, rank() OVER (PARTITION BY array_to_string(lines[i:j], chr(10)) ORDER BY doc_id NULLS LAST, fp, i) AS place
  FROM filled WHERE j IS NOT NULL
), gone AS (SELECT DISTINCT n, l FROM placed, unnest(range(i, j + 1)) AS t(l) WHERE place > 1),
kept AS (
  SELECT n, string_agg(lines[l], chr(10) ORDER BY l) AS kept
  FROM (SELECT n, lines, l FROM docs, unnest(range(1, len(lines) + 1)) AS t(l)) ANTI JOIN gone USING (n, l) GROUP BY n
), counts AS (SELECT n, count(*) AS n_removed_lines FROM gone GROUP BY n)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, coalesce(n_removed_lines, 0) AS n_removed_lines, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (n) LEFT JOIN counts USING (n)
"""

REPEATED_BYTES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, hex(encode(coalesce(text, ''))) AS data, length(hex(encode(coalesce(text, '')))) // 2 AS size FROM documents
), pieces AS (  -- of 500 places each, with the bytes that windows from there reach
  SELECT n, size, k, substr(data, k * 1000 + 1, 1398) AS piece FROM docs, unnest(range(size // 500 + 1)) AS t(k)
), windows AS (
  SELECT n, k * 500 + j AS i, md5(substr(piece, j * 2 + 1, 400)) AS win FROM pieces, unnest(range(500)) AS t(j) WHERE k * 500 + j + 200 <= size
), repeated AS (SELECT win FROM windows GROUP BY win HAVING count(*) > 1),
marked AS (SELECT n, i, lag(i) OVER (PARTITION BY n ORDER BY i) AS before FROM windows SEMI JOIN repeated USING (win)),
numbered AS (SELECT n, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY n ORDER BY i) AS span FROM marked),
spans AS (SELECT n, span, min(i) AS start, max(i) + 200 AS stop FROM numbered GROUP BY n, span),
edges AS (
  SELECT n, stop AS low, lead(start) OVER (PARTITION BY n ORDER BY start) AS high FROM spans
  UNION ALL SELECT n, 0, min(start) FROM spans GROUP BY n
), kept AS (
  SELECT n, string_agg(substr(data, low * 2 + 1, (coalesce(high, size) - low) * 2), '' ORDER BY low) AS kept FROM edges JOIN docs USING (n) GROUP BY n
), counts AS (SELECT n, sum(stop - start) AS n_removed, count(*) AS n_spans FROM spans GROUP BY n)
SELECT doc_id, CAST(size AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, data))) AS kept_sha256
FROM docs LEFT JOIN kept USING (n) LEFT JOIN counts USING (n)
"""

NEAR_COPIES = r"""
WITH RECURSIVE docs AS (
  SELECT text, doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words
  FROM (SELECT coalesce(text, '') AS text, min(doc_id) AS doc_id FROM documents GROUP BY ALL)
), numbered AS (SELECT row_number() OVER () AS n, * FROM docs),
shingles AS (
  SELECT n, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
  FROM numbered, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS t(i) WHERE len(words) > 0
), elements AS (SELECT n, md5(shingle) AS shingle, row_number() OVER (PARTITION BY n, shingle) AS layer FROM shingles),
weights AS (SELECT n, count(*) AS weight FROM elements GROUP BY n),
shared AS (
  SELECT x.n AS a, y.n AS b, count(*) AS same FROM elements x JOIN elements y ON x.shingle = y.shingle AND x.layer = y.layer AND x.n < y.n GROUP BY x.n, y.n
), links AS (
  SELECT a, b FROM shared JOIN weights x ON x.n = a JOIN weights y ON y.n = b WHERE same >= 0.8 * (x.weight + y.weight - same)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT n AS a, n AS b FROM numbered
  UNION
  SELECT r.a, w.b FROM reached r JOIN ways w ON r.b = w.a
), classes AS (SELECT a, min(doc_id) AS class_id FROM reached JOIN numbered ON n = b GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM ways GROUP BY a)
SELECT d.doc_id, class_id, d.doc_id IS NOT DISTINCT FROM class_id AS kept
FROM documents d JOIN numbered ON numbered.text = coalesce(d.text, '') JOIN classes ON a = n
"""
