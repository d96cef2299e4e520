"""SQL of the queries that SQL can express: plain joins over all pairs that share a shingle
or a label, and over all prefixes, fit for small tables."""

OP1 = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
shingled AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS shingle
  FROM worded),
sized AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingled a JOIN shingled b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.other),
least_of AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least_of ON id = d.doc_id LEFT JOIN sized s ON s.doc_id = d.doc_id"""

OP3 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
edges AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
counted AS (SELECT a, count(*) AS n FROM edges GROUP BY a),
reach(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.other),
least_of AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least_of ON id = vec_id LEFT JOIN counted ON a = vec_id"""

# crc32 of a decimal number, bit by bit: the fold over its characters starts at all ones.
OP12 = """
WITH turned AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce("text", '')) ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
coded AS (
  SELECT conv_id, own, xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END))) % 9 AS h
  FROM turned),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.own[:a.h], []), a.own[a.h + 1:]) AS turns
  FROM coded a LEFT JOIN coded b ON b.conv_id = a.conv_id - a.conv_id % 5),
steps AS (SELECT conv_id, turns[:d] AS path, d, d = len(turns) AS is_end FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)),
nodes AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM steps GROUP BY path, d),
kids AS (SELECT path[:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
costed AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(n.path[depth].t)) END AS saved
  FROM nodes n LEFT JOIN kids k ON k.path = n.path),
up AS (SELECT path[:a] AS path, saved, n_children FROM costed, unnest(range(0, depth + 1)) AS u(a)),
totals AS (SELECT path, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM up GROUP BY path)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs::BIGINT AS n_convs, c.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM costed c JOIN totals t ON t.path = c.path LEFT JOIN nodes p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.path = c.path[:c.depth - 1]"""

OP11 = r"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce("text", '') AS t FROM documents),
cut AS (
  SELECT k, doc_id, lang, source, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM doc),
runs AS (SELECT k, i, array_to_string(ws[i:i + 4], ' ') AS r FROM cut, unnest(range(1, len(ws) - 3)) AS u(i)),
again AS (SELECT k, r FROM runs GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT k, count(DISTINCT i + o) AS n FROM runs JOIN again USING (k, r), unnest(range(0, 5)) AS u(o) GROUP BY k),
m AS (
  SELECT k, doc_id, lang, source, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN covered USING (k)),
long AS (
  SELECT k, lang, source, unnest(['word_length', 'symbols', 'repeated_words', 'repeated_lines']) AS feature,
    unnest([100 * word_chars // n_words, 1000 * n_symbols // n_words, 1000 * n_repeat_words // n_words, 1000 * n_dup_lines // n_lines]) AS v
  FROM m WHERE n_words > 0),
binned AS (SELECT *, greatest(length(bin(v)) - 6, 0) AS a, a * 32 + (v >> a) AS b FROM long),
pooled AS (
  SELECT 0 AS level, lang, source, feature, b FROM binned UNION ALL
  SELECT 1, lang, NULL, feature, b FROM binned UNION ALL SELECT 2, NULL, NULL, feature, b FROM binned),
quart AS (
  SELECT level, lang, source, feature, count(*) AS n,
    list_sort(list(b))[(count(*) + 3) // 4] AS b1, list_sort(list(b))[(3 * count(*) + 3) // 4] AS b3
  FROM pooled GROUP BY ALL),
read AS (
  SELECT level, lang, source, feature, n, (b1 - greatest(b1 // 32 - 1, 0) * 32) << greatest(b1 // 32 - 1, 0) AS q1,
    (b3 - greatest(b3 // 32 - 1, 0) * 32) << greatest(b3 // 32 - 1, 0) AS q3
  FROM quart),
fences AS (
  SELECT o.lang, o.source, o.feature, CASE WHEN o.n >= 100 THEN o.q1 WHEN l.n >= 100 THEN l.q1 ELSE g.q1 END AS low,
    CASE WHEN o.n >= 100 THEN o.q3 WHEN l.n >= 100 THEN l.q3 ELSE g.q3 END AS high,
    3 * greatest(high - low, CASE o.feature WHEN 'word_length' THEN 80 WHEN 'symbols' THEN 50 WHEN 'repeated_words' THEN 60 ELSE 120 END) AS reach
  FROM read o JOIN read l ON l.level = 1 AND l.feature = o.feature AND l.lang IS NOT DISTINCT FROM o.lang
    JOIN read g ON g.level = 2 AND g.feature = o.feature WHERE o.level = 0),
passed AS (
  SELECT k, bool_and(v <= high + reach AND (x.feature <> 'word_length' OR v >= low - reach)) AS ok
  FROM long x JOIN fences f ON f.feature = x.feature AND f.lang IS NOT DISTINCT FROM x.lang AND f.source IS NOT DISTINCT FROM x.source GROUP BY k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND coalesce(ok, false) AS kept
FROM m LEFT JOIN passed USING (k)"""
