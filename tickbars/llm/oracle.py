"""Reference SQL (DuckDB) of the text queries that SQL can express."""

#: The white space of the contract.
SPACE = r"[ \t\n\x0B\f\r]+"

ORACLE: dict[str, str] = {
    "op3_warc": """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
heads AS (SELECT html, max(page_id) AS head FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, url, strlen(p.html) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM p LEFT JOIN heads ON p.html = heads.html""",
    "op8_line_dedup": f"""
WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (
  SELECT doc_id, k, line, words, len(words) AS n, array_to_string(words, ' ') AS w FROM (
    SELECT *, list_filter(string_split_regex(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                       'abcdefghijklmnopqrstuvwxyz'), '{SPACE}'), lambda x: x <> '') AS words
    FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS k FROM docs))),
kinds AS (SELECT w, any_value(words) AS words, any_value(n) AS n, min(row(doc_id, k)) AS place FROM l WHERE n > 0 GROUP BY w),
variants AS (
  SELECT w, place, i, array_to_string(list_concat(words[:i - 1], words[i + 1:]), ' ') AS v
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM kinds WHERE n >= 8)),
near AS (
  SELECT w FROM (SELECT w, place, min(place) OVER (PARTITION BY v, i) AS first FROM variants) WHERE first < place
  UNION SELECT a.w FROM variants a JOIN kinds b ON a.v = b.w WHERE b.n >= 8 AND b.place < a.place
  UNION SELECT b.w FROM variants a JOIN kinds b ON a.v = b.w WHERE b.n >= 8 AND a.place < b.place),
fate AS (
  SELECT l.*, l.n > 0 AND (near.w IS NOT NULL OR row(doc_id, k) <> place) AS gone
  FROM l LEFT JOIN kinds USING (w) LEFT JOIN near USING (w))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM fate GROUP BY doc_id""",
    "op11_lexical_search": r"""
WITH d AS (
  SELECT *, len(ts) AS n FROM (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents)
  WHERE len(ts) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
tfs AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM d) SEMI JOIN items USING (t) GROUP BY r, t),
weights AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM tfs GROUP BY t), totals),
gains AS (
  SELECT r, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS gain
  FROM tfs JOIN weights USING (t) JOIN d USING (r), totals),
scores AS (SELECT item_id, doc_id, r, sum(gain)::BIGINT AS score FROM gains JOIN items USING (t) JOIN d USING (r) GROUP BY ALL HAVING sum(gain) > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores)
WHERE rank <= 10""",
    # CRC-32 bit by bit; totals by sums over the members of a node instead of messages.
    "op13_prefix_trie": """
WITH ids AS (
  SELECT conv_id, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)),
made AS (
  SELECT ids.conv_id, 0 AS own, p, role, text FROM ids JOIN turns ON turns.conv_id = ids.conv_id - ids.conv_id % 5 AND p <= h
  UNION ALL SELECT conv_id, 1, p, role, text FROM ids JOIN turns USING (conv_id) WHERE p > h),
seq AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS depth FROM made),
chained AS (
  SELECT conv_id, depth, strlen(text) AS n_bytes,
         list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS path,
         depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM seq),
members AS (
  SELECT conv_id, depth, n_bytes, sha256(path::JSON::VARCHAR) AS k, is_end FROM chained
  UNION ALL SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM seq) FROM ids),
nodes AS (
  SELECT k, depth, min(conv_id) AS first, count(*) AS n_convs, any_value(n_bytes) AS n_bytes,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '') AS ends FROM members GROUP BY k, depth),
up AS (SELECT m.k, m.depth, any_value(p.k) AS parent FROM members m JOIN members p ON p.conv_id = m.conv_id AND p.depth = m.depth - 1 GROUP BY m.k, m.depth),
kids AS (SELECT parent, count(*) AS n FROM up GROUP BY parent),
facts AS (
  SELECT nodes.*, up.parent, coalesce(n, 0) AS n_children, (n IS NULL)::INT AS leaf, (n_convs - 1) * n_bytes AS own
  FROM nodes LEFT JOIN up USING (k, depth) LEFT JOIN kids ON kids.parent = nodes.k),
below AS (
  SELECT m.k, sum(f.leaf) AS n_leaves, sum(f.own) AS saved
  FROM facts f JOIN members x ON x.k = f.k AND x.conv_id = f.first JOIN members m ON m.conv_id = f.first AND m.depth <= f.depth GROUP BY m.k)
SELECT f.first AS conv_id, f.depth::BIGINT AS depth, p.first AS parent_conv_id, f.n_convs, f.n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM facts f JOIN below USING (k) LEFT JOIN nodes p ON p.k = f.parent""",
}
