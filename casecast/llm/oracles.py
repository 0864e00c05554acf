"""DuckDB SQL for the queries that SQL can express."""

ORACLES = {
    "op3_chat_formatting": r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(regexp_replace(replace(role, '\', '\\'), '([<\[])(/?(s>|INST\]))', '\1-\2', 'g'))
          + length(regexp_replace(replace(text, '\', '\\'), '([<\[])(/?(s>|INST\]))', '\1-\2', 'g')) + 20 AS chars
  FROM given
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op4_exact_top_k": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
""",
    "op6_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS position
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN NOT dropped THEN line END, chr(10) ORDER BY position), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op9_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST([5, 2, 1][(rank - 1) % 3 + 1] AS BIGINT) AS weight, 3 * source_size AS bound FROM sources
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(bound) OVER before, 0) AS DOUBLE)
      / CAST(sum(weight) OVER from_here AS DOUBLE) AS level
  FROM weighed
  WINDOW before AS (ORDER BY CAST(source_size AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    from_here AS (ORDER BY CAST(source_size AS DOUBLE) / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), filled AS (
  SELECT (SELECT level FROM levels WHERE bound >= weight * level
    ORDER BY CAST(source_size AS DOUBLE) / weight, rank LIMIT 1) AS level
), targets AS (
  SELECT source, source_size, least(CAST(bound AS DOUBLE), weight * (SELECT level FROM filled)) AS target FROM weighed
), based AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least(floor(target / source_size), 3) AS BIGINT) ELSE 0 END AS base
  FROM targets
), running AS (
  SELECT source, h, size, sum(size) OVER (PARTITION BY source ORDER BY h) AS through
  FROM (SELECT source, h, sum(size) AS size FROM sized GROUP BY source, h)
), first_over AS (
  SELECT r.source, min_by(r.h, r.h) AS h, min_by(r.through, r.h) AS through, min_by(r.size, r.h) AS size
  FROM running r JOIN based b ON r.source IS NOT DISTINCT FROM b.source
  WHERE r.through > b.target - b.base * b.source_size GROUP BY r.source
), thresholds AS (
  SELECT b.*, CASE WHEN f.h IS NULL THEN 1152921504606846976
    WHEN f.through - (target - base * source_size) < (target - base * source_size) - (f.through - f.size) THEN f.h + 1
    ELSE f.h END AS threshold
  FROM based b LEFT JOIN first_over f ON f.source IS NOT DISTINCT FROM b.source AND f.h IS NOT NULL
)
SELECT s.doc_id, s.size, t.source_size, t.target,
  CAST(s.size * (t.base + CASE WHEN s.h < t.threshold THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s JOIN thresholds t ON s.source IS NOT DISTINCT FROM t.source
""",
    "op10_suffix_array_dedup": """
WITH whole AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (
  SELECT doc_id, b, unnest(range(octet_length(b) - 49)) AS place FROM whole WHERE octet_length(b) >= 50
), strings AS (SELECT doc_id, place, array_slice(b, place + 1, place + 50) AS string FROM starts),
earliest AS (
  SELECT string, min(doc_id) AS first_id FROM strings GROUP BY string HAVING min(doc_id) < max(doc_id)
), covered AS (
  SELECT s.doc_id, s.place AS a, s.place + 50 AS z
  FROM strings s JOIN earliest e ON s.string = e.string AND e.first_id < s.doc_id
), marked AS (
  SELECT *, coalesce(a > max(z) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    true) AS new FROM covered
), numbered AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a) AS span FROM marked),
spans AS (SELECT doc_id, span, min(a) AS a, max(z) AS z FROM numbered GROUP BY doc_id, span),
gaps AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans),
pieces AS (
  SELECT g.doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last,
    string_agg(CASE WHEN a > before THEN hex(array_slice(b, before + 1, a)) ELSE '' END, '' ORDER BY a) AS head
  FROM gaps g JOIN whole w ON g.doc_id = w.doc_id GROUP BY g.doc_id
)
SELECT w.doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN hex(b) WHEN last = octet_length(b) THEN head
    ELSE head || hex(array_slice(b, last + 1, octet_length(b))) END)) AS kept_sha256
FROM whole w LEFT JOIN pieces p ON w.doc_id = p.doc_id
""",
    "op11_ranked_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL
), counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
norms AS (SELECT doc_id, 100 - 75 + (75 * n * docs) // terms AS m FROM lengths, whole),
held AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM held, whole),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
), items AS (SELECT item_id, term, count(*) AS repeats FROM asked GROUP BY item_id, term),
scores AS (
  SELECT i.item_id, c.doc_id,
    CAST(sum(i.repeats * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * m.m))) AS BIGINT) AS score
  FROM items i JOIN counts c ON i.term = c.term JOIN weights w ON i.term = w.term JOIN norms m ON c.doc_id = m.doc_id
  GROUP BY i.item_id, c.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
    "op13_prefix_trie": """
WITH given AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), named AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, CAST(conv_id AS VARCHAR) AS digits FROM given GROUP BY conv_id
), bits AS (
  SELECT *, flatten(list_transform(range(1, length(digits) + 1),
    lambda i: [CAST(ascii(digits[i]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])) AS steps FROM named
), convs AS (
  SELECT conv_id, n, base, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), steps), lambda crc, x:
    xor(xor(crc, x) >> 1, CASE WHEN xor(crc, x) % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)),
    CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM bits
), rebuilt AS (
  SELECT c.conv_id, g.place AS depth, g.role, g.text FROM convs c JOIN given g ON g.conv_id = c.base AND g.place <= c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + g.place - c.h, g.role, g.text
  FROM convs c JOIN given g ON g.conv_id = c.conv_id AND g.place > c.h LEFT JOIN convs b ON b.conv_id = c.base
), paths AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS chars FROM convs
  UNION ALL
  SELECT conv_id, depth, string_agg(length(role) || ':' || length(text) || ':' || role || text, '')
    OVER (PARTITION BY conv_id ORDER BY depth), length(text)
  FROM rebuilt
), grouped AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM paths GROUP BY depth, path
), members AS (
  SELECT p.conv_id AS member, p.depth, g.conv_id FROM paths p JOIN grouped g ON p.depth = g.depth AND p.path = g.path
), nodes AS (
  SELECT g.conv_id, g.depth, m.conv_id AS parent_conv_id, g.n_convs, g.chars
  FROM grouped g LEFT JOIN members m ON m.member = g.conv_id AND m.depth = g.depth - 1
), children AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), counted AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.conv_id = c.conv_id AND n.depth = c.depth
), sums AS (
  SELECT m.conv_id, m.depth, sum(CASE WHEN x.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved
  FROM counted x JOIN members m ON m.member = x.conv_id AND m.depth <= x.depth GROUP BY m.conv_id, m.depth
), lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
ends AS (
  SELECT m.conv_id, m.depth, string_agg(CAST(m.member AS VARCHAR), ',' ORDER BY m.member) AS ids
  FROM members m JOIN lengths l ON m.member = l.conv_id AND m.depth = l.depth GROUP BY m.conv_id, m.depth
)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, c.parent_conv_id, CAST(c.n_convs AS BIGINT) AS n_convs,
  CAST(c.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted c JOIN sums s ON c.conv_id = s.conv_id AND c.depth = s.depth
LEFT JOIN ends e ON c.conv_id = e.conv_id AND c.depth = e.depth
""",
}
