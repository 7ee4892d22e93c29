"""SQL twins of the divergence audit and the prefix trie."""

# All terms of all groups, absent ones too, laid out in full.
SOURCE_DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents),
occurrences AS (SELECT i, lang, source, unnest(words) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM occurrences GROUP BY lang, source, term),
vocabulary AS (
    SELECT lang, term FROM occurrences GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM vocabulary GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
    SELECT g.lang, g.source, w.term, coalesce(c.n, 0) AS n
    FROM groups g JOIN vocabulary w ON g.lang = w.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = w.term),
totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source),
langs AS (SELECT lang, term, sum(n) AS n FROM cells GROUP BY lang, term),
lang_totals AS (SELECT lang, sum(n) AS total FROM langs GROUP BY lang),
p AS (
    SELECT c.lang, c.source, c.term, c.n,
           1 + (1000000000::HUGEINT * (c.n + 2)) // (t.total + 2 * s.v) AS p
    FROM cells c JOIN totals t ON c.lang = t.lang AND c.source = t.source
    JOIN sizes s ON c.lang = s.lang),
q AS (
    SELECT l.lang, l.term, 1 + (1000000000::HUGEINT * (l.n + 2)) // (t.total + 2 * s.v) AS q
    FROM langs l JOIN lang_totals t ON l.lang = t.lang JOIN sizes s ON l.lang = s.lang),
pairs AS (
    SELECT a.lang, a.source, b.source AS item,
           sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
           CAST(coalesce(x.value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    UNION ALL
    SELECT p.lang, p.source, 'term', p.term,
           CAST(((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) AS BIGINT)
    FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part
                                      ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# Nodes keyed by the sequences themselves. crc32 is taken bit by bit: a byte, then -1 for each shift.
PREFIX_TRIE = r"""
WITH own AS (
    SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (
               PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, coalesce(role, ''),
                        md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''),
                                   coalesce(text, '')))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv, max(pos) AS n FROM own GROUP BY conv),
crc AS (
    SELECT conv, n, conv - conv % 20 AS base,
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, flatten(list_transform(
                   range(1, length(CAST(conv AS VARCHAR)) + 1),
                   lambda i: [ascii(CAST(conv AS VARCHAR)[i])::BIGINT,
                              -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                                 ELSE xor(a >> 1, (a & 1) * 3988292384) END),
               4294967295) % 4 AS h
    FROM sizes),
convs AS (
    SELECT c.conv, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS taken
    FROM crc c LEFT JOIN sizes b ON b.conv = c.base),
turns AS (
    SELECT c.conv, o.pos, o.role, o.text
    FROM convs c JOIN own o ON o.conv = c.base AND o.pos <= c.taken
    UNION ALL
    SELECT c.conv, c.taken + o.pos - c.h, o.role, o.text
    FROM convs c JOIN own o ON o.conv = c.conv AND o.pos > c.h),
sequences AS (
    SELECT c.conv, coalesce(s.turns, []) AS turns
    FROM convs c LEFT JOIN (
        SELECT conv, list(struct_pack(role := role, text := text) ORDER BY pos) AS turns
        FROM turns GROUP BY conv) s ON s.conv = c.conv),
members AS (
    SELECT conv, d AS depth, list_slice(turns, 1, d) AS seq, d = len(turns) AS ends
    FROM (SELECT conv, turns, unnest(range(0, len(turns) + 1)) AS d FROM sequences)),
named AS (
    SELECT conv, depth, ends, min(conv) OVER (PARTITION BY depth, seq) AS node,
           CASE WHEN depth = 0 THEN 0
                ELSE len(regexp_extract_all(seq[depth].text, '[^\x20\x09-\x0D]+')) END AS words
    FROM members),
nodes AS (
    SELECT depth, node, count(*) AS n_convs, max(words) AS words,
           coalesce(string_agg(CASE WHEN ends THEN CAST(conv AS VARCHAR) END, ',' ORDER BY conv),
                    '') AS ends
    FROM named GROUP BY depth, node),
parents AS (
    SELECT n.depth, n.node, m.node AS parent
    FROM nodes n LEFT JOIN named m ON m.conv = n.node AND m.depth = n.depth - 1),
children AS (
    SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children
    FROM parents WHERE depth > 0 GROUP BY depth, parent),
own_values AS (
    SELECT n.*, p.parent, coalesce(c.n_children, 0) AS n_children
    FROM nodes n JOIN parents p ON n.depth = p.depth AND n.node = p.node
    LEFT JOIN children c ON n.depth = c.depth AND n.node = c.node),
sums AS (
    SELECT m.depth, m.node, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
           sum((v.n_convs - 1) * v.words) AS saved_tokens
    FROM own_values v JOIN named m ON m.conv = v.node AND m.depth <= v.depth
    GROUP BY m.depth, m.node)
SELECT v.node AS conv_id, v.depth, v.parent AS parent_conv_id, v.n_convs, v.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(v.ends) AS ends_sha256
FROM own_values v JOIN sums s ON v.depth = s.depth AND v.node = s.node
"""
