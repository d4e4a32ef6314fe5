"""The SQL counterparts of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

WORDS = r"'[^\x20\x09-\x0D]+'"
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all({FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all({FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), test AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n,
           array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
    FROM item, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i)
    WHERE len(w) > 0
), place AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase
    FROM (SELECT * FROM doc, (SELECT DISTINCT n FROM test) AS l), unnest(range(1, len(w) - n + 2)) AS t(i)
), hit AS (
    SELECT doc_id, place.n, i, item_id FROM place JOIN test ON place.n = test.n AND place.phrase = test.phrase
), covered AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(k) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT item_id)) AS found
    FROM hit GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items,
       sha256(coalesce(array_to_string(found, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP3 = rf"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents
), run AS (
    SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS phrase
    FROM doc, unnest(range(1, len(w) - 33)) AS t(i)
), twice AS (
    SELECT phrase FROM run GROUP BY phrase HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, k
    FROM (SELECT doc_id, i FROM run SEMI JOIN twice USING (phrase)), unnest(range(i, i + 35)) AS t(k)
), word AS (
    SELECT doc_id, k, w[k] AS word FROM doc, unnest(range(1, len(w) + 1)) AS t(k)
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
), removed AS (
    SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# The level at which the first k sources stand at their caps, for each k, as in mixture.targets.
OP5 = rf"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {WORDS})) AS BIGINT) AS size FROM documents
), src AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM sized GROUP BY source
), capped AS (
    SELECT *, [5.0, 2.0, 1.0][rank % 3 + 1]::DOUBLE AS weight, (3 * source_size)::DOUBLE AS cap FROM src
), leveled AS (
    SELECT *, cap / weight AS turn,
           ((SELECT sum(source_size) FROM src)::DOUBLE
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM capped
), water AS (
    SELECT level AS water FROM leveled WHERE level <= turn ORDER BY turn, rank LIMIT 1
), aim AS (
    SELECT source, source_size, coalesce(least(cap, (SELECT water FROM water) * weight), cap) AS target FROM leveled
), rated AS (
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
           CAST('0x' || substr(md5('5:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)::DOUBLE
           / 4503599627370496.0::DOUBLE AS draw
    FROM sized JOIN aim ON sized.source IS NOT DISTINCT FROM aim.source
)
SELECT doc_id, size, source_size, target,
       size * CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM rated
"""

OP8 = """
WITH turns AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations
), placed AS (
    SELECT conv_id, row_number() OVER w AS place,
           sha256(coalesce('r' || role, '-') || chr(0) || coalesce('t' || text, '-')) AS h,
           '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS line
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), prefix AS (
    SELECT conv_id, place, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY place) AS p FROM placed
), whole AS (
    SELECT conv_id, max(place) AS n, max_by(p, place) AS p, FROM prefix GROUP BY conv_id
), kept AS (
    SELECT min(conv_id) AS conv_id, n, count(*) AS n_logged FROM whole
    WHERE p NOT IN (SELECT prefix.p FROM prefix JOIN whole AS o ON o.conv_id = prefix.conv_id AND place < o.n)
    GROUP BY n, p
)
SELECT kept.conv_id, n AS n_turns, n_logged, string_agg(line, '' ORDER BY place) AS rendered
FROM kept JOIN placed ON placed.conv_id = kept.conv_id GROUP BY kept.conv_id, n, n_logged
"""

# crc32 is worked out bit by bit over the id's ASCII characters.
OP11 = """
WITH placed AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
           sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))) AS turn_id,
           CAST(strlen(coalesce(text, '')) AS BIGINT) AS size
    FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base,
           xor(list_reduce(
               list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
               lambda c, x: list_reduce(
                   [xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))
           ), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM placed)
), rebuilt AS (
    SELECT conv.conv_id, place, turn_id, size
    FROM conv JOIN placed ON placed.conv_id = base AND place <= h
    UNION ALL
    SELECT conv.conv_id, place - h + least(h, (SELECT count(*) FROM placed AS o WHERE o.conv_id = base)), turn_id, size
    FROM conv JOIN placed ON placed.conv_id = conv.conv_id AND place > h
), prefix AS (
    SELECT conv_id, place AS depth, size, string_agg(turn_id, '') OVER (PARTITION BY conv_id ORDER BY place) AS p FROM rebuilt
), member AS (
    SELECT conv_id, depth, size, sha256(p) AS node, lag(sha256(p)) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
           depth = max(depth) OVER (PARTITION BY conv_id) AS ends
    FROM prefix
    UNION ALL
    SELECT conv_id, 0, 0, '', NULL, conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM conv
), linked AS (
    SELECT * REPLACE (CASE WHEN depth = 1 THEN '' ELSE parent END AS parent) FROM member
), node AS (
    SELECT node, depth, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs,
           (count(*) - 1) * any_value(size) AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM linked GROUP BY node, depth
), kids AS (
    SELECT parent, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent
), below AS (
    SELECT up.node, sum(down.saved) AS saved_tokens, count(*) FILTER (WHERE kids.parent IS NULL) AS n_leaves
    FROM node AS down
    JOIN member AS up ON up.conv_id = down.conv_id AND up.depth <= down.depth
    LEFT JOIN kids ON kids.parent = down.node
    GROUP BY up.node
)
SELECT node.conv_id, node.depth, above.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN below USING (node) LEFT JOIN node AS above ON above.node = node.parent LEFT JOIN kids ON kids.parent = node.node
"""

OP13 = f"""
WITH line AS (
    SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM line
), common AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT doc_id, i, line, last IS NOT NULL AND last <> doc_id AS gone FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLES = {
    "op2_decontaminate": OP2,
    "op3_drop_repeats": OP3,
    "op5_mix_sources": OP5,
    "op8_format_chats": OP8,
    "op11_conversation_trie": OP11,
    "op13_drop_lines": OP13,
}
