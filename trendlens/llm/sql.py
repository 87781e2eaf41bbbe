"""DuckDB SQL for the rows of the queries that SQL can express."""

OP11 = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), numbers AS (
    SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM drawn
), formed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, substring(text, 1, a) AS head, substring(text, a + 1, b - a) AS mid, substring(text, b + 1, n - b) AS tail FROM formed
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || mid
                     ELSE '<S>' || tail || '<P>' || head || '<M>' || mid END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""

OP12 = r"""
WITH turns AS (
    SELECT conv_id, list(struct_pack(digest, words) ORDER BY turn NULLS FIRST, digest) AS own
    FROM (SELECT conv_id, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
              len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
          FROM conversations WHERE conv_id IS NOT NULL)
    GROUP BY conv_id
), crc AS (
    -- a step is a byte to mix in, or -1 for the shift of one bit
    SELECT conv_id, own, xor(list_reduce(list_prepend(4294967295::BIGINT,
            flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: list_prepend(ascii(c)::BIGINT, repeat([-1::BIGINT], 8))))),
            lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT) % 4 AS h
    FROM turns
), rebuilt AS (
    SELECT a.conv_id, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS path
    FROM crc a LEFT JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % 20
), members AS (
    SELECT conv_id, d, len(path) = d AS ends, path[d].words AS words, sha256(array_to_string(list_transform(path[1:d], lambda t: t.digest), '')) AS node,
        CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(path[1:d - 1], lambda t: t.digest), '')) END AS parent
    FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, coalesce((count(*) - 1) * any_value(words), 0) AS own,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY node
), kids AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent
), subtrees AS (
    SELECT m.node, sum(n.own)::BIGINT AS saved_tokens, count(*) FILTER (k.n_children IS NULL) AS n_leaves
    FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.d <= n.depth LEFT JOIN kids k ON k.node = n.node
    GROUP BY m.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s USING (node) LEFT JOIN kids k USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""

OP13 = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), starts AS (
    SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s FROM items WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[s:s + 9], ' ') AS win FROM starts
), places AS (
    SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS p
    FROM texts, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size
), seen AS (
    SELECT r, p, size, item_id FROM (SELECT r, p, size, array_to_string(words[p:p + size - 1], ' ') AS win FROM places) JOIN windows USING (size, win)
), hits AS (
    SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS place FROM seen) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS name FROM seen) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

ORACLES: dict[str, str] = {"op11_infill": OP11, "op12_prefixes": OP12, "op13_leaks": OP13}
