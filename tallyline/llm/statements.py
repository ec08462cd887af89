"""Expected results of the queries that SQL can express, for DuckDB."""

#: Leaves, trees level by level, siblings and folding; CRC-32 bit by bit.
MERKLE = """
WITH RECURSIVE
fields AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, n_chars,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
               || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
           coalesce(strlen(text) || ':' || text, '-') AS tail,
           list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)),
               lambda crc, b: list_reduce(
                   list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda v, bit: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END
               )
           ) AS crc
    FROM documents
),
leaf_rows AS (
    SELECT doc_id, tree,
           sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') || tail) AS leaf,
           sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR), '-') || tail) AS other,
           coalesce(xor(crc, 4294967295::BIGINT) % 7 = 0, false) AS tampered
    FROM fields
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaf_rows
),
levels AS (
    SELECT tree, 0 AS lvl, pos, leaf AS node FROM numbered
    UNION ALL
    SELECT tree, lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM levels) WHERE n > 1
    GROUP BY tree, lvl, pos // 2
),
heights AS (SELECT tree, max(lvl) AS top, arg_max(node, lvl) AS subroot FROM levels GROUP BY tree),
forest AS (SELECT tree, subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM heights),
upper_levels AS (
    SELECT 0 AS lvl, pos, subroot AS node FROM forest
    UNION ALL
    SELECT lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS n FROM upper_levels) WHERE n > 1
    GROUP BY lvl, pos // 2
),
summit AS (SELECT max(lvl) AS top, arg_max(node, lvl) AS root FROM upper_levels),
folds AS (
    SELECT tree, pos, 0 AS lvl, CASE WHEN tampered THEN other ELSE leaf END AS node, '' AS siblings FROM numbered
    UNION ALL
    SELECT f.tree, f.pos, f.lvl + 1,
           sha256(CASE WHEN s.node IS NULL THEN f.node WHEN (f.pos >> f.lvl) % 2 = 0 THEN f.node || s.node ELSE s.node || f.node END),
           f.siblings || coalesce(s.node, '')
    FROM folds f JOIN heights h ON h.tree = f.tree AND f.lvl < h.top
    LEFT JOIN levels s ON s.tree = f.tree AND s.lvl = f.lvl AND s.pos = xor(f.pos >> f.lvl, 1)
),
upper_folds AS (
    SELECT f.tree, f.pos, t.pos AS place, 0 AS lvl, f.node, f.siblings
    FROM folds f JOIN heights h ON h.tree = f.tree AND f.lvl = h.top JOIN forest t ON t.tree = f.tree
    UNION ALL
    SELECT f.tree, f.pos, f.place, f.lvl + 1,
           sha256(CASE WHEN s.node IS NULL THEN f.node WHEN (f.place >> f.lvl) % 2 = 0 THEN f.node || s.node ELSE s.node || f.node END),
           f.siblings || coalesce(s.node, '')
    FROM upper_folds f JOIN summit ON f.lvl < summit.top
    LEFT JOIN upper_levels s ON s.lvl = f.lvl AND s.pos = xor(f.place >> f.lvl, 1)
)
SELECT n.doc_id, n.leaf, t.subroot, s.root, sha256(f.siblings) AS proof_sha256, f.node AS folded_root, f.node = s.root AS verified
FROM numbered n JOIN forest t USING (tree) CROSS JOIN summit s
JOIN upper_folds f ON f.tree = n.tree AND f.pos = n.pos AND f.lvl = s.top
"""

#: Terms, their weights and the ten best documents of each item.
SEARCH = r"""
WITH terms AS (
    SELECT rowid_ AS row, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)
),
counts AS (SELECT row, doc_id, term, count(*) AS tf FROM terms GROUP BY row, doc_id, term),
sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY row),
total AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sizes),
wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM benchmark
),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, total WHERE term IN (SELECT term FROM wanted) GROUP BY term, documents
),
scored AS (
    SELECT item_id, row, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // length)))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (row), total
    GROUP BY item_id, row, doc_id
),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

#: Links by brute force, and the smallest vector that each one reaches.
EMBEDDINGS = """
WITH RECURSIVE
vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
    SELECT vec_id, e FROM vectors
    WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 ELSE false END
),
reach AS (
    SELECT vec_id AS node, vec_id AS other FROM vectors
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.node AS vec_id, coalesce(max(d.n), 0) AS n_links, min(r.other) AS component_id, r.node = min(r.other) AS kept
FROM reach r LEFT JOIN degrees d ON d.a = r.node GROUP BY r.node
"""
