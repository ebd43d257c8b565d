"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

OP10 = r"""
WITH digests AS (
    SELECT doc_id, coalesce(length(text), 0) AS chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), ranked AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM digests
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
"""


#: The checksum of a string ``s``: a table of 256 entries, and one step for each byte.
CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
)"""


def crc32(s: str) -> str:
    """SQL for the unsigned checksum of ``s``, where ``crc_table`` is in scope."""
    byte = f"('0x' || substr(hex(encode({s})), 2 * i::INT + 1, 2))::BIGINT"
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_transform(range(strlen({s})), lambda i: {byte}), lambda c, b: {step}, 4294967295), 4294967295)"


OP11 = rf"""
WITH RECURSIVE {CRC_TABLE}, said AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
    FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
    SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS p
    FROM said
), ids AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {crc32("conv_id::VARCHAR")} % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), parts AS (
    SELECT i.conv_id, 0 AS place, t.p, t.digest, t.words
    FROM ids i JOIN turns t ON t.conv_id = i.base AND i.conv_id <> i.base AND t.p <= i.h
    UNION ALL
    SELECT i.conv_id, 1, t.p, t.digest, t.words
    FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND (i.conv_id = i.base OR t.p > i.h)
), whole AS (
    SELECT i.conv_id, coalesce(list(p.digest ORDER BY p.place, p.p) FILTER (p.p IS NOT NULL), []) AS digests,
           coalesce(list(p.words ORDER BY p.place, p.p) FILTER (p.p IS NOT NULL), []) AS words
    FROM ids i LEFT JOIN parts p ON p.conv_id = i.conv_id GROUP BY i.conv_id
), prefixes AS (
    SELECT conv_id, d, array_to_string(digests[1:d], ',') AS node, len(digests) = d AS is_end,
           CASE WHEN d > 0 THEN array_to_string(digests[1:d - 1], ',') END AS parent,
           CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
    FROM whole, unnest(range(0, len(digests) + 1)) AS u(d)
), nodes AS (
    SELECT node, any_value(d) AS depth, any_value(parent) AS parent, any_value(words) AS words,
           min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
    FROM prefixes GROUP BY node
), children AS (
    SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
    SELECT up.node, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((q.n_convs - 1) * q.words) AS saved_tokens
    FROM nodes q LEFT JOIN children c ON c.node = q.node
    JOIN prefixes up ON up.conv_id = q.conv_id AND up.d <= q.depth
    GROUP BY up.node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.node = n.node
LEFT JOIN nodes up ON up.node = n.parent LEFT JOIN children c ON c.node = n.node
"""

OP13 = rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), hashed AS (
    SELECT run, {crc32("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc_table WHERE length(run) >= 7
), words AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
           count(*) AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND count(*) >= 2
), dropped AS (
    SELECT word, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest
    FROM words, unnest(range(1, length(word) + 1)) AS u(k)
), near AS (
    SELECT d.word, w.word AS near FROM dropped d JOIN words w ON w.word = d.rest
    UNION
    SELECT w.word, d.word FROM dropped d JOIN words w ON w.word = d.rest
    UNION
    SELECT a.word, b.word FROM dropped a JOIN dropped b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
), ranked AS (
    SELECT near.word, near.near, w.n, count(*) OVER (PARTITION BY near.word) AS n_near,
           row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, near.near) AS k
    FROM near JOIN words w ON w.word = near.near
), forms AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
           CASE WHEN r.n >= 10 * w.n THEN r.near END AS form, CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1
), ways AS (
    SELECT word, word AS root FROM forms
    UNION ALL
    SELECT ways.word, f.form FROM ways JOIN forms f ON f.word = ways.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n
FROM forms f JOIN ways w ON w.word = f.word JOIN forms last ON last.word = w.root AND last.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_exact_dedup": OP10, "op11_prefix_trie": OP11, "op13_spelling": OP13}
