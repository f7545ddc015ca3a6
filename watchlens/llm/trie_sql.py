"""SQL of the fill-in-the-middle and conversation trie queries, in DuckDB's dialect."""

MIDDLES = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|(?s:[^A-Za-z])') AS units,
           [('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8 * k + 1, 8))::BIGINT FOR k IN range(0, 4)] AS h
    FROM documents
), ranked AS (
    SELECT *, len(units)::BIGINT AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS low,
           greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS high,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), cut AS (
    SELECT *, array_to_string(units[:low], '') AS p, array_to_string(units[low + 1:high], '') AS m, array_to_string(units[high + 1:], '') AS s
    FROM ranked
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

#: crc32 of a decimal number's text, bit by bit.
_CRC32 = """xor(4294967295, list_reduce([4294967295::BIGINT] || [ascii(d)::BIGINT FOR d IN string_split(CAST(conv_id AS VARCHAR), '')],
    lambda c, d: list_reduce([xor(c, d)] || [0::BIGINT FOR i IN range(0, 8)], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

TRIE = f"""
WITH original AS (
    SELECT conv_id::BIGINT AS conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1
), drawn AS (
    SELECT *, ({_CRC32} % 4)::BIGINT AS h FROM original
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns, [])[:c.h], c.turns[c.h + 1:]) AS path
    FROM drawn c LEFT JOIN original b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefix AS (
    SELECT conv_id, d, path[:d] AS p, d = len(path) AS ends FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), node AS (
    SELECT p, d, min(conv_id) AS conv_id, count(*) AS n,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefix GROUP BY p, d
), linked AS (
    SELECT a.*, b.conv_id AS parent_conv_id, coalesce(k.children, 0) AS children,
           CASE WHEN a.d = 0 THEN 0 ELSE (a.n - 1) * len(regexp_extract_all(a.p[a.d].t, '[^\\x20\\x09-\\x0D]+')) END AS own
    FROM node a LEFT JOIN node b ON b.d = a.d - 1 AND b.p = a.p[:a.d - 1]
    LEFT JOIN (SELECT p[:d - 1] AS p, count(*) AS children FROM node WHERE d > 0 GROUP BY 1) k ON k.p = a.p
), below AS (
    SELECT up, sum(own) AS saved, count(*) FILTER (children = 0) AS leaves
    FROM (SELECT own, children, p[:unnest(range(0, d + 1))] AS up FROM linked) GROUP BY up
)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n::BIGINT AS n_convs, children::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM linked JOIN below ON below.up = linked.p
"""
