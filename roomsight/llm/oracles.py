"""The operators' results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from .common import TOKEN, WORD
from .decontaminate import WINDOW
from .licences import BASE, COVERAGE, K, NEAR, STRETCHED, TEMPLATES, VOTES
from .minhash import PERCENT, SHINGLE
from .mixing import MOST, SEED, SHARE, WEIGHTS

LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = f"regexp_extract_all(coalesce({LOW.format('text')}, ''), '{WORD}')"

OP1 = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {WORDS} AS ws FROM documents),
items AS (SELECT item_id, {WORDS} AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(len(ws), {WINDOW}) AS size FROM items WHERE len(ws) > 0),
known AS (SELECT DISTINCT item_id, size, array_to_string(ws[s:s + size - 1], ' ') AS win
          FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS s FROM sized)),
places AS (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS s
           FROM docs, (SELECT DISTINCT size FROM known)),
found AS (SELECT r, s, p.size, item_id FROM places p
          JOIN known k ON k.size = p.size AND k.win = array_to_string(p.ws[p.s:p.s + p.size - 1], ' ')),
hit AS (SELECT r, count(DISTINCT word) AS n_hit
        FROM (SELECT r, unnest(range(s, s + size)) AS word FROM found) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM found GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

_quality = r"""greatest(0.05::DOUBLE, CASE WHEN size + symbols = 0 THEN 1.0::DOUBLE
    ELSE size::DOUBLE / (size + 4 * symbols) END)"""

OP2 = f"""
WITH counted AS (SELECT doc_id, source, text,
    len(regexp_extract_all(coalesce(text, ''), '{TOKEN}')) AS size,
    len(regexp_extract_all(coalesce(text, ''), '[#$%&*|!<>{{}}=]')) AS symbols FROM documents),
rows_ AS (SELECT doc_id, source, size, -ln((('0x' || substr(md5(concat_ws('|',
    concat_ws('|', doc_id::VARCHAR, md5(text)), '{SEED}')), 1, 13))::BIGINT + 0.5::DOUBLE)
    / {2 ** 52}::DOUBLE) / {_quality} AS key FROM counted),
sources AS (SELECT source, sum(size)::BIGINT AS s,
    {list(WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS w,
    row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM rows_ GROUP BY source),
walk AS (SELECT *, {MOST} * s AS most, row_number() OVER o AS place,
    coalesce(sum({MOST} * s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS held,
    sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS open,
    {SHARE}::DOUBLE * (SELECT sum(s) FROM sources)::DOUBLE AS budget
    FROM sources WINDOW o AS (ORDER BY {MOST} * s / w, rn)),
level AS (SELECT place, budget - held AS b, open FROM walk
          WHERE w * (budget - held) / open < most ORDER BY place LIMIT 1),
targets AS (SELECT source, s, CASE WHEN place < coalesce((SELECT place FROM level), 1000000000)
    THEN most::DOUBLE ELSE w * (SELECT b FROM level) / (SELECT open FROM level) END AS target FROM walk),
plan AS (SELECT source, s, target, CASE WHEN s = 0 THEN 0 ELSE floor(target / s) END AS epochs,
    target - CASE WHEN s = 0 THEN 0 ELSE floor(target / s) END * s AS rest FROM targets),
groups AS (SELECT source, key, sum(size) AS g FROM rows_ GROUP BY source, key),
upto AS (SELECT *, sum(g) OVER (PARTITION BY source ORDER BY key) - g AS before FROM groups)
SELECT doc_id, size::BIGINT AS size, s AS source_size, target,
    (size * (epochs + CASE WHEN rest > 0 AND 2 * before + g <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rows_ r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source
JOIN upto u ON u.source IS NOT DISTINCT FROM r.source AND u.key = r.key
"""

ORACLES = {"op1_decontaminate": OP1, "op2_mixture": OP2}

_templates = ", ".join(f"({i}, '{label}', {str(base).lower()}, '{text}')" for i, (label, text, base) in
                       enumerate([(*b, True) for b in BASE] + [(*t, False) for t in TEMPLATES]))

OP9 = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {WORDS} AS ws FROM documents),
tpl AS (SELECT tid, label, is_base, string_split(text, ' ') AS ws
        FROM (VALUES {_templates}) AS v(tid, label, is_base, text)),
tgrams AS (SELECT tid, label, is_base, len(ws) - {K - 1} AS grams, len(ws) AS length, s - 1 AS place,
           array_to_string(ws[s:s + {K - 1}], ' ') AS gram
           FROM (SELECT *, unnest(range(1, len(ws) - {K - 2})) AS s FROM tpl)),
grams AS (SELECT r, s - 1 AS pos, array_to_string(ws[s:s + {K - 1}], ' ') AS gram
          FROM (SELECT r, ws, unnest(range(1, len(ws) - {K - 2})) AS s FROM docs)),
found AS (SELECT r, pos, tid, label, is_base, grams, length, place, pos - place AS diagonal
          FROM grams JOIN tgrams USING (gram)),
lines AS (SELECT r, tid, label, is_base, grams, length, diagonal, count(DISTINCT place) AS n,
                 min(pos) AS low, max(pos) AS high FROM found GROUP BY ALL),
opened AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, tid ORDER BY diagonal)
                  <= {NEAR} THEN 0 ELSE 1 END AS opens FROM lines),
clustered AS (SELECT *, sum(opens) OVER (PARTITION BY r, tid ORDER BY diagonal) AS cluster FROM opened),
merged AS (SELECT r, tid, label, is_base, grams, length, cluster,
    count(*) FILTER (n = grams) AS places, min(diagonal) FILTER (n = grams) AS first,
    max(diagonal) FILTER (n = grams) AS last, min(low) AS low, max(high) AS high
    FROM clustered GROUP BY r, tid, label, is_base, grams, length, cluster),
covered AS (SELECT c.r, c.tid, c.cluster, count(DISTINCT f.place) AS n FROM clustered c
    JOIN found f ON f.r = c.r AND f.tid = c.tid AND f.diagonal = c.diagonal GROUP BY 1, 2, 3),
judged AS (SELECT m.*, n::DOUBLE / grams AS coverage, CASE WHEN is_base THEN places > 0 ELSE places > 0
    OR (n >= {COVERAGE} * grams AND n >= {VOTES} AND high + {K} - low <= {STRETCHED} * length) END AS ok
    FROM merged m JOIN covered USING (r, tid, cluster)),
by_text AS (SELECT r, sum(places) FILTER (is_base AND ok) AS n_base,
    min(first) FILTER (is_base AND ok) AS first_word, max(last) FILTER (is_base AND ok) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base AND ok) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (ok) AS labels, max(coverage) AS score
    FROM judged GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
    first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN by_text USING (r)
"""

ORACLES["op9_licence_scan"] = OP9

OP13 = f"""
WITH RECURSIVE docs AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(coalesce({LOW.format('text')}, ''), '{TOKEN}') AS ws FROM documents),
sets AS (SELECT DISTINCT r, array_to_string(ws[s:s + {SHINGLE - 1}], ' ') AS gram
         FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - {SHINGLE - 2}, 2))) AS s FROM docs
               WHERE len(ws) > 0)),
sizes AS (SELECT r, count(*) AS n FROM sets GROUP BY r),
links AS (SELECT a.r AS x, b.r AS y FROM sets a JOIN sets b ON a.gram = b.gram AND a.r < b.r
    JOIN sizes m ON m.r = a.r JOIN sizes n ON n.r = b.r GROUP BY a.r, b.r, m.n, n.n
    HAVING 100 * count(*) >= {PERCENT} * (m.n + n.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT r AS x, r AS y FROM docs UNION
          SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.y),
least AS (SELECT reach.x AS r, min(doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.y GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id,
    doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs JOIN least USING (r) LEFT JOIN sizes USING (r)
"""

ORACLES["op13_minhash"] = OP13

_crc32 = """xor(list_reduce([4294967295::BIGINT] || [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')],
    lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda v, step: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"""

OP11 = f"""
WITH turns AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
               FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST,
    md5(concat_ws('|', strlen(role)::VARCHAR, role, text))) AS own, {_crc32} % 9 AS h FROM turns GROUP BY c),
made AS (SELECT a.c, coalesce(b.own[1:a.h], []) || a.own[a.h + 1:] AS t
         FROM convs a LEFT JOIN convs b ON b.c = a.c - a.c % 5),
members AS (SELECT c, len(t) AS size, d, t[1:d] AS key
            FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM made)),
nodes AS (SELECT key, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = size), '') AS ends FROM members GROUP BY key, d),
children AS (SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
own AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(nodes.key[depth].text) END AS saved
    FROM nodes LEFT JOIN children ON children.key = nodes.key),
sums AS (SELECT key[1:k] AS key, k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved
         FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM own) GROUP BY 1, 2)
SELECT own.conv_id::BIGINT AS conv_id, own.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id,
    own.n_convs::BIGINT AS n_convs, own.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
    sums.saved::BIGINT AS saved_tokens, sha256(own.ends) AS ends_sha256
FROM own JOIN sums ON sums.key = own.key
LEFT JOIN nodes parent ON own.depth > 0 AND parent.key = own.key[1:own.depth - 1]
"""

ORACLES["op11_conversation_trie"] = OP11
