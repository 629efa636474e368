"""The same results in DuckDB SQL, where SQL can state them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op4_exact"] = r"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
), g AS (
    SELECT norm, count(*) AS group_size, arg_max(doc_id, points::HUGEINT * 10000000000000000000 - doc_id) AS keep_id
    FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g USING (norm)
"""

ORACLES["op5_warc"] = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages
), t AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY body) ELSE page_id END AS top FROM p
)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top <> page_id THEN top END AS refers_to
FROM t
"""

ORACLES["op8_chat"] = r"""
WITH r AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
    SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS safe FROM r
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + 23 + length(safe) + CASE WHEN safe LIKE '|%' THEN 1 ELSE 0 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLES["op9_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source, md5(doc_id::VARCHAR || ':7') AS key,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s
), b AS (
    SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
           coalesce(sum(3 * source_size) OVER o, 0) AS stopped, coalesce(sum(weight) OVER o, 0) AS stopped_weight
    FROM w WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
    SELECT *, 3 * source_size * (weights - stopped_weight) < weight * (total - stopped) AS stops FROM b
), t AS (
    SELECT source, source_size,
           CASE WHEN stops THEN (3 * source_size)::DOUBLE
                ELSE coalesce(((total - sum(CASE WHEN stops THEN 3 * source_size ELSE 0 END) OVER ()) * weight)::DOUBLE
                     / sum(CASE WHEN stops THEN 0 ELSE weight END) OVER (), 0) END AS target
    FROM c
), p AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t
), r AS (
    SELECT d.doc_id, d.size, p.source_size, p.target, p.passes,
           greatest(0, floor(p.target)::BIGINT - p.passes * p.source_size) AS rest,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key) - d.size AS before
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (passes * size + least(size, greatest(0, rest - before)))::BIGINT AS taken
FROM r
"""

ORACLES["op6_lines"] = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no
    FROM documents
), n AS (
    SELECT doc_id, line_no, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM l
), w AS (
    SELECT * FROM n WHERE norm <> ''
), f AS (
    SELECT norm, min((doc_id::HUGEINT * 2147483648) + line_no) AS first FROM w GROUP BY norm
), h AS (
    SELECT norm, first, b.base, k.side,
           CASE WHEN k.side = 0 THEN left(norm, (b.base // 2)::INT) ELSE right(norm, (b.base - (b.base // 2))::INT) END AS half
    FROM (SELECT *, length(norm) AS size FROM f WHERE length(norm) >= 20),
         LATERAL (SELECT unnest([size, size - 1]) AS base) AS b, (SELECT unnest([0, 1]) AS side) AS k
    WHERE b.base >= 20
), g AS (
    SELECT x.norm, min(y.first) AS near
    FROM h AS x JOIN h AS y ON x.base = y.base AND x.side = y.side AND x.half = y.half AND y.first < x.first
    WHERE levenshtein(x.norm, y.norm) <= 1
    GROUP BY x.norm
), d AS (
    SELECT w.doc_id, w.line_no
    FROM w JOIN f USING (norm) LEFT JOIN g USING (norm)
    WHERE w.doc_id::HUGEINT * 2147483648 + w.line_no > f.first OR g.near IS NOT NULL
), s AS (
    SELECT doc_id, count(*) AS n_dropped, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS dropped FROM d GROUP BY doc_id
)
SELECT doc_id, len(string_split(coalesce(text, ''), chr(10)))::BIGINT AS n_lines,
       coalesce(n_dropped, 0)::BIGINT AS n_dropped, coalesce(dropped, '') AS dropped_lines
FROM documents LEFT JOIN s USING (doc_id)
"""

ORACLES["op11_decontamination"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
), b AS (
    SELECT item_id::VARCHAR AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark
), g AS (
    SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS gram
    FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM (SELECT *, least(len(ws), 10) AS n FROM b WHERE len(ws) > 0))
), w AS (
    SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS gram
    FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g))
), h AS (
    SELECT r, i, w.n, item FROM w JOIN g ON w.gram = g.gram AND w.n = g.n
), p AS (
    SELECT r, count(DISTINCT place)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM h) GROUP BY r
), t AS (
    SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""


def _merkle() -> str:
    """Trees of up to eight levels a language and four above them, level by level; DuckDB lists from 1."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
    row = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    with_queries = [f"""
d AS (
    SELECT doc_id, lang, {row('text')} AS leaf, {row('low')} AS changed
    FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents)
)""", """
b AS (SELECT b, list_reduce([b::BIGINT] || [0::BIGINT for i in range(8)], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(256) AS r(b))""", """
k AS (SELECT list(t ORDER BY b) AS t FROM b)""", """
t0 AS (
    SELECT doc_id, leaf, changed, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS idx,
           xor(4294967295, list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')], lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS crc
    FROM d, k
)""", """
c0 AS (SELECT doc_id, leaf, tree, idx, CASE WHEN crc % 3 = 0 THEN changed ELSE leaf END AS folded, '' AS proof FROM t0)""", """
n0 AS (SELECT tree, idx, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM t0)"""]
    lower, upper = 8, 4
    climbed = "doc_id, leaf, "
    for k in range(lower + upper):
        if k == lower:
            with_queries.append(f"""
s AS (SELECT tree AS lang_tree, digest AS subroot FROM n{k})""")
            with_queries.append(f"""
m{k} AS (SELECT 0 AS tree, tree AS idx, digest, count(*) OVER () AS n FROM n{k})""")
            with_queries.append(f"""
e{k} AS (SELECT doc_id, leaf, subroot, 0 AS tree, tree AS idx, folded, proof FROM c{k} JOIN s ON tree = lang_tree)""")
            climbed = "doc_id, leaf, subroot, "
        nodes, leaves = (f"m{k}", f"e{k}") if k == lower else (f"n{k}", f"c{k}")
        with_queries.append(f"""
r{k} AS (SELECT tree, idx // 8 AS run, any_value(n) AS n, list(digest ORDER BY idx) AS run_digests FROM {nodes} GROUP BY tree, idx // 8)""")
        with_queries.append(f"""
n{k + 1} AS (SELECT tree, run AS idx, CASE WHEN n = 1 THEN run_digests[1] ELSE sha256(array_to_string(run_digests, '')) END AS digest, (n + 7) // 8 AS n FROM r{k})""")
        left, right = "array_to_string(run_digests[1:(idx % 8)], '')", "array_to_string(run_digests[(idx % 8) + 2:], '')"
        with_queries.append(f"""
c{k + 1} AS (
    SELECT {climbed}tree, idx // 8 AS idx, CASE WHEN n = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded,
           CASE WHEN n = 1 THEN proof ELSE proof || {left} || {right} END AS proof
    FROM {leaves} JOIN r{k} USING (tree) WHERE idx // 8 = run
)""")
    last = lower + upper
    return "WITH" + ",".join(with_queries) + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM c{last}, n{last}
"""


ORACLES["op12_merkle"] = _merkle()
