"""DuckDB SQL for the queries that SQL can express, over the same tables and with the same columns."""

from __future__ import annotations

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

OP3 = rf"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '{WHITE}', ' ', 'g') AS norm FROM documents
), g AS (
    SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) AS n
    FROM t
)
SELECT doc_id, keep_id, group_size, n = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""

# weights 3, 1, 2 by the source's rank; 1.5 times all sizes; at most twice the source's size
OP5 = rf"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS cap,
           [3.0::DOUBLE, 1.0, 2.0][(((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3) + 1] AS weight
    FROM d GROUP BY source
), r AS (
    SELECT *, coalesce(sum(cap) OVER w, 0)::DOUBLE AS full_before,
           sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
           (SELECT 1.5::DOUBLE * sum(source_size) FROM s) AS budget
    FROM s WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
    -- sources fill in the order of cap / weight; the level is the first that fills none of the rest
    SELECT max((budget - full_before) / weight_left) FILTER (WHERE (budget - full_before) / weight_left * weight < cap) AS level FROM r
), t AS (
    SELECT s.source, source_size, least(cap, coalesce(level * weight, cap)) AS target,
           CASE WHEN source_size > 0 THEN floor(least(cap, coalesce(level * weight, cap)) / source_size)::BIGINT ELSE 0 END AS whole
    FROM s, l
), b AS (
    -- rows of one hash are taken together
    SELECT source, h, sum(size) AS w, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS after FROM d WHERE size > 0 GROUP BY source, h
), c AS (
    SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS budget, b.after, b.w
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source AND d.h = b.h
)
SELECT doc_id, size, source_size, target, source,
       (size * CASE WHEN size = 0 THEN 0
            WHEN after < budget THEN whole + 1
            WHEN after - w < budget AND after - budget <= budget - (after - w) THEN whole + 1
            ELSE whole END)::BIGINT AS taken
FROM c
"""

# bytes as hexadecimal digits: two characters a byte, 100 a window
OP9 = """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents
), n AS (
    SELECT *, length(hx) // 2 AS n_bytes FROM d
), w AS (
    SELECT doc_id, unnest(range(n_bytes - 49)) AS i, hx FROM n WHERE n_bytes >= 50
), s AS (
    SELECT doc_id, i, substr(hx, 2 * i + 1, 100) AS s FROM w
), f AS (
    SELECT s, min(doc_id) AS first FROM s GROUP BY s
), c AS (
    SELECT s.doc_id, i, lag(i) OVER (PARTITION BY s.doc_id ORDER BY i) AS before FROM s JOIN f USING (s) WHERE first < s.doc_id
), g AS (
    SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM c
), r AS (
    SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, run
), q AS (
    SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY run), 0) AS from_b FROM r
), k AS (
    SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last_b,
           string_agg(substr(hx, 2 * from_b + 1, 2 * (a - from_b)), '' ORDER BY run) AS head
    FROM q JOIN n USING (doc_id) GROUP BY doc_id
)
SELECT n.doc_id, n_bytes::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(hx, 2 * coalesce(last_b, 0) + 1))) AS kept_sha256
FROM n LEFT JOIN k USING (doc_id)
"""

HASH = "('0x' || substr(md5({}), 1, 8))::BIGINT"
AT_HASH = HASH.format("'at:' || k || ':' || pattern")

# a list derived from the pages: see url_filter.dated_list
OP1 = rf"""
WITH p AS (
    SELECT page_id, url, 1704067200 + {HASH.format("'fetch:' || coalesce(page_id::VARCHAR, '')")} % 63072000 AS fetched_at,
           regexp_replace(regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\\.$', '') AS host,
           list_filter(string_split(regexp_extract(coalesce(url, ''), '^[^/?#]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS seg
    FROM pages
), hosts AS (
    SELECT DISTINCT host AS pattern FROM p WHERE host <> ''
), domains AS (
    SELECT DISTINCT array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS pattern FROM p WHERE len(string_split(host, '.')) > 2
), paths AS (
    SELECT DISTINCT host || '/' || array_to_string(seg, '/') AS pattern FROM p
    WHERE host <> '' AND len(seg) > 0 AND {HASH.format("'path:' || coalesce(url, '')")} % 8 = 0
), picked AS (
    SELECT pattern, 5 AS n FROM hosts WHERE {HASH.format("'host:' || pattern")} % 3 = 0
    UNION ALL SELECT pattern, 3 FROM domains WHERE {HASH.format("'domain:' || pattern")} % 2 = 0
    UNION ALL SELECT pattern, 2 FROM paths
), entries AS (
    SELECT pattern, 1704067200 + {AT_HASH} % 63072000 AS since, k::VARCHAR AS entry_id, ['block', 'lift', 'allow', 'block', 'lift'][k + 1] AS action
    FROM picked, range(5) r(k) WHERE k < n
    UNION ALL SELECT pattern, 1704067200, 'bad', 'block' FROM hosts WHERE regexp_matches(pattern, 'casino|pills|bets')
), once AS (
    SELECT pattern, since, action FROM entries QUALIFY row_number() OVER (PARTITION BY pattern, since ORDER BY entry_id DESC, action DESC) = 1
), spans AS (
    SELECT pattern, action, since AS valid_from, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS valid_to FROM once
), caps AS (
    SELECT *, row_number() OVER () AS cap FROM p
), keys AS (
    SELECT cap, fetched_at, unnest(list_distinct(list_concat(
        list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(list_slice(string_split(host, '.'), -i, -1), '.')),
        list_transform(range(1, len(seg) + 1), lambda i: host || '/' || array_to_string(list_slice(seg, 1, i), '/'))))) AS pattern
    FROM caps WHERE host <> ''
), best AS (
    SELECT cap, pattern, action, valid_from, valid_to FROM keys JOIN spans USING (pattern)
    WHERE action <> 'lift' AND fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)
    QUALIFY row_number() OVER (PARTITION BY cap ORDER BY length(pattern) DESC) = 1
)
SELECT page_id, host, fetched_at, coalesce(action = 'block', false) AS blocked, pattern, action,
       coalesce(valid_from, -1) AS valid_from, coalesce(valid_to, -1) AS valid_to
FROM caps LEFT JOIN best USING (cap)
"""

# crc32 of a string, byte by byte over the table of its polynomial
CRC_TABLE = """crc AS (
    SELECT list(v ORDER BY i) AS tab FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
        FROM range(256) r(i)
    )
)"""


def crc32(s: str) -> str:
    """SQL of the unsigned crc32 of ``s``, where ``tab`` of ``CRC_TABLE`` is in scope."""
    code = f"hex(encode({s}))"
    at = f"list_transform(range(1, length({code}), 2), lambda i: ('0x' || substr({code}, i, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {at}), lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1])), 4294967295::BIGINT)"


OP12 = f"""
WITH {CRC_TABLE}, t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
    SELECT conv_id, list({{'d': sha256(length(role) || ':' || role || text), 'b': strlen(text)}}
                         ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS own FROM t GROUP BY conv_id
), h AS (
    SELECT conv_id, own, {crc32("conv_id::VARCHAR")} % 9 AS starts FROM o, crc
), r AS (
    SELECT h.conv_id, list_concat(list_slice(coalesce(b.own, []), 1, starts), list_slice(h.own, starts + 1, len(h.own))) AS turns
    FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 5
), p AS (
    SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r
), q AS (
    SELECT conv_id, depth, depth = len(turns) AS ends, CASE WHEN depth = 0 THEN 0 ELSE turns[depth].b END AS b,
           array_to_string(list_transform(list_slice(turns, 1, depth), lambda x: x.d), '') AS id,
           CASE WHEN depth > 0 THEN array_to_string(list_transform(list_slice(turns, 1, depth - 1), lambda x: x.d), '') END AS parent FROM p
), n AS (
    SELECT id, parent, depth, b, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends) AS ends
    FROM q GROUP BY id, parent, depth, b
), c AS (
    SELECT parent AS id, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent
), below AS (
    -- every node and what stands below it
    SELECT u.id, sum((v.n_convs - 1) * v.b) AS saved, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves
    FROM n u JOIN n v ON v.depth >= u.depth AND substr(v.id, 1, 64 * u.depth::INT) = u.id LEFT JOIN c ON c.id = v.id GROUP BY u.id
)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, n_leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256, c.n_children IS NULL AS is_leaf
FROM n JOIN below USING (id) LEFT JOIN c ON c.id = n.id LEFT JOIN n m ON m.id = n.parent
"""

_RUN = "[A-Za-z\u00C0-\u00FF]"
OP13 = f"""
WITH RECURSIVE {CRC_TABLE}, r AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, n FROM (
        SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{_RUN}+')) AS run FROM documents)
        WHERE length(run) >= 7 GROUP BY doc_id, run)
), k AS (
    SELECT run, n, {crc32("doc_id || ':' || run")} AS h FROM r, crc
), w AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM k)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), d AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)
), e AS (
    SELECT x.word, y.word AS near FROM d x JOIN d y ON x.i = y.i AND x.less = y.less AND x.word <> y.word
    UNION SELECT d.word, w.word FROM d JOIN w ON d.less = w.word
    UNION SELECT w.word, d.word FROM d JOIN w ON d.less = w.word
), f AS (
    SELECT e.word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n FROM e JOIN w ON w.word = e.near GROUP BY e.word
), g AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
    FROM w LEFT JOIN f USING (word)
), s AS (
    SELECT word, word AS at FROM g UNION ALL SELECT s.word, g.form FROM s JOIN g ON g.word = s.at WHERE g.form IS NOT NULL
), z AS (
    SELECT s.word, s.at AS root FROM s JOIN g ON g.word = s.at WHERE g.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM g JOIN z USING (word)
"""

ORACLE_SQL = {"op1_url_filter": OP1, "op3_radix_dedup": OP3, "op5_mixing": OP5, "op9_suffix_dedup": OP9, "op12_prefix_trie": OP12, "op13_spelling": OP13}
