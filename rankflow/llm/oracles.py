"""SQL for the queries of this subpackage that SQL can express, in DuckDB's dialect."""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
f AS (SELECT payload, min(page_id) AS first FROM p GROUP BY payload),
b AS (
    SELECT page_id, first, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS digest
    FROM p JOIN f USING (payload)
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
            (('0x' || substr(digest, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31
        )::INT, 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b
"""

OP9 = r"""
WITH p AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), r(verdict, rule, h, q) AS (VALUES
    ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
    ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
    ('block', 'com/de/', 'com', '/de/')
), hits AS (
    SELECT page_id, host, path, max_by(struct_pack(rule := rule, verdict := verdict), length(rule)) AS best
    FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
    GROUP BY ALL
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM hits
"""

OP11 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), g AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_words FROM d WHERE len(terms) > 0),
p AS (
    SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d) GROUP BY ALL
), f AS (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term),
q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), w AS (
    SELECT item_id, term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM q JOIN f USING (term), g
), s AS (
    SELECT item_id, r, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_words))))::BIGINT AS score
    FROM w JOIN p USING (term), g GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""

def _more(key: str, cost: int | str, letter: str) -> str:
    """A state of eight digits of cost and an audit, grown by one edit."""
    return f"lpad((left({key}, 8)::INT + {cost})::VARCHAR, 8, '0') || substr({key}, 9) || '{letter}'"

OP12 = rf"""
WITH RECURSIVE named AS (
    SELECT conv_id, coalesce('=' || conv_id, '') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
), marked AS (
    SELECT *, xor(list_reduce(
        flatten(list_transform(range(1, len(key) + 1), lambda i: [ord(key[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
        4294967295::BIGINT), 4294967295) % 20 AS mark
    FROM named
), hurt AS (
    SELECT conv, turn, CASE WHEN mark = 4 THEN 'user' ELSE role END AS role,
        CASE mark WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN mark = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM marked WHERE mark != 0
), hashed AS (
    SELECT *, sha256(sha256(role) || text) AS same, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
    FROM hurt
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, same, copy) AS i FROM hashed
), r AS (
    SELECT conv, i, turn, role, text, left(role, 1) AS head, CASE
        WHEN bare = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv, same) THEN 'duplicate'
        WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), dp AS (
    SELECT DISTINCT conv, 0::BIGINT AS i, '00000000' AS k0, NULL::VARCHAR AS k1, NULL::VARCHAR AS k2, NULL::VARCHAR AS k3 FROM r
    UNION ALL
    SELECT conv, i + 1, {_more('k0', 3, 'D')},
        least({_more('k1', 3, 'D')}, CASE WHEN open AND head = 's' THEN {_more('k0', 'late', 'K')} END),
        least({_more('p2', 3, 'D')},
            CASE WHEN open THEN least({_more('k0', '2 + late', 'R')}, {_more('k1', '2 + late', 'R')}, {_more('p3', '2 + late', 'R')}) END,
            CASE WHEN open AND head = 'u' THEN least({_more('k0', 'late', 'K')}, {_more('k1', 'late', 'K')}, {_more('p3', 'late', 'K')}) END),
        least({_more('p3', 3, 'D')}, CASE WHEN open THEN {_more('p2', '2 + late', 'R')} END,
            CASE WHEN open AND head = 'a' THEN {_more('p2', 'late', 'K')} END)
    FROM (
        SELECT *, least(k3, {_more('p2', 2, 'I')}) AS p3 FROM (
            SELECT dp.*, r.head, r.fault NOT IN ('blank', 'duplicate') AS open, (r.fault = 'truncated')::INT AS late,
                least(k2, {_more('k0', 2, 'I')}, {_more('k1', 2, 'I')}, {_more('k3', 2, 'I')}) AS p2
            FROM dp JOIN r ON r.conv = dp.conv AND r.i = dp.i + 1
        )
    )
), audits AS (
    SELECT conv, left(best, 8)::BIGINT AS cost, substr(best, 9) AS audit FROM (
        SELECT conv, least(k0, k3, {_more('k2', 2, 'I')}, {_more('k1', 4, 'II')}) AS best
        FROM dp JOIN (SELECT conv, max(i) AS i FROM r GROUP BY conv) USING (conv, i)
    )
), letters AS (
    SELECT conv, spot, audit[spot] AS letter FROM (SELECT conv, audit, unnest(range(1, len(audit) + 1)) AS spot FROM audits)
), edits AS (
    SELECT conv, spot, letter, count(*) FILTER (letter != 'I') OVER w AS i, count(*) FILTER (letter != 'D') OVER w AS out
    FROM letters WINDOW w AS (PARTITION BY conv ORDER BY spot)
), lines AS (
    SELECT e.conv, spot, e.letter, r.role, CASE WHEN e.letter = 'I' THEN '' ELSE r.text END AS text,
        out - max((e.out = 1 AND e.letter = 'K' AND r.head = 's')::INT) OVER (PARTITION BY e.conv) AS place
    FROM edits e LEFT JOIN r ON r.conv = e.conv AND r.i = e.i WHERE e.letter != 'D'
), repaired AS (
    SELECT conv, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || text, chr(10) ORDER BY spot)) AS digest
    FROM lines GROUP BY conv
), pairs AS (
    SELECT conv, lag(head) OVER (PARTITION BY conv ORDER BY i) || head AS pair FROM r
), illegal AS (
    SELECT conv, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv
), counts AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated
    FROM r GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
    coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
    coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM named) LEFT JOIN counts USING (conv) LEFT JOIN illegal USING (conv)
    LEFT JOIN audits USING (conv) LEFT JOIN repaired USING (conv)
"""

OP13 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id != c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

SQL = {"op6_warc": OP6, "op9_urls": OP9, "op11_lexical_search": OP11, "op12_repair": OP12, "op13_exact_products": OP13}
