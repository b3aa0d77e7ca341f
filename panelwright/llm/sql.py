"""DuckDB SQL for the queries that SQL can express."""

_HEX = "(strpos('0123456789abcdef', substr(h, CAST(5*i//4 AS INT)+{k}, 1))-1)"
_BASE32 = f"array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((({_HEX.format(k=1)}*16+{_HEX.format(k=2)}) >> CAST(3-(5*i)%4 AS INT)) & 31 AS INT)+1, 1)), '')"

OP3 = f"""WITH p AS (SELECT page_id, coalesce(html, '') body FROM pages), f AS (SELECT *, sha1(body) h, min(page_id) OVER (PARTITION BY body) first_id FROM p)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) payload_bytes, {_BASE32} payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END record_type, CASE WHEN page_id <> first_id THEN first_id END refers_to FROM f"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5 = f"""WITH d AS (SELECT doc_id, {_WORDS} w FROM documents), b AS (SELECT item_id, {_WORDS} w FROM benchmark),
bn AS (SELECT *, least(13, len(w)) n FROM b WHERE len(w) > 0),
bi AS (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) i FROM bn),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i+n-1], ' ') s FROM bi),
di AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) i FROM d, (SELECT DISTINCT n FROM bn) WHERE len(w) >= n),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') s FROM di),
h AS (SELECT doc_id, n, i, item_id FROM dw JOIN bw USING (n, s)),
c AS (SELECT doc_id, count(DISTINCT p) n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) n_items, string_agg(k, ',' ORDER BY k) ks FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) k FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit, CAST(coalesce(n_items, 0) AS BIGINT) n_items, sha256(coalesce(ks, '')) items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""
