"""DuckDB SQL for the queries of this subpackage that SQL can express, each by another way than its operator's."""

from __future__ import annotations

#: Capitals that are lowered, characters that are tokens by themselves, and words: as in `decontaminate`.
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
_SMALL = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ"
_ALONE = r"[\x{E00}-\x{EFF}\x{1000}-\x{10BF}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}]"
_WORD = r"[0-9a-z\x{80}-\x{DFF}\x{F00}-\x{FFF}\x{10C0}-\x{177F}\x{1800}-\x{2E7F}\x{A000}-\x{F8FF}\x{FB00}-\x{10FFFF}]+"
_TOKENS = f"regexp_extract_all(translate(text, '{_CAPITALS}', '{_SMALL}'), '{_ALONE}|{_WORD}')"

#: Equal tokens of documents and items, laid side by side by shift, and windows over them; no seeds.
CONTAMINATED = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, @TOKENS@ AS t FROM documents WHERE text IS NOT NULL),
    i AS MATERIALIZED (SELECT row_number() OVER () AS iid, item_id, t, len(t) AS n, least(16, len(t)) AS w, ceil(0.8 * least(16, len(t)) - 1e-9) AS need, list_sum(list_transform(t, lambda x: strlen(x))) AS bytes
        FROM (SELECT DISTINCT item_id, text, @TOKENS@ AS t FROM benchmark WHERE text IS NOT NULL) WHERE len(t) > 0),
    a AS (SELECT rid, unnest(t) AS word, generate_subscripts(t, 1) - 1 AS at_doc FROM d),
    b AS (SELECT iid, unnest(t) AS word, generate_subscripts(t, 1) - 1 AS j FROM i),
    hit AS MATERIALIZED (SELECT rid, iid, at_doc - j AS shift, j FROM a JOIN b USING (word)),
    laid AS (SELECT rid, iid, shift, any_value(n) AS n, any_value(w) AS w, any_value(need) AS need FROM hit JOIN i USING (iid) GROUP BY rid, iid, shift HAVING count(*) >= any_value(need)),
    good AS (SELECT rid, iid, shift, p, any_value(w) AS w FROM (SELECT *, unnest(range(n - w + 1)) AS p FROM laid) JOIN hit USING (rid, iid, shift) WHERE j BETWEEN p AND p + w - 1 GROUP BY rid, iid, shift, p HAVING count(*) >= any_value(need)),
    covered AS (SELECT DISTINCT rid, iid, shift, p + o AS j FROM (SELECT *, unnest(range(w)) AS o FROM good)),
    found AS (SELECT d.doc_id, i.item_id, shift, count(*) AS overlap_tokens, count(hit.j) AS matched_tokens FROM covered JOIN d USING (rid) JOIN i USING (iid) LEFT JOIN hit USING (rid, iid, shift, j)
        WHERE shift + covered.j BETWEEN 0 AND len(d.t) - 1 AND (n >= 5 OR bytes >= 24 OR n = len(d.t)) GROUP BY rid, iid, d.doc_id, i.item_id, shift)
SELECT doc_id, item_id, matched_tokens, overlap_tokens, shift AS first_token
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY overlap_tokens DESC, matched_tokens DESC, shift DESC) AS place FROM found) WHERE place = 1""".replace("@TOKENS@", _TOKENS)

#: All 400-byte strings of all texts, counted.
REPEATS = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
    s AS MATERIALIZED (SELECT rid, k, md5(b[k : k + 399]) AS h FROM (SELECT rid, b, unnest(range(1, octet_length(b) - 398)) AS k FROM d WHERE octet_length(b) >= 400)),
    r AS (SELECT rid, k FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)),
    n AS (SELECT rid, k, CASE WHEN k <= lag(k) OVER (PARTITION BY rid ORDER BY k) + 400 THEN 0 ELSE 1 END AS fresh FROM r),
    g AS (SELECT rid, k, sum(fresh) OVER (PARTITION BY rid ORDER BY k) AS run FROM n),
    x AS MATERIALIZED (SELECT rid, run, min(k) AS a, max(k) + 399 AS z FROM g GROUP BY 1, 2),
    p AS (SELECT rid, a, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) + 1 AS keep_from, a - 1 AS keep_to FROM x
        UNION ALL SELECT d.rid, octet_length(b) + 1, coalesce(max(z), 0) + 1, octet_length(b) FROM d LEFT JOIN x ON d.rid = x.rid GROUP BY d.rid, octet_length(b)),
    kept AS (SELECT p.rid, sha256(unhex(string_agg(CASE WHEN keep_to >= keep_from THEN hex(b[keep_from : keep_to]) ELSE '' END, '' ORDER BY a))) AS kept_sha256 FROM p JOIN d ON d.rid = p.rid GROUP BY p.rid),
    gone AS (SELECT rid, CAST(sum(z - a + 1) AS BIGINT) AS n_removed, count(*) AS n_spans FROM x GROUP BY rid)
    SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
    FROM d JOIN kept ON kept.rid = d.rid LEFT JOIN gone ON gone.rid = d.rid"""

EXACT = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n"""
