"""SQL answers of the operators that SQL can express."""

# As of each fetch, the latest event of every (list, key) of a capture decides.
URL_LISTS = r"""
WITH seen AS (
    SELECT page_id, url, html, TIMESTAMP '2024-01-01 00:00:00' + to_hours(page_id) AS ts,
           nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '') AS host,
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
    FROM pages),
parts AS (
    SELECT *, list_filter(string_split(path, '/'), lambda p: p <> '') AS names, string_split(host, '.') AS labels,
           string_split(path, '/')[2] AS section FROM seen),
raw_log AS (
    SELECT 'junk' AS list, host AS key, CASE WHEN contains(html, '%%%') THEN 'add' ELSE 'remove' END AS action, ts FROM parts
    UNION ALL
    SELECT 'section', CASE WHEN coalesce(section, '') <> '' THEN host || '/' || section END,
           CASE WHEN contains(html, '%%%') THEN 'add' ELSE 'remove' END, ts FROM parts
    UNION ALL
    SELECT 'tracking', nullif(regexp_extract(host, '^[^.]+\.(.+)$', 1), ''),
           CASE WHEN contains(url, 'ref=') THEN 'add' ELSE 'remove' END, ts FROM parts),
log AS (SELECT list, key, ts, max(action) AS action FROM raw_log WHERE key IS NOT NULL GROUP BY ALL),
keys AS (
    SELECT DISTINCT page_id, ts, key FROM (
        SELECT page_id, ts, unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) AS key FROM parts
        UNION ALL
        SELECT page_id, ts, host || '/' || unnest(list_transform(range(1, len(names) + 1), lambda i: array_to_string(names[:i], '/'))) FROM parts
        WHERE host IS NOT NULL)),
latest AS (
    SELECT k.page_id, l.list, l.key, max(l.ts) AS since, arg_max(l.action, l.ts) AS action
    FROM keys k JOIN log l ON l.key = k.key AND l.ts <= k.ts GROUP BY ALL),
hits AS (
    SELECT page_id, count(*) AS n_active, min({'valid_from': since, 'list': list, 'key': key}) AS oldest
    FROM latest WHERE action = 'add' GROUP BY page_id)
SELECT s.page_id, s.host, h.page_id IS NULL AS allowed, coalesce(h.n_active, 0) AS n_active, h.oldest.list AS list,
       h.oldest.key AS listed_key, strftime(h.oldest.valid_from, '%Y-%m-%d %H:%M:%S') AS listed_since
FROM seen s LEFT JOIN hits h USING (page_id)
"""

# All scores of all anchors; positives and negatives by rank.
HARD_NEGATIVES = """
WITH rows AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, list_inner_product(a.v, r.v)::BIGINT AS score
    FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v) WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 3
"""

# Common shingles of all pairs that share one; components by reaching out from every document.
TOKEN_GROUPS = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])
                                        WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT a AS doc_id, b AS r FROM both_ways UNION SELECT reached.doc_id, b FROM reached JOIN both_ways ON a = r)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(min(r), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reached USING (doc_id) GROUP BY d.doc_id
"""

ORACLE: dict[str, str] = {
    "op2_temporal_url_lists": URL_LISTS, "op11_fagin_negatives": HARD_NEGATIVES, "op12_token_group_join": TOKEN_GROUPS}
