"""SQL for the queries that SQL can express."""

OP3 = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)
"""

OP6 = r"""
WITH c AS (SELECT source, count(*) AS n, sqrt(count(*)) AS weight FROM documents GROUP BY source),
r AS (SELECT source, (SELECT sum(n) FROM c) * weight / (SELECT sum(weight) FROM c) / n AS rate FROM c),
d AS (SELECT *, greatest(ceil(rate / 16.0), 1)::INT AS draws FROM r),
s AS (
  SELECT source, draws, k - 1 AS k,
         sum(exp((k - 1) * ln(rate / draws) - rate / draws - lgamma(k))) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM d, range(1, 91) t(k)),
u AS (
  SELECT documents.*, x.draw, d.draws,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || x.draw), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents JOIN d ON documents.source IS NOT DISTINCT FROM d.source, range(1, draws + 1) x(draw)),
k AS (
  SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, u.draw, count(s.cdf) AS copies
  FROM u LEFT JOIN s ON s.source IS NOT DISTINCT FROM u.source AND s.cdf <= u.u GROUP BY ALL),
m AS (SELECT doc_id, text, lang, source, n_chars, sum(copies)::BIGINT AS copies FROM k GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, x.c::INT AS copy_no FROM m, range(1, copies + 1) x(c)
"""

OP12_ROUND = """
a{i} AS MATERIALIZED (
  SELECT vec_id, row_no, x, norm, arg_min(cid, (norm + cnorm - 2 * dot) * 16 + cid) AS cluster, min(norm + cnorm - 2 * dot) AS distance
  FROM (SELECT vec_id, row_no, x, norm, cid, cnorm, list_sum(list_transform(range(1, 65), lambda k: x[k] * c[k]))::BIGINT AS dot FROM v, c{i})
  GROUP BY vec_id, row_no, x, norm),"""

OP12_MEANS = """
m{i} AS (
  SELECT cluster, list(mean ORDER BY k) AS c FROM (
    SELECT cluster, k, floor(sum(x[k]) / count(*))::BIGINT AS mean FROM a{i}, range(1, 65) t(k) GROUP BY cluster, k) GROUP BY cluster),
c{j} AS MATERIALIZED (
  SELECT cid, c, list_sum(list_transform(c, lambda y: y * y))::BIGINT AS cnorm
  FROM (SELECT cid, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} ON cid = cluster)),"""

OP12 = (
    """
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row_no, x, list_sum(list_transform(x, lambda y: y * y))::BIGINT AS norm
  FROM (
    SELECT vec_id, list_transform(embedding, lambda y: floor(64 * y::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = 64)),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cid, x AS c, norm AS cnorm
  FROM v ORDER BY sha256('1:' || vec_id) LIMIT 16),"""
    + "".join(OP12_ROUND.format(i=i) + OP12_MEANS.format(i=i, j=i + 1) for i in range(3))
    + OP12_ROUND.format(i=3)
    + """
t AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM a3 GROUP BY cluster)
SELECT vec_id, cluster::INT AS cluster, distance, cluster_inertia, (SELECT sum(distance)::BIGINT FROM a3) AS inertia,
       sha256(list_aggregate(c, 'string_agg', ',')) AS centroid_sha256
FROM a3 JOIN t USING (cluster) JOIN c3 ON cid = cluster
"""
)

OP13 = r"""
WITH RECURSIVE rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
seen AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest,
         CASE WHEN regexp_matches(html, '(?i)canonical|refresh') THEN regexp_extract_all(
           regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'), '(?i)<(?:link|meta)\b[^>]*>')
         ELSE [] END AS tags
  FROM pages),
parts AS (
  SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM seen),
tagged AS (SELECT page_id, rest, host, path, unnest(tags) AS tag FROM parts),
written AS (
  SELECT page_id, rest, host, path, trim(replace(CASE
    WHEN regexp_matches(tag, '(?i)\brel\s*=\s*("[^"]*\bcanonical\b[^"]*"|''[^'']*\bcanonical\b[^'']*''|canonical[\s/>])')
    THEN regexp_extract(tag, '(?i)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1)
      || regexp_extract(tag, '(?i)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2)
      || regexp_extract(tag, '(?i)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3)
    WHEN regexp_matches(tag, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')
    THEN regexp_extract(
      regexp_extract(tag, '(?i)\bcontent\s*=\s*(?:"([^"]*)"|''([^'']*)'')', 1) || regexp_extract(tag, '(?i)\bcontent\s*=\s*(?:"([^"]*)"|''([^'']*)'')', 2),
      '(?i)^[\s\d.]*[;,]?\s*url\s*=\s*["'']?([^"'']*)', 1)
    ELSE '' END, '&amp;', '&'), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS target
  FROM tagged),
whole AS (
  SELECT page_id, rest, CASE
    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
    WHEN starts_with(target, '//') THEN ':' || target
    WHEN host = '' OR target = '' OR starts_with(target, '#') OR regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(target, '/') THEN '://' || host || target
    WHEN starts_with(target, '?') THEN '://' || host || path || target
    ELSE '://' || host || coalesce(nullif(regexp_extract(path, '^(.*/)[^/]*$', 1), ''), '/') || target END AS target
  FROM written),
linked AS (SELECT page_id, rest, substr(target, position('://' IN target) + 3) AS target FROM whole WHERE target IS NOT NULL),
rests AS (SELECT rest FROM parts UNION SELECT target FROM linked),
cut AS (
  SELECT rest, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         array_to_string(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(?i:utm_[a-z_]+|gclid|fbclid|msclkid)(=|$)')), '&') AS query
  FROM rests),
forms AS (
  SELECT rest, host, path, CASE WHEN regexp_replace(host, ':(80|443)?$', '') <> '' THEN
    regexp_replace(host, ':(80|443)?$', '') || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS form
  FROM cut),
best AS (
  SELECT rest, verdict, rule_host || rule_path AS rule
  FROM forms JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY rest ORDER BY length(rule_host || rule_path) DESC, verdict, rule_host || rule_path) = 1),
nodes AS (SELECT page_id, parts.rest, coalesce(form, 'page ' || coalesce(page_id::VARCHAR, '')) AS node FROM parts JOIN forms USING (rest)),
links AS (
  SELECT DISTINCT coalesce(f.form, 'page ' || coalesce(l.page_id::VARCHAR, '')) AS a, g.form AS b
  FROM linked l JOIN forms f ON f.rest = l.rest JOIN forms g ON g.rest = l.target WHERE g.form IS NOT NULL),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, other) AS (SELECT a, b FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
votes AS (
  SELECT node, verdict FROM nodes JOIN best USING (rest)
  UNION SELECT form, verdict FROM linked JOIN forms ON target = forms.rest JOIN best ON best.rest = target WHERE form IS NOT NULL),
shared AS (
  SELECT node, min(verdict) AS verdict FROM (
    SELECT node, verdict FROM votes UNION ALL SELECT r.node, verdict FROM reach r JOIN votes ON votes.node = r.other) GROUP BY node)
SELECT parts.page_id, host, path, rule, coalesce(best.verdict, shared.verdict, 'allow') AS verdict,
       CASE WHEN rule IS NOT NULL THEN 'rule' WHEN shared.verdict IS NOT NULL THEN 'alias' ELSE 'default' END AS decided_by
FROM parts LEFT JOIN best USING (rest)
JOIN (SELECT DISTINCT rest, page_id, node FROM nodes) n ON n.rest = parts.rest AND n.page_id IS NOT DISTINCT FROM parts.page_id
LEFT JOIN shared USING (node)
"""

ORACLE = {
    "op3_exact_dedup": OP3,
    "op6_poisson_mix": OP6,
    "op12_centroid_clustering": OP12,
    "op13_url_filter": OP13,
}
