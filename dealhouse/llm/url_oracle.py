"""The URL verdicts stated anew in DuckDB SQL, form by form, for comparison with the operator.

URLs are taken apart by one pattern, tags are searched attribute by attribute, dot segments are
folded over a list, and aliases are reached by a recursive query.
"""

ORACLE = r"""
WITH RECURSIVE
rules(verdict, host, path) AS (VALUES RULE_VALUES),
page AS (SELECT row_number() OVER () AS rid, * FROM pages),
cut AS (
  SELECT rid, page_id, html, contains(coalesce(url, ''), '://') AS has,
    regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(?:[?]([^#]*))?', ['h', 'p', 'q']) AS u FROM page),
own AS (
  SELECT rid, page_id, html, has, CASE WHEN has THEN coalesce(u.p, '') ELSE '' END AS path,
    CASE WHEN has THEN coalesce(u.q, '') ELSE '' END AS query,
    CASE WHEN has THEN array_to_string(list_transform(string_split(u.h, ''),
      lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN lower(c) ELSE c END), '') ELSE '' END AS host FROM cut),
tags AS (
  SELECT rid, host, path, unnest([
    {'kind': 'href', 'tag': list_filter(regexp_extract_all(html, '(?is)<link[\s"''/][^>]*>?'),
      lambda t: regexp_matches(t, '(?is)[\s"''/]rel\s*=\s*["'']?canonical["''\s>/]'))[1]},
    {'kind': 'url', 'tag': list_filter(regexp_extract_all(html, '(?is)<meta[\s"''/][^>]*>?'),
      lambda t: regexp_matches(t, '(?is)[\s"''/]http-equiv\s*=\s*["'']?refresh["''\s>/]'))[1]}]) AS t
  FROM own WHERE has),
named AS (
  SELECT rid, host, path, CASE t.kind
    WHEN 'href' THEN regexp_extract(t.tag, '(?is)[\s"''/]href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1)
    ELSE regexp_extract(t.tag, '(?is)url\s*=\s*["'']?([^"''\s>]+)', 1) END AS v FROM tags),
refs AS (
  SELECT rid, host, path, regexp_replace(replace(trim(
      CASE WHEN v[1] IN ('"', '''') THEN v[2:len(v) - 1] ELSE v END, E' \t\n\f\r'), '&amp;', '&'), '(?s)#.*', '') AS ref
  FROM named),
aimed AS (
  SELECT rid, CASE
    WHEN regexp_matches(ref, '(?i)^https?://') THEN substr(ref, strpos(ref, '://') + 3)
    WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(ref, '//') THEN substr(ref, 3)
    WHEN starts_with(ref, '/') THEN host || ref
    WHEN starts_with(ref, '?') THEN host || path || ref
    ELSE host || coalesce(nullif(regexp_extract(path, '(?s)^.*/'), ''), '/') || ref END AS target
  FROM refs WHERE ref <> ''),
parted AS (
  SELECT rid, string_split(regexp_extract(target, '^[^/?]*([^?]*)', 1), '/') AS segments,
    coalesce(regexp_extract(target, '(?s)^[^?]*([?].+)$', 1), '') AS query,
    array_to_string(list_transform(string_split(regexp_extract(target, '^[^/?]*'), ''),
      lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN lower(c) ELSE c END), '') AS host
  FROM aimed WHERE target IS NOT NULL),
folded AS (
  SELECT rid, host, query, segments, list_reduce(list_prepend([''], list_transform(segments[2:], lambda x: [x])),
    lambda done, x: CASE WHEN x[1] = '.' THEN done WHEN x[1] = '..' THEN done[:greatest(len(done) - 1, 1)]
      ELSE list_concat(done, x) END) AS kept FROM parted),
landed AS (
  SELECT rid, host || CASE WHEN len(segments) < 2 THEN '' WHEN len(kept) = 1 THEN '/'
    ELSE array_to_string(kept, '/') || CASE WHEN segments[-1] IN ('.', '..') AND kept[-1] <> '' THEN '/' ELSE '' END
    END || query AS b FROM folded),
spelt AS (
  SELECT rid, regexp_replace(host, '^www[.]', '') || rtrim(path, '/') || coalesce('?' || nullif(array_to_string(
    list_filter(string_split(query, '&'), lambda x: NOT regexp_matches(x, '^(utm_[a-z]*|ref|fbclid|gclid)=')), '&'), ''), '')
    AS b FROM own WHERE has),
node AS (SELECT rid, host || path || coalesce('?' || nullif(query, ''), '') AS a FROM own WHERE has),
link AS (SELECT DISTINCT a, b FROM node JOIN (SELECT * FROM spelt UNION ALL SELECT * FROM landed) USING (rid) WHERE a <> b),
step AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(x, y) AS (SELECT a, a FROM step UNION SELECT x, b FROM reach JOIN step ON y = a),
fits AS (
  SELECT k.x, r.verdict, r.host || r.path AS rule
  FROM (SELECT DISTINCT y AS x FROM reach UNION SELECT host || path FROM own) k
  JOIN rules r ON ('.' || regexp_extract(k.x, '^[^/?]*')) LIKE '%.' || r.host
    AND starts_with(regexp_extract(k.x, '^[^/?]*([^?]*)', 1), r.path)),
ruled AS (SELECT x, arg_max(verdict, length(rule)) AS verdict, arg_max(rule, length(rule)) AS rule FROM fits GROUP BY x),
guilty AS (
  SELECT reach.x FROM reach JOIN ruled ON ruled.x = reach.y GROUP BY reach.x
  HAVING count(*) FILTER (verdict = 'block') > 0 AND count(*) FILTER (verdict = 'allow') = 0)
SELECT page_id, own.host, own.path, ruled.rule,
  coalesce(ruled.verdict, CASE WHEN guilty.x IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM own LEFT JOIN ruled ON own.has AND ruled.x = own.host || own.path
LEFT JOIN node USING (rid) LEFT JOIN guilty ON guilty.x = node.a
"""


def oracle_sql(rules) -> str:
    """The rows of ``judge_urls`` over ``pages``, for rules of which no two equally long ones fit one address."""
    return ORACLE.replace("RULE_VALUES", ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules))
