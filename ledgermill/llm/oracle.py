"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations


def _host(url: str) -> str:
    return (
        f"translate(coalesce(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), ''), "
        "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _key(url: str) -> str:
    kept = (
        f"regexp_replace(regexp_replace(regexp_extract({url}, '(?s)^[^?#]*\\?([^#]*)', 1), "
        "'(?i)(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&', '')"
    )
    return (
        f"CASE WHEN {_host(url)} <> '' THEN regexp_replace({_host(url)}, '^www\\.', '') || "
        f"regexp_replace({_path(url)}, '/+$', '') || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END END"
    )


URL_RULES = f"""
WITH RECURSIVE rules(said, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
source AS (SELECT *, row_number() OVER () AS n FROM pages),
found AS (
  SELECT url,
         regexp_extract(regexp_extract(html, '(?is)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*>'),
                        '(?is)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1) AS canonical,
         regexp_extract(regexp_extract(html, '(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*>'),
                        '(?is)\\bcontent\\s*=\\s*["'']?[^"''>]*?\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1) AS redirect
  FROM source),
linked AS (SELECT url, unnest([canonical, redirect]) AS link FROM found),
resolved AS (
  SELECT url, CASE
    WHEN link LIKE '%://%' THEN link
    WHEN link LIKE '//%' THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || link
    WHEN link LIKE '/%' THEN regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || {_host('url')} || link
    ELSE regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || {_host('url')}
         || coalesce(nullif(regexp_extract({_path('url')}, '(?s)^(.*/)', 1), ''), '/') || link END AS target
  FROM linked WHERE link <> ''),
links AS (SELECT {_key('url')} AS a, {_key('target')} AS b, target FROM resolved),
edges AS (SELECT a, b FROM links WHERE a IS NOT NULL AND b IS NOT NULL
          UNION SELECT b, a FROM links WHERE a IS NOT NULL AND b IS NOT NULL),
reach(node, seen) AS (
  SELECT a, a FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a),
judged AS (
  SELECT n, page_id, {_key('url')} AS key, {_host('url')} AS host, {_path('url')} AS path FROM source),
fitting AS (
  SELECT n, rule_host || rule_path AS rule, said,
         row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path DESC) AS place
  FROM judged JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
ruled AS (SELECT judged.*, rule, said FROM judged LEFT JOIN fitting ON judged.n = fitting.n AND place = 1),
target_rule AS (
  SELECT b AS key, said, row_number() OVER (PARTITION BY target ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM links JOIN rules ON ({_host('target')} = rule_host OR ends_with({_host('target')}, '.' || rule_host))
                       AND starts_with({_path('target')}, rule_path)),
blocked AS (SELECT key FROM ruled WHERE said = 'block'
            UNION SELECT key FROM target_rule WHERE place = 1 AND said = 'block'),
bad AS (SELECT key FROM blocked UNION SELECT node FROM reach WHERE seen IN (SELECT key FROM blocked WHERE key IS NOT NULL))
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN key IN (SELECT key FROM bad WHERE key IS NOT NULL) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled"""

ORACLE: dict[str, str] = {"op5_url_rules": URL_RULES}
