"""Allow and block decisions on page urls, carried along redirects and canonical links.

Everything is built-in column functions and joins. A url's key is its spelling
without what does not change the page: scheme, ``www.``, fragment, tracking
parameters and a slash at the end. Pages of one key are aliases, and so are urls
joined by canonical links or redirects found in the pages. A page that no rule
fits is blocked if any url of its group is blocked by a rule; a page that a rule
allows stays allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.components import components
from ledgermill.sources.paths import stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Query parameters that only track where a visitor came from.
TRACKING = r"(?i)(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"
LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?is)\bcontent\s*=\s*[\"']?[^\"'>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"


@dataclass(frozen=True)
class Rule:
    """``verdict`` is allow or block, for a host with its subdomains and paths that start with ``path``."""

    verdict: str
    host: str
    path: str


def url_host(url: Column) -> Column:
    """Host in small letters; empty for NULL or a url without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), CAPITALS, SMALL), F.lit(""))


def url_path(url: Column) -> Column:
    """Path up to the query or fragment; empty for NULL or a url without ``://``."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits as a struct of size, name and verdict; NULL if none does.

    The rules are a list the caller holds in memory and go into the plan as
    literals. Of equally long ones the greater name wins, and allow before block.
    """
    if not rules:
        return F.lit(None).cast("struct<size:int,name:string,first:int,verdict:string>")
    known = F.array(
        *(
            F.struct(
                F.lit(len(r.host + r.path)).alias("size"),
                F.lit(r.host + r.path).alias("name"),
                F.lit(int(r.verdict == "allow")).alias("first"),
                F.lit(r.verdict).alias("verdict"),
                F.lit(r.host).alias("host"),
                F.lit(r.path).alias("path"),
            )
            for r in rules
        )
    )

    def fits(rule: Column) -> Column:
        return ((host == rule["host"]) | host.endswith(F.concat(F.lit("."), rule["host"]))) & path.startswith(rule["path"])

    return F.array_max(F.filter(known, fits))


def url_key(url: Column) -> Column:
    """The spelling of a url by which aliases are known; NULL if it has no host."""
    host = F.regexp_replace(url_host(url), r"^www\.", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&", "")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def resolved(link: Column, url: Column) -> Column:
    """A link as a whole url, as seen from the page; NULL for an empty one."""
    site = F.concat(F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.lit("://"), url_host(url))
    folder = F.regexp_extract(url_path(url), r"(?s)^(.*/)", 1)
    return (
        F.when(link == "", None)
        .when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def alias_links(pages: DataFrame) -> DataFrame:
    """Canonical links and redirects of pages with ``url`` and ``html``: url, target."""
    canonical = F.regexp_extract(F.regexp_extract("html", LINK, 0), HREF, 1)
    redirect = F.regexp_extract(F.regexp_extract("html", REFRESH, 0), REFRESH_URL, 1)
    targets = F.array_compact(F.array(resolved(canonical, F.col("url")), resolved(redirect, F.col("url"))))
    return pages.select("url", F.explode(targets).alias("target"))


def judge_pages(
    pages: DataFrame,
    rules: list[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """``id_column``, host, path, rule, verdict of each page.

    A NULL url, or one without ``://``, has an empty host and path, fits no rule
    and is allowed. A NULL html has no links. Repeated rows keep a result each.
    """
    source = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = (
        source.select("id", "url", url_key(F.col("url")).alias("key"))
        .withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
        .withColumn("found", rule)
        .select("id", "key", "host", "path", F.col("found.name").alias("rule"), F.col("found.verdict").alias("said"))
    )
    links = stored(
        alias_links(source).select(url_key(F.col("url")).alias("a"), url_key(F.col("target")).alias("b"), "target").distinct(), "alias-links"
    )
    groups = stored(components(links), "aliases")
    # Urls that only links name can be blocked too.
    target_rule = fitting_rule(url_host(F.col("target")), url_path(F.col("target")), rules)
    named = links.select(F.col("b").alias("key"), target_rule.alias("found"))
    blocked = (
        judged.where(F.col("said") == "block")
        .select("key")
        .union(named.where(F.col("found.verdict") == "block").select("key"))
        .distinct()
    )

    def group(df: DataFrame) -> DataFrame:
        joined = df.join(groups.select(F.col("node").alias("key"), "component"), "key", "left")
        return joined.withColumn("group", F.coalesce("component", "key")).drop("component")

    bad = group(blocked).select("group").distinct().withColumn("bad", F.lit(True))
    verdict = F.coalesce("said", F.when(F.col("bad"), "block").otherwise("allow"))
    return (
        group(judged)
        .join(bad, "group", "left")
        .select(F.col("id").alias(id_column), "host", "path", "rule", verdict.alias("verdict"))
    )
