"""Hosts, paths and rules against a plain reading, aliases by hand, and the SQL."""

import re
from collections import Counter

import duckdb
import pandas as pd
import pytest

from ledgermill.llm.components import components
from ledgermill.llm.queries import URL_RULES
from ledgermill.llm.url_rules import Rule, judge_pages

SCHEMA = "page_id bigint, url string, html string, host string, verdict int"


def plain(url):
    """Host, path and rule as the contract states them."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best and best.verdict


URLS = [None, "", "nourl", "http://", "http://A.ORG/x", "https://sub.example.org/es/1?x#y", "ftp://example.org/en/12",
        "http://notexample.org/es/", "http://xorg/", "x://a://b.com/de/", "HTTP://Ä.com/FR/", "http://c.com/fr/\n?q",
        "http://example.com/de/#f", "http://example.com#/de/", "http://example.com?u=http://b.org/", "http://org"]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "h", 1) for i, u in enumerate(URLS)] + [(None, URLS[4], "", None, None)], SCHEMA)
    rows = judge_pages(pages, URL_RULES).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path, rule, verdict = plain(URLS[4 if r.page_id is None else r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert judge_pages(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in judge_pages(pages, []).collect()} == {"allow"}


def test_blocks_reach_aliases_and_allow_comes_first(spark):
    pages = [
        (1, "http://A.com/de/x", '<link rel=canonical href="/en/x">'),
        (2, "https://www.a.com/en/x/?utm_source=q#f", None),
        (3, "http://b.net/p", '<META HTTP-EQUIV="refresh" CONTENT="0; URL=http://a.com/en/x">'),
        (4, "http://c.org/1", '<link href="http://b.net/p" rel="canonical">'),
        (5, "http://d.net/q", '<link rel="canonical" href="//e.net/q"><p>'),
        (6, "http://f.net/a/b", '<link rel="canonical" href="c">'),
        (7, "http://f.net/a/c", '<meta http-equiv=refresh content="5;url=//h.com/de/z">'),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: r.verdict for r in judge_pages(frame, URL_RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "block"}


def test_longer_rule_wins(spark):
    rules = [Rule("block", "net", "/"), Rule("allow", "good.net", "/"), Rule("block", "good.net", "/bad")]
    urls = ["http://x.net/", "http://w.good.net/a", "http://good.net/bad/1"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id bigint, url string, html string")
    assert [r.verdict for r in judge_pages(pages, rules).orderBy("page_id").collect()] == ["block", "allow", "block"]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 5000), (7, None), (None, None), (3, 4)]
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in rows} == {x: top(x) for x in parent} and len(rows) == len(parent)
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_sql_agrees(spark, small_dir):
    """On the table, and on it with links, redirects and odd rows added."""
    from ledgermill.llm.oracle import ORACLE

    pages = spark.read.parquet(f"{small_dir}/pages.parquet").toPandas()
    odd = [(None, u, None) for u in URLS] + [(900 + i, f"http://h{i}.net/p", f'<link rel="canonical" href="http://h{i + 1}.net/p">') for i in range(5)]
    odd += [(950, "http://h5.net/p", '<meta http-equiv=refresh content="0; url=//k.com/de/1">'), (951, "http://m.org/x/y", "<link rel=canonical href=z>")]
    more = pd.concat([pages, pd.DataFrame(odd, columns=pages.columns)], ignore_index=True).astype({"page_id": "Int64"})
    for frame in (pages, more):
        with duckdb.connect() as duck:
            duck.register("pages", frame)
            expected = Counter(duck.execute(ORACLE["op5_url_rules"]).fetchall())
        rows = [(None if pd.isna(k) else int(k), *(None if pd.isna(v) else v for v in r)) for k, *r in frame.itertuples(index=False)]
        source = spark.createDataFrame(rows, "page_id bigint, url string, html string")
        got = Counter(tuple(r) for r in judge_pages(source, URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect())
        assert got == expected
    assert sum(n for row, n in got.items() if row[0] is not None and row[0] >= 900 and row[4] == "block") == 6


@pytest.mark.parametrize("name", ["op5_url_rules"])
def test_plan_has_no_python(spark, small_dir, name):
    from ledgermill.llm.queries import REGISTRY

    plan = REGISTRY[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
