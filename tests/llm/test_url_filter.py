import random

import corpus
import parity
import pytest
from pyspark.sql import functions as F

from haulmetric.llm import url_filter
from haulmetric.llm.url_filter import Rule

SCHEMA = "page_id long, url string, html string, key string, id long, rule string, verdict string, links int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "r", "v", 2) for r in rows], SCHEMA)


def canonical(target):
    return f'<html><head><link rel="canonical" href="{target}"></head><body>text</body>'


def refresh(target):
    return f"<META content='0; URL={target}' http-equiv=refresh><p>moved"


def verdicts(frame):
    return {r.id: (r.verdict, r.decided_by) for r in frame.collect()}


def test_rules_fit_hosts_subdomains_and_longest_paths(spark):
    urls = {
        "https://example.org/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
        "http://a.b.EXAMPLE.org/en/12?x#y": ("a.b.example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://example.org": ("example.org", "", None, "allow"),
        "x://y.com/de/": ("y.com", "/de/", "com/de/", "block"),
        "http://y.com/de": ("y.com", "/de", None, "block"),
        "http://y.com?/de/": ("y.com", "", None, "allow"),
        "http://a.com/fr/x://b.com/de/": ("a.com", "/fr/x://b.com/de/", "com/fr/", "allow"),
        "": ("", "", None, "allow"),
        "no scheme.org/es/": ("", "", None, "allow"),
        "http:///de/": ("", "/de/", None, "allow"),
    }
    found = url_filter.judged(pages(spark, [(k, u, None) for k, u in enumerate(urls)]))
    got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    # http://y.com/de and x://y.com/de/ are two spellings of one address.
    assert got == dict(enumerate(urls.values()))


def test_blocks_reach_aliases_and_allows_take_precedence(spark):
    rows = [
        (1, "http://a.net/1", canonical("http://b.com/de/1")),  # its target is blocked, and no page
        (2, "http://a.net/2", refresh("/1")),  # through page 1
        (3, "http://c.net/x/y", canonical("z")),
        (4, "https://www.c.net:443/x/z/index.html?utm_source=q#top", refresh("//d.com/de/&amp;")),
        (5, "http://e.net/", canonical("http://f.com/de/")),
        (6, "http://f.com/de/", None),
        (7, "http://e.net", canonical("https://g.com/fr/")),  # one component with 5 and 6: allowed
        (8, "http://h.com/fr/1", canonical("http://b.com/de/1")),  # has a rule; frees 1 and 2
        (9, "http://i.net/", canonical("#here") + refresh("mailto:x@y.com") + canonical("http://b.com/de/1")),
        (10, "http://a.net/2?b=1&a=2", None),
        (11, "http://i.net/q?ref=1&b=1&a=2", canonical("http://k.com/de/1")),
        (12, "http://i.net/q/?a=2&b=1", None),
    ]
    got = verdicts(url_filter.judged(pages(spark, rows)))
    assert got == {
        1: ("allow", "alias"), 2: ("allow", "alias"), 3: ("block", "alias"), 4: ("block", "alias"),
        5: ("allow", "alias"), 6: ("block", "rule"), 7: ("allow", "alias"), 8: ("allow", "rule"),
        9: ("allow", "default"), 10: ("allow", "default"), 11: ("block", "alias"), 12: ("block", "alias"),
    }
    without = [r for r in rows if r[0] != 8]
    assert verdicts(url_filter.judged(pages(spark, without)))[2] == ("block", "alias")


def test_redirect_table_adds_edges(spark):
    rows = [(k, f"http://n{k}.net/", None) for k in range(5)]
    redirects = spark.createDataFrame(
        [(f"http://n{k}.net", f"http://n{k + 1}.net/") for k in range(3)]
        + [("http://x.com/de/", "http://n0.net"), (None, "http://n4.net"), ("http://n4.net", None)],
        "source string, target string",
    )
    got = verdicts(url_filter.judged(pages(spark, rows), redirects=redirects))
    assert got == {k: ("block", "alias") for k in range(4)} | {4: ("allow", "default")}


def test_other_rules_and_ties(spark):
    rules = (Rule("block", "a.net/x"), Rule("allow", "net/x/yyy"), Rule("block", "net/"), Rule("block", "a.net/q"), Rule("allow", "b.net/q"))
    rows = [(1, "http://a.net/x/yyy", None), (2, "http://b.net/q", None), (3, "http://c.net/", None)]
    found = {r.id: r.rule for r in url_filter.judged(pages(spark, rows), rules).collect()}
    assert found == {1: "net/x/yyy", 2: "b.net/q", 3: "net/"}
    equal = (Rule("block", "a.net/"), Rule("allow", "a.net/"))
    assert verdicts(url_filter.judged(pages(spark, rows[:1]), equal)) == {1: ("allow", "rule")}


def test_odd_rows(spark):
    long = "http://a.net/" + "x" * 200_000
    rows = [(1, None, None), (None, None, ""), (2, "http://a.com/de/", "<link " * 50_000), (2, "http://a.com/de/", "<link " * 50_000),
            (None, "http://a.net/", canonical("http://a.com/de/")), (3, long, canonical("")), (4, "http://a.net/ü?ü=1", refresh("ü"))]
    found = url_filter.judged(pages(spark, rows).repartition(3))
    assert found.columns == ["id", "host", "path", "rule", "verdict", "decided_by"]
    got = sorted((r.id or 0, r.verdict, r.decided_by) for r in found.collect())
    assert got == [(0, "allow", "default"), (0, "block", "alias"), (1, "allow", "default"),
                   (2, "block", "rule"), (2, "block", "rule"), (3, "allow", "default"), (4, "allow", "default")]
    assert url_filter.judged(pages(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs_match_duckdb(spark, tmp_path, seed):
    """Chains, cycles and stars; a third of all pages share one address."""
    rng = random.Random(seed)

    def url():
        if rng.random() < 0.3:
            return "http://hot.net/de/"
        host = rng.choice(["a.net", "www.a.net", "b.net", "c.com", "d.example.org"])
        return f"http{rng.choice(['', 's'])}://{host}/{rng.choice(['de', 'es', 'en', 'x'])}/{rng.randrange(40)}{rng.choice(['', '/', '?ref=1', '?b=1&a=2', '#x'])}"

    rows = []
    for k in range(400):
        draw = rng.random()
        html = canonical(url()) if draw < 0.2 else refresh(url()) if draw < 0.3 else refresh(str(k)) if draw < 0.35 else rng.choice([None, "", "<p>"])
        rows.append((k, url(), html))
    path = corpus.stored(pages(spark, rows).select("page_id", "url", "html"), tmp_path, "pages")
    found = url_filter.op12_url_filter(spark, path)
    assert found.filter(F.col("decided_by") == "alias").count() > 20
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}/pages.parquet/*.parquet')")
    assert parity.differences(found, connection, url_filter.oracle_sql()) == []


def test_the_main_path_is_native(spark, sf_dir):
    plan = url_filter.op12_url_filter(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
