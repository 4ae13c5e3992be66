"""URL filters with redirect equivalence (operator 12). DataFrame functions only.

Allow and block rules name a host, with its subdomains, and a start of the path; the longest rule
that fits a URL decides. URLs that no rule fits take the decision of their aliases: pages are
joined by their redirects (a refresh in the page, or rows of a redirect table) and by their
canonical links, and connected components over these edges carry block decisions to every member.
An explicit allow takes precedence: a component with a member that a rule allows stays allowed,
and no propagated block touches a page with a rule of its own. Without a decision a page is allowed.

The nodes of the graph are canonical URLs, so that two spellings of one address are one node:
without scheme, fragment, default port, leading `www.`, index file, closing slash and tracking
parameters, and with the other parameters in order. Link targets are nodes, too, whether or not
they are among the pages; a rule that fits a target counts as a decision in its component.

Pages are read once. Only (key, decision) and edges are shuffled, decisions combined map-side, and
components found by alternating stars; a hot address is one key on the decisions' side of the join,
so adaptive execution can split its pages.

Defined results: a null URL, or one without `://`, has empty host and path and is nobody's alias,
nor is a URL without a host; a null page has no links; repeated rows are judged alike, each on its
own row; null ids stay; an empty table gives an empty result; of several canonical links or
refreshes in a page the first counts; other columns of the input may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetric.llm.common import quoted, read, saved
from haulmetric.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """`place` is a host and the start of a path, as in `example.org/en/1`."""

    verdict: str
    place: str

    @property
    def host(self) -> str:
        return self.place.partition("/")[0]

    @property
    def path(self) -> str:
        return self.place[len(self.host) :]


RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)

#: Host, path and query of a URL, and what a query's tracking parameters look like.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|\z)"
INDEX = r"/(index\.(html?|php))?\z"
PORT = r":(80|443)\z"
LAST_STEP = r"[^/]*\z"
OTHER_SCHEME = r"(?i)^([a-z][a-z0-9+.-]*:|#|\z)"
#: Tags that name another address for a page. A tag ends at the next angle bracket, so that
#: unclosed ones cost no more than their length.
CANONICAL = r"""(?i)<link[\x20\x09-\x0D][^<>]*\brel[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?canonical\b[^<>]*>"""
REFRESH = r"""(?i)<meta[\x20\x09-\x0D][^<>]*\bhttp-equiv[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?refresh\b[^<>]*>"""
HREF = r"""(?i)[\x20\x09-\x0D]href[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?([^"'<>\x20\x09-\x0D]+)"""
REFRESH_URL = r"""(?i)\burl[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?([^"'<>\x20\x09-\x0D]+)"""


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, group), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def ruling(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null; of equal ones an allow wins."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.place), r.verdict == "allow")):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        named = F.struct(F.lit(rule.place).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def canonical_key(url: Column) -> Column:
    """The address behind a URL's spellings; null where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), PORT, "")
    path = F.regexp_replace(path_of(url), INDEX, "")
    terms = F.filter(F.split(_part(url, 3), "&"), lambda t: (t != "") & ~t.rlike(TRACKING))
    query = F.array_join(F.array_sort(terms), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _absolute(link: Column, host: Column, path: Column) -> Column:
    """The link of a page as a URL; null for an empty one, a fragment, or another scheme."""
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    here = F.concat(F.lit("http://"), host)
    return (
        F.when(link.rlike("(?i)^https?://"), link)
        .when(link.rlike(OTHER_SCHEME), None)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(here, link))
        .when(host != "", F.concat(here, F.coalesce(F.nullif(F.regexp_replace(path, LAST_STEP, ""), F.lit("")), F.lit("/")), link))
    )


def links(html: Column, host: Column, path: Column) -> Column:
    """URLs that a page names as its own address: canonical link and refresh."""
    tag = lambda pattern, inner: F.regexp_extract(F.regexp_extract(html, pattern, 0), inner, 1)
    canonical = F.when(html.rlike("(?i)canonical"), tag(CANONICAL, HREF))
    refresh = F.when(html.rlike("(?i)http-equiv"), tag(REFRESH, REFRESH_URL))
    return F.array_compact(F.array(*(_absolute(found, host, path) for found in (canonical, refresh))))


def judged(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    redirects: DataFrame | None = None,
    id_: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Rows (id, host, path, rule, verdict, decided_by); decided_by is rule, alias or default.

    `redirects` may add edges as rows (source, target) of URLs.
    """
    address = quoted(url).cast("string")
    nodes = pages.select(
        quoted(id_).alias("id"), host_of(address).alias("host"), path_of(address).alias("path"),
        canonical_key(address).alias("key"), quoted(html).cast("string").alias("html"),
    )
    host, path = F.col("host"), F.col("path")
    nodes = saved(
        nodes.select(
            "id", "host", "path", "key",
            ruling(host, path, rules).alias("ruling"), links(F.col("html"), host, path).alias("links"),
        ),
        "nodes",
    )
    ends = nodes.filter("key IS NOT NULL").select("key", F.explode("links").alias("target"))
    if redirects is not None:
        sources = redirects.select(
            canonical_key(F.col("source")).alias("key"), F.col("target"),
            ruling(host_of(F.col("source")), path_of(F.col("source")), rules).alias("own"),
        )
        ends = ends.unionByName(sources.select("key", "target"))
    target = F.col("target")
    ends = ends.select(
        "key", canonical_key(target).alias("other"),
        ruling(host_of(target), path_of(target), rules).alias("ruling"),
    ).filter("key IS NOT NULL AND other IS NOT NULL")
    decided = [nodes.filter("key IS NOT NULL").select("key", "ruling"), ends.select(F.col("other").alias("key"), "ruling")]
    if redirects is not None:
        decided.append(sources.select("key", F.col("own").alias("ruling")).filter("key IS NOT NULL"))
    verdicts = _class_verdicts(
        reduce(DataFrame.unionByName, decided).filter("ruling IS NOT NULL").select("key", "ruling.verdict"),
        ends.select(F.col("key").alias("a"), F.col("other").alias("b")).filter("a <> b").distinct(),
    )
    ruled = nodes.filter("ruling IS NOT NULL").select(
        "id", "host", "path", "ruling.rule", "ruling.verdict", F.lit("rule").alias("decided_by")
    )
    open_ = nodes.filter("ruling IS NULL").join(verdicts, "key", "left")
    return ruled.unionByName(
        open_.select(
            "id", "host", "path", F.lit(None).cast("string").alias("rule"),
            F.coalesce("verdict", F.lit("allow")).alias("verdict"),
            F.when(F.col("verdict").isNull(), "default").otherwise("alias").alias("decided_by"),
        )
    )


def _class_verdicts(decided: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (key, verdict) for every key whose component has a decision; one row a key."""
    members = components(edges, "aliases")
    votes = F.max("allowed").alias("allowed")
    # Twice, so that only one row a key meets the components.
    by_key = decided.groupBy("key").agg(F.max(F.col("verdict") == "allow").alias("allowed"))
    of_class = (
        by_key.join(members.select(F.col("node").alias("key"), "component"), "key", "left")
        .groupBy(F.coalesce("component", "key").alias("class"))
        .agg(votes)
    )
    return of_class.join(members, F.col("component") == F.col("class"), "left").select(
        F.coalesce("node", "class").alias("key"),
        F.when(F.col("allowed"), "allow").otherwise("block").alias("verdict"),
    )


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def oracle_sql() -> str:
    """DuckDB SQL of op12."""
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    rules = ", ".join(f"({quote(r.verdict)}, {quote(r.place)}, {quote(r.host)}, {quote(r.path)})" for r in RULES)

    def fitting(host: str, path: str) -> str:
        return f"""(SELECT max_by({{'rule': place, 'verdict': verdict}}, [length(place), CAST(verdict = 'allow' AS INT)])
   FROM (VALUES {rules}) r(verdict, place, rule_host, rule_path)
   WHERE ({host} = rule_host OR ends_with({host}, '.' || rule_host)) AND starts_with({path}, rule_path))"""

    def parts(url: str) -> str:
        found = [f"regexp_extract(coalesce({url}, ''), {quote(PARTS)}, {k})" for k in (1, 2, 3)]
        return f"translate({found[0]}, '{UPPER}', '{LOWER}') AS host, {found[1]} AS path, {found[2]} AS query"

    key = f"""CASE WHEN host <> '' THEN
    regexp_replace(regexp_replace(host, '^www\\.', ''), {quote(PORT)}, '')
    || regexp_replace(path, {quote(INDEX)}, '')
    || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(query, '&'),
         lambda t: t <> '' AND NOT regexp_matches(t, {quote(TRACKING)}))), '&'), ''), '') END"""
    tag = lambda pattern, inner: f"regexp_extract(regexp_extract(coalesce(html, ''), {quote(pattern)}), {quote(inner)}, 1)"
    return f"""
WITH RECURSIVE
cut AS (SELECT row_number() OVER () AS row, page_id, html, {parts("url")} FROM pages),
node AS (SELECT *, {key} AS key, {fitting("cut.host", "cut.path")} AS ruling FROM cut),
named AS (
  SELECT key, host, path, replace(unnest([{tag(CANONICAL, HREF)}, {tag(REFRESH, REFRESH_URL)}]), '&amp;', '&') AS link
  FROM node WHERE key IS NOT NULL),
linked AS (
  SELECT key AS source,
    CASE WHEN regexp_matches(link, '(?i)^https?://') THEN link
         WHEN regexp_matches(link, {quote(OTHER_SCHEME)}) THEN NULL
         WHEN starts_with(link, '//') THEN 'http:' || link
         WHEN starts_with(link, '/') THEN 'http://' || host || link
         ELSE 'http://' || host || coalesce(nullif(regexp_replace(path, {quote(LAST_STEP)}, ''), ''), '/') || link END AS target
  FROM named),
target AS (SELECT source, {parts("target")} FROM linked WHERE target IS NOT NULL),
ends AS (SELECT source, {key} AS key, {fitting("target.host", "target.path")} AS ruling FROM target),
edge AS (SELECT source AS a, key AS b FROM ends WHERE key IS NOT NULL
         UNION SELECT key, source FROM ends WHERE key IS NOT NULL),
walk(start, stop) AS (SELECT a, a FROM edge UNION SELECT start, b FROM walk JOIN edge ON a = stop),
member AS (SELECT start AS key, min(stop) AS class FROM walk GROUP BY start),
vote AS (SELECT key, ruling FROM node UNION ALL SELECT key, ruling FROM ends),
verdict AS (
  SELECT coalesce(class, key) AS class, max(CAST(ruling.verdict = 'allow' AS INT)) AS allowed
  FROM vote LEFT JOIN member USING (key) WHERE ruling IS NOT NULL AND key IS NOT NULL GROUP BY 1)
SELECT page_id, host, path, ruling.rule AS rule,
       CASE WHEN ruling IS NOT NULL THEN ruling.verdict WHEN allowed = 0 THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN ruling IS NOT NULL THEN 'rule' WHEN allowed IS NULL THEN 'default' ELSE 'alias' END AS decided_by
FROM node LEFT JOIN member USING (key) LEFT JOIN verdict ON verdict.class = coalesce(member.class, node.key)"""
