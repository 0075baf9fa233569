"""URL filters that follow redirects, in built-in expressions only.

Rules (host, path, verdict) fit a host and its subdomains where the url's path
starts with the rule's; the longest that fits decides. A page that no rule fits
takes the decision of its aliases: pages and link targets that redirects
(``<meta http-equiv="refresh">``, or a table of known redirects) and canonical
links (``<link rel="canonical">``) connect, over any number of hops. In such a
group an explicit allow goes before a block; without either a page is allowed.
The page's own rule always goes before its aliases'.

How it runs: the scan reads url and html once and keeps host, path, a 128-bit
node of the url's normal form, and the links. Rules meet the distinct (host,
path) pairs by equality of host suffix and path prefix, cut at the lengths that
the rules have: a broadcast while the staged rules are small, else a shuffle, and
never a list of rules in one row. Links become components by the star joins of
``components``; a hub with a third of all links is one partial minimum there.
Groups are only ever counted (votes for allow and block), never gathered.

A url's normal form has no scheme, fragment, default port or tracking parameters,
and a path of at least ``/``; so ``http://a.com#x`` and ``https://a.com/?utm_source=b``
are one node. Paths are compared as written: dot segments and percent codes stay.

Defined cases: host and path of a null url or one without ``://`` are empty; no
rule fits it, and it is a node of its own, whose links to whole urls still count.
Null or empty html has no links. Links in comments and scripts, links to other
schemes (``mailto:``) or to fragments do not count. Rows that share a url or an id
are rows of their own and get the same answer; a page may declare several links. Of
rules of one length, allow goes first, then the lesser text. Rules with a null host
or path or an empty host fit nothing. Empty tables give no rows. Other columns are
not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.joins import lookup_join
from ticketloom.llm.common import narrow, ready
from ticketloom.llm.components import components
from ticketloom.session import stage

# fixed values: capitals and their small letters, white space, parameters that only track
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "\t\n\x0b\x0c\r "
TRACKING = r"^(?i:utm_[a-z_]+|gclid|fbclid|msclkid)(=|$)"
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
TAGS = r"(?i)<(?:link|meta)\b[^>]*>"
CANONICAL = r"""(?i)\brel\s*=\s*("[^"]*\bcanonical\b[^"]*"|'[^']*\bcanonical\b[^']*'|canonical[\s/>])"""
REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""
HREF = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
CONTENT = r"""(?i)\bcontent\s*=\s*(?:"([^"]*)"|'([^']*)')"""
TARGET = r"""(?i)^[\s\d.]*[;,]?\s*url\s*=\s*["']?([^"']*)"""


def lowered(text: Column) -> Column:
    """Small letters for A-Z only."""
    return F.translate(text, UPPER, LOWER)


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return lowered(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def normal_form(rest: Column) -> Column:
    """Host, path and query without default port, fragment and tracking parameters; null without a host."""
    host = F.regexp_replace(host_of(rest), r":(80|443)?$", "")
    path = path_of(rest)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    told = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    whole = F.concat(
        host, F.when(path == "", F.lit("/")).otherwise(path), F.when(told != "", F.concat(F.lit("?"), told)).otherwise(F.lit(""))
    )
    return F.when(host != "", whole)


def key_of(text: Column) -> Column:
    """128 bits of a SHA-256 digest."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def first_group(text: Column, pattern: str, groups: int) -> Column:
    """The first group that matched anything, or null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, pattern, g), F.lit("")) for g in range(1, groups + 1)])


def declared(html: Column) -> Column:
    """Targets, as written, of the canonical links and refreshes of a page."""
    seen = F.regexp_extract_all(F.regexp_replace(html, HIDDEN, " "), F.lit(TAGS), F.lit(0))

    def target(tag: Column) -> Column:
        refreshed = F.nullif(F.regexp_extract(first_group(tag, CONTENT, 2), TARGET, 1), F.lit(""))
        return F.when(tag.rlike(CANONICAL), first_group(tag, HREF, 3)).when(tag.rlike(REFRESH), refreshed)

    found = F.transform(seen, lambda tag: F.btrim(F.replace(target(tag), F.lit("&amp;"), F.lit("&")), F.lit(BLANKS)))
    none = F.array().cast("array<string>")
    return F.when(html.rlike("(?i)canonical|refresh"), F.filter(found, lambda t: t.isNotNull())).otherwise(none)


def resolved(target: Column, host: Column, path: Column) -> Column:
    """The target as ``://host/path`` seen from a page; null if it leads to no other url."""
    onto = F.concat(F.lit("://"), host)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*/)[^/]*$", 1), F.lit("")), F.lit("/"))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.lit(":"), target))
        .when((host == "") | (target == "") | target.startswith("#") | target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(target.startswith("/"), F.concat(onto, target))
        .when(target.startswith("?"), F.concat(onto, path, target))
        .otherwise(F.concat(onto, folder, target))
    )


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules as (rule_host, rule_path, rule, verdict), one for each (host, path)."""
    named = rules.select(lowered(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    usable = named.where("rule_host <> '' and rule_path is not null and verdict in ('allow', 'block')")
    merged = usable.groupBy("rule_host", "rule_path").agg(F.min("verdict").alias("verdict"))
    return merged.withColumn("rule", F.concat("rule_host", "rule_path"))


def matched(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(place, host, path) to (place, rule, verdict): the longest rule that fits, for places that one fits."""
    rules = stage(rule_table(rules), "url-rules")
    dots = F.length("rule_host") - F.length(F.translate("rule_host", ".", "")) + 1
    labels = rules.agg(F.max(dots)).first()[0]
    if labels is None:
        return places.select("place", F.lit("").alias("rule"), F.lit("").alias("verdict")).where("false")
    sizes = rules.select("rule_host", F.length("rule_path").alias("size")).distinct()
    own = F.length("host") - F.length(F.translate("host", ".", "")) + 1
    suffixes = places.where("host <> ''").withColumn("labels", F.explode(F.sequence(F.lit(1), F.least(F.lit(labels), own))))
    suffixes = suffixes.withColumn("rule_host", F.expr("substring_index(host, '.', -labels)"))
    cut = lookup_join(suffixes, sizes, "rule_host", "inner", "url-sizes", fixed_width=False)
    cut = cut.where(F.length("path") >= F.col("size")).withColumn("rule_path", F.expr("substring(path, 1, size)"))
    hits = lookup_join(cut.select("place", "rule_host", "rule_path"), rules, ["rule_host", "rule_path"], "inner", "url-rules", fixed_width=False)
    best = F.min(F.struct((-F.length("rule")).alias("size"), "verdict", "rule"))
    return hits.groupBy("place").agg(best.alias("best")).select("place", "best.rule", "best.verdict")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """One row for each page: id, host, path, rule, verdict, and ``decided_by`` (rule, alias or default).

    ``rules`` holds (host, path, verdict); ``redirects`` holds known redirects as
    (from_url, to_url), both whole urls.
    """
    ready(pages.sparkSession)
    seen = narrow(pages, id=id_col, rest=rest_of(F.col(url)), targets=declared(F.col(html)))
    seen = seen.withColumns({"host": host_of(F.col("rest")), "path": path_of(F.col("rest"))})
    alone = F.concat(F.lit("page "), F.coalesce(F.col("id").cast("string"), F.lit("")))
    listed = stage(
        seen.select(
            "id", "host", "path",
            key_of(F.concat_ws(" ", "host", "path")).alias("place"),
            key_of(F.coalesce(normal_form(F.col("rest")), alone)).alias("node"),
            F.filter(F.transform("targets", lambda t: rest_of(resolved(t, F.col("host"), F.col("path")))), lambda t: t != "").alias("rests"),
        ),
        "url-pages",
    )
    links = listed.select("node", F.explode("rests").alias("rest")).distinct()
    ends = [links.select("node", "rest")]
    if redirects is not None:
        known = redirects.select(rest_of(F.col("from_url")).alias("from"), rest_of(F.col("to_url")).alias("rest"))
        known = known.withColumn("node", key_of(normal_form(F.col("from")))).where("node is not null and rest <> ''")
        ends += [known.select("node", "rest"), known.select("node", F.col("from").alias("rest"))]
    for more in ends[1:]:
        links = links.unionByName(more)
    linked = stage(
        links.select(
            "node", key_of(normal_form(F.col("rest"))).alias("target"), host_of(F.col("rest")).alias("host"), path_of(F.col("rest")).alias("path")
        ).withColumn("place", key_of(F.concat_ws(" ", "host", "path"))).where("target is not null"),
        "url-links",
    )
    places = listed.select("place", "host", "path").unionByName(linked.select("place", "host", "path")).distinct()
    ruled = stage(matched(places, rules), "url-ruled")
    labels = components(linked.select(F.col("node").alias("a"), F.col("target").alias("b")))
    named = listed.join(ruled, "place", "left")
    groups = decisions(listed, linked, ruled, labels)
    by_alias = lookup_join(named.select("id", "host", "path", "node", "rule", F.col("verdict").alias("own")), groups, "node", "left", "url-groups")
    return by_alias.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("own", "shared", F.lit("allow")).alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(F.col("shared").isNotNull(), "alias").otherwise("default").alias("decided_by"),
    )


def decisions(listed: DataFrame, linked: DataFrame, ruled: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, shared): what the rules say of a node's group, for nodes in a group that a rule fits."""
    ends = listed.select("node", "place").unionByName(linked.select(F.col("target").alias("node"), "place"))
    votes = ends.distinct().join(ruled, "place").join(labels, "node", "left").select(F.coalesce("label", "node").alias("label"), "verdict")
    # an allow is the lesser text of the two and goes first
    shared = votes.groupBy("label").agg(F.min("verdict").alias("shared"))
    nodes = listed.join(ruled, "place", "left_anti").select("node").distinct().join(labels, "node", "left")
    return nodes.withColumn("label", F.coalesce("label", "node")).join(shared, "label").select("node", "shared")


def rules_of(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A table of rules from (verdict, host, path) texts."""
    named = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(("verdict", "host", "path"), r, strict=True)]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*named)))
