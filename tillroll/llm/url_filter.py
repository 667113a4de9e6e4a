"""URL filter with redirect equivalence, in DataFrame functions only.

Rules judge urls by host suffix and path prefix; the longest wins. Urls that
are one page under several names (scheme, www, default file, tracking
parameters, fragment), and urls that redirect to or name another one as
canonical, form one class: connected components over these edges. A url
without a rule takes its class's decision: allowed if a url of the class is
explicitly allowed, else blocked if one is blocked, else allowed.

Cases: a null url, or one without ``://``, has empty host and path and no
aliases; a null html has no edges; repeated rows are judged alike; an empty
table gives no rows. Of rules of one length an allow wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import connected_components, materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that don't select content.
TRACKING = r"(utm_[a-z]*|ref|fbclid|gclid|sessionid)"


def host_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; nulls if none fits. ``rules``: (verdict, host/path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: (len(x[1]), x[0] == "allow")):  # a later one goes before
        h, _, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def node_of(url: Column) -> Column:
    """One key for a page's names; null without ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"(/index)?\.html?$", ""), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, rf"(^|&){TRACKING}=[^&]*", ""), "^&+", "")
    return F.when(F.instr(url, "://") > 0, F.md5(F.concat_ws("\n", host, path, query).cast("binary")))


def resolve(base: Column, target: Column) -> Column:
    """The target of a link on a page, as an absolute url."""
    scheme, host, path = F.substring_index(base, "://", 1), host_of(base), path_of(base)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(scheme, F.lit("://"), host, target))
            .when(target != "", F.concat(scheme, F.lit("://"), host, F.regexp_extract(F.concat(F.lit("/"), F.ltrim(path, F.lit("/"))), r"^.*/", 0), target)))


def page_links(pages: DataFrame) -> DataFrame:
    """(url, target) of canonical links and meta refreshes in the pages' html."""
    tag = F.filter(F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\s[^>]*>"), F.lit(0)),
                   lambda t: t.rlike(r"(?i)rel\s*=\s*[\"']?canonical\b") | t.rlike(r"(?i)http-equiv\s*=\s*[\"']?refresh\b"))
    tags = pages.filter(F.col("html").rlike("(?i)canonical|refresh")).select("url", F.explode(tag).alias("tag"))
    href = F.regexp_extract("tag", r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    refresh = F.regexp_extract("tag", r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)
    target = F.when(F.col("tag").rlike("(?i)^<link"), href).otherwise(refresh)
    return tags.select("url", resolve(F.col("url"), target).alias("target")).filter("target is not null")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every page. ``redirects``: further (url, target) rows."""
    links = page_links(pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")))
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    links = materialise(links, "url-links").filter(F.col("url").contains("://") & F.col("target").contains("://"))
    components = connected_components(links.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b")))

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = rows.withColumns({"rule": rule, "own": verdict}).join(components, "node", "left") \
        .withColumn("class", F.coalesce("component", "node"))
    # A link's target has its say even if it isn't among the pages.
    ends = links.select(F.explode(F.array("url", "target")).alias("url"))
    _, said = rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)
    ends = ends.select(node_of(F.col("url")).alias("node"), said.alias("own")).distinct().join(components, "node", "left") \
        .select(F.coalesce("component", "node").alias("class"), "own")
    decisions = judged.select("class", "own").union(ends).filter("class is not null and own is not null").groupBy("class").agg(
        F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"))
    whole = judged.join(decisions, "class", "left")
    method = F.when(F.coalesce("blocked", F.lit(False)) & ~F.coalesce("allowed", F.lit(False)), "block").otherwise("allow")
    return whole.select("page_id", "host", "path", "rule", F.coalesce("own", method).alias("verdict"))
