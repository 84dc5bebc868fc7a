"""URL rules, and trust for what no rule names.

Rules name a host (with all its subdomains) and the beginning of a path. A host most of whose ruled pages are allowed is a
trusted seed, one most of whose are blocked a distrusted seed, in proportion to the share of its pages. Trust follows
links from trusted seeds (personalised PageRank); distrust follows them backwards from distrusted seeds, since
who links to bad hosts is suspect. A page without a rule gets the verdict of its host: block when distrust is more than
``threshold`` of the sum of both.
"""

from __future__ import annotations

import string
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from tablework.llm.common import picked, stage

# The rules of the production list, verdict and rule.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# A tag that never closes ends where the next one begins.
_LINK = r"""(?is)<a\s[^<>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""
# Scores are settled when no host is new and none changed by more than this share of its score.
TOLERANCE = 1e-4
DAMPING = 0.85


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; equal rules: the first."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in reversed(sorted(rules, key=lambda r: -len(r[1]))):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, from (host, html)."""
    targets = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)), lambda u: host_of(
        F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u)
    )))
    pairs = pages.where("html IS NOT NULL AND host != ''").select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
    return pairs.where("src != dst AND dst != ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagated(links: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """(host, score): personalised PageRank over (src, dst, n) with restart at (host, weight).

    A host that links nowhere hands its score back to the seeds. Scores add up to 1. Without seeds there is no row. Without
    ``rounds`` it goes on until the scores are settled, however long the paths.
    """
    mass = seeds.agg(F.sum("weight")).first()[0]
    if not mass:
        return seeds.select("host", F.col("weight").alias("score")).limit(0)
    start = stage(seeds.where("weight > 0").select("host", (F.col("weight") / mass).alias("start")), "seeds")
    out = links.groupBy("src").agg(F.sum("n").alias("total"))
    edges = stage(links.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share")), "links")
    scores = start.select("host", F.col("start").alias("score"))
    if not edges.take(1):
        return scores
    for _ in count() if rounds is None else range(rounds):
        sent = (
            scores.join(edges, scores.host == edges.src).groupBy(F.col("dst").alias("host"))
            .agg((F.sum(F.col("score") * F.col("share")) * damping).alias("score"))
        )
        sent = stage(sent, "sent")
        rest = 1.0 - (sent.agg(F.sum("score")).first()[0] or 0.0)
        back = start.select("host", (F.col("start") * F.lit(rest)).alias("score"))
        before, scores = scores, stage(sent.unionByName(back).groupBy("host").agg(F.sum("score").alias("score")), "scores")
        if rounds is None:
            old = before.withColumnRenamed("score", "old")
            unsettled = F.col("old").isNull() | (F.abs(F.col("score") - F.col("old")) > F.col("score") * TOLERANCE)
            if not scores.join(old, "host", "left").where(unsettled).take(1):
                break
    return scores


def judged(pages: DataFrame, rules=RULES, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url",
           html_col: str = "html", rounds: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), one row per input row.

    A null url, or one without ``://``, has empty host and path; no rule fits it and it is allowed, like every page of a
    host that no seed reaches. Null html has no links; null ids are passed on; repeated pages count as often as they
    come; an empty table gives no rows; other columns are not looked at.
    """
    source = picked(pages, page_id=id_col, url=url_col, html=html_col)
    parsed = source.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    marked = parsed.withColumns({"rule": rule, "ruled": verdict})
    hosts = stage(
        marked.where("host != ''").groupBy("host").agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if(F.col("ruled") == "allow").alias("allowed"),
            F.count_if(F.col("ruled") == "block").alias("blocked"),
        ),
        "hosts",
    )
    links = stage(host_links(parsed.select("host", "html")), "host-links")
    trust = propagated(links, hosts.where("allowed * 2 > pages").select("host", (F.col("allowed") / F.col("pages")).alias("weight")), rounds)
    against = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagated(against, hosts.where("blocked * 2 > pages").select("host", (F.col("blocked") / F.col("pages")).alias("weight")), rounds)
    by_host = (
        hosts.select("host").join(trust.withColumnRenamed("score", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "left")
        .select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    )
    narrow = marked.select("page_id", "host", "path", "rule", "ruled")
    own = F.when(F.col("distrust") > (F.col("trust") + F.col("distrust")) * threshold, "block").otherwise("allow")
    return narrow.join(by_host, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
