"""URL filtering by rules, and by propagation over the graph of hosts.

Rules name hosts, which stand for their subdomains too, and path prefixes. Hosts without a fitting rule are judged by
the links between hosts: trust flows along them from the hosts of allowed pages (personalised PageRank), distrust flows
against them from the hosts of blocked pages. A host is blocked if its distrust reaches a threshold and exceeds its
trust.

Pages meet rules by their host's suffixes, hosts by link edges; what is joined per step is one row per edge and one per
host, and contributions are summed before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import small
from lodestone.session import stage

STEPS = 10
RESET = 0.15
#: Distrust, as a multiple of what an even share of all distrust would be, from which a host can be blocked.
THRESHOLD = 1.0

HREF = r"(?i)\shref\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*+:)?//[^\"'\s>]*+)"
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z as a-z; else empty."""
    found = F.regexp_extract(url, r"(?s)^(?:(?!://).)*+://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, *LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What is after the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^(?:(?!://).)*+://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column) -> Column:
    """The host and the domains above it."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def fitting_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct (host, path) of ``pages`` that a rule fits: the longest rule of
    ``rules`` (host, path, verdict); of equal ones a blocking one. Null hosts, paths and verdicts of rules fit nothing.
    """
    known = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        F.translate("host", *LOWER).alias("suffix"), F.col("path").alias("prefix"), F.col("verdict").alias("says")
    )
    known = small(stage(known, "url-rules"))
    parts = pages.where("host <> ''").select("host", "path").distinct()
    parts = parts.select("host", "path", F.explode(_suffixes(F.col("host"))).alias("suffix"))
    fits = parts.join(known, "suffix").where(F.col("path").startswith(F.col("prefix")))
    rule = F.concat("suffix", "prefix")
    best = F.max(F.struct(F.char_length(rule).alias("n"), (F.col("says") == "block").alias("b"), rule.alias("rule"), "says"))
    fits = fits.groupBy("host", "path").agg(best.alias("best"))
    return fits.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.says").alias("verdict"))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst): distinct links between different hosts, from the ``href`` of ``pages`` (host, html). Links without a
    scheme stay on their host; ``//host/path`` has the page's scheme."""
    hrefs = F.regexp_extract_all("html", F.lit(HREF), F.lit(1))
    rows = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(hrefs).alias("to"))
    absolute = F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))
    return rows.select("src", host_of(absolute).alias("dst")).where("dst <> '' AND src <> dst").distinct()


def _propagate(edges: DataFrame, seeds: DataFrame, steps: int, reset: float) -> DataFrame:
    """(host, score): personalised PageRank along ``edges`` (src, dst) from ``seeds`` (host, weight; sum 1). What hosts
    without links would pass on returns to the seeds, so that scores add up to 1."""
    degree = edges.groupBy("src").agg(F.count("*").alias("links"))
    weighted = stage(edges.join(degree, "src"), "host-edges")
    ranks = seeds.select("host", F.col("weight").alias("score"))
    if weighted.isEmpty():
        return ranks
    for _ in range(steps):
        moved = weighted.join(ranks, weighted["src"] == ranks["host"])
        moved = moved.groupBy(F.col("dst").alias("host")).agg((F.sum(F.col("score") / F.col("links")) * (1 - reset)).alias("in"))
        moved = stage(moved, "host-ranks")
        passed = moved.agg(F.sum("in")).first()[0] or 0.0
        both = seeds.join(moved, "host", "full")
        score = F.coalesce("in", F.lit(0.0)) + F.coalesce("weight", F.lit(0.0)) * (1.0 - passed)
        ranks = both.select("host", score.alias("score"))
    return ranks


def host_scores(edges: DataFrame, hosts: DataFrame, steps: int = STEPS, reset: float = RESET) -> DataFrame:
    """(host, trust, distrust), as multiples of an even share, of ``hosts`` (host, allowed, blocked: numbers of pages
    that a rule allows or blocks). Seeds weigh by their pages."""
    total = hosts.agg(F.count("*"), F.sum("allowed"), F.sum("blocked")).first()
    n, sums = total[0], {"allowed": total[1] or 0, "blocked": total[2] or 0}

    def spread(column: str, along: DataFrame) -> DataFrame:
        weight = F.col(column) / F.lit(float(max(sums[column], 1)))
        seeds = hosts.where(F.col(column) > 0).select("host", weight.alias("weight"))
        return _propagate(along, seeds, steps, reset)

    trust = spread("allowed", edges).withColumnRenamed("score", "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    distrust = spread("blocked", back).withColumnRenamed("score", "distrust")
    both = hosts.select("host").join(trust, "host", "left").join(distrust, "host", "left")
    scale = lambda c: (F.coalesce(c, F.lit(0.0)) * n).alias(c)
    return both.select("host", scale("trust"), scale("distrust"))


def filter_urls(
    pages: DataFrame, rules: DataFrame, steps: int = STEPS, reset: float = RESET, threshold: float = THRESHOLD
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), one row per row of ``pages`` (page_id, url, html).

    A page that a rule fits has its verdict; others are judged by their host's scores, which are null for hosts that
    are not known. A null url, or one without ``://``, has an empty host and path, no rule and no scores, and is
    allowed. Repeated rows are judged alike, and count as pages of their host. A null html has no links.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    light = stage(parsed.select("page_id", "host", "path"), "urls")
    edges = stage(host_links(parsed), "host-links")
    fits = stage(fitting_rules(light, rules), "url-fits")
    joined = light.join(fits, ["host", "path"], "left")
    ruled = lambda verdict: F.count_if(F.col("verdict") == verdict)
    own = joined.where("host <> ''").groupBy("host").agg(ruled("allow").alias("allowed"), ruled("block").alias("blocked"))
    linked = edges.select(F.col("dst").alias("host")).distinct().join(own.select("host"), "host", "left_anti")
    zero = F.lit(0).cast("long")
    hosts = stage(own.unionByName(linked.select("host", zero.alias("allowed"), zero.alias("blocked"))), "hosts")
    scores = stage(host_scores(edges, hosts, steps, reset), "host-scores")
    bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    by_method = F.when(bad, "block").otherwise("allow")
    return joined.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), "trust", "distrust"
    )
