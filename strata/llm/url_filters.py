"""URL filters: rules first, link-graph propagation for what no rule decides.

The hosts of the pages and of their links form a graph. Trust starts at
hosts with pages that a rule allows and follows links; distrust starts at
hosts with blocked pages and goes against them (who links to a bad host is
suspect). Both are personalised PageRanks whose teleport vector counts
pages, so they compare with the host's undecided pages, its neutral
evidence. A host is blocked when distrust holds more than ``threshold`` of
all its evidence.

DataFrame operations only. Edges are summed per host pair before any join,
so a host with a third of all pages weighs no more than its distinct links.

Cases: a null url, or one without ``://``, has an empty host and path, no
rule, and is allowed; repeated rows count and are answered one by one; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.text import lower_ascii
from strata.session import stage_table

# The rules, host and path as one string.
BLOCK, ALLOW = "block", "allow"
RULES = {
    "net/": BLOCK,
    "example.net/en/": ALLOW,
    "example.com/de/": BLOCK,
    "org/fr/": ALLOW,
}

DAMPING = 0.85
ITERATIONS = 12
THRESHOLD = 0.5
#: Blocked hosts are broadcast up to so many bytes, at so many a host; more are joined by a shuffle.
BROADCAST_BYTES, HOST_BYTES = 32 << 20, 512
#: Iterations between two written tables.
STAGE_EVERY = 4
#: Hosts of absolute links; a link without a host stays on its own host and moves no mass.
LINK_HOST = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def url_host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(found)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits a host, its subdomains and the start of a path; else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # a longer one is tried before
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def rule_verdict(rule: Column, rules: dict[str, str]) -> Column:
    blocked = [r for r, v in rules.items() if v == BLOCK]
    return F.when(rule.isNull(), F.lit(None)).when(rule.isin(blocked), F.lit(BLOCK)).otherwise(F.lit(ALLOW))


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between different hosts: (src, dst, links)."""
    links = F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(LINK_HOST), F.lit(1))
    return (
        pages.select(url_host(F.col("url")).alias("src"), F.explode(links).alias("dst"))
        .withColumn("dst", lower_ascii(F.col("dst")))
        .filter("src <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def host_evidence(judged: DataFrame) -> DataFrame:
    """Pages of each host that a rule allows, blocks, or leaves open."""
    return judged.groupBy("host").agg(
        F.count(F.when(F.col("ruled") == ALLOW, 1)).cast("double").alias("allowed"),
        F.count(F.when(F.col("ruled") == BLOCK, 1)).cast("double").alias("blocked"),
        F.count(F.when(F.col("ruled").isNull(), 1)).cast("double").alias("open"),
    )


def propagate(
    seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS
) -> DataFrame:
    """Mass of each (kind, host) from seeds (kind, host, seed) over edges (kind, src, dst, share)."""
    base = seeds.select("kind", "host", ((1 - damping) * F.col("seed")).alias("mass"))
    ranks = base
    for k in range(1, iterations + 1):
        moved = edges.join(ranks.withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (damping * F.col("share") * F.col("mass")).alias("mass")
        )
        ranks = base.unionByName(moved).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if k % STAGE_EVERY == 0 and k < iterations:
            ranks, _ = stage_table(ranks, f"url_ranks_{k}")
    return ranks


def blocked_hosts(judged: DataFrame, edges: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Hosts on which distrust outweighs trust and the pages that no rule decides."""
    damping = options.get("damping", DAMPING)
    evidence, _ = stage_table(host_evidence(judged), "url_evidence")
    seeds = evidence.select(
        "host",
        F.explode(F.array(F.struct(F.lit("t").alias("kind"), F.col("allowed").alias("seed")),
                          F.struct(F.lit("d").alias("kind"), F.col("blocked").alias("seed")))).alias("s"),
    ).select("s.kind", "host", "s.seed").filter("seed > 0")
    both = edges.select(F.lit("t").alias("kind"), "src", "dst", "links").unionByName(
        edges.select(F.lit("d").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    )
    out = both.groupBy("kind", "src").agg(F.sum("links").alias("all_links"))
    shares, _ = stage_table(
        both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("all_links")).alias("share")),
        "url_shares",
    )
    ranks = propagate(seeds, shares, **options)
    mass = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0))
    scores = ranks.groupBy("host").agg(mass("t").alias("trust"), mass("d").alias("distrust"))
    neutral = (1 - damping) * F.coalesce(F.col("open"), F.lit(0.0))
    total = F.col("trust") + F.col("distrust") + neutral
    return (
        scores.join(evidence.select("host", "open"), "host", "left")
        .filter((F.col("host") != "") & (F.col("distrust") > threshold * total))
        .select("host")
    )


def filter_urls(pages: DataFrame, rules: dict[str, str] | None = None, **options) -> DataFrame:
    """Verdict on every page's url: the rule's, else that of its host's place in the link graph."""
    rules = RULES if rules is None else rules
    pages = pages.select("page_id", "url", "html")
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = judged.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    judged = judged.withColumn("ruled", rule_verdict(F.col("rule"), rules))
    edges, _ = stage_table(host_edges(pages), "url_edges")
    bad = blocked_hosts(judged, edges, **options).withColumn("bad", F.lit(True))
    bad, _ = stage_table(bad, "url_blocked_hosts")
    if bad.count() * HOST_BYTES <= BROADCAST_BYTES:
        bad = F.broadcast(bad)
    verdict = F.coalesce("ruled", F.when(F.col("bad"), F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return judged.join(bad, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
