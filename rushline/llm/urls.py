"""URL filter: rules by host and path, and link-graph propagation for the rest.

A rule fits its host and all subdomains where the path starts with the rule's;
the longest fitting rule wins. Hosts no rule speaks for are judged by the link
graph: trust flows from hosts with allowed pages along host edges (personalised
PageRank), distrust flows from hosts with blocked pages against them, and a host
whose distrust outweighs its trust is blocked.

Defined results: a NULL url, or one without ``://``, has an empty host and path,
fits no rule and takes no part in the graph; such rows and hosts without any link
from or to a seed get the default verdict. Repeated pages are judged one by one,
their links count once per host and target. An empty table gives an empty result.
Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rushline.llm.common import ascii_lower, join_few, lambda_range, let, stored

RULE_SCHEMA = "rule_host string, rule_path string, rule_verdict string"


@dataclass(frozen=True)
class Propagation:
    damping: float = 0.85
    #: Steps that the SQL unrolls; the operator does not stop there.
    iterations: int = 12
    #: Go on until one step moves less than this and reaches no further host.
    tolerance: float = 1e-4
    #: Block where distrust exceeds so many times the trust.
    distrust_ratio: float = 2.0
    default: str = "allow"

    def settled_after(self) -> int:
        """Steps after which the tolerance holds on any graph: a step moves at most
        damping times what the one before moved, the first at most twice the damping
        for each of the two kinds."""
        return 1 + max(1, math.ceil(math.log(self.tolerance / 4) / math.log(self.damping)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower case."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(
        F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(rule_host, rule_path, rule_verdict) of rules like ("example.org/es/", "block")."""
    rows = [(text.partition("/")[0], "/" + text.partition("/")[2], verdict)
            for text, verdict in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def suffixes(host: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c]"""
    return let(F.split(host, r"\."), lambda parts: F.transform(
        lambda_range(F.size(parts)),
        lambda i: F.concat_ws(".", F.slice(parts, i + 1, F.size(parts)))))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules of each host and its parents, the winner first.

    Longest text first, then the nearer host, then block before allow. Grouped by
    host, whose share of the rules is what was written for its own domains.
    """
    fitting = hosts.select("host", F.explode(suffixes(F.col("host"))).alias("rule_host")).join(
        rules, "rule_host").groupBy("host").agg(F.collect_set(F.struct(
            (-F.length(F.concat("rule_host", "rule_path"))).alias("order"),
            (-F.length("rule_host")).alias("near"),
            (F.col("rule_verdict") == "allow").alias("allows"),
            F.concat("rule_host", "rule_path").alias("rule"), "rule_path", "rule_verdict",
        )).alias("rules"))
    return fitting.select("host", F.sort_array("rules").alias("rules"))


def first_rule(path: Column, rules: Column) -> Column:
    """The winning rule for a path, or NULL."""
    return F.get(F.filter(rules, lambda r: F.startswith(path, r["rule_path"])), F.lit(0))


def link_hosts(html: Column, host: Column) -> Column:
    """The other hosts a page links to, each once. Relative links stay inside."""
    targets = F.regexp_extract_all(
        F.coalesce(html, F.lit("")),
        F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""), F.lit(1))
    return F.filter(F.array_distinct(F.transform(targets, ascii_lower)), lambda t: t != host)


def propagate(edges: DataFrame, seeds: DataFrame, settings: Propagation = Propagation()) -> DataFrame:
    """(kind, host, score): seeds' mass spread over weighted links.

    ``edges`` (kind, src, dst, weight) hold each kind's direction, weights of one
    src summing to 1; ``seeds`` (kind, host, mass) sum to 1 per kind. Both kinds
    run in one job per step. A step sums per target on the map side first; a hub's
    many edges are split by the skew join. The ranks of every step are stored, so
    plans stay short and a lost executor costs one step. Every host that links lead
    to gets its score, however far it is: a step that reaches a new one is not the
    last. The hosts bound these steps, ``settled_after`` those of the tolerance.
    """
    taken, reached = 0, -1
    ranks = seeds.select("kind", "host", F.col("mass").alias("score"))
    while True:
        moved = edges.join(
            ranks.withColumnRenamed("host", "src"), ["kind", "src"],
        ).select("kind", F.col("dst").alias("host"),
                 (settings.damping * F.col("score") * F.col("weight")).alias("part"))
        spread = moved.unionByName(seeds.select(
            "kind", "host", ((1 - settings.damping) * F.col("mass")).alias("part")))
        previous = ranks.select("kind", "host", F.lit(0.0).alias("score"),
                                (-F.col("score")).alias("change"))
        step = spread.select("kind", "host", F.col("part").alias("score"),
                             F.col("part").alias("change")).unionByName(previous)
        ranks = stored(step.groupBy("kind", "host").agg(
            F.sum("score").alias("score"), F.sum("change").alias("change")), "url_ranks")
        before = reached
        delta, reached = ranks.agg(F.sum(F.abs("change")), F.count(F.lit(1))).first()
        taken += 1
        if (delta or 0.0) < settings.tolerance:
            if reached == before:
                return ranks.select("kind", "host", "score")
        elif taken > settings.settled_after():
            raise RuntimeError(
                f"ranks still move by {delta} after {taken} steps; do the weights of a host sum to 1?")


def host_graph(links: DataFrame) -> DataFrame:
    """Both directions of (src, dst, n) as (kind, src, dst, weight)."""
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"),
                     F.col("src").alias("dst"), "n"))
    totals = both.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    return both.join(totals, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("n") / F.col("total")).alias("weight"))


def judge(
    pages: DataFrame, rules: DataFrame, settings: Propagation = Propagation(),
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page."""
    parsed = stored(pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        "html",
    ).select("page_id", "host", "path", link_hosts(F.col("html"), F.col("host")).alias("links")),
        "url_pages")
    named = parsed.where(F.col("host") != "")
    hosts = named.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    ruled = stored(rules_of_hosts(hosts, rules).withColumnRenamed("host", "host_"), "url_rules")
    salt = F.xxhash64("page_id", "path")
    placed = join_few(parsed, ruled, "host", "host_", salt, "left").select(
        "page_id", "host", "path", first_rule(F.col("path"), F.col("rules")).alias("hit"))
    # Seeds: each host's share of the allowed, and of the blocked pages.
    counts = placed.where(F.col("hit").isNotNull()).groupBy(
        F.when(F.col("hit.rule_verdict") == "allow", "trust").otherwise("distrust").alias("kind"),
        "host").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = stored(counts.join(F.broadcast(totals), "kind").select(
        "kind", "host", (F.col("n") / F.col("total")).alias("mass")), "url_seeds")
    links = named.select(F.col("host").alias("src"), F.explode("links").alias("dst")).groupBy(
        "src", "dst").agg(F.count(F.lit(1)).alias("n"))
    links = stored(links, "url_links")
    scores = stored(propagate(host_graph(links), seeds, settings).groupBy(
        F.col("host").alias("host_")).agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score"))).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score"))).alias("distrust")), "url_scores")
    judged = join_few(placed, scores, "host", "host_", salt, "left").select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.col("hit.rule_verdict").alias("ruled"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    by_graph = F.when(
        F.col("distrust") > settings.distrust_ratio * F.col("trust"), "block",
    ).otherwise(settings.default)
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_graph).alias("verdict"),
        "trust", "distrust")
