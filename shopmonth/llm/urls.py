"""URL verdicts by rules, and by trust and distrust that spread over links between hosts.

Rules name a host and a path; a rule fits its host and all subdomains when the
url's path starts with the rule's, and the longest fitting rule decides. Hosts get
seeds from their pages: trust by the share that rules allow, distrust by the share
that rules block. Trust is a personalised PageRank along links, distrust one
against them: who links to blocked hosts is suspect. A host whose distrust reaches
``threshold`` and exceeds its trust is blocked, and so are those of its pages that
no rule judges; all others are allowed.

All of it is column expressions, joins and aggregates. Links are added up per pair
of hosts before they are joined, every round aggregates before it is written, and
lineage is cut by a checkpoint each round.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule and is allowed; null html has no links; relative links and links of a
host to itself carry nothing; repeated rows count as pages of their own. Rank that
reaches hosts without links is not handed on.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workdir import stage
from .graph import settled

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DAMPING = 0.85
ROUNDS = 10
THRESHOLD = 0.5
BROADCAST_ROWS = 1_000_000
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_BLANKS = r"[ \t\n\f\r]*+"  # never given back, so any number of them costs one pass
_LINK = rf"""(?is)\b(?:href|src){_BLANKS}={_BLANKS}["']?{_BLANKS}((?:[a-z][a-z0-9+.-]*+:)?//[^\s"'<>]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null when none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    rule = verdict = F.lit(None).cast("string")
    for kind, name in reversed(ordered):
        domain, _, rest = name.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """``src``, ``dst`` and ``n`` of links between different hosts, from the html."""
    targets = F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)))
    links = pages.where("host <> ''").select(F.col("host").alias("src"), targets.alias("link"))
    links = links.select("src", host_of(F.concat(F.lit("any:"), F.regexp_extract("link", r"(?s)//.*", 0))).alias("dst"))
    return links.where("dst <> '' AND dst <> src").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def link_shares(links: DataFrame) -> DataFrame:
    """``src``, ``dst`` and ``share``: the part of a host's links (src, dst, n) that goes to each other host."""
    out = links.groupBy("src").agg(F.sum("n").alias("total"))
    return links.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share"))


def _spread(seeds: DataFrame, shares: DataFrame, origin: str, target: str, value: Column, rounds: int) -> DataFrame:
    """``host`` and ``rank``: in each round what ``seed`` and ``moved``, the shares of others' ranks, make by ``value``."""
    zero = F.lit(0.0)
    start = seeds.select("host", "seed", zero.alias("moved"))
    ranks = settled(seeds.select("host", F.col("seed").alias("rank")))
    for _ in range(rounds):
        moved = (ranks.join(shares, ranks["host"] == shares[origin])
                 .groupBy(F.col(target).alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("moved")))
        both = start.unionByName(moved.select("host", zero.alias("seed"), "moved"))
        both = both.groupBy("host").agg(F.sum("seed").alias("seed"), F.sum("moved").alias("moved"))
        ranks = settled(both.select("host", value.alias("rank")))
    return ranks


def spread_trust(seeds: DataFrame, shares: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host`` and ``rank``: personalised PageRank from ``seeds`` (host, seed) along ``shares``."""
    return _spread(seeds, shares, "src", "dst", F.col("seed") + damping * F.col("moved"), rounds)


def spread_distrust(seeds: DataFrame, shares: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host`` and ``rank``: the damped chance to come from a host along ``shares`` to the blocked part of ``seeds``."""
    return _spread(seeds, shares, "dst", "src", F.col("seed") + (1 - F.col("seed")) * damping * F.col("moved"), rounds)


def host_scores(pages: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` of all hosts that seeds or links touch."""
    share = lambda kind: F.avg(F.when(F.col("rule_verdict") == kind, 1.0).otherwise(0.0))
    seeds = settled(pages.where("host <> ''").groupBy("host").agg(share("allow").alias("good"), share("block").alias("bad"))
                    .where("good > 0 OR bad > 0"))
    shares = settled(link_shares(settled(host_links(pages))))
    if shares.isEmpty():
        rounds = 0
    trust = spread_trust(seeds.where("good > 0").select("host", F.col("good").alias("seed")), shares, damping, rounds)
    distrust = spread_distrust(seeds.where("bad > 0").select("host", F.col("bad").alias("seed")), shares, damping, rounds)
    return (trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host", "full")
            .na.fill(0.0))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, threshold: float = THRESHOLD,
           damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "rule_verdict": verdict})
    scores = host_scores(rows, damping, rounds)
    blocked = stage(scores.where((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))).select("host"), "hosts")
    blocked = blocked.withColumn("blocked", F.lit(True))
    blocked = F.broadcast(blocked) if blocked.count() <= BROADCAST_ROWS else blocked
    by_method = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return (rows.drop("html").join(blocked, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_method).alias("verdict")))
