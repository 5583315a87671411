"""URL filters: rules, and link-graph propagation for what no rule judges.

Only DataFrame functions.  A page's rule is the longest (host, path) rule that
fits; a rule fits its host and every subdomain of it, for paths that start with
its path.  Hosts get two scores over the host edges of the pages' links:

* trust: personalised PageRank along the links, seeded by the share of a host's
  pages that rules allow;
* distrust: the same against the links (who links to a bad host is suspect),
  seeded by the share of pages that rules block.

Both are propagated unnormalised, ``r = (1 - d) * seed + d * neighbours``, so
scores of hosts compare on one scale.  A page without a rule is blocked if
``distrust / (trust + distrust + prior)`` of its host reaches ``threshold``.

Defined cases: a null url or one without ``://`` has empty host and path, no rule
and is allowed (no evidence); a repeated page or link counts each time for
seeds and once for edges; a host without links in or out keeps its own seed;
an empty table gives no rows; further columns are ignored; a null html has no links.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import discard, lower_ascii, staged


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*([^"'\s>]+)"""


def url_rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))


def host_of(rest: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))


def path_of(rest: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``pages`` with host and path, plus ``rule`` and ``rule_verdict`` of the longest fitting rule (or nulls)."""
    ordered = sorted(rules, key=lambda r: (len(r.host), len(r.path)), reverse=True)

    def fits(rule: Rule) -> Column:
        host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        return host & F.col("path").startswith(rule.path)

    def pick(value) -> Column:
        return reduce(lambda rest, r: F.when(fits(r), F.lit(value(r))).otherwise(rest), reversed(ordered), F.lit(None).cast("string"))

    return pages.withColumns({"rule": pick(lambda r: r.name), "rule_verdict": pick(lambda r: r.verdict)})


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) links between different hosts; a relative link stays on its host and is no edge."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("href"))
    rest = F.regexp_extract("href", r"(?i)^(?:[a-z][a-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return (
        links.select("src", lower_ascii(rest).alias("dst"))
        .where((F.col("dst") != "") & (F.col("src") != "") & (F.col("dst") != F.col("src")))
        .distinct()
    )


def propagate(seeds: DataFrame, edges: DataFrame, damping: float, rounds: int) -> DataFrame:
    """(host, trust, distrust) after ``rounds`` of propagation from ``seeds`` (host, trust_seed, distrust_seed).

    Every round is one aggregation over the edges for both scores; it is written
    to the shared folder, so lineage stays one round long.
    """
    out_n = edges.groupBy("src").agg(F.count("*").alias("out_n"))
    in_n = edges.groupBy("dst").agg(F.count("*").alias("in_n"))
    weighted = staged(edges.join(out_n, "src").join(in_n, "dst"), "host-edges")
    hosts = seeds.select("host").union(edges.select("src")).union(edges.select("dst")).distinct()
    seeds = staged(hosts.join(seeds, "host", "left").na.fill(0.0, ["trust_seed", "distrust_seed"]), "host-seeds")
    keep = 1.0 - damping
    start = seeds.select("host", (keep * F.col("trust_seed")).alias("trust"), (keep * F.col("distrust_seed")).alias("distrust"))
    if weighted.isEmpty():
        return start
    ranks, before = start, None
    for _ in range(rounds):
        forward = weighted.join(ranks.select(F.col("host").alias("src"), "trust"), "src").select(
            F.col("dst").alias("host"), (F.col("trust") / F.col("out_n")).alias("t"), F.lit(0.0).alias("d")
        )
        backward = weighted.join(ranks.select(F.col("host").alias("dst"), "distrust"), "dst").select(
            F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") / F.col("in_n")).alias("d")
        )
        moved = forward.union(backward).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        ranks = seeds.join(moved, "host", "left").select(
            "host",
            (keep * F.col("trust_seed") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
            (keep * F.col("distrust_seed") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust"),
        )
        ranks = staged(ranks, "host-ranks")
        if before is not None:
            discard(before)
        before = ranks
    return ranks


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    damping: float = 0.85,
    rounds: int = 12,
    prior: float = 0.05,
    threshold: float = 0.5,
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row of ``pages`` (page_id, url, html).

    ``prior`` is the weight of no evidence; with the seeds' scale ``1 - damping`` it
    keeps hosts with a few blocked pages allowed.
    """
    rest = url_rest(F.col("url"))
    parsed = pages.select("page_id", "html", rest.alias("rest")).select(
        "page_id", "html", host_of(F.col("rest")).alias("host"), path_of(F.col("rest")).alias("path")
    )
    ruled = with_rule(parsed, rules)
    seeds = (
        ruled.where(F.col("host") != "")
        .groupBy("host")
        .agg(
            F.avg((F.coalesce("rule_verdict", F.lit("")) == "allow").cast("double")).alias("trust_seed"),
            F.avg((F.coalesce("rule_verdict", F.lit("")) == "block").cast("double")).alias("distrust_seed"),
        )
    )
    ranks = propagate(seeds, host_edges(parsed), damping, rounds)
    risk = F.col("distrust") / (F.col("trust") + F.col("distrust") + prior)
    by_method = F.when(F.coalesce(risk, F.lit(0.0)) >= threshold, "block").otherwise("allow")
    return ruled.join(ranks, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", by_method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
