"""URL filters: rules first, link-graph propagation for hosts that no rule settles.

A rule is a verdict, a host and a path: it fits its host and all subdomains where the url's path
starts with the rule's; the longest rule wins. The share of a host's pages that rules allow or
block makes it a trusted or blocked seed. Trust then follows host edges as personalised PageRank
from the trusted seeds; distrust follows them backwards from the blocked seeds, so hosts that lead
to blocked ones lose. A host without edges in that direction keeps what it has. A host is blocked if
its distrust exceeds its trust by ``threshold``, in units of one fully blocked host.

Edges: absolute links of the page sources, one for each pair of hosts and page, added up before the
shuffle; and, as sites vouch for their own domain, an edge from each host to its parent domain down
to two labels. Everything is DataFrame operations; rounds are written tables of one row a host.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule and is
allowed; null html has no links; a host named like a rule's without a label border doesn't fit;
rules of equal length go by their text; repeated rows count each; an empty table gives an empty
result. Columns other than page_id, url and html are not read. Rules are a short list in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.llm.shared import written

#: (verdict, host, path) of the registered query.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING = 0.85
ROUNDS = 8
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^"'\s>/?#]*)"""


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None)
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts; ``pages``: (host, html)."""
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), lambda h: F.translate(h, UPPER, LOWER)))).alias("dst"))
    links = links.where("dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    hosts = pages.select("host").distinct().unionByName(links.select(F.col("dst").alias("host"))).distinct()
    labels = F.split("host", r"\.")
    steps = F.when(F.size(labels) > 2, F.sequence(F.lit(1), F.size(labels) - 2))
    name = lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    parents = hosts.select(F.explode(F.transform(steps, lambda k: F.struct(name(k).alias("src"), name(k + 1).alias("dst")))).alias("e")).select("e.*").distinct()
    return links.unionByName(parents.withColumn("weight", F.lit(1.0))).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) of every host; ``seeds``: (host, trust, distrust)."""
    hosts = edges.select(F.col("src").alias("host")).unionByName(edges.select(F.col("dst").alias("host"))).unionByName(seeds.select("host")).distinct()
    steps = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "weight").unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "weight"))
    total = steps.groupBy("kind", "host").agg(F.sum("weight").alias("total"))
    every = hosts.crossJoin(F.broadcast(edges.sparkSession.createDataFrame([("trust",), ("distrust",)], "kind string")))
    stay = every.join(total, ["kind", "host"], "left_anti").select("kind", "host", F.col("host").alias("to"), F.lit(1.0).alias("share"))
    steps = written(steps.join(total, ["kind", "host"]).select("kind", "host", "to", (F.col("weight") / F.col("total")).alias("share")).unionByName(stay), "url-steps")
    start = written(seeds.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "score")).where("score > 0"), "url-seeds")
    now = start
    for _ in range(rounds):
        moved = steps.join(now, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.lit(damping) * F.col("score") * F.col("share")).alias("score"))
        given = start.select("kind", "host", (F.lit(1 - damping) * F.col("score")).alias("score"))
        now = written(moved.unionByName(given).groupBy("kind", "host").agg(F.sum("score").alias("score")), "url-scores")
    one = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
    return now.groupBy("host").agg(one("trust"), one("distrust"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, page_id: str = "page_id", url: str = "url", html: str = "html", threshold: float = THRESHOLD, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``page_id``, host, path, rule, verdict, and the host's trust and distrust, of every page."""
    parts = pages.select(F.col(page_id).alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = parts.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules)).select("page", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled"))
    share = lambda verdict: F.avg(F.when(F.col("ruled") == verdict, 1.0).otherwise(0.0))
    seeds = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    edges = written(host_edges(pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))), "url-edges")
    scores = propagate(edges, seeds, damping, rounds)
    blocked = F.coalesce(F.col("distrust") - F.col("trust"), F.lit(0.0)) >= threshold
    out = ruled.join(scores, "host", "left").withColumn("verdict", F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")))
    return out.select(F.col("page").alias(page_id), "host", "path", "rule", "verdict", "trust", "distrust")
