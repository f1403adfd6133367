"""URL filters by rules and link-graph propagation (DataFrame functions only).

A rule (action, host, path) fits its host and all subdomains when the URL's
path starts with the rule's; the longest fitting rule decides. URLs without a
rule get the verdict of their host:

* edges: hyperlinks between different hosts (absolute and protocol-relative
  ``href`` values; relative ones stay on their host), and each host with its
  parent domain in both directions, since a subdomain is run by its parent;
* trust: personalised PageRank along the edges from the hosts with allowed
  pages; distrust: the same along the reversed edges from the hosts with
  blocked pages. Seeds weigh by their share of the pages that rules decide;
* a host is blocked when distrust reaches it and is at least ``threshold`` times its
  trust; hosts that neither reaches are allowed. Both are compared as they are, equal
  up to a relative ``TOLERANCE`` (sums add up in any order), so a verdict depends on
  the ratio of the two and not on how many pages share the seeds' mass.

Edges are summed to one row per pair of hosts before any join, so the loop's
data grows with host pairs and not with pages. A node without out-edges keeps
its mass. ``iterations`` steps leave at most ``damping ** iterations`` of the walk open: 0.85 ** 12
is 14 percent, mass that would still move between hosts 13 and more links from a seed.

Cases: NULL URL, or one without ``://``, has an empty host and path, no rule
and verdict allow; NULL html has no links; repeated rows are judged alike and
counted twice as seeds; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
TOLERANCE = 1e-9
HREF = r"""href[ \t\r\n]*=[ \t\r\n]*["']?([^"' \t\r\n>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, action) of the longest fitting rule, or NULL."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, action of every row."""
    df = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return df.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)) \
        .select("page_id", "host", "path", "r.rule", "r.action")


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: one row per ordered pair of hosts."""
    src = host_of(F.col("url"))
    href = F.explode(F.regexp_extract_all("html", F.lit("(?i)" + HREF), F.lit(1)))
    links = pages.select(src.alias("src"), href.alias("href"))
    full = F.when(F.col("href").startswith("//"), F.concat(F.lit("x:"), "href")).otherwise(F.col("href"))
    links = links.select("src", host_of(full).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst") \
        .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    hosts = pages.select(src.alias("h")).where("h <> ''").groupBy("h").agg(F.lit(1).alias("one"))
    parent = F.regexp_extract("h", r"^[^.]+\.(.+\..+)$", 1)
    kin = hosts.select("h", parent.alias("p")).where("p <> ''")
    kin = kin.select(F.explode(F.array(F.struct(F.col("h").alias("src"), F.col("p").alias("dst")),
                                       F.struct(F.col("p").alias("src"), F.col("h").alias("dst")))).alias("e")) \
        .select("e.src", "e.dst", F.lit(1).cast("long").alias("n"))
    return links.unionByName(kin).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, iterations: int = 12, damping: float = 0.85) -> DataFrame:
    """host, trust, distrust. ``seeds``: host, trust, distrust (each sums to 1 or 0)."""
    both = edges.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n"),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "n"))).alias("e")) \
        .select("e.*")
    out = both.groupBy("kind", "a").agg(F.sum("n").alias("total"))
    norm = materialize(both.join(out, ["kind", "a"]).select("kind", "a", "b", (F.col("n") / F.col("total")).alias("w")),
                       "host-edges")
    seed = seeds.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), "host", F.col("trust").alias("s")),
        F.struct(F.lit("distrust").alias("kind"), "host", F.col("distrust").alias("s")))).alias("e")).select("e.*")
    nodes = norm.select("kind", F.explode(F.array("a", "b")).alias("host")).unionByName(seed.select("kind", "host")) \
        .distinct()
    keeps = norm.select("kind", F.col("a").alias("host")).distinct().withColumn("moves", F.lit(True))
    nodes = materialize(nodes.join(seed, ["kind", "host"], "left").join(keeps, ["kind", "host"], "left")
                        .select("kind", "host", F.coalesce("s", F.lit(0.0)).alias("s"),
                                F.col("moves").isNull().alias("sink")), "host-nodes")
    rank = nodes.select("kind", "host", F.col("s").alias("r"))
    for i in range(iterations):
        flow = rank.join(norm, (norm.kind == rank.kind) & (norm.a == rank.host)) \
            .select(norm.kind, F.col("b").alias("host"), (F.col("r") * F.col("w")).alias("x"))
        stay = rank.join(nodes.where("sink").select("kind", "host"), ["kind", "host"], "left_semi") \
            .select("kind", "host", F.col("r").alias("x"))
        got = flow.unionByName(stay).groupBy("kind", "host").agg(F.sum("x").alias("x"))
        rank = nodes.join(got, ["kind", "host"], "left") \
            .select("kind", "host", ((1 - damping) * F.col("s") + damping * F.coalesce("x", F.lit(0.0))).alias("r"))
        rank = materialize(rank, "host-rank")
    r = F.col("r")
    return rank.groupBy("host").agg(F.max(F.when(F.col("kind") == "trust", r)).alias("trust"),
                                    F.max(F.when(F.col("kind") == "distrust", r)).alias("distrust"))


def host_scores(pages: DataFrame, rules=RULES, iterations: int = 12, damping: float = 0.85) -> DataFrame:
    counts = materialize(judged(pages, rules).where("action IS NOT NULL AND host <> ''").groupBy("host").agg(
        F.count_if(F.col("action") == "allow").alias("a"), F.count_if(F.col("action") == "block").alias("b")),
        "host-seeds")
    total = counts.agg(F.sum("a"), F.sum("b")).first()
    share = lambda c, t: (F.col(c) / F.lit(float(t))) if t else F.lit(0.0)
    seeds = counts.select("host", share("a", total[0]).alias("trust"), share("b", total[1]).alias("distrust"))
    return propagate(seeds, materialize(host_edges(pages), "host-links"), iterations, damping)


def filter_urls(pages: DataFrame, rules=RULES, threshold: float = 1.0, iterations: int = 12,
                damping: float = 0.85) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row."""
    scores = host_scores(pages, rules, iterations, damping)
    out = judged(pages, rules).join(scores, "host", "left")
    t, d = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    verdict = F.coalesce("action", F.when((d > 0) & (d >= threshold * t * (1 - TOLERANCE)), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), t.alias("trust"), d.alias("distrust"))
