"""URL verdicts: explicit host and path rules first, then trust and distrust that spread along the host link graph.
Native.

Trust is a personalised PageRank along links, from every host in proportion to its pages that the rules allow; distrust
is one against links (who links to a bad host is suspect), from every host in proportion to its pages that they block.
A page that no rule fits is blocked if its host's distrust is over `threshold` of its trust and distrust together, and
allowed if the host has neither.

Defined cases: a url that is null or has no "://" has an empty host and path, which no rule fits and no link reaches
(allow); null html has no links; repeated rows are judged alike; an empty table gives an empty result; other columns
are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import ascii_lower, cut, read

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
LINK = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?\s*(?:https?:)?//([^/"'\s>?#]+)"""
#: Rounds end when one moves less mass than TOLERANCE in all; that is looked at every LOOK rounds.
DAMPING, TOLERANCE, LOOK, THRESHOLD = 0.85, 1e-6, 4, 0.5


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, w: links between different hosts in the html, and host to parent domain where both have pages."""
    linked = (
        pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
        .withColumn("dst", ascii_lower(F.col("dst")))
        .filter("src <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("w"))
    )
    hosts = pages.select("host").filter("host <> ''").distinct()
    up = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1).alias("dst"))
    up = up.join(hosts.withColumnRenamed("host", "dst"), "dst", "left_semi")
    both = up.select("src", "dst").unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return linked.unionByName(both.withColumn("w", F.lit(1.0)))


def propagate(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """seeds: kind (trust or distrust), host, seed (sums to 1 by kind). Gives kind, host, score.

    Both kinds run in one table: trust along the edges, distrust against them. score = (1 - DAMPING) seed + DAMPING times
    what comes in; what reaches a host without links of its own goes no further. A round is one join and one sum on
    (kind, host), partial before the shuffle; a hub's links are a skewed key of that join, which Spark splits. Rounds go on
    until the scores stand still: each has DAMPING times the mass to move that the last had, so they come to an end.
    """
    turn = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "w").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "w")
    )
    total = turn.groupBy("kind", "a").agg(F.sum("w").alias("t"))
    steps = cut(turn.join(total, ["kind", "a"]).select("kind", "a", "b", (F.col("w") / F.col("t")).alias("p")))
    seeds = cut(seeds)
    now, k = seeds.withColumnRenamed("seed", "score"), 0
    if steps.isEmpty():
        return now
    while True:
        flow = now.withColumnRenamed("host", "a").join(steps, ["kind", "a"])
        flow = flow.select("kind", F.col("b").alias("host"), (F.col("score") * F.col("p") * DAMPING).alias("score"))
        base = seeds.select("kind", "host", (F.col("seed") * (1 - DAMPING)).alias("score"))
        last, now, k = now, flow.unionByName(base).groupBy("kind", "host").agg(F.sum("score").alias("score")), k + 1
        if k % LOOK == LOOK - 1:
            now = cut(now)  # the next round is compared with this one
        if k % LOOK == 0:
            now = cut(now)
            old = last.withColumnRenamed("score", "was")
            moved = now.join(old, ["kind", "host"], "full").agg(
                F.sum(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("was", F.lit(0.0))))
            )
            if (moved.first()[0] or 0.0) < TOLERANCE:
                return now


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict for each page."""
    url = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    url = url.withColumn("_m", matched_rule(F.col("host"), F.col("path"), rules))
    per_host = url.filter("host <> ''").groupBy("host").agg(
        F.count_if(F.col("_m.verdict") == "allow").alias("good"), F.count_if(F.col("_m.verdict") == "block").alias("bad")
    )
    kinds = F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("good").alias("m")),
        F.struct(F.lit("distrust").alias("kind"), F.col("bad").alias("m")),
    )
    mass = per_host.select("host", F.inline(kinds)).filter("m > 0")
    total = mass.groupBy("kind").agg(F.sum("m").alias("t"))  # two rows at most
    seeds = mass.join(F.broadcast(total), "kind").select("kind", "host", (F.col("m") / F.col("t")).alias("seed"))
    links = host_edges(pages.select(host_of(F.col("url")).alias("host"), "html"))
    score = propagate(seeds, links).groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("bad"), F.sum("score").alias("all")
    )
    worse = score.filter(F.col("bad") > threshold * F.col("all")).select("host", F.lit("block").alias("_v"))
    out = url.join(worse, "host", "left")
    return out.select(
        "page_id", "host", "path", F.col("_m.rule").alias("rule"), F.coalesce("_m.verdict", "_v", F.lit("allow")).alias("verdict")
    )


def op5(spark, sf_dir):
    return judge(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
