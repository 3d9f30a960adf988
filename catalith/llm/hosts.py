"""URL filters: rules by host and path, and for the rest trust and distrust that travel along links between hosts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import stored

#: Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]*)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class RankConfig:
    """``damping`` part of a score travels on each of ``steps`` steps; a host is blocked where its distrust is above ``ratio`` times its trust.

    ``parents`` links each host with the domain above it, down to ``labels`` labels; ``cut`` steps are planned at a time.
    """

    damping: float = 0.85
    steps: int = 20
    ratio: float = 1.0
    parents: bool = True
    labels: int = 2
    cut: int = 5


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to a slash, question mark, hash or the end, A-Z lower-cased; then up to a question mark, hash or the end."""
    mark = F.locate("://", url)
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def link_host(href: Column) -> Column:
    """Host that an absolute or scheme-less link names; NULL for links inside the page's own host."""
    named = F.regexp_extract(href, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]+)", 1)
    return F.when(named != "", F.translate(named, UPPER, LOWER))


def ruled(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules (verdict, host, path) that fit a host or a domain above it, as a list, longest first.

    ``hosts`` holds each host once; a host meets the rules at each of its domains by equality, so a list of any length is joined, not broadcast.
    """
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    met = hosts.where("host <> ''").select("host", F.explode(domains).alias("domain")).join(rules.withColumnRenamed("host", "domain"), "domain")
    rule = F.struct((-F.length("domain") - F.length("path")).alias("size"), F.concat("domain", "path").alias("rule"), "path", "verdict")
    return met.groupBy("host").agg(F.sort_array(F.collect_list(rule)).alias("rules"))


def host_links(pages: DataFrame, config: RankConfig) -> DataFrame:
    """(src, dst, weight) between different hosts out of (host, html): how many links one has to the other; one more both ways for a domain above."""
    out = pages.where("host <> ''").select("host", F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("href"))
    links = out.select(F.col("host").alias("src"), link_host(F.col("href")).alias("dst")).where("dst <> src")
    links = links.groupBy("src", "dst").agg(F.count("*").alias("weight"))
    if config.parents:
        nodes = pages.where("host <> ''").select("host").distinct()
        labels = F.split("host", r"\.")
        chain = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(labels) - config.labels, F.lit(0))), lambda k: F.array_join(F.slice(labels, k + 1, F.size(labels)), ".")
        )
        steps = nodes.select(F.explode(F.arrays_zip(F.slice(chain, 1, F.size(chain) - 1).alias("low"), F.slice(chain, 2, F.size(chain) - 1).alias("high"))).alias("e"))
        steps = steps.select("e.low", "e.high").distinct()
        both = steps.select(F.explode(F.array(F.struct(F.col("low").alias("src"), F.col("high").alias("dst")), F.struct(F.col("high").alias("src"), F.col("low").alias("dst")))).alias("e"))
        links = links.unionByName(both.select("e.src", "e.dst", F.lit(1).cast("long").alias("weight"))).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    return links


def host_scores(links: DataFrame, seeds: DataFrame, config: RankConfig) -> DataFrame:
    """(host, trust, distrust): personalised PageRank from (host, good, bad) seeds.

    Trust starts at hosts by their share of good pages and travels along links; distrust starts by the share of bad pages and travels against them, to those who
    link there. Both go in one table; a step is a join on the sender and a sum per receiver with partial aggregation, and every few steps are written
    to the shared folder. Scores that reach a host without links out of it end there.
    """
    good, bad = seeds.agg(F.sum("good"), F.sum("bad")).first()
    start = F.explode(F.array(
        F.struct(F.lit(True).alias("trust"), (F.col("good") / F.lit(float(good or 1))).alias("score")),
        F.struct(F.lit(False).alias("trust"), (F.col("bad") / F.lit(float(bad or 1))).alias("score")),
    )).alias("s")
    start = stored(seeds.select("host", start).select("host", "s.trust", "s.score").where("score > 0"), "seeds")
    both = links.select(F.lit(True).alias("trust"), "src", "dst", "weight").unionByName(
        links.select(F.lit(False).alias("trust"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    sums = both.groupBy("trust", "src").agg(F.sum("weight").alias("all"))
    edges = stored(both.join(sums, ["trust", "src"]).select("trust", "src", "dst", (F.col("weight") / F.col("all")).alias("part")), "host-links")
    again = start.select("host", "trust", ((1 - config.damping) * F.col("score")).alias("score"))
    now = start
    for step in range(1, config.steps + 1):
        sent = now.withColumnRenamed("host", "src").join(edges, ["trust", "src"])
        sent = sent.select(F.col("dst").alias("host"), "trust", (config.damping * F.col("score") * F.col("part")).alias("score"))
        now = sent.unionByName(again).groupBy("host", "trust").agg(F.sum("score").alias("score"))
        if step % config.cut == 0:
            now = stored(now, "scores")
    value = lambda wanted: F.sum(F.when(F.col("trust") == wanted, F.col("score")).otherwise(0.0))
    return now.groupBy("host").agg(value(True).alias("trust"), value(False).alias("distrust"))


def judged_pages(pages: DataFrame, rules: DataFrame, config: RankConfig = RankConfig(), key: str = "page_id") -> DataFrame:
    """One row per page: key, host, path, rule, verdict, trust, distrust.

    A page that a rule fits has the longest rule's verdict; the pages so judged are the seeds, each host by its counts. Any other page has its host's: block
    where distrust is above trust, else allow. Pages without a host (NULL url, no ``://``) and hosts that no score reaches are allowed. A NULL
    html has no links. Rows may repeat; keys are not looked at; an empty table gives an empty result.
    """
    host, path = url_parts(F.col("url"))
    parts = stored(pages.select(key, host.alias("host"), path.alias("path")), "urls")
    lists = stored(ruled(parts.select("host").distinct(), rules), "host-rules").withColumnRenamed("host", "_h")
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    first = F.get(fitting, F.lit(0))
    found = parts.join(lists, F.col("host") == F.col("_h"), "left").select(key, "host", "path", first["rule"].alias("rule"), first["verdict"].alias("ruled"))
    found = stored(found, "ruled")
    seeds = found.where("ruled is not null").groupBy("host").agg(
        F.sum((F.col("ruled") == "allow").cast("long")).alias("good"), F.sum((F.col("ruled") == "block").cast("long")).alias("bad")
    )
    links = stored(host_links(pages.select(host.alias("host"), "html"), config), "links")
    scores = stored(host_scores(links, stored(seeds, "host-seeds"), config), "host-scores").withColumnRenamed("host", "_h")
    out = found.join(scores, F.col("host") == F.col("_h"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    verdict = F.coalesce("ruled", F.when(distrust > config.ratio * trust, F.lit("block")).otherwise(F.lit("allow")))
    return out.select(key, "host", "path", "rule", verdict.alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def default_rules(pages: DataFrame) -> DataFrame:
    """The fixed rules as a table."""
    return pages.sparkSession.createDataFrame(list(RULES), "verdict string, host string, path string")
