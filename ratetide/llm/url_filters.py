"""URL filter by rules and by trust that flows over links between hosts.

A rule such as ``example.org/es/`` fits its host and all subdomains where the
path starts with the rule's; the longest fitting rule decides.  Other pages get
their host's verdict: trust is a personalised PageRank from hosts that rules
mostly allow, distrust one over the reversed links from hosts that rules mostly
block (a host that links to blocked ones is suspect).  Rules judge a host by
its pages and, where these make it no seed (it may have none), by the linked
urls that lead to it from other hosts.  Each seed hands out one unit in all, over
the links out of a host (trust) or those into it (distrust), so both scores have
one scale and seeds elsewhere in the graph do not move a verdict.  A host is
blocked if its distrust exceeds ``threshold`` times its trust; without either it
is allowed.

Host and path are those of the text after the first ``://`` (A-Z of the host
lower-cased); a null url or one without ``://`` has both empty.  Links are
absolute or protocol-relative ``href`` values of a page; links to the own host
count for nothing, null pages have none.  Repeated pages count again, as links
and for the seeds.  DataFrame functions only.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, lower_ascii, quoted, written

ADDRESS = "(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = "(?i)\\shref\\s*=\\s*[\"']?\\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\\s>]+)"


@dataclass(frozen=True)
class Trust:
    """Parameters of the propagation."""

    damping: float = 0.85
    tolerance: float = 1e-6   # stop when scores change by less for each seed and no further host is reached
    seed_share: float = 0.5   # a host is a seed if rules give so large a share of its pages, or linked urls, one verdict
    threshold: float = 1.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, ADDRESS, 1)), F.regexp_extract(text, ADDRESS, 2)


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls.  ``rules`` is a
    short list of (verdict, "host/path"); of equal lengths a block comes first."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, host_col: str, html_col: str, rules: list[tuple[str, str]] = ()) -> DataFrame:
    """(src, dst, share, back_share, links, allowed, blocked): links between
    different hosts, as a share of all that leave ``src`` and of all that lead to
    ``dst``, and how many of their urls the rules allow or block."""
    found = pages.select(quoted(host_col).alias("src"), F.explode(F.regexp_extract_all(
        F.coalesce(quoted(html_col), F.lit("")), F.lit(LINK), F.lit(1))).alias("url"))
    dst = lower_ascii(F.regexp_extract("url", "//([^/?#]*)", 1))
    parts = found.select("src", dst.alias("dst"), F.regexp_extract("url", "//[^/?#]*([^?#]*)", 1).alias("path"))
    _, verdict = best_rule(F.col("dst"), F.col("path"), rules)
    counted = (parts.where("src <> '' and dst <> '' and src <> dst").select("src", "dst", verdict.alias("verdict"))
               .groupBy("src", "dst").agg(F.count("*").alias("links"), *(
                   F.count_if(F.col("verdict") == v).alias(name) for v, name in (("allow", "allowed"), ("block", "blocked")))))
    total = lambda side, name: counted.groupBy(side).agg(F.sum("links").alias(name))
    return counted.join(total("src", "left"), "src").join(total("dst", "come"), "dst").select(
        "src", "dst", (F.col("links") / F.col("left")).alias("share"), (F.col("links") / F.col("come")).alias("back_share"),
        "links", "allowed", "blocked")


def seed_hosts(hosts: DataFrame, links: DataFrame, share: float) -> DataFrame:
    """(host, verdict): hosts of which rules give ``share`` of the pages one
    verdict, or else of the linked urls."""
    made = lambda df, name, verdict: df.where(F.col(name) >= share).select("host", F.lit(verdict).alias("verdict"))
    both = lambda df: made(df, "allowed", "allow").unionByName(made(df, "blocked", "block"))
    by_page = both(hosts)
    linked = links.groupBy(F.col("dst").alias("host")).agg(*(
        (F.sum(x) / F.sum("links")).alias(x) for x in ("allowed", "blocked")))
    return by_page.unionByName(both(linked).join(by_page.select("host"), "host", "left_anti"))


def propagate(links: DataFrame, seeds: DataFrame, trust: Trust) -> DataFrame:
    """(host, score): the sum over all seed hosts of the personalised PageRank over
    (src, dst, share) that restarts at that seed.  Shares out of a host sum to 1;
    scores that reach hosts without links end there.  Rounds go on until scores
    change by less than the tolerance for each seed and all hosts that a seed
    leads to have one, however many links away.  A round is two shuffles of the
    host graph."""
    if not 0 <= trust.damping < 1 or trust.tolerance <= 0:
        raise ValueError("damping must be at least 0 and below 1, tolerance above 0")
    total = seeds.agg(F.count("*")).first()[0]
    scores = seeds.select("host", F.lit(1.0).alias("score"))
    if not total or links.isEmpty():
        return scores
    restart = seeds.select("host", F.lit(1 - trust.damping).alias("score"))
    for n in itertools.count(1):
        flow = (scores.join(links, scores["host"] == links["src"])
                .select(F.col("dst").alias("host"), (trust.damping * F.col("score") * F.col("share")).alias("score")))
        new = written(flow.union(restart).groupBy("host").agg(F.sum("score").alias("score")), "trust-scores")
        sides = new.select("host", "score", F.lit(1).alias("side")).union(
            scores.select("host", (-F.col("score")).alias("score"), F.lit(-1).alias("side")))
        change, reached = (sides.groupBy("host").agg(F.abs(F.sum("score")).alias("x"), F.sum("side").alias("new"))
                           .agg(F.sum("x"), F.sum("new")).first())
        scores = new
        # a round shrinks the change by the damping at least, but for rounding
        settled = change < trust.tolerance * total or 2 * trust.damping ** (n - 1) < trust.tolerance
        if settled and not reached:
            return scores


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], url_col: str = "url", html_col: str = "html",
               trust: Trust | None = None, out: str = "filter") -> DataFrame:
    """``pages`` with a struct column ``out`` (underscores are appended while the
    name is taken): host, path, rule, trust, distrust, verdict."""
    trust = trust or Trust()
    out, host_col, path_col, rule_col, by_rule = (free_name(pages, x) for x in (out, "host", "path", "rule", "by_rule"))
    host, path = host_and_path(quoted(url_col))
    parsed = pages.withColumn(host_col, host).withColumn(path_col, path)
    rule, verdict = best_rule(quoted(host_col), quoted(path_col), rules)
    ruled = parsed.withColumn(rule_col, rule).withColumn(by_rule, verdict)

    share = lambda v: F.avg(F.coalesce((quoted(by_rule) == v).cast("double"), F.lit(0.0)))
    hosts = written(ruled.groupBy(quoted(host_col).alias("host")).agg(share("allow").alias("allowed"), share("block").alias("blocked")), "trust-hosts")
    links = written(host_links(ruled, host_col, html_col, rules), "trust-links")
    seeds = written(seed_hosts(hosts, links, trust.seed_share), "trust-seeds")
    good = propagate(links, seeds.where("verdict = 'allow'").select("host"), trust)
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("back_share").alias("share"))
    bad = propagate(back, seeds.where("verdict = 'block'").select("host"), trust)
    scores = (hosts.select("host").join(good.withColumnRenamed("score", "trust"), "host", "left")
              .join(bad.withColumnRenamed("score", "distrust"), "host", "left").na.fill(0.0, ["trust", "distrust"]))
    at, good_col, bad_col = (free_name(ruled, x) for x in ("judged_host", "trust", "distrust"))
    joined = ruled.join(scores.toDF(at, good_col, bad_col), quoted(host_col) == quoted(at), "left")
    by_host = F.when(quoted(bad_col) > trust.threshold * quoted(good_col), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(*(quoted(c) for c in pages.columns), F.struct(
        quoted(host_col).alias("host"), quoted(path_col).alias("path"), quoted(rule_col).alias("rule"),
        quoted(good_col).alias("trust"), quoted(bad_col).alias("distrust"), F.coalesce(quoted(by_rule), by_host).alias("verdict")).alias(out))
