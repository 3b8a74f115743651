"""URL filters by trust and distrust over the link graph of hosts.

Rules judge urls by host and path prefix; the longest that fits wins. Urls without a
rule get the verdict of their host, from the link graph: trust starts at hosts with
allowed pages (as the share of the host's pages) and follows links, a personalised
PageRank; distrust starts at hosts with blocked pages and runs against the links, so that who
links to bad hosts is distrusted. Both keep the walk's restart at the seeds:

    trust(v) = (1 - a) seed(v) + a x sum over links u -> v of trust(u) links(u, v) / links out of u
    distrust(u) = (1 - a) seed(u) + a x sum over links u -> v of distrust(v) links(u, v) / links into v

A link within a host, relative ones among them, is an edge to itself. It counts only where
the host has no other links on that side, so that such a host keeps its own share.

The scores shrink with each step and with the number of links into a host. To be
comparable from host to host, each is divided by the score of the same walk that starts at every host with
a judged page, allowed or blocked, with seed 1: what remains is the part of that walk's mass that
comes from trusted seeds, or from blocked ones, between 0 and 1. A host is blocked if
its part of distrust exceeds its part of trust by ``threshold`` or more. A host that no seed reaches has
neither, and is allowed. Links reach as far as ``rounds``.

Null urls and urls without ``://`` have an empty host and path; empty hosts take no part
in the graph and are allowed unless a rule fits. Null pages have no links. Repeated rows
count as often as they occur. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.tables import prepare, stored

SALTS = 32
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` to ``/``, ``?``, ``#`` or the end; path: on to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, CAPITALS, SMALL), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict (nulls if none); rules are (host, path, verdict)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for suffix, prefix, said in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(suffix + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """``src, dst, links``: links between hosts, those within a host as well."""
    targets = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""), F.lit(1))
    source = host_and_path(F.col(url))[0]
    target = F.when(F.col("link").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), host_and_path(F.col("link"))[0]) \
        .when(F.col("link").startswith("//"), host_and_path(F.concat(F.lit("x:"), F.col("link")))[0]) \
        .when(F.col("link").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit("")) \
        .otherwise(F.col("src"))
    # a page's links count by host before they leave it
    return pages.select(source.alias("src"), F.explode(targets).alias("link")).where("src != ''") \
        .select("src", target.alias("dst")).where("dst != ''").groupBy("src", "dst").agg(F.count("*").alias("links"))


def _spread(edges: DataFrame, seeds: DataFrame, seed: str, sender: str, receiver: str, share: str,
            rounds: int, kept: Column, weight: Column) -> DataFrame:
    """``host, score``: kept x seed + weight x what neighbours send over ``share``."""
    base = seeds.select("host", F.col(seed).alias("seed"), kept.alias("kept"), weight.alias("weight"))
    score = base.select("host", F.col("seed").alias("score"))
    sent = edges.select(F.col(sender).alias("host"), F.col(receiver).alias("to"), F.col(share).alias("part"))
    for k in range(rounds):
        arriving = sent.join(score, "host").groupBy(F.col("to").alias("host")).agg(F.sum(F.col("part") * F.col("score")).alias("more"))
        score = base.join(arriving, "host", "left").select(
            "host", (F.col("kept") * F.col("seed") + F.col("weight") * F.coalesce("more", F.lit(0.0))).alias("score"))
        if k % 4 == 3:
            score = stored(score, "scores")
    return score


def host_scores(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", html: str = "html",
                damping: float = 0.5, rounds: int = 12) -> DataFrame:
    """``host, trust, distrust, good, bad`` for every host of a page or of a link; ``good`` and ``bad`` are
    the parts of trust and distrust in what all judged seeds send."""
    prepare(pages.sparkSession)
    host, path = host_and_path(F.col(url))
    seen = pages.select(host.alias("host"), matching_rule(host, path, rules)[1].alias("said")).where("host != ''") \
        .groupBy("host").agg(F.count("*").alias("pages"),
                             F.sum(F.when(F.col("said") == "allow", 1.0).otherwise(0.0)).alias("allowed"),
                             F.sum(F.when(F.col("said") == "block", 1.0).otherwise(0.0)).alias("blocked"))
    links = host_links(pages, url, html)
    # a host without links keeps what it has
    loops = seen.select(F.col("host").alias("src"), F.col("host").alias("dst"), F.lit(0).cast("long").alias("links"))
    links = stored(links.union(loops).groupBy("src", "dst").agg(F.sum("links").alias("links")), "hostlinks")
    ends = links.select("src").union(links.select("dst")).distinct().withColumnRenamed("src", "host")
    seeds = stored(ends.join(seen, "host", "left").select(
        "host", F.coalesce(F.col("allowed") / F.col("pages"), F.lit(0.0)).alias("allowed"),
        F.coalesce(F.col("blocked") / F.col("pages"), F.lit(0.0)).alias("blocked"),
        F.when(F.col("allowed") + F.col("blocked") > 0, 1.0).otherwise(0.0).alias("judged")), "seeds")
    across = F.when(F.col("src") != F.col("dst"), F.col("links")).otherwise(0)
    outs = links.groupBy("src").agg(F.sum(across).alias("outs"))
    ins = links.groupBy("dst").agg(F.sum(across).alias("ins"))
    # a link within a host counts where it has no others
    part = lambda total: F.when(F.col(total) > 0, across / F.col(total)).otherwise(F.lit(1.0))
    # trust is dealt out over the sender's links out, distrust over the links into the host it leaves
    edges = stored(links.join(outs, "src").join(ins, "dst").select(
        "src", "dst", part("ins").alias("of_in"), part("outs").alias("of_out")), "edges")
    kept, weight = F.lit(1 - damping), F.lit(damping)
    trust = _spread(edges, seeds, "allowed", "src", "dst", "of_out", rounds, kept, weight).withColumnRenamed("score", "trust")
    distrust = _spread(edges, seeds, "blocked", "dst", "src", "of_in", rounds, kept, weight).withColumnRenamed("score", "distrust")
    sent = _spread(edges, seeds, "judged", "src", "dst", "of_out", rounds, kept, weight).withColumnRenamed("score", "sent")
    back = _spread(edges, seeds, "judged", "dst", "src", "of_in", rounds, kept, weight).withColumnRenamed("score", "back")
    part = lambda score, whole: F.when(F.col(whole) > 0, F.col(score) / F.col(whole)).otherwise(F.lit(0.0))
    return trust.join(distrust, "host").join(sent, "host").join(back, "host").select(
        "host", "trust", "distrust", part("trust", "sent").alias("good"), part("distrust", "back").alias("bad"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url", html: str = "html",
          threshold: float = 0.5, damping: float = 0.5, rounds: int = 12) -> DataFrame:
    """``key, host, path, rule, verdict, trust, distrust`` for each row."""
    scores = stored(host_scores(pages, rules, url, html, damping, rounds), "hosts")
    host, path = host_and_path(F.col(url))
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    # one host may have a third of all pages: its pages are dealt over salts
    dealt = scores.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = pages.select(F.col(key).alias("id"), host.alias("host"), path.alias("path"), F.col(url).alias("url_")) \
        .withColumn("salt", F.pmod(F.xxhash64("id", "url_"), F.lit(SALTS)).cast("int"))
    return rows.join(dealt, ["host", "salt"], "left").select(
        F.col("id").alias(key), "host", "path", rule.alias("rule"),
        F.coalesce(said, F.when(F.col("bad") - F.col("good") >= threshold, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
