"""URL filters: longest rule first, else trust and distrust that travel along host links.

Trust starts at hosts whose pages the rules mostly allow and follows links; distrust starts at
hosts mostly blocked and follows links backwards.  Both are personalised PageRanks over host
edges, computed by joins and sums in Spark.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretrail.llm.common import drop_written, staging, written

#: (verdict, host/path): a configuration list; the longest that fits wins.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DAMPING = 0.85
#: Share of a host's pages that rules must allow (block) to make it a seed.
SEED_SHARE = 0.5
#: Distrust, as a multiple of one seed's start, from which a host that isn't trusted more is blocked.
THRESHOLD = 0.1
#: Change of all ranks together, of one round, from which on nothing changes.
CLOSE = 1e-6
_ABSOLUTE = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def lowered(host: Column) -> Column:
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    has = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(has, lowered(host)).otherwise(""), F.when(has, path).otherwise("")


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        of, _, start = rule.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith("/" + start)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n) of the absolute links in the pages; a host's links to itself don't count."""
    host, _ = host_and_path(F.col(url_col).cast("string"))
    links = F.regexp_extract_all(F.col(html_col).cast("string"), F.lit(_ABSOLUTE), F.lit(1))
    return (pages.select(host.alias("src"), F.explode(F.array_distinct(F.transform(links, lowered))).alias("dst"))
            .where((F.col("src") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count("*").alias("n")))


def propagated(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) in multiples of one seed's start.  ``seeds``: host, trusted,
    blocked (booleans).  Both rankings move in the same passes until nothing changes; what
    reaches a host without links ends there.  The sum of the changes shrinks by the damping in
    each round, so what is left after the last is bounded, wherever it may meet."""
    if not 0 <= damping < 1:
        raise ValueError(f"damping {damping} is not from 0 to below 1")
    with staging() as keep:
        # written, so that the joins meet plain shuffles and the edges of a hub can be split
        edges = written(edges, "links")
        out = written(edges.groupBy("src").agg(F.sum("n").alias("n_out")), "onward")
        back = written(edges.groupBy("dst").agg(F.sum("n").alias("n_in")), "back")
        weighed = written(edges.join(out, "src").join(back, "dst")
                          .select("src", "dst", (F.col("n") / F.col("n_out")).alias("onward"), (F.col("n") / F.col("n_in")).alias("back")), "edges")
        start = written(seeds.where("trusted or blocked").select("host", (F.col("trusted").cast("double") * (1 - damping)).alias("trust"),
                                                                 (F.col("blocked").cast("double") * (1 - damping)).alias("distrust")), "seeds")
        now, done, most = start, 0, math.inf
        while True:
            forth = weighed.join(now.withColumnRenamed("host", "src"), "src").select(
                F.col("dst").alias("host"), (F.col("trust") * F.col("onward") * damping).alias("trust"), F.lit(0.0).alias("distrust"))
            backward = weighed.join(now.withColumnRenamed("host", "dst"), "dst").select(
                F.col("src").alias("host"), F.lit(0.0).alias("trust"), (F.col("distrust") * F.col("back") * damping).alias("distrust"))
            after = written(start.unionByName(forth).unionByName(backward)
                            .groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "ranks")
            moved = (after.select("host", "trust", "distrust")
                     .unionByName(now.select("host", (-F.col("trust")).alias("trust"), (-F.col("distrust")).alias("distrust")))
                     .groupBy("host").agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d"))
                     .agg(F.greatest(F.sum(F.abs("t")), F.sum(F.abs("d")))).first()[0]) or 0.0
            if now is not start:
                drop_written(now)
            now = after
            done += 1
            if moved < CLOSE:
                break
            if done == 1:
                most = 5 + math.ceil(math.log(CLOSE / moved) / math.log(damping))
            if not done < most:
                raise RuntimeError(f"ranks still move by {moved} after {done} rounds")
        keep(now)
    return now.select("host", (F.col("trust") / (1 - damping)).alias("trust"), (F.col("distrust") / (1 - damping)).alias("distrust"))


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
           rules: Sequence[tuple[str, str]] = RULES, threshold: float = THRESHOLD, damping: float = DAMPING) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row.

    The verdict is the rule's; without a rule, a page is blocked if its host's distrust
    reaches the threshold and exceeds its trust.  Null or odd urls have an empty host and
    path and no trust either way; null html has no links; repeated rows are judged alike
    (and weigh in the seeds as often as they occur).
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = (pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
            .withColumn("found", matched_rule(F.col("host"), F.col("path"), rules)))
    ruled = F.col("found.verdict")
    seeds = (rows.where("host <> ''").groupBy("host")
             .agg(F.avg(F.coalesce(ruled == "allow", F.lit(False)).cast("int")).alias("allowed"),
                  F.avg(F.coalesce(ruled == "block", F.lit(False)).cast("int")).alias("refused"))
             .select("host", (F.col("allowed") >= SEED_SHARE).alias("trusted"), (F.col("refused") > SEED_SHARE).alias("blocked")))
    ranks = propagated(host_edges(pages, url_col, html_col), seeds, damping)
    trust, distrust = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust"))
    own = F.when((distrust >= threshold) & (distrust > trust), "block").otherwise("allow")
    return rows.join(ranks, "host", "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce(ruled, own).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"))
