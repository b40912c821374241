"""Connected components of an edge table, by alternating stars.

Every round makes the large stars (each vertex links its larger neighbours to its smallest)
and the small ones (each links itself and its smaller neighbours to the smallest).  The
number of edges never grows, hubs are summed before the shuffle, and nothing leaves Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretrail.llm.common import drop_written, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written, so that the join below meets plain shuffles and a hub's edges can be split
    least = written(both.groupBy("a").agg(F.min("b").alias("m")), "least")
    return (edges.withColumnsRenamed({"a": "lo", "b": "hi"})
            .join(least.withColumnRenamed("a", "lo"), "lo")
            .select(F.least("lo", "m").alias("a"), F.col("hi").alias("b"))
            .where("a <> b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    return (edges.join(least, "b")
            .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")),
                                      F.struct(F.least("m", "a").alias("a"), F.greatest("m", "a").alias("b")))).alias("e"))
            .select("e.*").where("a <> b"))


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of ``edges`` (columns a < b); component: its
    smallest vertex.  An empty table gives none."""
    now = written(edges.distinct(), "edges")
    while True:
        wide = written(_large_star(now).distinct(), "edges")
        after = written(_small_star(wide).distinct(), "edges")
        print_ = lambda t: t.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        done = print_(now) == print_(after)
        drop_written(wide)
        drop_written(now)
        now = after
        if done:
            break
    return (now.select(F.col("b").alias("vertex"), F.col("a").alias("component"))
            .unionByName(now.select(F.col("a").alias("vertex"), F.col("a").alias("component")).distinct()))
