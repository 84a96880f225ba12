"""Connected components of an edge table: min-label propagation with pointer jumping, all in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, frequent, hot_join, stored


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long), each once in any direction -> (node long, root long); root is the smallest
    node of its component. Every round takes the least label around each node, then that label's own
    label, so rounds grow with the logarithm of the longest path. No table reaches the driver; what is
    reread each round is written to the shared folder. Nodes with very many neighbours and labels of very
    many nodes are looked up by broadcast (see hot_join), so no task reads all rows of one. Null ends are
    dropped; no edges: no rows."""
    e = edges.where("a is not null and b is not null and a <> b")
    both = stored(e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    first = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"), F.count("*").alias("n")), "nodes")
    hubs = frequent(first, "node", "n")
    label = stored(first.select("node", F.least("node", "low").alias("root")), "labels")
    spark = edges.sparkSession
    while True:
        near = hot_join(both, "b", label, "node", hubs).groupBy("a").agg(F.min("root").alias("low"))
        took = stored(label.join(near, label["node"] == near["a"]).select("node", F.col("root").alias("was"), F.least("root", "low").alias("root")), "labels")
        large = frequent(took.groupBy("root").agg(F.count("*").alias("n")), "root", "n")
        up = took.select(F.col("node").alias("up_node"), F.col("root").alias("up_root"))
        new = stored(hot_join(took, "root", up, "up_node", large).select("node", "was", F.least("root", F.coalesce("up_root", "root")).alias("root")), "labels")
        dropped(spark, label, took)
        label = new.select("node", "root")
        if new.where("was <> root").isEmpty():
            dropped(spark, both, first)
            return label
