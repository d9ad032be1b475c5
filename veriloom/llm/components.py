"""Connected components of a table of links, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected(links: DataFrame) -> DataFrame:
    """node and the smallest node reachable from it, for every node of ``links`` (a, b).

    Each round points every node at the smallest root among its neighbours', then follows one
    pointer; it ends when nothing changes, as roots only fall.  Each round's table is written to the shared folder."""
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a is not null and b is not null").distinct(), "links")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")), "roots")
    while True:
        theirs = roots.select(F.col("node").alias("b"), F.col("root").alias("theirs"))
        low = both.join(theirs, "b").groupBy("a").agg(F.min("theirs").alias("theirs"))
        # The root of a node may itself have found a smaller one: tell it.
        near = roots.join(low.withColumnRenamed("a", "node"), "node").select("node", "root", F.least("root", "theirs").alias("new"))
        told = near.where("new < root").groupBy(F.col("root").alias("node")).agg(F.min("new").alias("told"))
        step = near.join(told, "node", "left").select("node", F.col("root").alias("old"), F.least("new", F.coalesce("told", "new")).alias("root"))
        up = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
        after = written(step.join(up, "root", "left").select("node", "old", F.coalesce("up", "root").alias("root")), "roots")
        if after.where("old <> root").isEmpty():
            return after.select("node", "root")
        roots = after.select("node", "root")
