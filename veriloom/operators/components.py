"""Connected components of a table of links, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import discard, scratch, written


def connected(links: DataFrame) -> DataFrame:
    """node and the smallest node reachable from it, for every node of ``links`` (a, b).

    A round first lets every node follow its root's pointer, then takes the smallest root among its
    neighbours, and tells its old root of it.  Roots only fall, so rounds end when nothing changes,
    after about the logarithm of the longest path.  Both sides of the joins on roots and on hubs are
    plain shuffles of written tables, which Spark splits where one key is hot; aggregations combine
    before their shuffle.  Each round's table is written, and the one before deleted."""
    spark = links.sparkSession
    ends = scratch(spark, "links")
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a is not null and b is not null").distinct(), "links", ends)
    path = scratch(spark, "roots")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")), "roots", path)
    while True:
        hop = roots.select(F.col("node").alias("root"), F.col("root").alias("up")).where("root <> up")
        jumped = roots.join(hop, "root", "left").select("node", F.col("root").alias("old"), F.coalesce("up", "root").alias("root"))
        theirs = jumped.select(F.col("node").alias("b"), F.col("root").alias("theirs"))
        low = both.join(theirs, "b").groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        near = jumped.join(low, "node").select("node", "old", "root", F.least("root", "theirs").alias("new"))
        told = near.where("new < root").groupBy(F.col("root").alias("node")).agg(F.min("new").alias("told"))
        step = near.join(told, "node", "left").select("node", "old", F.least("new", F.coalesce("told", "new")).alias("root"))
        now = scratch(spark, "roots")
        after = written(step, "roots", now)
        discard(spark, path)
        path, roots = now, after.select("node", "root")
        if after.where("old <> root").isEmpty():
            discard(spark, ends)
            return roots
