"""Exact de-duplication by content sort, in DataFrame operations only.

Normalised texts are range-partitioned by sampled splitters (``repartitionByRange`` on the head of a
text, then its digest), sorted within partitions, and a window over the sorted rows compares each text
in full with its neighbour and keeps the smallest identifier of a run of equals.  The sort is external
(it spills), and the window needs no second exchange, since the range partitioning keeps equals
together.

A text whose copies would fill partitions (more than a share of all rows) is salted: its copies are
spread over several ranges by a salt, found by a count of digests that combines within tasks.  Each
range sorts and compares its copies like all others; then the few runs of a salted text are joined into
one group.  Fewer than HOT_SHARE texts can be hot whatever the input, which bounds both broadcasts.

Defined results: null counts as the empty text; doc_id null sorts after others and is kept only if
all of a group are null; rows that repeat in full count each, and one of them is kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import only, written

#: A text is hot if it has more than 1/HOT_SHARE of all rows; so there are fewer than this.
HOT_SHARE = 500
#: Ranges that a hot text is spread over for each 1/HOT_SHARE of the rows that it has.
SPREAD = 2
#: Characters of the text that splitters hold; texts with the same head are placed by digest.
HEAD = 32


def normalised(text: str = "text"):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    found = written(_sorted_runs(docs, only(docs, "doc_id", "text")).drop("row"), "runs")
    rows = _joined(found)
    return rows.select("doc_id", "keep_id", "group_size", ((F.col("run_rank") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that stay."""
    first = written(_sorted_runs(docs, docs).where("run_rank = 1"), "runs")
    return _joined(first).where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("row.*")


def _joined(rows: DataFrame) -> DataFrame:
    """keep_id and group_size of rows: those of their run, or of all runs of a salted text."""
    runs = rows.where("salted and run_rank = 1").groupBy(F.col("text_sha256").alias("salted_sha256"))
    whole = runs.agg(F.min("run_keep").alias("all_keep"), F.sum("run_size").alias("all_size"))  # fewer than HOT_SHARE rows
    out = rows.join(F.broadcast(whole), F.col("salted") & (F.col("text_sha256") == F.col("salted_sha256")), "left")
    return out.select(
        *rows.columns,
        F.when(F.col("salted"), F.col("all_keep")).otherwise(F.col("run_keep")).alias("keep_id"),
        F.when(F.col("salted"), F.col("all_size")).otherwise(F.col("run_size")).alias("group_size"),
    )


def _sorted_runs(docs: DataFrame, carried: DataFrame) -> DataFrame:
    """The carried columns of each row as ``row``, and of the run of equal texts in which it lies the
    smallest doc_id (run_keep), size and the row's place; ``salted`` texts have several runs."""
    base = carried.select(F.struct(*[F.col(f"`{c}`") for c in carried.columns]).alias("row"))
    norm = normalised("row.text")
    total = docs.count()
    # Pre-aggregated before its shuffle; at most HOT_SHARE rows pass the filter.
    hot = (
        base.groupBy(F.sha2(norm, 256).alias("hot_sha256"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > F.lit(total // HOT_SHARE + 1))
        .select("hot_sha256", F.ceil(F.col("copies") * F.lit(SPREAD * HOT_SHARE / max(1, total))).cast("int").alias("salts"))
    )
    salted = (
        base.withColumn("head", F.substring(norm, 1, HEAD))
        .withColumn("text_sha256", F.sha2(norm, 256))
        .join(F.broadcast(hot), F.col("text_sha256") == F.col("hot_sha256"), "left")
        .withColumn("salt", F.when(F.col("salts").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("row.doc_id"), F.col("salts")).cast("int")))
        .drop("salts", "hot_sha256")
    )
    # Splitters come from a sample of (head, digest, salt), which bounds what the driver sees of
    # long texts; equal texts with equal salt never part, and the window compares them in full.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = salted.repartitionByRange(parts, "head", "text_sha256", "salt")
    placed = placed.withColumn("norm", norm).withColumn("doc_id", F.col("row.doc_id"))
    equal = Window.partitionBy("head", "text_sha256", "salt", "norm")
    return placed.select(
        "row",
        "doc_id",
        "text_sha256",
        (F.col("salt") >= 0).alias("salted"),
        F.first("doc_id").over(equal.orderBy(F.col("doc_id").asc_nulls_last())).alias("run_keep"),
        F.row_number().over(equal.orderBy(F.col("doc_id").asc_nulls_last())).alias("run_rank"),
        F.count(F.lit(1)).over(equal).alias("run_size"),
    )
