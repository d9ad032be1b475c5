"""Joins of the pipeline that are not tied to one stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spine(candidates: DataFrame, utterances: DataFrame, documents: DataFrame) -> DataFrame:
    """Candidates with their utterance and document."""
    u = utterances.withColumnRenamed("id", "utterance_id")
    d = documents.withColumnRenamed("id", "document_id").withColumnRenamed("language", "doc_language").drop("meta")
    return candidates.join(u, "utterance_id").join(d, "document_id")


def export_spine(quotes: DataFrame, speakers: DataFrame, adjudications: DataFrame, spined: DataFrame, fetches: DataFrame) -> DataFrame:
    """Quotes with speaker, verdict, record and fetch; the fetch is the document's or else the one
    that the utterance's meta names (J02)."""
    fetch = F.coalesce(F.col("raw_fetch_id"), F.get_json_object("meta", "$.raw_fetch_id").cast("long"))
    rows = quotes.join(speakers, "speaker_id", "left").join(adjudications.select(F.col("id").alias("adjudication_id"), "verdict"), "adjudication_id").join(spined.withColumnRenamed("id", "candidate_id"), "candidate_id")
    return rows.withColumn("fetch_id", fetch).join(fetches.select(F.col("id").alias("fetch_id"), "fetched_at", "content_sha256"), "fetch_id", "left")


def absent(rows: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
    """Rows without a partner."""
    return rows.join(others.select(*on), on, "left_anti")


def present(rows: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
    """Rows with a partner."""
    return rows.join(others.select(*on), on, "left_semi")


def latest(rows: DataFrame, log: DataFrame, on: list[str], value: str, by: str, default: str) -> DataFrame:
    """The newest value of each key, or a default."""
    newest = log.groupBy(*on).agg(F.max_by(value, by).alias(value))
    return rows.join(newest, on, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def sibling_rank(rows: DataFrame, among: list[str], order: list[Column]) -> DataFrame:
    """1-based rank among siblings, and how many there are."""
    w = Window.partitionBy(*among)
    return rows.withColumn("rank", F.row_number().over(w.orderBy(*order))).withColumn("n_siblings", F.count(F.lit(1)).over(w))


def superseded(docs: DataFrame, key: Column, provisional: Column) -> DataFrame:
    """Provisional rows whose business key a final row has."""
    named = docs.withColumn("business_key", key)
    final = named.where(~provisional).select("business_key").distinct()
    return named.where(provisional).join(final, "business_key", "left_semi")


def other_versions(utterances: DataFrame, documents: DataFrame, candidates: DataFrame, keep: DataFrame) -> DataFrame:
    """Utterances of versions that ``keep`` (document_id) leaves out and no candidate refers to."""
    old = documents.select(F.col("id").alias("document_id")).join(keep, "document_id", "left_anti")
    return utterances.join(old, "document_id", "left_semi").join(candidates.select(F.col("utterance_id").alias("id")), "id", "left_anti")


def exploded(rows: DataFrame, values: str, name: str) -> DataFrame:
    """A row for each value of an array."""
    return rows.withColumn(name, F.explode(values)).drop(values)


def first_hit(rows: DataFrame, listed: DataFrame, equal: list[str], on: Column, key: str, order: str) -> DataFrame:
    """The first listed entry that fits, for each row (J22, P02).  ``equal`` are columns that both sides
    share (a document, a jurisdiction): the condition is tested within them only."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.join(listed, equal).where(on).withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def unique_hit(rows: DataFrame, listed: DataFrame, equal: list[str], on: Column, key: str, tie: Column) -> DataFrame:
    """The only entry that fits, else the only one that passes the tie-break, else none."""
    hits = rows.join(listed, equal).where(on)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    m = F.sum(tie.cast("int")).over(Window.partitionBy(key))
    return hits.withColumn("n", n).withColumn("m", m).where((F.col("n") == 1) | ((F.col("m") == 1) & tie)).drop("n", "m")


def first_seen(frames: list[DataFrame], key: list[str], order: str) -> DataFrame:
    """Rows of several result lists, each key once: from the first list, and there the first."""
    every = [f.withColumn("list_no", F.lit(i)) for i, f in enumerate(frames)]
    out = every[0]
    for f in every[1:]:
        out = out.unionByName(f)
    w = Window.partitionBy(*key).orderBy("list_no", order)
    return out.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def capped(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows, and whether there were more."""
    first = rows.orderBy(*order).limit(n + 1).withColumn("place", F.row_number().over(Window.orderBy(*order)))
    more = F.max("place").over(Window.partitionBy()) > n
    return first.withColumn("truncated", more).where(F.col("place") <= n).drop("place")
