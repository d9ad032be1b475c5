"""Incremental coverage: windows to fetch, what is done, versions of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import without_controls


def tiles(spans: DataFrame, days: int) -> DataFrame:
    """Windows of ``days`` days over each source's (source, start, end) span."""
    rows = spans.select("source", "end", F.explode(F.sequence(F.col("start"), F.col("end"), F.expr(f"interval {days} days"))).alias("window_start"))
    return rows.select("source", "window_start", F.least(F.date_add("window_start", days - 1), F.col("end")).alias("window_end"))


def calendar_tiles(spans: DataFrame, unit: str) -> DataFrame:
    """Windows that end with each month or year."""
    step, last = ("1 month", F.last_day("t")) if unit == "month" else ("1 year", F.date_sub(F.add_months("t", 12), 1))
    rows = spans.select("source", "start", "end", F.explode(F.sequence(F.trunc("start", unit), F.trunc("end", unit), F.expr(f"interval {step}"))).alias("t"))
    return rows.select("source", F.greatest("t", "start").alias("window_start"), F.least(last, F.col("end")).alias("window_end"))


def lagged(windows: DataFrame, today: Column, lag: int = 0, rolling: int | None = None) -> DataFrame:
    """Without windows that end within ``lag`` days, or lie before the rolling span."""
    out = windows.where(F.col("window_end") <= F.date_sub(today, lag))
    return out if rolling is None else out.where(F.col("window_start") >= F.date_sub(today, rolling))


def open_windows(planned: DataFrame, ledger: DataFrame) -> DataFrame:
    """Planned windows that are not done with exactly their bounds."""
    done = ledger.where("status = 'done'").select("source", "window_start", "window_end")
    return planned.join(done, ["source", "window_start", "window_end"], "left_anti")


def marked(ledger: DataFrame, news: DataFrame) -> DataFrame:
    """One row for each window: the newest."""
    w = Window.partitionBy("source", "window_start", "window_end").orderBy(F.col("updated_at").desc())
    return ledger.unionByName(news).withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def version(content: Column) -> Column:
    return F.substring(F.sha2(content, 256), 1, 16)


def new_versions(docs: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming (source, native_id, content) whose version is not known yet, once each."""
    rows = incoming.withColumn("version_hash", version(F.col("content"))).dropDuplicates(["source", "native_id", "version_hash"])
    return rows.join(docs.select("source", "native_id", "version_hash"), ["source", "native_id", "version_hash"], "left_anti")


def upserted_utterances(old: DataFrame, new: DataFrame) -> DataFrame:
    """By (document_id, seq): text, speaker and context of the newer, all else of the older."""
    key, over = ["document_id", "seq"], ["text", "speaker_raw", "speech_context"]
    n = new.withColumn("text", without_controls(F.col("text")))
    both = old.alias("o").join(n.alias("n"), key, "full")
    seen_n = F.col("n.text").isNotNull()
    seen_o = F.col("o.text").isNotNull()
    cols = [F.when(seen_n if c in over else ~seen_o, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in old.columns if c not in key]
    return both.select(*key, *cols)
