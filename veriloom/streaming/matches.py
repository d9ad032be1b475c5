"""The scan as a stream: new utterance files, matched without state, versions once (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keywords import TermList, candidates


def utterance_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def matched(stream: DataFrame, lists: list[TermList], event_time: str, delay: str = "1 day") -> DataFrame:
    """Candidates of a stream; a version seen again within the delay is dropped."""
    once = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["source", "native_id", "version_hash", "seq"])
    return candidates(once, lists)


def windowed_counts(stream: DataFrame, event_time: str, width: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Candidates by source and window of event time."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), "source").count()


def write(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
