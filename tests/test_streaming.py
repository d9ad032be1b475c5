from pyspark.sql import functions as F

from veriloom.operators.keywords import TermList
from veriloom.streaming import matches


def test_scan_stream(spark, tmp_path):
    schema = "id long, source string, native_id string, version_hash string, seq int, text string, language string, at timestamp"
    rows = [(1, "s", "n", "v", 0, "the AI act", "en"), (2, "s", "n", "v", 0, "the AI act", "en"), (3, "s", "m", "v", 0, "nothing", "en")]
    df = spark.createDataFrame([(*r, None) for r in rows], schema).withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = matches.matched(matches.utterance_stream(spark, str(tmp_path / "in"), schema), [TermList("en", ("AI",))], "at")
    q = matches.write(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
