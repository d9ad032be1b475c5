"""A Spark session with the settings the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "veriloom", **settings: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; ``settings`` win (dots written as __)."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in settings.items()}
    return SparkSession.builder.appName(app).config(map=conf).getOrCreate()
