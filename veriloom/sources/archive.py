"""Content-addressed archive and fetch cache."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stored(archive: DataFrame | None, blobs: DataFrame) -> DataFrame:
    """source, sha256, content: new blobs once each, known ones not again."""
    rows = blobs.select("source", F.sha2("content", 256).alias("sha256"), "content").dropDuplicates(["source", "sha256"])
    return rows if archive is None else archive.unionByName(rows.join(archive.select("source", "sha256"), ["source", "sha256"], "left_anti"))


def loaded(archive: DataFrame, keys: DataFrame) -> DataFrame:
    """The content of (source, sha256) keys; null where there is none."""
    return keys.join(archive, ["source", "sha256"], "left")


def cached(fetches: DataFrame, archive: DataFrame) -> DataFrame:
    """The newest good fetch of each (source, url) whose content is kept."""
    good = fetches.where("status_code = 200 and content_sha256 is not null").join(archive.select("source", F.col("sha256").alias("content_sha256")), ["source", "content_sha256"], "left_semi")
    return good.groupBy("source", "url").agg(F.max_by("content_sha256", F.struct("fetched_at", "id")).alias("content_sha256"))


def failures(fetches: DataFrame) -> DataFrame:
    """Fetches without a status and why."""
    return fetches.where("status_code is null").select("source", "url", "note")


@F.pandas_udf(T.StringType())
def decoded(content: pd.Series, declared: pd.Series) -> pd.Series:
    """Text by the declared charset, else UTF-8, else Latin-1."""

    def one(raw, name):
        if raw is None:
            return None
        for enc in (name, "utf-8"):
            try:
                codecs.lookup(enc)
                return bytes(raw).decode(enc)
            except (LookupError, UnicodeDecodeError, TypeError):
                pass
        return bytes(raw).decode("utf-8", "replace")

    return pd.Series([one(c, d) for c, d in zip(content, declared, strict=True)])
