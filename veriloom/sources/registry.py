"""Sources by name, prompts by hash, and reports of what is missing."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import settings


@dataclass(frozen=True)
class Source:
    """A source: where it belongs, how its windows are cut, and how raw records become utterances."""

    name: str
    jurisdiction: str
    parse: Callable[[DataFrame], DataFrame]
    window_days: int = 30
    calendar: str | None = None
    languages: tuple[str, ...] = ("en",)
    enabled: bool = True
    options: dict = field(default_factory=dict)


class Registry(dict):
    """Sources by name."""

    def add(self, source: Source) -> Source:
        if source.name in self:
            raise ValueError(f"source {source.name} is registered already")
        self[source.name] = source
        return source

    def chosen(self, names: list[str] | None = None) -> list[Source]:
        """Enabled sources, or the named ones; an unknown name is an error."""
        if names is None:
            return [s for s in self.values() if s.enabled]
        if unknown := [n for n in names if n not in self]:
            raise KeyError(f"unknown sources: {', '.join(unknown)}")
        return [self[n] for n in names]

    def parsed(self, raw: dict[str, DataFrame]) -> DataFrame:
        """Utterances of all sources, one after another."""
        frames = [self[n].parse(df).withColumn("source", F.lit(n)) for n, df in raw.items()]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out


def whole_range(spark: SparkSession, source: str, start: str, end: str) -> DataFrame:
    """One window for sources that ignore the ledger."""
    return spark.createDataFrame([(source, start, end)], "source string, s string, e string").select("source", F.to_date("s").alias("window_start"), F.to_date("e").alias("window_end"))


def config(folder: str, name: str) -> dict:
    """A file of settings, YAML or JSON."""
    return settings.read(next(p for p in (Path(folder, f"{name}.yaml"), Path(folder, f"{name}.json")) if p.exists()))


def prompt(path: str) -> tuple[str, str]:
    """A prompt and its SHA-256."""
    text = Path(path).read_text(encoding="utf-8")
    return text, hashlib.sha256(text.encode()).hexdigest()


def judge_model(judges: dict[str, dict], name: str) -> dict:
    """Model and parameters of a judge; an unknown name is an error."""
    if name not in judges:
        raise KeyError(f"unknown judge {name}; known: {', '.join(sorted(judges))}")
    return judges[name]


def unlinked(quotes: DataFrame) -> DataFrame:
    """Distinct jurisdiction and name of quotes without a speaker, sorted, as lines."""
    rows = quotes.where("speaker_id is null").select("jurisdiction", "speaker_display").distinct()
    return rows.orderBy("jurisdiction", "speaker_display").select(F.concat_ws("\t", "jurisdiction", "speaker_display").alias("value"))
