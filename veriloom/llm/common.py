"""Plumbing shared by the operators: table access, shared storage, Arrow mapping."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import scratch, written  # noqa: F401  (for the operators)

#: Characters that one Python call works on; bounds the memory of the array kernels.
BATCH_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns; other columns, whatever they are called, take no part."""
    return df.select(*[F.col(f"`{n}`") for n in names])


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(), f"{base}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join(base, os.path.relpath(full, root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``chars`` bytes of text; one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        if col.offset:
            col = pa.concat_arrays([col])
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        ends = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[: batch.num_rows + 1]
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, int(ends[at]) + chars, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """Whole texts; null counts as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_R = 0x9E3779B97F4A7C15 | 1
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^i and r^-i modulo 2^64 for i < n."""
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 2 * len(_powers[0]), 1 << 20)
        made = []
        for r in (_R, pow(_R, -1, 1 << 64)):
            p = np.full(n, r, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        _powers = (made[0], made[1])
    return _powers


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of values[s:e] for all ranges, by prefix sums modulo 2^64."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * down[: len(values)], out=total[1:])
    h = (total[ends] - total[starts]) * up[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def per_group(df: DataFrame, key: str, fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """One call of ``fn`` for each value of ``key``; callers bound what shares a value."""
    ship(df.sparkSession)
    return df.groupBy(key).applyInArrow(fn, schema)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of other than ASCII white space, A-Z in lower case) of
    all texts end to end, and where each text's words begin (and the end)."""
    raw = [t.encode() for t in texts]
    joined = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    firsts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=firsts[1:])
    white = _SPACE[joined]
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    if len(white) and not white[0]:
        edge = np.append(0, edge)
    starts, ends = edge[::2], edge[1::2]
    return range_hashes(_LOWER[joined], starts, ends), np.searchsorted(starts, firsts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
