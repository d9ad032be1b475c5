"""Sorted arrays in the folder that all executors share, memory-mapped by their readers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mix64, per_group, scratch

#: Identifiers in one array, about.
SHARD_IDS = 1 << 20


def _local(url: str) -> str | None:
    parts = urlparse(url)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def save(url: str, name: str, array: np.ndarray) -> None:
    """Write an array under a final name at once, so that a task that runs twice does no harm."""
    folder = _local(url)
    if folder is not None:
        os.makedirs(folder, exist_ok=True)
        fd, tmp = tempfile.mkstemp(dir=folder, suffix=".part")
        with os.fdopen(fd, "wb") as f:
            np.save(f, array)
        os.replace(tmp, f"{folder}/{name}.npy")
    else:
        from pyarrow import fs

        where, path = fs.FileSystem.from_uri(url)
        where.create_dir(path, recursive=True)
        part = f"{path}/{name}-{uuid.uuid4().hex}.part"
        with where.open_output_stream(part) as f:
            np.save(f, array)
        where.move(part, f"{path}/{name}.npy")


def load(url: str, name: str) -> np.ndarray:
    """Memory-map an array of the shared folder (a copy of it where the folder is remote)."""
    folder = _local(url)
    if folder is None:
        from pyarrow import fs

        where, path = fs.FileSystem.from_uri(url)
        folder = os.path.join(tempfile.gettempdir(), f"arrays-{abs(hash(url))}")
        os.makedirs(folder, exist_ok=True)
        if not os.path.exists(f"{folder}/{name}.npy"):
            fd, tmp = tempfile.mkstemp(dir=folder)
            with os.fdopen(fd, "wb") as f, where.open_input_stream(f"{path}/{name}.npy") as g:
                while chunk := g.read(1 << 22):
                    f.write(chunk)
            os.replace(tmp, f"{folder}/{name}.npy")
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


# -- rows by identifier, without a shuffle of what they carry ----------------------------------------


def _shard(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def write_ids(ids: DataFrame, rows: int) -> tuple[str, int]:
    """Write the (non-null) identifiers of a one-column frame as sorted arrays; ``rows`` sets the
    number of shards.  Where they are, and the bits of a shard's name."""
    name = ids.columns[0]
    bits = max(1, (rows // SHARD_IDS).bit_length())
    url = scratch(ids.sparkSession, "ids")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(_shard(own, bits))], names=["id", "shard"])

    def put(t: pa.Table) -> pa.Table:
        own = np.unique(t.column("id").to_numpy())
        save(url, f"ids-{t.column('shard')[0].as_py()}", own)
        return pa.table({"n": pa.array([len(own)], pa.int64())})

    dealt = map_arrow(ids.where(F.col(name).isNotNull()).select(F.col(name).cast("long").alias("id")), deal, "id long, shard long")
    per_group(dealt, "shard", put, "n long").agg(F.sum("n")).first()
    return url, bits


@lru_cache(256)
def _mapped(url: str, name: str) -> np.ndarray | None:
    try:
        return load(url, name)
    except FileNotFoundError:
        return None


def among(ids: np.ndarray, url: str, bits: int) -> np.ndarray:
    """Which identifiers were written."""
    out = np.zeros(len(ids), bool)
    shard = _shard(ids, bits)
    for k in np.unique(shard).tolist():
        have = _mapped(url, f"ids-{k}")
        if have is not None and len(have):
            at = np.flatnonzero(shard == k)
            out[at] = have[np.minimum(np.searchsorted(have, ids[at]), len(have) - 1)] == ids[at]
    return out


def with_ids(docs: DataFrame, url: str, bits: int, name: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, with all columns, whose identifier was written or is null."""
    place = docs.columns.index(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                col = b.column(place)
                own = col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                keep = among(own, url, bits) | col.is_null().to_numpy(zero_copy_only=False)
                yield b.filter(pa.array(keep))

    return map_arrow(docs, run, docs.schema)
