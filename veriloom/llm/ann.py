"""Nearest neighbours by a block matrix join.

Vectors are packed into blocks of int8 codes with one scale for each vector.  A tile is a block of
queries against a block of candidates: one integer matrix product (in float32, where these integers
are exact) gives the distances between codes, and the known lengths of the quantisation errors
bound the true distance from both sides.  Pairs whose lower bound is not beyond the k-th smallest
upper bound survive; they are recomputed in double precision from the original vectors, and the
best of a query's tiles meet in heaps.  Bounds drop nothing that could be among the nearest, so the
result is exact.

Defined results: vectors that are null, zero, of another dimension than most, or that hold null or
non-finite components take no part; with fewer than k candidates all are returned; ties go to the
smaller identifier; rows that repeat count each, but a query's own identifier is never its
neighbour; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, only, per_group, written

#: Vectors in a block; a tile holds BLOCK * QUERY_BLOCK distances.
BLOCK = 2048
QUERY_BLOCK = 512
#: Candidates that meet in one task of the last merge, about.
MERGED = 400_000

_PACKED = "ids binary, codes binary, vectors binary"


def _usable(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    v = F.col(embedding).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    return df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null").where(fine).where(some)


def _blocks(vectors: DataFrame, rows: int, dim: int) -> DataFrame:
    """Rows of at most ``rows`` vectors each: identifiers, int8 codes and the originals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        rest: list[np.ndarray] = []
        have = 0

        def flush(everything: bool):
            nonlocal ids, rest, have
            i, m = np.concatenate(ids), np.concatenate(rest)
            at = 0
            while have - at >= rows or (everything and at < have):
                part, own = i[at : at + rows], m[at : at + rows]
                code, _, _ = quantise(own)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (part, code, own)], names=["ids", "codes", "vectors"])
                at += rows
            ids, rest, have = [i[at:]], [m[at:]], max(0, have - at)

        for b in batches:
            if b.num_rows:
                ids.append(b.column("vec_id").to_numpy(zero_copy_only=False))
                rest.append(b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                have += b.num_rows
                if have >= rows:
                    yield from flush(False)
        if have:
            yield from flush(True)

    return map_arrow(vectors.where(F.size("v") == dim), run, _PACKED)


def quantise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and the lengths of what the codes leave out."""
    scale = np.abs(m).max(1) / 127.0
    code = np.rint(m / scale[:, None]).astype(np.int8)
    return code, scale, np.sqrt(((m - code * scale[:, None]) ** 2).sum(1))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, summed dimension by dimension in double precision."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        x = a[:, d] - b[:, d]
        total += x * x
    return np.sqrt(total)


def tile(qid: np.ndarray, q: np.ndarray, qcode: np.ndarray, cid: np.ndarray, c: np.ndarray, ccode: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, distance) of pairs that can be among a query's k nearest here,
    with true distances."""
    qs, cs = np.abs(q).max(1) / 127.0, np.abs(c).max(1) / 127.0
    qe = np.sqrt(((q - qcode * qs[:, None]) ** 2).sum(1))
    ce = np.sqrt(((c - ccode * cs[:, None]) ** 2).sum(1))
    dot = (qcode.astype(np.float32) @ ccode.astype(np.float32).T).astype(np.float64)
    qn = (qcode.astype(np.float64) ** 2).sum(1) * qs**2
    cn = (ccode.astype(np.float64) ** 2).sum(1) * cs**2
    near = np.sqrt(np.maximum(0.0, qn[:, None] + cn[None, :] - 2.0 * dot * qs[:, None] * cs[None, :]))
    # Rounding of these few double operations is far below this allowance.
    slack = qe[:, None] + ce[None, :] + 1e-7 * (np.sqrt(qn)[:, None] + np.sqrt(cn)[None, :])
    upper = near + slack
    upper[qid[:, None] == cid[None, :]] = np.inf
    kth = np.partition(upper, k - 1, axis=1)[:, k - 1] if len(cid) > k else np.full(len(qid), np.inf)
    keep = (near - slack <= kth[:, None]) & (qid[:, None] != cid[None, :])
    i, j = np.nonzero(keep)
    return i, j, distances(q[i], c[j])


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest candidates."""
    schema = "query_id long, rank int, vec_id long, score double"
    cands = _usable(only(candidates, vec_id, embedding), vec_id, embedding)
    asks = _usable(only(queries, vec_id, embedding), vec_id, embedding)
    # The dimension of most vectors: one aggregated row for each dimension.
    dims = cands.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims:
        return queries.sparkSession.createDataFrame([], schema)
    dim = dims[0]["d"]
    # Written once, so that pairing blocks reads them and quantises nothing again.
    left = written(_blocks(asks, QUERY_BLOCK, dim).select(F.col("ids").alias("q_ids"), F.col("codes").alias("q_codes"), F.col("vectors").alias("q_vectors")), "queries")
    right = written(_blocks(cands, BLOCK, dim), "candidates")

    def best_of(i: np.ndarray, v: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((v, s, i))
        i, v, s = i[order], v[order], s[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        return i[keep], v[keep], s[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tiles of one block of queries follow each other, and keep k candidates a query together.
        now, held = None, None

        def told() -> pa.RecordBatch:
            qid = np.frombuffer(now, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(qid[held[0]]), pa.array(held[1]), pa.array(held[2])], names=["query_id", "vec_id", "score"])

        for b in batches:
            for row in range(b.num_rows):
                take = lambda n, kind, w, row=row, b=b: np.frombuffer(b.column(n)[row].as_buffer(), kind).reshape(-1, w)
                block = b.column("q_ids")[row].as_py()
                if now is not None and block != now:
                    yield told()
                    held = None
                now = block
                qid, cid = take("q_ids", np.int64, 1)[:, 0], take("ids", np.int64, 1)[:, 0]
                i, j, score = tile(qid, take("q_vectors", np.float64, dim), take("q_codes", np.int8, dim), cid, take("vectors", np.float64, dim), take("codes", np.int8, dim), k)
                more = (i, cid[j], score)
                held = best_of(*more) if held is None else best_of(*(np.concatenate(x) for x in zip(held, more, strict=True)))
        if now is not None:
            yield told()

    # Blocks against blocks: the number of tiles, not of pairs.
    found = map_arrow(left.crossJoin(right), run, "query_id long, vec_id long, score double")
    parts = max(1, left.count() * max(1, right.rdd.getNumPartitions()) * QUERY_BLOCK * k // MERGED)
    few = found.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)))

    def merge(t: pa.Table) -> pa.Table:
        heaps: dict[int, list] = {}
        for q, v, s in zip(t.column("query_id").to_pylist(), t.column("vec_id").to_pylist(), t.column("score").to_pylist(), strict=True):
            heap = heaps.setdefault(q, [])
            item = (-s, -v)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
        rows = [(q, r, -v, -s) for q, heap in heaps.items() for r, (s, v) in enumerate(sorted(heap, reverse=True), 1)]
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        return pa.table([pa.array(list(c), kind) for c, kind in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "rank", "vec_id", "score"])

    return per_group(few, "part", merge, schema)
