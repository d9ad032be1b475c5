"""Best-fit packing of tokenised documents into sequences of bounded length.

*Vector best-fit*: a sequence has residual capacities of tokens, of documents and of attention
cost (the sum of squared piece lengths).  Pieces go in by falling length; each takes, of the
sequences that can hold it under every constraint, the one with the smallest weighted norm of the
residual after placement, or the largest weighted dot product of residual and size.  Under the norm a
sequence that is the best for one length stays the best until it is full, as its residual only shrinks;
so pieces of equal length fill the ranked sequences in turn, which costs one array operation for each
length.  A dot product falls as a sequence fills, so under that rule pieces are placed one by one, from
a heap of the sequences that can hold the length.

Pieces are dealt by hash into groups of about GROUP_PIECES, at every size alike, and each group is
packed on its own; a group wastes less than one sequence more than packing all together would.

Defined results: null text counts as empty (its only id is the end id); rows that repeat are packed
as often as they come; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import default_path, encoder
from .common import map_arrow, only, per_group, record, slices, texts_of, written

#: Pieces packed together; memory of a task follows this, not the input.
GROUP_PIECES = 65_536
END_ID = 0


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds: by default as many documents as tokens, and the attention cost of one
    full-length piece.  All three weigh alike in the choice of a sequence."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"  # or "dot"


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def cut(docs: DataFrame, capacity: int = 2048, path: str | None = None) -> DataFrame:
    """Pieces of every document: only documents over ``capacity`` tokens are cut, into pieces of
    that length, of which the first may be shorter."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches):
            ids, at = enc.encode(texts_of(b))
            doc = b.column("doc_id").to_pylist()
            rows: dict[str, list] = {n: [] for n in PIECES.names}
            end = np.array([END_ID], "<u4")
            for d, s, e in zip(doc, at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = np.concatenate([ids[s:e].astype("<u4"), end])
                edges = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
                for k, (a, z) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows["doc_id"].append(d)
                    rows["piece"].append(k)
                    rows["start"].append(a)
                    rows["length"].append(z - a)
                    rows["ids_crc32"].append(zlib.crc32(own[a:z].tobytes()))
            yield record(PIECES, **rows)

    return map_arrow(only(docs, "doc_id", "text"), run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def vector_best_fit(lengths: np.ndarray, cap: Capacity) -> np.ndarray:
    """The sequence (0, 1, ...) of each piece; ``lengths`` are at most cap.tokens.  Of equal scores the
    sequence that was opened first is taken."""
    order = np.argsort(-lengths, kind="stable")
    placed = np.empty(len(lengths), np.int64)
    full = np.array([cap.tokens, cap.documents, cap.attention], np.float64)
    weight = np.array(cap.weights)
    residual = np.zeros((0, 3), np.int64)  # of open sequences
    name = np.zeros(0, np.int64)
    made = 0
    values, first = np.unique(-lengths[order], return_index=True)
    for v, a, b in zip((-values).tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        size = np.array([v, 1, v * v])
        left = b - a
        fits = np.flatnonzero((residual >= size).all(1))
        if cap.rule == "dot":
            residual, name, made = _by_dot(order[a:b], placed, size, residual, name, fits, full, weight, made)
            left = 0
        elif len(fits):
            rest = (residual[fits] - size) / full
            fits = fits[np.argsort((weight * rest * rest).sum(1), kind="stable")]
            room = (residual[fits] // size).min(1)
            taken = np.minimum(room, np.maximum(0, left - (np.cumsum(room) - room)))
            residual[fits] -= taken[:, None] * size
            done = int(taken.sum())
            placed[order[a : a + done]] = np.repeat(name[fits], taken)
            left -= done
        if left:
            room = max(1, int((full.astype(np.int64) // size).min()))
            new = -(-left // room)
            taken = np.full(new, room)
            taken[-1] = left - room * (new - 1)
            placed[order[b - left : b]] = np.repeat(made + np.arange(new), taken)
            residual = np.concatenate([residual, full.astype(np.int64) - taken[:, None] * size])
            name = np.concatenate([name, made + np.arange(new)])
            made += new
        least = lengths[order[-1]]
        keep = (residual[:, 0] >= least) & (residual[:, 1] > 0)
        residual, name = residual[keep], name[keep]
    return placed


def _by_dot(pieces, placed, size, residual, name, fits, full, weight, made):
    """Place pieces of one length, each where the dot product of residual and size is largest."""
    ask = weight * size / full / full
    heap = [(-float(x), int(i)) for x, i in zip((residual[fits] * ask).sum(1), fits, strict=True)]
    heapq.heapify(heap)
    residual, name = list(residual), list(name)
    for p in pieces.tolist():
        if heap:
            i = heapq.heappop(heap)[1]
        else:
            i = len(residual)
            residual.append(full.astype(np.int64))
            name.append(made)
            made += 1
        placed[p] = name[i]
        residual[i] = residual[i] - size
        if (residual[i] >= size).all():
            heapq.heappush(heap, (-float((residual[i] * ask).sum()), i))
    return np.array(residual).reshape(-1, 3), np.array(name, np.int64), made


def pack(pieces: DataFrame, cap: Capacity | None = None) -> DataFrame:
    """The pieces with sequence_id and offset (gapless from 0 in each sequence)."""
    cap = cap or Capacity()
    pieces = written(pieces, "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))

    def run(t: pa.Table) -> pa.Table:
        lengths = t.column("length").to_numpy()
        at = vector_best_fit(lengths, cap)
        order = np.argsort(at, kind="stable")
        ends = np.cumsum(lengths[order])
        begin = np.empty(len(order), np.int64)
        fresh = np.append(True, at[order][1:] != at[order][:-1]) if len(order) else np.zeros(0, bool)
        begin[order] = ends - lengths[order] - np.repeat((ends - lengths[order])[fresh], np.diff(np.append(np.flatnonzero(fresh), len(order))))
        group = t.column("pack_group").to_numpy()
        t = t.drop_columns(["pack_group"])
        return t.append_column("sequence_id", pa.array(group * (1 << 32) + at)).append_column("offset", pa.array(begin))

    # The place in the written table deals out rows that repeat, too; reading it again gives the same.
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)))
    return per_group(dealt, "pack_group", run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, cap: Capacity | None = None, path: str | None = None) -> DataFrame:
    cap = cap or Capacity()
    return pack(cut(docs, cap.tokens, path), cap)
