"""Repeated-substring removal by bucket-pointer refinement.

Every byte that lies in a SPAN-byte string which also starts somewhere else is removed.  Positions
are put in buckets by the q bytes that start there, and buckets are refined: the bucket of 2q bytes
at p is the pair of the buckets of q bytes at p and at p + q, and so on with the identifiers just
made, until a bucket stands for SPAN bytes.  Positions alone in a bucket leave at once.

1. *Initial buckets* over all documents, sparsely.  The bucket of a string of SPAN bytes is the
   smallest hash of its q-grams; equal strings have equal buckets, and neighbouring starts mostly share
   theirs, so a document is a sequence of runs, of about a hundred starts each.  Runs of the same bytes
   collapse: the starts of both are repeated, and one of them stands for all in what follows.
2. *Refinement.*  The distinct runs of a bucket that has several, and runs that may repeat themselves,
   meet in one task, with their bytes.  There the buckets of all positions are refined by sorting on
   pairs of bucket identifiers, Q -> 2Q -> ... -> SPAN.
3. Repeated starts come back to their documents as maximal spans, where they are joined and cut.

A bucket with more than HOT distinct runs (a passage of over q bytes in very many surroundings) is not
gathered: its starts, and no others, go through steps 1 and 2 again with longer grams, whose
identifiers are pairs of those of the grams before, until buckets are small or the grams have SPAN
bytes; then a bucket is one string, and runs of equal bytes are all that there is to find.

What passes between the scans (buckets with several runs, runs that others repeat, spans to cut) lies
as sorted arrays in the shared folder, which tasks memory-map; whole texts are never shuffled.  What is
counted is combined within tasks before, so a run that very many documents share comes once from each.

Defined results: null counts as empty text; documents under SPAN bytes lose nothing, as they cannot
hold a repeated string; rows that repeat are repeats of each other; rows that share a doc_id, or have
none, count as documents of their own (spans are told apart by doc_id and a 64-bit hash of the text);
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mix64, only, per_group, powers, range_hashes, record, scratch, signed, slices, texts_of
from .shared_arrays import load, save

SPAN = 400
#: Bytes of the initial buckets.
Q = 200
#: Distinct runs of a bucket that are refined in one task, at most; runs in one task, about; and
#: positions that are refined at a time, about.
HOT = 2000
TASK_RUNS = 10_000
POSITIONS = 600_000
#: Runs that a task holds to combine equal ones before they are told to others.
HELD = 500_000
#: Multiplier of the first of two identifiers that make one.
PAIR = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that one Python call works on.
SCANNED = 600_000
#: Bytes of text behind one shard of the arrays in the shared folder.
SHARD_BYTES = 128_000_000


def gram_hashes(joined: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of joined[p : p + q] for every p (rolling, by prefix sums modulo 2^64)."""
    up, down = powers(len(joined) + 1)
    total = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * down[: len(joined)], out=total[1:])
    n = len(joined) - q + 1
    return mix64((total[q:] - total[:n]) * up[:n])


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of h[p : p + width] for each p."""
    best, reach = h, 1
    while reach < width:
        step = min(reach, width - reach)
        best = np.minimum(best[:-step], best[step:])
        reach += step
    return best


@dataclass
class Runs:
    """Of each run: its bucket, a 64-bit print of its bytes (which tells the runs of a bucket apart),
    its text, first start, number of starts, and whether the bucket's gram comes twice in it, so that
    it may repeat itself; and a hash of each text."""

    bucket: np.ndarray
    print: np.ndarray
    text: np.ndarray
    first: np.ndarray
    n: np.ndarray
    twice: np.ndarray
    text_hash: np.ndarray

    @staticmethod
    def none(text_hash: np.ndarray) -> Runs:
        long, name = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return Runs(name, name, long, long, long, np.zeros(0, bool), text_hash)


def _next_reach(reach: int, span: int) -> int:
    """The length of the grams that follow those of ``reach`` bytes: half-way to ``span``, which two
    overlapping grams of ``reach`` bytes can cover."""
    left = span - reach
    return reach + min(reach, left if left <= span // 4 else -(-left // 2))


def _edges(bucket: np.ndarray, inside: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First starts of maximal runs of one bucket within one text, and where they stop."""
    opens = np.append(True, (bucket[1:] != bucket[:-1]) | ~inside[:-1])
    opens[heads] = True
    first = np.flatnonzero(opens & inside)
    ends = np.flatnonzero(np.append(inside[:-1] & (opens[1:] | ~inside[1:]), inside[-1])) + 1
    return first, ends


def runs_of(texts: list[bytes], span: int, q: int, hot: Sequence[Callable[[np.ndarray], np.ndarray]] = ()) -> Runs:
    """Runs of starts with one bucket, at the level that follows those of ``hot``: each tells which
    buckets of its level are hot, and only starts whose buckets are hot at all of them have runs."""
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum(sizes) - sizes
    text_hash = range_hashes(joined, begin, begin + sizes)
    if len(joined) < span or sizes.max() < span:
        return Runs.none(text_hash)
    # Starts whose string stays within its text.
    fits = sizes >= span
    heads = begin[fits]
    inside = np.zeros(len(joined) - span + 2, np.int64)
    np.add.at(inside, heads, 1)
    np.add.at(inside, heads + sizes[fits] - span + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    grams, reach = gram_hashes(joined, q), q
    low = sliding_min(grams, span - reach + 1)
    bucket = mix64(low)
    for is_hot in hot:
        first, stop = _edges(bucket, inside, heads)
        held = is_hot(bucket[first])
        if not held.any():
            return Runs.none(text_hash)
        inside = np.zeros(len(bucket) + 1, np.int64)
        np.add.at(inside, first[held], 1)
        np.add.at(inside, stop[held], -1)
        inside = np.cumsum(inside[:-1]) > 0
        # Longer grams are named by the pair of the grams that they begin and end with.
        step = _next_reach(reach, span) - reach
        grams, reach = mix64(grams[:-step] * PAIR + grams[step:]), reach + step
        low = sliding_min(grams, span - reach + 1)
        bucket = mix64(bucket * PAIR + low)
    if reach == span:
        first = np.flatnonzero(inside)
        stop = first + 1
    else:
        first, stop = _edges(bucket, inside, heads)
    text = np.searchsorted(begin, first, side="right") - 1
    width = span - reach + 1
    # Grams that are the smallest of some string: those equal to the largest of the minima over them.
    top = ~sliding_min(~low, min(width, len(low)))
    edge = width - 1
    chosen = np.ones(len(grams), bool)
    if len(low) >= width:
        chosen[edge : len(low)] = grams[edge : len(low)] == top
    place = np.flatnonzero(chosen)
    a, z = np.searchsorted(place, first), np.searchsorted(place, stop + edge)
    n = z - a
    of = np.repeat(np.arange(len(first)), n)
    own = place[np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)]
    twice = np.bincount(of[grams[own] == low[first][of]], minlength=len(first)) > 1
    return Runs(bucket[first], range_hashes(joined, first, stop + span - 1), text, first - begin[text], stop - first, twice, text_hash)


def refine(counts: list[int], texts: list[bytes], span: int, q: int) -> list[np.ndarray]:
    """For each text (a run's bytes) which of its first counts[i] starts begin a string of ``span``
    bytes that another of all these starts begins too.  Buckets are refined q -> 2q -> ... -> span."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    bucket = pd.factorize(gram_hashes(joined, q))[0].astype(np.int32)
    reach = q
    while reach < span:
        step = min(reach, span - reach)
        a, b = bucket[:-step].astype(np.int64), bucket[step:].astype(np.int64)
        # Positions that share their bucket are told apart by that of a later offset; a position
        # alone in its bucket stays alone.
        fresh = -1 - np.arange(len(a))
        shared = np.bincount(a)[a] > 1
        fresh[shared] = a[shared] * (int(b.max()) + 1) + b[shared]
        bucket = pd.factorize(fresh)[0].astype(np.int32)
        reach += step
    asked = np.repeat(begin, counts) + np.arange(sum(counts)) - np.repeat(np.cumsum(counts) - counts, counts)
    hit = np.bincount(bucket[asked])[bucket[asked]] > 1
    return np.split(hit, np.cumsum(counts)[:-1])


def _spans(starts: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered runs of sorted starts."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(np.diff(starts) > span)
    return starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)] + span


@lru_cache(256)
def _array(url: str, name: str) -> np.ndarray:
    return load(url, name)


def _try(url: str, name: str) -> np.ndarray | None:
    try:
        return _array(url, name)
    except FileNotFoundError:
        return None


def _find(url: str, bits: int, name: str, key: np.ndarray, check: np.ndarray | None = None) -> np.ndarray:
    """Values of the keys in the arrays ``name``-shard (keys, [what must agree too,] values); 0 if absent."""
    out = np.zeros(len(key), np.uint64)
    order = np.argsort(key)
    key = key[order]
    check = None if check is None else check[order]
    shard = (key >> np.uint64(64 - bits)).astype(np.int64)
    for k in np.unique(shard).tolist():
        have = _try(url, f"{name}-{k}")
        if have is None or not have.shape[1]:
            continue
        s, e = np.searchsorted(shard, [k, k + 1])
        at = np.searchsorted(have[0], key[s:e])
        todo = np.arange(e - s)
        while len(todo):  # once, but for keys that differ in what must agree too
            todo = todo[at[todo] < have.shape[1]]
            todo = todo[have[0][at[todo]] == key[s + todo]]
            good = np.ones(len(todo), bool) if check is None else have[1][at[todo]] == check[s + todo]
            out[order[s + todo[good]]] = have[-1][at[todo[good]]]
            todo = todo[~good]
            at[todo] += 1
    return out


def _doc_key(b: pa.RecordBatch, text_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """doc_id (0 for null) and a hash of the text (another for null): what tells documents apart."""
    col = b.column("doc_id")
    lost = col.is_null().to_numpy(zero_copy_only=False)
    return col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), np.where(lost, ~text_hash, text_hash)


def _doc_name(doc: np.ndarray, text_hash: np.ndarray) -> np.ndarray:
    return mix64(mix64(doc.view(np.uint64)) + text_hash)


def _packed(shard_of: np.ndarray, bits: int, *arrays: np.ndarray) -> pa.RecordBatch:
    """One row for each shard: the arrays' items whose ``shard_of`` begins with its bits."""
    shard = (shard_of >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    names = np.unique(shard)
    edge = np.append(np.searchsorted(shard[order], names), len(order))
    items = np.stack([x[order] for x in arrays])
    return pa.RecordBatch.from_arrays([pa.array(names), pa.array([items[:, s:e].tobytes() for s, e in zip(edge, edge[1:], strict=False)], pa.binary())], names=["shard", "items"])


def _unpacked(t: pa.Table, arrays: int) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), np.uint64).reshape(arrays, -1) for x in t.column("items")], axis=1)


def _combined(bucket: np.ndarray, print_: np.ndarray, doc: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """One item for each (bucket, print): its smallest document name, and how many runs it has."""
    order = np.lexsort((bucket, print_))
    bucket, print_ = bucket[order], print_[order]
    first = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (print_[1:] != print_[:-1])))
    return bucket[first], print_[first], np.minimum.reduceat(doc[order], first), np.add.reduceat(n[order], first)


def find_repeats(docs: DataFrame, span: int = SPAN, q: int = Q, hot: int = HOT) -> tuple[str, int]:
    """Write what is to be removed to the shared folder: where, and the bits of its shards."""
    docs = only(docs, "doc_id", "text")
    size = docs.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = max(1, (int(size) // SHARD_BYTES).bit_length())
    url = scratch(docs.sparkSession, "repeats")
    spans, more, reach = None, True, q
    levels: list[str] = []
    while more:
        levels.append(scratch(docs.sparkSession, "buckets"))
        found, more = _level(docs, span, q, hot, levels, bits, reach == span)
        spans = found if spans is None else spans.union(found)
        reach = _next_reach(reach, span) if reach < span else reach

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            name = _doc_name(b.column("doc_id").to_numpy(), b.column("text_hash").to_numpy().view(np.uint64))
            yield b.append_column("shard", pa.array((name >> np.uint64(64 - bits)).astype(np.int64)))

    def put(t: pa.Table) -> pa.Table:
        doc, text, start, end = (t.column(c).to_numpy() for c in ("doc_id", "text_hash", "start", "end"))
        order = np.lexsort((start, text, doc))
        save(url, f"cut-{t.column('shard')[0].as_py()}", np.stack([x[order] for x in (doc, text, start, end)]))
        return pa.table({"n": pa.array([t.num_rows], pa.int64())})

    dealt = map_arrow(spans, deal, f"{CUTS}, shard long")
    per_group(dealt, "shard", put, "n long").agg(F.sum("n")).first()
    return url, bits


CUTS = "doc_id long, text_hash long, start long, end long"


def _level(docs: DataFrame, span: int, q: int, hot: int, levels: list[str], bits: int, last: bool) -> tuple[DataFrame, bool]:
    """Spans of repeated starts that the last of ``levels`` finds, and whether it leaves hot buckets."""
    url = levels[-1]

    def hot_at(where: str) -> Callable[[np.ndarray], np.ndarray]:
        return lambda bucket: _find(where, bits, "bucket", bucket) > hot

    def runs(b: pa.RecordBatch) -> tuple[list[bytes], Runs]:
        texts = [t.encode() for t in texts_of(b)]
        return texts, runs_of(texts, span, q, [hot_at(u) for u in levels[:-1]])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for b in slices(batches, chars=SCANNED):
            _, r = runs(b)
            if len(r.bucket):
                held.append((r.bucket, r.print, _doc_name(*_doc_key(b, r.text_hash))[r.text], np.ones(len(r.bucket), np.uint64)))
                n += len(r.bucket)
            if n > HELD:
                held, n = [_combined(*map(np.concatenate, zip(*held, strict=True)))], 0
                if len(held[0][0]) > HELD // 2:
                    yield _packed(held[0][1], bits, *held[0])
                    held = []
        if held:
            items = _combined(*map(np.concatenate, zip(*held, strict=True)))
            yield _packed(items[1], bits, *items)

    def collapse(t: pa.Table) -> pa.Table:
        bucket, print_, doc, n = _combined(*_unpacked(t, 4))
        twin = n > 1
        save(url, f"twin-{t.column('shard')[0].as_py()}", np.stack([print_[twin], bucket[twin], doc[twin]]))
        bucket, kinds = np.unique(bucket, return_counts=True)
        return pa.Table.from_batches([_packed(bucket, bits, bucket, kinds.astype(np.uint64))])

    def count(t: pa.Table) -> pa.Table:
        items = _unpacked(t, 2)
        order = np.argsort(items[0], kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(items[0][order]) != 0))
        bucket, kinds = items[0][order][first], np.add.reduceat(items[1][order], first)
        save(url, f"bucket-{t.column('shard')[0].as_py()}", np.stack([bucket[kinds > 1], kinds[kinds > 1]]))
        cold = kinds[(kinds > 1) & (kinds <= hot)]
        return pa.table({"total": pa.array([int(cold.sum())], pa.int64()), "most": pa.array([int(kinds.max())], pa.int64())})

    told = per_group(map_arrow(docs, tell, "shard long, items binary"), "shard", collapse, "shard long, items binary")
    got = per_group(told, "shard", count, "total long, most long").agg(F.sum("total").alias("total"), F.max("most").alias("most")).first()
    tasks = max(1, int(got["total"] or 0) // TASK_RUNS)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, chars=SCANNED):
            texts, r = runs(b)
            if not len(r.bucket):
                continue
            doc, text_hash = _doc_key(b, r.text_hash)
            name = _doc_name(doc, text_hash)
            kinds = _find(url, bits, "bucket", r.bucket)
            lead = _find(url, bits, "twin", r.print, r.bucket)
            twin = lead > 0
            # Spans of runs that others repeat, joined within their text.
            at = np.flatnonzero(twin)
            if len(at):
                s, e = r.first[at], r.first[at] + r.n[at] + span - 1
                opens = np.append(True, (r.text[at][1:] != r.text[at][:-1]) | (s[1:] > e[:-1]))
                of = np.flatnonzero(opens)
                t = r.text[at][of]
                yield _rows(signed(name[t]), doc[t], signed(text_hash[t]), s[of], np.maximum.reduceat(e, of))
            if last:
                continue
            asks = ((kinds > 1) & (~twin | (lead == name[r.text])) | r.twice & ~twin) & (kinds <= hot)
            at = np.flatnonzero(asks)
            for k in range(0, len(at), 4096):
                i = at[k : k + 4096]
                t = r.text[i]
                raw = [texts[x][a : a + n + span - 1] for x, a, n in zip(t.tolist(), r.first[i].tolist(), r.n[i].tolist(), strict=True)]
                yield _rows(signed(r.bucket[i]), doc[t], signed(text_hash[t]), r.first[i], r.first[i] + r.n[i], raw)

    def meet(t: pa.Table) -> pa.Table:
        done = t.filter(pc.is_null(t.column("bytes")))
        t = t.filter(pc.is_valid(t.column("bytes")))
        doc, text, first, bucket = (t.column(c).to_numpy() for c in ("doc_id", "text_hash", "start", "bucket"))
        n = t.column("end").to_numpy() - first
        raw = t.column("bytes")
        order = np.argsort(bucket, kind="stable")
        edges = np.append(np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])), len(order)) if len(order) else np.zeros(1, np.int64)
        ends = np.cumsum(n[order] + span)[edges[1:] - 1]
        out: list[list[np.ndarray]] = [[], [], [], []]
        at = 0
        while at < len(edges) - 1:
            # Whole buckets, of about POSITIONS together.
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + POSITIONS, side="right")))
            rows = order[edges[at] : edges[to]]
            at = to
            for i, hit in zip(rows.tolist(), refine(n[rows].tolist(), raw.take(pa.array(rows)).to_pylist(), span, q), strict=True):
                s, e = _spans(first[i] + np.flatnonzero(hit), span)
                for held, x in zip(out, (np.full(len(s), doc[i]), np.full(len(s), text[i]), s, e), strict=True):
                    held.append(x)
        names = ["doc_id", "text_hash", "start", "end"]
        met = pa.table([pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64()) for x in out], names=names)
        return pa.concat_tables([met, done.select(names)])

    emitted = map_arrow(docs, emit, f"bucket long, {CUTS}, bytes binary").withColumn("task", F.pmod(F.xxhash64("bucket"), F.lit(tasks)))
    return per_group(emitted, "task", meet, CUTS), not last and (got["most"] or 0) > hot


def _rows(bucket: np.ndarray, doc: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray, raw: list[bytes] | None = None) -> pa.RecordBatch:
    """Runs to refine, with their bytes, or spans (without)."""
    raw = pa.nulls(len(doc), pa.binary()) if raw is None else pa.array(raw, pa.binary())
    return pa.RecordBatch.from_arrays([*map(pa.array, (bucket, doc, text, start, end)), raw], names=["bucket", "doc_id", "text_hash", "start", "end", "bytes"])


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The text without the (sorted) spans, bytes removed, and the number of maximal removed runs."""
    out, at, removed, n = [], 0, 0, 0
    end = -1
    for s, e in spans:
        n += s > end
        if e > at:
            out.append(text[at : max(at, s)])
            removed += e - max(at, s)
            at = e
        end = max(end, e)
    return b"".join([*out, text[at:]]), removed, n


def _cuts(url: str, bits: int, b: pa.RecordBatch, texts: list[bytes]) -> list[list[tuple[int, int]]]:
    joined = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    doc, text_hash = _doc_key(b, range_hashes(joined, np.append(0, ends[:-1]), ends))
    shard = (_doc_name(doc, text_hash) >> np.uint64(64 - bits)).astype(np.int64)
    out = []
    for d, h, k in zip(doc.tolist(), signed(text_hash).tolist(), shard.tolist(), strict=True):
        have = _try(url, f"cut-{k}")
        if have is None:
            out.append([])
            continue
        s, e = np.searchsorted(have[0], [d, d + 1])
        s, e = s + np.searchsorted(have[1][s:e], h), s + np.searchsorted(have[1][s:e], h, side="right")
        out.append(list(zip(have[2][s:e].tolist(), have[3][s:e].tolist(), strict=True)))
    return out


def dedup_digests(docs: DataFrame, span: int = SPAN, q: int = Q, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    url, bits = find_repeats(docs, span, q, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, chars=SCANNED):
            rows: dict[str, list] = {n: [] for n in RESULT.names}
            texts = [t.encode() for t in texts_of(b)]
            for raw, doc, spans in zip(texts, b.column("doc_id").to_pylist(), _cuts(url, bits, b, texts), strict=True):
                left, removed, n = cut(raw, spans)
                for k, v in zip(RESULT.names, (doc, len(raw), removed, n, hashlib.sha256(left).hexdigest()), strict=True):
                    rows[k].append(v)
            yield record(RESULT, **rows)

    return map_arrow(only(docs, "doc_id", "text"), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, span: int = SPAN, q: int = Q, hot: int = HOT) -> DataFrame:
    """doc_id and what is left of each text (bytes, as a cut may part a character)."""
    url, bits = find_repeats(docs, span, q, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, chars=SCANNED):
            texts = [t.encode() for t in texts_of(b)]
            left = [cut(t, s)[0] for t, s in zip(texts, _cuts(url, bits, b, texts), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(left, pa.binary())], names=["doc_id", "kept"])

    return map_arrow(only(docs, "doc_id", "text"), run, "doc_id long, kept binary")
