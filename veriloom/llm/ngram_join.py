"""N-gram Jaccard self-join by signature trees, and its connected components.

A document's set holds the distinct hashes of its word shingles.  Documents with equal sets are one
class.  The join is exact (up to 64-bit hash collisions):

1. *Blocks.*  In any fixed order of shingles, two sets with Jaccard similarity t or more share a
   shingle among the first |S| - ceil(t |S|) + 1 of each.  The order here puts shingles that many
   documents hold last, so shared passages rarely tie unlike documents together.  Sets that share
   such a shingle, and have enough left from there on to be linked if it is their first common one, meet
   in a block; all shingles of a family of near copies choose the same block (that
   of its smallest class), so a set goes to few blocks however many shingles it shares.
2. *Signature tree.*  Within a block, sets are leaves of a tree whose nodes hold OR-combined token
   bitmaps and size ranges.  A traversal of the tree against itself drops node pairs whose largest
   possible overlap falls short of what their smallest sizes need, and pairs of nodes that are one
   component already; sets that meet at the leaves are compared in full.
3. *Components* of the links over all blocks.

Blocks over BLOCK_SETS sets are dealt into parts, and pairs of parts are joined in separate tasks,
so no task holds more than two parts.

Defined results: null or empty text has no shingles, links with nothing and is its own component;
a text with fewer than n words has one shingle, the whole sequence; rows that repeat count as
copies; rows with one doc_id and different texts, and rows without doc_id, link as others do (inside, a
row goes by a 64-bit hash of doc_id and text); a component without any doc_id has none; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mix64, only, per_group, signed, slices, texts_of, words, written
from .components import connected
from .shared_arrays import with_ids, write_ids

WORDS = 5
PERCENT = 75
#: A shingle that so many documents hold comes late in the order.
FREQUENT = 4
#: At most so many frequent shingles are told to the workers (8 bytes each); any order is correct.
MOST_FREQUENT = 1 << 20
#: The share of the hash space in which frequencies are counted: prefixes lie there, mostly.
COUNTED = 0.4
#: Shingles in one bucket of the index; sets in one part of a block.
BUCKET_SHINGLES = 1_500_000
BLOCK_SETS = 4096
#: Children of a tree node; node pairs that a traversal opens at a time.
FAN_OUT = 8
OPENED = 1 << 12
#: Sets that share a shingle are tested pair by pair up to this number; more of them all meet.
TESTED = 256
#: Bytes of text that one Python call works on.
SCANNED = 1_500_000


def shingles(texts: list[str], n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (unsigned 64-bit) of each text."""
    h, at = words(texts)
    rolled = np.zeros(0, np.uint64)
    if len(h) >= n:
        size = len(h) - n + 1
        rolled = np.zeros(size, np.uint64)
        for k in range(n):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k : k + size]
        rolled = mix64(rolled)
    out = []
    for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if e - s >= n:
            own = np.sort(rolled[s : e - n + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif e > s:
            x = np.uint64(e - s)
            for w in h[s:e]:
                x = _fold(x, w)
            out.append(np.array([x], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _fold(x: np.uint64, w: np.uint64) -> np.uint64:
    return mix64((np.array([x], np.uint64) ^ np.array([w], np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))[0]


def set_key(s: np.ndarray) -> int:
    """A hash of the whole set: equal sets, equal keys."""
    return int(signed(mix64(np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(s)), len(s)], np.uint64)).sum(dtype=np.uint64, keepdims=True))[0])


def needed(a, b, percent: int):
    """The smallest overlap of sets of sizes a and b that makes a link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


# -- classes and frequencies ---------------------------------------------------------------


def _bits(n_bytes: int) -> int:
    """Buckets are named by so many high bits of a hash, so that each has about BUCKET_SHINGLES."""
    return max(1, int(n_bytes / 6 / BUCKET_SHINGLES / COUNTED).bit_length())


def _token(h: np.ndarray, bits: int) -> np.ndarray:
    """The 32 + bits high bits of a hash: bucket and token.  Chance equals only add candidates."""
    return h >> np.uint64(32 - bits)


def _dealt(token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted tokens: the buckets they have, and the range of each."""
    bucket = (token >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    return bucket[first], first, np.append(first[1:], len(token))


def _classes(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, row_key, n_shingles and set_key (null for an empty set) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = shingles(texts_of(b), n)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())],
                names=["doc_id", "row_key", "n_shingles", "set_key"],
            )

    return written(map_arrow(docs, run, "doc_id long, row_key long, n_shingles long, set_key long"), "classes")


def _frequent(docs: DataFrame, n: int, bits: int) -> np.ndarray:
    """Sorted tokens of shingles that many documents hold, MOST_FREQUENT at most."""
    limit = np.uint64(int(COUNTED * 2**32) << (bits))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, chars=SCANNED):
            token = _token(np.concatenate(shingles(texts_of(b), n)), bits)
            token = np.sort(token[token < limit])
            if len(token):
                bucket, first, last = _dealt(token)
                low = token.astype(np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array([low[s:e].tobytes() for s, e in zip(first, last, strict=True)], pa.binary())], names=["bucket", "low"])

    def count(t: pa.Table) -> pa.Table:
        low = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in t.column("low")])
        value, times = np.unique(low, return_counts=True)
        often = times >= FREQUENT
        token = (np.uint64(t.column("bucket")[0].as_py()) << np.uint64(32)) | value[often].astype(np.uint64)
        return pa.table([pa.array(signed(token)), pa.array(times[often])], names=["token", "times"])

    found = written(per_group(map_arrow(docs, tell, "bucket long, low binary"), "bucket", count, "token long, times long"), "frequent")
    # The lowest bar that keeps the list within its bound, from a histogram of few rows.
    steps = found.groupBy(F.floor(F.log2("times") * 4).alias("step")).count().orderBy(F.desc("step")).collect()
    bar, total = None, 0
    for r in steps:
        total += r["count"]
        if total > MOST_FREQUENT:
            break
        bar = r["step"]
    if bar is None:
        return np.zeros(0, np.uint64)
    kept = found.where(F.floor(F.log2("times") * 4) >= bar).select("token").toArrow()
    return np.sort(kept.column("token").to_numpy().view(np.uint64))


# -- blocks ----------------------------------------------------------------------------------


def _meetings(docs: DataFrame, n: int, percent: int, bits: int, frequent: np.ndarray) -> DataFrame:
    """set_key and block: every set with the blocks of the prefix shingles it shares."""
    late = docs.sparkSession.sparkContext.broadcast(frequent)  # MOST_FREQUENT * 8 bytes at most

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = late.value
        for b in slices(batches, chars=SCANNED):
            sets = [s for s in shingles(texts_of(b), n) if len(s)]
            if not sets:
                continue
            sizes = np.array([len(s) for s in sets])
            every = np.concatenate(sets)
            token = _token(every, bits)
            at = np.minimum(np.searchsorted(often, token), max(0, len(often) - 1))
            is_late = often[at] == token if len(often) else np.zeros(len(token), bool)
            # Rank in the order (frequent last, then by hash) of each set's shingles.
            doc = np.repeat(np.arange(len(sets)), sizes)
            start = np.cumsum(sizes) - sizes
            early = np.cumsum(~is_late) - ~is_late
            early -= np.repeat(early[start], sizes)
            n_early = np.bincount(doc, weights=~is_late, minlength=len(sets)).astype(np.int64)
            place = np.arange(len(every)) - np.repeat(start, sizes)
            rank = np.where(is_late, np.repeat(n_early, sizes) + place - early, early)
            take = rank < np.repeat(prefix_size(sizes, percent), sizes)
            token, doc, rest = token[take], doc[take], np.repeat(sizes, sizes)[take] - rank[take]
            order = np.argsort(token, kind="stable")
            token, doc, rest = token[order], doc[order], rest[order].astype(np.uint32)
            key = np.array([set_key(s) for s in sets], np.int64)
            bucket, first, last = _dealt(token)
            low = token.astype(np.uint32)
            blobs, names = [], []
            for s, e in zip(first.tolist(), last.tolist(), strict=True):
                own, local = np.unique(doc[s:e], return_inverse=True)
                blobs.append(low[s:e].tobytes() + local.astype(np.uint32).tobytes() + rest[s:e].tobytes())
                names.append(key[own].tobytes() + sizes[own].astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(blobs, pa.binary()), pa.array(names, pa.binary())], names=["bucket", "entries", "sets"])

    def meet(t: pa.Table) -> pa.Table:
        lows, keys, ns, rests = [], [], [], []
        for e, k in zip(t.column("entries"), t.column("sets"), strict=True):
            low, local, rest = np.frombuffer(e.as_buffer(), np.uint32).reshape(3, -1)
            key, n = np.frombuffer(k.as_buffer(), np.int64).reshape(2, -1)
            for out, x in ((lows, low), (keys, key[local]), (ns, n[local]), (rests, rest)):
                out.append(x)
        low, key, n, rest = np.concatenate(lows), np.concatenate(keys), np.concatenate(ns), np.concatenate(rests).astype(np.int64)
        order = np.lexsort((-rest, key, low))
        low, key, n, rest = low[order], key[order], n[order], rest[order]
        new = np.append(True, low[1:] != low[:-1])
        distinct = new | np.append(True, key[1:] != key[:-1])
        low, key, n, rest, new = low[distinct], key[distinct], n[distinct], rest[distinct], new[distinct]
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(low)))
        meets = _can_meet(first, sizes, n, rest, percent)
        # Among those that meet at a shingle the smallest names the block.
        low, key = low[meets], key[meets]
        first = np.flatnonzero(np.append(True, low[1:] != low[:-1])) if len(low) else np.zeros(0, np.int64)
        block = np.repeat(key[first], np.diff(np.append(first, len(low))))
        pairs = np.unique(np.stack([key, block], 1), axis=0)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["set_key", "block"])

    return per_group(map_arrow(docs, tell, "bucket long, entries binary, sets binary"), "bucket", meet, "set_key long, block long").distinct()


def _can_meet(first: np.ndarray, sizes: np.ndarray, n: np.ndarray, rest: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets that share a shingle (runs of ``sizes`` from ``first``) can be linked to another
    of the run whose first common shingle this is: what is left of both from here on (``rest``) must
    reach the overlap that their sizes need."""
    out = np.zeros(len(n), bool)
    for size in np.unique(sizes[sizes > 1]).tolist():
        runs = first[sizes == size]
        if size > TESTED:
            for a in runs.tolist():
                out[a : a + size] = True
            continue
        step = max(1, (1 << 20) // (size * size))
        for k in range(0, len(runs), step):
            at = runs[k : k + step, None] + np.arange(size)
            a, r = n[at], rest[at]
            ok = np.minimum(r[:, :, None], r[:, None, :]) >= needed(a[:, :, None], a[:, None, :], percent)
            ok[:, np.arange(size), np.arange(size)] = False
            out[at] = ok.any(2)
    return out


# -- the tree ---------------------------------------------------------------------------------


class SignatureTree:
    """Sets (sorted distinct 64-bit hashes) under nodes of OR-combined bitmaps and size ranges."""

    def __init__(self, sets: list[np.ndarray], fan_out: int = FAN_OUT) -> None:
        # Alike sets tend to have the same smallest hashes, so they become neighbours.
        self.order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i])))
        self.sets = [sets[i] for i in self.order]
        self.fan_out = fan_out
        sizes = np.array([len(s) for s in self.sets])
        width = 64
        while width < 4 * np.median(sizes) and width < 8192:
            width *= 2
        bits = np.concatenate([self._bitmaps(self.sets[k : k + 512], width) for k in range(0, len(sets), 512)])
        #: (bitmap, smallest size, largest size, most shingles beyond the distinct bits), leaves first
        self.levels = [(bits, sizes, sizes, sizes - np.bitwise_count(bits).sum(1).astype(np.int64))]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, more = self.levels[-1]
            at = np.arange(0, len(low), fan_out)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(more, at)))
        self.parent = list(range(len(sets)))
        self._settle()

    @staticmethod
    def _bitmaps(sets: list[np.ndarray], width: int) -> np.ndarray:
        grid = np.zeros((len(sets), width), bool)
        grid[np.repeat(np.arange(len(sets)), [len(s) for s in sets]), (np.concatenate(sets) >> np.uint64(11)) % np.uint64(width)] = True
        return np.packbits(grid, axis=1).view(np.uint64)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def _settle(self) -> None:
        """The component of each node at each level, -1 if its leaves are of several."""
        own = np.array([self.find(i) for i in range(len(self.sets))])
        self.component = [own]
        for _ in self.levels[1:]:
            at = np.arange(0, len(own), self.fan_out)
            low, high = np.minimum.reduceat(own, at), np.maximum.reduceat(own, at)
            own = np.where(low == high, low, -1)
            self.component.append(own)

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether a pair of leaves below nodes a and b can be a link yet unknown."""
        bits, low, high, more = self.levels[level]
        c = self.component[level]
        ok = ~((c[a] == c[b]) & (c[a] >= 0))
        ok &= (high[a] * 100 >= percent * low[b]) & (high[b] * 100 >= percent * low[a])
        at = np.flatnonzero(ok)
        shared = np.zeros(len(at), np.int64)
        for k in range(0, len(at), 4 * OPENED):
            p = at[k : k + 4 * OPENED]
            shared[k : k + 4 * OPENED] = np.bitwise_count(bits[a[p]] & bits[b[p]]).sum(1)
        most = np.minimum(shared + np.minimum(more[a[at]], more[b[at]]), np.minimum(high[a[at]], high[b[at]]))
        ok[at] = most >= needed(low[a[at]], low[b[at]], percent)
        return ok

    def links(self, percent: int) -> list[tuple[int, int]]:
        """Links (indices of the input) that span the components: each joins two of them."""
        found: list[tuple[int, int]] = []
        root = len(self.levels) - 1
        stack = [(root, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            if level:
                keep = self._possible(level, a, b, percent)
                a, b = a[keep], b[keep]
                if not len(a):
                    continue
                n = len(self.levels[level - 1][1])
                k = np.arange(self.fan_out)
                x = (a[:, None, None] * self.fan_out + k[None, :, None] + 0 * k[None, None, :]).ravel()
                y = (b[:, None, None] * self.fan_out + 0 * k[None, :, None] + k[None, None, :]).ravel()
                ok = (x < n) & (y < n) & (x <= y if level > 1 else x < y)
                x, y = x[ok], y[ok]
                near = np.argsort(y - x, kind="stable")
                x, y = x[near], y[near]
                stack += [(level - 1, x[s : s + OPENED], y[s : s + OPENED]) for s in range(0, len(x), OPENED)][::-1]
                continue
            keep = self._possible(0, a, b, percent)
            joined = False
            for i, j in zip(a[keep].tolist(), b[keep].tolist(), strict=True):
                ri, rj = self.find(i), self.find(j)
                if ri == rj:
                    continue
                s, t = self.sets[i], self.sets[j]
                if len(s) > len(t):
                    s, t = t, s
                at = np.searchsorted(t, s)
                at[at == len(t)] = 0
                if int((t[at] == s).sum()) >= needed(len(s), len(t), percent):
                    self.parent[max(ri, rj)] = min(ri, rj)
                    found.append((self.order[i], self.order[j]))
                    joined = True
            if joined:
                self._settle()
        return found


# -- the join ----------------------------------------------------------------------------------


def _links(docs: DataFrame, classes: DataFrame, meetings: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) of set keys that span the components of every block."""
    meetings = written(meetings, "meetings")
    sizes = meetings.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("set_key"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = meetings.join(sizes, "block").select("set_key", "block", part.alias("own"), other.alias("other"))
    dealt = dealt.select("set_key", F.xxhash64("block", F.least("own", "other"), F.greatest("own", "other")).alias("block"))
    one = classes.where("set_key is not null").groupBy("set_key").agg(F.min("row_key").alias("row_key"))
    dealt = written(dealt.join(one, "set_key"), "blocks")
    # Only members' texts are shuffled.
    members = with_ids(docs.select("row_key", "text"), *write_ids(dealt.select("row_key").distinct(), dealt.count()), "row_key")
    rows = dealt.join(members, "row_key").select("set_key", "block", "text")
    groups = max(1, meetings.count() // max(1, BLOCK_SETS // 4))
    rows = rows.withColumn("task", F.pmod(F.col("block"), F.lit(groups)))

    def join(t: pa.Table) -> pa.Table:
        block = t.column("block").to_numpy()
        key = t.column("set_key").to_numpy()
        text = t.column("text")
        order = np.argsort(block, kind="stable")
        edges = np.append(np.flatnonzero(np.append(True, block[order][1:] != block[order][:-1])), len(order))
        a, b = [], []
        for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            at = order[s:e]
            at = at[np.unique(key[at], return_index=True)[1]]
            if len(at) > 1:
                for i, j in SignatureTree(shingles(text.take(pa.array(at)).to_pylist(), n)).links(percent):
                    a.append(key[at[i]])
                    b.append(key[at[j]])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return per_group(rows, "task", join, "a long, b long")


def _row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """What tells rows apart, whether or not their doc_id repeats or is null."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text))


def _components(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, row_key, n_shingles, root (null for an empty set) and component_id of every document."""
    docs = only(docs, "doc_id", "text")
    size = docs.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = _bits(size)
    keyed = docs.withColumn("row_key", _row_key())
    classes = _classes(keyed, n)
    meetings = _meetings(docs, n, percent, bits, _frequent(docs, n, bits))
    roots = connected(_links(keyed, classes, meetings, n, percent))
    one = classes.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("low"))
    one = one.join(roots.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
    least = one.groupBy("root").agg(F.min("low").alias("component_id"))
    named = one.join(least, "root").select("set_key", "root", "component_id")
    return classes.join(named, "set_key", "left").select("doc_id", "row_key", "n_shingles", "root", F.coalesce("component_id", "doc_id").alias("component_id"))


def jaccard_components(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return _components(docs, n, percent).select("doc_id", "n_shingles", "component_id")


def near_deduplicated(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` (all columns) that stand for their component: one of those with its smallest
    doc_id, or without any where none has one, and its equals in doc_id and text.  Rows with empty
    sets are linked with nothing and stay."""
    found = written(_components(docs, n, percent).where("doc_id <=> component_id").select("root", "row_key"), "kept")
    kept = found.where("root is not null").groupBy("root").agg(F.min("row_key").alias("row_key")).select("row_key")
    kept = kept.union(found.where("root is null").select("row_key"))
    name = "row_key"
    while name in docs.columns:
        name += "_"
    return with_ids(docs.withColumn(name, _row_key()), *write_ids(kept, found.count()), name).drop(name)
