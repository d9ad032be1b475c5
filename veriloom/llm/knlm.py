"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, kept as sorted hash arrays.

Counting: tasks combine their own counts, deal them as packed arrays by hash ranges ("shards"), and a
shard's counts meet in one task, which writes sorted arrays to the shared folder.  The number of
shards follows the input.  N-grams are dealt by their context (all words but the last), so that a
context's totals are local; contexts made only of words with more than 1/HOT_SHARE of all tokens are
dealt by the whole n-gram instead, and their partial totals are added up.  Each shard passes the
numbers of left neighbours it saw to the next lower order, down to single words.  Scoring: workers
memory-map the arrays and look up each batch's distinct words and n-grams in sorted order; nothing is
held beyond the batch.  The driver gets sums and the totals of hot contexts, no row for each shard.

A text's tokens are its words (A-Z in lower case, split at ASCII white space) and one end; the first
token follows order - 1 start marks.  P(w|h) = (c(hw) - D) / c(h) + g(h) P'(w|h'), where h' is h
without its first word, with three discounts D from counts of counts; below the highest order c is the
number of left neighbours.  Single words go over a uniform distribution on the known words and one
unknown.

Words are told apart by 64-bit hashes, n-grams by 64-bit hashes of those.  Defined results: null counts
as empty text, whose only token is the end; rows that repeat count each; with nothing to learn from,
every word is unknown; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mix64, only, per_group, record, scratch, slices, texts_of, words, written
from .shared_arrays import load, save

#: Bytes of text behind a shard; a left word with a larger share of all tokens is hot.
SHARD_BYTES = 32_000_000
HOT_SHARE = 500
#: Distinct entries that a task combines before it passes them on.
COMBINED = 1_500_000
END = np.uint64(0xE4D0000000000001)
START = np.uint64(0x57A2700000000002)
#: Words of context and the word itself; see the README for what the third word costs.
ORDER = 2


# -- tokens ----------------------------------------------------------------------------------------


def tokens(texts: list[str], starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's tokens, after so many start marks, and where each text begins."""
    h, at = words(texts)
    n = len(texts)
    at = at + np.arange(n + 1) * (1 + starts)
    out = np.empty(at[-1], np.uint64)
    inner = np.ones(at[-1], bool)
    inner[at[1:] - 1] = False
    for i in range(starts):
        inner[at[:-1] + i] = False
        out[at[:-1] + i] = START
    out[at[1:] - 1] = END
    out[inner] = h
    return out, at


def _sum(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(times, first) if len(first) else times[:0]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _shards(n_bytes: int) -> int:
    """Bits of a hash that name its shard."""
    return max(1, (int(n_bytes) // SHARD_BYTES).bit_length())


def _runs(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
    for s, e in zip(first, [*first[1:], len(shard)], strict=True):
        yield int(shard[s]), int(s), int(e)


# -- counting --------------------------------------------------------------------------------------

_BLOBS = pa.schema([("shard", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_BLOBS_SQL = "shard long, a binary, b binary, c binary"


def _count_words(texts: DataFrame, bits: int) -> DataFrame:
    shift = np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def told() -> pa.RecordBatch:
            parts = list(_runs(key >> shift))
            return record(_BLOBS, shard=[k for k, _, _ in parts], a=[key[s:e].tobytes() for _, s, e in parts], b=[times[s:e].astype(np.uint32).tobytes() for _, s, e in parts], c=[None] * len(parts))

        for b in slices(batches):
            codes, distinct = pd.factorize(tokens(texts_of(b), 0)[0])
            key, times = _sum(np.concatenate([key, distinct]), np.concatenate([times, np.bincount(codes, minlength=len(distinct))]))
            if len(key) > COMBINED:
                yield told()
                key, times = key[:0], times[:0]
        if len(key):
            yield told()

    return map_arrow(texts, run, _BLOBS_SQL)


def _context(grams: list[np.ndarray]) -> np.ndarray:
    """One hash for the words of a context, given as columns."""
    key = grams[0]
    for word in grams[1:]:
        key = _pair(key, word)
    return key


def _all_hot(context: list[np.ndarray], hot: np.ndarray) -> np.ndarray:
    out = np.isin(context[0], hot)
    for word in context[1:]:
        out &= np.isin(word, hot)
    return out


def _merged(grams: list[np.ndarray], times: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct n-grams in the order of their words, and their summed counts."""
    if not len(times):
        return grams, times
    order = np.lexsort(grams[::-1])
    grams, times = [g[order] for g in grams], times[order]
    new = np.zeros(len(times), bool)
    new[0] = True
    for g in grams:
        new[1:] |= g[1:] != g[:-1]
    first = np.flatnonzero(new)
    return [g[first] for g in grams], np.add.reduceat(times, first)


def _small(x: np.ndarray) -> np.ndarray:
    """Counts in the narrowest of three types that holds them all."""
    top = int(x.max()) if x.size else 0
    return x.astype(np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _dealt(grams: list[np.ndarray], times: np.ndarray, bits: int, hot: np.ndarray) -> Iterator[tuple]:
    """Merged n-grams by shard: contexts with how many n-grams follow (a), last words (b), counts (c)."""
    shift = np.uint64(64 - bits)
    *context, last = grams
    if context:
        whole = _context(context)
        is_hot = _all_hot(context, hot)
        shard = np.where(is_hot, _pair(whole, last), whole) >> shift
    else:
        shard = last >> shift
    shard = shard.astype(np.int64)
    order = np.argsort(shard, kind="stable")
    context, last, times, shard = [c[order] for c in context], last[order], times[order], shard[order]
    whole = whole[order] if context else None
    for k, s, e in _runs(shard):
        a = b""
        if context:
            first = np.flatnonzero(np.append(True, whole[s + 1 : e] != whole[s : e - 1]))
            a = b"".join([*[c[s:e][first].tobytes() for c in context], np.diff(np.append(first, e - s)).astype(np.uint64).tobytes()])
        yield k, a, last[s:e].tobytes(), _small(times[s:e]).tobytes()


def _blobs(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(list(x), kind) for x, kind in zip(zip(*rows, strict=True), _BLOBS.types, strict=True)]


def _undealt(t: pa.Table, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    grams: list[list[np.ndarray]] = [[] for _ in range(order)]
    times = []
    for a, b, c in zip(t.column("a"), t.column("b"), t.column("c"), strict=True):
        last = np.frombuffer(b.as_buffer(), np.uint64)
        both = np.frombuffer(a.as_buffer(), np.uint64).reshape(order, -1) if order > 1 else []
        for i in range(order - 1):
            grams[i].append(np.repeat(both[i], both[-1].astype(np.int64)))
        grams[-1].append(last)
        raw = c.as_buffer()
        times.append(np.frombuffer(raw, {2: np.uint16, 4: np.uint32, 8: np.uint64}[raw.size // len(last)]).astype(np.int64))
    return [np.concatenate(g) for g in grams], np.concatenate(times)


def _count_grams(texts: DataFrame, order: int, bits: int, hot: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[np.ndarray], np.ndarray]] = []
        size = 0

        def told() -> pa.RecordBatch:
            grams, times = _merged([np.concatenate([g[i] for g, _ in held]) for i in range(order)], np.concatenate([n for _, n in held]))
            return pa.RecordBatch.from_arrays(_blobs(list(_dealt(grams, times, bits, hot))), schema=_BLOBS)

        for b in slices(batches):
            h, at = tokens(texts_of(b), order - 1)
            ends = np.ones(len(h), bool)
            for i in range(order - 1):
                ends[at[:-1] + i] = False
            last = np.flatnonzero(ends)
            grams = [h[last - i] for i in range(order - 1, -1, -1)]
            codes, _ = pd.factorize(_context(grams))
            by_code = np.argsort(codes, kind="stable")
            first = np.flatnonzero(np.append(True, codes[by_code][1:] != codes[by_code][:-1]))
            held.append(([g[by_code[first]] for g in grams], np.diff(np.append(first, len(by_code)))))
            size += len(first)
            if size > COMBINED:
                yield told()
                held, size = [], 0
        if held:
            yield told()

    return map_arrow(texts, run, _BLOBS_SQL)


def _of_counts(times: np.ndarray) -> list[int]:
    """How many are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(times, 5), minlength=6)[1:5].tolist()


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts.  Where those are missing or give a discount
    that leaves no mass to the lower order, or none to the n-gram, it is half the count."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.0
    out = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.0] if y else [0.0, 0.0, 0.0]
    return tuple(d if 0.0 < d < k else k / 2 for k, d in enumerate(out, 1))  # type: ignore[return-value]


@dataclass
class Model:
    """Where the arrays are, and what does not grow with the input."""

    url: str
    bits: int
    order: int = ORDER
    tokens: int = 0
    distinct: int = 0
    neighbours: int = 0
    kinds: tuple[int, int, int] = (0, 0, 0)
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    #: Discounts by order.
    d: dict[int, tuple[float, float, float]] = field(default_factory=dict)
    #: By order, hot contexts (sorted) and their totals.
    hot_stats: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)


def _added(told: DataFrame) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Hot contexts with their totals over all shards, and counts of counts, added up by Spark."""
    kind = pa.schema([("hot", pa.bool_()), ("key", pa.int64()), *[(f"s{i}", pa.int64()) for i in range(4)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, stats, of in zip(b.column("a"), b.column("b"), b.column("c"), strict=True):
                key = np.frombuffer(a.as_buffer(), np.int64)
                rows = np.vstack([np.frombuffer(stats.as_buffer(), np.int64).reshape(-1, 4), np.frombuffer(of.as_buffer(), np.int64)])
                yield record(kind, hot=np.append(np.ones(len(key), bool), False), key=np.append(key, 0), **{f"s{i}": rows[:, i] for i in range(4)})

    sums = map_arrow(told.where("shard < 0"), run, "hot boolean, key long, s0 long, s1 long, s2 long, s3 long").groupBy("hot", "key").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(4)])
    rows = sums.collect()  # at most HOT_SHARE ** (order - 1) contexts, and one row of counts
    of = next([r["s0"], r["s1"], r["s2"], r["s3"]] for r in rows if not r["hot"])
    rows = [r for r in rows if r["hot"]]
    key = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
    stats = np.array([[r[f"s{i}"] for i in range(4)] for r in rows], np.int64).reshape(-1, 4)
    order = np.argsort(key)
    return key[order], stats[order], of


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """Count the texts of ``docs`` and write the model of this order (2 or more) to the shared folder."""
    if order < 2:
        raise ValueError("the order of the model must be 2 or more")
    texts = only(docs, "text")
    spark = docs.sparkSession
    size = texts.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = _shards(size)
    url = scratch(spark, "knlm")
    model = Model(url, bits, order)

    def put_words(t: pa.Table) -> pa.Table:
        key, times = _sum(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("a")]), np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in t.column("b")]).astype(np.int64))
        k = t.column("shard")[0].as_py()
        save(url, f"word-{k}", key)
        save(url, f"count-{k}", times)
        total = int(times.sum())
        # Fewer than HOT_SHARE words can pass.
        often = times * HOT_SHARE > total
        none = [0] * int(often.sum())
        return pa.table({"n": pa.array([total, *none], pa.int64()), "v": pa.array([len(key), *none], pa.int64()), "word": pa.array([0, *key[often].view(np.int64)], pa.int64()), "times": pa.array([0, *times[often]], pa.int64())})

    told = written(per_group(_count_words(texts, bits), "shard", put_words, "n long, v long, word long, times long"), "words")
    sums = told.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    model.tokens, model.distinct = sums["n"] or 0, sums["v"] or 0
    if not model.tokens:
        return model
    often = told.where(F.col("times") > model.tokens // HOT_SHARE).select("word").collect()  # at most HOT_SHARE words
    model.hot = hot = np.unique(np.append(np.array([r["word"] for r in often], np.int64).view(np.uint64), START))

    def put_grams(level: int) -> Callable[[pa.Table], pa.Table]:
        def put(t: pa.Table) -> pa.Table:
            grams, times = _merged(*_undealt(t, level))
            k = t.column("shard")[0].as_py()
            whole = _context(grams[:-1])
            begin = np.flatnonzero(np.append(True, whole[1:] != whole[:-1]))
            stats = np.stack([np.add.reduceat(x.astype(np.int64), begin) for x in (times, times == 1, times == 2, times > 2)], 1)
            context = whole[begin]
            is_hot = _all_hot([g[begin] for g in grams[:-1]], hot)
            own = np.flatnonzero(~is_hot)
            own = own[np.argsort(context[own], kind="stable")]
            save(url, f"left{level}-{k}", context[own])
            save(url, f"stats{level}-{k}", _small(stats[own]))
            key = _pair(whole, grams[-1])
            by_key = np.argsort(key)
            save(url, f"gram{level}-{k}", key[by_key])
            big = times[by_key] > 65534
            save(url, f"times{level}-{k}", np.where(big, 65535, times[by_key]).astype(np.uint16))
            save(url, f"large{level}-{k}", np.stack([key[by_key][big], times[by_key][big].astype(np.uint64)]))
            told = (-1, context[is_hot].tobytes(), stats[is_hot].tobytes(), np.array(_of_counts(times), np.int64).tobytes())
            # Left neighbours of what follows the first word, combined here before their shuffle.
            lower = _merged(grams[1:], np.ones(len(times), np.int64))
            return pa.table(_blobs([*_dealt(*lower, bits, hot), told]), schema=_BLOBS)

        return put

    dealt = _count_grams(texts, order, bits, hot)
    for level in range(order, 1, -1):
        told = written(per_group(dealt, "shard", put_grams(level), _BLOBS_SQL), "neighbours")
        key, stats, of = _added(told)
        model.hot_stats[level], model.d[level] = (key, stats), discounts(of)
        dealt = told.where("shard >= 0")

    def put_neighbours(t: pa.Table) -> pa.Table:
        (word,), n = _merged(*_undealt(t, 1))
        k = t.column("shard")[0].as_py()
        save(url, f"near-{k}", n[np.minimum(np.searchsorted(word, np.asarray(load(url, f"word-{k}"))), len(word) - 1)])
        return pa.table({"n": pa.array([[int(n.sum()), int((n == 1).sum()), int((n == 2).sum()), int((n > 2).sum()), *_of_counts(n)]], pa.list_(pa.int64()))})

    rows = per_group(dealt, "shard", put_neighbours, "n array<long>")
    total = list(rows.agg(*[F.sum(F.col("n")[i]).alias(f"n{i}") for i in range(8)]).first())
    model.neighbours, model.kinds, model.d[1] = total[0], tuple(total[1:4]), discounts(total[4:])
    return model


# -- scoring ---------------------------------------------------------------------------------------


def _off(times: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """Counts less their discounts."""
    return np.maximum(0.0, times - np.array([0.0, *d])[np.minimum(times, 3)])


class Scorer:
    """The memory-mapped arrays of a model, opened as they are needed."""

    def __init__(self, model: Model) -> None:
        self.m = model
        self.array = lru_cache(None)(lambda name: load(model.url, name))

    def _find(self, kind: str, shard: np.ndarray, key: np.ndarray, *others: str) -> Iterator[tuple]:
        """For each shard: which keys (sorted by shard and key) it holds, and the other arrays there."""
        for k, s, e in _runs(shard):
            try:
                have = self.array(f"{kind}-{k}")
            except FileNotFoundError:
                continue
            at = np.minimum(np.searchsorted(have, key[s:e]), max(0, len(have) - 1))
            hit = np.flatnonzero(have[at] == key[s:e]) if len(have) else np.zeros(0, np.int64)
            yield k, s + hit, *[self.array(f"{o}-{k}")[at[hit]] for o in others]

    def known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of sorted words, and how many left neighbours they have."""
        count, near = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        for _, at, c, n in self._find("word", (h >> np.uint64(64 - self.m.bits)).astype(np.int64), h, "count", "near"):
            count[at], near[at] = c, n
        return count, near

    def stats(self, level: int, context: np.ndarray) -> np.ndarray:
        """Total, and n-grams counted once, twice, more often, of sorted contexts."""
        out = np.zeros((len(context), 4), np.int64)
        for _, at, s in self._find(f"left{level}", (context >> np.uint64(64 - self.m.bits)).astype(np.int64), context, f"stats{level}"):
            out[at] = s
        key, stats = self.m.hot_stats.get(level, (np.zeros(0, np.uint64), None))
        if len(key):
            at = np.minimum(np.searchsorted(key, context), len(key) - 1)
            is_hot = key[at] == context
            out[is_hot] = stats[at[is_hot]]
        return out

    def grams(self, level: int, context: np.ndarray, key: np.ndarray, is_hot: np.ndarray) -> np.ndarray:
        shard = (np.where(is_hot, key, context) >> np.uint64(64 - self.m.bits)).astype(np.int64)
        order = np.lexsort((key, shard))
        out = np.zeros(len(key), np.int64)
        for k, at, t in self._find(f"gram{level}", shard[order], key[order], f"times{level}"):
            t = t.astype(np.int64)
            big = t == 65535
            if big.any():
                large = self.array(f"large{level}-{k}")
                t[big] = large[1][np.searchsorted(large[0], key[order[at[big]]])]
            out[order[at]] = t
        return out

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, known tokens, base score and model score of each text."""
        m = self.m
        starts = m.order - 1
        h, at = tokens(texts, starts)
        word, inverse = np.unique(h, return_inverse=True)
        count, near = self.known(word)
        uniform = 1.0 / (m.distinct + 1)
        if m.neighbours:
            spare = sum(d * n for d, n in zip(m.d[1], m.kinds, strict=True)) / m.neighbours
            p1 = _off(near, m.d[1]) / m.neighbours + spare * uniform
        else:
            p1 = np.full(len(word), uniform)
        base = np.log10((count + 1.0) / (m.tokens + 1.0 * (m.distinct + 1)))
        token = np.ones(len(h), bool)
        for i in range(starts):
            token[at[:-1] + i] = False
        last = np.flatnonzero(token)
        right = inverse[last]
        p = p1[right]
        for level in range(2, m.order + 1) if m.neighbours else ():
            grams = [h[last - i] for i in range(level - 1, 0, -1)]
            context = _context(grams)
            codes, key = pd.factorize(_pair(context, h[last]))
            first = np.empty(len(key), np.int64)
            first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            context = context[first]
            distinct, back = np.unique(context, return_inverse=True)
            stats = self.stats(level, distinct)[back]
            total = stats[:, 0]
            seen = self.grams(level, context, key, _all_hot([g[first] for g in grams], m.hot))
            spare = np.where(total > 0, stats[:, 1:] @ np.array(m.d[level]) / np.maximum(1, total), 1.0)
            p = (_off(seen, m.d[level]) / np.maximum(1, total))[codes] + spare[codes] * p
        begin = at[:-1] - np.arange(len(texts)) * starts
        return np.diff(at) - starts, np.add.reduceat((count > 0)[right].astype(np.int64), begin), np.add.reduceat(base[right], begin), np.add.reduceat(np.log10(p), begin)


@lru_cache(2)
def _scorer(url: str, model: tuple) -> Scorer:
    return Scorer(model[0])


class _Same(tuple):
    """A key that is told apart by the model's folder alone."""

    def __hash__(self) -> int:
        return hash(self[0].url)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Same) and self[0].url == other[0].url


SCORES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model.url, _Same((model,)))
        for b in slices(batches):
            n, known, base, p = scorer.score(texts_of(b))
            yield record(SCORES, doc_id=b.column("doc_id"), n_tokens=n, n_known=known, base_score=base, score=p)

    return map_arrow(only(docs, "doc_id", "text"), run, "doc_id long, n_tokens long, n_known long, base_score double, score double").withColumn("train_tokens", F.lit(model.tokens).cast("long"))
