"""Language identification with averaged hashed subword embeddings.

A text's subwords (letter n-grams of one to four, with word edges) are hashed into buckets; the mean
of their embeddings goes through a linear softmax.  Embeddings and softmax are trained together by
stochastic gradient descent in numpy on the driver, on a bounded sample: at most SAMPLE documents,
spread evenly over languages, of which a fifth is held back to calibrate a temperature and the
score under which a prediction is in doubt.  Short texts and texts of several languages are in doubt
at any size of the input, so doubt alone rejects nothing: a text in doubt goes if most of its letters
are in none of the sample's documents.  Since the model is linear after averaging, workers get one
table of buckets by languages.

Defined results: null text, or text without letters, is ``und`` with score 0 and rejected; equal
probabilities go to the language first in sorted order; rows that repeat repeat their results;
without labelled rows nothing can be learned, and every text is ``und``; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mix64, only, record, slices, texts_of

BUCKETS = 1 << 15
DIM = 16
ORDERS = (1, 2, 3, 4)
#: Bound of the labelled documents that the model is fitted on.
SAMPLE = 2400
EPOCHS = 8
RATE = 0.5
#: Longest step that one document may move its mean embedding.
LONGEST_STEP = 0.5
SEED = 17
#: Share of calibration documents, rightly labelled, that may be in doubt at most.
MAX_REJECTED = 0.002
#: Highest score that may be asked for, whatever calibration says.
HIGHEST_BAR = 0.6
UNKNOWN = "und"
#: Characters whose subwords are looked up at a time, so that the arrays stay in the processor's cache.
RUN_CHARS = 60_000

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of the texts, and where each text's subwords begin (and the end).
    Texts without letters have none."""
    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    doc = np.repeat(np.arange(len(texts)), sizes)
    is_letter = letters()[points]
    chars = np.where(is_letter, points, np.uint32(32)).astype(np.uint64)
    salted = mix64(chars + np.uint64(0x5BD1E995))
    found, of = [], []
    h = salted.copy()
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            # One more character; texts are edged with blanks, so none reaches into the next.
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + salted[n - 1 :]
        m = len(h)
        if m <= 0:
            break
        ok = np.ones(m, bool)
        if n == 1:
            ok &= is_letter
        elif n == 2:
            ok &= is_letter[:m] | is_letter[1 : 1 + m]
        else:
            for k in range(1, n - 1):
                ok &= is_letter[k : k + m]
        ok &= doc[:m] == doc[n - 1 : n - 1 + m]
        if n in ORDERS:
            at = np.flatnonzero(ok)
            found.append((mix64(h[at] + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int32))
            of.append(doc[at])
    counts = sum((np.bincount(o, minlength=len(texts)) for o in of), np.zeros(len(texts), np.int64))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(counts, out=starts[1:])
    out = np.empty(starts[-1], np.int32)
    fill = starts[:-1].copy()
    for f, o in zip(found, of, strict=True):
        own = np.bincount(o, minlength=len(texts))
        out[np.arange(len(f)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(fill, own)] = f
        fill += own
    return out, starts


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # buckets by languages, already divided by the temperature
    bias: np.ndarray
    bar: float  # a lower score is in doubt
    alphabet: frozenset[str] = frozenset()  # letters of the sample, in lower case

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities by text and language; which texts have letters at all."""
        logits = np.zeros((len(texts), len(self.languages)))
        known = np.zeros(len(texts), bool)
        for s, e in _runs(texts):
            ids, starts = subwords(texts[s:e])
            n = np.diff(starts)
            own = np.flatnonzero(n)
            if len(own):
                known[s + own] = True
                for k in range(len(self.languages)):
                    total = np.add.reduceat(self.table[:, k][ids], starts[own], dtype=np.float64)
                    logits[s + own, k] = total / n[own] + self.bias[k]
        return softmax(logits), known

    def rejects(self, texts: list[str], p: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Texts without letters, and those in doubt whose letters are mostly foreign to the sample."""
        out = ~known
        for i in np.flatnonzero(known & (p.max(1) < self.bar)):
            own = [c for c in texts[i].lower() if c.isalpha()]
            out[i] = 2 * sum(c not in self.alphabet for c in own) > len(own)
        return out


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of RUN_CHARS characters together; a longer text ends its run."""
    at = n = 0
    for k, t in enumerate(texts, 1):
        n += len(t)
        if n >= RUN_CHARS or k == len(texts):
            yield at, k
            at, n = k, 0


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: tuple[str, ...], alphabet: frozenset[str] = frozenset()) -> Model:
    """``bags``: buckets and shares of each document; a fifth of them is for calibration."""
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(bags))
    held = order[: len(bags) // 5]
    used = order[len(bags) // 5 :]
    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM))
    soft = np.zeros((DIM, len(languages)))
    bias = np.zeros(len(languages))
    steps, step = EPOCHS * len(used), 0
    for _ in range(EPOCHS):
        for d in rng.permutation(used):
            ids, share = bags[d]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = share @ emb[ids]
            p = softmax(hidden @ soft + bias)
            p[labels[d]] -= 1
            move = rate * (soft @ p)
            move *= min(1.0, LONGEST_STEP / max(1e-12, float(np.sqrt(move @ move))))
            soft -= rate * np.outer(hidden, p)
            bias -= 0.1 * rate * p
            # Scaled so that the mean moves by exactly ``move``, however many subwords the text has.
            emb[ids] -= np.outer(share / (share @ share), move)
    if not (np.isfinite(emb).all() and np.isfinite(soft).all()):
        raise ArithmeticError("the language model did not converge")
    check = held if len(held) else used
    logits = np.array([bags[d][1] @ emb[bags[d][0]] @ soft + bias for d in check])
    right = labels[check]
    heats = np.geomspace(0.05, 20, 60)
    loss = [-np.log(np.maximum(1e-12, softmax(logits / t)[np.arange(len(check)), right])).mean() for t in heats]
    heat = heats[int(np.argmin(loss))]
    p = softmax(logits / heat)
    good = np.sort(p.max(1)[p.argmax(1) == right])
    bar = min(HIGHEST_BAR, float(good[int(MAX_REJECTED * len(good))])) if len(good) else 0.0
    return Model(languages, (emb @ soft / heat).astype(np.float32), bias / heat, bar * 0.999, alphabet)


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on ``labelled`` (doc_id, text, lang without nulls); at most ``sample`` rows reach the driver."""
    rows = only(labelled, "doc_id", "text", "lang").where("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row for each language
    if not sizes:
        return None
    each = max(1, sample // len(sizes))
    # The same share of each language's rows by a hash, then the bound.
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 1.2 * each / n))])
    dice = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = rows.where(dice < share[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, chars=500_000):
            texts = texts_of(b)
            ids, starts = subwords(texts)
            own = ["".join(sorted(c for c in set(t.lower()) if c.isalpha())) for t in texts]
            bags = [np.unique(ids[s:e], return_counts=True) for s, e in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("lang"), pa.array([x[0] for x in bags], pa.list_(pa.int32())), pa.array([x[1].astype(np.int32) for x in bags], pa.list_(pa.int32())), pa.array(own, pa.string())],
                names=["doc_id", "lang", "ids", "counts", "letters"],
            )

    got = map_arrow(picked, run, "doc_id long, lang string, ids array<int>, counts array<int>, letters string").where("size(ids) > 0")
    table = got.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(sample).toArrow()
    if not table.num_rows:
        return None
    languages = tuple(sorted(set(table.column("lang").to_pylist())))
    index = {lang: i for i, lang in enumerate(languages)}
    alphabet = frozenset().union(*table.column("letters").to_pylist())
    return train(bags_of(table), np.array([index[x] for x in table.column("lang").to_pylist()]), languages, alphabet)


def bags_of(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and shares of each document; the buckets are views of the table's own memory."""
    bags = []
    for b in table.to_batches():
        ids, counts = b.column("ids"), b.column("counts")
        at = ids.offsets.to_numpy().tolist()
        own = ids.values.to_numpy()
        n = counts.values.to_numpy()
        to = counts.offsets.to_numpy().tolist()
        for i in range(b.num_rows):
            c = n[to[i] : to[i + 1]].astype(np.float64)
            c /= c.sum()
            bags.append((own[at[i] : at[i + 1]], c))
    return bags


PREDICTION = "doc_id long, lang_pred string, score double, rejected boolean"
_PREDICTION = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every document, from its whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # buckets by languages, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in slices(batches, chars=500_000):
            texts = texts_of(b)
            if m is None:
                names, best, no = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            else:
                p, known = m.probabilities(texts)
                best = np.where(known, p.max(1), 0.0)
                names = [m.languages[k] if ok else UNKNOWN for k, ok in zip(p.argmax(1).tolist(), known.tolist(), strict=True)]
                no = m.rejects(texts, p, known)
            yield record(_PREDICTION, doc_id=b.column("doc_id"), lang_pred=names, score=best, rejected=no)

    return map_arrow(only(docs, "doc_id", "text"), run, PREDICTION)


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, with all columns, that the model does not reject."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in slices(batches, chars=500_000):
            if m is not None:
                texts = [t or "" for t in b.column(place).to_pylist()]
                yield b.filter(pa.array(~m.rejects(texts, *m.probabilities(texts))))

    return map_arrow(docs, run, docs.schema)


def fold(doc_id: str = "doc_id", parts: int = 4) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(parts))


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the labelled documents outside the held-out fold, then predict all."""
    train_rows = docs.where(F.coalesce(fold(), F.lit(2)) != 2)
    return predict(docs, fit(train_rows)).withColumn("held_out", F.coalesce(fold() == 2, F.lit(False)))
