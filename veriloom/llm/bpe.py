"""Byte-level BPE encoding and decoding of whole texts.

Pre-tokens are found by array operations over a batch of texts, each distinct pre-token of a
batch is merged once, and ids are gathered back.  Text beyond a leaf size is encoded by *tree
concatenation*: halves are encoded on their own, side by side, and a window around each join is
re-encoded and grown until its pieces agree with both sides.

Two kinds of agreement are used.  Between pre-tokens, scanning has no memory: a boundary that the
window and the right half share, with text behind it on both sides, makes everything after it
equal.  Inside one unbroken pre-token, a token sequence is the encoding of its text exactly if
every two neighbours encode to themselves, so both seams of the window are tested that way.

Defined results: null counts as empty text, which has no tokens; repeated rows give repeated
results; other columns are ignored.  Texts are never cut for good: every token is that of the
whole text.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from .common import map_arrow, only, range_hashes, record, slices, texts_of

#: Code points in a leaf of the tree over a text; bytes in a leaf of an unbroken pre-token.
LEAF_CHARS = 16_384
LEAF_BYTES = 512
#: Pre-tokens whose ids a worker keeps; others are merged again in each batch.
CACHED = 600_000
#: The pre-token pattern of this vocabulary (a fixed value of its public tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space of Unicode (fixed values).
SPACES = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


@lru_cache(1)
def classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    # Code points on which versions of Unicode differ: the tokenizer itself is asked.
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    newer = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        newer[np.frombuffer("".join(regex.findall(pattern, every)).encode("utf-32-le"), np.uint32)] = kind
    asked = np.flatnonzero(newer != table).tolist()
    for kind, before in ((LETTER, "a"), (NUMBER, "1")):
        shown = ByteLevel(add_prefix_space=False).pre_tokenize_str("".join(f"\n{before}{chr(c)}\n" for c in asked))
        ends = {at[0]: at[1] for _, at in shown}
        for k, c in enumerate(asked):
            if ends.get(4 * k + 1) == 4 * k + 3:
                table[c] = kind
            elif table[c] == kind:
                table[c] = OTHER
    table[SPACES] = SPACE
    return table


def pretokens(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of texts laid end to end; ``firsts`` are where texts begin."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    begins = np.zeros(n, bool)
    begins[firsts[firsts < n]] = True
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    start = change | begins
    run = np.flatnonzero(start)
    ends = np.append(run[1:], n)
    white = kind[run] == SPACE
    followed = np.zeros(len(run), bool)
    followed[:-1] = ~begins[run[1:]]
    # The last white-space character before other text stands alone, or joins it if a blank.
    split = white & followed
    last = ends[split] - 1
    start[last] = True
    joins = last[points[last] == 32]
    start[joins + 1] = False
    # 's 't 'm 'd 're 've 'll right after anything but a blank.
    quote = run[(points[run] == 39) & (ends - run == 1)]
    quote = quote[start[quote] & (quote + 1 < n)]
    quote = quote[~begins[quote + 1]]
    if len(quote):
        a = points[quote + 1]
        two = np.isin(a, [ord(c) for c in "stmd"])
        b = points[np.minimum(quote + 2, n - 1)]
        near = (quote + 2 < n) & ~begins[np.minimum(quote + 2, n - 1)]
        three = near & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        start[quote[two | three] + 1] = False
        after = np.concatenate([quote[two] + 2, quote[three] + 3])
        start[after[after < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """The vocabulary at ``path`` (a tokenizers JSON file of byte-level BPE)."""

    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = {c: b for b, c in byte_symbols().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(shown[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        core = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.merge = core._core_bpe.encode_single_piece
        size = max([*ranks.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for b, i in ranks.items():
            self.bytes[i] = b
        for t, i in self.special.items():
            self.bytes[i] = t.encode()
        self.decimal = [str(i) for i in range(size)]
        self.leaf_chars, self.leaf_bytes = leaf_chars, leaf_bytes
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.base, self.size, self.pool = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.int32)
        self.used, self.filled = 0, 0

    def _learn(self, hashes: np.ndarray, merged: list[list[int]]) -> np.ndarray:
        """Keep merged pre-tokens, at most CACHED for longer than this batch."""
        sizes = np.fromiter(map(len, merged), np.int64, len(merged))
        total, n = int(sizes.sum()), len(merged)
        while len(self.base) < self.used + n:
            self.base, self.size = np.resize(self.base, 2 * len(self.base)), np.resize(self.size, 2 * len(self.size))
        while len(self.pool) < self.filled + total:
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.filled : self.filled + total] = np.fromiter(itertools.chain.from_iterable(merged), np.int32, total)
        entry = np.arange(self.used, self.used + n)
        self.base[entry] = self.filled + np.cumsum(sizes) - sizes
        self.size[entry] = sizes
        if self.used + n <= CACHED:
            self.known.update(zip(hashes.tolist(), entry.tolist(), strict=True))
            self.used += n
            self.filled += total
        return entry

    # -- one pre-token ---------------------------------------------------------------
    def piece(self, raw: bytes) -> list[int]:
        """Merge one pre-token; a long one by halves joined through growing windows."""
        if len(raw) <= self.leaf_bytes:
            return self.merge(raw)
        half = len(raw) // 2
        return self._meet(self.piece(raw[:half]), self.piece(raw[half:]))

    def _agree(self, a: int, b: int) -> bool:
        return self.merge(self.bytes[a] + self.bytes[b]) == [a, b]

    def _meet(self, left: list[int], right: list[int]) -> list[int]:
        k = 4
        while True:
            a, b = max(0, len(left) - k), min(len(right), k)
            window = self.merge(b"".join(map(self.bytes.__getitem__, itertools.chain(left[a:], right[:b]))))
            if (not a or self._agree(left[a - 1], window[0])) and (b == len(right) or self._agree(window[-1], right[b])):
                return left[:a] + window + right[b:]
            k *= 2

    # -- texts -----------------------------------------------------------------------
    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids, where each pre-token's ids begin, pre-token starts (code points of the
        texts laid end to end), where each text begins."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        firsts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=firsts[1:])
        starts = pretokens(points, firsts[:-1])
        ends = np.append(starts[1:], len(points)).astype(np.int64)
        codes, distinct = pd.factorize(range_hashes(points, starts, ends))
        entry = np.fromiter(map(self.known.get, distinct.tolist(), itertools.repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(entry < 0)
        if len(new):
            # Where a new pre-token stands: its first occurrence.
            where = np.zeros(len(distinct), np.int64)
            where[codes[::-1]] = np.arange(len(codes))[::-1]
            where = where[new]
            merged = [self.piece(joined[s:e].encode()) for s, e in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
            entry[new] = self._learn(distinct[new], merged)
        base, sizes = self.base[entry], self.size[entry]
        pool = self.pool
        each = sizes[codes]
        bounds = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(each, out=bounds[1:])
        take = np.arange(bounds[-1]) + np.repeat(base[codes] - bounds[:-1], each)
        return pool[take], bounds, starts, firsts

    def _plain(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text: ids, where each pre-token's ids begin, pre-token starts."""
        ids, bounds, starts, firsts = self._flat(texts)
        cut = np.searchsorted(starts, firsts)
        return [(ids[bounds[a] : bounds[b]], bounds[a:b] - bounds[a], starts[a:b] - f) for a, b, f in zip(cut[:-1], cut[1:], firsts[:-1], strict=True)]

    def _join(self, text: str, mid: int, left: tuple, right: tuple) -> tuple:
        """The encoding of ``text`` from those of text[:mid] and text[mid:]."""
        if mid == 0:
            return right
        if mid == len(text):
            return left
        # A boundary of the left half with two characters behind it (a scan looks no further)
        # is one of the whole text.
        last = max(0, int(np.searchsorted(left[2], mid - 2, side="right")) - 1)
        b, grow = int(left[2][last]), 2
        theirs = right[2] + mid
        while True:
            j = min(grow, len(theirs))
            end = int(theirs[j]) if j < len(theirs) else len(text)
            window = self._plain([text[b:end]])[0]
            mine = window[2] + b
            if end == len(text):
                at, skip = end, len(theirs)
                taken = len(mine)
                break
            both = np.intersect1d(mine, theirs[: j + 1], assume_unique=True)
            both = both[both <= end - 2]
            if len(both):
                at = int(both[0])
                taken, skip = int(np.searchsorted(mine, at)), int(np.searchsorted(theirs, at))
                break
            grow *= 2
        keep = int(left[1][last])
        until = int(window[1][taken]) if taken < len(mine) else len(window[0])
        begin = int(right[1][skip]) if skip < len(theirs) else len(right[0])
        return (
            np.concatenate([left[0][:keep], window[0][:until], right[0][begin:]]),
            np.concatenate([left[1][:last], window[1][:taken] + keep, right[1][skip:] - begin + keep + until]),
            np.concatenate([left[2][:last], mine[:taken], theirs[skip:]]),
        )

    def _tree(self, texts: list[str]) -> list[tuple]:
        """Encodings of long texts: all leaves in one batch, then joins level by level."""
        cuts, leaves = [], []
        for t in texts:
            n = 1
            while len(t) / n > self.leaf_chars:
                n *= 2
            at = [len(t) * i // n for i in range(n + 1)]
            cuts.append(at)
            leaves += [t[a:b] for a, b in zip(at, at[1:], strict=False)]
        done = self._plain(leaves)
        out, k = [], 0
        for t, at in zip(texts, cuts, strict=True):
            parts = done[k : k + len(at) - 1]
            k += len(at) - 1
            while len(parts) > 1:
                parts = [self._join(t[at[2 * i] : at[2 * i + 2]], at[2 * i + 1] - at[2 * i], parts[2 * i], parts[2 * i + 1]) for i in range(len(parts) // 2)]
                at = at[::2]
            out.append(parts[0])
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts end to end, and where each text's ids begin (and the end)."""
        odd = [i for i, t in enumerate(texts) if len(t) > self.leaf_chars or any(s in t for s in self.special)]
        plain = list(texts)
        for i in odd:
            plain[i] = ""
        ids, bounds, starts, firsts = self._flat(plain)
        ends = bounds[np.searchsorted(starts, firsts)]
        if not odd:
            return ids, ends
        longs: dict[int, np.ndarray] = {}
        jobs: list[str] = []
        plan = []
        for i in odd:
            parts = self._parts(texts[i])
            plan.append((i, [(None, s) if s is not None else (len(jobs) + k, None) for k, (p, s) in enumerate(parts)]))
            jobs += [p for p, _ in parts]
        trees = self._tree(jobs) if jobs else []
        for i, steps in plan:
            got = [np.array([s], np.int32) if s is not None else trees[j][0] for j, s in steps]
            longs[i] = np.concatenate(got) if got else np.zeros(0, np.int32)
        pieces, prev = [], 0
        for i in odd:
            pieces += [ids[prev : ends[i]], longs[i]]
            prev = ends[i]
        pieces.append(ids[prev:])
        sizes = np.diff(ends)
        for i in odd:
            sizes[i] = len(longs[i])
        total = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes, out=total[1:])
        return np.concatenate(pieces), total

    def _parts(self, text: str) -> list[tuple[str, int | None]]:
        """Cut at special tokens: (text, None) or (its text, its id)."""
        out, rest = [], text
        while rest:
            at, s = min(((rest.find(s), s) for s in self.special if s in rest), default=(-1, ""))
            if at < 0:
                out.append((rest, None))
                break
            if at:
                out.append((rest[:at], None))
            out.append((s, self.special[s]))
            rest = rest[at + len(s) :]
        return out

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def byte_symbols() -> dict[int, str]:
    """Printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others follow from U+0100 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_decode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches):
            ids, at = enc.encode(texts_of(b))
            n, hashed, decoded = [], [], []
            for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = ids[s:e].tolist()
                n.append(e - s)
                hashed.append(hashlib.sha256(",".join(map(enc.decimal.__getitem__, own)).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join(map(enc.bytes.__getitem__, own)).decode("utf-8", "replace").encode()).hexdigest())
            yield record(SCHEMA, doc_id=b.column("doc_id"), n_tokens=n, ids_sha256=hashed, decoded_sha256=decoded)

    return map_arrow(only(docs, "doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the token ids of every document."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches):
            ids, at = enc.encode(texts_of(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], names=["doc_id", "ids"])

    return map_arrow(only(docs, "doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text from the token ids."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            text = [enc.decode(np.array(x or [], np.int64)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(text, pa.string())], names=["doc_id", "text"])

    return map_arrow(only(encoded, "doc_id", "ids"), run, "doc_id long, text string")


def rank_file(path: str) -> dict[bytes, int]:
    """Read a vocabulary kept as base64 ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
