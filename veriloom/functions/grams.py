"""Winnowed character grams, as Arrow UDFs over whole batches of code points."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Code points of a gram; a text of SHORTEST or more has a gram in common with every text that holds it.
GRAM = 24
SHORTEST = 120
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse modulo 2^64, to the powers below n."""
    up, down = (np.full(n, b, np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def gram_keys(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A well mixed 64-bit number of each run of ``gram`` code points, by prefix sums."""
    n = len(points) - gram + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(points) + 1)
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * down[:-1], out=total[1:])
    key = (total[gram:] - total[:n]) * up[:n]
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xD6E8FEB86659FD93)
    return key ^ (key >> np.uint64(29))


def window_lows(key: np.ndarray, width: int) -> np.ndarray:
    """The smallest key of each window of ``width`` keys."""
    low, reach = key, 1
    while reach < width:
        more = min(reach, width - reach)
        low = np.minimum(low[: len(low) - more], low[more:])
        reach += more
    return low


def _pointed(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts end to end, and where each text begins (and the end)."""
    whole = [t or "" for t in texts]
    return np.frombuffer("".join(whole).encode("utf-32-le", "surrogatepass"), np.uint32), np.append(0, np.cumsum([len(t) for t in whole], dtype=np.int64))


@F.pandas_udf(T.ArrayType(T.LongType()))
def offers(text: pd.Series) -> pd.Series:
    """What a text can be found by: the smallest gram of every window of SHORTEST code points."""
    points, begin = _pointed(text)
    key = gram_keys(points)
    lows = window_lows(key, SHORTEST - GRAM + 1) if len(points) >= SHORTEST else key[:0]
    return pd.Series([np.unique(lows[a : max(a, z - SHORTEST + 1)]).view(np.int64) for a, z in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)])


@F.pandas_udf(T.LongType())
def probe(text: pd.Series) -> pd.Series:
    """What a text of SHORTEST or more code points asks for: its smallest gram, which is the smallest
    of some window of it, and so of every text that holds it."""
    points, begin = _pointed(text)
    key = gram_keys(points)
    lows = [key[a : z - GRAM + 1].min().view(np.int64).item() if z - a >= GRAM else None for a, z in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
    return pd.Series(lows, dtype="Int64")
