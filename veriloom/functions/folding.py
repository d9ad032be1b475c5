"""Unicode folding and regular text surgery that Spark SQL lacks, as Arrow UDFs."""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORDLESS = re.compile(r"[^\w\s]")


def statement_key_of(text: str | None) -> str | None:
    """NFKC, no white space, case-folded; 32 hex digits of SHA-256; null if nothing is left."""
    if not text:
        return None
    folded = "".join(unicodedata.normalize("NFKC", text).split()).casefold()
    return hashlib.sha256(folded.encode()).hexdigest()[:32] if folded else None


def containment_key_of(text: str | None) -> str:
    """NFKC, squeezed, case-folded."""
    return " ".join(unicodedata.normalize("NFKC", text or "").split()).casefold()


def name_fold_of(name: str | None) -> str:
    """Without accents, case and punctuation."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", name or "") if not unicodedata.combining(c))
    return " ".join(_WORDLESS.sub(" ", bare.lower()).split())


def slug_of(text: str | None) -> str:
    bare = "".join(c for c in unicodedata.normalize("NFKD", text or "") if not unicodedata.combining(c))
    return re.sub(r"[^a-z0-9]+", "-", bare.lower()).strip("-")


def bold_of(quote: str | None, phrases) -> str:
    """Escaped text with phrases in bold, longest first, whatever their case."""
    out = html.escape(quote or "")
    for p in sorted({p for p in (phrases if phrases is not None else []) if p}, key=lambda p: (-len(p), p)):
        out = re.sub(re.escape(html.escape(p)), lambda m: f"<b>{m[0]}</b>", out, flags=re.I)
    return out


@F.pandas_udf(T.StringType())
def _statement_key(s: pd.Series) -> pd.Series:
    return s.map(statement_key_of)


def statement_key(text: Column | str) -> Column:
    """statement_key_of as a column: texts of ASCII letters stay in the JVM, others go to Python."""
    c = F.col(text) if isinstance(text, str) else text
    bare = F.regexp_replace(F.lower(c), r"[\x09-\x0D\x1C-\x20]+", "")
    plain = ~F.rlike(c, F.lit(r"[^\x00-\x7F]"))
    odd = _statement_key(F.when(~plain, c))
    return F.when(plain, F.when(bare != "", F.substring(F.sha2(bare, 256), 1, 32))).otherwise(odd)


@F.pandas_udf(T.StringType())
def containment_key(s: pd.Series) -> pd.Series:
    return s.map(containment_key_of)


@F.pandas_udf(T.StringType())
def name_fold(s: pd.Series) -> pd.Series:
    return s.map(name_fold_of)


@F.pandas_udf(T.StringType())
def slug(s: pd.Series) -> pd.Series:
    return s.map(slug_of)


@F.pandas_udf(T.StringType())
def bold(quote: pd.Series, phrases: pd.Series) -> pd.Series:
    return pd.Series([bold_of(q, p) for q, p in zip(quote, phrases, strict=True)])


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))
