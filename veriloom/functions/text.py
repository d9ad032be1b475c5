"""Scalar text functions as Spark columns (code points, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "\x1f"


def squeeze(c: Column) -> Column:
    """White-space runs (Unicode) to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def presentable(c: Column) -> Column:
    """Double hyphens to an em dash, then squeezed; null and empty pass."""
    return squeeze(F.regexp_replace(c, "-{2,}", "—"))


def paragraphs(c: Column) -> Column:
    """Squeezed paragraphs, set apart by one empty line."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"\n(?U:\s*)\n"), presentable)
    return F.array_join(F.filter(parts, lambda p: p != ""), "\n\n")


def without_controls(c: Column) -> Column:
    """Drop C0 controls other than tab and line ends."""
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def content_key(*parts: Column) -> Column:
    """SHA-256 of the parts joined by a unit separator; nulls count as empty."""
    first, *rest = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    joined = F.concat(first, *[x for p in rest for x in (F.lit(UNIT), p)])
    return F.sha2(joined, 256)


def public_id(url: Column, text: Column) -> Column:
    """Sixteen hex digits that name a statement by where and what."""
    return F.substring(content_key(url, text), 1, 16)


def shard(public: Column, shards: int = 8) -> Column:
    """The sidecar file of an id: its first hex digit modulo the shards."""
    return F.pmod(F.conv(F.substring(public, 1, 1), 16, 10).cast("int"), F.lit(shards))


def segments(display: Column) -> Column:
    """The runs of an abridged quote, which is joined by [...]."""
    return F.filter(F.transform(F.split(F.coalesce(display, F.lit("")), r"\[\.\.\.\]"), squeeze_ends), lambda s: s != "")


def squeeze_ends(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squashed(c: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def canonical_url(c: Column) -> Column:
    """Without query, fragment and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(c, r"[?#].*$", ""), "/+$", "")


def words_shown(c: Column) -> Column:
    """Alphanumeric runs, and each kana or Han character as one word (F26); Hangul has blanks."""
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), r"\[\.\.\.\]", " ")
    cjk = r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]"
    spaced = F.regexp_replace(plain, cjk, " ")
    return F.regexp_count(plain, F.lit(cjk)) + F.regexp_count(spaced, F.lit(r"[\p{L}\p{N}]+"))


def within(span: Column, text: Column) -> Column:
    """A non-empty span is verbatim in the text, white space apart."""
    return F.coalesce((F.length(span) > 0) & F.contains(squeeze(text), squeeze(span)), F.lit(False))


def spliced(display: Column, text: Column) -> Column:
    """Every run of an abridged quote is in the text, in order, without overlap; the first
    character of a run may differ in case (F25).  Folds over the runs; -1 marks failure."""
    hay = squeeze(text)

    def step(at: Column, seg: Column) -> Column:
        needle = squeeze(seg)
        first = F.substring(needle, 1, 1)
        other = F.when(F.upper(first) == first, F.lower(first)).otherwise(F.upper(first))
        a = _locate(needle, hay, at)
        b = _locate(F.concat(other, F.substr(needle, F.lit(2))), hay, at)
        hit = F.when(a == 0, b).when(b == 0, a).otherwise(F.least(a, b))
        return F.when(at < 0, at).when(hit == 0, F.lit(-1)).otherwise(hit + F.length(needle))

    runs = segments(display)
    return (F.size(runs) > 0) & (F.aggregate(runs, F.lit(1), step) > 0)


def _locate(needle: Column, hay: Column, at: Column) -> Column:
    """1-based place of needle in hay from ``at`` on, 0 if none."""
    return F.call_function("locate", needle, hay, F.greatest(at, F.lit(1)))


def passage(text: Column, starts: Column, ends: Column, longest: int = 8000, around: int = 2500) -> Column:
    """The text, or if it is long a window round its matches, with ellipses at cut ends.
    Without matches a long text gives its head."""
    n = F.length(text)
    lo = F.greatest(F.lit(0), F.coalesce(F.array_min(starts), F.lit(0)) - around)
    reach = F.least(n, F.coalesce(F.array_max(ends), F.lit(0)) + around)
    hi = F.when(reach - lo < longest, F.least(n, lo + longest)).otherwise(reach)
    cut = F.concat(F.when(lo > 0, "…").otherwise(""), F.substr(text, lo + 1, hi - lo), F.when(hi < n, "…").otherwise(""))
    return F.when(n <= longest, text).otherwise(cut)
