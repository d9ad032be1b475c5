"""Personal data: regular expressions propose spans, checksums confirm them, context scores them.

Four base kinds (email, ip, card, phone) are reported whenever pattern and check agree, whatever
their score.  Added kinds (iban, ssn) are reported when their check passes and the score, moved up
or down by words nearby, reaches ACCEPT.  Patterns run in time linear in the text, on long unbroken
runs too: an address is found from its ``@`` outwards, and runs of digits are matched once.

Defined results: null counts as empty text and has no spans; offsets are code points, ends exclusive;
rows that repeat give repeated results; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, only, record, slices, texts_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
ACCEPT = 0.5
#: Characters on either side of a span that are searched for context words.
NEAR = 48

# Words that speak for a kind, and words that speak against any (fixed values of this operator).
FOR = {
    "email": r"e-?mail|mail|contact|write|reach",
    "ip": r"\bip\b|address|host|server|client|login",
    "card": r"card|visa|credit|debit|payment|master",
    "phone": r"phone|tel|call|mobile|cell|fax|contact",
    "iban": r"iban|account|bank|transfer|konto|compte|cuenta",
    "ssn": r"ssn|social security|taxpayer|tax id",
}
AGAINST = re.compile(r"version|build|release|order no|invoice|serial|isbn|part no|example", re.I)
FOR_RE = {k: re.compile(v, re.I) for k, v in FOR.items()}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.6, "phone": 0.5, "iban": 0.6, "ssn": 0.3}

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    prev, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > prev and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            prev = m.end()
            yield start, prev
        at = text.find("@", at + 1)


def _octet(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) < 4 and int(s or "0") <= 255


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans that pattern and check agree on."""
    for s, e in emails(text):
        yield "email", s, e
    for m in IP.finditer(text):
        if all(map(_octet, m.groups())):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for m in IBAN.finditer(text):
        if 15 <= len(m[0].replace(" ", "")) <= 34 and mod97(m[0]):
            yield "iban", m.start(), m.end()
    for m in SSN.finditer(text):
        yield "ssn", m.start(), m.end()


def find(text: str) -> list[Span]:
    out = []
    for kind, s, e in _proposed(text):
        around = f"{text[max(0, s - NEAR) : s]} {text[e : e + NEAR]}"
        score = PRIOR[kind] + 0.3 * bool(FOR_RE[kind].search(around)) - 0.3 * bool(AGAINST.search(around))
        if kind in BASE or score >= ACCEPT:
            out.append(Span(s, KINDS.index(kind), e, min(1.0, max(0.0, round(score, 3)))))
    return sorted(out)


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[x.kind]}:{x.start}:{x.end}" for x in spans)


DIGEST = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_email", pa.int64()), ("n_ip", pa.int64()), ("n_card", pa.int64()), ("n_phone", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])
SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>"


def pii_digests(docs: DataFrame) -> DataFrame:
    """Counts of base kinds, the digest of base spans, and all spans, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [find(t) for t in texts_of(b)]
            base = [[x for x in f if x.kind < len(BASE)] for f in found]
            n = {f"n_{k}": [sum(x.kind == i for x in f) for f in base] for i, k in enumerate(BASE)}
            yield record(
                _DIGEST,
                doc_id=b.column("doc_id"),
                base_sha256=[hashlib.sha256(written_out(f).encode()).hexdigest() for f in base],
                spans=[written_out(f) for f in found],
                n_added=[len(f) - len(x) for f, x in zip(found, base, strict=True)],
                **n,
            )

    return map_arrow(only(docs, "doc_id", "text"), run, DIGEST)


def pii_spans(docs: DataFrame) -> DataFrame:
    """doc_id and its scored spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for b in slices(batches):
            rows = [[{"kind": KINDS[x.kind], "start": x.start, "end": x.end, "score": x.score} for x in find(t)] for t in texts_of(b)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    return map_arrow(only(docs, "doc_id", "text"), run, SPANS)


def redacted(text: str) -> str:
    """Spans replaced by their kind; spans that overlap become one, named after the first."""
    out, at = [], 0
    for x in find(text):
        if x.start >= at:
            out += [text[at : x.start], f"<{KINDS[x.kind].upper()}>"]
        at = max(at, x.end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with personal data in ``text`` replaced (null stays null);
    ``n_chars``, if there is such a column, is counted again."""
    at = docs.columns.index(text)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            new = [None if t is None else redacted(t) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    out = map_arrow(docs, run, schema)
    if n_chars and n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(F.col(text).isNull(), F.col(n_chars)).otherwise(F.length(text).cast(schema[n_chars].dataType)))
    return out
