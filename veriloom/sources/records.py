"""Records of particular formats: XML speech walks, DOCX, releases, markup (P07, P11, P12, P14, P15,
P30, F14, F28-F30, X19, X26, X28)."""

from __future__ import annotations

import html
import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TURNS = T.ArrayType(T.StructType([T.StructField("speaker", T.StringType()), T.StructField("context", T.StringType()), T.StructField("text", T.StringType())]))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def speeches_of(xml: str | None, turn: str, name: str, body: str, context: str) -> list[dict]:
    """Turns of an XML record in document order: own name and own body only, the last context
    carried along; turns inside turns come after what precedes them (P14, P15)."""
    try:
        root = ElementTree.fromstring(xml or "")
    except ElementTree.ParseError:
        return []
    out: list[dict] = []
    now: str | None = None

    def own(node, tag: str) -> str | None:
        for kid in node:
            if _local(kid.tag) == tag:
                return " ".join("".join(kid.itertext()).split()) or None
        return None

    def walk(node) -> None:
        nonlocal now
        for kid in node:
            kind = _local(kid.tag)
            if kind == context:
                now = " ".join("".join(kid.itertext()).split()) or now
            elif kind == turn:
                said = own(kid, body)
                if said:
                    out.append({"speaker": own(kid, name), "context": now, "text": said})
                walk(kid)
            else:
                walk(kid)

    walk(root)
    return out


def speeches(xml: Column, turn: str, name: str, body: str, context: str) -> Column:
    @F.pandas_udf(_TURNS)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: speeches_of(x, turn, name, body, context))

    return run(xml)


def docx_text_of(content: bytes | None) -> str | None:
    """Paragraphs of a DOCX file; breaks are line ends, tabs are blanks."""
    try:
        root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(bytes(content or b""))).read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    piece = {"t": lambda n: n.text or "", "br": lambda n: "\n", "cr": lambda n: "\n", "tab": lambda n: " "}
    paras = ["".join(piece[_local(n.tag)](n) for n in p.iter() if _local(n.tag) in piece) for p in root.iter() if _local(p.tag) == "p"]
    return "\n".join(paras)


@F.pandas_udf(T.StringType())
def docx_text(content: pd.Series) -> pd.Series:
    return content.map(docx_text_of)


def release_of(page: str | None, drop: tuple[str, ...], shortest: int = 200) -> str | None:
    """The text of a press release: containers of given classes go, lines are kept once, and what
    is too short is none (P11)."""
    text = page or ""
    for name in drop:
        text = re.sub(rf"(?is)<(\w+)[^>]*class=\"[^\"]*\b{re.escape(name)}\b[^\"]*\"[^>]*>.*?</\1>", " ", text)
    text = re.sub(r"(?is)<(script|style|nav)\b.*?</\1>", " ", text)
    text = html.unescape(re.sub(r"(?s)<[^>]+>", "", re.sub(r"(?i)</?(?:p|div|li|h[1-6]|br|section)\b[^>]*>", "\n", text)))
    lines = list(dict.fromkeys(s for s in (" ".join(x.split()) for x in text.split("\n")) if s))
    body = "\n".join(lines)
    return body if len(body) >= shortest else None


def release(page: Column, drop: tuple[str, ...], shortest: int = 200) -> Column:
    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: release_of(x, drop, shortest))

    return run(page)


def statement_author(text: Column, roles: str, boilerplate: str, head: int = 800, longest: int = 4) -> Column:
    """The name after the first role in the head of a statement, cut at boilerplate, if it has no more
    than ``longest`` words (P07)."""
    who = F.regexp_extract(F.substring(text, 1, head), rf"(?:{roles})\s+((?:[A-Z][\w.'-]*\s*)+)", 1)
    cut = F.trim(F.regexp_replace(who, rf"(?i)\b(?:{boilerplate})\b.*$", ""))
    return F.when((cut != "") & (F.size(F.split(cut, r"\s+")) <= longest), cut)


def reasserted(docs: DataFrame, precision: Column) -> DataFrame:
    """Documents whose date precision differs from what their rule says, with the right one."""
    return docs.withColumn("new_precision", precision).where(~F.col("date_precision").eqNullSafe(F.col("new_precision")))


def language_by_words(text: Column, words: dict[str, str]) -> Column:
    """The language most of whose function words occur, first of equals; null if none does.
    ``words`` maps languages to regular expressions."""
    counts = {lang: F.regexp_count(text, F.lit(rf"(?iuU)\b(?:{p})\b")) for lang, p in words.items()}
    most = F.greatest(*counts.values()) if len(counts) > 1 else next(iter(counts.values()))
    out = F.lit(None).cast("string")
    for lang, n in reversed(counts.items()):
        out = F.when((n == most) & (most > 0), lang).otherwise(out)
    return out


def in_scope(family: Column, title: Column, allowed: list[str], only: dict[str, str]) -> Column:
    """Publications of allowed families; some only if their title names a chamber."""
    ok = family.isin(allowed)
    for name, chamber in only.items():
        ok = ok | ((family == name) & F.contains(title, F.lit(chamber)))
    return F.coalesce(ok, F.lit(False))


def meeting_in_scope(kind: Column, title: Column, date: Column, start: str, end: str) -> Column:
    """Open hearings within a window; a bad date is out."""
    d = F.try_to_date(F.substring(date, 1, 10), "yyyy-MM-dd")
    return F.coalesce((kind == "Hearing") & ~F.contains(F.upper(title), F.lit("CLOSED")) & d.between(start, end), F.lit(False))


def review_status(meta: Column) -> Column:
    """disputed where the record says that it continues another's sentence."""
    return F.when(F.get_json_object(meta, "$.continues_previous").isin("true", "1"), "disputed").otherwise("accepted")


def weekdays(spans: DataFrame) -> DataFrame:
    """Every weekday of (start, end) spans."""
    days = spans.select("*", F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("day"))
    return days.where(F.weekday("day") < 5)


def week_starts(spans: DataFrame) -> DataFrame:
    """The Mondays of the weeks that a span touches."""
    return spans.select("*", F.explode(F.sequence(F.trunc("start", "WEEK"), F.col("end"), F.expr("interval 7 days"))).alias("monday"))


def url_slug(title: Column) -> Column:
    """ASCII letters and digits of a title; debate where there are none."""
    return F.coalesce(F.nullif(F.regexp_replace(title, "[^A-Za-z0-9]", ""), F.lit("")), F.lit("debate"))


def markup_clean(text: Column, markers: str = r"\[[A-Z]{2}\]") -> Column:
    """Text without tags and editorial markers, squeezed; entities are for unescape()."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?i)<br\s*/?>|</p>", "\n"), r"(?s)<[^>]+>", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, markers, ""), r"(?U)[^\S\n]+", " "))
