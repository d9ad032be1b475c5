"""Articles, dates and names out of pages and labels."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCKS = "p|div|br|li|ul|ol|h[1-6]|table|tr|td|th|section|article|blockquote"


def flattened(markup: Column) -> Column:
    """Block tags to blanks, other tags to nothing, squeezed (P10); entities are for unescape()."""
    spaced = F.regexp_replace(markup, rf"(?is)</?(?:{BLOCKS})\b[^>]*>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, r"(?s)<[^>]+>", ""), r"(?U)\s+", " "))


# Containers of article bodies, by how much they are to be trusted.
CONTAINERS = (
    "div#UCAP-CONTENT",
    "div.pages_content",
    "div#News_Body_Txt_A",
    "div.article-con",
    "div#detailContent",
    "div.TRS_Editor",
    "div.trs_editor_view",
    "div#con_con",
    "div#ozoom",
    "div#zoom",
    "div.article",
    "div#Content",
    "div.content",)
#: What no reader of an article sees, and what ends an open paragraph.
MUTED = frozenset({"script", "style", "nav", "footer", "header"})
ENDS_PARAGRAPH = frozenset({*"p div section article main aside ul ol dl table form blockquote pre hr h1 h2 h3 h4 h5 h6 li td th tr".split(), *MUTED} - {"script", "style"})


@dataclass(eq=False)
class _Span:
    """An element and the text runs from ``first`` up to ``end`` that it holds."""

    tag: str
    id: str | None
    classes: frozenset[str]
    first: int
    end: int | None = None

    def answers(self, container: str) -> bool:
        """Whether this is the container that tag#id or tag.class names."""
        tag, mark, name = re.split(r"([#.])", container, maxsplit=1)
        return tag == self.tag and (name == self.id if mark == "#" else name in self.classes)


class _Outline(HTMLParser):
    """Text runs of a page, and the spans of its containers, paragraphs and headings; linear in the page."""

    def __init__(self, tags: set[str]) -> None:
        super().__init__(convert_charrefs=True)
        self.tags = frozenset(tags | MUTED | {"div", "p", "h1", "title"})
        self.runs: list[str] = []
        self.spans: list[_Span] = []
        self.open: list[_Span] = []
        self.depth: Counter[str] = Counter()
        self.muted = 0

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH:
            self.handle_endtag("p")
        if tag in self.tags:
            named = dict(attrs)
            span = _Span(tag, named.get("id"), frozenset((named.get("class") or "").split()), len(self.runs))
            if not self.muted and tag not in MUTED:
                self.spans.append(span)
            self.open.append(span)
            self.depth[tag] += 1
            self.muted += tag in MUTED

    def handle_endtag(self, tag):
        while self.depth[tag]:
            span = self.open.pop()
            span.end = len(self.runs)
            self.depth[span.tag] -= 1
            self.muted -= span.tag in MUTED
            if span.tag == tag:
                return

    def handle_data(self, data):
        if not self.muted and (data := data.strip()):
            self.runs.append(data)

    def text(self, span: _Span, between: str = " ") -> str:
        return " ".join(between.join(self.runs[span.first : span.end]).split())


def article_of(page: str | None, containers: tuple[str, ...] = CONTAINERS) -> tuple[str | None, str | None]:
    """Title (first h1 over title) and paragraphs of 20 characters and more (P09), a line each.

    They are those anywhere below the first of ``containers`` whose first element holds over 200
    characters, else below the div with the most text, else of the whole page.  Where none is long
    enough, the body is all text there; null where there is none.
    """
    if not page:
        return None, None
    p = _Outline({re.split("[#.]", c)[0] for c in containers})
    p.feed(page)
    p.close()
    upto = [0, *accumulate(map(len, p.runs))]
    for span in p.open:
        span.end = len(p.runs)

    def size(span: _Span) -> int:
        return upto[span.end] - upto[span.first]

    known = (next((s for s in p.spans if s.answers(c)), None) for c in containers)
    body = next((s for s in known if s and size(s) > 200), None) or max((s for s in p.spans if s.tag == "div"), key=size, default=_Span("", None, frozenset(), 0, len(p.runs)))
    at = p.spans.index(body) if body in p.spans else -1
    inside = [s for s in p.spans[at + 1 :] if s.tag == "p" and s.end <= body.end]
    lines = [x for s in inside or [body] if len(x := p.text(s)) >= 20] or [p.text(body)]
    heads = (next((s for s in p.spans if s.tag == tag), None) for tag in ("h1", "title"))
    return next((x for s in heads if s and (x := p.text(s, ""))), None), "\n".join(lines) or None


@F.pandas_udf(T.StructType([T.StructField("title", T.StringType()), T.StructField("body", T.StringType())]))
def article(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([article_of(x) for x in s], columns=["title", "body"])


def earliest(captures: DataFrame, url: Column, ts: str) -> DataFrame:
    """The first capture of each canonical URL."""
    return captures.groupBy(url.alias("url")).agg(F.min(ts).alias(ts))


def url_date(url: Column) -> tuple[Column, Column]:
    """Date and precision (day or month) that a URL names (P25)."""
    day = F.regexp_extract(url, r"(\d{4})[-/]?(0[1-9]|1[0-2])[-/]?(0[1-9]|[12]\d|3[01])(?!\d)", 0)
    month = F.regexp_extract(url, r"(\d{4})[-/](0[1-9]|1[0-2])(?!\d)", 0)
    clean = lambda c: F.regexp_replace(c, "[-/]", "")
    d = F.when(day != "", F.try_to_date(clean(day), "yyyyMMdd"))
    m = F.when(month != "", F.try_to_date(F.concat(clean(month), F.lit("01")), "yyyyMMdd"))
    return F.coalesce(d, m), F.when(d.isNotNull(), "day").when(m.isNotNull(), "month")


def month_date(text: Column, months: dict[str, int]) -> Column:
    """A date written with a month's name in any language."""
    names = "|".join(months)
    part = lambda i: F.regexp_extract(text, rf"(?iuU)(\d{{1,2}})\s+({names})\s+(\d{{4}})", i)
    m = F.create_map(*[F.lit(x) for kv in months.items() for x in (kv[0].lower(), kv[1])])
    return F.try_to_date(F.concat_ws("-", part(3), F.lpad(F.try_element_at(m, F.lower(part(2))).cast("string"), 2, "0"), F.lpad(part(1), 2, "0")), "yyyy-MM-dd")


def recovered_date(body: Column, meta: str, dateline: str) -> Column:
    """From a meta tag, else a dateline; patterns with one ISO date group."""
    one = lambda p: F.try_to_date(F.nullif(F.regexp_extract(body, p, 1), F.lit("")), "yyyy-MM-dd")
    return F.coalesce(one(meta), one(dateline))


def congress(date: Column) -> Column:
    """The number of the US congress that sat on a date; it changes on 3 January."""
    y = F.year(date) - F.when((F.month(date) == 1) & (F.dayofmonth(date) < 3), 1).otherwise(0)
    return F.floor((y - 1789) / 2) + 1


def preferred(texts: Column, language: Column) -> Column:
    """A map's text in a language, else in English, else the first."""
    return F.coalesce(F.try_element_at(texts, language), F.try_element_at(texts, F.lit("en")), F.try_element_at(F.map_values(texts), F.lit(1)))


def last_field(title: Column, sep: str = " - ", reject: str = r"(?i)\brule\b") -> Column:
    """The last field of a title, unless it cites a rule."""
    parts = F.split(title, sep)
    last = F.trim(F.element_at(parts, -1))
    return F.when((F.size(parts) > 1) & ~F.rlike(last, F.lit(reject)), last)


def title_speaker(title: Column) -> Column:
    """Whose speech a title announces, unless an institution's or several people's."""
    who = F.trim(F.regexp_extract(title, r"^(?:Speech|Remarks|Statement|Address|Keynote)\b.*?\bby\s+([^,;:]+)", 1))
    return F.when((who != "") & ~F.rlike(who, F.lit(r"(?i)\b(?:council|commission|ministers|and)\b")), who)


def label(name: Column, country: Column, role: Column) -> Column:
    """Name (Country), Role with what there is of it."""
    who = F.when(country.isNotNull(), F.concat(name, F.lit(" ("), country, F.lit(")"))).otherwise(name)
    return F.coalesce(F.when(role.isNotNull() & who.isNotNull(), F.concat(who, F.lit(", "), role)), who, role)


def is_label(text: Column, honorifics: str, stop: list[str]) -> Column:
    """Whether a line is a speaker's label: an honorific or office, or capitals, and no stop word."""
    return (F.rlike(text, F.lit(f"^(?:{honorifics})\\b")) | F.rlike(text, F.lit(r"(?U)^[\p{Lu} .'-]{4,60}:?$"))) & ~F.lower(F.trim(text)).isin(stop)


def assembled_name(given: Column, particle: Column, family: Column) -> Column:
    """Given name, lower-case particle, family name; nothing twice (P20)."""
    g = F.when(F.startswith(family, F.concat(given, F.lit(" "))), F.lit("")).otherwise(F.coalesce(given, F.lit("")))
    return F.trim(F.regexp_replace(F.concat_ws(" ", g, F.lower(particle), family), " +", " "))


def normal_label(text: Column, title: str) -> Column:
    """Surname, title, given name to name with title behind."""
    m = lambda i: F.regexp_extract(text, rf"^(.)({title})(.+)$", i)
    return F.when(m(2) != "", F.concat(m(1), m(3), F.lit(" ("), m(2), F.lit(")"))).otherwise(text)


def lists_under(value, key: str) -> list:
    """Every list under a key, anywhere in a decoded JSON value."""
    out, todo = [], [value]
    while todo:
        v = todo.pop(0)
        if isinstance(v, dict):
            out += [x for k, x in v.items() if k == key and isinstance(x, list)]
            todo += list(v.values())
        elif isinstance(v, list):
            todo += v
    return out


def definitions(markdown: str) -> dict[str, dict[str, str]]:
    """Slug -> title and text from wrapped bullets ``- `a`, `b`: Title. Text``."""
    out: dict[str, dict[str, str]] = {}
    for item in re.split(r"\n(?=- )", "\n" + markdown):
        m = re.match(r"\s*- ((?:`[a-z0-9_]+`[,/ ]*)+)[:—-]*\s*(.*)", " ".join(item.split()))
        for s in re.findall(r"`([a-z0-9_]+)`", m[1]) if m else ():
            title, _, text = m[2].partition(". ")
            out[s] = {"title": title.rstrip("."), "text": text}
    return out
