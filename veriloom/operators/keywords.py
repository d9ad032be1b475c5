"""Dictionary terms in texts with code-point offsets, and the candidates they make."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MATCH
from ..sources import settings


@dataclass(frozen=True)
class TermList:
    """Terms of one language; unsegmented scripts match anywhere, others at word edges."""

    lang: str
    terms: tuple[str, ...]
    segmented: bool = True


def read_lists(folder: str) -> list[TermList]:
    """Term lists kept as YAML or JSON files {lang, segmented, keywords}, in file order."""
    out = []
    for path in _files(folder):
        d = settings.read(path)
        out.append(TermList(d.get("lang", path.stem), tuple(map(str, d.get("keywords") or ())), d.get("segmented", True)))
    return out


def _files(folder: str) -> list[Path]:
    return sorted(p for p in Path(folder).iterdir() if p.suffix in (".yaml", ".json"))


def version(lists: list[TermList]) -> str:
    """Sixteen hex digits that change with any term list."""
    return hashlib.sha256("\x1f".join(f"{t.lang}\n{t.segmented}\n" + "\n".join(t.terms) for t in lists).encode()).hexdigest()[:16]


def folder_version(folder: str) -> str:
    """The same of a folder of lists: names and contents of its files."""
    return hashlib.sha256("\x1f".join(f"{p.name}\n{p.read_text(encoding='utf-8')}" for p in _files(folder)).encode()).hexdigest()[:16]


def search_terms(terms: TermList) -> list[str]:
    """Terms for search services that know no wildcards."""
    return [t.strip("*") for t in terms.terms]


@dataclass(frozen=True)
class Shape:
    """What a term asks of a text: pieces to match one after the other (characters, or "*" for the rest
    of a word), whether a word starts and ends at its edges, and whether case counts."""

    pieces: tuple[str, ...]
    starts: bool = False
    ends: bool = False
    cased: bool = False

    @staticmethod
    def of(term: str, segmented: bool) -> Shape:
        """Wildcards stand for the rest of a word at the ends, for letters inside; terms in capitals keep
        their case; word edges count beside letters and digits; unsegmented terms are literal (F01)."""
        if not segmented:
            return Shape(tuple("\\*" if c == "*" else c for c in term), cased=True)
        inner = term.removeprefix("*").removesuffix("*")
        wordy = lambda c: c.isalnum() or c == "_"
        return Shape(
            tuple(term),
            not term.startswith("*") and wordy(inner[:1] or " "),
            not term.endswith("*") and wordy(inner[-1:] or " "),
            bool(inner) and all("A" <= c <= "Z" or c in ".&-" for c in inner),
        )


def _piece(c: str, word: str) -> str:
    if c == "*":
        return f"{word}*"
    return "['’]" if c == "'" else c if c.isalnum() or c in " _" or ord(c) > 127 or len(c) > 1 else "\\" + c


def python_pattern(term: str, segmented: bool) -> re.Pattern:
    shape = Shape.of(term, segmented)
    body = "".join(_piece(c, r"\w") for c in shape.pieces)
    return re.compile((r"\b" if shape.starts else "") + body + (r"\b" if shape.ends else ""), re.NOFLAG if shape.cased else re.IGNORECASE)


#: A word character as Python and the term lists have it.
WORD = r"[\p{L}\p{N}_]"


def any_pattern(lists: list[TermList]) -> str:
    """One Java regular expression that finds something where some term of the lists matches.  Terms
    with equal edges share a tree of their beginnings, so a place in a text is tested once for each
    first character, not for each term."""
    trees: dict[tuple[bool, bool, bool], dict] = {}
    for t in lists:
        for term in t.terms:
            shape = Shape.of(term, t.segmented)
            node = trees.setdefault((shape.starts, shape.ends, shape.cased), {})
            for c in shape.pieces:
                node = node.setdefault(c if shape.cased else c.lower(), {})
            node[""] = {}

    def joined(node: dict) -> str:
        parts = ["" if c == "" else _piece(c, WORD) + joined(rest) for c, rest in sorted(node.items(), key=lambda x: (x[0] == "", x[0]))]
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    kinds = [("" if cased else "(?iu)") + (f"(?<!{WORD})" if starts else "") + joined(tree) + (f"(?!{WORD})" if ends else "") for (starts, ends, cased), tree in sorted(trees.items())]
    return "|".join(f"(?:{k})" for k in kinds) or r"(?!)"


def base_language(lang: Column, lists: list[TermList]) -> Column:
    """The tag if it has a list, else what stands before its first hyphen."""
    return F.when(lang.isin([t.lang for t in lists]), lang).otherwise(F.element_at(F.split(F.coalesce(lang, F.lit("")), "-"), 1))


def hits(text: Column, lang: Column, lists: list[TermList]) -> Column:
    """Whether a term of the text's list is in it; without a list, of any (F02).  One pattern is tested
    for each row."""
    base, out = base_language(lang, lists), None
    for t in lists:
        test = F.rlike(text, F.lit(any_pattern([t])))
        out = F.when(base == t.lang, test) if out is None else out.when(base == t.lang, test)
    every = F.rlike(text, F.lit(any_pattern(lists)))
    return F.coalesce(every if out is None else out.otherwise(every), F.lit(False))


def matches_of(text: str, base: str | None, lists: tuple[TermList, ...]) -> list[dict]:
    """Matches of one text, sorted by offsets; a term that two lists share counts once, for the first."""
    own = [t for t in lists if t.lang == base] or lists
    found: dict[tuple[str, int, int], str] = {}
    for t in own:
        for term, pattern in _compiled(t):
            for m in pattern.finditer(text):
                found.setdefault((term, *m.span()), t.lang)
    rows = [{"keyword": k, "lang": lang, "start": a, "end": z} for (k, a, z), lang in found.items()]
    return sorted(rows, key=lambda r: (r["start"], r["end"]))


@lru_cache(64)
def _compiled(t: TermList) -> list[tuple[str, re.Pattern]]:
    return [(term, python_pattern(term, t.segmented)) for term in t.terms]


def matches(text: Column, lang: Column, lists: list[TermList]) -> Column:
    """Every match of the text's language list, sorted by offsets; a language without a list (or
    several languages at once) takes all lists (F02).  Only texts that some pattern finds go to
    Python, which knows offsets in code points and overlapping terms."""
    known = tuple(lists)

    def run(texts: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([[] if t is None else matches_of(t, b, known) for t, b in zip(texts, bases, strict=True)])

    # Not deterministic for the planner alone: so that a filter on the result does not run it again.
    found = F.pandas_udf(run, f"array<{MATCH}>").asNondeterministic()
    return found(F.when(hits(text, lang, lists), text), base_language(lang, lists))


def scanned(rows: DataFrame, text: str, lang: str, lists: list[TermList]) -> DataFrame:
    """The rows that match, with their ``matches``: one pattern for each row filters in the JVM, and
    matches are found once, behind it."""
    some = rows.where(hits(F.col(text), F.col(lang), lists))
    return some.withColumn("matches", matches(F.col(text), F.col(lang), lists)).where(F.size("matches") > 0)


def sorted_matches(m: Column) -> Column:
    """By start, then end; equal offsets stay in list order."""
    keyed = F.transform(m, lambda x, i: F.struct(x["start"].alias("a"), x["end"].alias("b"), i.alias("i"), x.alias("m")))
    return F.transform(F.array_sort(keyed), lambda x: x["m"])


def candidates(utterances: DataFrame, lists: list[TermList], existing: DataFrame | None = None, sources: list[str] | None = None) -> DataFrame:
    """Utterances not yet scanned at this version that match (F05).  ``existing`` has
    utterance_id and keyword_version."""
    tag = version(lists)
    rows = utterances if sources is None else utterances.where(F.col("source").isin(sources))
    if existing is not None:
        rows = rows.join(existing.where(F.col("keyword_version") == tag).select(F.col("utterance_id").alias("id")), "id", "left_anti")
    return scanned(rows, "text", "language", lists).withColumn("keyword_version", F.lit(tag))


def migrated(cands: DataFrame, quoted: DataFrame, judged: DataFrame) -> DataFrame:
    """One candidate of each utterance moves to a new version: with a quote, else with a verdict,
    else the newest (F06, W07).  ``quoted`` and ``judged`` have candidate_id."""
    has = lambda df, name: df.select(F.col("candidate_id").alias("id")).distinct().withColumn(name, F.lit(1))
    rows = cands.join(has(quoted, "q"), "id", "left").join(has(judged, "j"), "id", "left")
    best = Window.partitionBy("utterance_id").orderBy(F.col("q").desc_nulls_last(), F.col("j").desc_nulls_last(), F.col("id").desc())
    return rows.withColumn("r", F.row_number().over(best)).where("r = 1").drop("q", "j", "r")


def pruned(cands: DataFrame, judged: DataFrame, current: str) -> DataFrame:
    """Without candidates of old versions that were never judged."""
    seen = judged.select(F.col("candidate_id").alias("id")).distinct().withColumn("seen", F.lit(True))
    return cands.join(seen, "id", "left").where((F.col("keyword_version") == current) | F.col("seen")).drop("seen")


def ablation(scanned: DataFrame, accepted: Column) -> DataFrame:
    """For each keyword: candidates, those no other keyword finds, and those of them accepted."""
    words = scanned.select(F.array_distinct(F.col("matches.keyword")).alias("ks"), accepted.alias("ok")).where(F.size("ks") > 0)
    each = words.select(F.explode("ks").alias("keyword"), (F.size("ks") == 1).alias("alone"), "ok")
    return each.groupBy("keyword").agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.count_if("alone").alias("n_unique"),
        F.count_if(F.col("alone") & F.coalesce(F.col("ok"), F.lit(False))).alias("n_unique_accepted"),
    )
