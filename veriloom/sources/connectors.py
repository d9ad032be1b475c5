"""Sources put together (S17): raw responses to utterances, by Spark's JSON reader or one walk of an XML file.

Every parser takes a frame of raw responses and returns ``COLUMNS``: the fields of the document and of
one utterance.  A response that cannot be read gives no rows.  Fetching is the caller's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date
from html.parser import HTMLParser
from itertools import groupby
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pages
from .records import url_slug
from .registry import Registry, Source

COLUMNS = ["native_id", "url", "doc_date", "title", "doc_type", "seq", "speaker_raw", "speaker_native_id", "text", "speech_context", "is_verbatim"]


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def some(*values: Column) -> Column:
    """The first that is neither null nor empty; null if none is."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def with_note(name: Column, note: Column) -> Column:
    """name (note), or the name alone."""
    return F.when(note.isNotNull(), F.format_string("%s (%s)", F.coalesce(name, F.lit("")), note)).otherwise(name)


def _records(raw: DataFrame, field: str, of: str, *keep: str) -> DataFrame:
    """One row of columns for each object of the array ``field`` in the JSON of ``content``."""
    got = F.from_json("content", f"{field} array<struct<{of}>>")[field]
    return raw.select(*keep, F.explode(got).alias("r")).select(*keep, "r.*")


def _utterances(rows: DataFrame, **columns: Column) -> DataFrame:
    own = {"speaker_native_id": F.lit(None).cast("string"), "seq": F.lit(0), "is_verbatim": F.lit(True)} | columns
    return rows.select(*[own[c].alias(c) for c in COLUMNS]).withColumn("seq", F.col("seq").cast("int")).where("text <> ''")


# -- JSON ------------------------------------------------------------------------------------------


def kokkai(raw: DataFrame) -> DataFrame:
    """Pages of the Diet's speech search (content); speeches found by several terms count once."""
    fields = "speechID issueID nameOfHouse nameOfMeeting issue date meetingURL speechOrder speaker speakerGroup speakerPosition speech"
    r = _records(raw, "speechRecord", ",".join(f"{f} string" for f in fields.split())).dropDuplicates(["speechID"])
    meeting = F.trim(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("nameOfHouse", "nameOfMeeting", "issue")]))
    order = F.coalesce(F.nullif(F.expr("try_cast(speechOrder AS int)"), F.lit(0)), F.expr("try_cast(substring_index(speechID, '_', -1) AS int)"))
    who = with_note(F.coalesce("speaker", F.lit("")), some(F.col("speakerGroup"), F.col("speakerPosition")))
    return _utterances(r, native_id=F.col("issueID"), url=F.col("meetingURL"), doc_date=F.expr("try_cast(date AS date)"), title=meeting, doc_type=F.lit("debate"), seq=order, speaker_raw=who, text=stripped(F.col("speech")), speech_context=meeting)


def debate_url(house: Column, day: Column, debate: Column, title: Column, contribution: Column | None = None) -> Column:
    """Address of a debate, or of a contribution in it."""
    url = F.concat_ws("/", F.lit("https://hansard.parliament.uk"), house, day, F.lit("debates"), debate, url_slug(title))
    return url if contribution is None else F.concat(url, F.coalesce(F.concat(F.lit("#contribution-"), some(contribution)), F.lit("")))


def hansard(raw: DataFrame) -> DataFrame:
    """Pages of the contribution search (content) with their kind, Spoken or Written; a contribution counts once."""
    fields = "ContributionExtId ContributionTextFull SittingDate DebateSectionExtId DebateSectionId DebateSection House ItemId OrderInDebateSection AttributedTo MemberName MemberId"
    r = _records(raw, "Results", ",".join(f"{f} string" for f in fields.split()), "kind").dropDuplicates(["ContributionExtId"])
    text = F.regexp_replace(stripped(F.replace("ContributionTextFull", F.lit("\r\n"), F.lit("\n"))), "<[^>]+>", "")
    house, title = (F.coalesce(c, F.lit("")) for c in ("House", "DebateSection"))
    day = F.coalesce(F.substring("SittingDate", 1, 10), F.lit(""))
    debate = F.coalesce(some(F.col("DebateSectionExtId")), F.concat(F.lit("unknown-"), F.coalesce("DebateSectionId", F.lit(""))))
    none = [F.nullif(F.col(c), F.lit("0")) for c in ("ItemId", "OrderInDebateSection", "MemberId")]
    return _utterances(
        r,
        native_id=debate,
        url=debate_url(house, day, debate, title),
        doc_date=F.expr("try_cast(substring(SittingDate, 1, 10) AS date)"),
        title=title,
        doc_type=F.when(F.col("kind") == "Spoken", "debate").otherwise("written"),
        seq=F.coalesce(none[0], none[1], F.lit("0")),
        speaker_raw=some(F.col("AttributedTo"), F.col("MemberName")),
        speaker_native_id=some(none[2]),
        text=text,
        speech_context=F.concat_ws(", ", house, some(title)),
        is_verbatim=F.col("kind") == "Spoken",
    )


def presidential(raw: DataFrame) -> DataFrame:
    """Presidential documents: the record (content, JSON) and its plain text (body); short ones are none."""
    fields = "document_number string, html_url string, title string, subtype string, signing_date string, publication_date string, president struct<name string>"
    r = raw.select("body", F.from_json("content", fields).alias("r")).select("body", "r.*")
    text = stripped(F.regexp_replace(F.regexp_replace("body", "<[^>]+>", ""), r"\n{3,}", "\n\n"))
    kind, who = some(F.col("subtype")), some(F.col("president.name"))
    return _utterances(
        r.where(F.length(text) >= 200),
        native_id=F.col("document_number"),
        url=F.col("html_url"),
        doc_date=F.coalesce(*[F.expr(f"try_cast({c} AS date)") for c in ("signing_date", "publication_date")]),
        title=F.col("title"),
        doc_type=F.replace(F.lower(F.coalesce(kind, F.lit("presidential_document"))), F.lit(" "), F.lit("_")),
        speaker_raw=F.concat(who, F.lit(" (President)")),
        text=text,
        speech_context=F.concat(F.coalesce(kind, F.lit("Presidential Document")), F.lit(": "), F.coalesce(some(F.col("title")), F.col("document_number"))),
    )


# -- XML -------------------------------------------------------------------------------------------

_TURN = T.StructType().add("speaker", "string").add("native_id", "string").add("text", "string")
_SITTING = T.StructType().add("day", "date").add("title", "string").add("context", "string").add("turns", T.ArrayType(_TURN))


def _all_text(node: ElementTree.Element | None) -> str:
    return "" if node is None else "".join(node.itertext())


def _words(node: ElementTree.Element | None) -> str:
    return " ".join(_all_text(node).split())


def _day(year: str | None, month: str | None, day: str | None) -> date | None:
    try:
        return date(int(year or ""), int(month or ""), int(day or ""))
    except ValueError:
        return None


def commons_sitting(root: ElementTree.Element, native_id: str) -> tuple | None:
    """Interventions of a sitting, whose id is parliament, session and number, such as 441-007."""
    about = {i.get("Name"): (i.text or "").strip() for i in root.iter("ExtractedItem")}
    day = _day(*[about.get(f"MetaDateNum{part}") for part in ("Year", "Month", "Day")])
    session, _, number = native_id.partition("-")
    number = number.lstrip("0")
    turns = []
    for said in root.iter("Intervention"):
        person = said.find(".//PersonSpeaking/Affiliation")
        name = _words(person).strip(" :")
        text = "\n".join(filter(None, map(_words, said.findall(".//Content//ParaText"))))
        if name and text:
            turns.append((name, person.get("DbId"), text))
    return day and (day, f"House of Commons Debates, {about.get('Parliament', session)} No. {number}", f"House of Commons, sitting {session[:2]}-{session[2:3]}/{number}", turns)


# Classes of paragraphs that hold speech.
SPEECH = frozenset({"J", "J_1", "O", "Z"})


def bundestag_sitting(root: ElementTree.Element, native_id: str) -> tuple | None:
    """Speeches of a protocol: paragraphs while the first speaker holds the floor."""
    day = _day(*(root.get("sitzung-datum") or "").split(".")[::-1]) if (root.get("sitzung-datum") or "").count(".") == 2 else None
    name = f"Plenarprotokoll {root.get('wahlperiode')}/{root.get('sitzung-nr')}"
    turns = []
    for speech in root.iter("rede"):
        lead = speech.find(".//redner")
        holder = own = lead.get("id") if lead is not None else None
        lines = []
        for part in speech:
            kind = part.get("klasse")
            if part.tag == "name":
                holder = "chair"
            elif part.tag == "p" and kind == "redner":
                now = part.find(".//redner")
                holder = now.get("id") if now is not None else "nobody"
            elif part.tag == "p" and kind in SPEECH and holder == own:
                lines.append(_all_text(part).strip())
        who = None
        if lead is not None:
            first, last, group, role = (lead.findtext(f".//{tag}") or "" for tag in ("vorname", "nachname", "fraktion", "rolle_lang"))
            who = f"{first} {last}".strip() + (f" ({group or role})" if group or role else "")
        if text := "\n".join(filter(None, lines)):
            turns.append((who, own, text))
    return day and (day, name, f"Bundestag, {name}", turns)


def assemblee_sitting(root: ElementTree.Element, native_id: str) -> tuple | None:
    """Turns of a sitting: neighbouring paragraphs of one actor and name."""
    ns = {"an": root.tag[1:].partition("}")[0]} if root.tag.startswith("{") else {"an": ""}
    raw = root.findtext(".//an:metadonnees/an:dateSeance", "", ns) or ""
    day = _day(raw[:4], raw[4:6], raw[6:8])
    said = []
    for p in root.iterfind(".//an:paragraphe", ns):
        name, text = (p.findtext(".//an:orateurs/an:orateur/an:nom", "", ns) or "").strip(), _words(p.find("an:texte", ns))
        if name and text:
            said.append((name, p.get("id_acteur") or None, text))
    turns = [(*who, "\n".join(text for _, _, text in some)) for who, some in groupby(said, key=lambda t: t[:2])]
    return day and (day, f"AN, séance du {root.findtext('.//an:metadonnees/an:dateSeanceJour', None, ns)}", f"Assemblée nationale, séance du {day.isoformat()}", turns)


# Classes of spans that are not speech.
ASIDES = frozenset({"orateur_nom", "info_entre_parentheses"})


def _local(node: ElementTree.Element) -> str:
    return node.tag.rpartition("}")[2]


def _without_asides(node: ElementTree.Element) -> Iterator[str]:
    """Text of a node but for names and stage directions; what follows those stays."""
    yield node.text or ""
    for kid in node:
        if _local(kid) != "span" or kid.get("class") not in ASIDES:
            yield from _without_asides(kid)
        yield kid.tail or ""


def senat_sitting(root: ElementTree.Element, native_id: str) -> tuple | None:
    """Interventions of a sitting, whose id holds its day, such as d20240507."""
    day = _day(native_id[1:5], native_id[5:7], native_id[7:9])
    turns = []
    for said in root.iter():
        name = (said.get("nom") or "").strip()
        if _local(said) == "intervenant" and name:
            lines = [" ".join("".join(_without_asides(p)).split()) for p in said.iter() if _local(p) == "p"]
            who = f"{said.get('civ', '')} {name}".strip() + (f" ({said.get('qua')})" if said.get("qua") else "")
            if text := "\n".join(filter(None, lines)):
                turns.append((who, said.get("mat"), text))
    sitting = day and f"Sénat, séance du {day.isoformat()}"
    return day and (day, sitting, sitting, turns)


def _sittings(walk: Callable[[ElementTree.Element, str], tuple | None], encoding: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """Parser of XML files (native_id, url, content as bytes): a file without a date gives no rows.
    ``encoding`` is that of files which declare another."""

    def one(content: bytes | None, native_id: str | None) -> tuple:
        try:
            got = walk(ElementTree.fromstring(bytes(content or b""), ElementTree.XMLParser(encoding=encoding)), native_id or "")
        except ElementTree.ParseError:
            got = None
        return got or (None, None, None, [])

    @F.pandas_udf(_SITTING)
    def sitting(content: pd.Series, native_id: pd.Series) -> pd.DataFrame:
        rows = [one(c, n) for c, n in zip(content, native_id, strict=True)]
        return pd.DataFrame([(d, t, x, [dict(zip(_TURN.names, turn, strict=True)) for turn in turns]) for d, t, x, turns in rows], columns=_SITTING.names)

    def parse(raw: DataFrame) -> DataFrame:
        r = raw.select("native_id", "url", sitting("content", "native_id").alias("s")).select("native_id", "url", "s.*")
        r = r.select("*", F.posexplode("turns").alias("at", "turn"))
        return _utterances(r, native_id=F.col("native_id"), url=F.col("url"), doc_date=F.col("day"), title=F.col("title"), doc_type=F.lit("debate"), seq=F.col("at"), speaker_raw=F.col("turn.speaker"), speaker_native_id=F.col("turn.native_id"), text=F.col("turn.text"), speech_context=F.col("context"))

    return parse


# -- pages -----------------------------------------------------------------------------------------


def articles(raw: DataFrame) -> DataFrame:
    """One utterance a page (url, content) of at least 100 characters, named and dated by its address;
    whose words they are is not said."""
    r = raw.select("url", pages.article("content").alias("a"))
    stem = F.regexp_replace(F.substring_index("url", "/", -1), r"\.[^.]*$", "")
    rows = _utterances(r, native_id=stem, url=F.col("url"), doc_date=pages.url_date(F.col("url"))[0], title=F.col("a.title"), doc_type=F.lit("readout"), speaker_raw=F.lit(None).cast("string"), text=F.col("a.body"), speech_context=F.col("a.title"), is_verbatim=F.lit(False))
    return rows.where(F.length("text") >= 100)


class _Paragraphs(HTMLParser):
    """Paragraphs as (label, text): the label is a strong element at their very beginning."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[list[str], list[str]]] = []
        self.state = "out"

    def handle_starttag(self, tag, attrs):
        if tag == "p":
            self.found.append(([], []))
            self.state = "fresh"
        elif self.state == "fresh":
            self.state = "label" if tag == "strong" else "text"

    def handle_endtag(self, tag):
        if tag == "p":
            self.state = "out"
        elif tag == "strong" and self.state == "label":
            self.state = "text"

    def handle_data(self, data):
        if self.state != "out" and (data := " ".join(data.split())):
            if self.state == "fresh":
                self.state = "text"
            self.found[-1][self.state == "text"].append(data)


def labelled_turns(page: str | None) -> list[tuple[str | None, str]]:
    """Turns that <p><strong>label</strong>: opens, carried on by other paragraphs; what comes before the
    first is nobody's."""
    p = _Paragraphs()
    p.feed(page or "")
    p.close()
    turns: list[tuple[str | None, list[str]]] = [(None, [])]
    for label, text in ((" ".join(a), " ".join(b)) for a, b in p.found):
        if label and text.startswith(":"):
            turns.append((label.strip(" \t–—:-") or None, [text[1:].strip()]))
        else:
            turns[-1][1].append(f"{label} {text}".strip())
    whole = ((who, "\n".join(filter(None, lines))) for who, lines in turns)
    return [(who, text) for who, text in whole if len(text) > 1]


_SECTION_TURNS = T.ArrayType(T.StructType().add("section", T.IntegerType()).add("speaker", "string").add("text", "string"))


@F.pandas_udf(_SECTION_TURNS)
def section_turns(sections: pd.Series) -> pd.Series:
    return sections.map(lambda own: [{"section": i, "speaker": who, "text": text} for i, page in enumerate(own if own is not None else ()) for who, text in labelled_turns(page)])


def singapore(raw: DataFrame) -> DataFrame:
    """Reports of sittings (url, doc_date, content as JSON); one without metadata gives no rows."""
    fields = "metadata struct<parlimentNO string, sessionNO string, sittingNO string, sittingDate string, dateToDisplay string>, takesSectionVOList array<struct<content string, sectionType string, title string>>"
    r = raw.select("url", "doc_date", F.from_json("content", fields).alias("r")).select("url", "doc_date", "r.*").where(some(F.col("metadata.sittingDate")).isNotNull())
    r = r.select("*", section_turns(F.transform("takesSectionVOList", lambda s: s["content"])).alias("turns")).select("*", F.posexplode("turns").alias("at", "turn"))
    ids = [F.coalesce(F.col(f"metadata.{c}"), F.lit("")) for c in ("parlimentNO", "sessionNO", "sittingNO")]
    section = F.get("takesSectionVOList", F.col("turn.section"))
    place = F.concat(F.lit("Parliament of Singapore ("), F.coalesce(section["sectionType"], F.lit("")), F.lit(")"))
    shown = F.coalesce(some(F.col("metadata.dateToDisplay")), F.date_format("doc_date", "dd-MM-yyyy"))
    return _utterances(r, native_id=F.concat_ws("-", *ids), url=F.col("url"), doc_date=F.col("doc_date"), title=F.format_string("Parliament of Singapore, Sitting No. %s (%s)", ids[2], shown), doc_type=F.lit("debate"), seq=F.col("at"), speaker_raw=F.col("turn.speaker"), text=F.col("turn.text"), speech_context=F.concat_ws(": ", place, some(stripped(section["title"]))))


REGISTRY = Registry()
for _source in (
    Source("jp_kokkai", "JP", kokkai, languages=("ja",)),
    Source("uk_hansard", "UK", hansard),
    Source("us_fedreg", "US", presidential),
    Source("ca_commons", "CA", _sittings(commons_sitting)),
    Source("de_bundestag", "DE", _sittings(bundestag_sitting), languages=("de",)),
    Source("fr_assemblee", "FR", _sittings(assemblee_sitting), languages=("fr",)),
    Source("fr_senat", "FR", _sittings(senat_sitting, "iso-8859-1"), languages=("fr",)),
    Source("sg_parliament", "SG", singapore),
    *[Source(name, "CN", articles, languages=("zh", "en")) for name in ("cn_mfa", "cn_gov", "cn_cac", "cn_most", "cn_miit", "cn_people")],
):
    REGISTRY.add(_source)
