"""Sources on small responses of their own formats."""

import json

import pytest
from pyspark.sql import functions as F

from veriloom.sources import records
from veriloom.sources.connectors import COLUMNS, REGISTRY, debate_url


def parsed(spark, name, rows, schema):
    out = REGISTRY.parsed({name: spark.createDataFrame(rows, schema)})
    assert out.columns == [*COLUMNS, "source"]
    return [r.asDict() for r in out.orderBy("native_id", "seq").collect()]


def test_kokkai(spark):
    speech = {"speechID": "121_004", "issueID": "121", "nameOfHouse": "参議院", "nameOfMeeting": "本会議", "issue": "第1号", "date": "2024-02-01", "speechOrder": 4, "speaker": "甲", "speakerGroup": "", "speakerPosition": "大臣", "speech": "　話す。 "}
    pages = [{"speechRecord": [speech, {**speech, "speechID": "121_005", "speechOrder": None, "speaker": None, "speakerPosition": None}]}, {"speechRecord": [speech, {**speech, "speechID": "9", "speech": " "}]}, {"speechRecord": None}]
    a, b = parsed(spark, "jp_kokkai", [(json.dumps(p),) for p in pages] + [("no json",), (None,)], "content string")
    assert (a["native_id"], a["seq"], a["speaker_raw"], a["text"], a["title"]) == ("121", 4, "甲 (大臣)", "話す。", "参議院 本会議 第1号")
    assert (b["seq"], b["speaker_raw"], str(b["doc_date"])) == (5, "", "2024-02-01")


def test_hansard(spark):
    said = {"ContributionExtId": "C1", "ContributionTextFull": " <p>One\r\ntwo</p>", "SittingDate": "2024-05-17T00:00:00", "DebateSectionExtId": "D", "DebateSection": "AI: act", "House": "Lords", "ItemId": 0, "OrderInDebateSection": 7, "AttributedTo": "", "MemberName": "Baroness X", "MemberId": 12}
    other = {"ContributionExtId": "C2", "ContributionTextFull": "text", "DebateSectionId": 5, "House": "Commons"}
    a, b = parsed(spark, "uk_hansard", [(json.dumps({"Results": [said, other]}), "Spoken"), (json.dumps({"Results": [other]}), "Spoken")], "content string, kind string")
    assert (a["native_id"], a["seq"], a["speaker_raw"], a["speaker_native_id"], a["text"]) == ("D", 7, "Baroness X", "12", "One\ntwo")
    assert a["url"] == "https://hansard.parliament.uk/Lords/2024-05-17/debates/D/AIact" and a["speech_context"] == "Lords, AI: act"
    assert (b["native_id"], b["seq"], b["speaker_raw"], b["speech_context"], b["is_verbatim"]) == ("unknown-5", 0, None, "Commons", True)
    one = spark.range(1).select(debate_url(*map(F.lit, ("Commons", "d", "D", "!", "C"))), records.url_slug(F.lit(None).cast("string"))).first()
    assert tuple(one) == ("https://hansard.parliament.uk/Commons/d/debates/D/debate#contribution-C", "debate")


def test_presidential(spark):
    record = {"document_number": "2024-1", "title": "On AI", "subtype": "Executive Order", "publication_date": "2024-01-03", "president": {"name": "P. Q."}}
    rows = [(json.dumps(record), "<pre>" + "word " * 60 + "\n\n\n\nend</pre>"), (json.dumps(record), "short"), (json.dumps({"document_number": "2024-2"}), "x" * 200)]
    a, b = parsed(spark, "us_fedreg", rows, "content string, body string")
    assert (a["speaker_raw"], a["doc_type"], a["speech_context"], str(a["doc_date"])) == ("P. Q. (President)", "executive_order", "Executive Order: On AI", "2024-01-03")
    assert a["text"].endswith("word \n\nend") and (b["speaker_raw"], b["speech_context"]) == (None, "Presidential Document: 2024-2")


COMMONS = """<H><ExtractedItem Name="MetaDateNumYear">2024</ExtractedItem><ExtractedItem Name="MetaDateNumMonth">5</ExtractedItem><ExtractedItem Name="MetaDateNumDay">7</ExtractedItem>
<Intervention Type="Debate"><PersonSpeaking><Affiliation DbId="9">Hon.  A <i>B</i>:</Affiliation></PersonSpeaking><Content><ParaText>one <b>two</b></ParaText><ParaText> </ParaText><ParaText>three</ParaText></Content></Intervention>
<Intervention><Content><ParaText>nobody</ParaText></Content></Intervention></H>"""
BUNDESTAG = """<p sitzung-datum="07.05.2024" wahlperiode="20" sitzung-nr="8"><rede id="1"><p klasse="redner"><redner id="5"><name><vorname>A</vorname><nachname>B</nachname><fraktion>F</fraktion></name></redner></p>
<p klasse="J">eins</p><name>Chair</name><p klasse="J">not own</p><p klasse="redner"><redner id="6"/></p><p klasse="O">other</p><p klasse="redner"><redner id="5"/></p><p klasse="Z">zwei</p><p klasse="T">skipped</p></rede><rede/></p>"""
ASSEMBLEE = """<c xmlns="http://x"><metadonnees><dateSeance>20240507150000</dateSeance><dateSeanceJour>mardi 7 mai</dateSeanceJour></metadonnees>
<paragraphe id_acteur="PA1"><orateurs><orateur><nom>M. A</nom></orateur></orateurs><texte>un <i>deux</i></texte></paragraphe><paragraphe id_acteur="PA1"><orateurs><orateur><nom>M. A</nom></orateur></orateurs><texte>trois</texte></paragraphe>
<paragraphe><texte>nobody</texte></paragraphe><paragraphe><orateurs><orateur><nom>Mme B</nom></orateur></orateurs><texte>quatre</texte></paragraphe></c>"""


SENAT = """<?xml version="1.0" encoding="UTF-8"?><c:r xmlns:c="http://c" xmlns="http://h"><c:intervenant nom="A" civ="M." qua="ministre" mat="7"><p><span class="orateur_nom">M. A.</span>Un é<b>té</b> <span class="info_entre_parentheses">(Rires.)</span> ici</p><p> </p><p>deux</p></c:intervenant>
<c:intervenant nom=""><p>personne</p></c:intervenant></c:r>"""


@pytest.mark.parametrize(
    ("name", "native_id", "xml", "context", "turns"),
    [
        ("ca_commons", "441-007", COMMONS, "House of Commons, sitting 44-1/7", [("Hon. A B", "9", "one two\nthree")]),
        ("de_bundestag", "20008", BUNDESTAG, "Bundestag, Plenarprotokoll 20/8", [("A B (F)", "5", "eins\nzwei")]),
        ("fr_assemblee", "CR1", ASSEMBLEE, "Assemblée nationale, séance du 2024-05-07", [("M. A", "PA1", "un deux\ntrois"), ("Mme B", None, "quatre")]),
        ("fr_senat", "d20240507", SENAT, "Sénat, séance du 2024-05-07", [("M. A (ministre)", "7", "Un été ici\ndeux")]),
    ],
)
def test_sittings(spark, name, native_id, xml, context, turns):
    rows = [(native_id, "u", xml.encode("iso-8859-1" if name == "fr_senat" else "utf-8")), ("broken", "u", b"<a"), ("undated", "u", b"<a/>"), (None, None, None)]
    got = parsed(spark, name, rows, "native_id string, url string, content binary")
    assert [(r["speaker_raw"], r["speaker_native_id"], r["text"]) for r in got] == turns
    assert {(str(r["doc_date"]), r["speech_context"], r["doc_type"]) for r in got} == {("2024-05-07", context, "debate")}
    assert [r["seq"] for r in got] == list(range(len(turns)))


def test_articles(spark):
    page = "<title>T</title><div class='content'><p>" + "a long paragraph " * 20 + "</p></div>"
    (a,) = parsed(spark, "cn_mfa", [("https://x/t20240507_11.shtml", page), ("https://x/b.html", "<p>short</p>"), (None, None)], "url string, content string")
    assert (a["native_id"], a["title"], a["doc_type"], a["speaker_raw"], a["is_verbatim"]) == ("t20240507_11", "T", "readout", None, False)


def test_singapore(spark):
    said = "<p>Opening.</p><p><strong>Mr <i>A</i> (West)</strong>: One.</p><p>Two <strong>B</strong>: three.</p><p><strong>Order</strong> please</p><p> <strong>C:</strong>: </p><p>x"
    sections = [{"content": said, "sectionType": "OA", "title": " Bill "}, {"content": None}, {"content": "<p><strong>D</strong>: four</p>", "sectionType": None, "title": ""}]
    report = {"metadata": {"parlimentNO": 14, "sessionNO": 2, "sittingNO": 120, "sittingDate": "07-05-2024"}, "takesSectionVOList": sections}
    raw = spark.createDataFrame([("u", json.dumps(report)), ("v", "{}"), ("w", None)], "url string, content string").withColumn("doc_date", F.lit("2024-05-07").cast("date"))
    got = REGISTRY.parsed({"sg_parliament": raw}).orderBy("seq").collect()
    assert [(r["seq"], r["speaker_raw"], r["text"]) for r in got] == [(0, None, "Opening."), (1, "Mr A (West)", "One.\nTwo B : three.\nOrder please"), (2, "D", "four")]
    assert {(r["native_id"], r["title"]) for r in got} == {("14-2-120", "Parliament of Singapore, Sitting No. 120 (07-05-2024)")}
    assert [r["speech_context"] for r in got] == ["Parliament of Singapore (OA): Bill"] * 2 + ["Parliament of Singapore ()"]


def test_registry_names():
    assert len(REGISTRY.chosen()) == 14 and {s.jurisdiction for s in REGISTRY.values()} == {"JP", "UK", "US", "CA", "DE", "FR", "SG", "CN"}
