"""The commands end to end on a small corpus, and the operators that only they use."""

import glob
import io
import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from veriloom.functions import text
from veriloom.operators import export, promotion
from veriloom.operators.keywords import TermList
from veriloom.plans import commands
from veriloom.schemas import TABLES
from veriloom.sources import records, registry


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    s = commands.Store(spark, str(tmp_path_factory.mktemp("store")))
    texts = ["We must regulate AI now. It matters.", "We must regulate AI  now. It matters.", "Fish and chips.", "AGI may end us all. So I say.", "The AI act is dull."]
    docs = [(i, src, str(i), f"http://x/{i}", f"2024-0{i + 1}-01") for i, src in enumerate(["uk_hansard", "uk_hansard", "us_fedreg", "us_whitehouse", "fr_senat"])]
    d = spark.createDataFrame(docs, "id long, source string, native_id string, url string, d string").withColumn("doc_date", F.to_date("d")).drop("d")
    for c in [x.split()[0] for x in TABLES["documents"].split(", ")]:
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast(dict(x.split() for x in TABLES["documents"].split(", "))[c]))
    s.write("documents", d)
    u = [(i, i, 0, "Ms. Roe", None, "en", t, None, True, None) for i, t in enumerate(texts)]
    s.write("utterances", spark.createDataFrame(u, TABLES["utterances"]))
    return s


def test_end_to_end(spark, store):
    lists = [TermList("en", ("AI", "AGI"))]
    assert commands.scan(store, lists).count() == 4
    assert commands.scan(store, lists).count() == 4  # nothing twice
    judge = commands.rule_answers({"regulation": r"regulate", "agi": r"\bAGI\b"})
    assert commands.adjudicate(store, judge, "prompt", "rules").count() == 4
    assert commands.adjudicate(store, judge, "prompt", "rules").count() == 4
    q = commands.promote(store, "prompt")
    assert {" ".join(r["quote_original"].split()) for r in q.collect()} == {"We must regulate AI now.", "AGI may end us all."}
    assert sorted(len(r["mirrors"]) for r in q.collect()) == [0, 1]
    assert {r["decision"]: r["n"] for r in store.read("decisions").groupBy("decision").agg(F.count("*").alias("n")).collect()} == {"promoted": 2, "duplicate": 1, "rejected": 1}
    aliases = spark.createDataFrame([("UK", "Ms. Roe", "s1", 0, "Jane Roe")], "jurisdiction string, label string, speaker_id string, load_order int, canonical_name string")
    none = spark.createDataFrame([], "source string, native_id string, speaker_id string")
    names = spark.createDataFrame([("UK", "Jane Roe", "s1")], "jurisdiction string, canonical_name string, speaker_id string")
    linked = {r["jurisdiction"]: r["speaker_id"] for r in commands.link(store, aliases, none, names).collect()}
    assert linked == {"UK": "s1", "US": None}
    # A second promotion keeps links, states and mirrors.
    before = sorted(map(tuple, store.read("quotes").select("candidate_id", "speaker_id", "review_status", F.size("mirrors")).collect()))
    again = commands.promote(store, "prompt", aliases=aliases)
    assert sorted(map(tuple, again.select("candidate_id", "speaker_id", "review_status", F.size("mirrors")).collect())) == before
    assert registry.unlinked(store.read("quotes")).first()["value"] == "US\tMs. Roe"
    got = {r["stage"]: r["n"] for r in commands.stats(store).collect()}
    assert got == {"documents": 5, "utterances": 5, "candidates": 4, "adjudicated": 4, "quotes": 2}
    assert {r["keyword"]: (r["n_candidates"], r["n_unique"], r["n_unique_accepted"]) for r in commands.ablate(store).collect()} == {"AI": (3, 3, 1), "AGI": (1, 1, 1)}


def test_samples_stay(store):
    a = commands.validate_sample(store, "prompt", 4, 7)
    b = commands.validate_sample(store, "prompt", 2, 8)
    assert a.count() == 4 and b.count() == 2
    assert {r["seed"]: r["n"] for r in store.read("validation_samples").groupBy("seed").agg(F.count("*").alias("n")).collect()} == {7: 4, 8: 2}
    assert commands.validate_sample(store, "prompt", 3, 7).count() == 4  # drawn once
    assert commands.validate_report(store, "primary", 7).count() == 3
    commands.validate_reset(store, "primary", 8)
    assert [r["seed"] for r in store.read("validation_samples").select("seed").distinct().collect()] == [7]


def test_refine_and_labels(spark, store):
    good = {"coarse_topics": ["regulation"], "risk_subdomains": [], "policy_instruments": ["licensing_and_registration", "risk_tiering"], "primary_topic": "risk_tiering", "rationale": "r", "display_quote": "We must regulate AI now."}
    asked = []

    def judge(batch):
        out = []
        for m in batch["message"]:
            first = "failed validation" not in m
            asked.append(first)
            text = "AGI may end us all." if "AGI" in m else "We must regulate AI now." if "AI  now" not in m else "We must regulate AI  now."
            out.append(json.dumps(good | {"display_quote": "made up words" if first and "AGI" in m else text}))
        return pd.Series(out)

    log = commands.refine(store, judge, "refine it", "rules")
    assert log.where("verdict is not null").count() == 2 and log.where("error is not null").count() == 0
    assert commands.refine(store, judge, "refine it", "rules").count() == 2  # nothing twice
    sample = commands.validate_labels_sample(store, 8, 3)
    assert sample.count() > 0 and set(r["family"] for r in sample.collect()) == {"policy"}
    other = commands.validate_labels_sample(store, 2, 4)
    assert store.read("label_validation_samples").count() == sample.count() + other.count()
    answers = sample.select("candidate_id", "family", "label", F.lit("agree").alias("agreement"), F.lit("fine").alias("note"))
    commands.validate_labels(store, answers, 3)
    r = commands.validate_labels_report(store, 3).first()
    assert r["precision"] == 1.0 and r["misses"] == [] and r["n"] == sample.count()
    with pytest.raises(ValueError):
        commands.validate_labels_reset(store, 3)
    commands.validate_labels_reset(store, 3, force=True)
    assert [x["seed"] for x in store.read("label_validation_samples").select("seed").distinct().collect()] == [4]


def whole(path):
    return json.loads("\n".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*"))))


def test_publish(spark, store, tmp_path):
    out = commands.publish(store, str(tmp_path / "out"), "2.7.0", "2024-06-01")
    assert out.count() == 2 and sorted(len(r["mirrors"]) for r in out.collect()) == [0, 1]  # promotion's mirror stays
    site = whole(tmp_path / "out/site/quotes-data.json")
    assert site["v"] == "2.7.0" and [r["j"] for r in site["rows"]] == ["US", "UK"] and "o" not in site["rows"][0]
    assert len(whole(tmp_path / "out/quotes.json")) == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "out/quotes_compat.csv")).columns == export.COMPAT_FIELDS
    assert spark.read.parquet(str(tmp_path / "out/quotes.parquet")).columns == export.FLAT_FIELDS
    for i in range(8):
        side = whole(tmp_path / f"out/site/utterances-{i}")
        assert (side["n"], side["i"]) == (8, i) and side["u"] == {}  # no record is long enough
    assert commands.publish(store, str(tmp_path / "out2"), "2.7.0", "2024-06-01", ("us_whitehouse",)).count() == 1
    assert whole(tmp_path / "out2/site/quotes-data.json")["rows"][0]["j"] == "UK"


def test_sidecar_records(spark, tmp_path):
    long = "Before. " * 60 + "The words that count are here, in  full. " + "After. " * 60
    rows = spark.createDataFrame([("u1", "The words that count", None, long, "en", "debate"), ("u2", "short", None, "short text", "en", None), ("u3", "words [x]", "The words [...] in full", long, None, None)], "source_url string, quote_original string, display_quote string, text string, language string, speech_context string")
    rows = rows.withColumn("id", text.public_id(F.col("source_url"), F.col("quote_original")))
    records = export.sidecar_records(rows.select("id", "display_quote", "quote_original"), rows.drop("id", "display_quote"))
    got = {r["id"]: json.loads(r["record"]) for r in records.collect()}
    assert len(got) == 2
    one, two = sorted(got.values(), key=lambda r: "ss" in r)
    assert one["t"][slice(*one["s"])] == "The words that count" and one["l"] == "en" and one["sc"] == "debate" and "x" not in one
    assert [two["t"][slice(*s)] for s in two["ss"]] == ["The words", "in full"]
    export.write_sidecar(records, str(tmp_path), "1", "2024-01-01")
    back = {}
    for i in range(8):
        back |= whole(tmp_path / f"utterances-{i}")["u"]
    assert back == got


def test_skeptic_dates_citations(spark, store):
    judge = lambda batch: pd.Series([json.dumps({"refuted": "AGI" in m, "confidence": 0.9, "reason": "r"}) for m in batch["message"]])
    got = {r["jurisdiction"]: (r["k"], r["n"]) for r in commands.skeptic(store, judge, "doubt", "rules", 10).collect()}
    assert got == {"UK": (1, 1), "US": (0, 1)}
    assert {r["jurisdiction"]: r["review_status"] for r in store.read("quotes").collect()} == {"UK": "accepted", "US": "disputed"}
    assert {r["review_status"] for r in commands.promote(store, "prompt", aliases=spark.createDataFrame([("UK", "Ms. Roe", 0, "Jane Roe")], "jurisdiction string, label string, load_order int, canonical_name string")).collect()} == {"accepted", "disputed"}
    d = store.read("documents")
    store.write("documents", d.withColumn("date_precision", F.when(F.col("id") == 3, "month").otherwise("day")).withColumn("title", F.lit("T")).withColumn("is_provisional", F.col("id") == 3))
    bodies = spark.createDataFrame([(3, "<meta day='2024-04-17'>"), (0, "<meta day='2020-01-01'>")], "document_id long, body string")
    commands.resolve_dates(store, "us_whitehouse", bodies, "day='([0-9-]+)'", "dated ([0-9-]+)")
    assert {str(r["date"]) for r in store.read("quotes").collect()} == {"2024-01-01", "2024-04-17"}
    urls = lambda df: F.array(F.concat(F.lit("http://c/"), F.col("rank").cast("string")), F.concat(F.lit("http://d/"), F.col("native_id")))
    cited = commands.resolve_citations(store, "uk_hansard", urls, spark.createDataFrame([("http://d/1",), ("http://c/1",)], "url string"))
    assert {r["id"]: r["citation_url"] for r in cited.where("citation_url is not null").collect()} == {0: "http://c/1", 1: "http://c/1"}
    final = store.read("documents").where("id = 3").withColumn("id", F.lit(9).cast("long")).withColumn("is_provisional", F.lit(False))
    store.write("documents", store.read("documents").unionByName(final))
    commands.supersede_provisional(store, "us_whitehouse")
    assert {r["jurisdiction"]: r["review_status"] for r in store.read("quotes").collect()} == {"UK": "accepted", "US": "excluded"}
    assert commands.Store(spark, store.root).read("quotes").count() == 2


def test_ledger_commands(spark, store):
    spans = spark.sql("select 'uk_hansard' source, date'2024-01-01' start, date'2024-01-31' end")
    todo = commands.fetch(store, spans, 10, "2024-03-01")
    assert todo.count() == 4
    commands.mark(store, todo.where("window_start < '2024-01-15'"))
    assert commands.fetch(store, spans, 10, "2024-03-01").count() == 2


def test_registry(spark):
    r = registry.Registry()
    r.add(registry.Source("a_x", "A", lambda df: df.select(F.upper("t").alias("text"))))
    r.add(registry.Source("b_x", "B", lambda df: df.select(F.col("t").alias("text"), F.lit(1).alias("seq")), enabled=False))
    assert [s.name for s in r.chosen()] == ["a_x"]
    with pytest.raises(KeyError):
        r.chosen(["zzz"])
    raw = spark.createDataFrame([("q",)], "t string")
    assert {(x["text"], x["source"]) for x in r.parsed({"a_x": raw, "b_x": raw}).collect()} == {("Q", "a_x"), ("q", "b_x")}


def test_records(spark):
    xml = "<r><ctx>Item 1</ctx><w><n>A</n><t>says <i>this</i></t><w><n>B</n><t>breaks in</t></w></w><w><n>C</n></w></r>"
    assert [(s["speaker"], s["context"], s["text"]) for s in records.speeches_of(xml, "w", "n", "t", "ctx")] == [("A", "Item 1", "says this"), ("B", "Item 1", "breaks in")]
    assert records.speeches_of("<bad", "w", "n", "t", "c") == [] and records.speeches_of(None, "w", "n", "t", "c") == []
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        z.writestr("word/document.xml", '<d xmlns:w="u"><w:p><w:t>a</w:t><w:tab/><w:t>b</w:t></w:p><w:p><w:t>c</w:t></w:p></d>')
    assert records.docx_text_of(f.getvalue()) == "a b\nc" and records.docx_text_of(b"no") is None
    assert records.release_of("<nav>x</nav><p>" + "word " * 60 + "</p><div class='a'></div><div class=\"share\">y</div>", ("share",)) == ("word " * 60).strip()
    df = spark.createDataFrame([("der die und le",), ("le la les",), ("xyz",)], "t string")
    assert [r["l"] for r in df.select(records.language_by_words(F.col("t"), {"de": "der|die|und", "fr": "le|la|les"}).alias("l")).collect()] == ["de", "fr", None]
    r = spark.sql("select date'2024-03-01' start, date'2024-03-12' end")
    assert records.weekdays(r).count() == 8 and [str(x["monday"]) for x in records.week_starts(r).collect()] == ["2024-02-26", "2024-03-04", "2024-03-11"]


def test_promotion_parts(spark):
    df = spark.createDataFrame([(["a", "b", "c"], "c"), (["c", "b", "c"], "c"), (["c"], "c")], "l array<string>, p string")
    assert [r["x"] for r in df.select(promotion.applied_labels(F.col("l"), F.col("p"), ["a", "b", "c"]).alias("x")).collect()] == [["a", "b"], ["c", "b", "c"], ["c"]]
    marks = F.array(F.struct(F.lit(2).alias("start"), F.lit(4).alias("end"), F.lit("keyword").alias("kind")))
    got = spark.range(1).select(promotion.passage_parts(F.lit("abcdef"), marks).alias("x")).first()["x"]
    assert [(p["kind"], p["text"]) for p in got] == [("plain", "ab"), ("keyword", "cd"), ("plain", "ef")]
    v = F.struct(F.lit("one [...] two").alias("display_quote"), F.lit(None).cast("string").alias("display_quote_en"))
    r = spark.range(1).select(promotion.refinement_problem(v, F.lit("one x two"), F.lit("en")).alias("a"), promotion.refinement_problem(v, F.lit("one x two"), F.lit("de")).alias("b"), promotion.refinement_problem(v, F.lit("two one"), F.lit("en")).alias("c")).first()
    assert r["a"] is None and "missing" in r["b"] and "spliced" in r["c"]
