"""Small cases of single operators: tables of expected values, and plain Python beside Spark."""

import random
import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from veriloom.functions import excerpt, folding, text
from veriloom.functions.numbers import wilson
from veriloom.operators import export, keywords, mirrors, promotion, sampling, segments, speakers, statistics, verdicts
from veriloom.operators.components import connected
from veriloom.operators.keywords import TermList
from veriloom.sources import archive, ledger, pages
from veriloom.schemas import TABLES


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_tables_parse(spark):
    for ddl in TABLES.values():
        assert spark.createDataFrame([], ddl).columns


@pytest.mark.parametrize(
    "term,body,found",
    [
        ("AI", "the AI act, not said", ["AI"]),
        ("AI", "ai", []),
        ("A.I.", "on A.I. today", ["A.I."]),
        ("LLM*", "LLMs and LLM", ["LLMs", "LLM"]),
        ("superintelligen*", "Superintelligence is superintelligent", ["Superintelligence", "superintelligent"]),
        ("сильн* ИИ", "это сильный ИИ", ["сильный ИИ"]),
        ("l'IA", "de l’IA", ["l’IA"]),
        ("état", "L'État, éétat", ["État"]),
    ],
)
def test_terms(spark, term, body, found):
    lists = [TermList("x", (term,))]
    df = frame(spark, [(body, "x")], "t string, l string").select("t", keywords.matches(F.col("t"), F.col("l"), lists).alias("m"))
    r = df.first()
    assert [body[m["start"] : m["end"]] for m in r["m"]] == found


def test_language_fallback(spark):
    lists = [TermList("en", ("risk",)), TermList("fr", ("risque", "risk")), TermList("zh", ("风险",), False)]
    df = frame(spark, [("risk risque 风险😀风险", x) for x in ("en-GB", "fr", "zh", "mul", "pl")], "t string, l string")
    got = {r["l"]: [(m["keyword"], m["lang"], m["start"]) for m in r["m"]] for r in df.select("l", keywords.matches(F.col("t"), F.col("l"), lists).alias("m")).collect()}
    assert got["en-GB"] == [("risk", "en", 0)]
    assert got["fr"] == [("risk", "fr", 0), ("risque", "fr", 5)]
    assert got["zh"] == [("风险", "zh", 12), ("风险", "zh", 15)]
    assert got["mul"] == got["pl"] == [("risk", "en", 0), ("risque", "fr", 5), ("风险", "zh", 12), ("风险", "zh", 15)]


def test_golden_id(spark):
    r = one(spark, k=text.public_id(F.lit("https://example.test"), F.lit("We must make artificial intelligence safe.")))
    assert r["k"] == "e55cb3f863c5e9c7"


@pytest.mark.parametrize("display,ok", [("alpha beta", True), ("Alpha beta [...] delta", True), ("delta [...] alpha", False), ("alpha [...] alpha", False), ("", False), ("alpha  beta", True)])
def test_splice(spark, display, ok):
    assert one(spark, s=text.spliced(F.lit(display), F.lit("alpha\nbeta gamma delta")))["s"] == ok


@pytest.mark.parametrize("span,ok", [("b  c", True), ("", False), (" ", True), ("x", False), (None, False)])
def test_verbatim(spark, span, ok):
    assert one(spark, s=text.within(F.lit(span).cast("string"), F.lit("a b\nc")))["s"] == ok


def test_passage_bounds(spark):
    body = "x" * 9000
    r = one(spark, a=text.passage(F.lit(body), F.array(F.lit(8000)), F.array(F.lit(8010))), b=text.passage(F.lit(body), F.array().cast("array<int>"), F.array().cast("array<int>")), c=text.passage(F.lit("abc"), F.array(F.lit(0)), F.array(F.lit(1))))
    assert r["a"] == "…" + body[5500:] and r["b"] == body[:8000] + "…" and r["c"] == "abc"


def test_words_shown(spark):
    assert one(spark, n=text.words_shown(F.lit("It's 人工智能 ok_x [...] 3.5")))["n"] == len(re.findall(r"[^\W_]+", "It's   ok_x 3.5")) + 4


def test_folding():
    assert folding.statement_key_of(" ") is None
    assert folding.statement_key_of("Straße ＡＩ") == folding.statement_key_of("STRASSE ai")
    assert folding.name_fold_of("Nilüfer Gündoğan") == "nilufer gundogan"
    assert folding.bold_of("a <b> AI", ["ai", "<B>"]) == "a <b>&lt;b&gt;</b> <b>AI</b>"


def test_excerpt_moves_spans(spark):
    body = "word " * 4000 + "needle here " + "tail " * 4000
    e = excerpt.excerpt_of(F.col("t"), F.col("d"), 1000)
    df = frame(spark, [(body, "needle [...] here"), ("short", None), (body, "needle [...] absent"), ("a  Big\nCat.", "big cat"), (None, "x")], "t string, d string")
    a, b, c, d, n = df.select(e.alias("e"), "t").collect()
    shown = a["e"]["text"]
    assert a["e"]["truncated"] and [shown[s["start"] : s["end"]] for s in a["e"]["spans"]] == ["needle", "here"] and len(shown) <= 1010
    assert shown.startswith("… word ") and shown.endswith(" tail …")
    assert tuple(b["e"]) == ("short", None, False) and c["e"]["spans"] is None and c["e"]["text"] == body[:1000].strip() + " …"
    assert [tuple(s) for s in d["e"]["spans"]] == [(3, 10)] and tuple(n["e"]) == ("", None, False)
    r = one(spark, a=excerpt.find_span(F.lit("x \\E (a\n b) y"), F.lit("\\E (a b)")), b=excerpt.find_span(F.lit("x"), F.lit(" ")), c=excerpt.context(F.lit("0123456789"), F.struct(F.lit(4).alias("start"), F.lit(5).alias("end")), 2, 3), d=excerpt.context(F.lit("0123456789"), excerpt.locate(F.lit("a"), F.lit("b")), 2, 3))
    assert tuple(r["a"]) == (2, 11) and r["b"] is None and (r["c"], r["d"]) == ("…23456…", "012…")


def slots(df, *names):
    return {(tuple(r[n] for n in names) if len(names) > 1 else r[names[0]]): r["slots"] for r in df.collect()}


def test_apportioned(spark):
    def give(weights, total, caps=None):
        rows = [(k, w, (caps or weights)[k]) for k, w in weights.items()]
        return slots(sampling.apportioned(frame(spark, rows, "k string, w long, cap long"), total, "w", ["k"], "cap"), "k")

    assert give({"a": 700, "b": 200, "c": 100}, 100) == {"a": 70, "b": 20, "c": 10}
    assert give({"a": 3, "b": 100}, 20, {"a": 3, "b": 100})["b"] == 19
    assert give({"a": 50, "b": 50}, 20, {"a": 3, "b": 100}) == {"a": 3, "b": 17}
    assert give({"a": 1, "b": 1}, 20, {"a": 3, "b": 4}) == {"a": 3, "b": 4}
    assert give({}, 5) == {} and give({"a": 0}, 5) == {"a": 0} and give({"a": 5}, 0) == {"a": 0}


def test_allocation_totals(spark):
    rows = [(p, y, n * (k + 1)) for p, n in (("US", 60), ("CN", 25), ("JP", 4)) for k, y in enumerate(("2022", "2023", "2024"))]
    cells = frame(spark, rows, "p string, y string, n long").withColumn("weight", F.col("n"))
    got = slots(sampling.allocated(cells, 50, "p", "y"), "p", "y")
    assert sum(got.values()) == 50 and all(got[p, y] <= n for p, y, n in rows)
    places = slots(sampling.apportioned(cells.groupBy("p").agg(F.sum("n").alias("n")), 50, "n", ["p"]), "p")
    assert all(sum(n for (p, _), n in got.items() if p == q) == places[q] for q in places)
    years = {y: sum(n for (_, z), n in got.items() if z == y) for y in ("2022", "2023", "2024")}
    assert all(abs(years[y] - 50 * (k + 1) / 6) <= 1 for k, y in enumerate(sorted(years)))
    tight = slots(sampling.allocated(cells.withColumn("n", F.least("n", F.lit(3))), 25, "p", "y"), "p", "y")
    assert sum(tight.values()) == 25 and max(tight.values()) == 3
    assert sampling.allocated(cells.limit(0), 5, "p", "y").count() == 0


def test_label_plan(spark):
    vocabulary = [f"l{i}" for i in range(8)]
    rows = [(i, "US" if i % 3 else "CN", str(2022 + i % 2), sorted({vocabulary[i % 8], vocabulary[(i + 1 + i % 3) % 8]})) for i in range(60)]
    pop = frame(spark, rows, "candidate_id long, jurisdiction string, year string, own array<string>")
    plan = sampling.label_plan(pop, "own", vocabulary, 40, 3).collect()
    own = {r[0]: set(r[3]) for r in rows}
    assert sum(r["applied"] for r in plan) == 20 and len(plan) == 40 and len({(r["candidate_id"], r["label"]) for r in plan}) == 40
    assert all((r["label"] in own[r["candidate_id"]]) == r["applied"] and (r["sel_p"] is None) == r["applied"] for r in plan)
    assert all(0 < r["sel_p"] < 1 for r in plan if not r["applied"])
    each = [sum(r["candidate_id"] == c for r in plan) for c in own]
    assert max(each) <= 4


def test_family_rates(spark):
    rows = [("risk", True, True, "agree", None, "a", "US", 1, "n"), ("risk", True, False, "disagree", None, "b", "US", 2, "n"), ("risk", False, False, "agree", 0.5, "c", "US", 3, None), ("risk", False, True, "disagree", 0.1, "d", "CN", 4, "m"), ("risk", False, None, "unsure", 0.1, "e", "CN", 5, None)]
    r = statistics.family_rates(frame(spark, rows, "family string, applied boolean, human_applies boolean, agreement string, sel_p double, label string, jurisdiction string, candidate_id long, note string")).first()
    assert (r["n"], r["precision"], r["npv"], r["npv_reweighted"], r["kappa"]) == (4, 0.5, 0.5, round(2 / 12, 4), 0.0)
    assert [m["label"] for m in r["misses"]] == ["d"] and [m["label"] for m in r["false_applications"]] == ["b"]


def test_draw_is_stable(spark):
    df = spark.range(200).select("id", (F.col("id") % 3).cast("string").alias("p"), F.lit("2024").alias("y"), (F.col("id") % 2 == 0).alias("ok"))
    a = sampling.balanced(df, "id", "ok", "p", "y", 40, 1)
    b = sampling.balanced(df.repartition(7), "id", "ok", "p", "y", 40, 1)
    assert a.select("id", "position").orderBy("id").collect() == b.select("id", "position").orderBy("id").collect()
    assert a.where("ok").count() == 20


def test_statistics(spark):
    pairs = [(1, 1)] * 30 + [(1, 0)] * 20 + [(0, 1)] * 11 + [(0, 0)] * 39
    df = frame(spark, pairs, "a int, b int")
    assert statistics.kappa(df, F.col("a"), F.col("b")).first()["kappa"] == round(float(statistics.kappas(np.array([[[39, 11], [20, 30]]]))[0]), 4) == 0.38
    lo, hi = statistics.kappa_interval(pd.DataFrame(pairs))
    assert lo < 0.38 < hi and (lo, hi) == statistics.kappa_interval(pd.DataFrame(pairs)) and statistics.kappa_interval(pd.DataFrame(pairs[:1])) is None
    assert statistics.kappa(df.limit(0), F.col("a"), F.col("b")).first()["kappa"] is None
    ht = statistics.horvitz_thompson(frame(spark, [(0.5, True), (0.01, False)], "p double, a boolean"), F.col("p"), F.col("a")).first()
    assert ht["rate"] == round(2 / 102, 4) and ht["ess"] < 2
    lo, hi = wilson(F.lit(30), F.lit(50))
    r = one(spark, lo=F.round(lo, 4), hi=F.round(hi, 4))
    assert (r["lo"], r["hi"]) == (0.4618, 0.7239)
    r = one(spark, lo=wilson(F.lit(0), F.lit(0))[0], hi=wilson(F.lit(0), F.lit(0))[1])
    assert (r["lo"], r["hi"]) == (0.0, 1.0)


def test_mirrors(spark):
    long = " ".join(f"w{i}" for i in range(60))
    part = long[len("w0 ") : -len(" w59")]
    rows = frame(spark, [(1, "US", "A", long, "2024-01-02"), (2, "US", "A", part, "2024-01-01"), (3, "US", "B", part, "2024-01-01"), (4, "US", "B", part, "2023-01-01"), (5, "UK", "A", long, None), (6, "US", "C", None, None)], "id int, j string, s string, t string, date string")
    links = mirrors.containment_links(rows, "id", ["j", "s"], "t").unionByName(mirrors.key_links(rows, "id", [[F.col("j"), F.col("t")]]))
    kept, child = mirrors.collapsed(rows, "id", links, mirrors.survivor_rank(F.col("t"), F.lit("day"), F.col("date"), F.lit("x")), {"copy": F.col("id"), "date": F.col("date")})
    got = {r["id"]: ([m["copy"] for m in r["mirrors"]], r["n_mirrors"]) for r in mirrors.with_mirrors(kept, "id", child).collect()}
    assert got == {1: ([4, 2, 3], 3), 5: ([], 0), 6: ([], 0)}


def test_mirrors_once(spark):
    """As array_distinct: nulls in and for structs, empty and null arrays, the first of each in its place."""
    rnd = random.Random(2)
    some = lambda: None if rnd.random() < 0.1 else (rnd.choice("abc"), rnd.choice(["u", "v", None]), rnd.choice([None, "2024-01-01"]))
    rows = [([some() for _ in range(rnd.randrange(30))],) for _ in range(60)] + [(None,), ([],), ([None, None],)]
    df = frame(spark, rows, "m array<struct<source:string,url:string,date:string>>")
    assert all(r["got"] == r["want"] for r in df.select(mirrors.once(F.col("m")).alias("got"), F.array_distinct("m").alias("want")).collect())


def test_promoted_mirrors_of_hot_quotes(spark):
    """Many quotes of one key, with mirrors, without and with null: no comparison of each mirror with each."""
    n = 5_000
    mirror = lambda k: F.struct(F.format_string("s%06d", k).alias("source"), F.lit("u").alias("url"), F.lit(None).cast("date").alias("date"))
    own = F.when(F.col("id") == 0, F.transform(F.sequence(F.lit(1), F.lit(2)), lambda k: mirror(F.lit(n - 1)))).when(F.col("id") == 1, F.array().cast("array<struct<source:string,url:string,date:date>>"))
    quotes = spark.range(150).select(F.col("id").alias("candidate_id"), F.when(F.col("id") < 149, "k").otherwise("other").alias("span_key"), own.alias("mirrors"))
    twins = spark.range(2 * n).select(F.lit("k").alias("span_key"), mirror(F.col("id") % n)["source"].alias("source"), F.lit("u").alias("url"), F.lit(None).cast("date").alias("date"))
    start = time.monotonic()
    shown = promotion.with_promoted_mirrors(quotes, twins).select("candidate_id", F.size("mirrors").alias("n"), F.slice("mirrors", 1, 2)["source"].alias("first"))
    got = {r["candidate_id"]: (r["n"], r["first"]) for r in shown.collect()}
    assert time.monotonic() - start < 30
    assert got == {i: (n, ["s000000", "s000001"]) for i in range(1, 149)} | {0: (n, [f"s{n - 1:06d}", "s000000"]), 149: (0, [])}


def test_containment(spark):
    """Against every pair: copies, texts without blanks, short texts, nulls in group or text."""
    rnd = random.Random(1)
    base = ["".join(rnd.choice("ab cd\u4eba\u5de5 ") for _ in range(400)) for _ in range(6)]
    texts = [b[rnd.randint(0, 100) :][: rnd.choice([100, 120, 150, 400])] for b in base for _ in range(12)] + [None, "", "x" * 130, "x" * 131]
    rows = [(i, "g" if i % 7 else None, t) for i, t in enumerate(texts)]
    df = frame(spark, rows, "id int, g string, t string")
    want = {(a, b) for a, g, long in rows for b, h, short in rows if a != b and g and g == h and long and short and len(short) >= 120 and short in long and (len(long) > len(short) or a < b)}
    assert {tuple(r) for r in mirrors.containment_pairs(df, "id", ["g"], "t").select("a", "b").collect()} == want and len(want) > 30
    roots = {r["node"]: r["root"] for r in connected(mirrors.containment_links(df, "id", ["g"], "t")).collect()}
    assert all(roots[a] == roots[b] for a, b in want) and set(roots) == {x for p in want for x in p}


def test_refinement_coercion(spark):
    raw = '{"coarse_topics":["regulation","agi","agi"],"risk_subdomains":["toxic_content"],"policy_instruments":[],"primary_topic":"x_risk","rationale":"r","display_quote":"q"}'
    bad = raw.replace("toxic_content", "nonsense")
    r = frame(spark, [(raw,), (bad,), (None,)], "r string").select(verdicts.parsed_refinement(F.col("r")).alias("v")).collect()
    assert r[0]["v"]["coarse_topics"] == ["agi", "regulation"] and r[0]["v"]["primary_topic"] == "toxic_content"
    assert r[1]["v"] is None and r[2]["v"] is None


def test_verdict_validation(spark):
    rel = '"ai":1,"agi":7,"asi":0,"rsi":0,"x_risk":40,"regulation":%s'
    raw = '{"relevance":{' + rel + '},"rationale":"r","quote_span":"q","is_substantive":true,"speaker_owns_statement":true,"quote_type":"direct","speaker_in_scope":true,"stance":"mixed","context_note":"c"}'
    df = frame(spark, [(raw % 59,), (raw % 101,), (raw.replace('"mixed"', '"odd"') % 1,), ("x",)], "r string").select(verdicts.parsed_verdict(F.col("r")).alias("v"))
    got = df.select(F.when(F.col("v").isNotNull(), verdicts.topics(lambda k: F.col(f"v.relevance.{k}"))).alias("t")).collect()
    assert [r["t"] for r in got] == [["agi", "x_risk"], None, None, None]
    fenced = one(spark, j=verdicts.json_in(F.lit('so:\n```json\n{"a": {"b": 1}}\n``` ok')))
    assert fenced["j"] == '{"a": {"b": 1}}'


def test_ledger(spark):
    spans = spark.sql("select 'a' source, date'2024-01-10' start, date'2024-03-05' end")
    m = [(str(r[1]), str(r[2])) for r in ledger.calendar_tiles(spans, "month").orderBy("window_start").collect()]
    assert m == [("2024-01-10", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-05")]
    y = [(str(r[1]), str(r[2])) for r in ledger.calendar_tiles(spans, "year").collect()]
    assert y == [("2024-01-10", "2024-03-05")]
    t = ledger.tiles(spans, 30)
    assert ledger.lagged(t, F.lit("2024-03-01").cast("date"), 0).count() == 1


def test_upsert_keeps_old_fields(spark):
    schema = "document_id long, seq int, text string, speaker_raw string, speech_context string, language string"
    old, new = frame(spark, [(1, 0, "a", "s", "c", "en")], schema), frame(spark, [(1, 0, "b\x07", "t", "d", "fr"), (1, 1, "n", "u", "e", "de")], schema)
    got = {r["seq"]: (r["text"], r["speaker_raw"], r["language"]) for r in ledger.upserted_utterances(old, new).collect()}
    assert got == {0: ("b", "t", "en"), 1: ("n", "u", "de")}


def test_segments(spark):
    df = frame(spark, [(1, "lead [A]: one [B]: two"), (2, "none")], "k int, t string")
    got = [tuple(r) for r in segments.turns(df, "t", r"\[(\w)\]:", "k").orderBy("k", "seq").collect()]
    assert got == [(1, 0, None, "lead"), (1, 1, "A", "one"), (1, 2, "B", "two"), (2, 0, None, "none")]
    c = one(spark, c=segments.chunks(F.array(F.lit("aaaa"), F.lit("bb"), F.lit("cccc")), 6))["c"]
    assert c == ["aaaa\nbb", "cccc"]
    frags = frame(spark, [(1, 1, "abc def", None), (1, 2, "abc", "X"), (1, 3, "abc", None)], "d int, f int, t string, s string")
    assert [r["f"] for r in segments.leaves(frags, "d", "f", "t", "s").collect()] == [2]


def test_speakers(spark):
    r = one(spark, a=speakers.jurisdiction(F.lit("uk_hansard")), b=speakers.jurisdiction(F.lit("intl_un")), c=speakers.jurisdiction(F.lit("cn_mfa")), d=speakers.jurisdiction(F.lit("other")))
    assert tuple(r) == ("UK", "UN", "CN", "XX")
    df = frame(spark, [("Martin Rees, Lord Rees of Ludlow", "Martin Rees"), ("Michael McGrath", "Michael Detlefsen")], "a string, b string")
    assert [x["s"] for x in df.select(speakers.same_person(F.col("a"), F.col("b")).alias("s")).collect()] == [True, False]
    v = {"EPP": "EPP", "PPE": "EPP", "Verts/ALE": "Greens/EFA"}
    r = one(spark, a=speakers.groups_rewritten(F.lit("PPE, Verts/ALE, PPEX"), v), b=speakers.groups_named(F.lit("EPP and PPE and Verts/ALE"), v), c=speakers.group_label(F.lit("ppe"), v))
    assert tuple(r) == ("EPP, Greens/EFA, PPEX", ["EPP", "Greens/EFA"], "EPP")


def test_archive(spark):
    blobs = frame(spark, [("a", bytearray(b"x")), ("a", bytearray(b"x")), ("b", bytearray(b"x"))], "source string, content binary")
    first = archive.stored(None, blobs)
    assert first.count() == 2 and archive.stored(first, blobs).count() == 2
    got = frame(spark, [(bytearray("é".encode("latin-1")), "latin-1"), (bytearray("é".encode()), "nope"), (bytearray(b"\xff"), None)], "c binary, d string").select(archive.decoded("c", "d").alias("t")).collect()
    assert [r["t"] for r in got] == ["é", "é", "�"]


def test_pages(spark):
    r = one(spark, d=pages.url_date(F.lit("https://x/2024/05/17/a.html"))[0].cast("string"), p=pages.url_date(F.lit("https://x/2024-05/a"))[1], c=pages.congress(F.lit("2025-01-02").cast("date")), l=pages.last_field(F.lit("Question - X - Jane Roe")), s=pages.title_speaker(F.lit("Speech on AI by Jane Roe")))
    assert (r["d"], r["p"], r["c"], r["l"], r["s"]) == ("2024-05-17", "month", 118, "Jane Roe", "Jane Roe")
    assert pages.lists_under({"a": {"k": [1]}, "k": [2]}, "k") == [[2], [1]]
    assert pages.definitions("- `a`, `b`: Title. Some\n  text\n- `c`: T2. x")["b"] == {"title": "Title", "text": "Some text"}
    assert pages.article_of("<h1>T</h1><div><p>too short</p></div><article><p>" + "long enough text " * 4 + "</p></article>")[0] == "T"


def test_export(spark):
    r = one(
        spark,
        a=export.extended(F.lit("It is"), F.lit("It is"), F.lit("It is here. More")),
        b=export.extended(F.lit("It is"), F.lit("Es ist"), F.lit("It is here.")),
        c=export.extended(F.lit("Done."), F.lit("Done."), F.lit("Done. x")),
        d=export.not_verbatim(F.lit("direct"), F.lit("Mr Alex Yeo asked the Minister")),
        e=export.english_original(F.lit("Hello"), F.lit("zh")),
    )
    assert tuple(r) == ("It is here.", "It is [...]", "Done.", True, True)


def test_article_containers():
    long, other = "a paragraph of the known container " * 8, "another one beside it that is longer " * 9
    both = f'<div class="side x"><p>{other}</p></div><div id="zoom"><div><p>{long}<p>short<p>{long}</div></div>'
    assert pages.article_of(both) == (None, f"{long.strip()}\n{long.strip()}")  # nested, unclosed paragraphs
    assert pages.article_of(both, ("div.side",))[1] == other.strip()
    assert pages.article_of(both, ())[1] == f"{long.strip()}\n{long.strip()}"  # the div with most text
    few = f'<div class="content"><p>{"x" * 200}</p></div><div><p>{other}</p></div>'
    assert pages.article_of(few)[1] == other.strip()  # 200 characters are too few
    # No paragraph, only short ones, no div, nothing.
    assert pages.article_of("<title> a </title><div>some <b>plain</b> text</div>") == ("a", "some plain text")
    assert pages.article_of("<div><p>one</p><p>two</p></div>")[1] == "one two"
    assert pages.article_of(f"<article><p>{long}</p></article>")[1] == long.strip()
    assert pages.article_of("<title>T</title><h1> </h1>") == ("T", "T")
    assert pages.article_of("<div></div>") == pages.article_of("") == pages.article_of(None) == (None, None)
    # Headers, menus and scripts are not seen; a stray end tag does no harm.
    page = f"<header><h1>Site</h1></header><h1>A<b>B</b></h1></div><div><nav>{other}</nav><p>{long}<script>{other}</script></p></section></div>"
    assert pages.article_of(page) == ("AB", long.strip())


def test_article_of_pages(spark):
    """Every page against its divs, read by another way: the paragraphs are in the text with most."""
    rows = spark.read.parquet(f"{DATA}/pages.parquet").withColumn("a", pages.article("html")).collect()
    for r in rows:
        seen = re.sub(r"(?is)<(script|style|nav|footer|header)\b.*?</\1\s*>|<!--.*?-->", " ", r["html"] or "")
        words = set(pages.html.unescape(re.sub(r"<[^>]*>", " ", seen)).split())
        assert set((r["a"]["body"] or "").split()) <= words
        assert (r["a"]["body"] is None) == (not words)
