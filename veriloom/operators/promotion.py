"""From verdicts to quotes and back: status, refresh, assembly, re-keying, review populations
(V07, V09, V13, V15-V17, V19, V20, N05, N10, W04, X24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folding import statement_key
from ..functions.text import words_shown, spliced
from ..schemas import MULTILINGUAL_TAGS
from ..sources.records import review_status
from . import sampling, verdicts
from .mirrors import once
from .speakers import jurisdiction


def statuses(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """adjudicated with a verdict, error with failures only, else pending."""
    seen = log.groupBy(F.col("candidate_id").alias("id")).agg(F.count("verdict").alias("good"))
    out = candidates.drop("status").join(seen, "id", "left")
    return out.withColumn("status", F.when(F.col("good") > 0, "adjudicated").when(F.col("good") == 0, "error").otherwise("pending")).drop("good")


def refreshed(quotes: DataFrame, best: DataFrame) -> DataFrame:
    """Quotes whose verdict is still the best of their candidate."""
    return quotes.join(best.select("candidate_id", F.col("id").alias("adjudication_id")), ["candidate_id", "adjudication_id"], "left_semi")


def with_promoted_mirrors(quotes: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Quotes with what their duplicates were added to their mirrors, once each (V13).  ``duplicates`` has
    span_key, source, url, date.  Quotes without mirrors take the set of their key as it is."""
    m = duplicates.groupBy("span_key").agg(F.sort_array(F.collect_set(F.struct("source", "url", "date"))).alias("new_mirrors"))
    none = F.expr("cast(array() as array<struct<source:string,url:string,date:date>>)")
    old, new = F.coalesce("mirrors", none), F.coalesce("new_mirrors", none)
    return quotes.join(m, "span_key", "left").withColumn("mirrors", F.when(F.size(old) == 0, new).otherwise(once(F.concat(old, new)))).drop("new_mirrors")


def quotes_of(rows: DataFrame) -> DataFrame:
    """The quote table's rows from promoted candidates with their record."""
    v = F.col("verdict")
    return rows.where("decision = 'promoted'").select(
        "candidate_id",
        "adjudication_id",
        F.lit(None).cast("string").alias("speaker_id"),
        verdicts.squeezed_name(F.coalesce("speaker_raw", v["speaker_name"])).alias("speaker_display"),
        jurisdiction(F.col("source")).alias("jurisdiction"),
        F.col("doc_date").alias("date"),
        "date_precision",
        v["quote_span"].alias("quote_original"),
        v["quote_en"].alias("quote_en"),
        F.col("topics").alias("concepts"),
        v["stance"].alias("stance"),
        v["quote_type"].alias("quote_type"),
        v["trigger_phrases"].alias("trigger_phrases"),
        v["context_note"].alias("context"),
        F.coalesce("citation_url", "url").alias("source_url"),
        "language",
        "source",
        "span_key",
        statement_key(v["quote_span"]).alias("statement_key"),
        review_status(F.col("meta")).alias("review_status"),
    )


def rekeyed(quotes: DataFrame, names: DataFrame) -> DataFrame:
    """Keys recomputed with canonical names after linking (V16).  ``names``: speaker_id, canonical_name."""
    q = quotes.join(names.select("speaker_id", "canonical_name"), "speaker_id", "left")
    key = F.coalesce("statement_key", statement_key(F.col("quote_original")))
    return q.withColumn("statement_key", key).withColumn("span_key", verdicts.span_key(F.coalesce("canonical_name", "speaker_display"), F.col("statement_key"))).drop("canonical_name")


def disputed(quotes: DataFrame, refuted: DataFrame) -> DataFrame:
    """Quotes that a skeptic refuted become disputed."""
    r = refuted.select("candidate_id").distinct().withColumn("refuted", F.lit(True))
    return quotes.join(r, "candidate_id", "left").withColumn("review_status", F.when(F.col("refuted"), "disputed").otherwise(F.col("review_status"))).drop("refuted")


def skeptic_sample(quotes: DataFrame, n: int, seed: int) -> DataFrame:
    """A sample in proportion to jurisdictions, one of each at least."""
    sizes = quotes.groupBy("jurisdiction").agg(F.count(F.lit(1)).alias("n"))
    share = F.lit(n) * F.col("n") / F.sum("n").over(Window.partitionBy())
    return sampling.drawn(quotes, "candidate_id", ["jurisdiction"], sizes.select("jurisdiction", F.greatest(F.bround(share), F.lit(1)).cast("long").alias("slots")), seed)


def needs_translation(language: Column) -> Column:
    """Tagged with a language other than English."""
    return ~F.coalesce(language, F.lit("")).isin("en", *MULTILINGUAL_TAGS)


def refinement_problem(refined: Column, text: Column, language: Column, most: int = 150) -> Column:
    """Why a refinement fails its guards, as feedback for one retry; null if it passes."""
    english = F.coalesce(F.nullif(refined["display_quote_en"], F.lit("")), refined["display_quote"])
    return (
        F.when(~F.coalesce(spliced(refined["display_quote"], text), F.lit(False)), "display_quote is not spliced from the passage")
        .when(needs_translation(language) & (F.coalesce(refined["display_quote_en"], F.lit("")) == ""), "display_quote_en is missing")
        .when(words_shown(english) > most, F.concat(F.lit("the quote has "), words_shown(english).cast("string"), F.lit(" words")))
    )


def refine_message(quotes: DataFrame, passage: Column) -> Column:
    """The refining judge's view of a quote."""
    line = lambda name, c: F.concat(F.lit(f"{name}: "), c, F.lit("\n"))
    return F.concat(
        line("Jurisdiction", F.col("jurisdiction")), line("Speaker", F.col("speaker_display")), line("Date", F.coalesce(F.col("date").cast("string"), F.lit("None"))),
        line("Setting", F.coalesce("speech_context", "title", F.lit("unknown"))), line("Language", F.coalesce("language", F.lit("en"))), line("First-stage topics", F.coalesce(F.nullif(F.array_join("concepts", ", "), F.lit("")), F.lit("none"))),
        F.lit("\nACCEPTED QUOTE (first-stage span):\n"), F.col("quote_original"), F.lit("\n\nPASSAGE (source text around the quote; display_quote segments must be verbatim substrings of this):\n"), passage,
    )


def skeptic_message(longest: int = 6000) -> Column:
    """The skeptic's view of a quote."""
    c = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("None"))
    return F.concat(
        F.lit("Jurisdiction: "), c("jurisdiction"), F.lit("\nSpeaker: "), c("speaker_display"), F.lit("\nDate: "), c("date"), F.lit("\nSetting: "), c("context"), F.lit("\nLabeled concepts: "), F.to_json(F.col("concepts")),
        F.lit("\nLabeled quote_type: "), c("quote_type"), F.lit("\n\nACCEPTED QUOTE:\n"), F.col("quote_original"), F.lit("\n\nFULL SOURCE PASSAGE:\n"), F.substring("text", 1, longest),
    )


def refined_rows(quotes: DataFrame, log: DataFrame, prompt: str) -> DataFrame:
    """Quotes with their best refinement and the judges' consensus."""
    best = verdicts.best_refinement(log, prompt).select("candidate_id", verdicts.parsed_refinement(F.col("verdict")).alias("refined"))
    votes = log.where("verdict is not null").select("candidate_id", "model", "id", verdicts.parsed_refinement(F.col("verdict"))["coarse_topics"].alias("coarse_topics"))
    return quotes.join(best, "candidate_id", "left").join(verdicts.consensus(votes), "candidate_id", "left")


def population(log: DataFrame, spined: DataFrame, prompt: str, language: str | None = None) -> DataFrame:
    """Candidates with their authoritative verdict, place and year; what cannot be read is out
    (N05, W04)."""
    rows = log.where("verdict is not null")
    best = verdicts.best_of(rows, ["candidate_id", "model"], (F.col("prompt_sha256") == prompt).desc(), F.col("id").desc())
    read = best.withColumn("v", verdicts.parsed_verdict(F.col("verdict"))).where("v is not null")
    topics = verdicts.topics(lambda k: F.col(f"v.relevance.{k}"))
    read = read.select("candidate_id", "model", F.col("id").alias("adjudication_id"), verdicts.accepted(topics, F.col("v.is_substantive"), F.col("v.speaker_owns_statement"), F.col("v.speaker_in_scope")).alias("judge_accept"))
    s = spined if language is None else spined.where(F.col("language") == language)
    places = s.select(F.col("id").alias("candidate_id"), jurisdiction(F.col("source")).alias("jurisdiction"), F.coalesce(F.nullif(F.substring(F.col("doc_date").cast("string"), 1, 4), F.lit("")), F.lit("unknown")).alias("year"))
    return read.join(places, "candidate_id")


def applied_labels(labels: Column, primary: Column, vocabulary: list[str]) -> Column:
    """Labels of the vocabulary that a judge chose: a primary that code appended last is not."""
    known = F.filter(labels, lambda x: x.isin(vocabulary))
    before = F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0)))
    appended = F.array_contains(known, primary) & (F.size(known) > 1) & ~F.array_contains(before, primary)
    return F.when(F.coalesce(appended, F.lit(False)), F.array_remove(known, primary)).otherwise(known)


def passage_parts(text: Column, marks: Column) -> Column:
    """Runs of a passage, plain or marked, in order (X24): ``marks`` are sorted, disjoint structs of
    start, end and kind."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<kind:string,text:string>>)").alias("out"))
    part = lambda kind, a, b: F.filter(F.array(F.struct(kind.alias("kind"), F.substr(text, a + 1, b - a).alias("text"))), lambda p: p["text"] != "")

    def step(acc: Column, m: Column) -> Column:
        return F.struct(m["end"].alias("at"), F.concat(acc["out"], part(F.lit("plain"), acc["at"], m["start"]), part(m["kind"], m["start"], m["end"])).alias("out"))

    return F.aggregate(marks, start, step, lambda acc: F.concat(acc["out"], part(F.lit("plain"), acc["at"], F.length(text))))
