"""Verdicts: validation, topics, acceptance, best of several, what is pending, promotion
(F08-F11, W01-W04, W11, V03-V11, A08)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import content_key, squeeze, within
from ..schemas import BARS, COARSE_TOPICS, FRONTIER_TOPICS, POLICY_INSTRUMENTS, QUOTE_TYPES, REFINEMENT, REGULATION_SCORES, RISK_SCORES, RISK_SUBDOMAINS, STANCES, TOPICS, VERDICT


def topics(relevance: Callable[[str], Column]) -> Column:
    """Topics whose score reaches its bar, in fixed order (F08); generic ai never counts."""
    return F.array_compact(F.array(*[F.when(relevance(t) >= BARS[t], F.lit(t)) for t in TOPICS]))


def accepted(topic_list: Column, substantive: Column, owns: Column, in_scope: Column) -> Column:
    """Some topic, and all three judgements."""
    return F.coalesce((F.size(topic_list) > 0) & substantive & owns & in_scope, F.lit(False))


def json_in(answer: Column) -> Column:
    """The outermost JSON object of a model's answer, fences or not."""
    fenced = F.regexp_extract(answer, r"(?s)```(?:json)?\s*(.*?)```", 1)
    body = F.when(fenced != "", fenced).otherwise(answer)
    found = F.regexp_extract(body, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def parsed_verdict(raw: Column) -> Column:
    """The verdict, or null where a field is missing, out of range or unknown."""
    v = F.from_json(raw, VERDICT)
    score = lambda c: c.isNotNull() & c.between(0, 100)
    sub = lambda c: c.isNull() | c.between(0, 100)
    fine = F.lit(True)
    for t in ("ai", *TOPICS):
        fine = fine & score(v["relevance"][t])
    for group, names in (("x_risk_sub", RISK_SCORES), ("regulation_sub", REGULATION_SCORES)):
        for n in names:
            fine = fine & sub(v["relevance"][group][n])
    for name in ("rationale", "quote_span", "is_substantive", "speaker_owns_statement", "speaker_in_scope", "context_note"):
        fine = fine & v[name].isNotNull()
    fine = fine & v["quote_type"].isin(QUOTE_TYPES) & v["stance"].isin(STANCES)
    return F.when(F.coalesce(fine, F.lit(False)), v)


def parsed_refinement(raw: Column) -> Column:
    """The refinement with canonical coarse topics, its primary made consistent, or null."""
    v = F.from_json(raw, REFINEMENT)
    every = lambda a, vocab: F.forall(a, lambda x: x.isin(vocab))
    lit_array = lambda xs: F.array(*map(F.lit, xs))
    risks, tools = F.coalesce(v["risk_subdomains"], F.array().cast("array<string>")), F.coalesce(v["policy_instruments"], F.array().cast("array<string>"))
    given = v["primary_topic"]
    risk0, tool0 = F.try_element_at(risks, F.lit(1)), F.try_element_at(tools, F.lit(1))
    primary = F.when(given == "x_risk", F.coalesce(risk0, F.lit("other"))).when(given == "regulation", F.coalesce(tool0, risk0, F.lit("other"))).otherwise(given)
    add = lambda a, vocab: F.when(primary.isin(vocab) & ~F.array_contains(a, primary), F.concat(a, F.array(primary))).otherwise(a)
    coarse = F.when(v["coarse_topics"].isNotNull(), F.array_intersect(lit_array(COARSE_TOPICS), F.when(primary.isin(FRONTIER_TOPICS), F.concat(v["coarse_topics"], F.array(primary))).otherwise(v["coarse_topics"])))
    fine = every(risks, RISK_SUBDOMAINS) & every(tools, POLICY_INSTRUMENTS) & F.coalesce(every(v["coarse_topics"], COARSE_TOPICS), F.lit(True))
    fine = fine & primary.isin([*RISK_SUBDOMAINS, *POLICY_INSTRUMENTS, *FRONTIER_TOPICS, "other"]) & v["display_quote"].isNotNull()
    out = F.struct(coarse.alias("coarse_topics"), add(risks, RISK_SUBDOMAINS).alias("risk_subdomains"), add(tools, POLICY_INSTRUMENTS).alias("policy_instruments"), primary.alias("primary_topic"), v["rationale"].alias("rationale"), v["display_quote"].alias("display_quote"), v["display_quote_en"].alias("display_quote_en"))
    return F.when(F.coalesce(fine, F.lit(False)), out)


def best_of(rows: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The first row of each key in a total order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("best_rank", F.row_number().over(w)).where("best_rank = 1").drop("best_rank")


def best_adjudication(log: DataFrame, prompt: str) -> DataFrame:
    """Current prompt first, then confirm over escalation over primary, then the newest."""
    role = F.when(F.col("role") == "confirm", 0).when(F.col("role") == "escalation", 1).otherwise(2)
    rows = log.where("verdict is not null and role in ('confirm', 'escalation', 'primary')")
    return best_of(rows, ["candidate_id"], (F.col("prompt_sha256") == prompt).desc(), role, F.col("id").desc())


def best_refinement(log: DataFrame, prompt: str, by_model: bool = False) -> DataFrame:
    """Current prompt first, then the newest; for each model if asked."""
    key = ["candidate_id", *(["model"] if by_model else [])]
    return best_of(log.where("verdict is not null"), key, (F.col("prompt_sha256") == prompt).desc(), F.col("id").desc())


def pending(candidates: DataFrame, log: DataFrame, prompt: str, confirm: bool = False, retry_errors: bool = True, limit: int | None = None) -> DataFrame:
    """Candidates without a resolving verdict at this prompt: a confirmation, a rejection, or (with
    a single judge) any primary verdict (V03, W11, O01).  ``log`` has an ``accept`` column."""
    now = log.where(F.col("prompt_sha256") == prompt)
    has = F.col("verdict").isNotNull()
    flags = now.groupBy("candidate_id").agg(
        F.max((has & (F.col("role") == "confirm")).cast("int")).alias("confirmed"),
        F.max((has & ~F.col("accept")).cast("int")).alias("rejected"),
        F.max((has & (F.col("role") == "primary")).cast("int")).alias("primary"),
        F.max((~has).cast("int")).alias("failed"),
    )
    done = (F.col("confirmed") == 1) | (F.col("rejected") == 1)
    if not confirm:
        done = done | (F.col("primary") == 1)
    if not retry_errors:
        done = done | (F.col("failed") == 1)
    out = candidates.join(flags.where(done).select(F.col("candidate_id").alias("id")), "id", "left_anti")
    return out.orderBy("id").limit(limit) if limit else out


def judged(rows: DataFrame, judge: Callable[[pd.DataFrame], pd.Series], message: Column, system: str, model: str, known: DataFrame | None = None) -> DataFrame:
    """Ask a judge about each distinct message once; answers already known by key are joined.
    ``judge`` maps a frame with ``message`` to answers, batch by batch."""
    keyed = rows.withColumn("message", message).withColumn("cache_key", content_key(F.lit(model), F.lit(system), F.col("message")))
    todo = keyed.select("cache_key", "message").dropDuplicates(["cache_key"])
    if known is not None:
        todo = todo.join(known.select("cache_key"), "cache_key", "left_anti")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"cache_key": b["cache_key"], "raw_response": judge(b)})

    fresh = todo.mapInPandas(ask, "cache_key string, raw_response string")
    if known is not None:
        fresh = fresh.unionByName(known.select("cache_key", "raw_response"))
    return keyed.join(fresh, "cache_key", "left")


def upserted(old: DataFrame, new: DataFrame) -> DataFrame:
    """An append-only log keyed by cache_key: a new row counts if there is none with a verdict."""
    both = old.withColumn("fresh", F.lit(0)).unionByName(new.withColumn("fresh", F.lit(1)))
    return best_of(both, ["cache_key"], ((F.col("fresh") == 0) & F.col("verdict").isNotNull()).desc(), F.col("fresh").desc(), F.col("id").desc()).drop("fresh")


def span_key(canonical: Column, statement: Column) -> Column:
    """Who and what, as 32 hex digits."""
    return F.substring(content_key(canonical, statement), 1, 32)


def decisions(rows: DataFrame, quoted_keys: DataFrame, confirm: bool = False) -> DataFrame:
    """Why a candidate is promoted or not, the first reason that holds (V10).  ``rows`` has
    candidate_id, verdict (parsed or null), raw_verdict, accept, role, text, span_key.
    Of several candidates with one span_key the first by candidate_id is promoted."""
    reason = (
        F.when(F.col("raw_verdict").isNull(), "no_adjudication")
        .when(F.col("verdict").isNull(), "legacy_schema")
        .when(~F.col("accept"), "rejected")
        .when(F.lit(confirm) & (F.col("role") != "confirm"), "awaiting_confirm")
        .when(~within(F.col("verdict.quote_span"), F.col("text")), "not_verbatim")
    )
    staged = rows.withColumn("reason", reason)
    known = quoted_keys.select("span_key").distinct().withColumn("known", F.lit(True))
    w = Window.partitionBy("span_key", F.col("reason").isNull()).orderBy("candidate_id")
    out = staged.join(known, "span_key", "left").withColumn("r", F.row_number().over(w))
    again = F.col("reason").isNull() & (F.coalesce(F.col("known"), F.lit(False)) | (F.col("r") > 1))
    return out.withColumn("decision", F.when(again, "duplicate").otherwise(F.coalesce("reason", F.lit("promoted")))).drop("reason", "known", "r")


def consensus(votes: DataFrame) -> DataFrame:
    """candidate_id, judges, agreed and disputed topics of each judge's newest list (A08).  ``votes``
    has candidate_id, model, id and coarse_topics; a null list is no vote."""
    newest = best_of(votes, ["candidate_id", "model"], F.col("id").desc())
    heads = newest.groupBy("candidate_id").agg(F.count("coarse_topics").alias("judges"))
    each = newest.select("candidate_id", F.explode("coarse_topics").alias("topic")).groupBy("candidate_id", "topic").agg(F.count(F.lit(1)).alias("n"))
    lists = each.groupBy("candidate_id").agg(F.map_from_entries(F.collect_list(F.struct("topic", "n"))).alias("by"))
    order = F.array(*map(F.lit, COARSE_TOPICS))
    votes_for = lambda t: F.coalesce(F.try_element_at(F.col("by"), t), F.lit(0))
    return heads.join(lists, "candidate_id", "left").select(
        "candidate_id",
        "judges",
        F.filter(order, lambda t: (F.col("judges") > 0) & (votes_for(t) == F.col("judges"))).alias("agreed"),
        F.filter(order, lambda t: (votes_for(t) > 0) & (votes_for(t) < F.col("judges"))).alias("disputed"),
    )


def rule_judge(scores: dict[str, Column]) -> Column:
    """A deterministic judge for offline runs: scores become a relevance struct."""
    return F.struct(*[F.least(F.lit(100), F.greatest(F.lit(0), c)).cast("int").alias(k) for k, c in scores.items()])


def user_message(jurisdiction: Column, speaker: Column, date: Column, setting: Column, verbatim: Column, language: Column, text: Column) -> Column:
    """The judge's view of a passage."""
    return F.concat(
        F.lit("Jurisdiction: "), jurisdiction, F.lit("\nSpeaker: "), F.coalesce(speaker, F.lit("UNKNOWN")), F.lit("\nDate: "), F.coalesce(date.cast("string"), F.lit("None")), F.lit("\nSetting: "), F.coalesce(setting, F.lit("unknown")),
        F.lit("\nRecord: "), F.when(verbatim, "verbatim").otherwise("may be paraphrase"), F.lit("\nLanguage: "), F.coalesce(language, F.lit("")), F.lit("\n\n"), text,
    )


def translated(rows: DataFrame, span: str, translate: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """English of each distinct span, asked once."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({span: b[span], "translated": translate(b[span])})

    once = rows.select(span).where(F.col(span).isNotNull()).distinct().mapInPandas(ask, f"`{span}` string, translated string")
    return rows.join(once, span, "left")


def squeezed_name(display: Column) -> Column:
    """A speaker's display without a trailing [V]; Unknown if nothing is left."""
    name = squeeze(F.regexp_replace(F.coalesce(display, F.lit("")), r"\s*\[V\]\s*$", ""))
    return F.when(name == "", "Unknown").otherwise(name)
