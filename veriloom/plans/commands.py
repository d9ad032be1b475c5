"""The pipeline's commands over a folder of Parquet tables: each reads tables, and writes its own anew
under a fresh version, which then becomes current."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.excerpt import context, find_span
from ..functions.folding import bold, containment_key, statement_key
from ..functions.text import content_key, passage, presentable, public_id, squashed
from ..operators import export, joins, keywords, mirrors, promotion, sampling, speakers, statistics, verdicts
from ..operators.keywords import TermList
from ..schemas import POLICY_INSTRUMENTS, RISK_SUBDOMAINS, TABLES
from ..sources import ledger, pages


class Store:
    """Tables under a root; the current version of each is named in the store's own small table."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.current: dict[str, str] = {}
        try:
            rows = spark.read.json(f"{self.root}/_versions").collect()  # one row for each write
            for r in sorted(rows, key=lambda r: r["n"]):
                self.current[r["name"]] = r["path"]
            self.n = len(rows)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            self.n = 0

    def read(self, name: str) -> DataFrame:
        if name in self.current:
            return self.spark.read.parquet(self.current[name])
        return self.spark.createDataFrame([], TABLES[name])

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}/v={uuid.uuid4().hex}"
        df.write.parquet(path)
        self.spark.createDataFrame([(self.n, name, path)], "n long, name string, path string").coalesce(1).write.mode("append").json(f"{self.root}/_versions")
        self.n += 1
        self.current[name] = path
        return self.spark.read.parquet(path)


def fetch(store: Store, spans: DataFrame, days: int, today: str) -> DataFrame:
    """Windows that are still to be fetched; what fetches them is the caller's (no network here)."""
    planned = ledger.lagged(ledger.tiles(spans, days), F.to_date(F.lit(today)))
    return ledger.open_windows(planned, store.read("watermarks"))


def mark(store: Store, windows: DataFrame, status: str = "done") -> DataFrame:
    """Record windows in the coverage ledger."""
    news = windows.select("source", "window_start", "window_end", F.lit(status).alias("status"), F.current_timestamp().alias("updated_at"), F.lit(None).cast("string").alias("note"))
    return store.write("watermarks", ledger.marked(store.read("watermarks"), news))


def scan(store: Store, lists: list[TermList]) -> DataFrame:
    """Filter: new candidates of this version of the lists."""
    old = store.read("candidates")
    u = store.read("utterances").join(store.read("documents").select(F.col("id").alias("document_id"), "source"), "document_id")
    fresh = keywords.candidates(u, lists, old).select(F.col("id").alias("utterance_id"), "keyword_version", "matches")
    new = fresh.select(F.xxhash64("utterance_id", "keyword_version").alias("id"), "utterance_id", "keyword_version", "matches", F.current_timestamp().alias("created_at"), F.lit("pending").alias("status"))
    return store.write("candidates", old.unionByName(new))


def adjudicate(store: Store, judge: Callable[[pd.DataFrame], pd.Series], prompt: str, model: str, role: str = "primary") -> DataFrame:
    """Ask the judge about pending candidates and add to the log."""
    log = store.read("adjudications")
    v = verdicts.parsed_verdict(F.col("verdict"))
    flagged = log.withColumn("accept", verdicts.accepted(verdicts.topics(lambda k: v["relevance"][k]), v["is_substantive"], v["speaker_owns_statement"], v["speaker_in_scope"]))
    sha = F.sha2(F.lit(prompt), 256)
    todo = verdicts.pending(store.read("candidates"), flagged.withColumn("prompt_sha256", F.when(F.col("prompt_sha256") == sha, prompt)), prompt)
    rows = joins.spine(todo, store.read("utterances"), store.read("documents"))
    starts, ends = F.col("matches.start"), F.col("matches.end")
    message = verdicts.user_message(speakers.jurisdiction(F.col("source")), F.col("speaker_raw"), F.col("doc_date"), F.coalesce("speech_context", "title"), F.col("is_verbatim"), F.col("language"), passage(F.col("text"), starts, ends))
    asked = verdicts.judged(rows, judge, message, prompt, model)
    answer = verdicts.json_in(F.col("raw_response"))
    good = verdicts.parsed_verdict(answer).isNotNull()
    new = asked.select(
        F.xxhash64("id", "cache_key").alias("id"), F.col("id").alias("candidate_id"), F.lit(model).alias("model"), F.lit(None).cast("string").alias("provider"), sha.alias("prompt_sha256"), F.lit(role).alias("role"),
        F.when(good, answer).alias("verdict"), "raw_response", F.when(~good, "invalid verdict").alias("error"), F.current_timestamp().alias("created_at"), F.sha2(F.concat("cache_key", F.col("id").cast("string")), 256).alias("cache_key"),
    )
    log = store.write("adjudications", verdicts.upserted(log, new))
    store.write("candidates", promotion.statuses(store.read("candidates"), log).select(*store.read("candidates").columns))
    return log


def promote(store: Store, prompt: str, confirm: bool = False, excluded: tuple[str, ...] = (), aliases: DataFrame | None = None) -> DataFrame:
    """Quotes of accepted candidates; why the others are none is in ``decisions``.

    Incremental: quotes whose verdict is still the best of their candidate stay as they are, with their
    links and states; only candidates without a quote are decided.  A duplicate of a quote, old or
    new, becomes one of its mirrors.  ``aliases`` (jurisdiction, label, canonical_name, load_order) name
    speakers as link() will, so that a statement is known again after it was linked."""
    sha = F.sha2(F.lit(prompt), 256)
    log = store.read("adjudications").withColumn("prompt_sha256", F.when(F.col("prompt_sha256") == sha, prompt).otherwise(F.col("prompt_sha256")))
    best = verdicts.best_adjudication(log, prompt)
    kept = promotion.refreshed(store.read("quotes"), best)
    v = verdicts.parsed_verdict(F.col("raw_verdict"))
    rows = joins.spine(store.read("candidates"), store.read("utterances"), store.read("documents")).join(best.select(F.col("candidate_id").alias("id"), F.col("id").alias("adjudication_id"), F.col("verdict").alias("raw_verdict"), "role"), "id", "left")
    rows = joins.absent(rows.withColumnRenamed("id", "candidate_id"), kept, ["candidate_id"]).where(~F.col("source").isin(list(excluded)))
    rows = rows.withColumn("verdict", v).withColumn("topics", verdicts.topics(lambda k: F.col(f"verdict.relevance.{k}")))
    rows = rows.withColumn("accept", verdicts.accepted(F.col("topics"), F.col("verdict.is_substantive"), F.col("verdict.speaker_owns_statement"), F.col("verdict.speaker_in_scope")))
    rows = rows.withColumn("speaker_display", verdicts.squeezed_name(F.coalesce("speaker_raw", "verdict.speaker_name"))).withColumn("jurisdiction", speakers.jurisdiction(F.col("source")))
    rows = rows.withColumn("canonical_name", F.lit(None).cast("string")) if aliases is None else speakers.canonical_names(rows, aliases)
    key = verdicts.span_key(F.coalesce("canonical_name", "speaker_display"), statement_key(F.col("verdict.quote_span")))
    decided = store.write("decisions", verdicts.decisions(rows.withColumn("span_key", key).drop("canonical_name", "speaker_display", "jurisdiction"), kept, confirm))
    new = promotion.quotes_of(decided).withColumn("speaker_resolution", speakers.resolution(F.col("speaker_display"), F.lit("")))
    columns = [c.split()[0] for c in TABLES["quotes"].split(", ")]
    both = kept.select(*columns).unionByName(new.withColumn("extraction_method", F.lit("direct")).withColumn("mirrors", F.array().cast(dict(kept.dtypes)["mirrors"])).select(*columns))
    twins = decided.where("decision = 'duplicate'").select("span_key", "source", F.coalesce("citation_url", "url").alias("url"), F.col("doc_date").alias("date"))
    return store.write("quotes", promotion.with_promoted_mirrors(both, twins).select(*columns))


def link(store: Store, aliases: DataFrame, native: DataFrame, names: DataFrame) -> DataFrame:
    """Speakers of all quotes by the cascade, and keys with their canonical names."""
    q = store.read("quotes")
    ask = q.select(F.col("candidate_id").alias("quote_id"), "speaker_display", "jurisdiction", "source", F.lit(None).cast("string").alias("native_id"))
    found = speakers.linked(ask, speakers.alias_map(aliases), native, names).select(F.col("quote_id").alias("candidate_id"), "speaker_id")
    return store.write("quotes", promotion.rekeyed(q.drop("speaker_id").join(found, "candidate_id", "left"), names.select("speaker_id", "canonical_name").dropDuplicates(["speaker_id"])))


def publish(store: Store, path: str, version: str, generated: str, excluded: tuple[str, ...] = ()) -> DataFrame:
    """Export: filter, collapse mirrors, name, and write the payload with the remarks round its rows."""
    spark = store.spark
    spined = joins.spine(store.read("candidates"), store.read("utterances"), store.read("documents")).select(F.col("id").alias("candidate_id"), "text", "speech_context", "speaker_raw", "doc_language", "title", "citation_url")
    barred = spark.createDataFrame([(x,) for x in excluded], "source string")
    q = export.published(store.read("quotes").join(spined, "candidate_id"), barred)
    refined = promotion.refined_rows(q.select("candidate_id"), store.read("refinements"), "")
    r = F.col("refined")
    q = q.join(refined, "candidate_id", "left").withColumn("id", public_id(F.col("source_url"), presentable(F.col("quote_original"))))
    q = q.withColumn("display_quote", r["display_quote"]).withColumn("display_quote_en", r["display_quote_en"]).withColumn("shown", presentable(F.coalesce("display_quote", "quote_original")))
    q = q.where(~export.statutory(F.col("speaker_display"), F.col("jurisdiction"), F.col("source"), F.col("shown"), F.col("display_quote_en"), F.col("quote_original"), F.col("quote_en")))
    # Of rows with one public id the first candidate stands for all.
    q = verdicts.best_of(q, ["id"], F.col("candidate_id"))
    links = mirrors.key_links(q, "id", [[F.col("jurisdiction"), F.col("statement_key")], [F.col("jurisdiction"), statement_key(F.col("shown"))]])
    links = links.unionByName(mirrors.containment_links(q.withColumn("key", containment_key("shown")), "id", ["jurisdiction", "speaker_display"], "key"))
    rank = mirrors.survivor_rank(F.col("shown"), F.col("date_precision"), F.col("date"), F.col("source"))
    kept, child = mirrors.collapsed(q, "id", links, rank, {"source": F.col("source"), "url": F.col("source_url"), "date": F.col("date")})
    # Promotion's mirrors first, then those that collapsed here.
    shown = mirrors.with_mirrors(kept.withColumnRenamed("mirrors", "promoted_mirrors"), "id", child)
    out = shown.withColumn("mirrors", mirrors.once(F.concat("promoted_mirrors", "mirrors"))).drop("promoted_mirrors", "n_mirrors")
    out = out.select(
        "*",
        F.col("speaker_display").alias("speaker"),
        F.coalesce("speech_context", "title").alias("body"),
        F.struct(r["primary_topic"].alias("primary"), r["risk_subdomains"].alias("risks"), r["policy_instruments"].alias("instruments"), F.col("disputed").alias("disputed")).alias("topics_refined"),
        bold("quote_en", "trigger_phrases").alias("quote_html"),
        export.coarse_topics(F.col("judges"), F.col("agreed"), F.col("concepts")).alias("topics"),
        F.lit(None).cast("map<string,int>").alias("scores"),
        F.col("speaker_raw").alias("speaker_as_recorded"),
        *[F.lit(None).cast("string").alias(c) for c in ("speaker_role", "speaker_description", "speaker_profile_url", "speaker_image_url")],
    ).withColumn("refined", F.when(F.col("refined").isNotNull(), F.col("topics_refined")))
    records = store.write("sidecar", export.sidecar_records(out, out.select("source_url", "quote_original", "text", "language", "speech_context")))
    lengths = records.select("id", F.length(F.get_json_object("record", "$.t")).alias("utterance_len"))
    out = store.write("published", out.join(lengths, "id", "left"))
    through = export.coverage_end(store.read("watermarks"), F.to_date(F.lit(generated))).first()["coverage_end"]
    export.write_payload(out, path, version, generated, None if through is None else str(through))
    export.write_sidecar(records, f"{path}/site", version, generated)
    for name, df in stats_parts(store).items():
        df.coalesce(1).write.mode("overwrite").json(f"{path}/stats/{name}")
    return out


def stats_parts(store: Store) -> dict[str, DataFrame]:
    """The funnel and four group-bys of the quotes."""
    q = store.read("quotes")
    return {
        "funnel": stats(store),
        "by_jurisdiction": statistics.counted(q, F.col("jurisdiction")),
        "by_concept": statistics.counted(q.select(F.explode("concepts").alias("concept")), F.col("concept")),
        "by_quarter": statistics.counted(q.where("date is not null"), statistics.quarter(F.col("date")).alias("quarter")),
        "by_quote_type": statistics.counted(q, F.col("quote_type")),
    }


def refine(store: Store, judge: Callable[[pd.DataFrame], pd.Series], prompt: str, model: str, retry_errors: bool = True) -> DataFrame:
    """Ask the judge to refine quotes without a refinement at this prompt; an answer that fails its
    guards is asked for once more, with what was wrong (J06, V19)."""
    log = store.read("refinements")
    sha = F.sha2(F.lit(prompt), 256)
    done = log.where((F.col("prompt_sha256") == sha) & (F.col("model") == model) & (F.col("verdict").isNotNull() | F.lit(not retry_errors)))
    spined = joins.spine(store.read("candidates"), store.read("utterances"), store.read("documents")).select(F.col("id").alias("candidate_id"), "text", "speech_context", "title")
    q = joins.absent(store.read("quotes"), done, ["candidate_id"]).join(spined, "candidate_id")
    around = context(F.col("text"), find_span(F.col("text"), F.col("quote_original")))
    ask = promotion.refine_message(q, around)
    rows = q.select("candidate_id", "text", "language", ask.alias("ask"))

    def answered(rows: DataFrame, message: Column) -> DataFrame:
        got = verdicts.judged(rows, judge, message, prompt, model)
        answer = verdicts.json_in(F.col("raw_response"))
        parsed = verdicts.parsed_refinement(answer)
        wrong = F.when(parsed.isNull(), "the answer is no valid refinement").otherwise(promotion.refinement_problem(parsed, F.col("text"), F.col("language")))
        return got.select("candidate_id", "text", "language", "ask", "raw_response", answer.alias("answer"), wrong.alias("wrong"))

    first = store.write("refine_first", answered(rows, F.col("ask")))
    retry = F.concat("ask", F.lit("\n\nYour previous answer failed validation: "), "wrong", F.lit(". Return ONLY the corrected JSON object."))
    second = answered(first.where("wrong is not null").select("candidate_id", "text", "language", F.concat(retry).alias("ask")), F.col("ask"))
    both = first.where("wrong is null").unionByName(second)
    new = both.select(
        F.xxhash64("candidate_id", F.lit(model), sha).alias("id"), "candidate_id", F.lit(model).alias("model"), F.lit(None).cast("string").alias("provider"), sha.alias("prompt_sha256"),
        F.when(F.col("wrong").isNull(), F.col("answer")).alias("verdict"), "raw_response", F.when(F.col("wrong").isNotNull(), F.concat(F.lit("validation: "), "wrong")).alias("error"), F.current_timestamp().alias("created_at"),
        content_key(F.col("text"), sha, F.lit(model), F.lit("refine"), F.col("candidate_id")).alias("cache_key"),
    )
    return store.write("refinements", verdicts.upserted(log, new))


def skeptic(store: Store, judge: Callable[[pd.DataFrame], pd.Series], prompt: str, model: str, n: int = 200, seed: int = 20260712) -> DataFrame:
    """A second judge tries to refute a sample of accepted quotes; what it refutes becomes disputed.
    Survival by jurisdiction with intervals (A20, V17)."""
    spined = joins.spine(store.read("candidates"), store.read("utterances"), store.read("documents")).select(F.col("id").alias("candidate_id"), "text")
    sample = promotion.skeptic_sample(store.read("quotes").where("review_status = 'accepted'"), n, seed).join(spined, "candidate_id")
    asked = verdicts.judged(sample, judge, promotion.skeptic_message(), prompt, model)
    v = F.from_json(verdicts.json_in(F.col("raw_response")), "refuted boolean, confidence double, reason string")
    told = store.write("skeptic", asked.select("candidate_id", "jurisdiction", "raw_response", v["refuted"].alias("refuted")))
    sha = F.sha2(F.lit(prompt), 256)
    new = told.where("refuted is not null").select(
        F.xxhash64("candidate_id", F.lit("skeptic"), sha).alias("id"), "candidate_id", F.lit(model).alias("model"), F.lit(None).cast("string").alias("provider"), sha.alias("prompt_sha256"), F.lit("skeptic").alias("role"),
        verdicts.json_in(F.col("raw_response")).alias("verdict"), "raw_response", F.lit(None).cast("string").alias("error"), F.current_timestamp().alias("created_at"), content_key(F.col("candidate_id"), sha, F.lit(model), F.lit("skeptic")).alias("cache_key"),
    )
    store.write("adjudications", verdicts.upserted(store.read("adjudications"), new))
    store.write("quotes", promotion.disputed(store.read("quotes"), told.where("refuted")))
    return statistics.breakdown(told.where("refuted is not null"), "jurisdiction", ~F.col("refuted"))


def supersede_provisional(store: Store, source: str) -> DataFrame:
    """Quotes of provisional documents that a final one has replaced are excluded."""
    d = store.read("documents").where(F.col("source") == source)
    key = F.concat_ws("|", F.col("doc_date").cast("string"), squashed(F.col("title")))
    gone = joins.superseded(d, key, F.coalesce("is_provisional", F.lit(False))).select(F.col("id").alias("document_id"))
    cands = store.read("candidates").join(store.read("utterances").select(F.col("id").alias("utterance_id"), "document_id"), "utterance_id").join(gone, "document_id", "left_semi").select(F.col("id").alias("candidate_id"), F.lit(True).alias("gone"))
    q = store.read("quotes").join(cands, "candidate_id", "left")
    return store.write("quotes", q.withColumn("review_status", F.when(F.col("gone"), "excluded").otherwise(F.col("review_status"))).drop("gone"))


def resolve_dates(store: Store, source: str, bodies: DataFrame, meta: str, dateline: str) -> DataFrame:
    """Days of documents that know only their month, from their pages; quotes follow (P29).  ``bodies``
    has document_id and body; the patterns have one group with an ISO date."""
    d = store.read("documents")
    found = bodies.select(F.col("document_id").alias("id"), pages.recovered_date(F.col("body"), meta, dateline).alias("found"))
    vague = (F.col("source") == source) & (F.col("date_precision") == "month") & F.col("found").isNotNull()
    told = store.write("documents", d.join(found, "id", "left").withColumn("doc_date", F.when(vague, F.col("found")).otherwise(F.col("doc_date"))).withColumn("date_precision", F.when(vague, "day").otherwise(F.col("date_precision"))).select(*d.columns))
    dates = joins.spine(store.read("candidates"), store.read("utterances"), told).where(F.col("source") == source).select(F.col("id").alias("candidate_id"), F.col("doc_date").alias("new_date"), F.col("date_precision").alias("new_precision"))
    q = store.read("quotes")
    store.write("quotes", q.join(dates, "candidate_id", "left").withColumn("date", F.coalesce("new_date", "date")).withColumn("date_precision", F.coalesce("new_precision", "date_precision")).select(*q.columns))
    return told


def resolve_citations(store: Store, source: str, candidates: Callable[[DataFrame], Column], known: DataFrame | None = None) -> DataFrame:
    """Where a reader verifies a document: the first candidate URL, or the first that ``known`` (url)
    has.  Candidates may depend on a document's ``rank`` among its siblings of one day (J15)."""
    d = store.read("documents")
    ranked = joins.sibling_rank(d.where(F.col("source") == source), ["source", "doc_date"], [F.col("native_id")])
    urls = ranked.select("id", F.posexplode(candidates(ranked)).alias("place", "cited"))
    if known is not None:
        urls = urls.join(known.select(F.col("url").alias("cited")).distinct(), "cited", "left_semi")
    first = urls.groupBy("id").agg(F.min_by("cited", "place").alias("cited"))
    return store.write("documents", d.join(first, "id", "left").withColumn("citation_url", F.coalesce("citation_url", "cited")).select(*d.columns))


def stats(store: Store) -> DataFrame:
    """The funnel."""
    return statistics.funnel({"documents": store.read("documents"), "utterances": store.read("utterances"), "candidates": store.read("candidates"), "adjudicated": store.read("adjudications").where("verdict is not null").select("candidate_id").distinct(), "quotes": store.read("quotes")})


def ablate(store: Store) -> DataFrame:
    """What each keyword adds."""
    quoted = store.read("quotes").select(F.col("candidate_id").alias("id"), F.lit(True).alias("quoted"))
    return keywords.ablation(store.read("candidates").join(quoted, "id", "left"), F.col("quoted"))


def validate_sample(store: Store, prompt: str, n: int, seed: int, judge: str = "primary", language: str | None = None) -> DataFrame:
    """A balanced sample to review, drawn once for (judge, seed); other draws stay."""
    spined = joins.spine(store.read("candidates"), store.read("utterances"), store.read("documents"))
    sha = F.sha2(F.lit(prompt), 256)
    log = store.read("adjudications").where(F.col("role") == judge).withColumn("prompt_sha256", F.when(F.col("prompt_sha256") == sha, prompt))
    pop = promotion.population(log, spined, prompt, language)
    drawn = sampling.balanced(pop, "candidate_id", "judge_accept", "jurisdiction", "year", n, seed)
    old = store.read("validation_samples")
    once = sampling.sample_once(drawn.withColumn("lang", F.lit(language).cast("string")), old, judge, seed)
    columns = [c.split()[0] for c in TABLES["validation_samples"].split(", ")]
    others = old.where((F.col("judge") != judge) | (F.col("seed") != seed))
    every = store.write("validation_samples", others.select(*columns).unionByName(once.select(*columns)))
    return every.where((F.col("judge") == judge) & (F.col("seed") == seed))


def validate_reset(store: Store, judge: str, seed: int, force: bool = False) -> DataFrame:
    """Drop a draw and its labels; labels only if forced."""
    here = (F.col("judge") == judge) & (F.col("seed") == seed)
    labels = store.read("validation_labels")
    sampling.reset(labels.where(here), force)
    store.write("validation_labels", labels.where(~here))
    return store.write("validation_samples", store.read("validation_samples").where(~here))


def validate_labels_sample(store: Store, n: int, seed: int, group: int = 4) -> DataFrame:
    """Pairs of quotes and labels to review, half risks and half policies (N08, N10), drawn once for a
    seed; other draws stay."""
    old = store.read("label_validation_samples")
    if not old.where(F.col("seed") == seed).isEmpty():
        return old.where(F.col("seed") == seed)
    best = verdicts.best_of(store.read("refinements").where("verdict is not null"), ["candidate_id"], F.col("id").desc())
    v = verdicts.parsed_refinement(F.col("verdict"))
    base = best.select("candidate_id", F.col("id").alias("refinement_id"), v.alias("v")).where("v is not null")
    base = base.join(store.read("quotes").select("candidate_id", "jurisdiction", F.coalesce(F.substring(F.col("date").cast("string"), 1, 4), F.lit("unknown")).alias("year")), "candidate_id")
    families = {"risk": ("risk_subdomains", RISK_SUBDOMAINS), "policy": ("policy_instruments", POLICY_INSTRUMENTS)}
    parts = []
    for i, (family, (field, vocabulary)) in enumerate(families.items()):
        own = promotion.applied_labels(F.col(f"v.{field}"), F.col("v.primary_topic"), vocabulary)
        pop = base.select("candidate_id", "refinement_id", "jurisdiction", "year", own.alias("own"))
        plan = sampling.label_plan(pop, "own", vocabulary, n // 2 + (i < n % 2), seed + i, group)
        parts.append(plan.join(pop.select("candidate_id", "refinement_id"), "candidate_id").withColumn("family", F.lit(family)))
    place = F.row_number().over(Window.orderBy(sampling.dice(F.concat_ws(":", "candidate_id", "family"), seed + 7), "candidate_id", "family", sampling.dice(F.col("label"), seed + 8)))
    columns = [c.split()[0] for c in TABLES["label_validation_samples"].split(", ")]
    new = parts[0].unionByName(parts[1]).withColumn("seed", F.lit(seed).cast("long")).withColumn("position", place).select(*columns)
    every = store.write("label_validation_samples", old.unionByName(new))
    return every.where(F.col("seed") == seed)


def validate_labels(store: Store, answers: DataFrame, seed: int) -> DataFrame:
    """Record a reviewer's answers (candidate_id, family, label, agreement, note); newer ones win, notes
    stay (N07)."""
    key = ["seed", "candidate_id", "family", "label"]
    told = sampling.labelled(store.read("label_validation_labels"), answers.withColumn("seed", F.lit(seed).cast("long")), key)
    sample = store.read("label_validation_samples").select(*key, "applied")
    out = told.join(sample, key, "left").withColumn("human_applies", sampling.human_accept(F.col("applied"), F.col("agreement"))).withColumn("labelled_at", F.current_timestamp())
    columns = [c.split()[0] for c in TABLES["label_validation_labels"].split(", ")]
    return store.write("label_validation_labels", out.select(*columns))


def validate_labels_report(store: Store, seed: int) -> DataFrame:
    """Rates of each family in a reviewed draw."""
    key = ["seed", "candidate_id", "family", "label"]
    rows = store.read("label_validation_samples").where(F.col("seed") == seed).join(store.read("label_validation_labels").select(*key, "agreement", "human_applies", "note"), key, "left")
    return statistics.family_rates(rows.join(store.read("quotes").select("candidate_id", "jurisdiction"), "candidate_id", "left"))


def validate_labels_reset(store: Store, seed: int, force: bool = False) -> DataFrame:
    labels = store.read("label_validation_labels")
    sampling.reset(labels.where(F.col("seed") == seed), force)
    store.write("label_validation_labels", labels.where(F.col("seed") != seed))
    return store.write("label_validation_samples", store.read("label_validation_samples").where(F.col("seed") != seed))


def validate_report(store: Store, judge: str, seed: int) -> DataFrame:
    """Confusion, precision and NPV of the labelled part of a sample."""
    here = (F.col("judge") == judge) & (F.col("seed") == seed)
    rows = store.read("validation_samples").where(here).join(store.read("validation_labels").where(here).select("candidate_id", "agreement"), "candidate_id", "left")
    return statistics.confusion(rows, F.col("judge_accept"), sampling.human_accept(F.col("judge_accept"), F.col("agreement")))


def rule_answers(words: dict[str, str]) -> Callable[[pd.DataFrame], pd.Series]:
    """An offline judge: topics by regular expressions, the first matching sentence as the span."""
    import re

    found = {k: re.compile(p, re.I) for k, p in words.items()}

    def judge(batch: pd.DataFrame) -> pd.Series:
        out = []
        for m in batch["message"]:
            text = m.split("\n\n", 1)[-1]
            hits = {k: p.search(text) for k, p in found.items()}
            first = min((h.start() for h in hits.values() if h), default=None)
            span = "" if first is None else next(s for s in re.findall(r"[^.!?]*[.!?]?", text[text.rfind(".", 0, first) + 1 :]) if s.strip()).strip()
            score = {t: 0 for t in ("ai", "agi", "asi", "rsi", "x_risk", "regulation")} | {k: 90 for k, h in hits.items() if h}
            out.append(json.dumps({"relevance": score, "rationale": "rule", "quote_span": span or text[:40], "is_substantive": first is not None, "speaker_owns_statement": True, "quote_type": "direct", "speaker_in_scope": True, "trigger_phrases": [h[0] for h in hits.values() if h], "stance": "neutral", "context_note": "rule"}))
        return pd.Series(out)

    return judge
