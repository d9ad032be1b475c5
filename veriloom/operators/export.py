"""What is published: display, language, provenance, filters, projections, files
(F13-F20, F31-F35, A06, A21, J16, O02, S18-S23)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.excerpt import excerpt, locate, locate_all
from ..functions.text import paragraphs, presentable, public_id, shard
from ..schemas import CJK_LANGUAGES, EXECUTIVE_SOURCES, MULTILINGUAL_TAGS, OFFICIAL_ENGLISH_SOURCES
from .speakers import clean_display

# Patterns of house styles that results depend on (fixed values).
REPORTED_QUESTION = r"(?i)^\s*(?:Mr|Ms|Mrs|Miss|Mdm|Dr|Prof|Assoc Prof|Er)\.?\s+[^,.]{1,60}?\s+asked\s+the\s+"
SPOKE_IN = r"\(\s*spoke in ([A-Za-z]+)"
PROVISION = r"^\s*(?:(?:SEC|Sec)\.\s*\d+\s*[.:]|Section\s+\d+\s*[.:]|Section\s+\d+\s+[A-Z]{2}|Article\s+\d+\s*[:.]|\(\d+\)\s+In general)"
PROVISION_CJK = r"^\s*第[一二三四五六七八九十百千零〇\d]+[条條]"
PRESIDING = r"(?i)^(?:The\s+)?(?:Presiding\s+Chair|Speaker\s+pro\s+tempore|Deputy\s+Speaker|Madam\s+Deputy\s+Speaker|Mr\.?\s+Speaker|The\s+Chair|Chairman|Voorzitter|Acting\s+President)\b"
REPORT_LANGUAGE = r"^\s*(?:The agreement provides|The Committee (?:recommends|directs|provides)|The bill provides|In lieu of the)"
ENDS_CLEANLY = r"[.!?\"')\]。！？」”’]\s*$"
SENTENCE_END = r"^([^.!?。！？]*[.!?。！？])"


def _matches(c: Column, pattern: str) -> Column:
    return F.coalesce(F.rlike(c, F.lit(pattern)), F.lit(False))


def not_verbatim(quote_type: Column, text: Column) -> Column:
    """Paraphrased or reported, or a question told in the third person."""
    return F.coalesce(quote_type.isin("official_paraphrase", "reported"), F.lit(False)) | _matches(text, REPORTED_QUESTION)


def english_original(text: Column, language: Column) -> Column:
    """Tagged English, or tagged CJK with ASCII letters only."""
    ascii_only = ~_matches(text, r"(?U)[\p{L}&&[^\x00-\x7F]]") & _matches(text, "[A-Za-z]")
    return F.coalesce((language == "en") | (language.isin(CJK_LANGUAGES) & ascii_only), F.lit(False))


def displayed(original: Column, english: Column, display: Column, display_en: Column, is_english: Column) -> tuple[Column, Column]:
    """(original, English) as shown: a refined display wins over the span."""
    nonempty = lambda c: F.when(c != "", c)
    has = F.coalesce(display != "", F.lit(False))
    shown = F.when(has, display).otherwise(original)
    own = F.when(has, F.coalesce(nonempty(display_en), display)).otherwise(F.coalesce(nonempty(english), original))
    return shown, F.when(is_english, shown).otherwise(own)


def display_language(is_english: Column, language: Column) -> Column:
    """en for English originals and for tags that name no language."""
    tag = F.coalesce(language, F.lit(""))
    return F.when(is_english | tag.isin(MULTILINGUAL_TAGS), "en").otherwise(tag)


def translation(language: Column, doc_language: Column, source: Column, speaker: Column, shown: Column, shown_en: Column, is_english: Column) -> Column:
    """How the English came to be: mt, raw, official, or null (F16)."""
    foreign = ~is_english & (F.coalesce(language, F.lit("en")) != "en")
    floor = F.lower(F.regexp_extract(F.coalesce(speaker, F.lit("")), SPOKE_IN, 1))
    untold = F.coalesce(language, F.lit("")).isin(MULTILINGUAL_TAGS)
    return (
        F.when(foreign & ~shown_en.eqNullSafe(shown), "mt")
        .when(foreign & ~untold, "raw")
        .when(foreign, F.lit(None).cast("string"))
        .when((doc_language == "en") & source.isin(OFFICIAL_ENGLISH_SOURCES), "official")
        .when((floor != "") & (floor != "english"), "official")
    )


def statutory(speaker: Column, jurisdiction: Column, source: Column, *texts: Column) -> Column:
    """Legal drafting under the name of someone who did not write it."""
    some = lambda pattern: F.exists(F.array(*texts), lambda t: _matches(t, pattern))
    drafted = some(PROVISION) | some(PROVISION_CJK)
    floor = (jurisdiction == "US") & ~F.coalesce(source, F.lit("")).isin(EXECUTIVE_SOURCES)
    return some(REPORT_LANGUAGE) | (drafted & (_matches(speaker, PRESIDING) | F.coalesce(floor, F.lit(False))))


def extended(display: Column, display_en: Column, record: Column, limit: int = 250) -> Column:
    """The shown text with its sentence finished from the record, if it was cut and the record has
    the end within ``limit``; else marked with [...] (F33)."""
    at = F.call_function("locate", display, record)
    tail = F.substr(record, at + F.length(display), F.lit(limit))
    rest = F.regexp_extract(tail, SENTENCE_END, 1)
    can = display_en.eqNullSafe(display) & (F.coalesce(at, F.lit(0)) > 0) & (rest != "")
    clean = _matches(display_en, ENDS_CLEANLY) | (F.coalesce(display_en, F.lit("")) == "")
    return F.when(clean, display).when(can, F.concat(display, rest)).otherwise(F.concat(display, F.lit(" [...]")))


def legislative_text(jurisdiction: Column, setting: Column, speaker: Column) -> Column:
    """Text of US bills and amendments, or a chamber as its author (F19); case does not count."""
    like = lambda c, p: F.coalesce(F.ilike(c, F.lit(p)), F.lit(False))
    amended = like(setting, "%text of%amendment%")
    chamber = like(speaker, "U.S. Senate%") | like(speaker, "U.S. Congress%") | like(speaker, "U.S. House%") | F.coalesce(speaker == "Congress", F.lit(False))
    return F.coalesce(jurisdiction == "US", F.lit(False)) & (amended | chamber)


def published(rows: DataFrame, excluded: DataFrame) -> DataFrame:
    """Neither excluded by status nor by source, no legislative text, and with a resolved speaker.
    ``rows`` has review_status, speaker_resolution, source, jurisdiction, speech_context, speaker_display."""
    drafted = legislative_text(F.col("jurisdiction"), F.col("speech_context"), F.col("speaker_display"))
    return rows.where("review_status <> 'excluded' and speaker_resolution = 'resolved'").where(~drafted).join(excluded.select("source"), "source", "left_anti")


def coarse_topics(judges: Column, agreed: Column, first_stage: Column) -> Column:
    """The refinement's topics if any judge voted, even none of them; else the first stage's."""
    return F.when(F.coalesce(judges, F.lit(0)) > 0, agreed).otherwise(F.coalesce(first_stage, F.array().cast("array<string>")))


def flat_scores(top: dict[str, Column], risk: dict[str, Column], regulation: dict[str, Column]) -> Column:
    """Scores other than zero as one map; sub-scores with x: and r: (F32)."""
    pairs = [(k, c) for k, c in top.items()] + [(f"x:{k}", c) for k, c in risk.items()] + [(f"r:{k}", c) for k, c in regulation.items()]
    m = F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[F.coalesce(c, F.lit(0)) for _, c in pairs]))
    return F.map_filter(m, lambda _, v: v != 0)


def compact(always: dict[str, Column], if_any: dict[str, Column]) -> Column:
    """A JSON record: the first fields even where null, the others only where they are neither null nor
    zero nor empty (F31)."""
    base = F.to_json(F.struct(*[c.alias(k) for k, c in always.items()]), {"ignoreNullFields": "false"})
    rest = F.to_json(F.struct(*[c.alias(k) for k, c in if_any.items()]))
    return F.when(rest == "{}", base).otherwise(F.concat(F.substr(base, F.lit(1), F.length(base) - 1), F.lit(","), F.substr(rest, F.lit(2), F.length(rest))))


def some(c: Column, kind: str = "string") -> Column:
    """Null where a value says nothing: empty texts and arrays, zeros."""
    return F.when(F.size(c) > 0, c) if kind == "array" else F.when(c != (0 if kind == "number" else ""), c)


def compact_row() -> Column:
    """The site's record of a published row, under its short keys.

    Reads id, date, jurisdiction, speaker, quote_original, quote_en, display_quote, display_quote_en,
    source_url, context, topics, stance, language, scores, refined (primary, risks, instruments,
    disputed), doc_language, source, speaker_as_recorded, extraction_method, quote_type, speaker_role,
    speaker_description, speaker_profile_url, speaker_image_url, utterance_len, citation_url and
    date_precision."""
    c = F.col
    is_en = english_original(c("quote_original"), c("language"))
    shown, shown_en = displayed(c("quote_original"), c("quote_en"), c("display_quote"), c("display_quote_en"), is_en)
    r = c("refined")
    refined = F.struct(some(r["primary"]).alias("p"), some(r["risks"], "array").alias("r"), some(r["instruments"], "array").alias("i"), some(r["disputed"], "array").alias("cd"))
    flag = lambda cond: F.when(F.coalesce(cond, F.lit(False)), 1)
    always = {
        "id": c("id"), "d": c("date").cast("string"), "j": c("jurisdiction"), "s": clean_display(c("speaker")), "q": shown_en, "u": c("source_url"), "c": c("context"),
        "t": c("topics"), "st": c("stance"), "l": display_language(is_en, c("language")), "sc": c("scores"),
    }
    if_any = {
        "o": F.when((shown != "") & ~shown.eqNullSafe(shown_en), shown),
        "rt": F.when(r.isNotNull() & (F.to_json(refined) != "{}"), refined),
        "tr": translation(c("language"), c("doc_language"), c("source"), c("speaker_as_recorded"), shown, shown_en, is_en),
        "asr": flag(c("extraction_method") == "asr"),
        "nv": flag(not_verbatim(c("quote_type"), shown_en)),
        "r": F.when(~c("speaker_role").isin("", "institutional", "member"), c("speaker_role")),
        "sd": some(c("speaker_description")), "sl": some(c("speaker_profile_url")), "si": some(c("speaker_image_url")),
        "ul": some(c("utterance_len"), "number"), "cu": some(c("citation_url")),
        "dp": F.when(F.coalesce("date_precision", F.lit("day")) != "day", c("date_precision")),
    }
    return compact(always, if_any)


def duplicate_ids(rows: DataFrame, key: str) -> DataFrame:
    """Identifiers that occur more than once."""
    return rows.groupBy(key).count().where("count > 1")


def coverage_end(ledger: DataFrame, today: Column) -> DataFrame:
    """The last day covered, no later than today; null if none."""
    return ledger.where("status = 'done'").agg(F.least(F.max("window_end"), F.max(today)).alias("coverage_end"))


def sidecar(rows: DataFrame, public: str, shards: int = 8) -> DataFrame:
    """A file's worth of records for each shard; shards without records are there too."""
    held = rows.withColumn("shard", shard(F.col(public), shards)).groupBy("shard").agg(F.count(F.lit(1)).alias("n_records"), F.min(public).alias("first_id"), F.max(public).alias("last_id"))
    every = rows.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    return every.join(held, "shard", "left").withColumn("n_records", F.coalesce("n_records", F.lit(0)))


#: A record is kept if it has so many characters more than the quote.
MIN_EXTRA = 200


def sidecar_records(rows: DataFrame, records: DataFrame) -> DataFrame:
    """id and the JSON record of the remarks round each published quote, joined by the public id that is
    computed anew from where and what (J16).  ``rows`` has id, display_quote and quote_original;
    ``records`` source_url, quote_original, text, language and speech_context."""
    key = public_id(F.col("source_url"), presentable(F.col("quote_original")))
    one = records.select(key.alias("id"), F.struct("text", "language", "speech_context").alias("r")).groupBy("id").agg(F.max("r").alias("r"))
    base = rows.select("id", presentable(F.col("display_quote")).alias("display"), F.col("quote_original").alias("original")).join(one, "id")
    base = base.withColumn("t", paragraphs(F.col("r.text"))).where("t <> ''")
    by_span = locate(F.col("t"), presentable(F.col("original")))
    base = base.withColumn("spans", F.coalesce(locate_all(F.col("t"), F.col("display")), F.when(by_span.isNotNull(), F.array(by_span))))
    base = base.withColumn("e", excerpt(F.col("t"), F.col("spans")))
    told = F.coalesce(some(F.col("display")), F.col("original"), F.lit(""))
    kept = base.where(F.length("e.text") - F.length(told) >= MIN_EXTRA)
    pair = lambda s: F.array(s["start"], s["end"])
    spans = F.col("e.spans")
    whole = F.when(F.size(spans) > 0, F.array(F.element_at(spans, 1)["start"], F.element_at(spans, -1)["end"]))
    record = compact(
        {"t": F.col("e.text")},
        {"s": whole, "ss": F.when(F.size(spans) > 1, F.transform(spans, pair)), "l": some(F.col("r.language")), "x": F.when(F.col("e.truncated"), 1), "sc": some(presentable(F.col("r.speech_context")))},
    )
    return kept.select("id", record.alias("record"))


def payload_order(rows: DataFrame) -> DataFrame:
    """Newest first, then by id downwards; rows without a date last."""
    return rows.orderBy(F.coalesce(F.col("date").cast("string"), F.lit("")).desc(), F.col("id").desc())


def csv_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The named fields, arrays and structs as JSON."""
    kinds = dict(rows.dtypes)
    return rows.select(*[F.to_json(F.col(c)).alias(c) if kinds[c].startswith(("array", "map", "struct")) else F.col(c) for c in fields])


FLAT_FIELDS = ["id", "speaker", "date", "jurisdiction", "body", "language", "quote_original", "quote_en", "display_quote", "display_quote_en", "concepts", "topics_refined", "stance", "quote_type", "review_status", "extraction_method", "source_url", "context"]
COMPAT_FIELDS = ["speaker", "quote_html", "source_url", "context", "date"]


def json_text(rows: DataFrame, head: str, foot: str, *order: Column) -> DataFrame:
    """Lines of one JSON text: head, the ``line`` of each row, foot, with commas between rows.  Written
    as text the files make the JSON in the order of their names; no task holds it whole."""
    spark = rows.sparkSession
    numbered = rows.withColumn("o", F.struct(*[c for c in order])).select("line", "o")
    first = numbered.agg(F.min_by("line", "o").alias("line"), F.min("o").alias("o"))
    rest = numbered.join(first.select("o"), "o", "left_anti").select(F.lit(2).alias("k"), "o", F.concat(F.lit(","), "line").alias("line"))
    ends = spark.createDataFrame([(0, head), (3, foot)], "k int, line string").withColumn("o", F.lit(None).cast(dict(numbered.dtypes)["o"]))
    body = first.where("line is not null").select(F.lit(1).alias("k"), "o", "line").unionByName(rest)
    return body.unionByName(ends).orderBy("k", "o").select("line")


def write_sidecar(records: DataFrame, path: str, version: str, generated: str, shards: int = 8) -> None:
    """A folder of text for each shard, all of them always: {v, generated, n, i, u: {id: record}}."""
    pair = F.concat(F.to_json(F.struct(F.col("id").alias("k"))), F.lit("")).substr(F.lit(6), F.length("id") + 2)
    lines = records.select("id", shard(F.col("id"), shards).alias("shard"), F.concat(pair, F.lit(":"), "record").alias("line"))
    for i in range(shards):  # eight files by format
        head = json.dumps({"v": version, "generated": generated, "n": shards, "i": i})[:-1] + ', "u": {'
        json_text(lines.where(F.col("shard") == i), head, "}}", F.col("id")).write.mode("overwrite").text(f"{path}/utterances-{i}")


def write_payload(rows: DataFrame, path: str, version: str, generated: str, collected: str | None = None) -> None:
    """All the files of an export of full rows: JSON array, CSV and Parquet of the flat fields, the
    five-column CSV, and the site's envelope {v, generated, collected, rows} of compact rows (S18-S22)."""
    ordered = (F.coalesce(F.col("date").cast("string"), F.lit("")), F.col("id"))
    newest = lambda df: json_text_down(df, ordered)
    newest(rows.withColumn("line", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})))("[", "]").write.mode("overwrite").text(f"{path}/quotes.json")
    flat = payload_order(csv_fields(rows, FLAT_FIELDS))
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/quotes.csv")
    flat.write.mode("overwrite").parquet(f"{path}/quotes.parquet")
    payload_order(rows).select(*COMPAT_FIELDS).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/quotes_compat.csv")
    top = {"v": version, "generated": generated} | ({"collected": collected} if collected else {})
    newest(rows.withColumn("line", compact_row()))(json.dumps(top)[:-1] + ', "rows": [', "]}").write.mode("overwrite").text(f"{path}/site/quotes-data.json")


def json_text_down(rows: DataFrame, order: tuple[Column, ...]):
    """json_text in falling order of texts: by the complement of their bytes."""
    down = [F.concat(F.translate(F.hex(F.encode(c, "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~")) for c in order]
    return lambda head, foot: json_text(rows, head, foot, *down)
