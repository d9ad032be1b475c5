"""Who said it: alias cascade, registries, resolution, names and groups (J03, J08-J10, J18-J20,
F12, F21, F22, F36-F40, V16)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folding import name_fold
from ..functions.text import content_key, squeeze
from ..schemas import INTERNATIONAL_SOURCES, SOURCE_PREFIXES

UNIDENTIFIED_ROLES = ["unknown", "unspecified", "unidentified speaker", "institutional/procedural"]
# Words of a trailing note, or of a role, that mark an attribution as doubtful.
DOUBT = ["ambiguous", "best-effort", "best effort", "identity unclear", "unidentified", "unnamed", "procedural"]


def jurisdiction(source: Column) -> Column:
    """By the source's prefix; international bodies by name; XX if unknown."""
    m = F.create_map(*[F.lit(x) for x in chain(*SOURCE_PREFIXES.items())])
    out = F.coalesce(F.try_element_at(m, F.split_part(source, F.lit("_"), F.lit(1))), F.lit("XX"))
    for name, place in INTERNATIONAL_SOURCES.items():
        out = F.when(source == name, place).otherwise(out)
    return F.when(F.contains(source, F.lit("_")), out).otherwise("XX")


def alias_map(aliases: DataFrame, by: str = "load_order") -> DataFrame:
    """jurisdiction, label -> speaker_id; the first registration of a label wins."""
    w = Window.partitionBy("jurisdiction", "label").orderBy(by, "speaker_id")
    return aliases.withColumn("r", F.row_number().over(w)).where("r = 1").select("jurisdiction", "label", "speaker_id")


def linked(quotes: DataFrame, aliases: DataFrame, native: DataFrame, names: DataFrame, minted: bool = True) -> DataFrame:
    """quotes with speaker_id and how it was found (J08): exact alias, squeezed alias, native id,
    exact canonical name, else a minted id for an unseen native id, else unlinked.

    A native id that an alias match claims first belongs to that speaker.  ``quotes`` has quote_id,
    speaker_display, jurisdiction, source, native_id; ``aliases`` jurisdiction, label, speaker_id;
    ``native`` source, native_id, speaker_id; ``names`` jurisdiction, canonical_name, speaker_id."""
    exact = aliases.select("jurisdiction", F.col("label").alias("speaker_display"), F.col("speaker_id").alias("by_exact"))
    loose = aliases.select("jurisdiction", squeeze(F.col("label")).alias("squeezed"), "speaker_id").groupBy("jurisdiction", "squeezed").agg(F.min("speaker_id").alias("by_squeezed"))
    one_name = names.groupBy("jurisdiction", F.col("canonical_name").alias("speaker_display")).agg(F.min("speaker_id").alias("by_name"))
    rows = quotes.withColumn("squeezed", squeeze(F.col("speaker_display"))).join(exact, ["jurisdiction", "speaker_display"], "left").join(loose, ["jurisdiction", "squeezed"], "left")
    first = rows.withColumn("by_alias", F.coalesce("by_exact", "by_squeezed"))
    claimed = first.where("by_alias is not null and native_id is not null").groupBy("source", "native_id").agg(F.min_by("by_alias", "quote_id").alias("claimed"))
    registered = native.groupBy("source", "native_id").agg(F.min("speaker_id").alias("registered"))
    rows = first.join(registered, ["source", "native_id"], "left").join(claimed, ["source", "native_id"], "left").withColumn("by_native", F.coalesce("registered", "claimed")).join(one_name, ["jurisdiction", "speaker_display"], "left")
    mint = F.when(F.col("native_id").isNotNull() & F.lit(minted), F.substring(content_key(F.col("source"), F.col("native_id")), 1, 16))
    how = F.when(F.col("by_exact").isNotNull(), "alias").when(F.col("by_squeezed").isNotNull(), "squeezed").when(F.col("by_native").isNotNull(), "native").when(F.col("by_name").isNotNull(), "name").when(mint.isNotNull(), "minted").otherwise("unlinked")
    return rows.select(*[c for c in quotes.columns if c != "speaker_id"], F.coalesce(F.col("by_alias").cast("string"), F.col("by_native").cast("string"), F.col("by_name").cast("string"), mint).alias("speaker_id"), how.alias("linked_by"))


def canonical_names(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """The registered name of (jurisdiction, squeezed label), null if unknown."""
    known = aliases.groupBy("jurisdiction", squeeze(F.col("label")).alias("squeezed")).agg(F.min_by("canonical_name", "load_order").alias("canonical_name"))
    return rows.withColumn("squeezed", squeeze(F.col("speaker_display"))).join(known, ["jurisdiction", "squeezed"], "left").drop("squeezed")


def first_roles(roles: DataFrame) -> DataFrame:
    """The first role other than member, and the first party, of each speaker."""
    return roles.groupBy("speaker_id").agg(
        F.min_by(F.col("role"), F.when((F.col("role") != "member"), F.col("id"))).alias("role"),
        F.min_by(F.col("party"), F.when(F.col("party").isNotNull(), F.col("id"))).alias("party"),
    )


def enriched(speakers: DataFrame, more: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values filled from another source, present ones kept."""
    other = more.select("speaker_id", *[F.col(c).alias(f"new_{c}") for c in columns])
    out = speakers.join(other, "speaker_id", "left")
    return out.select(*[F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"new_{c}")).alias(c) if c in columns else F.col(c) for c in speakers.columns])


def referenced(dimension: DataFrame, quotes: DataFrame) -> DataFrame:
    """Rows of a dimension that some quote names."""
    return dimension.join(quotes.select("speaker_id"), "speaker_id", "left_semi")


def _doubtful(c: Column) -> Column:
    return F.rlike(c, F.lit("(?i)" + "|".join(DOUBT)))


def _note(display: Column) -> Column:
    return F.regexp_extract(display, r"\s*\(([^()]*)\)\s*$", 1)


def clean_display(display: Column) -> Column:
    """Without a trailing note of doubt."""
    d = F.coalesce(display, F.lit(""))
    return F.trim(F.when(_doubtful(_note(d)), F.regexp_replace(d, r"\s*\([^()]*\)\s*$", "")).otherwise(d))


def resolution(display: Column, role: Column) -> Column:
    """resolved, ambiguous or unidentified."""
    name, role = F.trim(F.coalesce(display, F.lit(""))), F.trim(F.coalesce(role, F.lit("")))
    return (
        F.when((name == "") | (F.lower(name) == "unknown") | F.lower(role).isin(UNIDENTIFIED_ROLES), "unidentified")
        .when(_doubtful(_note(name)), F.when(clean_display(name) == "", "unidentified").otherwise("ambiguous"))
        .when((role != "") & _doubtful(role), "ambiguous")
        .otherwise("resolved")
    )


def same_person(a: Column, b: Column) -> Column:
    """One name's folded words contain the other's (F40); trailing parentheses do not count."""
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"\s*[（(][^)）]*[)）]\s*$", "")
    words = lambda c: F.filter(F.split(name_fold(bare(c)), " "), lambda w: w != "")
    x, y = words(a), words(b)
    return (F.size(x) > 0) & (F.size(y) > 0) & ((F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0))


def group_label(label: Column, variants: dict[str, str]) -> Column:
    """The canonical label of a political group's variant, else the label itself."""
    m = F.create_map(*[F.lit(x) for k, v in variants.items() for x in (k.lower(), v)])
    return F.coalesce(F.try_element_at(m, F.lower(F.trim(label))), label)


def groups_rewritten(text: Column, variants: dict[str, str]) -> Column:
    """Variants in prose become canonical, longest first."""
    for k in sorted(variants, key=lambda k: (-len(k), k)):
        text = F.regexp_replace(text, rf"(?U)(?<!\w)\Q{k}\E(?!\w)", variants[k].replace("$", r"\$"))
    return text


def groups_named(text: Column, variants: dict[str, str]) -> Column:
    """The set of canonical labels that a text names."""
    m = F.create_map(*[F.lit(x) for kv in variants.items() for x in kv])
    pattern = r"(?U)(?<!\w)(" + "|".join(rf"\Q{k}\E" for k in sorted(variants, key=lambda k: (-len(k), k))) + r")(?!\w)"
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda k: m[k])))


def profile_url(native_id: Column, template: str, pattern: str = ".+") -> Column:
    """A URL made from a native id that fits a pattern, else null."""
    return F.when(F.rlike(native_id, F.lit(f"^(?:{pattern})$")), F.replace(F.lit(template), F.lit("{id}"), native_id))
