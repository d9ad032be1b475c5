"""Documents to utterances: turns, islands, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import squeeze


def turns(docs: DataFrame, text: str, header: str, key: str) -> DataFrame:
    """Split at speaker headers (a regular expression with one group): key, seq, speaker, body.
    Text before the first header belongs to nobody; without headers the text is one turn (P01)."""
    heads = F.regexp_extract_all(F.col(text), F.lit(header), F.lit(1))
    bodies = F.split(F.col(text), header, -1)
    pairs = F.when(F.size(heads) == 0, F.array(F.struct(F.lit(None).cast("string").alias("speaker"), F.col(text).alias("body")))).otherwise(
        F.zip_with(F.concat(F.array(F.lit(None).cast("string")), heads), bodies, lambda h, b: F.struct(h.alias("speaker"), b.alias("body")))
    )
    rows = docs.select(key, F.posexplode(pairs).alias("seq", "turn")).select(key, "seq", F.col("turn.speaker"), F.trim(F.col("turn.body")).alias("body"))
    return rows.where("body <> ''")


def merged_turns(rows: DataFrame, key: str, order: str, who: list[str], text: str, glue: str = "\n") -> DataFrame:
    """Neighbouring rows of one speaker become one turn (P03, P04, W10): change flags, running sum."""
    w = Window.partitionBy(key).orderBy(order)
    change = F.lit(False)
    for c in who:
        change = change | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    flag = F.when(F.row_number().over(w) == 1, F.lit(1)).otherwise(change.cast("int"))
    island = F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = rows.withColumn("new", flag).withColumn("island", island)
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return marked.groupBy(key, "island").agg(*[F.first(c).alias(c) for c in who], F.min(order).alias("first_seq"), F.count(F.lit(1)).alias("n_rows"), F.array_join(F.transform(parts, lambda p: p["t"]), glue).alias(text))


def continues_previous(rows: DataFrame, key: str, order: str, who: str, text: str) -> DataFrame:
    """A row that starts in lower case under another label than the last known one."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(who, ignorenulls=True).over(before)
    first = F.substring(F.col(text), 1, 1)
    lower = (F.lower(first) == first) & (F.upper(first) != first)
    return rows.withColumn("continues", F.coalesce(lower & last.isNotNull() & ~F.col(who).eqNullSafe(last), F.lit(False)))


def holding_floor(rows: DataFrame, key: str, order: str, who: Column, lead: Column) -> DataFrame:
    """Paragraphs while the lead speaker holds the floor; others' interjections go."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("holder", F.last(who, ignorenulls=True).over(w)).where(F.col("holder") == lead).drop("holder")


def carried(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The last known value of a column in document order."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(value, F.last(value, ignorenulls=True).over(w))


def without_blocks(rows: DataFrame, key: str, order: str, opens: Column, tail: Column) -> DataFrame:
    """Lines without blocks that an opening line starts and tail lines carry on."""
    w = Window.partitionBy(key).orderBy(order)
    state = F.when(opens, F.lit(1)).when(~tail, F.lit(0))
    marked = rows.withColumn("state", F.last(state, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return marked.where(F.coalesce(F.col("state"), F.lit(0)) == 0).drop("state")


def reflowed(text: Column) -> Column:
    """Paragraphs of wrapped prose; lines of digits only go."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda s: ~F.rlike(s, F.lit(r"^\s*\d+\s*$")))
    paras = F.transform(F.split(F.array_join(lines, "\n"), r"\n\s*\n"), squeeze)
    return F.array_join(F.filter(paras, lambda p: p != ""), "\n\n")


def chunks(paragraphs: Column, longest: int = 6000) -> Column:
    """Paragraphs in greedy chunks of about ``longest`` characters."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, p: Column) -> Column:
        full = (acc["open"] != "") & (F.length(acc["open"]) + F.length(p) > longest)
        done = F.when(full, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])
        open_ = F.when(full | (acc["open"] == ""), p).otherwise(F.concat(acc["open"], F.lit("\n"), p))
        return F.struct(done.alias("done"), open_.alias("open"))

    return F.aggregate(paragraphs, start, step, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))


def leaves(rows: DataFrame, key: str, frag: str, text: str, speaker: str) -> DataFrame:
    """Fragments that hold no shorter fragment's text; of equal texts the attributed one."""
    w = Window.partitionBy(key, text).orderBy(F.col(speaker).isNull(), frag)
    one = rows.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    inner = one.select(F.col(key).alias("leaf_key"), F.col(frag).alias("leaf_frag"), F.col(text).alias("leaf_text"))
    parents = one.join(inner, (F.col(key) == F.col("leaf_key")) & (F.col(frag) != F.col("leaf_frag")) & (F.length(text) > F.length("leaf_text")) & (F.col("leaf_text") != "") & F.contains(F.col(text), F.col("leaf_text")), "left_semi")
    return one.join(parents.select(key, frag), [key, frag], "left_anti")
