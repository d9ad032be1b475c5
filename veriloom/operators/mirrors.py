"""Copies of one statement become one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grams
from ..functions.excerpt import let
from ..storage import written
from .components import connected

CONTAINED = 120


def key_links(rows: DataFrame, row_id: str, keys: list[list[Column]]) -> DataFrame:
    """Links a-b of rows that share a key: each row to the smallest of its key, so a key of n rows
    has n links, not n squared.  A key with a null part links nothing."""

    def star(parts: list[Column]) -> DataFrame:
        named = rows.select(F.col(row_id).alias("b"), *[p.alias(f"k{i}") for i, p in enumerate(parts)]).dropna()
        ks = [f"k{i}" for i in range(len(parts))]
        low = named.groupBy(*ks).agg(F.min("b").alias("a"))
        return named.join(low, ks).select("a", "b").where("a <> b")

    return reduce(DataFrame.unionByName, map(star, keys)).distinct()


def containment_links(rows: DataFrame, row_id: str, group: list[str], text: str, shortest: int = CONTAINED) -> DataFrame:
    """Links that join each text to the longer texts of its group that contain it, and to its copies.

    Copies collapse first: a link stands between the smallest rows of two texts, and a copy is linked
    to the smallest of its text, so n copies have n links.  Candidates share (group, key): every text
    offers the smallest gram of each of its windows of ``shortest`` characters, a text asks for its
    smallest gram (``functions.grams``); no script needs blanks, and no group is compared as a whole.
    A null in the group or the text links nothing.  ``shortest`` is at least ``grams.SHORTEST``."""
    if shortest < grams.SHORTEST:
        raise ValueError(f"texts under {grams.SHORTEST} characters need not share a gram with what contains them")
    base = rows.select(F.col(row_id).alias("id"), *group, F.col(text).alias("t")).where(F.length("t") >= shortest).dropna(subset=group)
    print_ = base.select("id", *group, F.sha2("t", 256).alias("h"))
    low = print_.groupBy(*group, "h").agg(F.min("id").alias("a"))
    copies = print_.join(written(low, "texts"), [*group, "h"]).where("id <> a").select("a", F.col("id").alias("b"))
    one = written(base.join(low.select(F.col("a").alias("id")), "id", "left_semi"), "texts")
    asks = one.select(F.col("id").alias("b"), *group, F.length("t").alias("n_b"), grams.probe("t").alias("key"))
    offers = one.select(F.col("id").alias("a"), *group, F.length("t").alias("n_a"), F.explode(grams.offers("t")).alias("key"))
    found = asks.join(offers, [*group, "key"]).where("n_a > n_b").select("a", "b")
    texts = lambda name, t: one.select(F.col("id").alias(name), F.col("t").alias(t))
    held = found.join(texts("b", "short"), "b").join(texts("a", "long"), "a").where(F.contains("long", F.col("short")))
    return held.select("a", "b").unionByName(copies)


def containment_pairs(rows: DataFrame, row_id: str, group: list[str], text: str, shortest: int = CONTAINED) -> DataFrame:
    """Every pair (a, b) of rows where the text of a contains that of b, copies by smaller row (J11);
    as many rows as there are pairs."""
    links = written(containment_links(rows, row_id, group, text, shortest), "links")
    base = rows.select(F.col(row_id).alias("id"), *group, F.col(text).alias("t")).where(F.length("t") >= shortest).dropna(subset=group)
    linked = base.join(links.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi")
    copies = linked.select("id", *group, F.sha2("t", 256).alias("h"))
    low = copies.groupBy(*group, "h").agg(F.min("id").alias("low"))
    named = written(copies.join(low, [*group, "h"]).select("id", "low"), "copies")
    of = lambda name: named.select(F.col("id").alias(name), F.col("low").alias(f"low_{name}"))
    heads = links.join(named.where("id = low").select(F.col("low").alias("b")), "b", "left_semi")
    held = heads.select(F.col("a").alias("low_a"), F.col("b").alias("low_b")).join(of("a"), "low_a").join(of("b"), "low_b").select("a", "b")
    same = of("a").join(of("b"), F.col("low_a") == F.col("low_b")).where("a < b").select("a", "b")
    return held.unionByName(same)


def collapsed(rows: DataFrame, row_id: str, links: DataFrame, rank: list[Column], mirror: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """One row of each component, the first by ``rank`` and id, with ``n_mirrors``; and what the others
    were: a row for each, with the survivor's id, its place and the ``mirror`` columns.

    The first of a component is a minimum, which combines before its shuffle, so no task holds all
    copies of a statement."""
    roots = connected(links).select(F.col("node").alias(row_id), "root")
    place = F.struct(*[c.alias(f"r{i}") for i, c in enumerate(rank)], F.col(row_id).alias("id"))
    members = written(rows.join(roots, row_id).select(F.col(row_id).alias("member"), "root", place.alias("place"), *[c.alias(f"m_{k}") for k, c in mirror.items()]), "members")
    best = written(members.groupBy("root").agg(F.min("place")["id"].alias("survivor"), (F.count(F.lit(1)) - 1).cast("int").alias("n_mirrors")), "survivors")
    others = members.join(best.select("root", "survivor"), "root").where("member <> survivor")
    child = others.select("survivor", "place", *[F.col(f"m_{k}").alias(k) for k in mirror])
    counted = best.select(F.col("survivor").alias(row_id), "n_mirrors")
    gone = others.select(F.col("member").alias(row_id))
    kept = rows.join(gone, row_id, "left_anti").join(counted, row_id, "left").withColumn("n_mirrors", F.coalesce("n_mirrors", F.lit(0)))
    return kept, child


def with_mirrors(kept: DataFrame, row_id: str, child: DataFrame) -> DataFrame:
    """The survivors with an array of their mirrors in rank order, as a payload shows them."""
    fields = [c for c in child.columns if c not in ("survivor", "place")]
    lists = child.groupBy(F.col("survivor").alias(row_id)).agg(F.sort_array(F.collect_list(F.struct("place", *fields))).alias("m"))
    shown = F.transform("m", lambda x: F.struct(*[x[k].alias(k) for k in fields]))
    return kept.join(lists.select(row_id, shown.alias("mirrors")), row_id, "left").withColumn("mirrors", F.coalesce("mirrors", F.array()))


def once(values: Column) -> Column:
    """An array of structs without repeats, the first of each in its place: what array_distinct returns, which
    compares structs each with each.  Here they are sorted, with their places, and compared with the one before."""
    placed = F.sort_array(F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    firsts = let(placed, lambda p: F.filter(p, lambda x, k: (k == 0) | ~x["v"].eqNullSafe(F.get(p, k - 1)["v"])))
    return F.transform(F.sort_array(F.transform(firsts, lambda x: F.struct(x["i"].alias("i"), x["v"].alias("v")))), lambda x: x["v"])


def survivor_rank(text: Column, precision: Column, date: Column, source: Column) -> list[Column]:
    """Longest text, real day, earliest date, then source (W06): the smallest comes first."""
    return [-F.length(F.coalesce(text, F.lit(""))), F.when(F.coalesce(precision, F.lit("day")) == "day", 0).otherwise(1), F.coalesce(date.cast("string"), F.lit("9999-99-99")), F.coalesce(source, F.lit(""))]
