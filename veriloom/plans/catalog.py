"""Registered queries of the statement pipeline on the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import excerpt, folding, text
from ..functions.numbers import wilson
from ..operators import export, joins, keywords, mirrors, sampling, segments, speakers, statistics, verdicts
from ..operators.keywords import TermList
from ..sources import ledger, pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: Demonstration terms; real lists are read from a folder (keywords.read_lists).
TERMS = [TermList("en", ("pathetic", "worthless", "disgust*", "idiot", "clown", "scum")), TermList("de", ("ungsge", "keitsch"), False), TermList("fr", ("eauché", "ouion"), False), TermList("es", ("ciónes", "mentedo"), False)]


def _scanned(spark: SparkSession, d: str) -> DataFrame:
    return keywords.scanned(t(spark, d, "documents"), "text", "lang", TERMS)


_HITS = """
    WITH terms(lang, keyword, pat) AS (VALUES
        ('en','pathetic','(?i)\\bpathetic\\b'), ('en','worthless','(?i)\\bworthless\\b'), ('en','disgust*','(?i)\\bdisgust\\w*'), ('en','idiot','(?i)\\bidiot\\b'), ('en','clown','(?i)\\bclown\\b'), ('en','scum','(?i)\\bscum\\b'),
        ('de','ungsge','ungsge'), ('de','keitsch','keitsch'), ('fr','eauché','eauché'), ('fr','ouion','ouion'), ('es','ciónes','ciónes'), ('es','mentedo','mentedo')),
    hits AS (SELECT doc_id, keyword, pat, text FROM documents JOIN terms USING (lang) WHERE regexp_matches(coalesce(text, ''), pat))
"""


@query(
    _HITS
    + """, per AS (SELECT doc_id, list_distinct(list(keyword)) AS ks FROM hits GROUP BY doc_id),
    e AS (SELECT doc_id, unnest(ks) AS keyword, len(ks) = 1 AS alone FROM per)
    SELECT keyword, count(*) AS n_candidates, count(*) FILTER (alone) AS n_unique, count(*) FILTER (alone AND quality = 1) AS n_unique_accepted
    FROM e LEFT JOIN labels USING (doc_id) GROUP BY keyword"""
)
def keyword_ablation(spark, d):
    """A07 over F02: candidates, unique candidates and accepted ones of each keyword."""
    rows = _scanned(spark, d).select("doc_id", "matches").join(t(spark, d, "labels"), "doc_id", "left")
    return keywords.ablation(rows, F.col("quality") == 1)


@query(
    _HITS
    + """, s AS (SELECT doc_id, keyword, regexp_split_to_array(text, pat) AS gaps, regexp_extract_all(text, pat) AS ms FROM hits),
    n AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM s)
    SELECT doc_id, keyword, (coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0))::INTEGER AS "start",
           (coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + list_sum(list_transform(ms[1:i], lambda x: length(x))))::INTEGER AS "end" FROM n"""
)
def keyword_match_offsets(spark, d):
    """Every match with code-point offsets."""
    return _scanned(spark, d).select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.keyword", "m.start", "m.end")


@query(
    """WITH k AS (SELECT substr(sha256(replace(lower(regexp_replace(text, '[\\s\\x{A0}\\x{3000}]+', '', 'g')), 'ß', 'ss')), 1, 32) AS statement_key FROM documents WHERE regexp_matches(text, '\\S'))
    SELECT statement_key, count(*) AS count FROM k GROUP BY 1 HAVING count(*) > 1"""
)
def statement_key_dups(spark, d):
    """Statement keys that several documents have."""
    keyed = t(spark, d, "documents").select(folding.statement_key("text").alias("statement_key")).where("statement_key is not null")
    return export.duplicate_ids(keyed, "statement_key")


@query(
    """WITH k AS (SELECT doc_id, source, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS k, length(coalesce(text, '')) AS n FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, source, doc_id) AS place, count(*) OVER (PARTITION BY k) AS size FROM k)
    SELECT doc_id, source, (size - 1)::INTEGER AS n_mirrors FROM r WHERE place = 1"""
)
def exact_mirror_collapse(spark, d):
    """A22, W06 with key links only: one row of each statement, and how many mirrors it has."""
    rows = t(spark, d, "documents").withColumn("k", text.squeeze(F.coalesce("text", F.lit(""))))
    links = mirrors.key_links(rows, "doc_id", [[F.col("k")]])
    kept, _ = mirrors.collapsed(rows.drop("k"), "doc_id", links, mirrors.survivor_rank(F.col("text"), F.lit("day"), F.lit(None), F.col("source")), {"source": F.col("source")})
    return kept.select("doc_id", "source", "n_mirrors")


@query(
    """WITH b AS (SELECT doc_id, lang, source, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS t FROM documents)
    SELECT l.doc_id AS a, s.doc_id AS b FROM b s JOIN b l ON s.lang = l.lang AND s.source = l.source AND s.doc_id <> l.doc_id
    AND length(s.t) >= 120 AND contains(l.t, s.t) AND (length(l.t) > length(s.t) OR l.doc_id < s.doc_id)"""
)
def containment_pairs(spark, d):
    """Texts contained in longer ones of the same group."""
    rows = t(spark, d, "documents").withColumn("t", text.squeeze(F.coalesce("text", F.lit(""))))
    return mirrors.containment_pairs(rows, "doc_id", ["lang", "source"], "t")


@query(
    """WITH f AS (SELECT *, CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id) THEN 1 WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS new FROM conversations),
    i AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM f)
    SELECT conv_id, island::BIGINT AS island, any_value(role) AS role, min(turn) AS first_seq, count(*) AS n_rows, string_agg(text, chr(10) ORDER BY turn) AS text FROM i GROUP BY conv_id, island"""
)
def merge_consecutive_turns(spark, d):
    """Neighbouring turns of one role become one."""
    return segments.merged_turns(t(spark, d, "conversations"), "conv_id", "turn", ["role"], "text")


@query(
    """WITH x AS (SELECT conv_id, turn, role, substr(text, 1, 1) AS c, last_value(role IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM conversations)
    SELECT conv_id, turn, coalesce(lower(c) = c AND upper(c) <> c AND p IS NOT NULL AND role IS DISTINCT FROM p, false) AS continues FROM x"""
)
def continues_previous(spark, d):
    """Turns that carry on another's sentence."""
    return segments.continues_previous(t(spark, d, "conversations"), "conv_id", "turn", "role", "text").select("conv_id", "turn", "continues")


@query(
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_orderpriority, o_orderdate DESC, o_orderkey DESC) r FROM orders) WHERE r = 1"""
)
def best_version_per_key(spark, d):
    """The best of each key in a total order."""
    best = verdicts.best_of(t(spark, d, "orders"), ["o_custkey"], (F.col("o_orderstatus") == "F").desc(), F.col("o_orderpriority"), F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    return best.select("o_custkey", "o_orderkey", "o_orderpriority")


@query(
    """WITH s AS (SELECT d.doc_id, d.doc_id % 11 AS agi, d.doc_id % 7 AS asi, d.doc_id % 9 AS rsi, d.n_chars % 101 AS x_risk, (d.n_chars // 7) % 101 AS regulation, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)),
    t AS (SELECT *, list_filter([CASE WHEN agi >= 5 THEN 'agi' END, CASE WHEN asi >= 5 THEN 'asi' END, CASE WHEN rsi >= 5 THEN 'rsi' END, CASE WHEN x_risk >= 30 THEN 'x_risk' END, CASE WHEN regulation >= 60 THEN 'regulation' END], lambda x: x IS NOT NULL) AS ts FROM s)
    SELECT doc_id, array_to_string(ts, ',') AS topics, coalesce(len(ts) > 0 AND quality = 1 AND toxic = 0, false) AS accept FROM t"""
)
def verdict_topics_accept(spark, d):
    """F08, F09 with the rule judge."""
    rows = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left")
    scores = verdicts.rule_judge({"agi": F.col("doc_id") % 11, "asi": F.col("doc_id") % 7, "rsi": F.col("doc_id") % 9, "x_risk": F.col("n_chars") % 101, "regulation": F.floor(F.col("n_chars") / 7) % 101})
    rows = rows.withColumn("s", scores).withColumn("ts", verdicts.topics(lambda k: F.col(f"s.{k}")))
    return rows.select("doc_id", F.array_join("ts", ",").alias("topics"), verdicts.accepted(F.col("ts"), F.col("quality") == 1, F.col("toxic") == 0, F.lit(True)).alias("accept"))


_WILSON = "greatest(0, (p + 3.8416 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)) AS lo, least(1, (p + 3.8416 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)) AS hi"


@query(
    f"""WITH m AS (SELECT count(*) FILTER (quality = 1 AND toxic = 0) AS tp, count(*) FILTER (quality = 1 AND toxic = 1) AS fp, count(*) FILTER (quality = 0 AND toxic = 1) AS tn, count(*) FILTER (quality = 0 AND toxic = 0) AS fn FROM labels WHERE toxic IS NOT NULL),
    r AS (SELECT *, 'precision' AS measure, tp AS k, tp + fp AS n FROM m UNION ALL SELECT *, 'npv', tn, tn + fn FROM m UNION ALL SELECT *, 'agreement', tp + tn, tp + fp + tn + fn FROM m),
    w AS (SELECT *, k / n AS p, {_WILSON} FROM r)
    SELECT tp, fp, tn, fn, measure, k, n, round(p, 4) AS rate, round(lo, 4) AS ci_low, round(hi, 4) AS ci_high FROM w"""
)
def confusion_rates_wilson(spark, d):
    """A09, A10, X22."""
    return statistics.confusion(t(spark, d, "labels"), F.col("quality") == 1, F.col("toxic") == 0)


@query(
    """WITH c AS (SELECT quality AS a, 1 - toxic AS b FROM labels), n AS (SELECT count(*) AS n, count(*) FILTER (a = b) / count(*) AS po FROM c),
    e AS (SELECT sum(x.n * y.n) AS s FROM (SELECT a, count(*) n FROM c GROUP BY a) x JOIN (SELECT b, count(*) n FROM c GROUP BY b) y ON x.a = y.b)
    SELECT n, round((po - s / (n * n)) / (1 - s / (n * n)), 4) AS kappa FROM n, e"""
)
def cohens_kappa(spark, d):
    """A13."""
    return statistics.kappa(t(spark, d, "labels"), F.col("quality"), 1 - F.col("toxic"))


_BASKETS = "SELECT l_orderkey, l_linenumber, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey"


def _baskets(spark, d):
    return t(spark, d, "lineitem").join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_brand")


@query(
    f"""WITH b AS ({_BASKETS}), g AS (SELECT l_orderkey, coalesce(list_distinct(list(p_brand) FILTER (l_linenumber % 2 = 0)), []) AS a, coalesce(list_distinct(list(p_brand) FILTER (l_linenumber % 3 = 0)), []) AS b FROM b GROUP BY 1),
    j AS (SELECT len(a) + len(b) AS m, len(list_intersect(a, b)) AS i, len(list_distinct(list_concat(a, b))) AS u FROM g)
    SELECT count(*) AS n, round(avg(CASE WHEN i = u THEN 1.0 ELSE 0.0 END), 3) AS exact_set_match, round(avg(CASE WHEN u = 0 THEN 1.0::DOUBLE ELSE i / u END), 3) AS mean_jaccard, round(avg(m) / 2, 2) AS mean_labels FROM j"""
)
def pair_set_jaccard(spark, d):
    """Two label sets of each order."""
    part = lambda k: F.coalesce(F.collect_set(F.when(F.col("l_linenumber") % k == 0, F.col("p_brand"))), F.array())
    sets = _baskets(spark, d).groupBy("l_orderkey").agg(part(2).alias("a"), part(3).alias("b"))
    return statistics.pair_sets(sets, F.col("a"), F.col("b"))


@query(f"WITH b AS (SELECT DISTINCT l_orderkey, p_brand FROM ({_BASKETS})) SELECT x.p_brand AS a, y.p_brand AS b, count(*) AS n FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.p_brand <> y.p_brand GROUP BY 1, 2")
def label_cooccurrence(spark, d):
    """Labels on one order, by ordered pairs."""
    return statistics.cooccurrence(_baskets(spark, d), "l_orderkey", "p_brand")


@query(
    f"""WITH b AS (SELECT DISTINCT l_orderkey, p_brand FROM ({_BASKETS})), c AS (SELECT p_brand, count(*) AS n FROM b GROUP BY 1), tot AS (SELECT sum(n) AS total FROM c),
    pr AS (SELECT x.p_brand AS a, y.p_brand AS b, count(*) AS n FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.p_brand <> y.p_brand GROUP BY 1, 2),
    v(label) AS (VALUES ('Brand#1'), ('Brand#2'), ('Brand#3'), ('Brand#4'), ('Brand#5')),
    ask AS (SELECT DISTINCT b.l_orderkey, v.label FROM b, v WHERE NOT EXISTS (SELECT 1 FROM b z WHERE z.l_orderkey = b.l_orderkey AND z.p_brand = v.label)),
    s AS (SELECT ask.l_orderkey, ask.label, sum(pr.n / ca.n) AS p FROM ask JOIN b ON b.l_orderkey = ask.l_orderkey JOIN pr ON pr.a = b.p_brand AND pr.b = ask.label JOIN c ca ON ca.p_brand = b.p_brand GROUP BY 1, 2)
    SELECT ask.l_orderkey, ask.label, round(coalesce(s.p, 0) + 0.05 * (coalesce(c.n, 0) + 1) / total, 9) AS weight FROM ask LEFT JOIN s USING (l_orderkey, label) LEFT JOIN c ON c.p_brand = ask.label, tot"""
)
def negative_weights(spark, d):
    """How plausible the labels are that an order lacks."""
    return statistics.negative_weights(_baskets(spark, d), "l_orderkey", "p_brand", [f"Brand#{i}" for i in range(1, 6)]).withColumn("weight", F.round("weight", 9))


@query(ORACLES["negative_weights"].replace("(VALUES ('Brand#1'), ('Brand#2'), ('Brand#3'), ('Brand#4'), ('Brand#5'))", "(SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)"))
def negative_weights_all(spark, d):
    """A25 over every label that part has."""
    labels = sorted(r["p_brand"] for r in t(spark, d, "part").select("p_brand").where("p_brand is not null").distinct().collect())  # a row for each label
    return statistics.negative_weights(_baskets(spark, d), "l_orderkey", "p_brand", labels).withColumn("weight", F.round("weight", 9))


@query(
    """SELECT l_returnflag, count(*) AS n, round(sum(50 / l_quantity) * sum(50 / l_quantity) / sum((50 / l_quantity) * (50 / l_quantity)), 1) AS ess,
    round(sum(CASE WHEN l_linestatus = 'F' THEN 50 / l_quantity ELSE 0 END) / sum(50 / l_quantity), 4) AS rate FROM lineitem WHERE l_quantity > 0 GROUP BY 1"""
)
def horvitz_thompson(spark, d):
    """A15 by group."""
    return statistics.horvitz_thompson(t(spark, d, "lineitem"), F.col("l_quantity") / 50, F.col("l_linestatus") == "F", "l_returnflag")


@query(
    """WITH c AS (SELECT source, lang, count(*) AS w FROM documents GROUP BY 1, 2), x AS (SELECT *, 97 * w // sum(w) OVER () AS base, (97 * w) % sum(w) OVER () AS rest FROM c),
    r AS (SELECT *, row_number() OVER (ORDER BY rest DESC, w DESC, source, lang) AS k, 97 - sum(base) OVER () AS room FROM x)
    SELECT source, lang, w AS n, (base + CASE WHEN k <= room THEN 1 ELSE 0 END)::BIGINT AS slots FROM r"""
)
def largest_remainder(spark, d):
    """N01, the uncapped pass: slots of each (source, lang) cell."""
    cells = t(spark, d, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    return sampling.apportioned(cells, 97, "n", ["source", "lang"])


@query(
    """WITH q AS (SELECT o_orderkey AS quote_id, CASE WHEN o_orderkey % 5 = 0 THEN ' ' || c_name || ' ' WHEN o_orderkey % 5 = 1 THEN 'Nobody' ELSE c_name END AS speaker_display, CAST(c_nationkey AS VARCHAR) AS jurisdiction, o_orderpriority AS source, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END AS native_id FROM orders JOIN customer ON o_custkey = c_custkey),
    al AS (SELECT CAST(c_nationkey AS VARCHAR) AS jurisdiction, c_name AS label, CAST(c_custkey AS VARCHAR) AS speaker_id FROM customer WHERE c_custkey % 2 = 0),
    nm AS (SELECT CAST(c_nationkey AS VARCHAR) AS jurisdiction, c_name AS canonical_name, CAST(c_custkey AS VARCHAR) AS speaker_id FROM customer WHERE c_custkey % 3 = 0),
    a AS (SELECT q.*, x.speaker_id AS by_exact, y.speaker_id AS by_squeezed FROM q LEFT JOIN al x ON x.jurisdiction = q.jurisdiction AND x.label = q.speaker_display LEFT JOIN al y ON y.jurisdiction = q.jurisdiction AND y.label = trim(q.speaker_display)),
    cl AS (SELECT source, native_id, arg_min(coalesce(by_exact, by_squeezed), quote_id) AS claimed FROM a WHERE coalesce(by_exact, by_squeezed) IS NOT NULL AND native_id IS NOT NULL GROUP BY 1, 2),
    b AS (SELECT a.*, cl.claimed, nm.speaker_id AS by_name FROM a LEFT JOIN cl USING (source, native_id) LEFT JOIN nm ON nm.jurisdiction = a.jurisdiction AND nm.canonical_name = a.speaker_display)
    SELECT quote_id, coalesce(by_exact, by_squeezed, claimed, by_name, CASE WHEN native_id IS NOT NULL THEN substr(sha256(source || chr(31) || native_id), 1, 16) END) AS speaker_id,
    CASE WHEN by_exact IS NOT NULL THEN 'alias' WHEN by_squeezed IS NOT NULL THEN 'squeezed' WHEN claimed IS NOT NULL THEN 'native' WHEN by_name IS NOT NULL THEN 'name' WHEN native_id IS NOT NULL THEN 'minted' ELSE 'unlinked' END AS linked_by FROM b"""
)
def alias_cascade_link(spark, d):
    """Quotes to speakers by the cascade."""
    c = t(spark, d, "customer").withColumn("jurisdiction", F.col("c_nationkey").cast("string")).withColumn("speaker_id", F.col("c_custkey").cast("string"))
    o = t(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    display = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit(" "), "c_name", F.lit(" "))).when(F.col("o_orderkey") % 5 == 1, "Nobody").otherwise(F.col("c_name"))
    quotes = o.select(F.col("o_orderkey").alias("quote_id"), display.alias("speaker_display"), "jurisdiction", F.col("o_orderpriority").alias("source"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey").cast("string")).alias("native_id"))
    aliases = speakers.alias_map(c.where("c_custkey % 2 = 0").select("jurisdiction", F.col("c_name").alias("label"), "speaker_id", F.col("c_custkey").alias("load_order")), "load_order")
    names = c.where("c_custkey % 3 = 0").select("jurisdiction", F.col("c_name").alias("canonical_name"), "speaker_id")
    native = spark.createDataFrame([], "source string, native_id string, speaker_id string")
    return speakers.linked(quotes, aliases, native, names).select("quote_id", "speaker_id", "linked_by")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def source_anti_join(spark, d):
    """J04."""
    return joins.absent(t(spark, d, "customer"), t(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey AND l_returnflag = 'R')")
def scope_semi_join(spark, d):
    """A chain of EXISTS."""
    scoped = joins.present(t(spark, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey"), t(spark, d, "lineitem").where("l_returnflag = 'R'"), ["l_orderkey"])
    return joins.present(t(spark, d, "customer"), scoped.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]).select("c_custkey")


@query(
    """WITH s AS (SELECT event_type AS source, min(ts)::DATE AS a, max(ts)::DATE AS z FROM events GROUP BY 1),
    w AS (SELECT source, unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP, INTERVAL 7 DAY))::DATE AS window_start, z FROM s),
    p AS (SELECT source, window_start, least((window_start + INTERVAL 6 DAY)::DATE, z) AS window_end FROM w)
    SELECT source, window_start::VARCHAR AS window_start, window_end::VARCHAR AS window_end FROM p WHERE NOT (day(window_start) % 2 = 0)"""
)
def window_ledger(spark, d):
    """Planned windows less those done."""
    spans = t(spark, d, "events").groupBy(F.col("event_type").alias("source")).agg(F.min("ts").cast("date").alias("start"), F.max("ts").cast("date").alias("end"))
    planned = ledger.tiles(spans, 7)
    done = planned.where(F.dayofmonth("window_start") % 2 == 0).withColumn("status", F.lit("done"))
    return ledger.open_windows(planned, done).select("source", F.col("window_start").cast("string"), F.col("window_end").cast("string"))


@query("SELECT year(o_orderdate)::VARCHAR || '-Q' || quarter(o_orderdate)::VARCHAR AS quarter, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def quarter_rollup(spark, d):
    """A05, X18."""
    return statistics.counted(t(spark, d, "orders").where("o_orderdate is not null"), statistics.quarter(F.col("o_orderdate")).alias("quarter"))


@query("SELECT 'documents' AS stage, count(*) AS n FROM documents UNION ALL SELECT 'labelled', count(*) FROM labels UNION ALL SELECT 'accepted', count(*) FROM labels WHERE quality = 1 UNION ALL SELECT 'sources', count(DISTINCT source) FROM documents")
def funnel(spark, d):
    """A01, U01, S24."""
    docs, labels = t(spark, d, "documents"), t(spark, d, "labels")
    return statistics.funnel({"documents": docs, "labelled": labels, "accepted": labels.where("quality = 1"), "sources": docs.select("source").where("source is not null").distinct()})


@query("SELECT event_type, (props::JSON ->> '$.k')::INTEGER % 10 AS bucket, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def json_props_extract(spark, d):
    """X20, X21."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t(spark, d, "events").groupBy("event_type", (k % 10).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query()
def html_article_extract(spark, d):
    """Title and body of every page."""
    return t(spark, d, "pages").select("page_id", pages.article("html").alias("a")).select("page_id", "a.title", "a.body")


@query("SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS url FROM pages")
def url_canonical(spark, d):
    """P24."""
    return t(spark, d, "pages").select("page_id", text.canonical_url(F.col("url")).alias("url"))


@query(
    """WITH m AS (SELECT doc_id, text, length(text) AS n, CASE WHEN instr(text, 'tion') > 0 THEN instr(text, 'tion') - 1 ELSE 0 END AS s FROM documents WHERE text IS NOT NULL),
    w AS (SELECT *, greatest(0, s - 250) AS lo, least(n, s + 4 + 250) AS r FROM m), h AS (SELECT *, CASE WHEN r - lo < 800 THEN least(n, lo + 800) ELSE r END AS hi FROM w)
    SELECT doc_id, CASE WHEN n <= 800 THEN text ELSE CASE WHEN lo > 0 THEN '…' ELSE '' END || substr(text, lo + 1, hi - lo) || CASE WHEN hi < n THEN '…' ELSE '' END END AS passage FROM h"""
)
def passage_window(spark, d):
    """V01 with smaller bounds."""
    at = F.greatest(F.instr("text", "tion") - 1, F.lit(0))
    return t(spark, d, "documents").where("text is not null").select("doc_id", text.passage(F.col("text"), F.array(at), F.array(at + 4), 800, 250).alias("passage"))


@query()
def utterance_excerpt(spark, d):
    """Each long document round its middle sentence."""
    docs = t(spark, d, "documents").where("text is not null")
    display = F.concat(F.substr("text", F.floor(F.length("text") / 2).cast("int") + 1, F.lit(40)), F.lit(" [...] "), F.substr("text", F.floor(F.length("text") / 2).cast("int") + 200, F.lit(40)))
    return docs.select("doc_id", excerpt.excerpt_of(F.col("text"), display).alias("e")).select("doc_id", "e.text", F.size("e.spans").alias("n_spans"), "e.truncated")


@query("SELECT doc_id, substr(sha256(coalesce(source, '') || chr(31) || coalesce(text, '')), 1, 16) AS public_id, (('0x' || substr(sha256(coalesce(source, '') || chr(31) || coalesce(text, '')), 1, 1))::INTEGER % 8) AS shard FROM documents")
def shard_assignment(spark, d):
    """X09, X16."""
    key = text.public_id(F.col("source"), F.col("text"))
    return t(spark, d, "documents").select("doc_id", key.alias("public_id"), text.shard(key).alias("shard"))


@query(
    """WITH i AS (SELECT substr(sha256(coalesce(source, '') || chr(31) || coalesce(text, '')), 1, 16) AS k FROM documents), s AS (SELECT k, ('0x' || substr(k, 1, 1))::INTEGER % 8 AS shard FROM i)
    SELECT r.shard::INTEGER AS shard, count(k) AS n_records, min(k) AS first_id, max(k) AS last_id FROM range(8) r(shard) LEFT JOIN s ON s.shard = r.shard GROUP BY 1"""
)
def sidecar_shards(spark, d):
    """All shards, filled or not."""
    return export.sidecar(t(spark, d, "documents").select(text.public_id(F.col("source"), F.col("text")).alias("k")), "k")


@query("SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\W_]+'))::INTEGER AS n_words FROM documents WHERE lang = 'en' AND NOT regexp_matches(coalesce(text, ''), '[^\\x00-\\x7F]')")
def word_count_cap(spark, d):
    """F26 on ASCII texts."""
    return t(spark, d, "documents").where("lang = 'en'").where(~F.rlike(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x7F]"))).select("doc_id", text.words_shown(F.col("text")).alias("n_words"))


@query(
    """WITH p AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\\[\\.\\.\\.\\]', ' ', 'g') AS t FROM documents), c AS (SELECT *, '[\\x{3040}-\\x{30ff}\\x{3400}-\\x{4dbf}\\x{4e00}-\\x{9fff}\\x{f900}-\\x{faff}]' AS cjk FROM p)
    SELECT doc_id, (len(regexp_extract_all(t, cjk)) + len(regexp_extract_all(regexp_replace(t, cjk, ' ', 'g'), '[\\p{L}\\p{N}]+')))::INTEGER AS n_words FROM c"""
)
def word_count_all(spark, d):
    """F26 on all documents, whatever their language and letters."""
    return t(spark, d, "documents").select("doc_id", text.words_shown(F.col("text")).alias("n_words"))


@query("SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(text, '-{2,}', '—', 'g'), '[\\s\\x{A0}]+', ' ', 'g'))) AS h FROM documents WHERE text IS NOT NULL")
def presentable_text(spark, d):
    """X01, X02."""
    return t(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(text.presentable(F.col("text")), 256).alias("h"))


@query(
    """WITH r AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN role || ' (identity unclear)' WHEN 1 THEN '' WHEN 2 THEN 'Mr. ' || role ELSE '(procedural)' END AS display, CASE WHEN turn % 5 = 0 THEN 'unspecified' WHEN turn % 7 = 0 THEN 'unnamed aide' ELSE '' END AS role2 FROM conversations)
    SELECT conv_id, turn, CASE WHEN display = '' OR role2 = 'unspecified' THEN 'unidentified' WHEN display = '(procedural)' THEN 'unidentified' WHEN display LIKE '%(identity unclear)' THEN 'ambiguous' WHEN role2 LIKE 'unnamed%' THEN 'ambiguous' ELSE 'resolved' END AS resolution,
    CASE WHEN display = '(procedural)' THEN '' WHEN display LIKE '% (identity unclear)' THEN replace(display, ' (identity unclear)', '') ELSE display END AS shown FROM r"""
)
def speaker_resolution(spark, d):
    """F21, F22."""
    k = F.col("turn") % 4
    display = F.when(k == 0, F.concat("role", F.lit(" (identity unclear)"))).when(k == 1, "").when(k == 2, F.concat(F.lit("Mr. "), "role")).otherwise("(procedural)")
    role = F.when(F.col("turn") % 5 == 0, "unspecified").when(F.col("turn") % 7 == 0, "unnamed aide").otherwise("")
    return t(spark, d, "conversations").select("conv_id", "turn", speakers.resolution(display, role).alias("resolution"), speakers.clean_display(display).alias("shown"))


@query(
    """WITH x AS (SELECT doc_id, lang, source, CASE WHEN doc_id % 3 = 0 THEN text ELSE 'English: ' || doc_id END AS en, text, doc_id % 2 = 0 AS mul FROM documents WHERE text IS NOT NULL AND text <> ''), y AS (SELECT *, CASE WHEN mul THEN 'mul' ELSE lang END AS tag FROM x)
    SELECT doc_id, CASE WHEN tag <> 'en' AND en <> text THEN 'mt' WHEN tag <> 'en' AND tag <> 'mul' THEN 'raw' WHEN tag = 'mul' THEN NULL WHEN source = 'src1' THEN 'official' END AS translation, CASE WHEN tag = 'mul' THEN 'en' ELSE tag END AS shown_language FROM y"""
)
def translation_provenance(spark, d):
    """F15-F18."""
    docs = t(spark, d, "documents").where("text <> ''")
    tag = F.when(F.col("doc_id") % 2 == 0, "mul").otherwise(F.col("lang"))
    english = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.concat(F.lit("English: "), F.col("doc_id").cast("string")))
    is_en = export.english_original(F.col("text"), tag)
    shown, shown_en = export.displayed(F.col("text"), english, F.lit(None).cast("string"), F.lit(None).cast("string"), is_en)
    source = F.when(F.col("source") == "src1", "cn_mfa").otherwise(F.col("source"))
    return docs.select("doc_id", export.translation(tag, F.when(tag == "en", "en"), source, F.lit(""), shown, shown_en, is_en).alias("translation"), export.display_language(is_en, tag).alias("shown_language"))


@query(
    """WITH x AS (SELECT item_id, CASE item_id % 4 WHEN 0 THEN 'SEC. ' || item_id || '. Findings' WHEN 1 THEN 'Section 4. Definitions' WHEN 2 THEN 'The Committee recommends ' || text ELSE text END AS t, CASE WHEN item_id % 3 = 0 THEN 'The Presiding Chair' ELSE 'Ms. A' END AS sp, CASE WHEN item_id % 5 = 0 THEN 'US' ELSE 'UK' END AS j, CASE WHEN item_id % 10 = 0 THEN 'us_fedreg' ELSE 'x' END AS s FROM benchmark)
    SELECT item_id, t LIKE 'The Committee recommends%' OR (regexp_matches(t, '^\\s*(SEC\\.\\s*\\d+\\s*[.:]|Section\\s+\\d+\\s*[.:])') AND (sp = 'The Presiding Chair' OR (j = 'US' AND s <> 'us_fedreg'))) AS statutory FROM x"""
)
def statutory_provision(spark, d):
    """F20."""
    i = F.col("item_id")
    shown = F.when(i % 4 == 0, F.concat(F.lit("SEC. "), i.cast("string"), F.lit(". Findings"))).when(i % 4 == 1, "Section 4. Definitions").when(i % 4 == 2, F.concat(F.lit("The Committee recommends "), "text")).otherwise(F.col("text"))
    return t(spark, d, "benchmark").select("item_id", export.statutory(F.when(i % 3 == 0, "The Presiding Chair").otherwise("Ms. A"), F.when(i % 5 == 0, "US").otherwise("UK"), F.when(i % 10 == 0, "us_fedreg").otherwise("x"), shown).alias("statutory"))


@query(
    """WITH x AS (SELECT doc_id, text, substr(text, 11, 60) AS s FROM documents WHERE length(text) > 80), y AS (SELECT *, regexp_extract(substr(text, instr(text, s) + length(s), 250), '^([^.!?]*[.!?])', 1) AS rest FROM x)
    SELECT doc_id, CASE WHEN regexp_matches(s, '[.!?")\\]'']\\s*$') THEN s WHEN rest <> '' THEN s || rest ELSE s || ' [...]' END AS shown FROM y"""
)
def sentence_extension(spark, d):
    """F33."""
    s = F.substring("text", 11, 60)
    return t(spark, d, "documents").where("length(text) > 80").select("doc_id", export.extended(s, s, F.col("text")).alias("shown"))


@query(
    """WITH x AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS h, doc_id % 3 AS k FROM documents WHERE length(text) > 200), y AS (SELECT *, trim(substr(h, 20, 30)) AS a, trim(substr(h, 90, 30)) AS b FROM x)
    SELECT doc_id, k <> 2 AS verbatim, CASE WHEN k = 0 THEN true WHEN k = 1 THEN instr(substr(h, instr(h, b) + length(b)), a) > 0 ELSE false END AS spliced FROM y WHERE NOT contains(a, '[') AND NOT contains(b, '[') AND instr(h, a) + length(a) <= instr(h, b) AND lower(substr(a,1,1)) <> upper(substr(a,1,1)) AND lower(substr(b,1,1)) <> upper(substr(b,1,1))"""
)
def verbatim_and_splice_guards(spark, d):
    """spans in order pass, spans out of order or made up do not."""
    rows = t(spark, d, "documents").where("length(text) > 200").withColumn("h", text.squeeze(F.col("text"))).withColumn("a", F.trim(F.substring("h", 20, 30))).withColumn("b", F.trim(F.substring("h", 90, 30)))
    letter = lambda c: F.lower(F.substring(c, 1, 1)) != F.upper(F.substring(c, 1, 1))
    rows = rows.where(~F.contains("a", F.lit("[")) & ~F.contains("b", F.lit("[")) & (F.instr("h", F.col("a")) + F.length("a") <= F.instr("h", F.col("b"))) & letter("a") & letter("b"))
    k = F.col("doc_id") % 3
    display = F.when(k == 0, F.concat_ws(" [...] ", "a", "b")).when(k == 1, F.concat_ws(" [...] ", "b", "a")).otherwise(F.concat_ws(" [...] ", "a", F.lit("no such words anywhere")))
    span = F.when(k == 2, F.concat("a", F.lit("no such words"))).otherwise(F.col("a"))
    return rows.select("doc_id", text.within(span, F.col("text")).alias("verbatim"), text.spliced(display, F.col("text")).alias("spliced"))


@query(
    """WITH v AS (SELECT l_orderkey AS candidate_id, l_suppkey % 3 AS model, l_linenumber AS id, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE list_filter(['agi', 'asi', 'rsi', 'x_risk', 'regulation'], lambda x, i: (l_partkey // (2 ** (i - 1))::BIGINT) % 2 = 1) END AS ts FROM lineitem),
    n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id, model ORDER BY id DESC, ts) r FROM v) WHERE r = 1),
    g AS (SELECT candidate_id, count(ts) AS judges FROM n GROUP BY 1), e AS (SELECT candidate_id, unnest(ts) AS topic FROM n), c AS (SELECT candidate_id, topic, count(*) AS k FROM e GROUP BY 1, 2)
    SELECT g.candidate_id, judges, coalesce(string_agg(topic, ',' ORDER BY list_position(['agi', 'asi', 'rsi', 'x_risk', 'regulation'], topic)) FILTER (k = judges), '') AS agreed, coalesce(string_agg(topic, ',' ORDER BY list_position(['agi', 'asi', 'rsi', 'x_risk', 'regulation'], topic)) FILTER (k < judges), '') AS disputed
    FROM g LEFT JOIN c USING (candidate_id) GROUP BY 1, 2"""
)
def coarse_consensus(spark, d):
    """Topics that all judges' newest lists share, and those that some have."""
    from ..schemas import COARSE_TOPICS

    li = t(spark, d, "lineitem")
    topics = F.array_compact(F.array(*[F.when(F.floor(F.col("l_partkey") / 2**i) % 2 == 1, F.lit(k)) for i, k in enumerate(COARSE_TOPICS)]))
    votes = li.select(F.col("l_orderkey").alias("candidate_id"), (F.col("l_suppkey") % 3).alias("model"), F.col("l_linenumber").alias("id"), F.when(F.col("l_partkey") % 4 != 0, topics).alias("coarse_topics"))
    votes = votes.groupBy("candidate_id", "model", "id").agg(F.min("coarse_topics").alias("coarse_topics"))
    return verdicts.consensus(votes).select("candidate_id", "judges", F.array_join("agreed", ",").alias("agreed"), F.array_join("disputed", ",").alias("disputed"))


@query(
    """WITH n AS (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p FROM orders GROUP BY 1) SELECT c_custkey, coalesce(p, 'direct') AS method FROM customer LEFT JOIN n ON o_custkey = c_custkey"""
)
def latest_lookup(spark, d):
    """The newest value of each key, or a default."""
    log = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("method"), F.struct("o_orderdate", "o_orderkey").alias("at"))
    return joins.latest(t(spark, d, "customer"), log, ["c_custkey"], "method", "at", "direct").select("c_custkey", "method")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey)::INTEGER AS rank, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS n_siblings FROM orders")
def sibling_rank(spark, d):
    """J15, W08."""
    return joins.sibling_rank(t(spark, d, "orders"), ["o_custkey", "o_orderstatus"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", "rank", "n_siblings")


@query(
    """WITH b AS (SELECT d.doc_id, d.text, l.quality, CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE substr(d.text, 1, 40) || CASE WHEN d.doc_id % 5 = 0 THEN '~' ELSE '' END END AS span, sha256(coalesce(d.text, '')) AS k FROM documents d LEFT JOIN labels l USING (doc_id)),
    r AS (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'no_adjudication' WHEN span IS NULL THEN 'legacy_schema' WHEN coalesce(quality, 0) <> 1 THEN 'rejected' WHEN span = '' OR NOT contains(trim(regexp_replace(text, '\\s+', ' ', 'g')), trim(regexp_replace(span, '\\s+', ' ', 'g'))) THEN 'not_verbatim' END AS reason FROM b),
    w AS (SELECT *, row_number() OVER (PARTITION BY k, reason IS NULL ORDER BY doc_id) AS rn FROM r)
    SELECT CASE WHEN reason IS NULL AND rn > 1 THEN 'duplicate' ELSE coalesce(reason, 'promoted') END AS decision, count(*) AS n FROM w GROUP BY 1"""
)
def promote_cascade(spark, d):
    """Decisions in order, counted."""
    rows = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left")
    i = F.col("doc_id")
    span = F.when(i % 6 != 0, F.concat(F.substring("text", 1, 40), F.when(i % 5 == 0, "~").otherwise("")))
    rows = rows.select(i.alias("candidate_id"), "text", F.when(i % 7 != 0, "{}").alias("raw_verdict"), F.when(span.isNotNull(), F.struct(span.alias("quote_span"))).alias("verdict"), (F.coalesce("quality", F.lit(0)) == 1).alias("accept"), F.lit("primary").alias("role"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("span_key"))
    return statistics.outcomes(verdicts.decisions(rows, spark.createDataFrame([], "span_key string")))


@query(
    """WITH l AS (SELECT o_orderkey AS id, o_custkey AS cand, CASE WHEN o_orderstatus = 'F' THEN 'confirm' ELSE 'primary' END AS role, o_orderpriority LIKE '1%' AS accept, o_orderkey % 4 <> 0 AS has FROM orders WHERE o_orderkey % 3 = 0),
    f AS (SELECT cand, bool_or(has AND role = 'confirm') AS c, bool_or(has AND NOT accept) AS r, bool_or(has AND role = 'primary') AS p FROM l GROUP BY 1)
    SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT cand FROM f WHERE c OR r OR p)"""
)
def pending_candidates(spark, d):
    """Candidates without a resolving verdict."""
    o = t(spark, d, "orders").where("o_orderkey % 3 = 0")
    log = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("candidate_id"), F.when(F.col("o_orderstatus") == "F", "confirm").otherwise("primary").alias("role"), F.col("o_orderpriority").startswith("1").alias("accept"), F.when(F.col("o_orderkey") % 4 != 0, "{}").alias("verdict"), F.lit("p").alias("prompt_sha256"))
    return verdicts.pending(t(spark, d, "customer").select(F.col("c_custkey").alias("id")), log, "p")


@query(ORACLES["pending_candidates"].replace(" WHERE o_orderkey % 3 = 0", ""))
def pending_candidates_all(spark, d):
    """V03, W11 with the whole of orders as the log."""
    o = t(spark, d, "orders")
    log = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("candidate_id"), F.when(F.col("o_orderstatus") == "F", "confirm").otherwise("primary").alias("role"), F.col("o_orderpriority").startswith("1").alias("accept"), F.when(F.col("o_orderkey") % 4 != 0, "{}").alias("verdict"), F.lit("p").alias("prompt_sha256"))
    return verdicts.pending(t(spark, d, "customer").select(F.col("c_custkey").alias("id")), log, "p")


@query(
    """WITH c AS (SELECT o_orderkey AS id, o_custkey AS u, o_orderkey % 5 = 0 AS q, o_orderkey % 3 = 0 AS j FROM orders) SELECT u AS utterance_id, id FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY q DESC, j DESC, id DESC) r FROM c) WHERE r = 1"""
)
def candidate_migration(spark, d):
    """F06, W07."""
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("utterance_id"))
    ids = lambda k: o.where(F.col("id") % k == 0).select(F.col("id").alias("candidate_id"))
    return keywords.migrated(o, ids(5), ids(3)).select("utterance_id", "id")


@query("SELECT doc_id FROM documents WHERE lang = 'en' AND doc_id % 4 <> 0 AND regexp_matches(coalesce(text, ''), '(?i)\\b(pathetic|worthless|disgust\\w*|idiot|clown|scum)\\b')")
def candidate_scan(spark, d):
    """texts not scanned at this version that match."""
    u = t(spark, d, "documents").where("lang = 'en'").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("language"), "source")
    seen = u.where("id % 4 = 0").select(F.col("id").alias("utterance_id"), F.lit(keywords.version(TERMS)).alias("keyword_version"))
    return keywords.candidates(u, TERMS, seen).select(F.col("id").alias("doc_id"))


@query(
    _HITS
    + """, u AS (SELECT doc_id, text, split_part(coalesce(lang, ''), '-', 1) AS base FROM documents WHERE doc_id % 4 <> 0)
    SELECT DISTINCT doc_id FROM u JOIN terms ON lang = base OR base NOT IN (SELECT lang FROM terms) WHERE regexp_matches(coalesce(text, ''), pat)"""
)
def candidate_scan_all(spark, d):
    """F05 over documents of every language."""
    u = t(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("language"), "source")
    seen = u.where("id % 4 = 0").select(F.col("id").alias("utterance_id"), F.lit(keywords.version(TERMS)).alias("keyword_version"))
    return keywords.candidates(u, TERMS, seen).select(F.col("id").alias("doc_id"))


@query("SELECT event_type, (count(*) FILTER (value > 20)) AS k, count(*) AS n, round(count(*) FILTER (value > 20) / count(*), 4) AS rate, count(*) FILTER (value IS NULL) AS unsure FROM events GROUP BY 1")
def agreement_breakdown(spark, d):
    """A11, A20."""
    return statistics.breakdown(t(spark, d, "events"), "event_type", F.col("value") > 20).select("event_type", "k", "n", "rate", "unsure")


@query(
    f"""WITH b AS ({_BASKETS}), g AS (SELECT l_orderkey, coalesce(list_distinct(list(p_brand) FILTER (l_linenumber % 2 = 0)), []) AS a, coalesce(list_distinct(list(p_brand) FILTER (l_linenumber % 3 = 0)), []) AS b FROM b GROUP BY 1),
    m AS (SELECT unnest(list_filter(b, lambda x: NOT list_contains(a, x))) AS label, 1 AS added FROM g UNION ALL SELECT unnest(list_filter(a, lambda x: NOT list_contains(b, x))), 0 FROM g)
    SELECT label, sum(added)::BIGINT AS n_added, sum(1 - added)::BIGINT AS n_dropped FROM m GROUP BY 1"""
)
def label_drift(spark, d):
    """A19, U05."""
    part = lambda k: F.collect_set(F.when(F.col("l_linenumber") % k == 0, F.col("p_brand")))
    sets = _baskets(spark, d).groupBy("l_orderkey").agg(part(2).alias("a"), part(3).alias("b"))
    return statistics.drift(sets, F.col("a"), F.col("b"))


@query(
    """WITH x AS (SELECT doc_id, source, sha256('7:' || doc_id::VARCHAR) AS h FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY substr(h, 1, 13), doc_id) AS k FROM x) SELECT doc_id, source FROM r WHERE k <= 3"""
)
def stratified_draw(spark, d):
    """Three documents of each source in the order of a seeded hash."""
    docs = t(spark, d, "documents").select("doc_id", "source")
    slots = docs.select("source").distinct().withColumn("slots", F.lit(3))
    return sampling.drawn(docs, "doc_id", ["source"], slots, 7)


@query(
    """WITH v AS (SELECT DISTINCT source, lang AS native_id, substr(sha256(text), 1, 16) AS version_hash FROM documents WHERE text IS NOT NULL), o AS (SELECT DISTINCT source, lang AS native_id, substr(sha256(text), 1, 16) AS version_hash FROM documents WHERE text IS NOT NULL AND doc_id % 2 = 0)
    SELECT * FROM v EXCEPT SELECT * FROM o"""
)
def document_versions(spark, d):
    """Versions not known yet."""
    rows = t(spark, d, "documents").where("text is not null").select("doc_id", "source", F.col("lang").alias("native_id"), F.col("text").alias("content"))
    known = rows.where("doc_id % 2 = 0").withColumn("version_hash", ledger.version(F.col("content")))
    return ledger.new_versions(known, rows.drop("doc_id")).select("source", "native_id", "version_hash")


@query("SELECT conv_id, turn, k.seq, trim(k.body) AS body FROM (SELECT conv_id, turn, unnest(list_transform(string_split(text, '. '), lambda x, i: {'seq': (i - 1)::INTEGER, 'body': x})) AS k FROM conversations) WHERE trim(k.body) <> ''")
def turn_split(spark, d):
    """Bodies between headers (here, sentence ends)."""
    rows = t(spark, d, "conversations").withColumn("key", F.struct("conv_id", "turn"))
    return segments.turns(rows, "text", r"(\. )", "key").select("key.conv_id", "key.turn", "seq", "body")


@query()
def paragraph_chunks(spark, d):
    """Greedy chunks of lines; rows only, as SQL has no fold with state of this kind."""
    return t(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(segments.chunks(F.split("text", "\n"), 1500)).alias("n", "chunk"))


@query(
    f"""WITH r AS (SELECT event_type, count(*) FILTER (value > 10) AS k, count(*) AS n FROM events GROUP BY 1), w AS (SELECT *, k / n AS p, {_WILSON} FROM r) SELECT event_type, round(lo, 4) AS lo, round(hi, 4) AS hi FROM w"""
)
def wilson_by_group(spark, d):
    """X22."""
    g = t(spark, d, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 10).alias("k"), F.count(F.lit(1)).alias("n"))
    lo, hi = wilson(F.col("k"), F.col("n"))
    return g.select("event_type", F.round(lo, 4).alias("lo"), F.round(hi, 4).alias("hi"))


@query(
    """SELECT count(*) AS n, count(*) FILTER (text IS NULL OR text = '') AS n_empty, min(length(text))::INTEGER AS shortest, max(length(text))::INTEGER AS longest, count(DISTINCT source) AS n_sources, count(DISTINCT lang) AS n_languages, count(*) FILTER (length(text) > 12000) AS n_truncated FROM documents"""
)
def payload_measures(spark, d):
    """S25, A23, F35."""
    n = F.length("text")
    return t(spark, d, "documents").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("text", F.lit("")) == "").alias("n_empty"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.count_distinct("source").alias("n_sources"), F.count_distinct("lang").alias("n_languages"), F.count_if(n > 12000).alias("n_truncated"))


@query("SELECT least(max(ts)::DATE, DATE '2024-06-30')::VARCHAR AS coverage_end FROM events WHERE event_type = 'click'")
def coverage_end(spark, d):
    """A06."""
    rows = t(spark, d, "events").select(F.col("ts").cast("date").alias("window_end"), F.when(F.col("event_type") == "click", "done").otherwise("partial").alias("status"))
    return export.coverage_end(rows, F.lit("2024-06-30").cast("date")).select(F.col("coverage_end").cast("string"))


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2")
def group_counts(spark, d):
    """A02-A04, O03."""
    return statistics.counted(t(spark, d, "documents"), F.col("source"), F.col("lang"))
