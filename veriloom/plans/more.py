"""More registered queries: operators that the first catalog leaves out, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import excerpt, folding, text
from ..operators import export, joins, keywords, mirrors, promotion, sampling, segments, speakers, statistics, verdicts
from ..operators.components import connected
from ..sources import ledger, pages, records, registry
from .catalog import query, t

# Shapes that several queries share: orders as candidates, lineitem as a log of verdicts.
_LOG = """log AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS candidate_id, CASE l_linenumber % 4 WHEN 0 THEN 'confirm' WHEN 1 THEN 'primary' WHEN 2 THEN 'skeptic' ELSE 'escalation' END AS role,
    CASE WHEN l_partkey % 3 = 0 THEN 'p' ELSE 'old' END AS prompt, l_suppkey % 5 <> 0 AS has, 'm' || l_suppkey % 2 AS model FROM lineitem)"""


def _log(spark, d):
    n = F.col("l_linenumber") % 4
    return t(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("candidate_id"),
        F.when(n == 0, "confirm").when(n == 1, "primary").when(n == 2, "skeptic").otherwise("escalation").alias("role"),
        F.when(F.col("l_partkey") % 3 == 0, "p").otherwise("old").alias("prompt_sha256"),
        F.when(F.col("l_suppkey") % 5 != 0, "{}").alias("verdict"),
        F.concat(F.lit("m"), (F.col("l_suppkey") % 2).cast("string")).alias("model"),
    )


@query(
    f"""WITH {_LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY prompt = 'p' DESC, CASE role WHEN 'confirm' THEN 0 WHEN 'escalation' THEN 1 ELSE 2 END, id DESC) AS k FROM log WHERE has AND role IN ('primary', 'escalation', 'confirm'))
    SELECT candidate_id, id FROM r WHERE k = 1"""
)
def best_adjudication(spark, d):
    """Prompt, then role, then the newest; a skeptic's verdict never counts."""
    return verdicts.best_adjudication(_log(spark, d), "p").select("candidate_id", "id")


@query(f"WITH {_LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY candidate_id, model ORDER BY prompt = 'p' DESC, id DESC) AS k FROM log WHERE has) SELECT candidate_id, model, id FROM r WHERE k = 1")
def best_refinement(spark, d):
    """Of each judge, the current prompt first, then the newest."""
    return verdicts.best_refinement(_log(spark, d), "p", by_model=True).select("candidate_id", "model", "id")


@query(f"WITH {_LOG}, g AS (SELECT candidate_id, bool_or(has) AS good FROM log GROUP BY 1) SELECT o_orderkey AS id, CASE WHEN good THEN 'adjudicated' WHEN good IS NULL THEN 'pending' ELSE 'error' END AS status FROM orders LEFT JOIN g ON candidate_id = o_orderkey")
def candidate_status(spark, d):
    """From the log of verdicts."""
    return promotion.statuses(t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("pending").alias("status")), _log(spark, d)).select("id", "status")


@query(
    f"""WITH {_LOG}, q AS (SELECT candidate_id, max(id) AS adjudication_id FROM log GROUP BY 1), r AS (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY prompt = 'p' DESC, CASE role WHEN 'confirm' THEN 0 WHEN 'escalation' THEN 1 ELSE 2 END, id DESC) AS k FROM log WHERE has AND role <> 'skeptic')
    SELECT q.candidate_id, q.adjudication_id FROM q JOIN r ON r.k = 1 AND r.candidate_id = q.candidate_id AND r.id = q.adjudication_id"""
)
def refreshed_quotes(spark, d):
    """Quotes whose verdict is still the best."""
    log = _log(spark, d)
    quotes = log.groupBy("candidate_id").agg(F.max("id").alias("adjudication_id"))
    return promotion.refreshed(quotes, verdicts.best_adjudication(log, "p"))


@query(
    """WITH b AS (SELECT l_orderkey AS cache_key, l_linenumber AS id, l_suppkey % 3 = 0 AS has, l_linenumber > 3 AS fresh FROM lineitem),
    r AS (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY (NOT fresh AND has) DESC, fresh DESC, id DESC) AS k FROM b) SELECT cache_key, id FROM r WHERE k = 1"""
)
def log_upsert(spark, d):
    """A stored verdict stays, a failure gives way to the newer row."""
    rows = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("cache_key"), F.col("l_linenumber").alias("id"), F.when(F.col("l_suppkey") % 3 == 0, "{}").alias("verdict"))
    return verdicts.upserted(rows.where("id <= 3"), rows.where("id > 3")).select("cache_key", "id")


@query("""WITH s AS (SELECT event_type AS source, min(ts)::DATE AS a, max(ts)::DATE AS z FROM events GROUP BY 1), m AS (SELECT source, a, z, unnest(generate_series(date_trunc('month', a), date_trunc('month', z), INTERVAL 1 MONTH))::DATE AS t FROM s)
    SELECT source, 'month' AS unit, greatest(t, a)::VARCHAR AS window_start, least(last_day(t), z)::VARCHAR AS window_end FROM m
    UNION ALL SELECT source, 'year', greatest(y, a)::VARCHAR, least((y + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE, z)::VARCHAR FROM (SELECT source, a, z, unnest(generate_series(date_trunc('year', a), date_trunc('year', z), INTERVAL 1 YEAR))::DATE AS y FROM s)""")
def calendar_windows(spark, d):
    """Windows that end with months and years."""
    spans = t(spark, d, "events").groupBy(F.col("event_type").alias("source")).agg(F.min("ts").cast("date").alias("start"), F.max("ts").cast("date").alias("end"))
    cut = lambda unit: ledger.calendar_tiles(spans, unit).select("source", F.lit(unit).alias("unit"), F.col("window_start").cast("string"), F.col("window_end").cast("string"))
    return cut("month").unionByName(cut("year"))


@query("""WITH s AS (SELECT o_orderstatus AS source, o_orderdate AS a FROM orders), w AS (SELECT DISTINCT source, a AS window_start, (a + INTERVAL 6 DAY)::DATE AS window_end FROM s)
    SELECT source, window_start::VARCHAR AS window_start FROM w WHERE window_end <= DATE '1996-12-31' - 30 AND window_start >= DATE '1996-12-31' - 365""")
def lagged_windows(spark, d):
    """Neither too fresh nor before the rolling year."""
    w = t(spark, d, "orders").select(F.col("o_orderstatus").alias("source"), F.col("o_orderdate").alias("window_start"), F.date_add("o_orderdate", 6).alias("window_end")).distinct()
    return ledger.lagged(w, F.lit("1996-12-31").cast("date"), 30, 365).select("source", F.col("window_start").cast("string"))


@query("""WITH r AS (SELECT o_orderstatus AS source, o_orderdate AS day, o_orderpriority AS status, row_number() OVER (PARTITION BY o_orderstatus, o_orderdate ORDER BY o_orderkey DESC) AS k FROM orders) SELECT source, day::VARCHAR AS window_start, status FROM r WHERE k = 1""")
def ledger_upsert(spark, d):
    """The newest entry of each window."""
    rows = t(spark, d, "orders").select(F.col("o_orderstatus").alias("source"), F.col("o_orderdate").alias("window_start"), F.col("o_orderdate").alias("window_end"), F.col("o_orderpriority").alias("status"), F.col("o_orderkey").alias("updated_at"))
    return ledger.marked(rows.where("updated_at % 2 = 0"), rows.where("updated_at % 2 = 1")).select("source", F.col("window_start").cast("string"), "status")


@query("""WITH o AS (SELECT conv_id, turn, text, role FROM conversations WHERE turn % 3 <> 0), n AS (SELECT conv_id, turn, 'new ' || text AS text, upper(role) AS role FROM conversations WHERE turn % 2 = 0)
    SELECT conv_id AS document_id, turn AS seq, coalesce(n.text, o.text) AS text, coalesce(n.role, o.role) AS speaker_raw, CASE WHEN o.text IS NULL THEN 'n' ELSE 'o' END AS language FROM o FULL JOIN n USING (conv_id, turn)""")
def utterance_upsert(spark, d):
    """Text and speaker of the newer row, the rest of the older."""
    rows = t(spark, d, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("seq"), "text", F.col("role").alias("speaker_raw"), F.lit(None).cast("string").alias("speech_context"))
    old = rows.where("seq % 3 <> 0").withColumn("language", F.lit("o"))
    new = rows.where("seq % 2 = 0").withColumn("text", F.concat(F.lit("new\x07 "), "text")).withColumn("speaker_raw", F.upper("speaker_raw")).withColumn("language", F.lit("n"))
    return ledger.upserted_utterances(old, new).select("document_id", "seq", "text", "speaker_raw", "language")


@query("SELECT DISTINCT CAST(c_nationkey AS VARCHAR) || chr(9) || c_name AS value FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def unlinked_report(spark, d):
    """What no registry knows."""
    c, o = t(spark, d, "customer"), t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lit("x").alias("speaker_id")).distinct()
    return registry.unlinked(c.join(o, "c_custkey", "left").select(F.col("c_nationkey").cast("string").alias("jurisdiction"), F.col("c_name").alias("speaker_display"), "speaker_id"))


@query("""SELECT o_orderkey AS id, o_custkey AS utterance_id, c_nationkey AS document_id, c_name AS text, n_name AS source FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def spine_join(spark, d):
    """Candidates with utterance and document."""
    c = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("utterance_id"))
    u = t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("document_id"), F.col("c_name").alias("text"))
    n = t(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("source"), F.lit("en").alias("language"), F.lit("{}").alias("meta"))
    return joins.spine(c, u, n).select("id", "utterance_id", "document_id", "text", "source")


@query("""WITH q AS (SELECT o_orderkey AS candidate_id, o_custkey AS speaker_id, o_orderkey * 10 + 1 AS adjudication_id FROM orders), f AS (SELECT o_orderkey AS candidate_id, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 7 END, o_orderkey % 5) AS fetch_id FROM orders)
    SELECT q.candidate_id, c_name AS canonical_name, f.fetch_id, p.p_name AS content FROM q JOIN f USING (candidate_id) JOIN lineitem ON l_orderkey = q.candidate_id AND l_linenumber = 1 LEFT JOIN customer ON c_custkey = q.speaker_id AND c_custkey % 3 = 0 LEFT JOIN part p ON p.p_partkey = f.fetch_id""")
def export_spine(spark, d):
    """Quotes with speaker, verdict, record, and the fetch that the document or the utterance names."""
    o = t(spark, d, "orders")
    q = o.select(F.col("o_orderkey").alias("candidate_id"), F.col("o_custkey").alias("speaker_id"), (F.col("o_orderkey") * 10 + 1).alias("adjudication_id"))
    s = t(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("speaker_id"), F.col("c_name").alias("canonical_name"))
    spined = o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 7).alias("raw_fetch_id"), F.to_json(F.struct((F.col("o_orderkey") % 5).alias("raw_fetch_id"))).alias("meta"))
    fetches = t(spark, d, "part").select(F.col("p_partkey").alias("id"), F.lit(None).cast("timestamp").alias("fetched_at"), F.col("p_name").alias("content_sha256"))
    return joins.export_spine(q, s, _log(spark, d), spined, fetches).select("candidate_id", "canonical_name", "fetch_id", F.col("content_sha256").alias("content"))


@query("""WITH r AS (SELECT o_custkey AS speaker_id, o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'member' ELSE o_orderpriority END AS role, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS party FROM orders)
    SELECT speaker_id, arg_min(role, id) FILTER (role <> 'member') AS role, arg_min(party, id) FILTER (party IS NOT NULL) AS party FROM r GROUP BY 1""")
def first_roles(spark, d):
    """The first role that is not mere membership, and the first party."""
    k = F.col("o_orderkey")
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("speaker_id"), k.alias("id"), F.when(k % 3 == 0, "member").otherwise(F.col("o_orderpriority")).alias("role"), F.when(k % 4 == 0, F.col("o_orderstatus")).alias("party"))
    return speakers.first_roles(rows)


@query("""WITH a AS (SELECT CAST(c_nationkey AS VARCHAR) AS j, trim(regexp_replace(c_name, '#', ' #')) AS k, arg_min(c_custkey, c_custkey) AS canonical FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1, 2)
    SELECT o_orderkey, 'C' || canonical AS canonical_name FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN a ON j = CAST(c_nationkey AS VARCHAR) AND k = regexp_replace(c_name, '#', ' #')""")
def canonical_names(spark, d):
    """Registered names by jurisdiction and squeezed label."""
    c = t(spark, d, "customer")
    a = c.where("c_custkey % 2 = 0").select(F.col("c_nationkey").cast("string").alias("jurisdiction"), F.regexp_replace("c_name", "#", "  #").alias("label"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("canonical_name"), F.col("c_custkey").alias("load_order"))
    rows = t(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_nationkey").cast("string").alias("jurisdiction"), F.regexp_replace("c_name", "#", " \t#").alias("speaker_display"))
    return speakers.canonical_names(rows, a).select("o_orderkey", "canonical_name")


@query("""SELECT c_custkey AS speaker_id, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, n.o_orderpriority) AS image FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1) n ON o_custkey = c_custkey""")
def enriched_speakers(spark, d):
    """What is missing is filled, what is there stays."""
    s = t(spark, d, "customer").select(F.col("c_custkey").alias("speaker_id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).when(F.col("c_custkey") % 3 == 0, "").alias("image"))
    more = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("speaker_id")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("image"))
    return speakers.enriched(s, more, ["image"])


@query("SELECT c_custkey AS speaker_id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def referenced_speakers(spark, d):
    """Without orphans."""
    return speakers.referenced(t(spark, d, "customer").select(F.col("c_custkey").alias("speaker_id")), t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("speaker_id")))


@query("""WITH u AS (SELECT l_orderkey AS document_id, l_orderkey * 10 + l_linenumber AS id FROM lineitem), keep AS (SELECT max(o_orderkey) AS k FROM orders GROUP BY o_custkey)
    SELECT id FROM u WHERE document_id IN (SELECT o_orderkey FROM orders) AND document_id NOT IN (SELECT k FROM keep) AND id NOT IN (SELECT l_orderkey * 10 + l_linenumber FROM lineitem WHERE l_returnflag = 'R')""")
def superseded_versions(spark, d):
    """Utterances of versions that gave way, unless a candidate refers to them."""
    li, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    keep = o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("document_id")).select("document_id")
    return joins.other_versions(li.select(key.alias("id"), F.col("l_orderkey").alias("document_id")), o.select(F.col("o_orderkey").alias("id")), li.where("l_returnflag = 'R'").select(key.alias("utterance_id")), keep).select("id")


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderdate::VARCHAR || '|' || regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '', 'g') IN (SELECT o_orderdate::VARCHAR || '|' || regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '', 'g') FROM orders WHERE o_orderstatus <> 'O')""")
def superseded_documents(spark, d):
    """Provisional records whose business key a final one has."""
    o = t(spark, d, "orders")
    return joins.superseded(o, F.concat_ws("|", F.col("o_orderdate").cast("string"), text.squashed(F.col("o_orderpriority"))), F.col("o_orderstatus") == "O").select("o_orderkey")


@query("""WITH f AS (SELECT conv_id, turn, role, CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN substr(text, 1, 20) ELSE substr(text, 1, 20) || '!' END AS body FROM conversations),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, body ORDER BY role IS NULL, turn) AS k FROM f), u AS (SELECT * FROM o WHERE k = 1)
    SELECT conv_id, turn FROM u x WHERE NOT EXISTS (SELECT 1 FROM u y WHERE y.conv_id = x.conv_id AND y.turn <> x.turn AND y.body <> '' AND length(x.body) > length(y.body) AND contains(x.body, y.body))""")
def leaf_fragments(spark, d):
    """Fragments that hold no shorter one."""
    k = F.col("turn") % 3
    body = F.when(k == 0, F.col("text")).when(k == 1, F.substring("text", 1, 20)).otherwise(F.concat(F.substring("text", 1, 20), F.lit("!")))
    rows = t(spark, d, "conversations").select("conv_id", "turn", "role", body.alias("body"))
    return segments.leaves(rows, "conv_id", "turn", "body", "role").select("conv_id", "turn")


@query("""WITH h AS (SELECT s_suppkey, s_name, c_custkey, count(*) OVER (PARTITION BY s_suppkey) AS n, sum((c_custkey % 2)::INT) OVER (PARTITION BY s_suppkey) AS m, row_number() OVER (PARTITION BY s_suppkey ORDER BY c_custkey) AS k FROM supplier JOIN customer ON s_nationkey = c_nationkey WHERE contains(c_name, right(s_name, 3)))
    SELECT s_suppkey, max(c_custkey) FILTER (k = 1) AS first_hit, max(c_custkey) FILTER (n = 1 OR (m = 1 AND c_custkey % 2 = 1))::VARCHAR AS unique_hit FROM h GROUP BY 1""")
def witness_match(spark, d):
    """The first listed name that fits, and the only one."""
    s = t(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n"))
    c = t(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n"))
    fits = F.contains("c_name", F.expr("right(s_name, 3)"))
    first = joins.first_hit(s, c, ["n"], fits, "s_suppkey", "c_custkey").select("s_suppkey", F.col("c_custkey").alias("first_hit"))
    only = joins.unique_hit(s, c, ["n"], fits, "s_suppkey", F.col("c_custkey") % 2 == 1).select("s_suppkey", F.col("c_custkey").cast("string").alias("unique_hit"))
    return first.join(only, "s_suppkey", "left")


@query("WITH x AS (SELECT doc_id, unnest(string_split(coalesce(source, ''), 'r')) AS part FROM documents) SELECT part, count(*) AS n FROM x GROUP BY 1")
def exploded_counts(spark, d):
    """A row for each value of an array, counted."""
    rows = t(spark, d, "documents").select(F.split(F.coalesce("source", F.lit("")), "r").alias("parts"))
    return statistics.counted(joins.exploded(rows, "parts", "part"), F.col("part"))


@query("""WITH a AS (SELECT o_custkey AS k, o_orderkey AS pos, 0 AS l FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey, o_orderkey, 1 FROM orders WHERE o_orderstatus <> 'F'), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY l, pos) AS n FROM a) SELECT k, pos FROM r WHERE n = 1""")
def first_seen_union(spark, d):
    """Hits of several searches, each once, in the order they were first seen."""
    o = t(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("pos"), "o_orderstatus")
    return joins.first_seen([o.where("o_orderstatus = 'F'"), o.where("o_orderstatus <> 'F'")], ["k"], "pos").select("k", "pos")


@query("SELECT o_orderkey, (SELECT count(*) FROM orders) > 100 AS truncated FROM (SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100)")
def capped_crawl(spark, d):
    """The first hundred, and whether there were more."""
    return joins.capped(t(spark, d, "orders").select("o_orderkey", "o_orderdate"), 100, F.col("o_orderdate"), F.col("o_orderkey")).select("o_orderkey", "truncated")


@query("SELECT o_orderkey AS id, row_number() OVER (ORDER BY coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END::VARCHAR, '') DESC, o_orderkey DESC) AS place FROM orders")
def payload_order(spark, d):
    """Newest first, rows without a date last; places by the order of the rows."""
    from pyspark.sql import Window

    rows = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).alias("date"))
    ordered = export.payload_order(rows).withColumn("m", F.monotonically_increasing_id())
    return ordered.select("id", F.row_number().over(Window.orderBy("m")).cast("long").alias("place"))


@query("""WITH RECURSIVE l AS (SELECT DISTINCT ps AS a, pt AS b FROM (SELECT l_suppkey * 2 AS ps, l_partkey % 50 * 2 + 1 AS pt FROM lineitem WHERE l_linenumber = 7)), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    r(node, root) AS (SELECT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node) SELECT node, min(root) AS root FROM r GROUP BY 1""")
def link_components(spark, d):
    """Connected components."""
    links = t(spark, d, "lineitem").where("l_linenumber = 7").select((F.col("l_suppkey") * 2).alias("a"), (F.col("l_partkey") % 50 * 2 + 1).alias("b"))
    return connected(links)


@query("""WITH x AS (SELECT doc_id, source, CASE doc_id % 4 WHEN 0 THEN 'uk_' WHEN 1 THEN 'cn_' WHEN 2 THEN 'zz_' ELSE '' END || source AS s FROM documents WHERE source IS NOT NULL)
    SELECT doc_id, CASE WHEN NOT contains(s, '_') THEN 'XX' WHEN split_part(s, '_', 1) = 'uk' THEN 'UK' WHEN split_part(s, '_', 1) = 'cn' THEN 'CN' ELSE 'XX' END AS jurisdiction FROM x""")
def source_jurisdiction(spark, d):
    """by the prefix of a source's name."""
    k = F.col("doc_id") % 4
    name = F.concat(F.when(k == 0, "uk_").when(k == 1, "cn_").when(k == 2, "zz_").otherwise(""), "source")
    return t(spark, d, "documents").where("source is not null").select("doc_id", speakers.jurisdiction(name).alias("jurisdiction"))


@query("""WITH x AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Mr ' || substr(text, 1, 10) || ' asked the Minister' ELSE text END AS s, CASE WHEN doc_id % 5 = 0 THEN 'reported' ELSE 'direct' END AS k FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, k = 'reported' OR regexp_matches(s, '^\\s*(?:Mr|Ms|Mrs|Miss|Mdm|Dr|Prof|Assoc Prof|Er)\\.?\\s+[^,.]{1,60}?\\s+asked\\s+the\\s+', 'i') AS nv FROM x""")
def not_verbatim(spark, d):
    """paraphrased, reported, or told in the third person."""
    i = F.col("doc_id")
    shown = F.when(i % 3 == 0, F.concat(F.lit("Mr "), F.substring("text", 1, 10), F.lit(" asked the Minister"))).otherwise(F.col("text"))
    return t(spark, d, "documents").where("text is not null").select("doc_id", export.not_verbatim(F.when(i % 5 == 0, "reported").otherwise("direct"), shown).alias("nv"))


@query("""WITH x AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Text of the amendment' WHEN 1 THEN 'TEXT OF AMENDMENTS' ELSE 'debate' END AS ctx, CASE o_orderkey % 7 WHEN 0 THEN 'U.S. Senate Committee' WHEN 1 THEN 'Congress' WHEN 2 THEN 'u.s. house clerk' ELSE 'Ms. Roe' END AS sp, CASE WHEN o_orderkey % 2 = 0 THEN 'US' ELSE 'UK' END AS j, CASE WHEN o_orderkey % 11 = 0 THEN 'excluded' ELSE 'accepted' END AS st, o_orderpriority AS src, CASE WHEN o_orderkey % 13 = 0 THEN 'ambiguous' ELSE 'resolved' END AS res FROM orders)
    SELECT o_orderkey FROM x WHERE st <> 'excluded' AND res = 'resolved' AND src <> '5-LOW' AND NOT (j = 'US' AND (lower(ctx) LIKE '%text of%amendment%' OR sp ILIKE 'U.S. Senate%' OR sp ILIKE 'U.S. Congress%' OR sp ILIKE 'U.S. House%' OR sp = 'Congress'))""")
def published_filter(spark, d):
    """status, source, legislative text, resolution."""
    k = F.col("o_orderkey")
    rows = t(spark, d, "orders").select(
        "o_orderkey",
        F.when(k % 6 == 0, "Text of the amendment").when(k % 6 == 1, "TEXT OF AMENDMENTS").otherwise("debate").alias("speech_context"),
        F.when(k % 7 == 0, "U.S. Senate Committee").when(k % 7 == 1, "Congress").when(k % 7 == 2, "u.s. house clerk").otherwise("Ms. Roe").alias("speaker_display"),
        F.when(k % 2 == 0, "US").otherwise("UK").alias("jurisdiction"),
        F.when(k % 11 == 0, "excluded").otherwise("accepted").alias("review_status"),
        F.col("o_orderpriority").alias("source"),
        F.when(k % 13 == 0, "ambiguous").otherwise("resolved").alias("speaker_resolution"),
    )
    return export.published(rows, spark.createDataFrame([("5-LOW",)], "source string")).select("o_orderkey")


@query("""WITH x AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN ' ' || role || ' [V] ' WHEN 1 THEN '[V]' ELSE role END AS s FROM conversations) SELECT conv_id, turn, CASE WHEN trim(regexp_replace(coalesce(s, ''), '\\s*\\[V\\]\\s*$', '')) = '' THEN 'Unknown' ELSE trim(regexp_replace(s, '\\s*\\[V\\]\\s*$', '')) END AS name FROM x""")
def clean_speaker(spark, d):
    """without a trailing mark; Unknown if nothing is left."""
    k = F.col("turn") % 3
    shown = F.when(k == 0, F.concat(F.lit(" "), "role", F.lit(" [V] "))).when(k == 1, "[V]").otherwise(F.col("role"))
    return t(spark, d, "conversations").select("conv_id", "turn", verdicts.squeezed_name(shown).alias("name"))


@query("SELECT doc_id, coalesce(lang, '') NOT IN ('en', 'mul', 'und', '') AS foreign_tag FROM documents")
def needs_translation(spark, d):
    """tagged with a language other than English."""
    return t(spark, d, "documents").select("doc_id", promotion.needs_translation(F.col("lang")).alias("foreign_tag"))


@query("""WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Hearing' ELSE 'Meeting' END AS kind, CASE WHEN o_orderkey % 4 = 0 THEN 'Closed session' ELSE o_orderpriority END AS title, CASE WHEN o_orderkey % 10 = 0 THEN 'soon' ELSE o_orderdate::VARCHAR || 'T09:00' END AS day FROM orders)
    SELECT o_orderkey, kind = 'Hearing' AND NOT contains(upper(title), 'CLOSED') AND coalesce(TRY_CAST(substr(day, 1, 10) AS DATE) BETWEEN DATE '1994-01-01' AND DATE '1996-12-31', false) AS meets, title IN ('1-URGENT', '2-HIGH') OR (title = '5-LOW' AND contains(kind, 'Hear')) AS publication FROM x""")
def scope_filters(spark, d):
    """publications and meetings in scope."""
    k = F.col("o_orderkey")
    rows = t(spark, d, "orders").select("o_orderkey", F.when(k % 3 == 0, "Hearing").otherwise("Meeting").alias("kind"), F.when(k % 4 == 0, "Closed session").otherwise(F.col("o_orderpriority")).alias("title"), F.when(k % 10 == 0, "soon").otherwise(F.concat(F.col("o_orderdate").cast("string"), F.lit("T09:00"))).alias("day"))
    return rows.select("o_orderkey", records.meeting_in_scope(F.col("kind"), F.col("title"), F.col("day"), "1994-01-01", "1996-12-31").alias("meets"), records.in_scope(F.col("title"), F.col("kind"), ["1-URGENT", "2-HIGH"], {"5-LOW": "Hear"}).alias("publication"))


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'disputed' ELSE 'accepted' END AS status FROM documents""")
def disputed_status(spark, d):
    """what the record itself contradicts."""
    meta = F.when(F.col("doc_id") % 4 == 0, '{"continues_previous": true}').when(F.col("doc_id") % 4 == 1, '{"continues_previous": false}').when(F.col("doc_id") % 4 == 2, "{}")
    return t(spark, d, "documents").select("doc_id", records.review_status(meta).alias("status"))


@query("""WITH w AS (SELECT doc_id, regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{M}\\p{N}\\p{Pc}]+') AS ws FROM documents), x AS (SELECT doc_id, len(list_filter(ws, lambda v: v IN ('der', 'und', 'ung'))) AS de, len(list_filter(ws, lambda v: v IN ('le', 'la', 'de'))) AS fr, len(list_filter(ws, lambda v: v IN ('the', 'of', 'to'))) AS en FROM w)
    SELECT doc_id, CASE WHEN greatest(de, fr, en) = 0 THEN NULL WHEN de = greatest(de, fr, en) THEN 'de' WHEN fr = greatest(de, fr, en) THEN 'fr' ELSE 'en' END AS lang FROM x""")
def language_by_words(spark, d):
    """by function words."""
    return t(spark, d, "documents").select("doc_id", records.language_by_words(F.coalesce("text", F.lit("")), {"de": "der|und|ung", "fr": "le|la|de", "en": "the|of|to"}).alias("lang"))


@query("""SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_quantity % 5 <> 0 THEN 'agi=' || (l_quantity % 5)::INT END, CASE WHEN l_partkey % 3 <> 0 THEN 'x:misuse=' || l_partkey % 3 END, CASE WHEN l_suppkey % 2 <> 0 THEN 'r:auditing=' || l_suppkey % 2 END) AS scores FROM lineitem""")
def flat_scores(spark, d):
    """F32: scores other than zero, sub-scores under their prefix."""
    m = export.flat_scores({"agi": (F.col("l_quantity") % 5).cast("int")}, {"misuse": (F.col("l_partkey") % 3).cast("int")}, {"auditing": (F.col("l_suppkey") % 2).cast("int")})
    pairs = F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(pairs, ",").alias("scores"))


@query("""SELECT doc_id, '{"id":' || doc_id || ',"d":' || coalesce('"' || lang || '"', 'null') || CASE WHEN n_chars > 500 THEN ',"ul":' || n_chars ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN ',"cu":"x"' ELSE '' END || '}' AS record FROM documents""")
def compact_records(spark, d):
    """some fields always, others where they say something."""
    i = F.col("doc_id")
    optional = {"ul": export.some(F.when(F.col("n_chars") > 500, F.col("n_chars")).otherwise(0), "number"), "cu": export.some(F.when(i % 3 == 0, "x").when(i % 3 == 1, ""))}
    return t(spark, d, "documents").select("doc_id", export.compact({"id": i, "d": F.col("lang")}, optional).alias("record"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'agi' ELSE '' END ELSE CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'rsi,asi' END END AS topics FROM documents""")
def coarse_topics(spark, d):
    """the refinement's topics if any judge voted, else the first stage's."""
    i = F.col("doc_id")
    agreed = F.when(i % 2 == 0, F.array(F.lit("agi"))).otherwise(F.array().cast("array<string>"))
    first = F.when(i % 5 != 0, F.array(F.lit("rsi"), F.lit("asi")))
    return t(spark, d, "documents").select("doc_id", F.array_join(export.coarse_topics(F.when(i % 3 > 0, i % 3), agreed, first), ",").alias("topics"))


@query("""WITH x AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'PPE' WHEN 1 THEN ' verts/ale ' WHEN 2 THEN 'S&D' ELSE 'none' END AS g FROM documents)
    SELECT doc_id, CASE g WHEN 'PPE' THEN 'EPP' WHEN ' verts/ale ' THEN 'Greens/EFA' ELSE g END AS label, 'member of ' || CASE g WHEN 'PPE' THEN 'EPP' ELSE g END || ' group' AS prose, CASE g WHEN 'PPE' THEN 'EPP' WHEN 'S&D' THEN 'S&D' ELSE '' END AS named FROM x""")
def group_labels(spark, d):
    """Political groups under one label, in fields and in prose."""
    variants = {"EPP": "EPP", "PPE": "EPP", "Verts/ALE": "Greens/EFA", "S&D": "S&D"}
    k = F.col("doc_id") % 4
    g = F.when(k == 0, "PPE").when(k == 1, " verts/ale ").when(k == 2, "S&D").otherwise("none")
    prose = F.concat(F.lit("member of "), g, F.lit(" group"))
    return t(spark, d, "documents").select("doc_id", speakers.group_label(g, variants).alias("label"), speakers.groups_rewritten(prose, variants).alias("prose"), F.array_join(speakers.groups_named(prose, variants), ",").alias("named"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'https://p/' || c_custkey || '/x' END AS url FROM customer")
def profile_urls(spark, d):
    """from ids that fit a pattern."""
    native = F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).otherwise(F.concat(F.lit("x"), F.col("c_custkey").cast("string")))
    return t(spark, d, "customer").select("c_custkey", speakers.profile_url(native, "https://p/{id}/x", r"\d+").alias("url"))


@query("""SELECT c_custkey, c_custkey % 3 <> 2 AS same FROM customer""")
def same_person(spark, d):
    """Folded words of one name within the other's."""
    k = F.col("c_custkey")
    other = F.when(k % 3 == 0, F.concat(F.upper("c_name"), F.lit(" Éclair (minister)"))).when(k % 3 == 1, F.regexp_replace("c_name", "#", " ")).otherwise("Someone Else")
    return t(spark, d, "customer").select("c_custkey", speakers.same_person(F.col("c_name"), other).alias("same"))


@query("""SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', '', 'g') AS squashed, sha256(coalesce(source, '') || chr(31) || coalesce(lang, '') || chr(31) || doc_id) AS key FROM documents""")
def squashed_keys(spark, d):
    """Letters and digits only, and content keys."""
    return t(spark, d, "documents").select("doc_id", text.squashed(F.coalesce("text", F.lit(""))).alias("squashed"), text.content_key(F.col("source"), F.col("lang"), F.col("doc_id")).alias("key"))


@query("""WITH x AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL), p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(replace(text, '. ', chr(10) || ' ' || chr(10)), '\\n\\s*\\n'), lambda s: trim(regexp_replace(regexp_replace(s, '-{2,}', '—', 'g'), '[\\s\\x{A0}]+', ' ', 'g'))), lambda s: s <> '') AS ps FROM x)
    SELECT doc_id, sha256(array_to_string(ps, chr(10) || chr(10))) AS h FROM p""")
def presentable_paragraphs(spark, d):
    """Squeezed paragraphs, one empty line apart."""
    broken = F.replace(F.col("text"), F.lit(". "), F.lit("\n \n"))
    return t(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(text.paragraphs(broken), 256).alias("h"))


@query("""WITH m AS (SELECT doc_id, text, length(text) AS n, length(text) // 2 AS s FROM documents WHERE text IS NOT NULL), w AS (SELECT *, greatest(0, s - 300) AS lo, least(n, s + 20 + 300) AS hi FROM m)
    SELECT doc_id, CASE WHEN lo > 0 THEN '…' ELSE '' END || substr(text, lo + 1, hi - lo) || CASE WHEN hi < n THEN '…' ELSE '' END AS around FROM w""")
def context_window(spark, d):
    """What lies round a span."""
    s = F.floor(F.length("text") / 2).cast("int")
    return t(spark, d, "documents").where("text is not null").select("doc_id", excerpt.context(F.col("text"), F.struct(s.alias("start"), (s + 20).alias("end")), 300, 500).alias("around"))


@query("""WITH x AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(substr(coalesce(text, ''), 21, 30), '^[\\s\\x{A0}]+|[\\s\\x{A0}]+$', '', 'g') AS s FROM documents)
    SELECT doc_id, CASE WHEN s <> '' THEN (instr(text, s) - 1)::VARCHAR END AS "start", CASE WHEN s <> '' THEN (instr(text, s) - 1 + length(s))::VARCHAR END AS "end" FROM x""")
def located_spans(spark, d):
    """Places of spans whose blanks were doubled; a blank span is nowhere."""
    s = F.regexp_replace(F.substring(F.coalesce("text", F.lit("")), 21, 30), " ", "  ")
    rows = t(spark, d, "documents").select("doc_id", excerpt.find_span(F.coalesce("text", F.lit("")), s).alias("f"))
    return rows.select("doc_id", F.col("f.start").cast("string").alias("start"), F.col("f.end").cast("string").alias("end"))


@query("""WITH x AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents), y AS (SELECT *, regexp_replace(substr(text, n // 2 + 1, 40), '^[\\s\\x{A0}]+|[\\s\\x{A0}]+$', '', 'g') AS s FROM x), z AS (SELECT *, CASE WHEN s <> '' THEN instr(text, s) - 1 END AS a, length(s) AS k FROM y),
    r AS (SELECT *, least(n, coalesce(greatest(0, a - (1000 - k) // 2), 0) + 1000) AS hi0 FROM z), l AS (SELECT *, greatest(0, hi0 - 1000) AS lo0, substr(text, greatest(0, hi0 - 80) + 1, least(hi0, 80)) AS tail FROM r),
    w AS (SELECT *, CASE WHEN lo0 > 0 THEN lo0 + length(regexp_extract(substr(text, lo0 + 1, 80), '^([^\\s\\x{A0}]*[\\s\\x{A0}])', 1)) ELSE 0 END AS lo, CASE WHEN hi0 < n AND regexp_matches(tail, '[\\s\\x{A0}]') THEN hi0 - length(regexp_extract(tail, '([^\\s\\x{A0}]*)$', 1)) ELSE hi0 END AS hi FROM l),
    b AS (SELECT *, substr(text, lo + 1, hi - lo) AS body FROM w), c AS (SELECT *, lo + length(regexp_extract(body, '^([\\s\\x{A0}]*)', 1)) AS x0, regexp_replace(body, '^[\\s\\x{A0}]+|[\\s\\x{A0}]+$', '', 'g') AS own FROM b)
    SELECT doc_id, CASE WHEN n <= 1000 THEN text ELSE CASE WHEN x0 > 0 THEN '… ' ELSE '' END || own || CASE WHEN x0 + length(own) < n THEN ' …' ELSE '' END END AS shown, CASE WHEN n <= 1000 THEN a::VARCHAR ELSE (a - x0 + CASE WHEN x0 > 0 THEN 2 ELSE 0 END)::VARCHAR END AS "start" FROM c""")
def excerpt_window(spark, d):
    """Long records cut round a passage, whose place moves along."""
    whole = F.coalesce("text", F.lit(""))
    s = F.substr(whole, F.floor(F.length(whole) / 2).cast("int") + 1, F.lit(40))
    rows = t(spark, d, "documents").select("doc_id", excerpt.excerpt_of(F.col("text"), s, 1000).alias("e"))
    return rows.select("doc_id", F.col("e.text").alias("shown"), F.try_element_at("e.spans", F.lit(1))["start"].cast("string").alias("start"))


@query("""SELECT doc_id, concat_ws('|', CASE WHEN substr(text, 1, 10) <> '' THEN 'plain:' || substr(text, 1, 10) END, CASE WHEN substr(text, 11, 20) <> '' THEN 'mark:' || substr(text, 11, 20) END, CASE WHEN substr(text, 31) <> '' THEN 'plain:' || substr(text, 31) END) AS parts FROM documents WHERE text IS NOT NULL""")
def passage_parts(spark, d):
    """A passage in marked and plain runs."""
    marks = F.array(F.struct(F.lit(10).alias("start"), F.lit(30).alias("end"), F.lit("mark").alias("kind")))
    runs = F.transform(promotion.passage_parts(F.col("text"), marks), lambda p: F.concat(p["kind"], F.lit(":"), p["text"]))
    return t(spark, d, "documents").where("text is not null").select("doc_id", F.array_join(runs, "|").alias("parts"))


@query("""WITH s AS (SELECT o_orderkey, o_orderdate::DATE AS a, o_orderdate::DATE + (o_orderkey % 9)::INT AS z FROM orders), e AS (SELECT o_orderkey, unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM s) SELECT o_orderkey, day::VARCHAR AS day FROM e WHERE isodow(day) < 6""")
def weekday_rows(spark, d):
    """Every weekday of a span."""
    spans = t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("start"), F.expr("date_add(o_orderdate, cast(o_orderkey % 9 as int))").alias("end"))
    return records.weekdays(spans).select("o_orderkey", F.col("day").cast("string"))


@query("""SELECT o_orderkey, ((year(o_orderdate) - CASE WHEN month(o_orderdate) = 1 AND day(o_orderdate) < 3 THEN 1 ELSE 0 END - 1789) // 2 + 1)::BIGINT AS congress, o_orderdate::DATE::VARCHAR AS day, 'day' AS precision FROM orders""")
def dates_from_urls(spark, d):
    """Dates that URLs name, and the congress that sat."""
    url = F.concat(F.lit("https://x/"), F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("/a.html"))
    day, precision = pages.url_date(url)
    return t(spark, d, "orders").select("o_orderkey", pages.congress(day).alias("congress"), day.cast("string").alias("day"), precision.alias("precision"))


@query("""SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day, CASE WHEN o_orderkey % 3 <> 2 THEN o_orderdate::DATE::VARCHAR END AS recovered FROM orders""")
def dates_from_texts(spark, d):
    """A month's name, a meta tag, a dateline."""
    months = {m: i + 1 for i, m in enumerate("января февраля марта апреля мая июня июля августа сентября октября ноября декабря".split())}
    name = F.element_at(F.array(*map(F.lit, months)), F.month("o_orderdate"))
    told = F.concat(F.lit("от "), F.dayofmonth("o_orderdate").cast("string"), F.lit(" "), F.initcap(name), F.lit(" "), F.year("o_orderdate").cast("string"), F.lit(" года"))
    iso, k = F.to_date("o_orderdate").cast("string"), F.col("o_orderkey") % 3
    body = F.when(k == 0, F.concat(F.lit("<meta day='"), iso, F.lit("'>"))).when(k == 1, F.concat(F.lit("City, "), iso, F.lit(" -"))).otherwise("no date")
    return t(spark, d, "orders").select("o_orderkey", pages.month_date(told, months).cast("string").alias("day"), pages.recovered_date(body, "day='([0-9-]+)'", "City, ([0-9-]+)").cast("string").alias("recovered"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'day' ELSE 'month' END AS new_precision FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 = 1 OR o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0")
def reasserted_precision(spark, d):
    """Where the rule says otherwise."""
    k = F.col("o_orderkey")
    docs = t(spark, d, "orders").withColumn("date_precision", F.when(k % 3 == 0, "day").otherwise("month"))
    return records.reasserted(docs, F.when(k % 2 == 0, "day").otherwise("month")).select("o_orderkey", "new_precision")


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'own' WHEN 1 THEN 'english' ELSE 'other' END AS shown FROM documents""")
def preferred_language(spark, d):
    """The asked language, else English, else the first."""
    k = F.col("doc_id") % 3
    own = F.create_map(F.lit("xx"), F.lit("other"), F.lit("en"), F.lit("english"), F.lit("de"), F.lit("own"))
    texts = F.when(k == 0, own).when(k == 1, F.create_map(F.lit("xx"), F.lit("other"), F.lit("en"), F.lit("english"))).otherwise(F.create_map(F.lit("xx"), F.lit("other"), F.lit("yy"), F.lit("more")))
    return t(spark, d, "documents").select("doc_id", pages.preferred(texts, F.lit("de")).alias("shown"))


@query("SELECT regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS url, min(page_id) AS first_id FROM pages GROUP BY 1")
def earliest_capture(spark, d):
    """The first capture of each canonical URL."""
    return pages.earliest(t(spark, d, "pages").select("url", F.col("page_id").alias("first_id")), text.canonical_url(F.col("url")), "first_id")


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN NULL END AS author, CASE c_custkey % 3 WHEN 0 THEN c_name || ' (' || c_nationkey || '), Minister' WHEN 1 THEN c_name || ', Minister' ELSE 'Minister' END AS label, CASE WHEN c_custkey % 2 = 0 THEN 'Jane Roe' END AS speaker FROM customer""")
def speaker_labels(spark, d):
    """Labels composed, authors and speakers read out of titles."""
    k = F.col("c_custkey")
    title = F.when(k % 3 == 0, F.concat(F.lit("Question - "), "c_name")).when(k % 3 == 1, "Question - Rule 136").otherwise("Question")
    name = F.when(k % 3 != 2, F.col("c_name"))
    said = F.when(k % 2 == 0, "Speech on risk by Jane Roe, minister").otherwise("Speech by the Council and others")
    return t(spark, d, "customer").select("c_custkey", pages.last_field(title).alias("author"), pages.label(name, F.when(k % 3 == 0, F.col("c_nationkey").cast("string")), F.lit("Minister")).alias("label"), pages.title_speaker(said).alias("speaker"))


@query("""SELECT c_custkey, c_custkey % 3 = 0 AS is_label, CASE WHEN c_custkey % 2 = 0 THEN '羅智強 (委員)' ELSE c_name END AS normal, 'Jan van ' || c_custkey AS assembled FROM customer""")
def speaker_names(spark, d):
    """Labels told from prose, titles moved behind, names assembled."""
    k = F.col("c_custkey")
    line = F.when(k % 3 == 0, "Mr Speaker").when(k % 3 == 1, "APPLAUSE").otherwise("A line of prose, no more")
    return t(spark, d, "customer").select("c_custkey", pages.is_label(line, "Mr|Ms", ["applause"]).alias("is_label"), pages.normal_label(F.when(k % 2 == 0, "羅委員智強").otherwise(F.col("c_name")), "委員").alias("normal"), pages.assembled_name(F.lit("Jan"), F.lit("Van"), F.when(k % 2 == 0, k.cast("string")).otherwise(k.cast("string"))).alias("assembled"))


@query("""WITH s AS (SELECT conv_id, turn, CASE WHEN turn % 4 = 0 THEN 1 WHEN turn % 4 = 3 THEN 0 END AS st, role, text FROM conversations), r AS (SELECT *, last_value(st IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM s) SELECT conv_id, turn FROM r WHERE coalesce(state, 0) = 0""")
def lines_without_blocks(spark, d):
    """Blocks that an opening line starts and tail lines carry on."""
    k = F.col("turn") % 4
    return segments.without_blocks(t(spark, d, "conversations"), "conv_id", "turn", k == 0, (k == 1) | (k == 2)).select("conv_id", "turn")


@query("""WITH s AS (SELECT conv_id, turn, last_value(CASE WHEN turn % 3 = 0 THEN role END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM conversations) SELECT conv_id, turn, held, held = 'user' AS leads FROM s WHERE held IS NOT NULL""")
def floor_holder(spark, d):
    """Values carried on, and who holds the floor."""
    rows = t(spark, d, "conversations").withColumn("held", F.when(F.col("turn") % 3 == 0, F.col("role")))
    carried = segments.carried(rows, "conv_id", "turn", "held").where("held is not null").select("conv_id", "turn", "held")
    leads = segments.holding_floor(rows, "conv_id", "turn", F.col("held"), F.lit("user")).select("conv_id", "turn", F.lit(True).alias("leads"))
    return carried.join(leads, ["conv_id", "turn"], "left").withColumn("leads", F.coalesce("leads", F.lit(False)))


@query("""WITH x AS (SELECT doc_id, '12' || chr(10) || replace(text, '. ', '.' || chr(10) || chr(10)) AS s FROM documents WHERE text IS NOT NULL), l AS (SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(s, '\\r?\\n'), lambda r: NOT regexp_matches(r, '^\\s*\\d+\\s*$')), chr(10)) AS s FROM x),
    p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(s, '\\n\\s*\\n'), lambda r: trim(regexp_replace(r, '[\\s\\x{A0}]+', ' ', 'g'))), lambda r: r <> '') AS ps FROM l) SELECT doc_id, sha256(array_to_string(ps, chr(10) || chr(10))) AS h FROM p""")
def reflowed_prose(spark, d):
    """Wrapped prose as paragraphs, lines of digits gone."""
    broken = F.concat(F.lit("12\n"), F.replace(F.col("text"), F.lit(". "), F.lit(".\n\n")))
    return t(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(segments.reflowed(broken), 256).alias("h"))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Jane Roe' WHEN 1 THEN NULL ELSE 'John Doe' END AS author FROM documents""")
def statement_authors(spark, d):
    """The name after a role in a statement's head."""
    k = F.col("doc_id") % 3
    head = F.when(k == 0, "STATEMENT OF Chairman Jane Roe Committee on Rules").when(k == 1, "No role here").otherwise("by Senator John Doe, who said")
    return t(spark, d, "documents").select("doc_id", records.statement_author(F.concat(head, F.lit(" "), F.coalesce(F.lower("text"), F.lit(""))), "Chairman|Senator", "Committee").alias("author"))


@query("""SELECT doc_id, 'a b ' || doc_id || ' c' AS flat, 'AIactof' || doc_id AS slug, 'one' || chr(10) || 'two' AS clean FROM documents""")
def markup_texts(spark, d):
    """Tags to text, titles to slugs, editorial marks gone."""
    i = F.col("doc_id").cast("string")
    return t(spark, d, "documents").select("doc_id", pages.flattened(F.concat(F.lit("<p>a</p><div>b <i>"), i, F.lit("</i></div> c"))).alias("flat"), records.url_slug(F.concat(F.lit("AI act, of "), i)).alias("slug"), records.markup_clean(F.lit("one<br/>[DE]<b>two</b>")).alias("clean"))


@query("""SELECT doc_id, '{"a":' || doc_id || '}' AS found FROM documents""")
def json_in_answers(spark, d):
    """The JSON object in a model's answer."""
    j = F.concat(F.lit('{"a":'), F.col("doc_id").cast("string"), F.lit("}"))
    k = F.col("doc_id") % 3
    return t(spark, d, "documents").select("doc_id", verdicts.json_in(F.when(k == 0, F.concat(F.lit("so:\n```json\n"), j, F.lit("\n``` done"))).when(k == 1, F.concat(F.lit("I say "), j, F.lit("."))).otherwise(j)).alias("found"))


@query("""SELECT doc_id, CASE WHEN doc_id % 7 = 0 OR n_chars % 101 > 100 OR doc_id % 11 = 0 THEN NULL ELSE (n_chars % 101)::VARCHAR END AS x_risk FROM documents""")
def verdict_validation(spark, d):
    """verdicts with a missing, unknown or impossible field are none."""
    i = F.col("doc_id")
    score = F.when(i % 11 == 0, 101).otherwise(F.col("n_chars") % 101).cast("int")
    zero = [F.lit(0).alias(k) for k in ("ai", "agi", "asi", "rsi", "regulation")]
    raw = F.to_json(F.struct(F.struct(*zero, score.alias("x_risk")).alias("relevance"), F.lit("r").alias("rationale"), F.lit("q").alias("quote_span"), F.lit(True).alias("is_substantive"), F.lit(True).alias("speaker_owns_statement"), F.lit("direct").alias("quote_type"), F.lit(True).alias("speaker_in_scope"), F.when(i % 7 == 0, "odd").otherwise("mixed").alias("stance"), F.lit("c").alias("context_note")))
    return t(spark, d, "documents").select("doc_id", verdicts.parsed_verdict(raw)["relevance"]["x_risk"].cast("string").alias("x_risk"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'agi,regulation' END AS coarse, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN 'toxic_content' ELSE 'agi' END AS primary_topic FROM documents""")
def refinement_validation(spark, d):
    """canonical topics, a generic primary made specific, unknown slugs refused."""
    i = F.col("doc_id")
    raw = F.to_json(F.struct(F.array(F.lit("regulation"), F.lit("agi"), F.lit("agi")).alias("coarse_topics"), F.array(F.when(i % 5 == 0, "nonsense").otherwise("toxic_content")).alias("risk_subdomains"), F.array().cast("array<string>").alias("policy_instruments"), F.when(i % 2 == 0, "x_risk").otherwise("agi").alias("primary_topic"), F.lit("r").alias("rationale"), F.lit("q").alias("display_quote")))
    v = verdicts.parsed_refinement(raw)
    return t(spark, d, "documents").select("doc_id", F.array_join(v["coarse_topics"], ",").alias("coarse"), v["primary_topic"].alias("primary_topic"))


@query("""SELECT doc_id, 'Jurisdiction: UK' || chr(10) || 'Speaker: ' || coalesce(source, 'UNKNOWN') || chr(10) || 'Date: None' || chr(10) || 'Setting: unknown' || chr(10) || 'Record: verbatim' || chr(10) || 'Language: ' || coalesce(lang, '') || chr(10) || chr(10) || coalesce(text, '') AS message FROM documents""")
def judge_messages(spark, d):
    """The judge's view of a passage."""
    null = F.lit(None).cast("string")
    return t(spark, d, "documents").select("doc_id", verdicts.user_message(F.lit("UK"), F.col("source"), null, null, F.lit(True), F.col("lang"), F.coalesce("text", F.lit(""))).alias("message"))


@query("""WITH x AS (SELECT o_orderkey, o_orderpriority AS message, sha256('m' || chr(31) || 's' || chr(31) || o_orderpriority) AS cache_key FROM orders) SELECT o_orderkey, cache_key, CASE WHEN message = '1-URGENT' THEN 'known' ELSE 'asked ' || message END AS raw_response FROM x""")
def judged_once(spark, d):
    """Each distinct message is asked about once, known answers are joined."""
    import pandas as pd

    rows = t(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    known = spark.range(1).select(text.content_key(F.lit("m"), F.lit("s"), F.lit("1-URGENT")).alias("cache_key"), F.lit("known").alias("raw_response"))

    def judge(batch: pd.DataFrame) -> pd.Series:
        return "asked " + batch["message"]

    return verdicts.judged(rows, judge, F.col("o_orderpriority"), "s", "m", known).select("o_orderkey", "cache_key", "raw_response")


@query("""WITH q AS (SELECT c_custkey AS candidate_id, CAST(c_nationkey AS VARCHAR) AS span_key FROM customer), m AS (SELECT CAST(s_nationkey AS VARCHAR) AS span_key, count(DISTINCT s_name) AS n FROM supplier GROUP BY 1) SELECT candidate_id, coalesce(n, 0) AS n_mirrors FROM q LEFT JOIN m USING (span_key)""")
def promoted_mirrors(spark, d):
    """Duplicates become mirrors of the quote they repeat, once each."""
    q = t(spark, d, "customer").select(F.col("c_custkey").alias("candidate_id"), F.col("c_nationkey").cast("string").alias("span_key"), F.expr("cast(array() as array<struct<source:string,url:string,date:date>>)").alias("mirrors"))
    s = t(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("span_key"), F.col("s_name").alias("source"), F.lit("u").alias("url"), F.lit(None).cast("date").alias("date"))
    return promotion.with_promoted_mirrors(q, s.unionByName(s)).select("candidate_id", F.size("mirrors").cast("long").alias("n_mirrors"))


@query("""SELECT c_custkey AS candidate_id, substr(sha256(CASE WHEN c_custkey % 2 = 0 THEN 'Canon ' || c_custkey ELSE c_name END || chr(31) || CASE WHEN c_custkey % 3 = 0 THEN 'kept' ELSE substr(sha256(replace(lower(c_mktsegment || ' said'), ' ', '')), 1, 32) END), 1, 32) AS span_key FROM customer""")
def rekeyed_quotes(spark, d):
    """Keys with canonical names, after linking."""
    k = F.col("c_custkey")
    q = t(spark, d, "customer").select(k.alias("candidate_id"), k.alias("speaker_id"), F.col("c_name").alias("speaker_display"), F.when(k % 3 == 0, "kept").alias("statement_key"), F.concat("c_mktsegment", F.lit(" said")).alias("quote_original"))
    names = t(spark, d, "customer").where("c_custkey % 2 = 0").select(k.alias("speaker_id"), F.concat(F.lit("Canon "), k.cast("string")).alias("canonical_name"))
    return promotion.rekeyed(q, names).select("candidate_id", "span_key")


@query("SELECT c_custkey AS candidate_id, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'disputed' ELSE 'accepted' END AS review_status FROM customer")
def disputed_quotes(spark, d):
    """What a skeptic refuted."""
    q = t(spark, d, "customer").select(F.col("c_custkey").alias("candidate_id"), F.lit("accepted").alias("review_status"))
    return promotion.disputed(q, t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("candidate_id")))


@query("""WITH x AS (SELECT doc_id, lang, doc_id % 4 AS k, regexp_replace(substr(coalesce(text, ''), 1, 20), '^[\\s\\x{A0}]+|[\\s\\x{A0}]+$', '', 'g') AS s FROM documents)
    SELECT doc_id, CASE WHEN k = 0 OR s = '' THEN 'display_quote is not spliced from the passage' WHEN lang IS NOT NULL AND lang <> 'en' AND k <> 1 THEN 'display_quote_en is missing' WHEN k = 1 THEN 'the quote has 151 words' END AS problem FROM x""")
def refinement_problems(spark, d):
    """Why a refinement fails its guards."""
    k = F.col("doc_id") % 4
    shown = F.when(k == 0, "words that nobody ever said zzz").otherwise(F.regexp_replace(F.substring("text", 1, 20), r"(?U)^\s+|\s+$", ""))
    v = F.struct(shown.alias("display_quote"), F.when(k == 1, F.repeat(F.lit("w "), 151)).alias("display_quote_en"))
    return t(spark, d, "documents").select("doc_id", promotion.refinement_problem(v, F.col("text"), F.col("lang")).alias("problem"))


@query("""WITH {log}, g AS (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY prompt = 'p' DESC, id DESC) AS k FROM log WHERE has) SELECT o_orderkey AS candidate_id, g.id IS NOT NULL AS refined FROM orders LEFT JOIN g ON candidate_id = o_orderkey AND k = 1""".replace("{log}", _LOG))
def refined_quotes(spark, d):
    """Quotes with their best refinement, if there is one."""
    log = _log(spark, d).withColumn("verdict", F.when(F.col("verdict").isNotNull(), '{"risk_subdomains":[],"policy_instruments":[],"primary_topic":"agi","display_quote":"q","coarse_topics":["agi"]}'))
    q = t(spark, d, "orders").select(F.col("o_orderkey").alias("candidate_id"))
    return promotion.refined_rows(q, log, "p").select("candidate_id", F.col("refined").isNotNull().alias("refined"))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'a,b' WHEN 1 THEN 'c,b,c' ELSE 'c' END AS chosen FROM documents""")
def applied_labels(spark, d):
    """Labels that the judge chose, without a primary that code appended."""
    k = F.col("doc_id") % 3
    a = lambda *xs: F.array(*map(F.lit, xs))
    labels = F.when(k == 0, a("a", "b", "c")).when(k == 1, a("c", "b", "c")).otherwise(a("c"))
    return t(spark, d, "documents").select("doc_id", F.array_join(promotion.applied_labels(labels, F.lit("c"), ["a", "b", "c"]), ",").alias("chosen"))


@query("""WITH s AS (SELECT doc_id, quality AS j, CASE doc_id % 5 WHEN 0 THEN 'unsure' WHEN 1 THEN 'disagree' WHEN 2 THEN NULL ELSE 'agree' END AS a FROM labels) SELECT count(a) AS done, count(*) AS total, count(*) FILTER (a = 'unsure') AS unsure FROM s""")
def review_progress(spark, d):
    """Done, total and unsure."""
    k = F.col("doc_id") % 5
    rows = t(spark, d, "labels")
    told = rows.select("doc_id", F.when(k == 0, "unsure").when(k == 1, "disagree").when(k != 2, "agree").alias("agreement")).where("agreement is not null")
    return sampling.progress(rows, told, ["doc_id"])


@query("""WITH o AS (SELECT doc_id, 'agree' AS a, 'note ' || doc_id AS note FROM labels WHERE doc_id % 2 = 0), n AS (SELECT doc_id, 'disagree' AS a, CASE WHEN doc_id % 4 = 0 THEN 'newer' END AS note FROM labels WHERE doc_id % 3 = 0) SELECT doc_id, coalesce(n.a, o.a) AS agreement, coalesce(n.note, o.note) AS note FROM o FULL JOIN n USING (doc_id)""")
def label_upsert(spark, d):
    """Newer answers win, notes stay."""
    rows, i = t(spark, d, "labels"), F.col("doc_id")
    old = rows.where(i % 2 == 0).select("doc_id", F.lit("agree").alias("agreement"), F.concat(F.lit("note "), i.cast("string")).alias("note"))
    new = rows.where(i % 3 == 0).select("doc_id", F.lit("disagree").alias("agreement"), F.when(i % 4 == 0, "newer").alias("note"))
    return sampling.labelled(old, new, ["doc_id"])


@query("""WITH p AS (SELECT avg(quality)::DOUBLE AS share FROM labels), m AS (SELECT count(*) FILTER (quality = 1 AND toxic = 0) / count(*) FILTER (quality = 1) AS pr, count(*) FILTER (quality = 0 AND toxic = 1) / count(*) FILTER (quality = 0) AS npv FROM labels) SELECT round(share * pr + (1 - share) * npv, 4) AS estimate FROM p, m""")
def corpus_estimate(spark, d):
    """Agreement over the whole corpus from precision, NPV and the share of accepts."""
    q, ok = F.col("quality") == 1, F.col("toxic") == 0
    m = t(spark, d, "labels").agg(F.avg("quality").alias("share"), (F.count_if(q & ok) / F.count_if(q)).alias("p"), (F.count_if(~q & ~ok) / F.count_if(~q)).alias("n"))
    return m.select(statistics.corpus_estimate(F.col("share"), F.col("p"), F.col("n")).alias("estimate"))


@query("""WITH r AS (SELECT l_returnflag AS family, l_linestatus = 'F' AS j, l_partkey % 2 = 0 AS h, 1 / l_quantity AS p FROM lineitem WHERE l_suppkey % 7 <> 0), g AS (SELECT family, count(*) AS n, count(*) FILTER (j AND h) AS tp, count(*) FILTER (j) AS a, count(*) FILTER (h) AS hu, count(*) FILTER (NOT j AND NOT h) AS tn, count(*) FILTER (NOT j) AS lo, sum(1 / p) FILTER (NOT j) AS w, sum(1 / p) FILTER (NOT j AND NOT h) AS wa, count(*) FILTER (NOT j AND h) AS misses FROM r GROUP BY 1),
    k AS (SELECT *, (tp + tn) / n AS po, (a * hu + lo * (n - hu)) / (n * n) AS pe FROM g) SELECT family, n, round(CASE WHEN a > 0 THEN tp / a END, 4) AS precision, round(CASE WHEN lo > 0 THEN tn / lo END, 4) AS npv, round(CASE WHEN w > 0 THEN wa / w END, 4) AS npv_reweighted, round(CASE WHEN pe < 1 THEN (po - pe) / (1 - pe) END, 4) AS kappa, misses::INTEGER AS misses FROM k""")
def family_rates(spark, d):
    """Rates of each family of labels."""
    rows = t(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("family"), (F.col("l_linestatus") == "F").alias("applied"), (F.col("l_partkey") % 2 == 0).alias("human_applies"), F.when(F.col("l_suppkey") % 7 == 0, "unsure").otherwise("agree").alias("agreement"),
        (1 / F.col("l_quantity")).alias("sel_p"), F.col("l_linestatus").alias("label"), F.lit("XX").alias("jurisdiction"), F.col("l_orderkey").alias("candidate_id"), F.lit("n").alias("note"),
    )
    return statistics.family_rates(rows).withColumn("misses", F.size("misses")).drop("false_applications")


@query("""SELECT o_custkey, id, o_orderstatus AS version FROM (SELECT o_custkey, o_orderkey AS id, o_orderstatus, o_orderkey % 4 = 0 AS judged FROM orders) WHERE o_orderstatus = 'O' OR judged""")
def pruned_candidates(spark, d):
    """without candidates of old versions that nobody judged."""
    c = t(spark, d, "orders").select("o_custkey", F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("keyword_version"))
    return keywords.pruned(c, c.where("id % 4 = 0").select(F.col("id").alias("candidate_id")), "O").withColumnRenamed("keyword_version", "version")


@query("""WITH x AS (SELECT doc_id, source, lang, lower(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) AS k, length(coalesce(text, '')) AS n FROM documents),
    e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.source = b.source AND a.lang = b.lang AND a.doc_id <> b.doc_id AND length(b.k) >= 120 AND contains(a.k, b.k)),
    l AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (WITH RECURSIVE r(node, root) AS (SELECT a, a FROM l UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node) SELECT node, min(root) AS root FROM r GROUP BY 1),
    g AS (SELECT x.doc_id, x.n, coalesce(r.root, x.doc_id) AS root, x.source FROM x LEFT JOIN r ON node = doc_id), p AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY n DESC, source, doc_id) AS place, count(*) OVER (PARTITION BY root) AS size FROM g)
    SELECT doc_id, (size - 1)::INTEGER AS n_mirrors FROM p WHERE place = 1""")
def containment_collapse(spark, d):
    """A22, J11, W06, X05 with containment links: copies and contained texts of a group become one row."""
    rows = t(spark, d, "documents").withColumn("k", F.lower(text.squeeze(F.coalesce("text", F.lit("")))))
    links = mirrors.containment_links(rows, "doc_id", ["source", "lang"], "k")
    kept, _ = mirrors.collapsed(rows.drop("k"), "doc_id", links, mirrors.survivor_rank(F.col("text"), F.lit("day"), F.lit(None), F.col("source")), {"source": F.col("source")})
    return kept.select("doc_id", "n_mirrors")


@query("""WITH q AS (SELECT 'u' || (doc_id % 500) AS url, coalesce(text, '') AS text FROM documents) SELECT count(*) AS n FROM (SELECT DISTINCT substr(sha256(url || chr(31) || trim(regexp_replace(regexp_replace(substr(text, 1, 40), '-{2,}', '—', 'g'), '[\\s\\x{A0}]+', ' ', 'g'))), 1, 16) AS id FROM q)""")
def public_ids(spark, d):
    """Ids of statements, by where and what."""
    rows = t(spark, d, "documents")
    key = text.public_id(F.concat(F.lit("u"), (F.col("doc_id") % 500).cast("string")), text.presentable(F.substring("text", 1, 40)))
    return rows.select(key.alias("id")).distinct().agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey AS candidate_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ORDER BY 1 LIMIT 50""")
def pending_limit(spark, d):
    """The first fifty by id of those without a resolving verdict."""
    log = t(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("candidate_id"), F.lit("{}").alias("verdict"), F.lit("primary").alias("role"), F.lit(True).alias("accept"), F.lit("p").alias("prompt_sha256"))
    return verdicts.pending(t(spark, d, "orders").select(F.col("o_orderkey").alias("id")), log, "p", limit=50).select(F.col("id").alias("candidate_id"))


@query("""WITH x AS (SELECT doc_id, lower(coalesce(lang, 'none')) AS slug FROM documents) SELECT doc_id, 'language-' || slug || '-e' AS slug, CASE WHEN slug = 'en' THEN '<b>en</b> &lt;x&gt;' ELSE slug || ' &lt;x&gt;' END AS bold FROM x""")
def folded_texts(spark, d):
    """Slugs without accents, phrases in bold."""
    name = F.coalesce("lang", F.lit("none"))
    return t(spark, d, "documents").select("doc_id", folding.slug(F.concat(F.lit("Language: "), name, F.lit(" É!"))).alias("slug"), folding.bold(F.concat(name, F.lit(" <x>")), F.array(F.lit("EN"))).alias("bold"))
