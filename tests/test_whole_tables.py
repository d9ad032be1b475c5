"""Queries over whole tables, beside those that are asked over a part."""

from conftest import DATA
from veriloom.plans import QUERIES


def test_words_of_all_documents(spark):
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    assert QUERIES["word_count_all"](spark, DATA).count() == d.count()


def test_words_of_other_scripts(spark, tmp_path):
    rows = [(1, "Größe été naïve", "de"), (2, "人工智能 AI", None), (3, None, "en"), (4, "a_b [...] 12", "fr")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["n_words"] for r in QUERIES["word_count_all"](spark, str(tmp_path)).collect()} == {1: 3, 2: 5, 3: 0, 4: 3}


def test_scan_of_all_languages(spark, tmp_path):
    rows = [(1, "keitsch", "de", "s"), (2, "ouion", "fr", "s"), (3, "mentedo", "es", "s"), (5, "keitsch", None, "s"), (6, "a clown", "en", "s"), (7, "keitsch", "en", "s"), (8, "ouion", "fr", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r["doc_id"] for r in QUERIES["candidate_scan_all"](spark, str(tmp_path)).collect()) == [1, 2, 3, 5, 6]


def test_weights_of_all_labels(spark):
    brands = {r["p_brand"] for r in spark.read.parquet(f"{DATA}/part.parquet").collect()}
    assert {r["label"] for r in QUERIES["negative_weights_all"](spark, DATA).select("label").distinct().collect()} == brands


def test_pending_reads_the_whole_log(spark, tmp_path):
    spark.createDataFrame([(1,), (2,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(5, 1, "F", "1-URGENT"), (4, 2, "F", "1-URGENT")], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    assert [r["id"] for r in QUERIES["pending_candidates_all"](spark, str(tmp_path)).collect()] == [2]
