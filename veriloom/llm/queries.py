"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    return identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import dedup_digests

    return dedup_digests(table(spark, sf_dir, "documents"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_decode_digests

    return encode_decode_digests(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pii_digests

    return pii_digests(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_render import extract

    return extract(table(spark, sf_dir, "pages"))


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .knlm import score, train
    from .langid import fold

    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(fold(parts=7) == 2, F.lit(False))
    marks = score(docs, train(docs.where(~held)))
    return marks.withColumn("held_out", held).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows.where(F.col("vec_id") % 100 == 0), rows, 10)


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": r"""
            WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
            SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
            FROM n WINDOW w AS (PARTITION BY t)""",
        "op10_nearest_neighbours": """
            WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
                       WHERE embedding IS NOT NULL AND len(embedding) > 0
                         AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
                         AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0),
            p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])), lambda a, b: a + b)) AS score
                  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
            r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM p)
            SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""",
    }
