"""The corpus queries, one per operator, over the whole tables; and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_pairs, edit_embedding, hidden_markov, packing, pivot_search, private_spans, prob_minhash, secret_scan, toxicity, url_filter
from ._common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxic_spans_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold("doc_id", 3) != 1)
    scored = toxicity.score(docs, toxicity.train(docs, labels), spans=True)
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= toxicity.REJECT).cast("int").alias("predicted"),
        F.array_join(F.transform("toxic_spans", lambda x: F.concat_ws(":", x.start.cast("string"), x.end.cast("string"))), ",").alias("spans"),
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pairs.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op3_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prob_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.fingerprints(table(spark, sf_dir, "documents"), near=True)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_hidden_markov_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_spans.find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("found")


def op8_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return pivot_search.top_k(rows, F.pmod("vec_id", F.lit(50)) == 0)


def op9_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan_documents(docs, secret_scan.train(docs))


def op10_url_words_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_toxic_spans_crf, op2_byte_bpe, op3_prob_minhash, op4_edit_embedding, op5_best_fit_packing, op6_hidden_markov_lm, op7_bootstrapped_pii, op8_pivot_topk, op9_secret_crf, op10_url_words_bayes)}
ORACLE_SQL: dict[str, str] = {
    "op8_pivot_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), p AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
