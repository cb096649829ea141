"""Documents to training sequences: toxic ones go, near-copies go, personal data is masked, and
what is left is packed. Each stage reads all rows that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import packing, private_spans, prob_minhash, toxicity
from ledgerloom.llm._common import fold, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is under ``toxicity.REJECT``; the model learns from the labelled
    rows among ``docs`` outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold("doc_id", 3) != 1)
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    return toxicity.score(docs, model).where(F.col("toxic_score") < toxicity.REJECT).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the least doc_id of each class of near-duplicates."""
    return prob_minhash.keep_one(docs)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data in text replaced by its kind."""
    return private_spans.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: its tokens' digest, its sequence and its place in it."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("private", mask_private), ("packing", pack_sequences)]

ORACLE_SQL = None  # a trained model, sketches and a packing: tests/llm holds the run against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
