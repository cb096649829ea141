"""Every operator over names that clash, one id for many rows, very long texts, nulls and no rows."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import byte_pairs, edit_embedding, hidden_markov, packing, private_spans, prob_minhash, secret_scan, toxicity, url_filter
from ledgerloom.llm._common import fold

NAMES = "uid key name keys sig w z row t base maybe found sequence_id offset piece score toxic_score spans hit symbols h n k p class_id links url host path verdict rule toxic _text _t _h".split()


@pytest.fixture(scope="module")
def crowded(spark, prose):
    """Twenty rows of one id, one text of half a million characters, nulls, and every internal name."""
    rows = [(7, f"{prose(30, i)} call +1 (555) 123-456{i % 10} token = {'ab12' * 4}{i}") for i in range(20)]
    rows += [(1, prose(80_000, 3)), (2, None), (None, ""), (3, "x" * 100_000), (4, " " * 50_000 + "end"), (5, prose(30, 5)), (5, prose(30, 5))]
    return spark.createDataFrame([(*r, *(f"{c}!" for c in NAMES)) for r in rows], "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in NAMES))


OPERATORS = {
    "digests": lambda d: byte_pairs.digests(d, P.path("byte_bpe_multi_50k.tiktoken")),
    "near": prob_minhash.near_duplicates,
    "fingerprints": lambda d: edit_embedding.fingerprints(d, near=True),
    "classes": edit_embedding.near_classes,
    "language": lambda d: hidden_markov.score(d, fold("doc_id", 7) == 2),
    "private": private_spans.find,
    "secrets": lambda d: secret_scan.scan_documents(d, secret_scan.train(d)),
    "toxic": lambda d: toxicity.score(d, toxicity.train(d, d.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_stay(crowded, name):
    out = OPERATORS[name](crowded)
    assert sorted(map(str, (r["doc_id"] for r in out.select("doc_id").collect()))) == sorted(map(str, (r["doc_id"] for r in crowded.select("doc_id").collect())))
    assert OPERATORS[name](crowded.limit(0)).count() == 0


def test_packing_keeps_every_document(crowded):
    out = packing.pack_documents(crowded, P.path("byte_bpe_50k.json"))
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in crowded.collect()}
    assert out.where("start = 0").count() == crowded.count()
    assert packing.pack_documents(crowded.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_stages_keep_columns(crowded):
    once = prob_minhash.keep_one(crowded)
    assert once.columns == crowded.columns and once.where("doc_id = 5").count() == 1 and once.where("_h <> '_h!' or uid <> 'uid!' or sig <> 'sig!'").count() == 0
    masked = private_spans.redact(crowded)
    assert masked.columns == crowded.columns and masked.count() == crowded.count()
    assert masked.where("doc_id = 7 and text not like '%<PHONE>%'").count() == 0 and masked.where("text is null").count() == 1
    assert masked.where(" or ".join(f"`{c}` <> '{c}!'" for c in NAMES)).count() == 0


def test_urls_with_names_that_clash(spark, crowded):
    pages = crowded.withColumn("page_id", F.col("doc_id")).withColumn("url", F.concat(F.lit("http://a.net/es/"), F.col("doc_id").cast("string")))
    out = url_filter.judge(pages)
    assert out.count() == crowded.count() and out.columns[0] == "page_id"


def test_texts_that_no_sample_holds(spark, prose, monkeypatch):
    """Samples pass over what does not fit, and go on."""
    monkeypatch.setattr(hidden_markov, "START_TEXT", 20)
    monkeypatch.setattr(secret_scan, "SAMPLE_CHARS", 2000)
    rows = [(i, prose(40, i) + f" password={'q7' * 6}{i}" * (i % 3 == 0)) for i in range(30)] + [(99, prose(3000, 4) + " secret: " + "z9" * 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert hidden_markov.score(docs, F.lit(False)).where("score < 0").count() == 31
    assert secret_scan.train(docs).trans is not None
