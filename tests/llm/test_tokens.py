import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import byte_pairs, packing

from .conftest import ODD

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
TEXTS = [t or "" for t in ODD] + ["a  b", "x \n y", "\n\n a", "  a", "foo\n bar", "don't <|endoftext|> it's", "1 2 3  ", "a\x1c b c", "日本語 テスト", "a  b", "tab\t x"]


def test_parts_make_the_same_ids():
    enc = byte_pairs.encoding(RANKS)
    text = "some words, and more;  with\n lines " * 300
    cut = byte_pairs.parts(text, 100)
    assert "".join(cut) == text and len(cut) > 50
    assert [i for x in cut for i in enc.encode_ordinary(x)] == enc.encode_ordinary(text)


def test_round_trip_and_digests(odd, none):
    rows = byte_pairs.digests(odd, RANKS).collect()
    enc = byte_pairs.encoding(RANKS)
    assert len(rows) == odd.count() and byte_pairs.digests(none, RANKS).count() == 0
    want = {}
    for r in odd.collect():
        ids = np.array(enc.encode_ordinary(r["text"] or ""), "<u4")
        want.setdefault(r["doc_id"], set()).add((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) in want[r["doc_id"]] for r in rows)


def test_general_encode_and_decode(odd):
    out = byte_pairs.decode_ids(byte_pairs.encode_documents(odd, RANKS).drop("decoded"), RANKS)
    texts = sorted((r["text"] or "").encode() for r in odd.collect())
    assert sorted(bytes(r["decoded"]) for r in out.collect()) == texts


def test_word_by_word_ids_are_the_tokenizers_ids():
    own = Tokenizer.from_file(JSON)
    got = packing.token_ids(pa.array(TEXTS, pa.string()), JSON)
    assert [x.tolist() for x in got] == [own.encode(t, add_special_tokens=False).ids for t in TEXTS]


RUNS = [" ", "\n", "\r\n", "\u2003 ", "a", "7", "!", "\u00e9"]


@pytest.mark.parametrize("unit", RUNS)
@pytest.mark.parametrize("tail", ["", "word", "  "])
def test_long_runs(unit, tail):
    """Runs of one kind, as long as no expression survives; shorter ones give the library's ids."""
    enc, own = byte_pairs.encoding(RANKS), Tokenizer.from_file(JSON)
    text = "head 's x" + unit * 30_000 + tail + unit * 12_000 + "a b" + unit * 11_000
    assert byte_pairs.encode(text, enc).tolist() == enc.encode_ordinary(text)
    assert packing.token_ids(pa.array([text, "q " + text]), JSON)[0].tolist() == own.encode(text, add_special_tokens=False).ids
    long = "x" + unit * (3_000_000 // len(unit)) + tail
    ids = byte_pairs.encode(long, enc)
    assert byte_pairs.decode(ids, enc) == long.encode()
    assert packing.token_ids(pa.array([long]), JSON)[0].tolist() == own.encode(long, add_special_tokens=False).ids


def test_a_vocabulary_that_does_not_part_at_spaces(monkeypatch):
    monkeypatch.setattr(packing, "_spaced", lambda path: np.zeros(60_000, bool))
    own = Tokenizer.from_file(JSON)
    assert packing.token_ids(pa.array(["a b c"]), JSON)[0].tolist() == own.encode("a b c", add_special_tokens=False).ids


@pytest.mark.parametrize(("n", "pieces"), [(1, [(0, 1)]), (10, [(0, 10)]), (11, [(0, 1), (1, 10)]), (25, [(0, 5), (5, 10), (15, 10)])])
def test_cut(n, pieces):
    assert packing.cut(n, 10) == pieces


def test_best_fit_and_bound():
    rng = np.random.default_rng(1)
    for _ in range(30):
        x = rng.integers(1, 101, rng.integers(1, 200))
        bins = packing.best_fit_decreasing(x, 100)
        fill = np.bincount(bins, weights=x)
        assert fill.max() <= 100 and len(fill) >= packing.bin_bound(x, 100) >= -(-x.sum() // 100)
    assert packing.bin_bound(np.array([51, 51, 51]), 100) == 3
    assert packing.bin_bound(np.array([34] * 6), 100) == 3
    assert packing.bin_bound(np.array([], int), 100) == 0


def test_pack_documents(spark, odd, none, prose):
    rows = packing.pack_documents(odd, JSON).collect()
    assert packing.pack_documents(none, JSON).count() == 0
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    lone = [r for r in rows if r["doc_id"] == 4]
    assert [(r["piece"], r["start"], r["length"]) for r in lone] == [(0, 0, 2)]
    ids = np.array([*packing.token_ids(pa.array(["a"]), JSON)[0], packing.END_ID], "<u4")
    assert lone[0]["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_exchange_saves_bins(spark):
    """Partitions of odd sizes leave gaps that only an exchange closes."""
    sizes = [60] * 101 + [40] * 101
    items = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long")
    out = packing.pack(items, 100, group=16)
    assert out.count() == len(sizes) and out.select("sequence_id").distinct().count() <= 104
