import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import edit_embedding, prob_minhash
from ledgerloom.llm import _common, near
from ledgerloom.llm._common import components

from .test_private import base


def bag(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def probability_jaccard(a, b):
    if not a or not b:
        return float(not a and not b)
    keys = a.keys() | b.keys()
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in keys) for i in a.keys() & b.keys())


def classes_of(texts, least=0.8):
    bags, root = [bag(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if probability_jaccard(bags[i], bags[j]) >= least:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.fixture(scope="module")
def copies(prose):
    rng, texts = random.Random(1), []
    for i in range(12):
        words = prose(60 + 10 * i, i).split()
        texts.append(" ".join(words))
        for k in range(1 + i % 4):
            changed = list(words)
            for _ in range(1 + k * 2):
                changed[rng.randrange(len(changed))] = "edited"
            texts.append(" ".join(changed))
        texts.append(" ".join(words).upper())
        texts.append(" ".join(words * 2))
    return texts + ["", None, "  ", "one two", "One TWO", "one two three", "a b c d e", "a b c d e f"]


def test_exact_likeness():
    for a, b in (("a b c d e f g h", "a b c d e f g x"), ("a b c d e " * 9, "a b c d e f"), ("", "a"), ("", ""), ("q r", "q r")):
        x, y = (prob_minhash.bags(pa.array([t]))[1:] for t in (a, b))
        assert prob_minhash.likeness(x, y) == pytest.approx(probability_jaccard(bag(a), bag(b)))


def test_registers_estimate_likeness(prose):
    words = prose(300, 3).split()
    a, b = " ".join(words), " ".join(words[:200] + prose(100, 4).split() + words[:60])
    owner, code, weight = prob_minhash.bags(pa.array([a, b]))
    sig = prob_minhash.signatures(owner, code, weight, 2, 4000)
    assert (sig[0] == sig[1]).mean() == pytest.approx(probability_jaccard(bag(a), bag(b)), abs=0.03)


def test_classes_equal_brute_force(spark, copies):
    docs = spark.createDataFrame(list(enumerate(copies)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in prob_minhash.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(copies))] == classes_of(copies)


@pytest.mark.parametrize("block", [1000, 16])
def test_pairs_that_no_leader_resembles(spark, prose, monkeypatch, block):
    monkeypatch.setattr(_common, "BLOCK", block)
    texts = [f"{prose(60, 100 + k)}{more}" for k in range(20) for more in ("", " more")]
    # one bucket holds them all, and all signatures agree
    rows = [(i, bytes([i]), [7], bytes(prob_minhash.REGISTERS), t, len(t)) for i, t in enumerate(texts)]
    sketched = spark.createDataFrame(rows, "uid bigint, name binary, keys array<bigint>, sig binary, t string, w int")
    got = {r["uid"]: r["root"] for r in prob_minhash._classes(sketched).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


@pytest.mark.parametrize("block", [1000, 30])
def test_a_group_whose_members_differ_from_its_centre(spark, prose, monkeypatch, block):
    """Copies with some to many edits: chains of links, far from every leader."""
    monkeypatch.setattr(_common, "BLOCK", block)
    monkeypatch.setattr(near, "SHARE", 7)
    rng, first = random.Random(6), prose(120, 77).split()
    texts = []
    for k in range(90):
        words = list(first if k < 60 else texts[rng.randrange(60)].split())
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(40)}"
        texts.append(" ".join(words + ["twice over again and"] * (k % 3)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in prob_minhash.near_duplicates(docs).collect()}
    want = classes_of(texts)
    assert len(set(want)) > 5 and [got[i] for i in range(len(texts))] == want


def test_names_that_clash(spark):
    rows = [(1, "a b c d e f", 7, "x", "r"), (2, "a b c d e f", 8, "y", "s"), (3, "other", 9, "z", "t")]
    docs = spark.createDataFrame(rows, "_uid bigint, text string, doc_id bigint, `_h` string, `rest` string")
    kept = prob_minhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]


def test_near_edges(spark, odd, none):
    rows = prob_minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count() and prob_minhash.near_duplicates(none).count() == 0
    kept = prob_minhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["0", "3", "4", "5", "6", "7", "8", "9", "None"]


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    root = {n: n for p in pairs for n in p}
    for _ in range(500):
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
        if not changed:
            break
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    alone = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {n: r for n, r in root.items() if n not in alone}


def test_fingerprints(spark, prose):
    texts = ["", None, "ab", "x", prose(5, 1), prose(700, 2), prose(90, 3), prose(90, 3), "é" * 50]
    docs = spark.createDataFrame([(i * 3, t, "k") for i, t in enumerate(texts)], "doc_id bigint, text string, fingerprint string")
    rows = sorted(edit_embedding.fingerprints(docs).collect())
    plain = [t or "" for t in texts]
    assert len(rows) == len(texts)
    for i, r in enumerate(rows):
        t, following = plain[i], plain[(i + 1) % len(plain)]
        m = len(t) // 4
        want = t[: len(t) - m] + following[:m]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(want.encode()).hexdigest())
        alone = edit_embedding.embed([t, want])
        assert [r["fingerprint"], r["edited_fingerprint"]] == edit_embedding.as_strings(alone)
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    assert rows[6]["near_next"] == 1 and rows[5]["near_edited"] > 0.6 > 0.2 > rows[5]["near_next"]


def test_fingerprint_edges(odd, none):
    assert edit_embedding.fingerprints(odd).count() == odd.count()
    assert edit_embedding.fingerprints(none).count() == 0
    assert edit_embedding.fingerprints(odd.where("doc_id = 5")).collect()[0]["near_next"] == 1


def test_walks_fall_into_step_after_edits(prose):
    text = prose(400, 8)
    others = [text[:at] + "q" + text[at : at + 400] + text[at + 401 :] for at in range(200, 1000, 40)]
    a, b = edit_embedding.embed([text] * len(others)), edit_embedding.embed(others)
    assert np.median(edit_embedding.likeness(a, b)) > 0.6


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(2))
        assert edit_embedding.edit_distance(a, b) == plain_distance(a, b)
    for _ in range(20):
        a = "".join(rng.choice("abcdef") for _ in range(700))
        b = "".join(rng.choice("abcdef") if rng.random() < 0.2 else c for c in a)[rng.randrange(9) :]
        d = edit_embedding.edit_distance(a, b)
        for most in (d // 3, d - 1, d, d + 5):
            got = edit_embedding.edit_distance(a, b, most)
            assert got == d if got <= most or d <= most else most < got <= d


def test_walks_taken_up_again(prose):
    texts = [prose(n, n) for n in (1, 3, 40, 300, 900, 2500)] + ["", "x", "\u00e9" * 50]
    changed = [edit_embedding.edited(t, u) for t, u in zip(texts[:-1], texts[1:])]
    own, new = edit_embedding.embed_edited(texts, changed)
    assert edit_embedding.as_strings(own) == edit_embedding.as_strings(edit_embedding.embed(texts))
    assert edit_embedding.as_strings(new) == edit_embedding.as_strings(edit_embedding.embed(changed))


def test_near_classes_by_edits(spark, prose):
    base_text = prose(200, 1)
    texts = [base_text, base_text[:300] + "zz" + base_text[300:], base_text, prose(200, 2), prose(200, 3), ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in edit_embedding.near_classes(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5}


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


@pytest.mark.parametrize("block", [1000, 16])
def test_edit_classes_against_all_pairs(spark, prose, monkeypatch, block):
    """Every pair that shares a key and enough registers, and nothing else; most alike pairs do."""
    monkeypatch.setattr(_common, "BLOCK", block)
    rng, texts = random.Random(11), []
    for k in range(14):
        first = prose(60, 300 + k)
        texts.append(first)
        for n in range(4):
            changed = first.split()
            for _ in range(2 * n):
                changed[rng.randrange(len(changed))] = rng.choice(["x", "changed", "yz"])
            texts.append(" ".join(changed))
    least, has = edit_embedding.registers(texts)
    keys = [set(k) for k in edit_embedding.band_keys(least).tolist()]
    root, alike, met = list(range(len(texts))), 0, 0
    for i in range(len(texts)):
        for j in range(i):
            longer = max(len(texts[i]), len(texts[j]))
            if plain_distance(texts[i], texts[j]) <= int(0.1 * longer + 1e-9):
                alike += 1
                if keys[i] & keys[j] and (least[i] == least[j]).sum() >= edit_embedding.LEAST_AGREE:
                    met += 1
                    a, b = root[i], root[j]
                    root = [min(a, b) if r in (a, b) else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in edit_embedding.near_classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == root and met >= 0.8 * alike > 20


def test_aligned_distance_is_a_bound(prose):
    text = prose(4000, 5)
    other = text[:5000] + "zz" + text[5040:12000] + prose(20, 6) + text[12000:]
    far = edit_embedding.aligned_distance(text, other)
    assert edit_embedding.edit_distance(text, other) <= far <= 0.1 * len(text)
    assert edit_embedding.aligned_distance("ab" * 9000, "") == 18000


def test_classes_come_with_the_fingerprints(spark, odd, prose):
    rows = [(f"k{i}" if i else None, t) for i, t in enumerate([prose(40, 1), prose(40, 1), prose(40, 1)[:-3], prose(40, 2), "", None])] + [("k1", prose(40, 2))]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {(r["doc_id"], r["n_chars"]): r["class_id"] for r in edit_embedding.fingerprints(docs, near=True).collect()}
    n = len(prose(40, 1))
    assert got == {(None, n): "k1", ("k1", n): "k1", ("k2", n - 3): "k1", ("k3", len(prose(40, 2))): "k1", ("k4", 0): "k4", ("k5", 0): "k4", ("k1", len(prose(40, 2))): "k1"}
    assert edit_embedding.fingerprints(odd, near=True).count() == odd.count()


def test_order_of_ids(spark):
    """The next document of each kind of id: beyond 2^53, as text, and many rows of one id."""
    for ids, kind in (([2**60 + 1, 2**60, 2**60 + 2], "bigint"), (["b", "\u00e9", "a"], "string"), ([5] * 6 + [4, 7], "int")):
        docs = spark.createDataFrame([(k, f"{i}" * 8) for i, k in enumerate(ids)], f"doc_id {kind}, text string")
        rows = edit_embedding.fingerprints(docs).collect()
        order = sorted(((k, hashlib.md5((f"{i}" * 8).encode()).digest(), f"{i}" * 8) for i, k in enumerate(ids)), key=lambda x: (x[0].encode() if kind == "string" else x[0], x[1]))
        want = {(k, hashlib.sha256((t[:6] + order[(n + 1) % len(order)][2][:2]).encode()).hexdigest()) for n, (k, _, t) in enumerate(order)}
        assert {(r["doc_id"], r["edited_sha256"]) for r in rows} == want and len(rows) == len(ids)


def test_pipeline_against_its_parts(spark, tmp_path, copies):
    pipeline = pytest.importorskip("corpus_pipeline")
    texts = [f"{t} mail me a.b@c.de or +1 (555) 123-4567" if i % 3 == 0 and t else t for i, t in enumerate(copies)] + ["foulword " * 3 + f"clean words number {i} here and there" for i in range(12)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    toxic = [(i, 1, int("foulword" in (t or ""))) for i, t in enumerate(texts)]
    spark.createDataFrame(toxic, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    clean = pipeline.STAGES[0][1](spark, docs, str(tmp_path))
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean.columns == docs.columns and set(left) == {i for i, x in enumerate(toxic) if not x[2]}
    clean = spark.createDataFrame(clean.collect(), docs.schema)
    once = pipeline.STAGES[1][1](spark, clean, str(tmp_path))
    ids = sorted(left)
    roots = classes_of([left[i] for i in ids])
    kept = {r["doc_id"] for r in once.collect()}
    assert kept == {ids[r] for r in roots} and once.columns == docs.columns
    once = spark.createDataFrame(once.collect(), docs.schema)
    masked = {r["doc_id"]: r for r in pipeline.STAGES[2][1](spark, once, str(tmp_path)).collect()}
    assert set(masked) == kept
    for i in kept:
        assert not base(masked[i]["text"] or "")
        if not base(left[i] or ""):
            assert masked[i]["text"] == left[i]
    assert {r["doc_id"] for r in pipeline.run(spark, str(tmp_path)).collect()} == kept
