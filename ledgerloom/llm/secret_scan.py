"""Secrets: fixed patterns, and a linear-chain CRF that tags further ones.

The CRF tags the words between white space as begin, inside or outside of a secret. A word's
emission has weights for its shape, coarse and fine, for the words before and after it (those that stand beside
known secrets in the sample) and for the file it stands in (whether it names a secret or holds a
match at all) together with its shape. Viterbi decodes every whole text. What it tags, if it has the least length of a value and no base match
overlaps it, is added as kind ``crf``; base matches always stay.

It is fitted on a bounded sample of ``SAMPLE_CHARS`` characters whose words are labelled by the base
patterns: of all texts with a base match those among the ``SAMPLE_ROWS`` ids with the lowest hashes,
or the first ``MARKED_TEXTS`` by hash if these are more, and the first ``PLAIN_TEXTS`` without one.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import TimeMajor, Words, bounded_texts, per_block, staged, whole
from .crf import fit, viterbi

SAMPLE_ROWS, SAMPLE_CHARS, MARKED_TEXTS, PLAIN_TEXTS = 8000, 32_000_000, 300, 300
OUT, BEGIN, INSIDE = 0, 1, 2

# The base patterns and the least lengths they ask for.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "crf")

_NAMES = re.compile(r"passw(or)?d|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_WORD = re.compile(r"[^ \t-\r]+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order; matches that fail their length are dropped, not retried."""
    out = []
    if ("=" in text or ":" in text) and _NAMES.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _words(texts: pa.Array) -> Words:
    """Words between ASCII white space, as they stand."""
    texts = texts.cast(pa.large_string())
    for c in "\t\n\x0b\x0c\r":
        texts = pc.replace_substring(texts, c, " ")
    return Words(texts, lambda x: pc.split_pattern(x, " ")).drop_empty()


_EDGE = ".,;:!?\"'()[]{}<>|"

#: Shapes: 0 is no feature, 1 a plain word; the rest combine what _shape looks at.
SHAPES = 2 + 6 * 4 * 3 * 2 * 3


def _shape(word: str) -> int:
    """Length class, share of digits, case, hexadecimal or not, and how it holds a name of a secret."""
    core = word.strip(".,;:!?\"'()[]{}<>")
    n = max(1, len(core))
    digits = sum(map(str.isdigit, core))
    size = min(5, n.bit_length() - 1)
    part = 0 if not digits else 1 if 4 * digits < n else 2 if digits < n else 3
    case = 2 if core.isupper() else 0 if core.islower() else 1
    hexa = int(not set(core) - set("0123456789abcdef"))
    name = 0 if not (m := _NAMES.search(core)) else 1 if m.end() == len(core) else 2
    return 2 + (((size * 4 + part) * 3 + case) * 2 + hexa) * 3 + name


def _shapes(vocab: pa.Array) -> np.ndarray:
    trimmed = pc.utf8_trim(vocab, ".,;:!?\"'()[]{}<>")
    plain = np.asarray(pc.fill_null(pc.or_(pc.utf8_is_alpha(trimmed), pc.equal(pc.binary_length(trimmed), 0)), False))
    plain &= ~np.asarray(pc.match_substring_regex(vocab, "(?i)passw(or)?d|secret|token|api_?key"))
    out = np.ones(len(vocab), np.int64)
    for i in np.flatnonzero(~plain).tolist():
        out[i] = _shape(vocab[i].as_py())
    return out


#: Share of digits, and whether the word has 16 characters or more: what shapes have in common.
COARSE = 2 + 4 * 2


def _coarse(shape: np.ndarray) -> np.ndarray:
    rest = (shape - 2) // 18
    return np.where(shape < 2, shape, 2 + rest % 4 * 2 + (rest // 4 >= 4))


@dataclass
class Model:
    beside: dict[str, int] = field(default_factory=dict)
    weights: list[np.ndarray] = field(default_factory=list)
    trans: np.ndarray | None = None
    start: np.ndarray | None = None


def _features(words: Words, found: np.ndarray, beside: dict[str, int]) -> list[np.ndarray]:
    """Per position: shape, coarse shape, word before, word after, shape by file."""
    fine = _shapes(words.vocab)
    shape, coarse = fine[words.codes], _coarse(fine)[words.codes]
    vocab = words.vocab.to_pylist()
    near = np.array([beside.get(w, 1) for w in vocab], np.int64)[words.codes]
    first = np.r_[0, np.cumsum(words.counts)]
    before, after = np.roll(near, 1), np.roll(near, -1)
    full = words.counts > 0
    before[first[:-1][full]], after[first[1:][full] - 1] = 0, 0
    file = np.repeat(found, words.counts)
    return [shape, coarse, before, after, np.where(file, shape, 0)]


def _files(texts: list[str], spans: list[list]) -> np.ndarray:
    return np.array([bool(s) or bool(_NAMES.search(t)) for t, s in zip(texts, spans, strict=True)], bool)


def _sample(docs: DataFrame) -> list[str]:
    """Distinct whole texts to fit on, in order of their ids' hashes: plain ones, then those with a base
    match, one text per id. One pass over all texts finds which hold a match."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit = [bool(base_spans(t)) for t in batch.column("_text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(hit, pa.bool_())], ["doc_id", "hit"])

    texts = docs.where("doc_id is not null").select("doc_id", whole().alias("_text"))
    seen = staged(texts.mapInArrow(per_block(look, "_text"), f"doc_id {kind}, hit boolean"), "hits").groupBy("doc_id").agg(F.max("hit").alias("hit"))
    first = lambda df, most: [tuple(r) for r in df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()]
    few = [r for r in first(seen, SAMPLE_ROWS) if r[1]]
    marked = max(few, first(seen.where("hit"), MARKED_TEXTS), key=len)
    found = bounded_texts(docs, first(seen.where("not hit"), PLAIN_TEXTS) + marked, "hit boolean", lambda r: str(r[1]), {"False": SAMPLE_CHARS // 2, "True": SAMPLE_CHARS // 2})
    return list(dict.fromkeys(t for t, *_ in found))


def train(docs: DataFrame) -> Model:
    """Without a base match in any text there is nothing to learn, and nothing is added."""
    texts = _sample(docs)
    spans = [base_spans(t) for t in texts]
    order = [i for i, s in enumerate(spans) if s] + [i for i, s in enumerate(spans) if not s]
    if not order or not spans[order[0]]:
        return Model()
    texts, spans = [texts[i] for i in order], [spans[i] for i in order]
    words = _words(pa.array(texts, pa.string()))
    labels, beside, at = np.zeros(len(words.codes), np.int64), {}, np.r_[0, np.cumsum(words.counts)]
    for i, (text, found) in enumerate(zip(texts, spans, strict=True)):
        places = [m.span() for m in _WORD.finditer(text)] if found else []
        for start, _, end in found:
            inside = [k for k, (a, b) in enumerate(places) if a < end and b > start]
            for k in inside:
                labels[at[i] + k] = labels[at[i] + k] or (BEGIN if k == inside[0] else INSIDE)
            for k in (inside[0] - 1, inside[-1] + 1):
                if 0 <= k < len(places):
                    w = text[slice(*places[k])]
                    beside[w] = beside.get(w, 0) + 1
    kept = sorted((w for w, n in beside.items() if n >= 3))
    model = Model({w: i + 2 for i, w in enumerate(kept)})
    near = len(kept) + 2
    features = _features(words, _files(texts, spans), model.beside)
    hidden = np.repeat(np.arange(len(texts)) % 2 == 1, words.counts)
    features[0][hidden] = features[-1][hidden] = 0  # every other text, so that coarse shapes learn to stand alone
    model.weights, model.trans, model.start = fit(features, [SHAPES, COARSE, near, near, SHAPES], labels, words.counts, 3, steps=40, l2=0.3)
    return model


def scan(texts: pa.Array, model: Model) -> list[list[tuple[int, int, int]]]:
    """Per text (start, kind, end), base spans and added ones, in order."""
    plain = texts.to_pylist()
    spans = [base_spans(t) for t in plain]
    if model.trans is None or not plain:
        return spans
    words = _words(texts)
    features = _features(words, _files(plain, spans), model.beside)
    tags = viterbi(sum(w[f] for w, f in zip(model.weights, features, strict=True)), model.trans, model.start, TimeMajor(words.counts))
    at = np.r_[0, np.cumsum(words.counts)]
    owner = np.repeat(np.arange(len(plain)), words.counts)
    for i in np.unique(owner[tags > 0]).tolist():
        places = [m.span() for m in _WORD.finditer(plain[i])]
        taken, k, mine = spans[i], 0, tags[at[i] : at[i + 1]]
        added = []
        while k < len(mine):
            if not mine[k]:
                k += 1
                continue
            last = k
            while last + 1 < len(mine) and mine[last + 1] == INSIDE:
                last += 1
            start, end = places[k][0], places[last][1]
            kept = len(plain[i][start:end].strip(_EDGE)) >= LEAST_VALUE
            if kept and not any(a < end and b > start for a, _, b in taken):
                added.append((start, 3, end))
            k = last + 1
        spans[i] = sorted(taken + added)
    return spans


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans. Offsets are code points, ends are
    exclusive. Null text is empty; a text without a span has an empty string (and its digest). Null
    ids stay, repeated rows repeat, an empty table gives no rows, and where spans begin together the
    kind listed first comes first; other columns, whatever their names, are not looked at."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = scan(batch.column("_text"), model)
        base = [[s for s in x if s[1] < 3] for x in found]
        counts = [pa.array([sum(s[1] == k for s in x) for x in base], pa.int64()) for k in range(3)]
        digest = pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in base], pa.string())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, digest, pa.array(map(joined, found), pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole().alias("_text")).mapInArrow(per_block(run, "_text"), f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
