"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Training, on a bounded sample of labelled rows (``SAMPLE_ROWS`` per label and ``SAMPLE_CHARS``
characters, whole texts, the lowest hashes of the id first):

1. Token labels. Labels are of documents; which of a toxic document's tokens are toxic is found from
   all words and word beginnings. Those that stand in toxic texts far beyond chance (a bound on the
   binomial tail, over all of them) are taken. Then a greedy cover: take the one that best separates
   toxic texts not explained so far from clean texts, count the texts that hold it as explained, and
   go on until none is precise enough. Texts that are much alike (their least word triples under two
   hashes agree) count once, so copies lend no support to the innocent words they share. Tokens with
   a chosen feature are the toxic ones.
2. A two-state CRF fits these labels. A token's features are its word, its chosen beginnings of 3 to 6
   letters, its length and signs at its end, and what stands before and after it. In every other
   text the word itself is hidden, so beginnings and neighbours learn to tell words that no labelled
   text holds. It is fitted on at most ``FIT_WORDS`` words per label, of texts of at most
   ``FIT_TEXT`` words: for each chosen feature some that hold it, then others by the id's hash.
3. A logistic curve maps the forward-backward marginals of a document (the expected number of
   toxic tokens, the largest marginal, the number of tokens) to the probability of the label.

Scoring is one pass without a shuffle: each distinct word of a block is looked up once, marginals
come from the chain over all tokens of the text.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ._common import TimeMajor, Words, bounded_texts, lower_words, per_block
from .crf import fit, forward_backward

SAMPLE_ROWS, SAMPLE_CHARS = 1500, 8_000_000
FIT_TEXT, FIT_WORDS, EACH = 1500, 100_000, 3
#: Letters of a word's beginnings, and what a feature needs to be taken: texts it newly explains and
#: the share of the sample's texts with it that are toxic (more of a beginning, which speaks for
#: words that no labelled text holds).
PREFIXES, LEAST_TEXTS, LEAST_SHARE, HEAD_SHARE = (3, 4, 5, 6), 3, 0.9, 0.95
#: What a feature may owe to chance, over all features, to be taken without the cover.
CHANCE = 0.01
REJECT = 0.7
_EDGE = ".,;:!?\"'()[]{}<>*_~`#$%&|-"
#: Classes of a neighbour: none, an ordinary word, one that begins as a chosen word does, a chosen word.
NONE, PLAIN, LIKE, CHOSEN = range(4)


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    heads: dict[str, float] = field(default_factory=dict)
    shape: np.ndarray = field(default_factory=lambda: np.zeros(1))
    before: np.ndarray = field(default_factory=lambda: np.zeros(4))
    after: np.ndarray = field(default_factory=lambda: np.zeros(4))
    base: float = 0.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    curve: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def weights(self, words: Words, vocab: list[str]) -> np.ndarray:
        """The toxic state's emission score of each token, over the clean state's."""
        own, kind = np.empty(len(vocab)), np.empty(len(vocab), np.int64)
        for i, w in enumerate(vocab):
            heads = [x for x in map(self.heads.get, beginnings(w)) if x is not None]
            word = self.words.get(w)
            own[i] = (self.base if word is None else word) + sum(heads)
            kind[i] = CHOSEN if word is not None else LIKE if heads else PLAIN
        own += self.shape[np.minimum(_shapes(words, vocab), len(self.shape) - 1)]
        before, after = _neighbours(words, kind)
        return own[words.codes] + self.before[before] + self.after[after]


def beginnings(word: str) -> list[str]:
    """Those shorter than the word."""
    return [word[:n] for n in PREFIXES if len(word) > n]


def _shapes(words: Words, vocab: list[str]) -> np.ndarray:
    """Per distinct word: length class (0 to 7) and whether signs stand at its ends."""
    size = np.array([min(7, len(w) // 2) for w in vocab], np.int64)
    raw = np.asarray(pc.utf8_length(words.vocab)).astype(np.int64)
    return 2 * size + (raw > np.array([len(w) for w in vocab], np.int64))


def _neighbours(words: Words, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of the word before and after each token, NONE at the ends of a text."""
    flat = kind[words.codes]
    before, after = np.roll(flat, 1), np.roll(flat, -1)
    ends = np.r_[0, np.cumsum(words.counts)]
    full = words.counts > 0
    before[ends[:-1][full]], after[ends[1:][full] - 1] = NONE, NONE
    return before, after


def _tokens(texts: pa.Array) -> tuple[Words, list[str]]:
    """Lower-case words, without the punctuation at their ends."""
    words = lower_words(texts)
    return words, pc.utf8_trim(pc.utf8_lower(words.vocab), _EDGE).to_pylist()


def _marginals(words: Words, score: np.ndarray, model: Model) -> tuple[np.ndarray, TimeMajor]:
    emit = np.zeros((len(words.codes), 2))
    emit[:, 1] = score
    lay = TimeMajor(words.counts)
    return forward_backward(emit, model.trans, model.start, lay)[0][:, 1], lay


def _summary(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document: 1, the logarithm of one plus the expected toxic tokens, the largest marginal, and
    the logarithm of one plus the tokens (what a long clean text adds up)."""
    out = np.zeros((len(counts), 4))
    out[:, 0] = 1
    owner = np.repeat(np.arange(len(counts)), counts)
    out[:, 1] = np.log1p(np.bincount(owner, weights=p, minlength=len(counts)))
    np.maximum.at(out[:, 2], owner, p)
    out[:, 3] = np.log1p(counts) / 10
    return out


def _alike(words: Words, vocab: list[str]) -> np.ndarray:
    """A group number per text; texts whose least word triples under two hashes agree share one."""
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    least = np.full((len(words.counts), 2), 2**64 - 1, np.uint64)
    one = np.array([zlib.crc32(w.encode()) for w in vocab], np.uint64)[words.codes]
    triple = one + np.uint64(0x9E3779B97F4A7C15) * np.roll(one, -1) + np.uint64(0xC2B2AE3D27D4EB4F) * np.roll(one, -2)
    for k, odd in enumerate((0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93)):
        mixed = (triple ^ (triple >> np.uint64(31))) * np.uint64(odd)
        np.minimum.at(least[:, k], owner, mixed ^ (mixed >> np.uint64(29)))
    return np.unique(least, axis=0, return_inverse=True)[1].ravel()


def _cover(words: Words, vocab: list[str], toxic: np.ndarray) -> tuple[set[str], set[str]]:
    """Words and beginnings that mark toxic texts."""
    names = list(dict.fromkeys(vocab))
    index = {w: i for i, w in enumerate(names)}
    heads: dict[str, int] = {}
    for w in names:
        for h in beginnings(w):
            heads.setdefault(h, len(names) + len(heads))
    size = len(names) + len(heads)
    group = _alike(words, vocab)
    toxic = np.bincount(group, weights=np.where(toxic, 1.0, -1.0)) > 0
    owner = np.repeat(group, words.counts)
    seen = np.unique(owner * len(vocab) + words.codes)
    doc, at = seen // len(vocab), seen % len(vocab)
    own = [np.array([index[w] for w in vocab], np.int64)]
    own += [np.array([heads[w[:n]] if len(w) > n else -1 for w in vocab], np.int64) for n in PREFIXES]
    pairs = np.unique(np.concatenate([(doc * size + f[at])[f[at] >= 0] for f in own]))
    doc, feat = pairs // size, pairs % size
    clean = np.bincount(feat[~toxic[doc]], minlength=size)
    bad = toxic[doc]
    doc, feat = doc[bad], feat[bad]
    total = np.bincount(feat, minlength=size)
    fits = total >= np.where(np.arange(size) < len(names), LEAST_SHARE, HEAD_SHARE) * (total + clean)
    if "" in index:
        fits[index[""]] = False
    base, n = np.clip(toxic.mean(), 1e-9, 1 - 1e-9), total + clean
    share = np.divide(total, n, out=np.zeros(size), where=n > 0)
    apart = share * np.log(np.maximum(share, 1e-12) / base) + (1 - share) * np.log(np.maximum(1 - share, 1e-12) / (1 - base))
    sure = fits & (share > base) & (n * apart > np.log(size / CHANCE))
    chosen: list[int] = np.flatnonzero(sure).tolist()
    open_doc = np.ones(len(toxic), bool)
    open_doc[doc[sure[feat]]] = False
    while True:
        gain = np.bincount(feat[open_doc[doc]], minlength=size)
        ok = fits & (gain >= LEAST_TEXTS)
        if not ok.any():  # each turn explains texts, so there is an end
            break
        best = int(np.argmax(np.where(ok, gain / (clean + 1.0), 0)))
        chosen.append(best)
        open_doc[doc[feat == best]] = False
    of = list(heads)
    return {names[i] for i in chosen if i < len(names)}, {of[i - len(names)] for i in chosen if i >= len(names)}


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic (rows with other values than 0 and 1, and ids
    without a text, are left out; an id labelled twice counts as toxic if either row says so; of an
    id's several texts one is read). Without usable rows the model scores everything one half."""
    label = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    key = F.xxhash64(F.col("doc_id").cast("string"))
    picked = [tuple(r) for want in (1, 0) for r in label.where(F.col("toxic") == want).orderBy(key, "doc_id").limit(SAMPLE_ROWS).collect()]
    sample = bounded_texts(docs, picked, "toxic int", lambda r: str(r[1]), dict.fromkeys("01", SAMPLE_CHARS // 2))
    sample = list({t: (t, y) for t, _, y in sample[::-1]}.values())[::-1]  # equal texts once
    if not sample:
        return Model()
    texts, toxic = [t for t, _ in sample], np.array([y == 1 for _, y in sample], bool)
    words, vocab = _tokens(pa.array(texts, pa.string()))
    marked, heads = _cover(words, vocab, toxic)
    model = Model()
    _fit_chain(model, texts, toxic, words, vocab, marked, heads)
    del words, vocab  # the sample's largest part
    x, y = np.zeros((len(texts), 4)), toxic.astype(float)
    for a in range(0, len(texts), 250):
        words, vocab = _tokens(pa.array(texts[a : a + 250], pa.string()))
        x[a : a + 250] = _summary(_marginals(words, model.weights(words, vocab), model)[0], words.counts)
    rate = y.mean()
    wt = np.where(toxic, 0.5 / max(rate, 1e-6), 0.5 / max(1 - rate, 1e-6)) if 0 < rate < 1 else np.ones(len(y))
    for _ in range(50):  # Newton's method on the penalised logistic likelihood
        q = 1 / (1 + np.exp(-np.clip(x @ model.curve, -30, 30)))
        g = x.T @ (wt * (y - q)) - 0.1 * model.curve
        h = (x * (wt * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(4)
        model.curve = model.curve + np.clip(np.linalg.solve(h, g), -2, 2)
    return model


def _fit_texts(words: Words, bad: np.ndarray, toxic: np.ndarray) -> list[int]:
    """Which texts the chain is fitted on: toxic ones so that each toxic word occurs in ``EACH`` of
    them where it can, then by order, as many words of each label as ``FIT_WORDS`` allows."""
    at = np.r_[0, np.cumsum(words.counts)]
    usable = np.flatnonzero((words.counts <= FIT_TEXT) & (words.counts > 0))
    out: list[int] = []
    for want in (True, False):
        mine = usable[toxic[usable] == want]
        seen = np.zeros(len(bad), np.int64)
        first, rest = [], []
        for i in mine.tolist():
            own = np.unique(words.codes[at[i] : at[i + 1]])
            own = own[bad[own]]
            (first if want and (seen[own] < EACH).any() else rest).append(i)
            seen[own] += 1
        room = FIT_WORDS
        for i in first + rest:
            if words.counts[i] <= room:
                room -= int(words.counts[i])
                out.append(i)
    return out


def _fit_chain(model: Model, texts: list[str], toxic: np.ndarray, all_words: Words, all_vocab: list[str], marked: set[str], heads: set[str]) -> None:
    """Label the tokens of toxic texts that hold a chosen word or beginning, and fit the chain."""
    is_bad = lambda w: w in marked or any(h in heads for h in beginnings(w))
    used = _fit_texts(all_words, np.array([is_bad(w) for w in all_vocab], bool), toxic)
    if not used:
        return
    words, vocab = _tokens(pa.array([texts[i] for i in used], pa.string()))
    toxic = toxic[used]
    bad = np.array([is_bad(w) for w in vocab], bool)
    labels = (bad[words.codes] & np.repeat(toxic, words.counts)).astype(np.int64)
    hidden = np.repeat(np.arange(len(used)) % 2 == 1, words.counts)
    word_id = {w: i + 2 for i, w in enumerate(sorted({w for w, b in zip(vocab, bad, strict=True) if b}))}
    head_id = {h: i + 1 for i, h in enumerate(sorted(heads))}
    kind = np.array([CHOSEN if w in word_id else LIKE if any(h in head_id for h in beginnings(w)) else PLAIN for w in vocab], np.int64)
    own = np.array([word_id.get(w, 1) for w in vocab], np.int64)[words.codes]
    own[hidden] = 1
    by_head = [np.array([head_id.get(w[:n], 0) if len(w) > n else 0 for w in vocab], np.int64)[words.codes] for n in PREFIXES]
    shape = _shapes(words, vocab)[words.codes] + 1
    features = [own, *by_head, shape, *_neighbours(words, kind)]
    sizes = [len(word_id) + 2, *[len(head_id) + 1] * len(PREFIXES), 17, 4, 4]
    found, model.trans, model.start = fit(features, sizes, labels, words.counts, 2, steps=40, l2=0.1)
    gap = [w[:, 1] - w[:, 0] for w in found]
    model.base = float(gap[0][1])
    model.words = {w: float(gap[0][i]) for w, i in word_id.items()}
    summed = sum(gap[1 : 1 + len(PREFIXES)])
    model.heads = {h: float(summed[i]) for h, i in head_id.items()}
    model.shape, model.before, model.after = gap[-3][1:], gap[-2], gap[-1]


SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("marginal", DoubleType())]))


def score(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """All columns of ``docs`` (its own toxic_score and toxic_spans are replaced) with toxic_score (0 to
    1) and, if asked, toxic_spans: start and end (code points) and marginal of each token whose
    marginal is a half or more. Null and empty texts have no tokens and score what the curve gives
    for none; repeated rows and null ids are scored each; an empty table gives no rows."""
    docs = docs.drop("toxic_score", "toxic_spans")
    names = docs.columns
    more = [StructField("toxic_score", DoubleType())] + [StructField("toxic_spans", SPANS)] * spans

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column("text"), "")
        words, vocab = _tokens(texts)
        p, _ = _marginals(words, model.weights(words, vocab), model)
        value = 1 / (1 + np.exp(-np.clip(_summary(p, words.counts) @ model.curve, -30, 30)))
        cols = [*(batch.column(c) for c in names), pa.array(value)]
        if spans:
            cols.append(pa.array(_spans(texts, words.counts, p), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))))
        return pa.RecordBatch.from_arrays(cols, [*names, "toxic_score"] + ["toxic_spans"] * spans)

    return docs.mapInArrow(per_block(run, "text", 2_000_000), StructType([*docs.schema.fields, *more]))


def _spans(texts: pa.Array, counts: np.ndarray, p: np.ndarray) -> list[list[dict]]:
    at, out = np.r_[0, np.cumsum(counts)], []
    for i, text in enumerate(texts.to_pylist()):
        hits = np.flatnonzero(p[at[i] : at[i + 1]] >= 0.5)
        found = []
        if len(hits):
            places = [m.span() for m in re.finditer(r"[^ \t-\r]+", text)]
            found = [{"start": places[k][0], "end": places[k][1], "marginal": float(p[at[i] + k])} for k in hits]
        out.append(found)
    return out
