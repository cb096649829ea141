"""A hidden Markov language model over words, trained by Baum-Welch over all partitions.

Words are the runs between ASCII white space, A-Z in lower case; an end follows each text. The
``OWN`` most frequent words (and the end) are symbols of their own; every other word is drawn in
two steps, its shape (last byte and length) from the hidden state, then the word among those of its
shape by add-one counts. A text's likelihood is the scaled forward recursion over its symbols times
the word-within-shape factors.

1. One pass counts words; counts are combined per task and then by word.
2. One pass turns each text into symbol numbers, written to the shared folder. At most
   ``FREQUENT`` words' counts go to the workers; of other words a text's occurrences meet the
   counts in a join, whose keys are rare by construction (and combined per text first).
3. Baum-Welch: from a start fitted on a bounded sample (``START_SYMBOLS`` symbols of texts of at most
   ``START_TEXT``, the lowest hashes of their symbols first), rounds over all training texts: at most
   ``ROUNDS``, ``BARE_ROUNDS`` if there is no such sample, and none after one that raises the
   likelihood by less than ``GAIN`` of it. Each task sums its expected counts, groups of about the
   square root of the tasks add theirs up, the driver adds up the groups' and re-estimates.
   Parameters have a fixed size.
4. One pass runs the forward recursion over all texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import TimeMajor, lower_words, per_block, staged, whole

STATES, OWN, FREQUENT, SHAPES = 8, 4096, 150_000, 64
START_TEXTS, START_TEXT, START_SYMBOLS, START_ROUNDS = 600, 15_000, 300_000, 20
ROUNDS, BARE_ROUNDS, GAIN = 2, 8, 1e-4
#: Positions whose messages are held at once.
SPAN = 400_000
SEED = 7


def count_words(training: DataFrame) -> DataFrame:
    """word, n of the training texts; the empty word stands for the end."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = lower_words(batch.column("_text"))
        n = np.bincount(words.codes, minlength=len(words.vocab))
        words_, n = words.vocab.filter(pa.array(n > 0)), n[n > 0]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([words_.cast(pa.string()), pa.array([""])]), pa.array(np.r_[n, batch.num_rows])], ["word", "n"])

    each = training.select(whole().alias("_text")).mapInArrow(per_block(run, "_text", 8_000_000), "word string, n bigint")
    return staged(each.groupBy("word").agg(F.sum("n").alias("n")), "words")


def shape_column(word: Column) -> Column:
    last = F.coalesce(F.conv(F.right(F.hex(word), F.lit(2)), 16, 10).cast("int"), F.lit(0))
    return (last.bitwiseAND(7) * 8 + F.least(F.lit(7), F.floor(F.octet_length(word) / 3))).cast("int")


def shapes(words: pa.Array) -> np.ndarray:
    raw = words.cast(pa.large_string()).cast(pa.large_binary())
    size = np.asarray(pc.binary_length(raw)).astype(np.int64)
    if not len(raw):
        return np.empty(0, np.int64)
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"\0", np.uint8)
    last = np.where(size > 0, data[np.maximum(offsets[1:] - 1, 0)], 0).astype(np.int64)
    return (last & 7) * 8 + np.minimum(7, size // 3)


@dataclass
class Vocabulary:
    tokens: int  # N
    distinct: int  # V
    rare_below: int  # counts under this are not with the workers
    counts: dict[str, tuple[int, int]]  # word -> (symbol, count)
    shape_total: np.ndarray  # of words without a symbol of their own: occurrences and distinct
    own: int

    @property
    def symbols(self) -> int:
        return self.own + SHAPES


def vocabulary(counts: DataFrame) -> Vocabulary:
    size = F.floor(F.log2("n") * 8).cast("int")
    sums = counts.groupBy(size.alias("b")).agg(F.count("*").alias("words"), F.sum("n").alias("n"), F.min("n").alias("least")).orderBy(F.desc("b")).collect()
    rare_below, room = 1 << 62, FREQUENT
    for r in sums:
        room -= r["words"]
        if room < 0:
            break
        rare_below = r["least"]
    known = counts.where(F.col("n") >= rare_below).toPandas().sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    own = min(OWN, len(known))
    per_shape = counts.groupBy(shape_column(F.col("word")).alias("s")).agg(F.sum("n"), F.count("*")).collect()
    total = np.zeros((SHAPES, 2))
    for s, n, words in per_shape:
        total[s] = n, words
    mine = shapes(pa.array(known["word"][:own], pa.string()))
    np.subtract.at(total, (mine, 0), known["n"][:own].to_numpy())
    np.subtract.at(total, (mine, 1), 1)
    symbol = np.r_[np.arange(own), own + shapes(pa.array(known["word"][own:], pa.string()))]
    table = dict(zip(known["word"], zip(symbol.tolist(), known["n"].tolist(), strict=True), strict=True))
    return Vocabulary(sum(r["n"] for r in sums), sum(r["words"] for r in sums), rare_below, table, total, own)


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """uid, doc_id, held_out, n_tokens, known, logs, within, symbols, rare.

    logs: sum of log10(c+1) over the words the workers know; within: what the word-within-shape
    factors add to that for the words' own symbols and shapes; rare: the other words and how often."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocab)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rare_type = pa.list_(pa.struct([("word", pa.string()), ("tf", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v: Vocabulary = shared.value
        words = lower_words(batch.column("_text"))
        names = words.vocab.to_pylist()
        get, none = v.counts.get, (-1, -1)
        found = np.array([get(w, none) for w in names], np.int64).reshape(-1, 2)
        symbol = np.where(found[:, 0] >= 0, found[:, 0], v.own + shapes(words.vocab))
        log = np.where(found[:, 1] > 0, np.log10(np.maximum(found[:, 1], 0) + 1.0), 0.0)
        free = symbol - v.own
        below = np.log10(v.shape_total.sum(1) + 1)
        within = np.where(free >= 0, log - below[np.maximum(free, 0)], 0.0)
        end_symbol, end_count = get("", (v.own + int(shapes(pa.array([""]))[0]), 0))
        owner = np.repeat(np.arange(batch.num_rows), words.counts)
        rows = lambda x, extra: pa.array(np.bincount(owner, weights=x[words.codes], minlength=batch.num_rows) + extra)
        is_known = (found[:, 1] > 0).astype(float)
        at = np.r_[0, np.cumsum(words.counts)]
        flat = symbol[words.codes].astype("<u2")
        end = np.array([end_symbol], "<u2")
        symbols = [np.concatenate([flat[a:b], end]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        rare_at = np.flatnonzero(found[words.codes, 1] < 0)
        pair, tf = np.unique(owner[rare_at] * len(names) + words.codes[rare_at], return_counts=True)
        per_row = np.bincount(pair // max(1, len(names)), minlength=batch.num_rows)
        values = pa.StructArray.from_arrays([words.vocab.take(pa.array(pair % max(1, len(names)))).cast(pa.string()), pa.array(tf.astype(np.int64))], ["word", "tf"])
        rare = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per_row)].astype(np.int32)), values)
        end_log = np.log10(end_count + 1.0)
        cols = [batch.column("doc_id"), batch.column("held_out"), pa.array(words.counts + 1), rows(is_known, float(end_count > 0)), rows(log, end_log), rows(within, end_log - below[end_symbol - v.own] if end_symbol >= v.own else 0.0), pa.array(symbols, pa.binary()), rare.cast(rare_type)]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "n_tokens", "known", "logs", "within", "symbols", "rare"])

    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, known double, logs double, within double, symbols binary, rare array<struct<word:string,tf:bigint>>"
    out = docs.select("doc_id", "held_out", whole().alias("_text")).mapInArrow(per_block(run, "_text", 4_000_000), schema)
    return staged(out.withColumn("uid", F.monotonically_increasing_id()), "symbols")


@dataclass
class Chain:
    start: np.ndarray
    trans: np.ndarray
    emit: np.ndarray  # states x symbols
    likelihood: float = 0.0  # of expected counts: the natural logarithm of what they were made of


def _split(symbols: list[bytes]) -> tuple[np.ndarray, TimeMajor]:
    return np.frombuffer(b"".join(symbols), "<u2").astype(np.int64), TimeMajor(np.array([len(s) // 2 for s in symbols]))


def log_likelihood(symbols: list[bytes], chain: Chain) -> np.ndarray:
    """Natural logarithm of each sequence's probability, by the scaled forward recursion."""
    flat, lay = _split(symbols)
    flat, by_symbol = lay.take(flat), np.ascontiguousarray(chain.emit.T)
    out = np.zeros(len(symbols))
    state = None
    for t in range(lay.steps):
        n = lay.active[t]
        state = (chain.start if t == 0 else state[:n] @ chain.trans) * by_symbol[flat[lay.offset[t] : lay.offset[t + 1]]]
        c = state.sum(1)
        state /= c[:, None]
        out[:n] += np.log(c)
    back = np.empty_like(out)
    back[lay.order] = out
    return back


def expected_counts(symbols: list[bytes], chain: Chain) -> Chain:
    """The E-step: expected starts, transitions and emissions (not normalised).

    Messages are held for ``SPAN`` positions at a time: where there are more, a first pass keeps those
    at the spans' borders only, and each span's are made anew when the backward pass comes to it."""
    flat, lay = _split(symbols)
    flat, by_symbol = lay.take(flat), np.ascontiguousarray(chain.emit.T)
    o, n, states = lay.offset, lay.active, len(chain.start)
    spans = lay.spans(SPAN)
    border: list[np.ndarray | None] = [None] * len(spans)

    def forward(k: int, keep: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t0, t1 = spans[k]
        e, state = by_symbol[flat[o[t0] : o[t1]]], border[k]
        alpha, scale = (np.empty_like(e), np.empty(len(e))) if keep else (e, e)
        for t in range(t0, t1):
            here = slice(o[t] - o[t0], o[t + 1] - o[t0])
            x = (chain.start if t == 0 else state[: n[t]] @ chain.trans) * e[here]
            c = x.sum(1)
            state = x / c[:, None]
            if keep:
                alpha[here], scale[here] = state, c
        if k + 1 < len(spans):
            border[k + 1] = state
        return e, alpha, scale

    for k in range(len(spans) - 1):
        forward(k, False)
    pairs, emit, first = np.zeros_like(chain.trans), np.zeros_like(chain.emit), np.zeros_like(chain.start)
    likelihood, later = 0.0, None  # the message that the next span sends back
    for k in range(len(spans) - 1, -1, -1):
        t0, t1 = spans[k]
        e, alpha, scale = forward(k, True)
        likelihood += float(np.log(scale).sum())
        e /= scale[:, None]
        beta = np.ones_like(alpha)
        for t in range(t1 - 1, t0 - 1, -1):
            here = slice(o[t] - o[t0], o[t + 1] - o[t0])
            if later is not None:
                m = len(later)
                part = slice(here.start, here.start + m)
                pairs += alpha[part].T @ later
                beta[part] = later @ chain.trans.T
            later = e[here] * beta[here]
        gamma = beta * alpha
        if t0 == 0 and len(gamma):
            first = gamma[: n[0]].sum(0)
        emit += np.stack([np.bincount(flat[o[t0] : o[t1]], weights=gamma[:, s], minlength=chain.emit.shape[1]) for s in range(states)])
    return Chain(first, pairs * chain.trans, emit, likelihood)


def maximise(counts: Chain, mass: np.ndarray) -> Chain:
    """The M-step; emissions are smoothed towards the corpus by ``mass`` (one value per symbol)."""
    norm = lambda x: x / x.sum(-1, keepdims=True)
    return Chain(norm(counts.start + 0.1), norm(counts.trans + 0.1), norm(counts.emit + mass))


def first_chain(symbols: list[bytes], size: int, mass: np.ndarray) -> Chain:
    rng = np.random.default_rng(SEED)
    emit = mass * rng.uniform(0.5, 1.5, (STATES, size))
    trans = np.full((STATES, STATES), 0.3 / STATES) + 0.7 * np.eye(STATES)
    chain = Chain(np.full(STATES, 1 / STATES), trans / trans.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
    for _ in range(START_ROUNDS if symbols else 0):
        chain = maximise(expected_counts(symbols, chain), mass)
    return chain


def train(encoded: DataFrame, vocab: Vocabulary) -> Chain:
    """Baum-Welch over every row that is not held out."""
    training = encoded.where("not held_out")
    size, shape = vocab.symbols, (STATES, vocab.symbols)
    mass = np.ones(size)
    for symbol, n in vocab.counts.values():
        if symbol < vocab.own:
            mass[symbol] += n
    mass[vocab.own :] += vocab.shape_total[:, 0]
    mass = mass / mass.sum() * 50
    rows = training.where(F.col("n_tokens") <= START_TEXT).select("n_tokens", "uid", F.xxhash64("symbols").alias("h")).orderBy("h", "uid").limit(START_TEXTS).collect()
    uids, room = [], START_SYMBOLS
    for r in rows:
        if r["n_tokens"] <= room:
            uids.append((r["uid"],))
            room -= r["n_tokens"]
    few = []
    if uids:
        ids = encoded.sparkSession.createDataFrame(uids, "uid long")
        few = sorted(bytes(r["symbols"]) for r in training.join(F.broadcast(ids), "uid").select("symbols").collect())
    chain = first_chain(few, size, mass)
    names = ["start", "trans", "emit", "likelihood"]

    def blob(c: Chain) -> list[bytes]:
        return [np.ascontiguousarray(x, float).tobytes() for x in (c.start, c.trans, c.emit, c.likelihood)]

    def add(a: Chain | None, b: Chain) -> Chain:
        return b if a is None else Chain(a.start + b.start, a.trans + b.trans, a.emit + b.emit, a.likelihood + b.likelihood)

    def read(row) -> Chain:
        return Chain(np.frombuffer(row["start"]), np.frombuffer(row["trans"]).reshape(STATES, STATES), np.frombuffer(row["emit"]).reshape(shape), float(np.frombuffer(row["likelihood"])[0]))

    groups = max(1, int(training.rdd.getNumPartitions() ** 0.5))
    before = -np.inf
    for _ in range(ROUNDS if few else BARE_ROUNDS):
        now = chain

        def local(batches):
            total = None

            def one(batch: pa.RecordBatch):
                nonlocal total
                total = add(total, expected_counts(batch.column("symbols").to_pylist(), now))
                return []

            for _ in per_block(one, "symbols", 600_000)(batches):
                pass
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in blob(total)], names)

        def merge(group: pd.DataFrame) -> pd.DataFrame:
            total = None
            for _, row in group.iterrows():
                total = add(total, read(row))
            return pd.DataFrame([blob(total)], columns=names)

        sums = training.select("symbols").mapInArrow(local, "start binary, trans binary, emit binary, likelihood binary")
        merged = sums.groupBy(F.pmod(F.spark_partition_id(), F.lit(groups)).alias("g")).applyInPandas(merge, "start binary, trans binary, emit binary, likelihood binary")
        total = None
        for row in merged.toLocalIterator():
            total = add(total, read(row))
        if total is None:
            break
        chain = maximise(total, mass)
        if total.likelihood - before < GAIN * abs(total.likelihood):
            break
        before = total.likelihood
    return chain


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10). Other columns of
    ``docs``, whatever their names, are not looked at; an empty table gives no rows.

    Null text is empty: one token, the end. Rows are told apart by where they are read, so repeated
    and null ids get rows of their own. With no training row every word is unknown, and the base
    gives each token probability one (N and V are 0)."""
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = count_words(docs.where("not held_out"))
    vocab = vocabulary(counts)
    encoded = encode(docs, vocab)
    chain = train(encoded, vocab)
    kind = docs.schema["doc_id"].dataType.simpleString()
    keep = ["uid", "doc_id", "held_out", "n_tokens", "known", "logs", "within"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = log_likelihood(batch.column("symbols").to_pylist(), chain) / np.log(10)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found)], [*keep, "hidden"])

    schema = f"uid bigint, doc_id {kind}, held_out boolean, n_tokens bigint, known double, logs double, within double, hidden double"
    scored = encoded.select(*keep, "symbols").mapInArrow(per_block(run, "symbols", 4_000_000), schema)
    rare = encoded.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.tf")
    # their shape's factor is in "within" already; what is missing is their count, if they have one
    meet = rare.join(counts.where(F.col("n") < vocab.rare_below), "word")
    sums = meet.groupBy("uid").agg(F.sum(F.col("tf") * F.log10(F.col("n") + 1.0)).alias("rare_logs"), F.sum("tf").alias("rare_known"))
    all_ = scored.join(sums, "uid", "left")
    rare_logs, rare_known = F.coalesce("rare_logs", F.lit(0.0)), F.coalesce("rare_known", F.lit(0))
    denominator = float(np.log10(vocab.tokens + vocab.distinct + 1))
    return all_.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known").cast("long") + rare_known).alias("n_known"),
        F.lit(int(vocab.tokens)).cast("long").alias("train_tokens"),
        (F.col("logs") + rare_logs - F.col("n_tokens") * denominator).alias("base_score"),
        (F.col("hidden") + F.col("within") + rare_logs).alias("score"),
    )
