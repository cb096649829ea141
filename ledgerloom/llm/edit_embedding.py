"""Document fingerprints by randomised edit embedding, and classes of texts that differ by few edits.

A walk reads a text from its start. At step j it stands on a character c, and a random bit shared
by all texts, fixed by (j, c), says whether it moves on. The characters it stands on, step by step,
form the embedded string: a few edits change few of its places, since two walks that an edit has
parted soon fall into step again. The fingerprint samples the embedded string at fixed steps: all
of the first ``FIRST``, then ``FIRST`` of each octave, each as four hashed bits of the character and
its successor; a step past the end is a pad. Likeness is the share of equal samples, weighted by
the steps a sample stands for, less what chance gives.

All texts of a block walk together; those at their end drop out.

Classes. A walk over a whole text loses its step where edits are many, so banding rests on short
walks: one of ``WINDOW`` steps from every place whose next three characters hash to it (one in
``EVERY``), sampled at ``SAMPLES`` of its steps. Edits elsewhere leave a window's samples as they are,
wherever it lies. Of each of ``BANDS * PER_BAND`` hash functions a register keeps the least window;
``PER_BAND`` registers make a band key. Texts that share a key and enough registers are verified by
their edit distance, and classes are the components (``near``). Two texts are alike if their distance
is at most ``1 - LEAST`` of the longer one's length. Texts of more than ``LONG`` characters are aligned
along the windows that occur once in either, and the distances in between are added up: that is an
upper bound, so what it calls alike is alike.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ._common import mix, per_block, staged, whole, width
from .near import Rule, classes, maybe_in

FIRST, PERIOD, PAD, SEED = 64, 4096, 16, 20
_HEX = np.frombuffer(b"0123456789abcdef-", np.uint8)


@cache
def _bits() -> np.ndarray:
    """Shared random bits by step (modulo PERIOD) and character class; class 0 is past the end."""
    bits = np.random.default_rng(SEED).integers(0, 2, (PERIOD, 256), dtype=np.uint8).astype(np.int32)
    bits[:, 0] = 0
    return bits


@cache
def _rows() -> list[bytes]:
    """The same, a byte string per step."""
    return [r.tobytes() for r in _bits().astype(np.uint8)]


@cache
def sampled_steps(octaves: int) -> np.ndarray:
    """The first steps, then FIRST random ones of each [FIRST * 2^k, FIRST * 2^(k+1))."""
    out = [np.arange(FIRST)]
    for k in range(octaves):
        rng = np.random.default_rng([SEED, k])
        low = FIRST << k
        out.append(low + np.sort(rng.choice(low, FIRST, replace=False)))
    return np.concatenate(out)


def sample_weights(n: int) -> np.ndarray:
    """Steps that each of n samples stands for."""
    return np.exp2(np.maximum(0, np.arange(n) // FIRST - 1).astype(float))


#: Steps between two looks at which walks have ended, and which changed texts' walks begin.
STRIDE, FEW = 256, 24


def embed(texts: list[str]) -> np.ndarray:
    """Samples of each text's embedded string: 0 to 15, or PAD (texts x samples)."""
    return embed_edited(texts, [])[0]


def embed_edited(texts: list[str], changed: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Samples of the texts, and of the first of them as ``edited``. A changed text's walk is its text's
    until it comes near what was replaced, and starts there."""
    n, all_ = len(texts), [*texts, *changed]
    if not all_:
        return np.full((0, FIRST), PAD, np.uint8), np.full((0, FIRST), PAD, np.uint8)
    lengths = np.array([len(t) for t in all_], np.int64)
    chars = np.frombuffer("\0".join([*all_, ""]).encode("utf-32-le"), "<u4").astype(np.uint32)
    kind = (chars * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(255) + np.uint32(1)
    two = chars * np.uint32(0x85EBCA6B) + np.roll(chars, -1) * np.uint32(0xC2B2AE35)
    symbol = ((two ^ (two >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(28)).astype(np.uint8)
    end = np.cumsum(lengths + 1) - 1
    kind = kind.astype(np.uint8)
    kind[end], symbol[end] = 0, PAD
    first = (end - lengths).astype(np.int32 if len(chars) < 2**31 else np.int64)
    # where a text's walk must have been left: a sample also looks at the next character
    near = first[: len(changed)] + lengths[: len(changed)] - lengths[: len(changed)] // 4 - 2 - STRIDE
    left = np.zeros(len(changed), bool)
    # a walk of n characters takes 2n steps on average; octaves are added as walks need them
    rows, at = np.arange(n), first[:n].copy()
    c, bits, columns = np.take(kind, at), _bits(), []
    octaves, step, done, steps, flat = 0, 0, 0, sampled_steps(0), None
    while True:
        if step % STRIDE == 0:
            if step:
                live = c != 0
                rows, at, c = rows[live], at[live], c[live]
            own = rows < len(changed)
            go = np.flatnonzero(own)[at[own] > near[rows[own]]]
            go = go[~left[rows[go]]]
            if len(go):
                mine = rows[go]
                left[mine] = True
                rows, at = np.r_[rows, n + mine], np.r_[at, at[go] - first[mine] + first[n + mine]]
                c = np.take(kind, at)
        if step == steps[done]:
            column = np.full(len(all_), PAD, np.uint8)
            column[rows] = np.take(symbol, at)
            column[n:][~left] = column[: len(changed)][~left]
            columns.append(column)
            done += 1
            if done == len(steps):
                if not c.any():
                    break
                octaves += 1
                steps = sampled_steps(octaves)
        stop = min(int(steps[done]), (step // STRIDE + 1) * STRIDE)
        if len(rows) > FEW:
            for j in range(step, stop):
                at += np.take(bits[j % PERIOD], c)
                np.take(kind, at, out=c)
        elif len(rows):  # the longest texts' ends: a vector of a few walks costs as much as one of many
            flat = kind.tobytes() if flat is None else flat
            moves = _rows()[step % PERIOD : step % PERIOD + stop - step]
            for w, place in enumerate(at.tolist()):
                for move in moves:
                    place += move[flat[place]]
                at[w] = place
            c = np.take(kind, at)
        step = stop
    samples = np.stack(columns, 1)
    return samples[:n], samples[n:]


def as_strings(samples: np.ndarray) -> list[str]:
    """One character per sample, pads at the end left off."""
    return [row.tobytes().decode().rstrip("-") for row in _HEX[samples]]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, 0 to 1; samples past the end of both texts do not count. Two empty texts: 1."""
    n = max(a.shape[1], b.shape[1])
    wide = lambda x: np.pad(x, ((0, 0), (0, n - x.shape[1])), constant_values=PAD)
    a, b = wide(a), wide(b)
    w = sample_weights(n)
    some = (a != PAD) | (b != PAD)
    all_ = (some * w).sum(1)
    same = ((a == b) & some) @ w
    share = np.divide(same, all_, out=np.ones_like(all_), where=all_ > 0)
    return np.clip((share - 1 / 16) / (15 / 16), 0, 1)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the next document's first as many."""
    m = len(text) // 4
    return text[: len(text) - m] + following[:m]


WINDOW, EVERY, SAMPLES, BANDS, PER_BAND = 32, 16, 10, 16, 3
REGISTERS = BANDS * PER_BAND
#: Registers that a pair has in common at least: of texts with a tenth of their words replaced 27 of 48
#: on average, 18 at least of forty; of texts that share a passage 10 or so.
LEAST_AGREE, LEAST, GRAM, LONG = 17, 0.9, 5, 3000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


@cache
def _sampled() -> frozenset[int]:
    return frozenset(np.random.default_rng([SEED, WINDOW]).choice(WINDOW, SAMPLES, replace=False).tolist())


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, samples hashed) of every window, texts in order; an empty text has none."""
    chars = np.frombuffer("\0".join([*texts, "", ""]).encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.r_[0, np.cumsum(lengths + 1)][:-1]
    kind = ((chars * np.uint64(2654435761) >> np.uint64(16)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    kind[first + lengths] = 0
    two = mix(chars * np.uint64(0x85EBCA6B) + np.roll(chars, -1) * _GOLD)
    three = mix(two + np.roll(chars, -2))
    start = (three & np.uint64(EVERY - 1)) == 0
    start[first[lengths > 0]] = True
    start &= kind != 0
    start[len(chars) - 1 :] = False
    begin = np.flatnonzero(start)
    at, key, bits = begin.copy(), np.zeros(len(begin), np.uint64), _bits()
    for j in range(WINDOW):
        c = kind[at]
        if j in _sampled():
            key = mix(key ^ np.where(c > 0, two[at], 0))
        at += bits[j][c]
    owner = np.searchsorted(first, begin, side="right") - 1
    return owner, begin - first[owner], key


def registers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(texts x REGISTERS least windows, whether a text has any)."""
    owner, _, key = windows(texts)
    out = np.zeros((len(texts), REGISTERS), np.uint64)
    some, begin = np.unique(owner, return_index=True)
    for r in range(REGISTERS if len(some) else 0):
        out[some, r] = np.minimum.reduceat(mix(key + np.uint64((r + 1) * int(_GOLD) % 2**64)), begin)
    has = np.zeros(len(texts), bool)
    has[some] = True
    return out, has


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.zeros((len(least), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD
    for k in range(PER_BAND):
        key = mix(key ^ least[:, k::PER_BAND])
    return key.view(np.int64)


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance by bit vectors as long as the shorter text, without what both begin and
    end with. With ``most`` it stops where every way on costs more, with a bound beyond it."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[len(a) - mid : len(a) - low] == b[len(b) - mid : len(b) - low] else (low, mid - 1)
    a, b = a[: len(a) - low], b[: len(b) - low]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    mask, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = mask, 0, len(a)
    looks = {len(b) * k // 8 for k in range(2, 8)} if most is not None and len(b) > 400 else ()
    for r, ch in enumerate(b):
        if r in looks and (bound := _least_on(up, down, len(a), len(b), r)) > most:
            return bound
        eq = where.get(ch, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (mask & ~(diag | up)), up & diag
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1 | 1) & mask, minus << 1 & mask
        up, down = minus | (mask & ~(diag | plus)), plus & diag
    return score


def _least_on(up: int, down: int, n: int, total: int, r: int) -> int:
    """The least that a way through row r costs: its distance there, and what the lengths left differ by."""
    unpack = lambda v: np.unpackbits(np.frombuffer(v.to_bytes(-(-n // 8), "little"), np.uint8), bitorder="little")[:n].astype(np.int64)
    there = r + np.r_[0, np.cumsum(unpack(up) - unpack(down))]
    return int((there + np.abs((n - np.arange(n + 1)) - (total - r))).min())


def _single(owner: np.ndarray, start: np.ndarray, key: np.ndarray, i: int) -> dict[int, int]:
    """Where the windows lie that text i holds once."""
    a, b = np.searchsorted(owner, [i, i + 1])
    keys, at, n = np.unique(key[a:b], return_index=True, return_counts=True)
    return dict(zip(keys[n == 1].tolist(), start[a:b][at[n == 1]].tolist(), strict=True))


def aligned_distance(a: str, b: str, once: tuple[dict, dict] | None = None, most: int | None = None) -> int:
    """An upper bound on the edit distance: the windows that occur once in either text, as many as
    keep one order, stay where they are; between them distances are exact. Beyond ``most`` it may stop."""
    if once is None:
        found = windows([a, b])
        once = (_single(*found, 0), _single(*found, 1))
    pairs = sorted((p, once[1][k]) for k, p in once[0].items() if k in once[1])
    tails, ends, back = [], [], [-1] * len(pairs)  # the longest run that rises in both texts
    for i, (_, q) in enumerate(pairs):
        k = bisect_left(tails, q)
        tails[k : k + 1], ends[k : k + 1] = [q], [i]
        back[i] = ends[k - 1] if k else -1
    i, chain = (ends[-1] if ends else -1), []
    while i >= 0:
        chain.append(pairs[i])
        i = back[i]
    total, x, y = 0, 0, 0
    for p, q in [*chain[::-1], (len(a), len(b))]:
        if a[x:p] != b[y:q]:
            total += edit_distance(a[x:p], b[y:q])
            if most is not None and total > most:
                break
        x, y = p, q
    return total


class Edits:
    """Texts as compressed bytes, and which of them are alike to one of them."""

    def __init__(self, packed: pa.Array):
        self.texts = [_unpacked(x) for x in packed.to_pylist()]
        # some texts at a time: while windows are found, a character takes about 30 bytes
        part = np.cumsum([len(t) for t in self.texts]) // 500_000 if self.texts else np.empty(0, int)
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else part
        found = [(a, windows(self.texts[a:b])) for a, b in zip(starts.tolist(), [*starts.tolist()[1:], len(part)], strict=True)]
        self.found = tuple(np.concatenate(x) for x in zip(*((o + a, p, k) for a, (o, p, k) in found), strict=True)) if found else windows([])
        self.once: dict[int, dict[int, int]] = {}
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def singles(self, i: int) -> dict[int, int]:
        if i not in self.once:
            self.once[i] = _single(*self.found, i)
        return self.once[i]

    def grams(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.held:
            flat = np.frombuffer(self.texts[i].encode("utf-32-le"), "<u4").astype(np.uint64)
            n = max(0, len(flat) - GRAM + 1)
            code = np.zeros(n, np.uint64)
            for k in range(GRAM):
                code = code * _GOLD + flat[k : k + n]
            self.held[i] = np.unique(mix(code), return_counts=True)
        return self.held[i]

    def alike(self, i: int, others: np.ndarray) -> np.ndarray:
        """An edit spoils at most GRAM of the grams that two texts share, which often says no; the aligned
        distance is a bound that mostly says yes; the exact one decides the rest."""
        return np.array([self._alike(i, int(j)) for j in others.tolist()], bool)

    def _alike(self, i: int, j: int) -> bool:
        a, b = self.texts[i], self.texts[j]
        longer = max(len(a), len(b))
        most = int((1 - LEAST) * longer + 1e-9)
        if longer - min(len(a), len(b)) > most:
            return False
        x, y = self.singles(i), self.singles(j)
        many = 5 * len(x.keys() & y.keys()) >= 4 * max(len(x), len(y)) > 0
        if not many and self._shared(i, j) < longer - GRAM + 1 - GRAM * most:
            return False
        if aligned_distance(a, b, (x, y), most) <= most:
            return True
        return longer <= LONG and edit_distance(a, b, most) <= most

    def _shared(self, i: int, j: int) -> int:
        (code, count), (mine, many) = self.grams(i), self.grams(j)
        if not len(mine) or not len(code):
            return 0
        place = np.minimum(np.searchsorted(mine, code), len(mine) - 1)
        return int(np.minimum(count, many[place])[mine[place] == code].sum())


RULE = Rule(REGISTERS, LEAST_AGREE, Edits)


def _unpacked(packed: bytes) -> str:
    return zstandard.decompress(packed).decode() if packed else ""


def _name(text: str) -> Column:
    return F.unhex(F.md5(text))


def sketch(docs: DataFrame) -> DataFrame:
    """uid, key (doc_id), name (of the text; null counts as empty), keys, sig and w, written to the
    shared folder."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("t").to_pylist()
        least, has = registers(texts)
        lists = [k if ok else [] for k, ok in zip(band_keys(least).tolist(), has.tolist(), strict=True)]
        sig = [r.tobytes() for r in (mix(least) >> np.uint64(56)).astype(np.uint8)]
        cols = [batch.column("key"), batch.column("name"), pa.array(lists, pa.list_(pa.int64())), pa.array(sig, pa.binary()), pa.array([len(t) for t in texts], pa.int32())]
        return pa.RecordBatch.from_arrays(cols, ["key", "name", "keys", "sig", "w"])

    schema = StructType([StructField("key", docs.schema["doc_id"].dataType), StructField("name", BinaryType()), StructField("keys", ArrayType(LongType())), StructField("sig", BinaryType()), StructField("w", IntegerType())])
    rows = docs.select(F.col("doc_id").alias("key"), whole().alias("t"))
    out = rows.withColumn("name", _name("t")).mapInArrow(per_block(run, "t", 2_000_000), schema)
    return staged(out.withColumn("uid", F.monotonically_increasing_id()), "sketches")


def _packed(docs: DataFrame, column: str, cuts: list | None = None, number: bool = True) -> DataFrame:
    """key, name and ``column``: the text compressed, the form in which texts move; with ``cuts`` also p,
    the range that the key falls into."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=3)
        z = pa.array([pack.compress(t.encode()) if t else b"" for t in batch.column("t").to_pylist()], pa.binary())
        ranges = [] if cuts is None else [_range(batch.column("key"), cuts, number)]
        return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("name"), z, *ranges], ["key", "name", column] + ["p"] * (cuts is not None))

    schema = StructType([StructField("key", docs.schema["doc_id"].dataType), StructField("name", BinaryType()), StructField(column, BinaryType())] + [StructField("p", IntegerType())] * (cuts is not None))
    rows = docs.select(F.col("doc_id").alias("key"), whole().alias("t"))
    return rows.withColumn("name", _name("t")).mapInArrow(per_block(run, "t", 4_000_000), schema)


def _range(keys: pa.Array, cuts: list, number: bool) -> pa.Array:
    """How many cuts are not beyond the key; a null key comes first."""
    if number:
        values = np.array([-np.inf if k is None else float(k) for k in keys.to_pylist()])
        return pa.array(np.searchsorted(np.array(cuts, float), values, side="right").astype(np.int32))
    return pa.array([0 if k is None else bisect_right(cuts, k.encode()) for k in keys.to_pylist()], pa.int32())


def _classes(sketched: DataFrame, docs: DataFrame) -> DataFrame:
    """key, name, class_id of the rows whose class has several members; class_id is its least key."""

    def texts(asked: DataFrame, n: int) -> DataFrame:
        ids = asked.select("id", "name").withColumn("h", F.xxhash64("name"))
        rows = docs.select(whole().alias("t")).withColumn("name", _name("t"))
        some = rows.where(maybe_in(ids.select("h"), n)(F.xxhash64("name"))).join(ids, "name")
        one = some.groupBy("id", "name").agg(F.any_value("t").alias("text"))
        return _packed(one.withColumnRenamed("id", "doc_id"), "t").select(F.col("key").alias("id"), "t")

    found = staged(sketched.select("uid", "key", "name").join(classes(sketched, texts, RULE), "uid").groupBy("root", "key", "name").agg(F.count("*").alias("n")), "members")
    least = found.groupBy("root").agg(F.min("key").alias("class_id"), F.sum("n").alias("n")).where("n > 1")
    return found.select("root", "key", "name").join(least.select("root", "class_id"), "root").select("key", "name", "class_id")


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least id of the class), a row per row of ``docs``: equal texts, and texts
    alike by edits that share a band key. Null texts are empty, null ids stay, an empty table gives no
    rows. A text without a partner is its own class; of one id's texts each has its class."""
    sketched = sketch(docs)
    found = _classes(sketched, docs).withColumnRenamed("key", "k").withColumnRenamed("name", "n")
    met = sketched.select("key", "name").join(found, F.col("key").eqNullSafe(F.col("k")) & (F.col("name") == F.col("n")), "left")
    return met.select(F.col("key").alias("doc_id"), F.when(F.col("n").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"))


def _in_order(docs: DataFrame, keys: DataFrame, found: DataFrame | None, chars: int = 64_000_000) -> DataFrame:
    """Rows dealt by ranges of the key and sorted, texts compressed (z); before each row what ``found``
    (key, name, class_id) says of its key; after each range's rows the first of the next range (of the
    first range, after the last), marked as guest. keys: key and w of all rows. Null keys come first;
    rows of one key are in the order of their names. Keys are numbers or strings."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType
    number = not isinstance(kind, StringType)
    rank = F.coalesce(F.col("key").cast("double"), F.lit(float("-inf"))) if number else F.when(F.col("key").isNull(), "0").otherwise(F.concat(F.lit("1"), "key"))
    ranked = keys.select("key", "w", rank.alias("k"))
    parts = max(width(spark), -(-int(keys.agg(F.sum("w")).first()[0] or 0) // chars))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    if number:
        cuts = sorted({c for c in ranked.agg(F.percentile_approx("k", shares, 20_000)).first()[0] or [] if abs(c) != float("inf")})
    else:  # ranges come of a sample by hash; which rows they hold does not change what a row's next is
        few = sorted(r[0].encode() for r in keys.where("key is not null").select("key").distinct().orderBy(F.xxhash64("key")).limit(20 * parts).collect())
        cuts = sorted({few[len(few) * i // parts] for i in range(1, parts)}) if few else []

    def dealt(df: DataFrame, *more: str) -> DataFrame:
        run = lambda b: pa.RecordBatch.from_arrays([*(b.column(c) for c in ("key", *more)), _range(b.column("key"), cuts, number)], ["key", *more, "p"])
        schema = StructType([df.schema["key"], *(df.schema[c] for c in more), StructField("p", IntegerType())])
        return df.select("key", *more).mapInArrow(lambda batches: map(run, batches), schema)

    least = sorted((r[0], r[1]) for r in dealt(ranked, "k").groupBy("p").agg(F.min("k")).collect())
    # as many rows as there are ranges
    table = spark.createDataFrame([(k, least[i - 1][0]) for i, (_, k) in enumerate(least)], f"k {'double' if number else 'string'}, before int")
    rows = _packed(docs, "z", cuts, number).withColumn("k", rank).join(F.broadcast(table), "k", "left")
    both = F.array(F.struct(F.col("p").alias("p"), F.lit(0).alias("g")), F.struct(F.col("before").alias("p"), F.lit(1).alias("g")))
    at = rows.withColumn("at", F.explode(F.filter(both, lambda x: x.p.isNotNull())))
    out = at.select("key", "z", "name", F.col("at.p").alias("p"), F.col("at.g").alias("guest"), F.lit(None).cast(kind).alias("class_id"), F.lit(1).alias("row"))
    if found is not None:
        told = dealt(found, "name", "class_id")
        out = out.unionByName(told.select("key", F.lit(None).cast("binary").alias("z"), "name", "p", F.lit(0).alias("guest"), "class_id", F.lit(0).alias("row")))
    return out.repartitionById(len(cuts) + 1, F.col("p")).sortWithinPartitions("guest", "key", "row", "name").select("key", "z", "name", "guest", "class_id", "row")


def fingerprints(docs: DataFrame, near: bool = False) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and, if
    ``near``, class_id (see ``near_classes``).

    Null text is empty (its fingerprint is the empty string); a lone document is its own next; null ids
    come first, rows of one id in the order of their texts' digests; an empty table gives no rows.
    Other columns of ``docs``, whatever their names, are not looked at."""
    kind = docs.schema["doc_id"]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"] + ["class_id"] * near
    schema = StructType([StructField("doc_id", kind.dataType), *StructType.fromDDL("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double").fields] + [StructField("class_id", kind.dataType)] * near)

    def run(batches):
        held, told = None, {}  # the last row seen, waiting for its next; what is known of rows' classes
        for whole_batch in batches:
            for part in per_block(lambda b: b, "z", 1_500_000)([whole_batch]):
                isrow = np.asarray(part.column("row")) == 1
                for key, name, cls in zip(*(part.column(c).filter(pa.array(~isrow)).to_pylist() for c in ("key", "name", "class_id")), strict=True):
                    told[key, name] = (cls,)
                own = part.filter(pa.array(isrow))
                ids, packed, guests, marks = (own.column(c).to_pylist() for c in ("key", "z", "guest", "name"))
                texts = [_unpacked(x) for x in packed]
                if held is not None and not held[2]:
                    ids, texts, guests, marks = [held[0], *ids], [held[1], *texts], [held[2], *guests], [held[3], *marks]
                elif held is not None:
                    return  # guests after the first are not needed
                if not ids:
                    continue
                held = (ids[-1], texts[-1], guests[-1], marks[-1])
                n = next((i for i, g in enumerate(guests) if g), len(ids) - 1)
                if n:
                    yield block(ids, texts, n, [told.get((k, m), (k,))[0] for k, m in zip(ids[:n], marks[:n], strict=True)])
                if n < len(ids) - 1:
                    held = (None, "", 1, None)
                    break

    def block(ids: list, texts: list[str], n: int, found: list) -> pa.RecordBatch:
        changed = [edited(a, b) for a, b in zip(texts[:n], texts[1 : n + 1], strict=True)]
        both, new = embed_edited(texts[: n + 1], changed)
        own, after = both[:n], both[1 : n + 1]
        cols = [
            pa.array(ids[:n], arrow),
            pa.array([len(t) for t in texts[:n]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(as_strings(own), pa.string()),
            pa.array(as_strings(new), pa.string()),
            pa.array(likeness(own, new)),
            pa.array(likeness(own, after)),
        ] + [pa.array(found, arrow)] * near
        return pa.RecordBatch.from_arrays(cols, names)

    arrow = to_arrow_type(kind.dataType)
    if near:
        keys = sketch(docs)
        rows = _in_order(docs, keys, _classes(keys, docs))
    else:
        rows = _in_order(docs, docs.select(F.col("doc_id").alias("key"), F.length(whole()).alias("w")), None)
    return rows.mapInArrow(run, schema)
