"""Near-duplicates by ProbMinHash over weighted word shingles.

A text is the bag of its shingles of five words (lower-case runs between white space), weighted by
how often they occur; a text of one to four words is one shingle. The likeness of two bags is their
probability Jaccard index, the chance that two ProbMinHash components agree; for texts whose
shingles do not repeat it is the plain Jaccard index. Pairs of 0.8 or more are near-duplicates, and
classes are the connected components of such pairs.

1. Sketch, one pass. Every shingle is a Poisson process whose rate is its weight; each arrival
   falls to a random one of the signature's registers, which keeps the shingle of its earliest
   arrival. All shingles of a block advance arrival by arrival, and a shingle ends as soon as its
   next arrival is later than all of its text's registers.
2. Equal bags become one node. Banding: five registers to a band.
3. Buckets, families and exact verification as ``near`` has them. A pair whose signatures agree in
   too few registers is no link (a pair of 0.8 passes but for one in a million).

Verification is by the exact index over the whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from ._common import lower_words, mix, per_block, staged, whole
from .near import Rule, classes, maybe_in

SHINGLE, BANDS, PER_BAND = 5, 25, 5
REGISTERS = BANDS * PER_BAND
#: A pair of likeness 0.8 agrees in 100 of 125 registers, with a deviation of 4.5.
LEAST_AGREE = 78
LEAST = 0.8
#: What the sum of an index may lack by rounding.
ROUNDING = 1e-9

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, weight) of all texts, sorted by text and hash."""
    words = lower_words(texts)
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in words.vocab.to_pylist()], np.uint64)
    hashed = known[words.codes] if len(words.codes) else np.empty(0, np.uint64)
    n, counts = len(hashed), words.counts
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(n) - np.repeat(np.r_[0, np.cumsum(counts)][:-1], counts)
    length = np.minimum(counts, SHINGLE)[owner] if n else owner
    starts = place <= counts[owner] - length if n else np.empty(0, bool)
    code = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        code = code * np.uint64(0xD6E8FEB86659FD93)
        inside = k < length
        code[inside] += hashed[np.minimum(np.arange(n) + k, n - 1)][inside] if n else 0
    code = mix(code + length.astype(np.uint64))
    owner, code = owner[starts], code[starts]
    order = np.lexsort((code, owner))
    owner, code = owner[order], code[order]
    first = np.r_[True, (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])] if len(owner) else np.empty(0, bool)
    at = np.flatnonzero(first)
    return owner[at], code[at], np.diff(np.r_[at, len(owner)]).astype(float)


def signatures(owner: np.ndarray, code: np.ndarray, weight: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """The shingle in each register of each text (texts x registers); 0 for texts without one."""
    early = np.full(texts * registers, np.inf)
    held = np.zeros(texts * registers, np.uint64)
    latest = np.full(texts, np.inf)
    size = np.bincount(owner, minlength=texts)
    lone = size[owner] == 1
    held.reshape(texts, registers)[owner[lone]] = code[lone][:, None]
    live = np.flatnonzero(~lone)
    at, time, step = owner[live], np.zeros(len(live)), 0
    element, rate = code[live], weight[live]
    while len(element):
        step += 1
        draw = mix(element + np.uint64(step * int(_GOLD) % 2**64))
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) / 2**53) / rate
        soon = time < latest[at]
        element, rate, at, time, draw = element[soon], rate[soon], at[soon], time[soon], draw[soon]
        if not len(element):
            break
        register = at * registers + (mix(draw ^ _GOLD) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(early, register, time)
        won = early[register] == time
        held[register[won]] = element[won]
        here = np.unique(at)
        latest[here] = early.reshape(texts, registers)[here].max(1)
    return held.reshape(texts, registers)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One key per band (texts x BANDS), the band's number mixed in."""
    key = np.zeros((len(sig), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD
    for k in range(PER_BAND):
        key = mix(key ^ sig[:, k::PER_BAND])
    return key.view(np.int64)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two bags (sorted hashes, weights): the sum over shared shingles i of
    1 / sum_j max(a_j/a_i, b_j/b_i). Sorted by a_j/b_j, the inner sum is two prefix sums."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    both = np.union1d(a[0], b[0])
    x, y = np.zeros(len(both)), np.zeros(len(both))
    x[np.searchsorted(both, a[0])], y[np.searchsorted(both, b[0])] = a[1], b[1]
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    below = np.searchsorted(ratio, ratio, side="left")
    y_below = np.r_[0, np.cumsum(y)][below]
    x_from = np.r_[np.cumsum(x[::-1])[::-1], 0][below]
    shared = (x > 0) & (y > 0)
    return float((1 / (x_from[shared] / x[shared] + y_below[shared] / y[shared])).sum())


class Bags:
    """The bags of a list of texts, and the exact likeness of one of them with some others."""

    def __init__(self, texts: pa.Array):
        owner, self.code, self.weight = bags(texts)
        self.at = np.searchsorted(owner, np.arange(len(texts) + 1))
        self.size = np.diff(self.at)
        self.plain = np.ones(len(texts), bool)  # no shingle twice
        self.plain[owner[self.weight > 1]] = False

    def bag(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.code[self.at[i] : self.at[i + 1]], self.weight[self.at[i] : self.at[i + 1]]

    def alike(self, i: int, others: np.ndarray) -> np.ndarray:
        """Whether text i and each of the others are near-duplicates. For bags without repeats the
        index is the share of common shingles."""
        out = np.zeros(len(others), bool)
        plain = self.plain[others] & self.plain[i] & (self.size[others] > 0) & (self.size[i] > 0)
        for k in np.flatnonzero(~plain).tolist():
            out[k] = likeness(self.bag(i), self.bag(int(others[k]))) >= LEAST - ROUNDING
        some = others[plain]
        if len(some):
            mine, n = self.bag(i)[0], self.size[some]
            first = np.r_[0, np.cumsum(n)][:-1]
            codes = self.code[np.repeat(self.at[some] - first, n) + np.arange(int(n.sum()))]
            place = np.minimum(np.searchsorted(mine, codes), len(mine) - 1)
            both = np.add.reduceat((mine[place] == codes).astype(np.int64), first)
            out[plain] = both >= (LEAST - ROUNDING) * (n + len(mine) - both)
        return out


def sketch(docs: DataFrame) -> DataFrame:
    """docs: text (t) and any other columns but these: uid, name (16 bytes that name the bag), keys
    (band keys; none for a text without words), sig (a byte per register), w (characters); written to
    the shared folder with all columns."""
    own = docs.columns
    schema = StructType([*docs.schema.fields, StructField("name", BinaryType()), StructField("keys", ArrayType(LongType())), StructField("sig", BinaryType()), StructField("w", IntegerType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.compute.fill_null(batch.column("t"), "")
        owner, code, weight = bags(texts)
        n = batch.num_rows
        at = np.searchsorted(owner, np.arange(n + 1))
        name = [xxhash.xxh3_128_digest(code[a:b].tobytes() + weight[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
        sig = signatures(owner, code, weight, n)
        keys = band_keys(sig)
        some = np.diff(at) > 0
        lists = [k if ok else [] for k, ok in zip(keys.tolist(), some.tolist(), strict=True)]
        short = (mix(sig) >> np.uint64(56)).astype(np.uint8)
        cols = [*(batch.column(c) for c in own), pa.array(name, pa.binary()), pa.array(lists, pa.list_(pa.int64())), pa.array([r.tobytes() for r in short], pa.binary()), pa.compute.utf8_length(texts).cast(pa.int32())]
        return pa.RecordBatch.from_arrays(cols, [*own, "name", "keys", "sig", "w"])

    return staged(docs.mapInArrow(per_block(run, "t", 2_000_000), schema).withColumn("uid", F.monotonically_increasing_id()), "sketches")


RULE = Rule(REGISTERS, LEAST_AGREE, Bags)


def _classes(sketched: DataFrame) -> DataFrame:
    def texts(asked: DataFrame, n: int) -> DataFrame:
        some = sketched.where(maybe_in(asked.select("id"), n)(F.col("uid"))).select(F.col("uid").alias("id"), whole("t").alias("t"))
        return some.join(asked.select("id"), "id")

    return classes(sketched, texts, RULE)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), class_size and links, a row per row of
    ``docs``: links counts the class's distinct texts less one, the links that hold it together.

    Null and empty texts, and those of white space alone, have no shingle and are one class. Null
    ids keep their rows; a class of null ids alone has a null class_id. Repeated rows are copies.
    Other columns of ``docs``, whatever their names, are not looked at."""
    sketched = sketch(docs.select(F.col("doc_id").alias("key"), F.col("text").alias("t")))
    found = sketched.select("uid", "key", "name").join(_classes(sketched), "uid")
    texts = found.groupBy("root", "name").agg(F.min("key").alias("least"), F.count("*").alias("n"))
    sizes = texts.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"), (F.count("*") - 1).alias("links"))
    return found.join(sizes, "root").select(F.col("key").alias("doc_id"), "class_id", "class_size", "links")


def keep_one(docs: DataFrame) -> DataFrame:
    """The row of the least doc_id of each class, with the columns of ``docs``, whatever their names
    (of rows that share that id, the one read first)."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    slim = docs.select(F.col("doc_id").alias("key"), F.col("text").alias("t"), *([F.struct(*(F.col(f"`{c}`") for c in others)).alias("rest")] if others else []))
    sketched = sketch(slim)
    rooted = sketched.select("uid", "key").join(_classes(sketched), "uid")
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "uid"))["uid"].alias("uid"))
    dropped = staged(rooted.select("uid").join(first, "uid", "left_anti"), "dropped")
    # only rows that the filter cannot clear meet the join, so texts that stay are not moved
    marked = sketched.withColumn("maybe", maybe_in(dropped, dropped.count())(F.col("uid")))
    clear, rest = marked.where("not maybe"), marked.where("maybe").join(dropped, "uid", "left_anti")
    own = [F.col({"doc_id": "key", "text": "t"}[c]).alias(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c) for c in docs.columns]
    return clear.select(*own).unionByName(rest.select(*own))
