"""Bound-certified repacking of tokenised documents into sequences of fixed capacity.

1. Each document becomes ids and an end id; one longer than the capacity is cut into pieces, all
   but the first of them full. Pieces (not texts) are what later steps move.
2. Pieces are dealt by hash to partitions of about ``GROUP`` pieces; each runs best-fit decreasing.
3. Dual-feasible functions give each partition, and the whole, a lower bound on the bins. A
   partition that meets its bound with at most one bin not full is done; the others have gaps.
   While the whole is over its bound, the documents of bins that are not full are exchanged: dealt
   anew among fewer partitions and packed again, as long as that saves bins; the round that saves
   none is discarded and ends the exchange.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Words, per_block, staged, whole
from .byte_pairs import encode

CAPACITY, END_ID = 2048, 0
#: Pieces per partition that one best-fit run holds.
GROUP = 8192


@cache
def _encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary of a tokenizers file (byte-level BPE whose ids are in merge order) as ranks."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
    ranks = {}
    for token, i in model["vocab"].items():
        if all(c in byte_of for c in token) and i < 256 + len(model["merges"]):
            ranks[bytes(byte_of[c] for c in token)] = i
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def _added(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """The file's added tokens, which part a text before anything else; where two begin together
    the first listed wins."""
    with open(path, encoding="utf-8") as f:
        ids = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", []) if t["content"]}
    return re.compile("|".join(map(re.escape, ids))) if ids else None, ids


@cache
def _spaced(path: str) -> np.ndarray:
    """Of each id, whether its bytes start with a space."""
    enc = _encoding(path)
    return np.array([enc.decode_single_token_bytes(t)[:1] == b" " for t in range(enc.n_vocab)])


def _ids(text: str, path: str) -> np.ndarray:
    enc, (pattern, ids) = _encoding(path), _added(path)
    if pattern is None or not pattern.search(text):
        return encode(text, enc)
    out, start = [], 0
    for m in pattern.finditer(text):
        out += [encode(text[start : m.start()], enc), np.array([ids[m[0]]], "<u4")]
        start = m.end()
    return np.concatenate([*out, encode(text[start:], enc)])


def token_ids(texts: pa.Array, path: str) -> list[np.ndarray]:
    """Ids of each text, every distinct word of the block encoded once.

    Words between single spaces are encoded apart from each other: a match of the pattern that
    holds a space after a non-space starts there. All words of the block go through one call; in
    what it returns, a token starts with a space exactly where a word starts. A word that is empty
    or ends in white space has no boundary behind it: a text with one inside is encoded whole. The
    first word, which no space precedes, and the last, which may end in anything, are on their own."""
    words = Words(texts.cast(pa.large_string()), lambda x: pc.split_pattern(x, " "))
    last = pc.utf8_slice_codeunits(words.vocab, -1, 1 << 40)
    apart = np.asarray(pc.and_(pc.greater(pc.binary_length(last), 0), pc.invert(pc.utf8_is_space(last))))
    chosen = words.vocab.filter(pa.array(apart))
    joined = " ".join(chosen.to_pylist())
    ids = encode(" " + joined, _encoding(path)) if len(chosen) else np.empty(0, np.uint32)
    at = np.flatnonzero(_spaced(path)[ids])
    if len(at) != len(chosen):  # a vocabulary whose tokens do not part at spaces
        return [_ids(t, path) for t in texts.to_pylist()]
    start, size = np.zeros(len(apart), np.int32), np.zeros(len(apart), np.int32)
    start[apart], size[apart] = at, np.diff(np.r_[at, len(ids)])
    first = np.r_[0, np.cumsum(words.counts)]
    inner = np.ones(len(words.codes), bool)
    inner[first[:-1]] = inner[first[1:] - 1] = False
    bad = np.zeros(len(texts), bool)
    owner = np.repeat(np.arange(len(texts)), words.counts)
    bad[owner[inner & ~apart[words.codes]]] = True
    bad |= ~apart[words.codes[first[:-1]]]
    for token in _added(path)[1]:
        bad |= np.asarray(pc.match_substring(texts, token))
    size, start = size[words.codes], start[words.codes]
    size[~inner] = 0
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    flat = ids[np.repeat(start - (end - size).astype(np.int32), size) + np.arange(total, dtype=np.int32)]
    done, out = np.r_[0, end][first], []
    for i, text in enumerate(texts.to_pylist()):
        if bad[i] or words.counts[i] < 2:
            out.append(_ids(text, path))
        else:
            ends = (_ids(x, path) for x in (text[: text.index(" ")], text[text.rindex(" ") :]))
            out.append(np.concatenate([next(ends), flat[done[i] : done[i + 1]], next(ends)]))
    return out


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: the first takes what does not fill a piece."""
    head = n % capacity or capacity
    return [(0, min(head, n)), *((s, capacity) for s in range(head, n, capacity))]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """One row per piece: ``keep`` columns, piece, start, length, ids_crc32 and, if asked, ids."""
    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    schema = f"{kinds}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, piece, start, length, crc, ids = [], [], [], [], [], []
        end = np.array([END_ID], "<u4").tobytes()
        for i, found in enumerate(token_ids(batch.column("_text"), path)):
            raw = found.astype("<u4").tobytes() + end
            for k, (s, n) in enumerate(cut(len(raw) // 4, capacity)):
                part = raw[4 * s : 4 * (s + n)]
                row.append(i), piece.append(k), start.append(s), length.append(n), crc.append(zlib.crc32(part)), ids.append(part)
        at = pa.array(row, pa.int64())
        cols = [batch.column(k).take(at) for k in keep] + [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
        names = [*keep, "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays(cols + [pa.array(ids, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    return docs.select(*keep, whole().alias("_text")).mapInArrow(per_block(run, "_text", 3_000_000), schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Bin of each length; open bins are kept by free space, the tightest found by a bit mask."""
    order = np.argsort(-lengths, kind="stable")
    out = np.empty(len(lengths), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0
    for i in order.tolist():
        n = int(lengths[i])
        if fits := mask >> n:
            free = n + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                mask ^= 1 << free
        else:
            b, free, bins = bins, capacity, bins + 1
        out[i] = b
        if free := free - n:
            by_free[free].append(b)
            mask |= 1 << free
    return out


def bin_bound(lengths: np.ndarray, capacity: int = CAPACITY, count: np.ndarray | None = None) -> int:
    """Of lengths, or of ``count`` by length, the best lower bound over two families of dual-feasible functions.

    Threshold t: sizes over capacity-t count as a whole bin, those under t as nothing, the rest
    in proportion. Rounding k: x -> floor((k+1)x)/k, and x itself where (k+1)x is whole."""
    if count is None:
        count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1]
    count = count.astype(np.int64)
    size = np.arange(capacity + 1)
    above, mass = np.cumsum(count[::-1])[::-1], np.r_[0, np.cumsum(count * size)]
    best = -(-int(mass[-1]) // capacity)
    for t in range(1, capacity // 2 + 1):
        large = int(above[capacity - t + 1]) if t else 0
        middle = int(mass[capacity - t + 1] - mass[t])
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 33):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, k * size, capacity * (scaled // capacity))
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def _pack(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    group = group.sort_values(["length", "uid"], ascending=[False, True], kind="stable", ignore_index=True)
    lengths = group["length"].to_numpy()
    bins = best_fit_decreasing(lengths, capacity)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    opened = fill < capacity
    certified = len(fill) == bin_bound(lengths, capacity)
    order = np.argsort(bins, kind="stable")
    total = np.cumsum(lengths[order]) - lengths[order]
    first = np.r_[True, np.diff(bins[order]) != 0]
    offset = np.empty_like(total)
    offset[order] = total - np.maximum.accumulate(np.where(first, total, 0))
    return pd.DataFrame({"uid": group["uid"], "length": lengths, "part": group["part"], "bin": bins, "offset": offset, "open": opened[bins], "certified": certified})


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """items: uid long (unique), length long in 1..capacity. Returns uid, sequence_id, offset."""

    def deal(df: DataFrame, n: int, salt: int) -> DataFrame:
        dealt = df.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(max(1, -(-n // group)))).alias("part"))
        packed = dealt.groupBy("part").applyInPandas(lambda g: _pack(g, capacity), "uid long, length long, part long, bin long, offset long, open boolean, certified boolean")
        return staged(packed.withColumn("round", F.lit(salt)), "packed")

    def opened(df: DataFrame) -> tuple[int, int, int]:
        """Bins not full, what lies in them, and partitions with a gap: short of their bound, or
        with several bins not full."""
        bins = df.where("open").groupBy("part", "bin").agg(F.count("*").alias("n"), F.every("certified").alias("ok"))
        parts = bins.groupBy("part").agg(F.count("*").alias("bins"), F.sum("n").alias("n"), F.every("ok").alias("ok"))
        got = parts.agg(F.sum("bins"), F.sum("n"), F.count_if((~F.col("ok")) | (F.col("bins") > 1)), F.count("*")).first()
        return got[0] or 0, got[1] or 0, max(got[2], got[3] - 1)

    now = deal(items, items.count(), 0)
    done = [now.where("not open")]
    (bins, n, gaps), full = opened(now), now.where("not open").select("part", "bin").distinct().count()
    count = np.zeros(capacity + 1)
    for length, many in items.groupBy("length").count().collect():  # as many rows as there are lengths
        count[length] = many
    bound = bin_bound(np.empty(0), capacity, count)
    salt = 0
    while gaps and full + bins > bound:
        salt += 1
        again = deal(now.where("open"), n, salt)
        made = again.select("part", "bin").distinct().count()
        if made >= bins:
            break
        now = again
        done.append(now.where("not open"))
        (bins, n, gaps), filled = opened(now), now.where("not open").select("part", "bin").distinct().count()
        full += filled
    done.append(now.where("open"))
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    seq = F.shiftleft(F.col("round").cast("long"), 56) + F.shiftleft("part", 28) + F.col("bin")
    return out.select("uid", seq.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every document's pieces with their sequence and place in it. Null text is empty and packs
    as its end id alone; repeated rows are packed each; an empty table gives no rows."""
    cut_up = staged(pieces(docs, path, capacity, keep).withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    placed = pack(cut_up.select(F.col("_uid").alias("uid"), "length"), capacity)
    return cut_up.join(placed, cut_up["_uid"] == placed["uid"]).drop("_uid", "uid")
