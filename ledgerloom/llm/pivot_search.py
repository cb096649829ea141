"""Exact top-k by inner product with pivot-table elimination.

Distances to ``PIVOTS`` vectors are worked out once per row and kept as a table: rows lie in blocks,
each in cells of ``CELL`` rows that are near the same pivot, and a cell keeps the least and greatest
distance of its rows to every pivot. For a query q and a cell, the greatest lower bound b on the
distance over all pivots caps the inner product at (|q|^2 + |x|^2 - b^2) / 2. Cells are evaluated in
the order of their caps until no cap left reaches the k-th best score; bounds and products are matrix
operations over all queries of a block.

Blocks are dropped before any vector moves: the pivot tables alone (packed in pages) meet the
queries, whose first k-th score comes from the bounded sample that the pivots are drawn from. Only
the queries that a block could still serve travel to it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged, width

PIVOTS, SCALE = 32, 256
#: Rows of the sample (and the bytes it may take), of a sorted stretch, of a block, of a cell; queries
#: of a block; blocks of a page.
SAMPLE, SAMPLE_BYTES, STRETCH, ROW_BLOCK, CELL, QUERY_BLOCK, PAGE = 2000, 16_000_000, 32_768, 4096, 32, 2048, 4096


def choose_pivots(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Farthest-first from the vector of the greatest norm."""
    if not len(sample):
        return sample
    norm = (sample * sample).sum(1)
    chosen = [int(norm.argmax())]
    far = np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        gap = sample - sample[chosen[-1]]
        far = np.minimum(far, (gap * gap).sum(1))
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    sq = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)
    return np.sqrt(np.maximum(sq, 0))


def near_order(x: np.ndarray, ids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Rows by their nearest pivot, the distance to it, and id."""
    d = distances(x, pivots)
    near = d.argmin(1)
    return np.lexsort((ids, d[np.arange(len(x)), near], near))


def pivot_table(x: np.ndarray, ids: np.ndarray, pivots: np.ndarray, cell: int = CELL) -> np.ndarray:
    """Per cell of consecutive rows: least and greatest distance to every pivot, the greatest
    squared norm, and the least id (exact as long as ids stay below 2^53, lower otherwise)."""
    d, at = distances(x, pivots), np.arange(0, len(x), cell)
    low, high = np.minimum.reduceat(d, at), np.maximum.reduceat(d, at)
    least = np.minimum.reduceat(ids, at)
    least = np.where(np.abs(least) < 2**53, least, -np.inf)
    return np.column_stack([low, high, np.maximum.reduceat((x * x).sum(1), at), least])


def caps(q: np.ndarray, table: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """What no inner product of a query with a row of a cell exceeds (queries x cells). Products of
    whole numbers are whole, so the cap is rounded down, by a margin that arithmetic stays within."""
    p = len(pivots)
    dq, nq = distances(q, pivots), (q * q).sum(1)[:, None]
    low = np.zeros((len(q), len(table)))
    for i in range(p):
        np.maximum(low, table[:, i] - dq[:, i : i + 1], out=low)
        np.maximum(low, dq[:, i : i + 1] - table[:, p + i], out=low)
    top = table[:, 2 * p]
    cap = np.minimum((nq + top - low * low) / 2, np.sqrt(nq * top))
    return np.floor(cap + 1e-9 * (nq + top) + 1e-6)


def search(q: np.ndarray, q_uid: np.ndarray, least: np.ndarray, x: np.ndarray, x_id: np.ndarray, x_uid: np.ndarray, table: np.ndarray, pivots: np.ndarray, k: int, cell: int = CELL) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Of each query its k best rows of the block that score ``least`` or more, ties to the smaller
    id: (query index, id, score), and the number of inner products taken. A row is no candidate for
    itself (the same uid)."""
    cap = caps(q, table, pivots)
    best = np.full((len(q), k), -np.inf)
    ids = np.full((len(q), k), np.iinfo(np.int64).max)
    kth, taken = least.copy(), 0
    for j in np.argsort(-cap.max(0, initial=-np.inf), kind="stable").tolist():
        c = cap[:, j]
        need = np.flatnonzero((c > kth) | ((c == kth) & ((best[:, -1] < kth) | (table[j, -1] < ids[:, -1]))))
        if not len(need):
            continue
        rows = slice(j * cell, j * cell + cell)
        s = q[need] @ x[rows].T
        s[q_uid[need][:, None] == x_uid[rows]] = -np.inf
        taken += s.size
        better = s.max(1) >= kth[need]
        need, s = need[better], s[better]
        if not len(need):
            continue
        all_s = np.concatenate([best[need], s], 1)
        all_id = np.concatenate([ids[need], np.broadcast_to(x_id[rows], s.shape)], 1)
        keep = np.lexsort((all_id, -all_s), axis=1)[:, :k]
        best[need], ids[need] = np.take_along_axis(all_s, keep, 1), np.take_along_axis(all_id, keep, 1)
        kth[need] = np.maximum(kth[need], best[need, -1])
    of, at = np.nonzero((best >= least[:, None]) & (best > -np.inf))
    return of, ids[of, at], best[of, at], taken


def first_kth(q: np.ndarray, q_uid: np.ndarray, sample: np.ndarray, sample_uid: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query within the sample, -inf if it has fewer rows."""
    if len(sample) <= k:
        return np.full(len(q), -np.inf)
    s = q @ sample.T
    s[q_uid[:, None] == sample_uid] = -np.inf
    return np.partition(s, len(sample) - k, axis=1)[:, len(sample) - k]


def top_k(rows: DataFrame, is_query, k: int = 5, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query row's k best other rows.

    Components become floor(256 x). Null vectors and those with null or non-finite components, and
    rows without an id, take no part; a shorter vector counts as padded with zeros. Inner products
    are exact while they stay below 2^53. Repeated rows are rows of their own, told apart by the
    place they are read from. Other columns of ``rows``, whatever their names, are not looked at."""
    spark = rows.sparkSession
    sound = F.col(vec).isNotNull() & F.forall(F.col(vec), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.col(key).isNotNull()
    ints = F.transform(F.col(vec), lambda v: F.floor(v.cast("double") * SCALE).cast("double"))
    usable = staged(
        rows.where(F.coalesce(sound, F.lit(False))).select(F.monotonically_increasing_id().alias("uid"), F.col(key).cast("long").alias("id"), ints.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")),
        "vectors",
    )
    facts = usable.agg(F.max(F.size("v")), F.count_if("asks"), F.count("*")).first()
    dim, asked, many = facts[0] or 0, facts[1], facts[2]
    if not dim or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    few = usable.orderBy(F.xxhash64("id", "uid")).limit(max(2 * k, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))).select("uid", "v").collect()
    sample, sample_uid = _matrix(pa.array([r["v"] for r in few], pa.list_(pa.float64())), dim), np.array([r["uid"] for r in few], np.int64)
    pivots = choose_pivots(sample)

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, ROW_BLOCK):
                part = batch.slice(a, ROW_BLOCK)
                held.append((_matrix(part.column("v"), dim), np.stack([np.asarray(part.column("id")), np.asarray(part.column("uid"))])))
                n += part.num_rows
                if n >= STRETCH:
                    yield from blocks_of(held)
                    held, n = [], 0
        if n:
            yield from blocks_of(held)

    def blocks_of(held):
        x, ids = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held], 1)
        order = near_order(x, ids[0], pivots)
        x, ids = x[order], ids[:, order]
        for a in range(0, len(x), ROW_BLOCK):
            part, own = x[a : a + ROW_BLOCK], ids[:, a : a + ROW_BLOCK]
            table = pivot_table(part, own[0], pivots)
            p = len(pivots)
            whole = np.concatenate([table[:, :p].min(0), table[:, p : 2 * p].max(0), table[:, 2 * p :].max(0)[:1], table[:, -1:].min(0)])
            yield _row(("ids", own.astype("<i8")), ("x", part.astype("<f8")), ("cells", table), ("outline", whole))

    packed = usable.select("id", "uid", "v").mapInArrow(pack, "ids binary, x binary, cells binary, outline binary")
    blocks = staged(packed.withColumn("b", F.monotonically_increasing_id()), "blocks")
    pages, groups = -(-many // (ROW_BLOCK * PAGE)), -(-asked // QUERY_BLOCK)

    def page(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"p": [group["p"].iloc[0]], "bs": [group["b"].to_numpy("<i8").tobytes()], "outlines": [b"".join(group["outline"])]})

    outlines = blocks.select("b", "outline").withColumn("p", F.pmod(F.xxhash64("b"), F.lit(pages)).cast("int"))
    outlines = outlines.groupBy("p").applyInPandas(page, "p int, bs binary, outlines binary")

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        q, uid = _matrix(pa.array(group["v"], pa.list_(pa.float64())), dim), group["uid"].to_numpy()
        kth = np.concatenate([first_kth(q[a : a + 512], uid[a : a + 512], sample, sample_uid, k) for a in range(0, len(q), 512)])
        return pd.DataFrame({"q_ids": [np.stack([group["id"], uid]).astype("<i8").tobytes()], "kth": [kth.tobytes()], "q": [q.tobytes()]})

    ask = usable.where("asks").withColumn("g", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")).select("g", "id", "uid", "v")
    ask = ask.groupBy("g").applyInPandas(gather, "q_ids binary, kth binary, q binary")
    ask = ask.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))

    def reach(batches):
        for row in _rows(batches, "q_ids", "kth", "q", "bs", "outlines"):
            qid, kth, q = np.frombuffer(row["q_ids"], "<i8").reshape(2, -1), np.frombuffer(row["kth"]), np.frombuffer(row["q"]).reshape(-1, dim)
            outline = np.frombuffer(row["outlines"]).reshape(-1, 2 * len(pivots) + 2)
            for a, b in enumerate(np.frombuffer(row["bs"], "<i8").tolist()):
                at = np.flatnonzero(caps(q, outline[a : a + 1], pivots)[:, 0] >= kth)
                if len(at):
                    yield _row(("q_ids", qid[:, at]), ("kth", kth[at]), ("q", q[at]), b=b)

    wanted = ask.join(outlines, "p").select("q_ids", "kth", "q", "bs", "outlines").mapInArrow(reach, "b long, q_ids binary, kth binary, q binary")

    def run(batches):
        for row in _rows(batches, "ids", "x", "cells", "q_ids", "kth", "q"):
            rid, qid = (np.frombuffer(row[c], "<i8").reshape(2, -1) for c in ("ids", "q_ids"))
            x, q = (np.frombuffer(row[c]).reshape(-1, dim) for c in ("x", "q"))
            table = np.frombuffer(row["cells"]).reshape(-1, 2 * len(pivots) + 2)
            of, got, score, _ = search(q, qid[1], np.frombuffer(row["kth"]), x, rid[0], rid[1], table, pivots, k)
            yield pa.RecordBatch.from_arrays([pa.array(qid[1][of]), pa.array(qid[0][of]), pa.array(got), pa.array(score.astype(np.int64))], ["uid", "query_id", "vec_id", "score"])

    met = wanted.repartition(width(spark), "b").join(blocks, "b")
    found = met.select("ids", "x", "cells", "q_ids", "kth", "q").mapInArrow(run, "uid long, query_id long, vec_id long, score long")
    # a block gives at most k rows per query; the window's rank limit is also applied before its shuffle
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _row(*arrays: tuple[str, np.ndarray], **longs: int) -> pa.RecordBatch:
    """One row: ``longs`` first, then the arrays' bytes."""
    cols = {n: pa.array([v], pa.int64()) for n, v in longs.items()} | {n: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for n, x in arrays}
    return pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def _rows(batches, *names: str):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in names}


def _matrix(vectors: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of a list column, those shorter than ``dim`` padded with zeros."""
    size = np.asarray(pc.list_value_length(vectors)).astype(np.int64)
    out = np.zeros((len(vectors), dim))
    out[np.arange(dim) < size[:, None]] = np.asarray(vectors.flatten())
    return out
