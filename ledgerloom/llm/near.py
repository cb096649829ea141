"""Near-duplicate classes out of sketches: buckets, families, exact verification.

A sketch has a row per text: uid, name (16 bytes; equal names are copies), keys (band keys), sig (a
byte per register) and w (characters). What makes two texts alike is a ``Rule``.

1. Equal names become one node.
2. Families: the members of a key's bucket are compared, by signature, with its most central member
   (the one whose buckets hold the most texts), so a bucket of n costs n pairs. Where some members do
   not agree with that one, all pairs that it has not settled are compared. Texts connected by
   agreeing pairs are a family.
3. Each text of a family is verified with the family's most central one.
4. Within each family that is not one class yet, all pairs of different classes whose signatures
   agree are verified, the most agreeing first; a pair that a link has meanwhile brought into one
   class needs no look. So every pair that shares a bucket is verified, excluded by its signature,
   or in one class.

All pairs of a group are compared in blocks of bounded size, every two of which meet in one task. A
meeting yields fewer links than it has rows, so nothing that is written grows with the square of a
group.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import components, linked_in_blocks, mix, per_block, rows_to_meet, staged, width

#: Members that meet one copy of their family's central text.
SHARE = 1000


@dataclass(frozen=True)
class Rule:
    """registers of a signature, how many of them an alike pair has in common, and what holds a list
    of texts and tells which of ``others`` are alike to text i: ``hold(texts).alike(i, others)``."""

    registers: int
    least: int
    hold: Callable

    def signs(self, column) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, self.registers)


#: Bits of the filter that tells which rows a join can leave out: 16 for each id, at most 16 MB in all.
LEAST_BITS, MOST_BITS, SLICES = 1 << 16, 1 << 27, 16


def maybe_in(ids: DataFrame, n: int) -> Callable[[Column], Column]:
    """A condition on ids that holds for all of ``ids`` (one long column of n rows) and few others: one
    hash into a bit map. Where very many ids fill it, it only lets more rows through. Tasks send the
    map in slices, which are joined as they come."""
    name, bits = ids.columns[0], min(MOST_BITS, max(LEAST_BITS, 1 << (16 * n).bit_length()))
    size = bits // 8 // SLICES

    def places(values: np.ndarray) -> np.ndarray:
        return (mix(values.astype(np.int64).view(np.uint64)) % np.uint64(bits)).astype(np.int64)

    def rows(found: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], ["slice", "bits"])

    def local(batches):
        held = np.zeros(bits, bool)
        for batch in batches:
            held[places(np.asarray(batch.column(name)))] = True
        packed = np.packbits(held).reshape(SLICES, size)
        yield rows({k: x for k, x in enumerate(packed) if x.any()})

    def merge(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("slice").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                found[k] = np.frombuffer(raw, np.uint8) | found.get(k, np.uint8(0))
        yield rows(found)

    schema = "slice int, bits binary"
    total = np.zeros((SLICES, size), np.uint8)
    for row in ids.mapInArrow(local, schema).repartition(SLICES, "slice").mapInArrow(merge, schema).collect():
        total[row["slice"]] |= np.frombuffer(bytes(row["bits"]), np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(total.tobytes())

    @F.pandas_udf("boolean")
    def hit(col: pd.Series) -> pd.Series:
        at = places(col.to_numpy())
        return pd.Series((np.frombuffer(shared.value, np.uint8)[at >> 3] >> (7 - (at & 7)) & 1).astype(bool))

    return lambda column: hit(column)


def _agreeing(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Of the pairs (lead, id) those whose signatures agree in enough registers."""

    def agree(batches):
        for batch in batches:
            same = (rule.signs(batch.column("x")) == rule.signs(batch.column("y"))).sum(1)
            yield batch.select(["lead", "id"]).filter(pa.array(same >= rule.least))

    sig = nodes.select("id", "sig")
    met = pairs.join(sig.toDF("lead", "x"), "lead").join(sig.toDF("id", "y"), "id").select("lead", "id", "x", "y")
    return staged(met.mapInArrow(agree, "lead bigint, id bigint"), "candidates")


def _verified(best: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b): of each id with its lead, if that is near enough. A lead's text travels once to
    every ``SHARE`` of its members."""
    spark = best.sparkSession
    many = best.groupBy("lead").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    member = best.where("lead <> id").join(many, "lead").select("lead", F.pmod(F.xxhash64("id"), "shares").cast("int").alias("share"), F.lit(1).alias("kind"), "id")
    leader = many.select("lead", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"), F.col("lead").alias("id"))

    def run(batches):
        lead = None  # the text of the leader whose members come
        for batch in batches:
            for part in per_block(lambda b: b, "t", 2_000_000)([batch]):
                texts = part.column("t").to_pylist()
                kind, own, share, ids = (part.column(c).to_numpy() for c in ("kind", "lead", "share", "id"))
                shift = int(lead is not None)
                held = rule.hold(pa.array(([lead] if shift else []) + texts, part.schema.field("t").type))
                starts = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (share[1:] != share[:-1])])
                a, b = [], []
                for x, y in zip(starts.tolist(), np.r_[starts[1:], len(ids)].tolist(), strict=True):
                    first = x + (kind[x] == 0)
                    at = x + shift if kind[x] == 0 else 0
                    if kind[x] == 0:
                        lead = texts[x]
                    hit = np.arange(first, y)[held.alike(at, np.arange(first, y) + shift)]
                    a.append(np.full(len(hit), own[x])), b.append(ids[hit])
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

    met = member.unionByName(leader).join(texts, "id").repartition(width(spark), "lead", "share").sortWithinPartitions("lead", "share", "kind")
    return staged(met.select("lead", "share", "kind", "id", "t").mapInArrow(run, "a bigint, b bigint"), "links")


def _agree(rule: Rule):
    """Finds pairs whose signatures agree, as many as connect all that do."""

    def find(ids: np.ndarray, roots: np.ndarray, held: pa.Table, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        order, of, look = rows_to_meet(roots)
        ids, sig = ids[order], rule.signs(held.column("sig"))[order]
        side = None if side is None else side[order]
        a, b = [], []
        for i in range(look):
            other = of[i + 1 :] != of[i]
            if side is not None:
                other &= side[i + 1 :] != side[i]
            at = i + 1 + np.flatnonzero(other)
            at = at[(sig[at] == sig[i]).sum(1) >= rule.least]
            for k, j in zip(*np.unique(of[at], return_index=True), strict=True):
                a.append(ids[i]), b.append(ids[at[j]])
                of[of == k] = of[i]
        return np.array(a, np.int64), np.array(b, np.int64)

    return find


def _near(rule: Rule):
    """Finds alike pairs, as many as connect all; the most agreeing are verified first."""

    def find(ids: np.ndarray, roots: np.ndarray, held: pa.Table, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        order, of, look = rows_to_meet(roots)
        ids, sig = ids[order], rule.signs(held.column("sig"))[order]
        side = None if side is None else side[order]
        texts = rule.hold(held.column("t").combine_chunks().take(pa.array(order)))
        a, b = [], []
        for i in range(look):
            other = of[i + 1 :] != of[i]
            if side is not None:
                other &= side[i + 1 :] != side[i]
            at = i + 1 + np.flatnonzero(other)
            same = (sig[at] == sig[i]).sum(1)
            at = at[np.argsort(-same, kind="stable")][: (same >= rule.least).sum()]
            step = 8
            while len(at):
                now, at = at[:step], at[step:]
                for j in now[texts.alike(i, now)].tolist():
                    if of[j] != of[i]:
                        a.append(ids[i]), b.append(ids[j])
                        of[of == of[j]] = of[i]
                at, step = at[of[at] != of[i]], 4 * step
        return np.array(a, np.int64), np.array(b, np.int64)

    return find


def classes(sketched: DataFrame, texts: Callable[[DataFrame, int], DataFrame], rule: Rule) -> DataFrame:
    """uid, root (the least uid of the class) of every row of the sketch. ``texts`` gives id and text
    (t) of the nodes asked for (id, name; an id is the least uid of its name) and how many they are."""
    rows = sketched.select("uid", "name")
    named = rows.groupBy("name").agg(F.min("uid").alias("id"))
    nodes = staged(named.join(sketched.select(F.col("uid").alias("id"), "keys", "sig", "w"), "id"), "nodes")
    sig = nodes.select("id", "sig")
    keyed = staged(nodes.select("id", F.explode("keys").alias("key")), "bands")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = staged(keyed.join(sizes, "key"), "buckets")
    central = staged(shared.groupBy("id").agg(F.struct(F.sum("n").alias("c"), F.xxhash64("id").alias("h")).alias("rank")), "central")
    ranked = shared.join(central, "id").select("key", "id", "rank")
    hubs = ranked.groupBy("key").agg(F.max_by("id", "rank").alias("lead"))
    met = staged(shared.select("key", "id").join(hubs, "key"), "members")
    close = _agreeing(met.select("lead", "id").where("lead <> id").distinct(), nodes, rule)
    settled = met.join(close.withColumn("same", F.lit(True)), ["lead", "id"], "left")
    open_ = settled.select(F.col("key").alias("g"), "id", F.when(F.coalesce("same", F.lit(False)), F.col("lead")).otherwise(F.col("id")).alias("r"), F.lit(rule.registers).alias("w"))
    more = linked_in_blocks(open_, sig, _agree(rule), "family-links")
    families = components(close.select(F.col("lead").alias("a"), F.col("id").alias("b")).unionByName(more))
    inside = families.select(F.col("root").alias("g"), F.col("node").alias("id")).join(central, "id")
    leads = inside.groupBy("g").agg(F.max_by("id", "rank").alias("lead"))
    inside = staged(inside.select("g", "id").join(leads, "g"), "families")
    text = staged(texts(inside.select("id").join(nodes.select("id", "name"), "id"), inside.count()), "candidate-texts")
    links = _verified(inside.select("lead", "id"), text, rule)
    hit = links.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("hit", F.lit(True))
    inside = inside.join(hit, "id", "left").withColumn("r", F.when(F.coalesce("hit", F.lit(False)), F.col("lead")).otherwise(F.col("id")))
    inside = inside.join(nodes.select("id", "w"), "id").select("g", "id", "r", "w")
    roots = components(links.unionByName(linked_in_blocks(inside, sig.join(text, "id"), _near(rule), "late-links")))
    rooted = named.join(roots, named["id"] == roots["node"], "left").select("name", F.coalesce("root", "id").alias("root"))
    return rows.join(rooted, "name").select("uid", "root")
