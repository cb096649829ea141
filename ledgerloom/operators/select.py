"""Restatement-aware deduplication and the choice of one row, or one breakdown, per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_one(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The first row of each key; give an order that leaves no ties."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def deduplicate(df: DataFrame, key: list[str], value: str, order: list[str], tolerance: float = 0.005) -> DataFrame:
    """The latest version of each fact, with n_versions and whether its values differ by more than
    ``tolerance`` of the largest. One aggregation, combined before the shuffle; null keys group."""
    rest = [c for c in df.columns if c not in key]
    top, low = F.max(value), F.min(value)
    picked = df.groupBy(*key).agg(
        F.max_by(F.struct(*rest), F.struct(*order, *(c for c in rest if c not in order))).alias("_latest"),
        F.count("*").alias("n_versions"),
        (F.abs(top - low) / F.greatest(F.abs(top), F.lit(1.0)) > tolerance).alias("_moved"),
    )
    return picked.select(*key, "_latest.*", "n_versions", F.coalesce("_moved", F.lit(False)).alias("restated"))


def best_signature(df: DataFrame, key: list[str], tag: str, axes: str, value: str, tags: list[str], prefer: str = "parsimony", subslices: tuple[str, ...] = (), modern: tuple[str, ...] = ()) -> DataFrame:
    """Keep, per key, the rows of one (tag, axes) pair, so that breakdowns are never mixed.

    Pairs rank by the tag's place in ``tags``, whether they hold a sub-slice axis, whether they lack
    every modern axis, and then fewest axes before greatest coverage (``parsimony``) or the other
    way round (``coverage``); ties go to the lesser axes string. ``axes`` joins names by ``|``; a
    sub-slice is named by any part of an axis."""
    parts = F.filter(F.split(F.coalesce(axes, F.lit("")), r"\|"), lambda x: x != "")
    hits = lambda names: F.size(F.array_intersect(parts, F.array(*(F.lit(n) for n in names)).cast("array<string>"))) > 0
    place = F.array_position(F.array(*(F.lit(t) for t in tags)), F.col(tag))
    cover, n = -F.round(F.sum(F.abs(value)), 2), F.size(parts)  # sums in another order stay ties
    per_pair = df.groupBy(*key, tag, axes).agg(cover.alias("_less"))
    rank = [F.when(place > 0, place).otherwise(len(tags) + 1), reduce(lambda a, b: a | b, (F.coalesce(F.col(axes), F.lit("")).contains(x) for x in subslices), F.lit(False)), ~hits(modern) if modern else F.lit(False)]
    rank += [n, F.col("_less")] if prefer == "parsimony" else [F.col("_less"), n]
    best = per_pair.groupBy(*key).agg(F.min_by(F.struct(tag, axes), F.struct(*(r.alias(f"r{i}") for i, r in enumerate(rank)), F.col(axes), F.col(tag))).alias("_best"))
    left, right = df.alias("l"), best.alias("r")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key]
    return left.join(right, same).where(F.col(f"l.{tag}").eqNullSafe(F.col(f"r._best.{tag}")) & F.col(f"l.{axes}").eqNullSafe(F.col(f"r._best.{axes}"))).select("l.*")


def sum_members(df: DataFrame, key: list[str], members: list[str], value: str, order: list[str], out: str) -> DataFrame:
    """Latest value per member set; equal values of one key are aliases and count once; then the sum."""
    latest = df.groupBy(*key, *members).agg(F.max_by(value, F.struct(*order, value)).alias("_v"))
    return latest.groupBy(*key).agg(F.sum_distinct("_v").alias(out))


def drop_fragments(df: DataFrame, key: list[str], value: str, ratio: float = 10.0) -> DataFrame:
    """Drop values more than ``ratio`` times smaller than the key's largest."""
    biggest = F.max(F.abs(value)).over(Window.partitionBy(*key))
    return df.withColumn("_big", biggest).where((F.col("_big") <= 0) | (F.abs(value) * ratio >= F.col("_big"))).drop("_big")


def fill_from(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Full outer union of two frames by key: the left value, else the right one, column by column."""
    shared = [c for c in left.columns if c in right.columns and c not in key]
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in shared})
    both = left.join(r, key, "full")
    return both.withColumns({c: F.coalesce(c, f"_r_{c}") for c in shared}).drop(*(f"_r_{c}" for c in shared)) if shared else both


def first_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows in an order that leaves no ties: each task keeps ``n``, one merges them."""
    return df.orderBy(*order).limit(n)
