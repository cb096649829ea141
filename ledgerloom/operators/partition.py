"""Sums over category trees that never count a rollup beside its parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import null_aware_sum


def partition_parts(df: DataFrame, key: list[str], category: str, value: str, closure: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Per key and category the sum, with contained = whether its descendants present add up to it.

    In long form: the sums meet the (ancestor, descendant) table, which is as small as the tree that
    it is made from and so is broadcast, and each other by an equi-join on the key."""
    sums = df.groupBy(*key, category).agg(F.sum(value).alias("_v"))
    up = F.broadcast(closure)
    below = sums.join(up, sums[category] == up["descendant"]).groupBy(*key, F.col("ancestor").alias(category)).agg(F.sum("_v").alias("_below"))
    left, right = sums.alias("s"), below.alias("b")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*key, category]]
    gap = F.abs(F.col("_v") - F.col("_below")) <= F.abs("_v") * tolerance
    inside = F.coalesce((F.col("_below") != 0) & gap, F.lit(False))
    return left.join(right, same, "left").select("s.*", inside.alias("contained")).withColumnRenamed("_v", value)


def partition_total(df: DataFrame, key: list[str], category: str, value: str, closure: DataFrame, out: str, tolerance: float = 0.001) -> DataFrame:
    parts = partition_parts(df, key, category, value, closure, tolerance)
    return parts.groupBy(*key).agg(F.sum(F.when(F.col("contained"), 0.0).otherwise(F.col(value))).alias(out))


def with_fallback(reported: DataFrame, built: DataFrame, key: list[str], value: str) -> DataFrame:
    """The reported total, else the built one; keys of either side stay."""
    other = built.withColumnRenamed(value, "_built")
    return reported.join(other, key, "full").withColumn(value, F.coalesce(value, "_built")).drop("_built")


def partition_check(df: DataFrame, leaves: list[str], total: str, less: str | None = None, unless: str | None = None) -> DataFrame:
    """residual = leaves - ``less`` - total, its share of the total and what is unallocated; null
    where the ``unless`` count is over zero, since backfilled rows have no leaves."""
    gap = null_aware_sum(*map(F.col, leaves)) - (F.coalesce(less, F.lit(0.0)) if less else F.lit(0.0)) - F.col(total)
    if unless:
        gap = F.when(F.coalesce(unless, F.lit(0)) == 0, gap)
    return df.withColumns({"partition_residual": gap}).withColumns({
        "partition_residual_pct": F.when(F.abs(total) > 0, F.col("partition_residual") / F.col(total) * 100),
        "unallocated": -F.col("partition_residual"),
    })


def built_totals(df: DataFrame, totals: dict[str, list[str]], flag: str) -> DataFrame:
    """Each total, else the null-aware sum of its parts; ``flag``: whether any total was missing."""
    missing = [F.col(t).isNull() for t in totals]
    any_missing = missing[0]
    for m in missing[1:]:
        any_missing = any_missing | m
    return df.withColumns({flag: any_missing, **{t: F.coalesce(t, null_aware_sum(*map(F.col, parts))) for t, parts in totals.items()}})


def ladder(df: DataFrame, index: list[str], bucket: str, value: str, buckets: list[str], prefix: str, rollups: dict[str, list[str]]) -> DataFrame:
    """One pivot with a stated column list, then sums of buckets where a rollup is not reported
    itself. A rollup may name an earlier one."""
    wide = df.groupBy(*index).pivot(bucket, buckets).agg(F.sum(value))
    out = wide.withColumnsRenamed({b: f"{prefix}{b}" for b in buckets})
    for name, parts in rollups.items():
        built = null_aware_sum(*(F.col(f"{prefix}{p}") for p in parts))
        out = out.withColumn(f"{prefix}{name}", F.coalesce(F.col(f"{prefix}{name}"), built) if f"{prefix}{name}" in out.columns else built)
    return out
