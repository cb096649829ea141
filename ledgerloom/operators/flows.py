"""Quarterly flows out of year-to-date figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.periods import previous_quarter_end


def reported_or_derived(df: DataFrame, key: list[str], start: str, end: str, value: str, filed: str, span: tuple[int, int] = (80, 100)) -> DataFrame:
    """Quarter values of duration facts: those reported over 80 to 100 days, else the difference of
    two cumulative figures from one start whose spans differ by as much. Reported ones win, then the
    latest filed. Adds basis: reported or derived."""
    facts = df.where(F.col(start).isNotNull()).withColumn("_span", F.datediff(end, start))
    native = facts.where(F.col("_span").between(*span)).withColumn("basis", F.lit("reported"))
    latest = Window.partitionBy(*key, start, end).orderBy(F.desc_nulls_last(filed), F.desc(value))
    cumulative = facts.withColumn("_r", F.row_number().over(latest)).where("_r = 1").drop("_r")
    along = Window.partitionBy(*key, start).orderBy(end)
    implied = F.col("_span") - F.coalesce(F.lag("_span").over(along), F.lit(0))
    step = F.col(value) - F.coalesce(F.lag(value).over(along), F.lit(0.0))
    derived = cumulative.withColumns({"_implied": implied, "_step": step, "_first": F.lag("_span").over(along).isNull()})
    derived = derived.where(F.col("_implied").between(*span) & ~F.col("_first")).withColumn(value, F.col("_step")).withColumn("basis", F.lit("derived"))
    both = native.unionByName(derived.drop("_implied", "_step", "_first"))
    best = Window.partitionBy(*key, end).orderBy(F.desc("basis"), F.desc_nulls_last(filed), F.asc(start), F.desc(value))
    return both.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r", "_span")


def quarterise(df: DataFrame, entity: str, period: str, flows: list[str], monotone: list[str] | None = None, pooled: DataFrame | None = None, drop: float = 0.5) -> DataFrame:
    """Year-to-date columns to quarterly ones, all flows in one window.

    The first quarter stands as it is; a later one is the difference to the quarter before, and null
    where that row is missing. A fall of a monotone flow by more than ``drop`` means that the books
    began anew: the figure stands, and flow_reset says so. ``pooled`` (entity, predecessor, period)
    lists mergers whose survivor restates the year: after a first quarter, the predecessor's
    year-to-date figure of the quarter before is taken off as well."""
    w = Window.partitionBy(entity).orderBy(period)
    day = F.col(period)
    first = F.quarter(day) == 1
    before = F.lag(period).over(w)
    joined = (F.year(before) == F.year(day)) & (F.quarter(before) == F.quarter(day) - 1)
    fell = [F.coalesce((F.lag(c).over(w) - F.col(c)) > drop, F.lit(False)) for c in (flows if monotone is None else monotone)]
    reset = ~first & F.coalesce(joined, F.lit(False)) & reduce(lambda a, b: a | b, fell, F.lit(False))
    out = df.withColumns({"flow_reset": reset, "_joined": F.coalesce(joined, F.lit(False)), **{f"_b_{c}": F.lag(c).over(w) for c in flows}})
    plain = {c: F.when(first | F.col("flow_reset"), F.col(c)).when(F.col("_joined"), F.col(c) - F.col(f"_b_{c}")) for c in flows}
    if pooled is None:
        return out.withColumns(plain).drop("_joined", *(f"_b_{c}" for c in flows))
    late = pooled.where(F.quarter(period) > 1).select(F.col(entity).alias("_e"), F.col(period).alias("_p"), F.col("predecessor").alias("_x"), previous_quarter_end(F.col(period)).alias("_q"))
    absorbed = df.select(F.col(entity).alias("_x"), F.col(period).alias("_q"), *(F.col(c).alias(f"_a_{c}") for c in flows))
    takes = late.join(absorbed, ["_x", "_q"]).groupBy("_e", "_p").agg(*(F.sum(f"_a_{c}").alias(f"_a_{c}") for c in flows))
    out = out.withColumns(plain).join(takes, (F.col(entity) == F.col("_e")) & (F.col(period) == F.col("_p")), "left")
    less = {c: F.when(F.col("flow_reset"), F.col(c)).otherwise(F.col(c) - F.coalesce(f"_a_{c}", F.lit(0.0))) for c in flows}
    return out.withColumns(less).drop("_joined", "_e", "_p", *(f"_b_{c}" for c in flows), *(f"_a_{c}" for c in flows))
