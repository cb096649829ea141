"""First-match-wins classification, compiled from rule tables to CASE expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Rules = Iterable[tuple[str, str]]

def first_match(text: Column, rules: Rules, ignore_case: bool = False) -> Column:
    """The category of the first pattern found in ``text``; null if none is."""
    out = F.lit(None).cast("string")
    for pattern, category in reversed(list(rules)):
        out = F.when(text.rlike(("(?i)" if ignore_case else "") + pattern), category).otherwise(out)
    return out


def lookup(key: Column, table: dict[str, str], default: Column | None = None) -> Column:
    found = reduce(lambda acc, kv: F.when(key == kv[0], kv[1]).otherwise(acc), table.items(), F.lit(None).cast("string"))
    return found if default is None else F.coalesce(found, default)


def classify(df: DataFrame, text: str, out: str, rules: Rules, scopes: dict[str, str] | None = None, overrides: dict[str, str] | None = None, ignore_case: bool = False) -> DataFrame:
    """Overrides by exact value, then none for values that state a scope, then the rules. Rules run
    once per distinct value, which then meets its rows by an equi-join."""
    names = df.select(text).where(F.col(text).isNotNull()).distinct()
    member = F.col(text)
    ruled = first_match(member, rules, ignore_case)
    if scopes:
        ruled = F.when(lookup(member, scopes).isNull(), ruled)
    return df.join(names.withColumn(out, lookup(member, overrides or {}, ruled)), text, "left")


def unmapped(df: DataFrame, text: str, category: str, least: int = 1) -> DataFrame:
    """Values that no rule names and how often they occur, the most frequent first."""
    lost = df.where(F.col(category).isNull() & F.col(text).isNotNull())
    return lost.groupBy(text).agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), text)


def closure(spark: SparkSession, tree: dict[str, str | None]) -> DataFrame:
    """(ancestor, descendant) of a category tree: as small as the rule table it comes from."""
    rows = []
    for name in tree:
        up = tree[name]
        while up is not None:
            rows.append((up, name))
            up = tree[up]
    return spark.createDataFrame(rows, "ancestor string, descendant string")
