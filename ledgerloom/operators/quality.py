"""Coverage, sanity flags, cross-source differences and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import ratio
from .fill import unpivot


def coverage(df: DataFrame, entity: list[str], columns: list[str], sparse: float = 60.0, not_applicable: DataFrame | None = None) -> DataFrame:
    """Per entity and variable: rows, rows with a value, their share, and status (n/a, missing,
    sparse under 60 %, ok). ``not_applicable``: (entity..., variable)."""
    long = unpivot(df, entity, columns)
    out = long.groupBy(*entity, "variable").agg(F.count("*").alias("n_periods"), F.count("value").alias("n_present"))
    out = out.withColumn("pct_present", F.round(F.col("n_present") * 100.0 / F.col("n_periods"), 1))
    if not_applicable is None:
        out = out.withColumn("not_applicable", F.lit(False))
    else:
        out = out.join(not_applicable.distinct().withColumn("not_applicable", F.lit(True)), [*entity, "variable"], "left").fillna({"not_applicable": False})
    status = F.when(F.col("not_applicable"), "n/a").when(F.col("n_present") == 0, "missing").when(F.col("pct_present") < sparse, "sparse").otherwise("ok")
    return out.withColumn("status", status)


def gap_summary(covered: DataFrame) -> DataFrame:
    """Per variable: how many entities have it, in what state, the fewest first."""
    count = lambda s: F.count_if(F.col("status") == s)
    out = covered.where(~F.col("not_applicable")).groupBy("variable").agg(
        F.count("*").alias("n_entities"), count("ok").alias("n_ok"), count("sparse").alias("n_sparse"), count("missing").alias("n_missing"), F.round(F.avg("pct_present"), 1).alias("mean_pct")
    )
    return out.withColumn("pct_ok", F.round(F.col("n_ok") * 100.0 / F.col("n_entities"), 1)).orderBy("pct_ok", "variable")


def coverage_delta(before: DataFrame, after: DataFrame, entity: list[str]) -> DataFrame:
    """Rows per entity in both builds and the gain; entities of the later build."""
    n = lambda df, name: df.groupBy(*entity).agg(F.count("*").alias(name))
    out = n(after, "n_after").join(n(before, "n_before"), entity, "left").fillna({"n_before": 0})
    return out.withColumn("gained", F.col("n_after") - F.col("n_before"))


def wide_flags(df: DataFrame, key: list[str], checks: dict[str, Column]) -> DataFrame:
    """A boolean per check and how many hold; rows without a flag go; most flags first."""
    out = df.select(*key, *(F.coalesce(c, F.lit(False)).alias(k) for k, c in checks.items()))
    total = sum((F.col(k).cast("int") for k in checks), F.lit(0))
    return out.withColumn("n_flags", total).where("n_flags > 0").orderBy(F.desc("n_flags"), *key)


def long_flags(df: DataFrame, key: list[str], checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per flag with its message, in one scan: each row's checks form an array that is
    filtered and exploded."""
    each = F.array(*(F.struct(F.lit(k).alias("flag"), F.coalesce(c, F.lit(False)).alias("hit"), d.cast("string").alias("detail")) for k, (c, d) in checks.items()))
    return df.select(*key, F.explode(F.filter(each, lambda x: x["hit"])).alias("f")).select(*key, "f.flag", "f.detail")


def bound_checks(specs: dict[str, tuple[str, str]], tolerance: float = 1e-4) -> dict[str, Column]:
    """name -> (part, whole): the part exceeds the whole by more than the tolerance."""
    return {k: F.col(p) > F.col(w) * (1 + tolerance) for k, (p, w) in specs.items()}


def compare(left: DataFrame, right: DataFrame, key: list[str], columns: list[str], within: float = 0.5) -> DataFrame:
    """Per key and variable both values, difference, percent and ratio, and a verdict: agree within
    0.5 %, differ, or one_source_only; where neither side has a value there is no row."""
    a = unpivot(left, key, columns, value="left_value")
    b = unpivot(right, key, columns, value="right_value")
    both = a.join(b, [*key, "variable"]).where("left_value is not null or right_value is not null")
    gap = F.col("right_value") - F.col("left_value")
    pct = gap / F.nullif(F.col("left_value"), F.lit(0.0)) * 100
    one = F.col("left_value").isNull() | F.col("right_value").isNull()
    return both.withColumns({
        "difference": gap,
        "difference_pct": pct,
        "ratio": F.col("right_value") / F.nullif(F.col("left_value"), F.lit(0.0)),
        "verdict": F.when(one, "one_source_only").when(F.abs(pct) <= within, "agree").otherwise("differ"),
    })


def summarise(diff: DataFrame, by: list[str]) -> DataFrame:
    count = lambda v: F.count_if(F.col("verdict") == v)
    return diff.groupBy(*by).agg(
        F.count("*").alias("n"), count("agree").alias("n_agree"), count("differ").alias("n_differ"), count("one_source_only").alias("n_one_source"),
        F.median("ratio").alias("median_ratio"), F.stddev_samp("ratio").alias("std_ratio"),
        (count("agree") * 100.0 / F.nullif(count("agree") + count("differ"), F.lit(0))).alias("pct_agree"),
    )


def unstable(summary: DataFrame, threshold: float = 0.15) -> DataFrame:
    """Pairs whose ratio moves: deviation over 15 % of the median, the most unstable first."""
    share = F.col("std_ratio") / F.nullif(F.abs("median_ratio"), F.lit(0.0))
    return summary.withColumn("instability", share).where(F.col("instability") > threshold).orderBy(F.desc("instability"))


def coverage_gained(frame: DataFrame, known: DataFrame, entity: str, period: str, value: str) -> DataFrame:
    """Per entity: first and last period, count and last value, and whether it was known before."""
    out = frame.groupBy(entity).agg(F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.count("*").alias("n_periods"), F.max_by(value, period).alias("last_value"))
    seen = known.select(entity).distinct().withColumn("in_other", F.lit(True))
    return out.join(seen, entity, "left").fillna({"in_other": False})


def audit_rate(df: DataFrame, entity: list[str], rate: str, numerator: str, denominator: str, factor: float = 10.0, share: float = 0.01) -> DataFrame:
    """A rate over ten times its entity's median is suspect. The denominator answers: where it is
    absent, zero, under 1 % of its own median or smaller than the numerator, the rate is nulled;
    where the recomputed rate (annualised, in percent) differs, it is put right; else it stands.
    Adds <rate>_audited and audit (ok, kept, nulled, corrected)."""
    medians = df.groupBy(*entity).agg(F.median(rate).alias("_med"), F.median(denominator).alias("_den"))
    w = df.join(medians, entity, "left")
    again = ratio(F.col(numerator), F.col(denominator), annualise=True)
    suspect = F.coalesce((F.abs("_med") > 1e-9) & (F.abs(rate) > factor * F.abs("_med")), F.lit(False))
    no_base = F.coalesce(F.col(denominator).isNull() | (F.abs(denominator) <= 0) | (F.abs(denominator) < share * F.abs("_den")) | (F.abs(numerator) > F.abs(denominator)), F.lit(False))
    wrong = F.coalesce(F.abs(F.col(rate) - again) > 1e-6 * F.abs(again) + 1e-9, F.lit(False))
    verdict = F.when(~suspect, "ok").when(no_base, "nulled").when(wrong, "corrected").otherwise("kept")
    out = w.withColumn("audit", verdict)
    value = F.when(F.col("audit") == "nulled", None).when(F.col("audit") == "corrected", again).otherwise(F.col(rate))
    return out.withColumn(f"{rate}_audited", value).drop("_med", "_den")


def nearest_quantile(value: str, q: float) -> Column:
    """The element at round(q (n-1)) of the sorted values, unlike an interpolated percentile."""
    values = F.array_sort(F.collect_list(value))
    return F.get(values, F.bround(q * (F.size(values) - 1)).cast("int"))


def peer_median(df: DataFrame, period: str, value: str) -> DataFrame:
    return df.groupBy(period).agg(F.median(value).alias("peer_median"), F.count(value).alias("n"))


def latest_ranking(df: DataFrame, period: str, value: str) -> DataFrame:
    """The last period's rows with a value, the largest first."""
    last = df.agg(F.max(period).alias(period))
    return df.join(F.broadcast(last), period).where(F.col(value).isNotNull()).orderBy(F.desc(value))


def weighted_mix(df: DataFrame, period: str, parts: list[str], total: str) -> DataFrame:
    """Sums over sums, in percent, of rows that have the total."""
    return df.where(F.col(total).isNotNull()).groupBy(period).agg(*((F.sum(p) / F.nullif(F.sum(total), F.lit(0.0)) * 100).alias(f"{p}_pct") for p in parts))


def build_info(df: DataFrame, columns: list[str], period: str, entity: str) -> DataFrame:
    """One row: rows, entities, the window and cells with a value."""
    cells = sum((F.count(c) for c in columns), F.lit(0))
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(entity).alias("n_entities"), F.min(period).alias("first_period"), F.max(period).alias("last_period"), cells.alias("n_cells"))


def provenance(df: DataFrame) -> DataFrame:
    """Cells by source over all ``<column>__source`` columns."""
    tags = [c for c in df.columns if c.endswith("__source")]
    return df.unpivot([], tags, "column", "source").where("source is not null").groupBy("column", "source").agg(F.count("*").alias("n"))
