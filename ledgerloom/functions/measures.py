"""Null-aware arithmetic: null is "not reported", never zero."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def null_aware_sum(*parts: Column) -> Column:
    """The sum of what is there; null only where every part is null."""
    total = reduce(lambda a, b: a + b, (F.coalesce(p, F.lit(0.0)) for p in parts))
    return F.when(reduce(lambda a, b: a | b, (p.isNotNull() for p in parts)), total)


def ratio(numerator: Column, denominator: Column, percent: bool = True, annualise: bool = False) -> Column:
    """numerator / denominator, null where the denominator is zero or absent."""
    value = F.when(F.abs(denominator) > 0, numerator / F.nullif(denominator, F.lit(0.0)))
    return value * (100.0 if percent else 1.0) * (4.0 if annualise else 1.0)


def with_ratios(df: DataFrame, ratios: dict[str, tuple[str, str, bool]]) -> DataFrame:
    """Each name: (numerator, denominator, annualised). One whose inputs ``df`` lacks is left out."""
    have = set(df.columns)
    made = {k: ratio(F.col(n), F.col(d), annualise=a) for k, (n, d, a) in ratios.items() if {n, d} <= have}
    return df.withColumns(made) if made else df


def with_growth(df: DataFrame, columns: list[str], entity: list[str], period: str = "period", contiguous: bool = False) -> DataFrame:
    """Annualised quarter-on-quarter and year-on-year growth in percent, by position; with
    ``contiguous``, only where the earlier row is one (four) quarters back."""
    w = Window.partitionBy(*entity).orderBy(period)
    out = {}
    for c in columns:
        for name, lag, power in (("qoq", 1, 4), ("yoy", 4, 1)):
            before = F.lag(c, lag).over(w)
            if contiguous:
                months = F.months_between(F.last_day(period), F.last_day(F.lag(period, lag).over(w)))
                before = F.when(months == 3 * lag, before)
            out[f"{c}_{name}"] = F.when(before > 0, (F.pow(F.col(c) / before, F.lit(power)) - 1) * 100)
    return df.withColumns(out)


def npa(nonaccrual: Column, other_owned: Column) -> Column:
    """Nonaccrual plus owned property; unknown where nonaccrual is."""
    return F.when(nonaccrual.isNotNull(), nonaccrual + F.coalesce(other_owned, F.lit(0.0)))


def net_of(gross: Column, recovered: Column, reported: Column | None = None) -> Column:
    """Gross less recoveries, where no net figure is reported."""
    built = gross - recovered
    return built if reported is None else F.coalesce(reported, built)


def rolled_up(total: Column, parts: list[Column], least: int = 2) -> Column:
    """The reported total, else the sum of at least ``least`` reported parts that is not zero."""
    n = reduce(lambda a, b: a + b, (p.isNotNull().cast("int") for p in parts))
    built = null_aware_sum(*parts)
    return F.coalesce(total, F.when((n >= least) & (F.abs(built) > 0), built))


def mix_coverage(leaves: list[Column], total: Column) -> Column:
    return ratio(null_aware_sum(*leaves), total)


def stress_inputs(df: DataFrame) -> DataFrame:
    """Noncurrent loans, earnings before provisions, tangible equity and assets, wholesale funding
    and the Texas ratio, from the columns named below; a missing column counts as all null."""
    c = lambda name: F.col(name) if name in df.columns else F.lit(None).cast("double")
    intangible = F.coalesce(c("intangibles_total"), c("goodwill"))
    tangible = c("equity") - F.coalesce(intangible, F.lit(0.0))
    noncurrent = c("nonaccrual_total") + c("past_due_90")
    capacity = tangible + F.coalesce(c("acl_total"), F.lit(0.0))
    return df.withColumns({
        "noncurrent": noncurrent,
        "ppnr": c("net_interest_income") + c("noninterest_income") - c("noninterest_expense"),
        "tangible_equity": tangible,
        "tangible_common_equity": tangible - F.coalesce(c("preferred_stock"), F.lit(0.0)),
        "tangible_assets": c("assets") - F.coalesce(intangible, F.lit(0.0)),
        "wholesale_funding": null_aware_sum(c("fed_funds_repo_purchased"), c("borrowings_other")),
        "texas_ratio": F.when(capacity > 0, npa(noncurrent, c("oreo")) / capacity * 100),
    })


def capital_ratios(df: DataFrame, regimes: tuple[str, ...] = ("", "_basel1")) -> DataFrame:
    """Per regime cet1, tier1 and total capital over risk-weighted assets, left apart; the leverage
    ratio alone is one series, of the newer regime's tier 1 where it is reported."""
    have = set(df.columns)
    made = {}
    for suffix in regimes:
        for kind in ("cet1", "tier1", "total"):
            if {f"{kind}_capital{suffix}", f"rwa{suffix}"} <= have:
                made[f"{kind}_ratio{suffix}"] = ratio(F.col(f"{kind}_capital{suffix}"), F.col(f"rwa{suffix}"))
    tiers = [F.col(f"tier1_capital{s}") for s in regimes if f"tier1_capital{s}" in have]
    if tiers and "assets_average" in have:
        made["leverage_ratio"] = ratio(F.coalesce(*tiers), F.col("assets_average"))
    return df.withColumns(made) if made else df


def with_groups(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Null-aware sums by name, in the order given: a group may hold an earlier one."""
    for name, parts in groups.items():
        df = df.withColumn(name, null_aware_sum(*(F.col(p) for p in parts if p in df.columns)))
    return df
