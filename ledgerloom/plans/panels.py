"""Whole panels: facts to one row per bank and quarter, and charters to holdings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures, members, periods, taxonomy
from ..functions.members import LOAN_TREE
from ..functions.rules import closure
from ..operators import flows, graph, partition, quality, resolve, select
from ..session import cut
from . import items, variables

KEY = ["bank", "ticker", "cik", "period"]
MEMBERS = ["segment", "loan_class", "credit_quality", "past_due", "other_dims"]


@dataclass(frozen=True)
class Variable:
    """A name, its tags in order of preference, whether it flows over a span, and whether it is
    broken down by loan category."""

    name: str
    tags: tuple[str, ...]
    flow: bool = False
    by_loan: bool = False
    unit: str = "USD"


def values(facts: DataFrame, variables: list[Variable]) -> DataFrame:
    """Long (KEY, column, value): the undimensioned total of each variable (named as the variable, with
    _total where it is broken down), else the sum of its partition, and each loan category. All variables and categories run in one pass, with the
    variable in the key; a tag may serve several."""
    spark = facts.sparkSession
    spec = [(v.name, t, i, v.flow, v.by_loan, v.unit) for v in variables for i, t in enumerate(v.tags)]
    table = F.broadcast(spark.createDataFrame(spec, "variable string, tag string, place int, flow boolean, by_loan boolean, unit string"))
    met = facts.join(table, ["tag", "unit"])
    stock = met.where(~F.col("flow") & F.col("instant"))
    span = flows.reported_or_derived(met.where(F.col("flow")), [*KEY[:3], "variable", "tag", "place", "by_loan", "dim_axes", "loan_cat", "scope", "n_dims", *MEMBERS], "period_start", "period", "value", "filed").drop("basis")
    both = stock.unionByName(span, allowMissingColumns=True)
    whole = both.where("n_dims = 0")
    total = select.top_one(whole, [*KEY, "variable"], F.asc("place"), F.desc_nulls_last("filed"), F.desc("value")).select(*KEY, "variable", "value")
    parts = both.where(F.col("by_loan") & F.col("loan_cat").isNotNull() & F.col("scope").isNull())
    named = parts.withColumn("_tag", F.concat(F.lpad(F.col("place").cast("string"), 3, "0"), F.lit(" "), "tag"))
    order = [f"{i:03d} {t}" for i, t in sorted({(p, t) for _, t, p, *_ in spec})]
    cut = select.best_signature(named, [*KEY, "variable", "loan_cat"], "_tag", "dim_axes", "value", order, subslices=members.SUBSLICE_AXES, modern=members.MODERN_LOAN_AXES)
    by_class = select.sum_members(cut, [*KEY, "variable", "loan_cat"], MEMBERS, "value", ["filed"], "value")
    spread = select.best_signature(named, [*KEY, "variable"], "_tag", "dim_axes", "value", order, prefer="coverage", subslices=members.SUBSLICE_AXES, modern=members.MODERN_LOAN_AXES)
    leaves = select.sum_members(spread, [*KEY, "variable", "loan_cat"], MEMBERS, "value", ["filed"], "value")
    built = partition.partition_total(leaves, [*KEY, "variable"], "loan_cat", "value", closure(spark, LOAN_TREE), "value")
    totals = partition.with_fallback(total, built, [*KEY, "variable"], "value").withColumn("loan_cat", F.lit("total"))
    long = by_class.where("loan_cat <> 'total'").unionByName(totals)
    sliced = F.col("variable").isin([v.name for v in variables if v.by_loan])
    return long.select(*KEY, F.when(sliced, F.concat("variable", F.lit("_"), "loan_cat")).otherwise(F.col("variable")).alias("column"), "value")


def buckets(facts: DataFrame, bucket: str, prefix: str, tags: list[str], by_bucket: bool = False) -> DataFrame:
    """Long (KEY, column, value) of balances by ``bucket``, of one (tag, axes) pair per quarter, or
    with ``by_bucket`` one per quarter and bucket, where the tag itself says which bucket it is."""
    kept = facts.where(F.col("instant") & F.col(bucket).isNotNull() & F.col("scope").isNull() & F.col("tag").isin(tags) & (F.col("unit") == "USD"))
    key = [*KEY, bucket]
    chosen = select.best_signature(kept, key if by_bucket else KEY, "tag", "dim_axes", "value", tags)
    if by_bucket:
        sums = select.sum_members(chosen, key, MEMBERS, "value", ["filed"], "value")
    else:
        latest = chosen.groupBy(*KEY, *MEMBERS, *([] if bucket in MEMBERS else [bucket])).agg(F.max_by("value", F.struct("filed", "value")).alias("value"))
        sums = latest.groupBy(*key).agg(F.sum("value").alias("value"))
    return sums.select(*KEY, F.concat(F.lit(prefix), bucket).alias("column"), "value")


def facts_panel(facts: DataFrame, variables: list[Variable], columns: list[str], ratios: dict[str, tuple[str, str, bool]], growth: list[str], since: str = "2013-01-01") -> DataFrame:
    """One row per bank and quarter with a stated column list: deduplicated facts, chosen
    breakdowns, one pivot, then ratios and growth of the pivoted columns."""
    wide = _pivoted(values(_latest(facts), variables), columns, since)
    out = measures.with_growth(measures.with_ratios(wide, ratios), growth, KEY[:3])
    return out.select(*KEY, "quarter", *sorted(set(out.columns) - {*KEY, "quarter"}))


def _latest(facts: DataFrame) -> DataFrame:
    return select.deduplicate(facts, [*KEY, "tag", "period_start", "unit", "dim_axes", *MEMBERS], "value", ["filed", "accn"])


def _pivoted(long: DataFrame, columns: list[str], since: str) -> DataFrame:
    kept = long.where(periods.is_quarter_end(F.col("period")) & (F.col("period") >= F.lit(since).cast("date")))
    wide = kept.groupBy(*KEY).pivot("column", columns).agg(F.first("value"))
    return wide.withColumn("quarter", periods.quarter_label(F.col("period")))


VARIABLES = [
    Variable(name, tuple(t for n, t in variables.pairs(table) if n == name), flow, name in variables.BY_LOAN)
    for table, flow in ((variables.STOCK_TAGS, False), (variables.FLOW_TAGS, True))
    for name in dict(variables.pairs(table))
]
#: Every column that a bank's panel has before measures are derived.
COLUMNS = [f"{v.name}_{c}" for v in VARIABLES if v.by_loan for c in LOAN_TREE] + [v.name for v in VARIABLES if not v.by_loan]
COLUMNS += [f"cq_{b}" for b in members.CREDIT_QUALITY_TREE] + [f"pd_{b}" for b in dict.fromkeys(b for _, b in members.PAST_DUE)]
# Classes that add up to the book, and those that make up commercial real estate.
MIX = "cre_total ci small_business lease municipal fund_finance financial_institutions commercial_other resi_mortgage home_equity credit_card auto student securities_based consumer_other other".split()
CRE = "cre_investor cre_owner_occupied multifamily construction".split()


def bank_panel(facts: DataFrame, adopted: DataFrame | None = None, since: str = "2013-01-01", prune: bool = False) -> DataFrame:
    """The panel of all variables from long facts: one row per bank and quarter end.

    facts: KEY, tag, period_start, instant, value, unit, accn, filed, the member columns, dim_axes,
    n_dims. adopted: ticker, adopted (the day of the change of accounting basis; others count as not
    adopted). Columns are the same whatever the facts hold; ``prune`` drops those without a value."""
    # several breakdowns read these, so they are made once
    named = cut(taxonomy.attach_categories(_latest(facts), by_tag=variables.PAST_DUE_BY_TAG))
    loan_tags = [t for n, t in variables.pairs(variables.STOCK_TAGS) if n == "loans"]
    ranked = [
        values(named, VARIABLES),
        buckets(named, "cq_cat", "cq_", loan_tags),
        buckets(named, "pd_cat", "pd_", loan_tags),
        buckets(named, "pd_cat", "pd_", list(variables.PAST_DUE_BY_TAG), by_bucket=True),
    ]
    long = None
    for place, part in enumerate(ranked):
        part = part.withColumn("_place", F.lit(place))
        long = part if long is None else long.unionByName(part)
    # a bucket by axis goes before the same bucket by tag
    long = long.groupBy(*KEY, "column").agg(F.min_by("value", "_place").alias("value"))
    wide = _pivoted(long, COLUMNS, since)
    ladder = {"classified": ("substandard", "doubtful", "loss"), "criticized": ("special_mention", "classified")}
    for name, parts in ladder.items():
        wide = wide.withColumn(f"cq_{name}", F.coalesce(f"cq_{name}", measures.null_aware_sum(*(F.col(f"cq_{p}") for p in parts))))
    wide = wide.withColumn("cq_rated_total", measures.null_aware_sum(*(F.col(f"cq_{b}") for b in members.CREDIT_QUALITY_FAMILIES["internal_ig"])))
    net = {f"nco_{c}": measures.net_of(F.col(f"charge_offs_{c}"), F.col(f"recoveries_{c}"), F.col(f"nco_{c}")) for c in LOAN_TREE}
    wide = wide.withColumns({**net, "npa_total": measures.npa(F.col("nonaccrual_total"), F.col("oreo")), "loans_cre_total": measures.rolled_up(F.col("loans_cre_total"), [F.col(f"loans_{c}") for c in CRE])})
    wide = wide.withColumn("mix_coverage_pct", measures.mix_coverage([F.col(f"loans_{c}") for c in MIX], F.col("loans_total")))
    out = measures.with_growth(measures.with_ratios(wide, variables.ratios(variables.SHARED_RATIOS)), [c for c in variables.GROWTH if c in wide.columns], KEY[:3])
    if adopted is None:
        out = out.withColumn("basis", periods.basis_label(F.col("period"), F.lit(None).cast("date")))
    else:
        out = out.join(adopted.select("ticker", "adopted"), "ticker", "left").withColumn("basis", periods.basis_label(F.col("period"), F.col("adopted"))).drop("adopted")
    if prune:
        some = out.agg(*(F.count(F.col(c)).alias(c) for c in out.columns)).first().asDict()
        out = out.select([c for c in out.columns if some[c] or c in KEY])
    return out.select(*KEY, "quarter", "basis", *sorted(set(out.columns) - {*KEY, "quarter", "basis"}))


def holdings_panel(long: DataFrame, items: list[resolve.Item], flow_columns: list[str], mapping: DataFrame, pooled: DataFrame | None = None, backfill: DataFrame | None = None, ratios: dict[str, tuple[str, str, bool]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(charters, holdings): items resolved per charter and quarter, thrift rows merged in before
    flows are differenced, flows differenced before charters are summed, ratios last.

    long: rssd, period, schedule, prefix, item, value; mapping: ticker, rssd, period."""
    charters = resolve.resolve_items(long, items, ["rssd", "period"])
    if backfill is not None:
        charters = graph.merge_backfill(charters, backfill, mapping, ["rssd", "period"], ("call", "tfr"))
    charters = flows.quarterise(charters, "rssd", "period", flow_columns, pooled=pooled)
    sums = [i.column for i in items]
    rolled = graph.roll_up(charters, mapping, ["rssd", "period"], ["ticker", "period"], sums, "rssd")
    return charters, measures.with_ratios(rolled, ratios or {})


def with_measures(holdings: DataFrame, cecl: str = "2020-01-01") -> DataFrame:
    """The measures of a panel of holdings (or of charters): groups, net charge-offs, nonperforming
    assets, stress inputs, the partition check, ratios of both catalogues, capital and growth."""
    have = set(holdings.columns)
    out = measures.with_groups(holdings, {k: list(v) for k, v in items.GROUPS.items()})
    net = {c.replace("charge_offs_", "nco_"): F.col(c) - F.col(c.replace("charge_offs_", "recoveries_")) for c in have if c.startswith("charge_offs_")}
    out = out.withColumns(net)
    out = out.withColumn("nco_cre_total", measures.null_aware_sum(*(F.col(f"nco_{c}") for c in ("cre_nonfarm_nonres", "construction", "multifamily"))))
    out = measures.stress_inputs(out.withColumns({"npa_total": measures.npa(F.col("nonaccrual_total"), F.col("oreo")), "past_due_90": F.col("pd_dpd_90_plus"), "rwa": F.col("risk_weighted_assets"), "rwa_basel1": F.col("risk_weighted_assets_basel1")}))
    out = out.withColumns({
        "noncurrent_total": F.col("noncurrent"),
        "intangibles_other": F.col("intangibles_total") - F.col("goodwill"),
        "securities_afs_unrealized": F.col("securities_afs") - F.col("securities_afs_amortized_cost"),
        "securities_htm_unrealized": F.col("securities_htm_fair_value") - F.col("securities_htm"),
    }).drop("noncurrent")
    leaves = [i.column for i in items.LEAF_ITEMS]
    out = partition.partition_check(out, leaves, "loans_rcc_total", "loans_unearned_income", "n_backfilled" if "n_backfilled" in have else None)
    described = measures.null_aware_sum(*map(F.col, leaves)) - F.coalesce("loans_unearned_income", F.lit(0.0))
    out = out.withColumns({"mix_coverage_pct": measures.ratio(described, F.col("loans_rcc_total")), "basis": periods.basis_label(F.col("period"), F.lit(cecl).cast("date"))})
    out = measures.with_ratios(out, variables.ratios(variables.SHARED_RATIOS, variables.CALL_RATIOS))
    out = measures.capital_ratios(out).drop("past_due_90", "rwa", "rwa_basel1")
    return measures.with_growth(out, [c for c in variables.GROWTH if c in out.columns], ["ticker"])


def call_panel(long: DataFrame, mapping: DataFrame, pooled: DataFrame | None = None, backfill: DataFrame | None = None, gaps: DataFrame | None = None, derived: bool = True) -> tuple[DataFrame, DataFrame]:
    """(charters, holdings) of the whole item catalogue.

    long: rssd, period, schedule, prefix, item, value (thousands); mapping: ticker, rssd, period and,
    where a charter came through a predecessor, via_rssd and failed_lineage; pooled: rssd,
    predecessor, period; backfill: rssd, period and amounts in dollars; gaps: ticker, period,
    n_insured_not_filing, insured_not_filing. Flows are differenced per charter, totals built and the
    partition checked there; then charters are summed, and measures made of the sums."""
    charters = resolve.resolve_items(long, items.ITEMS, ["rssd", "period"])
    if backfill is not None:
        charters = graph.merge_backfill(charters, backfill, mapping, ["rssd", "period"], ("call", "tfr"))
    charters = flows.quarterise(charters, "rssd", "period", [i.column for i in items.FLOW_ITEMS], list(items.MONOTONE), pooled)
    charters = partition.built_totals(charters, items.BUILT_TOTALS, "rcn_total_built")
    via = "via_rssd" in mapping.columns
    sums = [i.column for i in items.ITEMS]
    joined = charters.join(mapping, ["rssd", "period"])
    rolled = graph.roll_up(charters, mapping, ["rssd", "period"], ["ticker", "period"], sums, "rssd", {"predecessor_failed": "failed_lineage"} if via else None, ("deposits_uninsured_coverage_pct", "deposits_uninsured", "deposits"))
    extra = joined.groupBy("ticker", "period").agg(
        F.max("rcn_total_built").alias("rcn_total_built"),
        F.count_if("flow_reset").alias("n_flow_resets"),
        *([F.count_if(F.col("source") == "tfr").alias("n_backfilled")] if backfill is not None else []),
        *([F.count_distinct("via_rssd").alias("predecessor_count"), F.count("via_rssd").alias("n_predecessor_charters"), graph.ordered_list("via_rssd").alias("predecessors")] if via else []),
    )
    holdings = rolled.join(extra, ["ticker", "period"])
    if gaps is not None:
        holdings = holdings.join(gaps, ["ticker", "period"], "left").withColumn("n_insured_not_filing", F.coalesce("n_insured_not_filing", F.lit(0)))
    if derived:
        charters = partition.partition_check(charters, [i.column for i in items.LEAF_ITEMS], "loans_rcc_total", "loans_unearned_income")
        holdings = with_measures(holdings)
    return charters, holdings.withColumn("quarter", periods.quarter_label(F.col("period")))


def baseline_panel(long: DataFrame, mapping: DataFrame, since: str = "2013-01-01") -> DataFrame:
    """The holdings panel of each holding's own charters alone: no predecessors, no backfill."""
    own = mapping.where(F.col("via_rssd").isNull()) if "via_rssd" in mapping.columns else mapping
    keep = F.col("period") >= F.lit(since).cast("date")
    return call_panel(long.where(keep), own.where(keep).select("ticker", "rssd", "period"))[1]


def cross_check(left: DataFrame, right: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Differences, their summary by bank and variable, and the unstable ones."""
    diff = quality.compare(left, right, ["ticker", "period"], columns)
    summary = quality.summarise(diff, ["ticker", "variable"])
    return diff, summary, quality.unstable(summary)
