"""Catalogue, third part: whole panels from the item and variable catalogues, members, lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import taxonomy
from ..operators import graph, resolve, select
from . import items, panels
from .catalog import DAY, PANEL, SIDES, query, read

# ---- facts to a bank panel ----

_Q_START = "CAST(date_trunc('quarter', period) AS DATE)"
_FACT = "concat('N', nation) AS bank, concat('N', nation) AS ticker, CAST(nation AS STRING) AS cik, period, 'USD' AS unit, concat('a', nation) AS accn"


def _fact(tag: str, value: str, where: str = "true", starts: str = "CAST(NULL AS DATE)", axis: str = "", cls: str = "NULL", grade: str = "NULL", late: str = "NULL", filed: int = 30, source: str = "p") -> str:
    text = lambda x: f"CAST({x} AS STRING)"
    return f"""SELECT {_FACT}, '{tag}' AS tag, {starts} AS period_start, {starts} IS NULL AS instant, CAST(floor({value}) AS DOUBLE) AS value, period + {filed} AS filed, {text('NULL')} AS segment,
        {text(cls)} AS loan_class, {text(grade)} AS credit_quality, {text(late)} AS past_due, {text('NULL')} AS other_dims, '{axis}' AS dim_axes, {int(bool(axis))} AS n_dims FROM {source} WHERE {where} AND {value} IS NOT NULL"""


_BOOK = "NotesReceivableGross"
BANK_FACTS = f"WITH p AS ({PANEL}), y AS (SELECT nation, period, sum(urgent) OVER (PARTITION BY nation, year(period) ORDER BY period) AS ytd, urgent FROM p WHERE urgent IS NOT NULL) " + " UNION ALL ".join([
    _fact(_BOOK, "total", "nation % 2 = 0"),
    *(_fact(_BOOK, v, axis="ClassAxis", cls=f"'{m}'") for v, m in (("urgent", "CommercialAndIndustrialMember"), ("high", "CreditCardReceivablesMember"), ("finished", "ResidentialMortgageMember"))),
    _fact(_BOOK, "urgent * 5", axis="ClassAxis", cls="'LoansHeldForSaleMember'"),
    _fact("Assets", "total * 9"), _fact("Assets", "total * 10", filed=60),
    _fact("AllowanceForLoanAndLeaseLossesWriteOffs", "ytd / 100", starts="make_date(year(period), 1, 1)", source="y"),
    _fact("AllowanceForLoanAndLeaseLossesRecoveriesOfBadDebts", "urgent / 400", starts=_Q_START, source="y"),
    _fact("FinancingReceivableRecordedInvestmentNonaccrualStatus", "total / 50"), _fact("ForeclosedAssets", "total / 80", "nation % 3 = 0"),
    *(_fact(_BOOK, f"total / {n}", "nation % 4 = 0", axis="RatingAxis", grade=f"'{m}'") for n, m in ((2, "PassMember"), (10, "SpecialMentionMember"), (20, "SubstandardMember"), (25, "DoubtfulMember"))),
    _fact("FinancingReceivableRecordedInvestment30To59DaysPastDue", "total / 200"), _fact("FinancingReceivableRecordedInvestment90DaysPastDueAndStillAccruing", "total / 300"),
    _fact(_BOOK, "total / 150", "nation % 5 = 0", axis="LateAxis", late="'A3059dayspastdueMember'"),
])


@query(f"""
    WITH p AS (SELECT *, floor(urgent) AS ci, floor(high) AS card, floor(finished) AS resi FROM ({PANEL}) x),
    y AS (SELECT nation, period, floor(sum(urgent) OVER (PARTITION BY nation, year(period) ORDER BY period) / 100) AS ytd, floor(urgent / 400) AS back FROM p WHERE urgent IS NOT NULL),
    q AS (SELECT *, quarter(period) = 1 AS first, lag(period) OVER w AS before, lag(ytd) OVER w AS was FROM y WINDOW w AS (PARTITION BY nation ORDER BY period)),
    n AS (SELECT nation, period, CASE WHEN first THEN ytd WHEN year(before) = year(period) AND quarter(before) = quarter(period) - 1 THEN ytd - was END - back AS nco FROM q),
    b AS (SELECT p.*, nco, floor(total / 20) + floor(total / 25) AS low, coalesce(ci, 0) + coalesce(card, 0) + coalesce(resi, 0) AS mix, coalesce(ci, card, resi) IS NOT NULL AS known FROM p LEFT JOIN n ON p.nation = n.nation AND p.period = n.period),
    c AS (SELECT *, CASE WHEN nation % 2 = 0 THEN floor(total) WHEN known THEN mix END AS loans_total FROM b)
    SELECT concat('N', nation) AS ticker, period, loans_total, ci AS loans_ci, card AS loans_credit_card, resi AS loans_resi_mortgage, floor(total * 10) AS assets,
        nco AS nco_total, round(nco / nullif(loans_total, 0) * 400, 4) AS nco_rate, floor(total / 50) + CASE WHEN nation % 3 = 0 THEN floor(total / 80) ELSE 0 END AS npa_total,
        CASE WHEN nation % 4 = 0 THEN low END AS cq_classified, CASE WHEN nation % 4 = 0 THEN floor(total / 10) + low END AS cq_criticized,
        floor(total / CASE WHEN nation % 5 = 0 THEN 150 ELSE 200 END) AS pd_dpd_30_59, floor(total / 300) AS pd_dpd_90_plus, round(CASE WHEN known THEN mix / nullif(loans_total, 0) * 100 END, 4) AS mix_coverage_pct,
        round(CASE WHEN lag(loans_total, 4) OVER w > 0 THEN (loans_total / lag(loans_total, 4) OVER w - 1) * 100 END, 4) AS loans_total_yoy, CASE WHEN nation % 2 = 0 AND period >= DATE '1998-01-01' THEN 'CECL' ELSE 'incurred_loss' END AS basis
    FROM c WINDOW w AS (PARTITION BY nation ORDER BY period)""")
def bank_panel_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    adopted = read(spark, sf_dir, "SELECT concat('N', n_nationkey) AS ticker, DATE '1998-01-01' AS adopted FROM {nation} WHERE n_nationkey % 2 = 0")
    out = panels.bank_panel(read(spark, sf_dir, BANK_FACTS), adopted, since="1990-01-01")
    amounts = ["loans_total", "loans_ci", "loans_credit_card", "loans_resi_mortgage", "assets", "nco_total", "npa_total", "cq_classified", "cq_criticized", "pd_dpd_30_59", "pd_dpd_90_plus"]
    return out.select("ticker", "period", "basis", *(F.round(c, 2).alias(c) for c in amounts), *(F.round(c, 4).alias(c) for c in ("nco_rate", "mix_coverage_pct", "loans_total_yoy")))


# ---- charters to a holding panel ----

CHARTER = f"""
    SELECT s, last_day(make_date(year(d), quarter(d) * 3, 1)) AS period, floor(sum(v) / 1000) AS v, floor(sum(CASE WHEN f = 'A' THEN v ELSE 0 END) / 1000) AS a, floor(sum(CASE WHEN t = 'F' THEN v ELSE 0 END) / 1000) AS w
    FROM ({SIDES}) x GROUP BY 1, 2"""
# What the queries read: the same sums in decimals, exact in whatever order; a sum of doubles may fall
# just below the whole thousand that it is.
CHARTERED = f"SELECT s, period, CAST(v AS BIGINT) AS v, CAST(a AS BIGINT) AS a, CAST(w AS BIGINT) AS w FROM ({CHARTER.replace('l_extendedprice AS v', 'CAST(l_extendedprice AS DECIMAL(22, 6)) AS v')}) y"
_LINES = [
    ("RC", "RCON", "2170", "v", "true"), ("RC", "RCFD", "2170", "v + 7", "s % 2 = 0"), ("RC", "RCON", "2200", "w", "true"), ("RC", "RCFN", "2200", "w + 1", "s % 3 = 0"), ("RC", "RCON", "B528", "v + a", "true"),
    ("RCCI", "RCON", "1766", "a", "s % 4 = 0"), ("RCCI", "RCON", "1763", "a + 1", "s % 4 <> 0"), ("RCCI", "RCFD", "1764", "w", "s % 4 = 1"), ("RCCI", "RCON", "1480", "w", "s % 5 <> 0"), ("RCCI", "RCON", "F160", "v", "s % 5 = 0"), ("RCCI", "RCON", "F161", "a", "s % 5 = 0"),
    ("RCCI", "RCON", "2122", "v + 3", "true"), ("RCN", "RCON", "1403", "a", "s % 2 = 1"), ("RCN", "RCON", "1608", "w", "s % 2 = 0"), ("RCN", "RCON", "3495", "a", "s % 2 = 0"), ("RCN", "RCON", "1407", "a", "s % 3 <> 0"),
    ("RC", "RCON", "3210", "v", "true"), ("RCM", "RCON", "2143", "a", "s % 3 = 1"), ("RC", "RCON", "3163", "w", "s % 3 = 2"), ("RC", "RCON", "3123", "w", "true"),
]
CALL_LONG = f"WITH c AS ({CHARTERED}), y AS (SELECT s, period, sum(a) OVER (PARTITION BY s, year(period) ORDER BY period) AS co, sum(w) OVER (PARTITION BY s, year(period) ORDER BY period) AS re FROM c) " + " UNION ALL ".join(
    [f"SELECT CAST(s AS BIGINT) AS rssd, period, '{sch}' AS schedule, '{p}' AS prefix, '{i}' AS item, CAST({v} AS DOUBLE) AS value FROM c WHERE {where}" for sch, p, i, v, where in _LINES]
    + [f"SELECT CAST(s AS BIGINT), period, 'RIBI', 'RIAD', '{i}', CAST({v} AS DOUBLE) FROM y" for i, v in (("4635", "co"), ("4605", "re"))]
)
CHARTERS_OF = "SELECT concat('N', s_nationkey) AS ticker, s_suppkey AS rssd, CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey + 1000 END AS via_rssd, s_suppkey % 8 = 0 AS failed_lineage FROM {supplier}"


@query(f"""
    WITH c AS ({CHARTER}), l AS (SELECT *, quarter(period) = 1 OR coalesce(year(lag(period) OVER w) = year(period) AND quarter(lag(period) OVER w) = quarter(period) - 1, false) AS joined FROM c WINDOW w AS (PARTITION BY s ORDER BY period)),
    x AS (SELECT concat('N', s_nationkey) AS ticker, period, s, CASE WHEN s % 2 = 0 THEN v + 7 ELSE v END AS assets, w + CASE WHEN s % 3 = 0 THEN w + 1 ELSE 0 END AS deposits, v + a AS loans_total,
            CASE WHEN s % 4 = 0 THEN a ELSE a + 1 + CASE WHEN s % 4 = 1 THEN w ELSE 0 END END AS loans_ci, CASE WHEN s % 5 = 0 THEN v + a ELSE w END AS cre, v + 3 AS rcc, CASE WHEN s % 2 = 1 THEN a ELSE w + a END AS na,
            CASE WHEN s % 3 <> 0 THEN a END AS late, v AS equity, w AS acl, CASE s % 3 WHEN 1 THEN a WHEN 2 THEN w END AS intangible, CASE WHEN joined THEN a - w END AS nco, s % 4 = 0 AS via, s % 8 = 0 AS failed
        FROM l JOIN supplier ON s = s_suppkey),
    h AS (SELECT ticker, period, sum(assets) AS assets, sum(deposits) AS deposits, sum(loans_total) AS loans_total, sum(loans_ci) AS loans_ci, sum(cre) AS cre, sum(rcc) AS rcc, sum(na) AS na, sum(late) AS late, sum(equity) AS equity, sum(acl) AS acl,
            sum(intangible) AS intangible, sum(nco) AS nco, count(*) AS n_members, true AS rcn_total_built, bool_or(failed) AS predecessor_failed, count(CASE WHEN via THEN 1 END) AS predecessor_count FROM x GROUP BY 1, 2)
    SELECT ticker, period, assets * 1000.0 AS assets, deposits * 1000.0 AS deposits, loans_total * 1000.0 AS loans_total, loans_ci * 1000.0 AS loans_ci, cre * 1000.0 AS loans_cre_total, na * 1000.0 AS nonaccrual_total, nco * 1000.0 AS nco_total,
        round(nco / nullif(loans_total, 0) * 400, 4) AS nco_rate, round((loans_ci + cre - rcc) * 1000, 2) + 0.0 AS partition_residual, round((loans_ci + cre) / nullif(rcc, 0) * 100, 4) AS mix_coverage_pct, round((na + late) * 1000, 2) AS noncurrent_total,
        round(CASE WHEN equity - coalesce(intangible, 0) + acl > 0 THEN (na + late) / (equity - coalesce(intangible, 0) + acl) * 100 END, 4) AS texas_ratio, n_members, rcn_total_built, predecessor_failed, predecessor_count FROM h""")
def call_panel_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = read(spark, sf_dir, CALL_LONG)
    mapping = long.select("rssd", "period").distinct().join(read(spark, sf_dir, CHARTERS_OF), "rssd")
    out = panels.call_panel(long, mapping)[1]
    plain = ["assets", "deposits", "loans_total", "loans_ci", "loans_cre_total", "nonaccrual_total", "nco_total"]
    return out.select("ticker", "period", *plain, *(F.round(c, 4).alias(c) for c in ("nco_rate", "mix_coverage_pct", "texas_ratio")), (F.round("partition_residual", 2) + 0.0).alias("partition_residual"), F.round("noncurrent_total", 2).alias("noncurrent_total"), "n_members", "rcn_total_built", "predecessor_failed", "predecessor_count")


@query(f"""
    WITH c AS ({CHARTER}), b AS (SELECT concat('N', s_nationkey) AS ticker, period, s, v FROM c JOIN supplier ON s = s_suppkey WHERE s % 4 <> 0 AND period >= DATE '1996-06-30')
    SELECT ticker, period, sum(CASE WHEN s % 2 = 0 THEN v + 7 ELSE v END) * 1000.0 AS assets, count(*) AS n_members FROM b GROUP BY 1, 2""")
def baseline_panel_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = read(spark, sf_dir, CALL_LONG)
    mapping = long.select("rssd", "period").distinct().join(read(spark, sf_dir, CHARTERS_OF), "rssd")
    return panels.baseline_panel(long, mapping, "1996-06-30").select("ticker", "period", "assets", "n_members")


@query(" UNION ALL ".join(f"SELECT '{schedule}' AS schedule, {len(codes)} AS n, '{min(codes)}' AS first, '{max(codes)}' AS last" for schedule, codes in {
    "RC": [p + i for p in ("RCFD", "RCON") for i in "B528 5369 3123 2170 3210 2150 3545 1773 3163 2143 0426 3838 B993 B995 2800 3190".split()] + ["RCON2200", "RCFN2200"],
    "RCN": [p + i for p in ("RCFD", "RCON") for i in "1406 1407 1403 F172 F173 F174 F175 F176 F177 2759 2769 3492 3493 3494 3495 5398 5399 5400 C236 C238 C237 C239 C229 C230 5401 5402 5403 3499 3500 3501 F178 F179 F180 F181 F182 F183 3502 3503 3504 1248 1249 1250 5377 5380 5378 5381 5379 5382 B834 B835 B836 1594 1597 1583 1251 1254 1252 1255 1253 1256 1606 1607 1608 B575 B576 B577 K213 K216 K214 K217 K215 K218 B578 B579 B580 5389 5390 5391 5459 5460 5461 F166 F169 F167 F170 F168 F171 1226 1227 1228 1257 1271 1258 1272 1259 1791".split()] + ["RCFNB572", "RCFNB573", "RCFNB574"],
    "RCRI": [p + i for p in ("RCFA", "RCOA") for i in "P859 8274 3792 A223".split()],
}.items()))
def wanted_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many codes a reader keeps of three schedules, and the first and last of them."""
    codes = resolve.wanted(items.ITEMS)
    return spark.createDataFrame([(s, len(codes[s]), min(codes[s]), max(codes[s])) for s in ("RC", "RCN", "RCRI")], "schedule string, n int, first string, last string")


# ---- members ----

# member, filer, class, scope, credit quality, past-due bucket
_NAMED = [
    ("CommercialRealEstateExcludingResidentialBuilderAndDeveloperAndOtherConstructionMember", "A", "cre_total", None, None, None), ("ConstructionLoansMember", "A", "construction", None, None, None), ("ConsumerExcludingCreditCardLoanPortfolioSegmentMember", "A", "consumer_other", None, None, None),
    ("CommercialLeaseFinancingReceivableMember", "A", "lease", None, None, None), ("CommercialLoanAndLeaseFinancingLoanMember", "A", "commercial_total", None, None, None), ("TotalLoansandLeasesMember", "A", None, None, None, None), ("LoansHeldForSaleMember", "A", None, "held_for_sale", None, None),
    ("StudentLoansGovernmentGuaranteedMember", "WFC", "student", None, None, None), ("CommercialLoanMember", "WFC", "ci", None, None, None), ("CommercialLoanMember", "A", "commercial_total", None, None, None), ("CoveredFinancingReceivableMember", "A", None, "fdic_covered", None, None),
    ("NonAcquiredFinancingReceivableMember", "A", None, "acquired_status", None, None), ("UnallocatedFinancingReceivablesMember", "A", None, "allocation", None, None), ("AccruingLoansMember", "A", None, "accrual_status", None, None), ("UnfundedLendingReserveMember", "A", None, "unfunded_commitment", None, None),
    ("PersonalUnsecuredMember", "A", "consumer_other", None, None, None), ("EstimateOfFairValueFairValueDisclosureMember", "A", None, "fair_value", None, None), ("CriticizedSubstandardMember", "A", None, None, "criticized", None), ("FicoScoreLessThan620Member", "A", None, None, "fico_subprime", None),
    ("InternalNoninvestmentGradeMember", "A", None, None, "non_investment_grade", None), ("InternalRiskRating7Member", "A", None, None, "internal_grade_high", None), ("A3059dayspastdueMember", "A", None, None, None, "dpd_30_59"), ("FinancialAsset30Through59DaysPastDueMember", "A", None, None, None, "dpd_30_59"),
    ("NoncurrentMember", "A", None, None, None, None), ("FinancialAssetNotPastDueMember", "A", None, None, None, "current"), ("LoansInForeclosureMember", "A", None, None, None, "in_foreclosure"),
]
_TEXT = lambda x: "CAST(NULL AS VARCHAR)" if x is None else f"'{x}'"
MEMBERS_SQL = "SELECT p_partkey, CASE p_partkey % " + f"{len(_NAMED)} " + " ".join(f"WHEN {i} THEN '{m[0]}'" for i, m in enumerate(_NAMED)) + " END AS member, CASE p_partkey % " + f"{len(_NAMED)} " + " ".join(f"WHEN {i} THEN '{m[1]}'" for i, m in enumerate(_NAMED)) + " END AS ticker FROM {part}"


@query(f"SELECT p_partkey, m.loan_cat, m.scope, m.cq, m.pd FROM part JOIN (VALUES {', '.join('(' + ', '.join([str(i), *map(_TEXT, m[2:])]) + ')' for i, m in enumerate(_NAMED))}) m(i, loan_cat, scope, cq, pd) ON p_partkey % {len(_NAMED)} = m.i")
def member_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, m = read(spark, sf_dir, MEMBERS_SQL), F.col("member")
    named = df.select("member", "ticker").distinct().withColumns({"loan_cat": taxonomy.loan_category(m, F.col("ticker")), "scope": taxonomy.scope_of(m), "cq": taxonomy.credit_quality(m), "pd": taxonomy.past_due(m)})
    return df.join(named, ["member", "ticker"]).select("p_partkey", "loan_cat", "scope", "cq", "pd")


@query(f"""
    WITH p AS ({PANEL})
    SELECT nation, period, CASE WHEN (nation + quarter(period)) % 2 = 0 THEN 'rollup' END AS scope, CASE WHEN (nation + quarter(period)) % 2 <> 0 THEN 'resi_mortgage' END AS loan_cat FROM p""")
def superseded_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parent counts as a rollup in the quarters that report a part of it, and as a class in others."""
    none = "CAST(NULL AS STRING) AS"
    facts = read(spark, sf_dir, f"""WITH p AS ({PANEL}), f AS (SELECT nation, period, 'ResidentialMortgageMember' AS loan_class FROM p UNION ALL SELECT nation, period, 'FirstMortgageMember' FROM p WHERE (nation + quarter(period)) % 2 = 0)
        SELECT *, concat('T', nation) AS ticker, true AS instant, 'Loans' AS tag, {none} segment, {none} credit_quality, {none} past_due, {none} other_dims FROM f""")
    banks = [r[0] for r in read(spark, sf_dir, "SELECT concat('T', n_nationkey) FROM {nation}").collect()]  # as many as there are banks
    out = taxonomy.attach_categories(facts, {(b, "ResidentialMortgageMember"): ("FirstMortgageMember",) for b in banks})
    return out.where("loan_class = 'ResidentialMortgageMember'").select("nation", "period", "scope", "loan_cat")


# ---- graphs ----


@query("""
    WITH RECURSIVE e AS (SELECT c_custkey // 2 AS parent, c_custkey AS child FROM customer WHERE c_custkey > 3 AND c_custkey % 11 <> 0),
    w AS (SELECT c_custkey AS node, c_custkey AS top FROM customer UNION ALL SELECT node, parent FROM w JOIN e ON top = child)
    SELECT node, top AS holder FROM w WHERE top NOT IN (SELECT child FROM e)""")
def top_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest with several roots: halving chains, cut at every eleventh node."""
    edges = read(spark, sf_dir, "SELECT c_custkey DIV 2 AS parent, c_custkey AS child FROM {customer} WHERE c_custkey > 3 AND c_custkey % 11 <> 0")
    return graph.top_holders(read(spark, sf_dir, "SELECT c_custkey AS node FROM {customer}"), edges)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.first_rows(read(spark, sf_dir, "SELECT o_orderkey, o_totalprice FROM {orders}"), 100, F.desc("o_totalprice"), F.asc("o_orderkey"))
