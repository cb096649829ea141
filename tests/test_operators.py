"""The defining cases of each operator, on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import measures, members, periods, rules, taxonomy, text
from ledgerloom.operators import fill, flows, graph, lineage, partition, quality, resolve, select
from ledgerloom.plans import panels

D = dt.date


def one(df, column="v"):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][column]


def by(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


@pytest.mark.parametrize(("later", "restated"), [(110.0, True), (100.2, False)])
def test_restatement(spark, later, restated):
    rows = [("TB", None, 100.0, D(2024, 4, 30), "a"), ("TB", None, later, D(2024, 7, 31), "b")]
    out = select.deduplicate(spark.createDataFrame(rows, "t string, s date, v double, filed date, accn string"), ["t", "s"], "v", ["filed", "accn"]).collect()
    assert [(r["v"], r["n_versions"], r["restated"]) for r in out] == [(later, 2, restated)]


CUTS = "t string, tag string, axes string, m string, v double"


def test_signatures_are_never_mixed(spark):
    df = spark.createDataFrame([("TB", "x", "seg", "a", 600.0), ("TB", "x", "cls|seg", "a", 400.0), ("TB", "x", "cls|seg", "b", 200.0)], CUTS)
    assert one(select.best_signature(df, ["t"], "tag", "axes", "v", ["x"]).agg(F.sum("v").alias("v"))) == 600
    more = df.union(spark.createDataFrame([("TB", "x", "cls|seg", "c", 534.0)], CUTS))
    assert one(select.best_signature(more, ["t"], "tag", "axes", "v", ["x"], prefer="coverage").agg(F.sum("v").alias("v"))) == 1134


def test_signature_ranks(spark):
    df = spark.createDataFrame([("TB", "old", "", "a", 900.0), ("TB", "new", "legacy", "a", 502.0), ("TB", "new", "modern", "a", 260.0), (None, "new", "q", "a", 1.0)], CUTS)
    out = by(select.best_signature(df, ["t"], "tag", "axes", "v", ["new", "old"], prefer="coverage", modern=("modern",)), "t", "v")
    assert out == {"TB": 260.0, None: 1.0}
    sliced = select.best_signature(df.where("t is not null"), ["t"], "tag", "axes", "v", ["new", "old"], subslices=("modern",))
    assert one(sliced) == 502.0


def test_aliases_count_once(spark):
    df = spark.createDataFrame([("TB", "a", 100.0, 1), ("TB", "b", 100.0, 1), ("TB", "c", 5.0, 1), ("TB", "c", 7.0, 2)], "t string, m string, v double, filed int")
    assert one(select.sum_members(df, ["t"], ["m"], "v", ["filed"], "v")) == 107


def test_fragments(spark):
    df = spark.createDataFrame([("a", 100.0), ("a", 10.0), ("a", 9.9), ("b", 0.0)], "k string, v double")
    assert sorted(r["v"] for r in select.drop_fragments(df, ["k"], "v").collect()) == [0.0, 10.0, 100.0]


Q = [D(2024, 3, 31), D(2024, 6, 30), D(2024, 9, 30), D(2024, 12, 31), D(2025, 3, 31)]


@pytest.mark.parametrize(("rows", "want", "reset"), [
    ([730.0, 3346.0, 5022.0, 6810.0, 1902.0], [730, 2616, 1676, 1788, 1902], [False] * 5),
    ([730.0, None, None, 6810.0], [730, None], [False] * 2),
    ([155.0, 40.0, 95.0], [155, 40, 55], [False, True, False]),
])
def test_year_to_date(spark, rows, want, reset):
    df = spark.createDataFrame([(1, q, v) for q, v in zip(Q, rows, strict=False) if v is not None], "rssd int, period date, v double")
    out = flows.quarterise(df, "rssd", "period", ["v"]).orderBy("period").collect()
    assert [r["v"] for r in out] == want and [r["flow_reset"] for r in out] == reset


def test_pooled_merger(spark):
    rows = [(10, Q[0], 10.0), (10, Q[1], 20.0), (10, Q[2], 40.0), (30, Q[0], 5.0), (30, Q[1], 10.0)]
    pooled = spark.createDataFrame([(10, 30, Q[2])], "rssd int, predecessor int, period date")
    out = flows.quarterise(spark.createDataFrame(rows, "rssd int, period date, v double"), "rssd", "period", ["v"], pooled=pooled)
    assert [r["v"] for r in out.orderBy("rssd", "period").collect()] == [10, 10, 10, 5, 5]


def test_reported_beats_derived(spark):
    rows = [(D(2024, 1, 1), Q[0], 100.0), (D(2024, 1, 1), Q[1], 250.0), (D(2024, 1, 1), Q[2], 420.0), (D(2024, 4, 1), Q[1], 149.0)]
    df = spark.createDataFrame([("TB", s, e, v, 1) for s, e, v in rows], "t string, s date, e date, v double, filed int")
    out = flows.reported_or_derived(df, ["t"], "s", "e", "v", "filed")
    assert [(r["e"], r["v"], r["basis"]) for r in out.orderBy("e").collect()] == [(Q[0], 100, "reported"), (Q[1], 149, "reported"), (Q[2], 170, "derived")]



def test_partition_counts_no_rollup_beside_its_parts(spark):
    rows = [("a", "commercial_total", 60.0), ("a", "ci", 40.0), ("a", "lease", 20.0), ("b", "commercial_total", 60.0), ("b", "ci", 40.0)]
    out = partition.partition_total(spark.createDataFrame(rows, "k string, c string, v double"), ["k"], "c", "v", rules.closure(spark, members.LOAN_TREE), "total")
    assert by(out, "k", "total") == {"a": 60.0, "b": 100.0}


def test_ladder(spark):
    df = spark.createDataFrame([(1, "special_mention", 30.0), (1, "substandard", 15.0), (1, "doubtful", 5.0)], "k int, b string, v double")
    out = partition.ladder(df, ["k"], "b", "v", ["special_mention", "substandard", "doubtful", "loss"], "cq_", {"classified": ["substandard", "doubtful", "loss"], "criticized": ["special_mention", "classified"]}).first()
    assert (out["cq_classified"], out["cq_criticized"]) == (20, 50)


def test_measures(spark):
    df = spark.createDataFrame([(1000.0, 10.0, None), (0.0, 1.0, 2.0)], "loans double, nco double, x double")
    out = measures.with_ratios(df, {"rate": ("nco", "loans", True)}).select("rate", measures.null_aware_sum(F.col("x"), F.lit(None).cast("double")).alias("s"), measures.npa(F.col("x"), F.col("nco")).alias("npa"))
    assert [tuple(r) for r in out.collect()] == [(4.0, None, None), (None, 2.0, 3.0)]


def test_item_resolution(spark):
    items = [
        resolve.Item("x", (("T",), ("A", "B")), ("RCFD", "RCON")),
        resolve.Item("first", (("HK25",), ("K158", "K165")), ("RCON",), prefer="first"),
        resolve.Item("deposits", (("2200",),), ("RCON",), plus="RCFN"),
        resolve.Item("goodwill", (("3163",),), ("RCFD",), ("RC", "RCM")),
    ]
    rows = [(1, "", "RCFD", "A", 10.0), (1, "", "RCON", "A", 9.0), (1, "", "RCON", "B", 5.0), (1, "", "RCFD", "T", 99.0), (1, "", "RCON", "HK25", 100.0), (1, "", "RCON", "K158", 10.0),
            (1, "", "RCON", "K165", 20.0), (1, "", "RCON", "2200", 7.0), (1, "", "RCFN", "2200", 2.0), (1, "RC", "RCFD", "3163", 5.0), (1, "RCM", "RCFD", "3163", 6.0), (2, "", "RCON", "T", 3.0), (2, "", "RCON", "A", None)]
    df = spark.createDataFrame(rows, "rssd int, schedule string, prefix string, item string, value double")
    out = {r["rssd"]: r for r in resolve.resolve_items(df, items, ["rssd"]).collect()}
    assert [out[1][i.column] for i in items] == [15000, 100000, 9000, 5000]
    assert [out[2][i.column] for i in items] == [3000, None, None, None]
    assert resolve.wanted(items)["RC"] == ["RCFD3163"]


EDGES = [(100, 10, "1990-01-01", None), (300, 30, "1990-01-01", "2004-07-01"), (100, 30, "2004-07-01", "2006-01-01"), (400, 40, "1990-01-01", "2025-05-18"), (100, 40, "2025-05-18", None), (500, 50, "1990-01-01", None), (100, 500, "2008-07-01", None), (100, 600, "2010-01-01", None)]
EVENTS = [(300, 100, "2004-07-01", "1", False), (30, 10, "2006-01-01", "1", True), (20, 10, "2008-09-26", "50", False), (400, 100, "2025-05-18", "1", False)]


@pytest.fixture(scope="module")
def owned(spark):
    day = lambda s: D.fromisoformat(s) if s else None
    edges = spark.createDataFrame([(p, c, day(a), day(b)) for p, c, a, b in EDGES], "parent bigint, child bigint, start date, end date")
    events = spark.createDataFrame([(p, s, day(d), c, x) for p, s, d, c, x in EVENTS], "predecessor bigint, successor bigint, date date, code string, pooled boolean")
    ends = [D(y, m, d) for y in range(2003, 2026) for m, d in ((3, 31), (6, 30), (9, 30), (12, 31))]
    quarters = spark.createDataFrame([(q,) for q in ends], "period date")
    entities = spark.createDataFrame([(r, r in (10, 20, 30, 40, 50), False, None) for r in (10, 20, 30, 40, 50, 100, 300, 400, 500, 600)], "rssd bigint, depository boolean, failed boolean, opened date")
    holdings = spark.createDataFrame([(100, 100, 0, None), (400, 400, 1, D(2025, 5, 18))], "holding bigint, rssd bigint, ord int, until date")
    return edges, events, quarters, entities, holdings


def test_closures_end_in_cycles(spark):
    edges = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 3, 1), (2, 1, 9)], "g int, parent int, child int")
    roots = spark.createDataFrame([(1, 1), (2, 1)], "g int, root int")
    assert {tuple(r) for r in graph.closure(roots, edges, ["g"]).collect()} == {(1, 1, 1, 0), (1, 1, 2, 1), (1, 1, 3, 2), (2, 1, 1, 0), (2, 1, 9, 1)}


def test_top_holders_however_far_up(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 20)] + [(30, 31), (31, 30)], "parent int, child int")
    nodes = spark.createDataFrame([(1,), (13,), (14,), (20,), (31,)], "node int")
    assert {tuple(r) for r in graph.top_holders(nodes, edges).collect()} == {(1, 1), (13, 1), (14, 1), (20, 1)}


def test_lineage_and_claims(spark, owned):
    edges, events, quarters, entities, holdings = owned
    found = lineage.resolve(holdings, quarters, edges, events, entities, "2001-01-01")
    kinds = {(r["holding"], r["predecessor"]): r["succession_type"] for r in found.collect()}
    assert kinds == {(100, 300): "merger", (100, 30): "reorg", (100, 20): "fdic_assisted", (100, 400): "merger", (100, 500): "merger"}
    days = spark.createDataFrame([(D(2004, 6, 30),), (D(2024, 12, 31),), (D(2025, 6, 30),)], "period date")
    dated = graph.edges_at(edges, days)
    roots = days.crossJoin(holdings.select(F.col("rssd").alias("root")).union(found.select("predecessor")).distinct())
    closed = graph.closure(roots, dated, ["period"])
    roster = days.crossJoin(spark.createDataFrame([(10,), (30,), (40,), (50,)], "rssd bigint"))
    claims = {(r["period"], r["rssd"]): (r["holding"], r["via"]) for r in lineage.claimed(holdings, found, quarters, closed, roster).collect()}
    assert claims[D(2004, 6, 30), 30] == (100, 300) and claims[D(2004, 6, 30), 10] == (100, None)
    assert claims[D(2024, 12, 31), 40] == (400, None) and claims[D(2025, 6, 30), 40] == (100, None)
    assert claims[D(2004, 6, 30), 50] == (100, 500) and claims[D(2024, 12, 31), 50] == (100, None)


def test_rollup_keeps_null(spark):
    members = spark.createDataFrame([(9, 100.0, None), (10, 50.0, None), (20, 1.0, 3.0)], "rssd int, loans double, x double")
    mapping = spark.createDataFrame([(9, "A", False), (10, "A", True), (20, "B", False)], "rssd int, t string, failed boolean")
    out = {r["t"]: r for r in graph.roll_up(members, mapping, ["rssd"], ["t"], ["loans", "x"], "rssd", {"any": "failed"}, ("cov", "x", "loans")).collect()}
    assert (out["A"]["loans"], out["A"]["x"], out["A"]["members"], out["A"]["any"], out["A"]["cov"]) == (150.0, None, "9;10", True, 0.0)
    assert out["B"]["cov"] == 100.0


def test_entities_by_ein_then_name(spark):
    targets = spark.createDataFrame([("A", "000000001", "ZIONS"), ("B", None, "KEY"), ("C", None, "NOBODY")], "target string, ein string, name string")
    entities = spark.createDataFrame([(1, "000000001", "OTHER", False, False), (2, None, "ZIONS", True, True), (3, None, "KEY BANK", True, True), (4, None, "KEYSTONE", True, True), (5, None, "KEY", False, True)], "rssd bigint, ein string, name string, active boolean, is_holding boolean")
    out = lineage.matched_entities(targets, entities, spark.createDataFrame([(5,)], "rssd bigint"))
    assert by(out, "target", "rssd") == {"A": 1, "B": 5}


def test_gap_fill_never_overwrites(spark):
    panel = fill.tag_sources(spark.createDataFrame([("RF", 1e11, None)], "t string, loans_total double, loans_cre_total double"), ["loans_total", "loans_cre_total"], "xbrl")
    wide = spark.createDataFrame([("RF", 9.7e10, 2e10, 8.58e8)], "t string, loans_total double, loans_cre_total double, loans_office double")
    out = fill.fill_gaps(panel, wide, ["t"], "ir", allow_new=True).first()
    assert (out["loans_total"], out["loans_total__source"], out["loans_cre_total"], out["loans_cre_total__source"], out["loans_office"], out["loans_office__source"]) == (1e11, "xbrl", 2e10, "ir", 8.58e8, "ir")
    assert "loans_office" not in fill.fill_gaps(panel, wide, ["t"], "ir").columns


def test_audit(spark):
    rows = [("a", 1.0, 1.0, 400.0)] * 9 + [("a", 40.0, 1.0, 10.0), ("a", 40.0, 1.0, 2.0), ("a", 50.0, 1.0, 400.0), ("a", None, None, None)]
    out = quality.audit_rate(spark.createDataFrame(rows, "t string, r double, n double, d double"), ["t"], "r", "n", "d")
    assert sorted((r["audit"], r["r_audited"]) for r in out.where("audit <> 'ok'").collect()) == [("corrected", 1.0), ("kept", 40.0), ("nulled", None)]


def test_nearest_quantile(spark):
    assert one(spark.range(1, 11).agg(quality.nearest_quantile("id", 0.9).alias("v"))) == 9


def test_text_functions(spark):
    cells = ["(1,234.5)", "$ 12", "—", "-", "nan", "12%", "", None, "1,000)", " 7 "]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    assert [r[0] for r in df.select(text.financial_number(F.col("c"))).collect()] == [-1234.5, 12, None, None, None, None, None, None, -1000, 7]
    titles = {"2Q26EarningsSupplement.pdf": (2026, 2), "The+Supplement_3Q2025_x": (2025, 3), "hban20260630_8kex992.htm": (2026, 2), "Second Quarter results, 2024": (2024, 2), "nothing": (None, None), "2023 Q4 deck": (2023, 4), "x20260731": (None, None)}
    at = text.document_quarter(F.col("c"))
    assert {r[0]: (r[1], r[2]) for r in spark.createDataFrame([(t,) for t in titles], "c string").select("c", at["y"], at["q"]).collect()} == titles
    label, value = text.label_and_value(F.col("c"))
    lines = spark.createDataFrame([("Total loans (1) $ 96,723",), ("Share 12%",), ("47",)], "c string")
    assert [tuple(r) for r in lines.select(label, value).collect()] == [("Total loans", 96723.0), (None, None), (None, None)]
    names = spark.createDataFrame([("Zions Bancorporation, National Association",), ("First & Co.",)], "c string").select(text.company_name(F.col("c")))
    assert [r[0] for r in names.collect()] == ["ZIONS BANCORPORATION", "FIRST"]
    assert one(spark.range(1).select(text.declared_scale(F.lit("Loans (in millions)")).alias("v"))) == 1e6


# member, filer, class, scope
MEMBERS = [
    ("ConsumerExcludingCreditCardLoanPortfolioSegmentMember", None, "consumer_other", None), ("CreditCardReceivablesMember", None, "credit_card", None), ("CommercialRealEstateMember", None, "cre_total", None),
    ("CommercialRealEstateConstructionMember", None, "construction", None), ("ConstructionLoansMember", None, "construction", None), ("HomeEquityLoanMember", None, "home_equity", None), ("ResidentialMortgageMember", None, "resi_mortgage", None),
    ("CommercialAndIndustrialMember", None, "ci", None), ("CommercialPortfolioSegmentMember", None, "commercial_total", None), ("CapitalCallFinancingMember", None, "fund_finance", None),
    ("CommercialRealEstateExcludingResidentialBuilderAndDeveloperAndOtherConstructionMember", None, "cre_total", None), ("OtherCommercialConstructionMember", None, "construction", None), ("CardmemberLoansMember", None, "credit_card", None),
    ("MunicipalLoansMember", None, "municipal", None), ("FinanceLeasesFinancingReceivableMember", None, "lease", None), ("FinanceLeaseFinancingReceivableMember", None, "lease", None), ("LeaseFinancingsMember", None, "lease", None),
    ("CommercialLeaseFinancingReceivableMember", None, "lease", None), ("FinanceLeasesPortfolioSegmentMember", None, "lease", None), ("DirectFinancingLeaseMember", None, "lease", None),
    ("AllowanceForLoanAndLeaseLossesMember", None, None, None), ("InvestmentVehiclesAndLeveragedLeaseTrustsMember", None, None, None), ("LeaseAgreementsMember", None, None, None),
    ("CommercialLoanAndLeaseFinancingLoanMember", None, "commercial_total", None), ("CommercialLoansAndLeasesMember", None, "commercial_total", None), ("OtherConsumerLoansAndLeasesMember", None, "consumer_other", None),
    ("TotalLoansandLeasesMember", None, None, None), ("NonaccrualPortfolioLoansAndLeasesMember", None, None, None), ("LoansHeldForSaleMember", None, None, "held_for_sale"), ("Unknown", None, None, None), ("CommercialMortgageMember", None, "cre_investor", None),
    ("PurchasedCreditImpairedMember", None, None, "purchased_credit_impaired"), ("PurchaseCreditImpairedLoansMember", None, None, "purchased_credit_impaired"), ("FinancingReceivableAcquiredWithDeterioratedCreditQualityMember", None, None, "purchased_credit_impaired"),
    ("CoveredFinancingReceivableMember", None, None, "fdic_covered"), ("FdicSupportedLoansMember", None, None, "fdic_covered"), ("CollectivelyEvaluatedForImpairmentMember", None, None, "impairment_method"),
    ("IndividuallyEvaluatedForImpairmentMember", None, None, "impairment_method"), ("AcquiredFinancingReceivableMember", None, None, "acquired_status"), ("NonAcquiredFinancingReceivableMember", None, None, "acquired_status"),
    ("UnallocatedFinancingReceivablesMember", None, None, "allocation"), ("ImpairedFinancingReceivableWithRelatedAllowanceRecordedMember", None, None, "impaired"), ("NonperformingAssetsMember", None, None, "accrual_status"),
    ("CreOtherExcludingCoveredMember", "TFC", "cre_total", None), ("CreResidentialAdcExcludingCoveredMember", "TFC", "construction", None), ("ResidentialRealEstateExcludingPurchasedCreditImpairedMember", "JPM", "resi_mortgage", None),
    ("StudentLoansGovernmentGuaranteedMember", "WFC", "student", None), ("TotalCommercialMember", "RF", "commercial_total", None), ("TotalConsumerMember", "RF", "consumer_total", None),
    ("TotalCommercialInvestorRealEstateConstructionMember", "RF", "construction", None), ("LoansExcludingCertainLoansAcquiredInTransferWithEvidenceOfCreditDeteriorationMember", "WFC", None, None),
    ("EstimateOfFairValueFairValueDisclosureMember", None, None, "fair_value"), ("AccruingLoansMember", None, None, "accrual_status"), ("PersonalUnsecuredMember", None, "consumer_other", None),
    ("CommercialLoanMember", "WFC", "ci", None), ("CommercialLoanMember", "KEY", "commercial_total", None), ("OtherLoansMember", "COF", "commercial_other", None), ("OtherLoansMember", None, "other", None),
]
# member, bucket, family
GRADES = [
    ("SpecialMentionMember", "special_mention", "regulatory"), ("SubstandardMember", "substandard", "regulatory"), ("CriticizedMember", "criticized", "regulatory"), ("CriticizedSubstandardMember", "criticized", "regulatory"),
    ("InternalNoninvestmentGradeMember", "non_investment_grade", "internal_ig"), ("InternalInvestmentGradeMember", "investment_grade", "internal_ig"), ("FICOScoreGreaterThan740Member", "fico_prime", "fico"),
    ("RefreshedFicoScoresLessThan660Member", "fico_subprime", "fico"), ("FicoScoreLessThan620Member", "fico_subprime", "fico"), ("PrimeMember", "fico_prime", "fico"), ("SubprimeMember", "fico_subprime", "fico"),
    ("FICOScore660andAboveMember", "fico_prime", "fico"), ("FourToFiveInternalGradeMember", "internal_grade_mid", "internal_ladder"), ("PassMember", "pass", "regulatory"), ("PassDueMember", None, None), ("None", None, None),
]
BUCKETS = {
    "FinancingReceivables30To59DaysPastDueMember": "dpd_30_59", "A3059dayspastdueMember": "dpd_30_59", "FinancialAsset30Through59DaysPastDueMember": "dpd_30_59", "FinancialAssetNotPastDueMember": "current", "CurrentMember": "current",
    "NoncurrentMember": None, "Nonperforming": "nonperforming", "FinancialAssetEqualToOrGreaterThan90DaysPastDueMember": "dpd_90_plus", "FinancialAssetPastDueMember": "past_due_total", "LoansInForeclosureMember": "in_foreclosure", "X30to89Member": "dpd_30_89",
}


def test_taxonomy(spark):
    df = spark.createDataFrame([m[:2] for m in MEMBERS], "m string, t string")
    got = df.select("m", "t", taxonomy.loan_category(F.col("m"), F.col("t")), taxonomy.scope_of(F.col("m"))).collect()
    assert [tuple(r) for r in got] == MEMBERS
    df = spark.createDataFrame([(m,) for m, *_ in GRADES], "m string").select("m", taxonomy.credit_quality(F.col("m")).alias("b"))
    assert [tuple(r) for r in df.select("m", "b", taxonomy.credit_quality_family(F.col("b"))).collect()] == GRADES
    assert by(spark.createDataFrame([(m,) for m in BUCKETS], "m string").select("m", taxonomy.past_due(F.col("m")).alias("v")), "m", "v") == BUCKETS
    kinds = {"2Q26_Supplement.pdf": "supplement", "Annual Report 2024": None, "Earnings Call slides": "presentation", "Q1 results": "release"}
    assert by(spark.createDataFrame([(m,) for m in kinds], "m string").select("m", taxonomy.document_kind(F.col("m")).alias("v")), "m", "v") == kinds


def test_attached_categories(spark):
    rows = [
        ("WFC", Q[0], True, "Loans", None, "ResidentialMortgageMember", None, None, None), ("WFC", Q[0], True, "Loans", None, "FirstMortgageMember", None, None, None), ("WFC", Q[1], True, "Loans", None, "ResidentialMortgageMember", None, None, None),
        ("WFC", Q[0], False, "ChargeOffs", None, "ResidentialMortgageMember", None, None, None), ("BAC", Q[0], True, "Loans", "CommercialPortfolioSegmentMember", None, None, None, "BasisAxis=NotionalOrContractAmountMember;X=Y"),
        ("BAC", Q[0], True, "PastDue30", "ConsumerPortfolioSegmentMember", "", "SubstandardMember", None, ""), ("BAC", Q[0], True, "PastDue30", None, None, None, "A6089", None),
    ]
    facts = spark.createDataFrame(rows, "ticker string, period date, instant boolean, tag string, segment string, loan_class string, credit_quality string, past_due string, other_dims string")
    out = taxonomy.attach_categories(facts.withColumn("i", F.monotonically_increasing_id()), by_tag={"PastDue30": "dpd_30_89"}).orderBy("i")
    assert [tuple(r) for r in out.select("loan_cat", "scope", "cq_cat", "pd_cat").collect()] == [
        (None, "rollup", None, None), ("resi_mortgage", None, None, None), ("resi_mortgage", None, None, None), ("resi_mortgage", None, None, None), (None, "notional", None, None), ("consumer_total", None, "substandard", "dpd_30_89"), (None, None, None, "dpd_60_89"),
    ]


def test_periods(spark):
    df = spark.createDataFrame([("20240229",), ("99991231",), ("0",), ("",), (None,), ("20241301",)], "s string")
    assert [r[0] for r in df.select(periods.stamp_to_date(F.col("s"))).collect()] == [D(2024, 2, 29), None, None, None, None, None]
    ends = one(spark.range(1).select(periods.quarter_ends_between(F.lit(D(2024, 2, 1)), F.lit(D(2024, 9, 29))).alias("v")))
    assert ends == [D(2024, 3, 31), D(2024, 6, 30)]


FACT = "bank string, ticker string, cik string, tag string, period date, period_start date, instant boolean, value double, unit string, accn string, filed date, segment string, loan_class string, credit_quality string, past_due string, other_dims string, dim_axes string, n_dims int"


def test_facts_panel(spark):
    def fact(tag, value, cls=None, axes="", start=None, end=Q[0]):
        return ("Bank", "TB", "1", tag, end, start, start is None, value, "USD", "a", D(2024, 4, 30), None, cls, None, None, None, axes, int(bool(axes)))

    year = D(2024, 1, 1)
    rows = [fact("Loans", 1000.0), fact("Loans", 300.0, "CreditCardMember", "cls"), fact("Loans", 300.0, "CreditCardAliasMember", "cls"), fact("Loans", 600.0, "CommercialAndIndustrialMember", "cls")]
    rows += [fact("ChargeOffs", 10.0, start=year), fact("ChargeOffs", 25.0, start=year, end=Q[1]), fact("Acl", 9.0, "CreditCardMember", "cls"), fact("Loans", 1100.0, end=Q[1])]
    facts = taxonomy.attach_categories(spark.createDataFrame(rows, FACT))
    variables = [panels.Variable("loans", ("Loans",), by_loan=True), panels.Variable("nco", ("ChargeOffs",), flow=True, by_loan=True), panels.Variable("acl", ("Acl",), by_loan=True)]
    columns = ["loans_total", "loans_credit_card", "loans_ci", "nco_total", "acl_total"]
    out = {r["quarter"]: r for r in panels.facts_panel(facts, variables, columns, {"nco_rate": ("nco_total", "loans_total", True)}, ["loans_total"]).collect()}
    assert [out["2024Q1"][c] for c in columns] == [1000, 300, 600, 10, 9] and out["2024Q1"]["nco_rate"] == 4.0
    assert (out["2024Q2"]["nco_total"], out["2024Q2"]["acl_total"]) == (15, None) and out["2024Q2"]["loans_total_qoq"] == pytest.approx((1.1**4 - 1) * 100)


def test_holdings_panel(spark):
    long = spark.createDataFrame([(r, q, "", "RIAD", "4635", v) for r, q, v in ((1, Q[0], 10.0), (1, Q[1], 30.0), (2, Q[0], 1.0))] + [(1, q, "", "RCFD", "2170", 500.0) for q in Q[:2]], "rssd int, period date, schedule string, prefix string, item string, value double")
    items = [resolve.Item("charge_offs", (("4635",),), ("RIAD",)), resolve.Item("assets", (("2170",),), ("RCFD",))]
    mapping = spark.createDataFrame([("T", r, q) for r in (1, 2) for q in Q[:2]], "ticker string, rssd int, period date")
    _, out = panels.holdings_panel(long, items, ["charge_offs"], mapping, ratios={"rate": ("charge_offs", "assets", True)})
    rows = {r["period"]: r for r in out.collect()}
    assert rows[Q[0]]["charge_offs"] == 11000 and rows[Q[1]]["charge_offs"] == 20000 and rows[Q[1]]["members"] == "1" and rows[Q[1]]["rate"] == pytest.approx(16.0)
