"""The catalogue of the facts panel: variables with the tags that may report them, in order of
has the sources."""

from __future__ import annotations

# Tags of a balance at one day, the preferred first.
STOCK_TAGS = """
loans FinancingReceivableExcludingAccruedInterestBeforeAllowanceForCreditLoss
loans LoansAndLeasesReceivableNetReportedAmount
loans NotesReceivableGross
loans LoansAndLeasesReceivableNetOfDeferredIncome
loans LoansAndLeasesReceivableGrossCarryingAmount
acl FinancingReceivableAllowanceForCreditLosses
acl FinancingReceivableAllowanceForCreditLoss
acl FinancingReceivableAllowanceForCreditLossExcludingAccruedInterest
acl AllowanceForLoanAndLeaseLossesRealEstate
acl LoansAndLeasesReceivableAllowance
nonaccrual FinancingReceivableExcludingAccruedInterestNonaccrual
nonaccrual FinancingReceivableRecordedInvestmentNonaccrualStatus
nonaccrual FinancingReceivableNonaccrualNoAllowance
nonaccrual FinancingReceivableExcludingAccruedInterestNonaccrualNoAllowance
nonaccrual LoansAndLeasesReceivableImpairedNonperformingNonaccrualOfInterest
oreo OtherRealEstateAndForeclosedAssets
oreo RealEstateAcquiredThroughForeclosure
oreo ForeclosedAssets
oreo OtherRealEstate
assets Assets
equity StockholdersEquity
deposits Deposits
unfunded_commitments OffBalanceSheetCreditLossLiability
unfunded_commitments CommitmentsToExtendCredit
"""

# Tags of an amount over a span of days, the preferred first.
FLOW_TAGS = """
nco FinancingReceivableExcludingAccruedInterestAllowanceForCreditLossWriteoffAfterRecovery
nco FinancingReceivableAllowanceForCreditLossWriteoffAfterRecovery
nco AllowanceForLoanAndLeaseLossesWriteoffsNet
nco FinancingReceivableAllowanceForCreditLossesNetChargeOffs
charge_offs FinancingReceivableExcludingAccruedInterestAllowanceForCreditLossWriteoff
charge_offs FinancingReceivableAllowanceForCreditLossWriteoff
charge_offs FinancingReceivableAllowanceForCreditLossesWriteOffs
charge_offs AllowanceForLoanAndLeaseLossesWriteOffs
recoveries FinancingReceivableExcludingAccruedInterestAllowanceForCreditLossRecovery
recoveries FinancingReceivableAllowanceForCreditLossesRecovery
recoveries FinancingReceivableAllowanceForCreditLossesRecoveries
recoveries AllowanceForLoanAndLeaseLossesRecoveriesOfBadDebts
recoveries AllowanceForLoanAndLeaseLossRecoveryOfBadDebts
provision ProvisionForLoanLeaseAndOtherLosses
provision ProvisionForLoanAndLeaseLosses
provision ProvisionForLoanLossesExpensed
provision ProvisionForCreditLosses
net_income NetIncomeLoss
nii InterestIncomeExpenseNet
revenue Revenues
"""
# Variables that are broken down by loan class.
BY_LOAN = ("loans", "acl", "nonaccrual", "nco", "charge_offs", "recoveries", "provision")

# Tags that state a past-due bucket by themselves, the preferred first.
PAST_DUE_TAGS = """
current FinancingReceivableRecordedInvestmentCurrent
current FinancingReceivableRecordedInvestmentCurrentAnd1To29DaysPastDue
current FinancingReceivableRecordedInvestmentCurrentAndOneToTwentyNineDaysPastDue
dpd_30_59 FinancingReceivableRecordedInvestment30To59DaysPastDue
dpd_60_89 FinancingReceivableRecordedInvestment60To89DaysPastDue
dpd_30_89 FinancingReceivableRecordedInvestment30To89DaysPastDue
dpd_30_89 FinancingReceivableRecordedInvestment30To89DaysPastDueAndStillAccruing
dpd_30_89 FinancingReceivableRecordedInvestmentThirtyToEightyNineDaysPastDue
dpd_30_89 FinancingReceivablesRecordedInvestmentThirtyToEightyNineDaysPastDue
dpd_30_89 LoansAndLeasesReceivableThirtyToEightyNineDaysPastDue
dpd_90_plus FinancingReceivableRecordedInvestmentEqualToGreaterThan90DaysPastDue
dpd_90_plus FinancingReceivableRecordedInvestment90DaysPastDueAndStillAccruing
dpd_90_plus FinancingReceivablesRecordedInvestmentEqualToOrGreaterThanNinetyDaysPastDue
past_due_total FinancingReceivableRecordedInvestmentPastDue
past_due_total FinancingReceivableRecordedInvestmentPastDueExcluding1To29DaysPastDue
"""

# Ratios as name, numerator, denominator; a * marks a quarter's flow, taken four times.
SHARED_RATIOS = """
cre_pct loans_cre_total loans_total
construction_pct loans_construction loans_total
ci_pct loans_ci loans_total
multifamily_pct loans_multifamily loans_total
cre_investor_pct loans_cre_investor loans_total
cre_owner_occupied_pct loans_cre_owner_occupied loans_total
small_business_pct loans_small_business loans_total
credit_card_pct loans_credit_card loans_total
resi_pct loans_resi_mortgage loans_total
consumer_pct loans_consumer_total loans_total
commercial_pct loans_commercial_total loans_total
nco_rate nco_total loans_total *
nco_rate_cre nco_cre_total loans_cre_total *
nco_rate_ci nco_ci loans_ci *
nco_rate_card nco_credit_card loans_credit_card *
npa_ratio npa_total loans_total
nonaccrual_ratio nonaccrual_total loans_total
reserve_coverage acl_total loans_total
reserve_to_nonaccrual acl_total nonaccrual_total
reserve_coverage_cre acl_cre_total loans_cre_total
provision_to_nco provision_total nco_total
criticized_pct cq_criticized loans_total
classified_pct cq_classified loans_total
special_mention_pct cq_special_mention loans_total
substandard_pct cq_substandard loans_total
investment_grade_pct cq_investment_grade cq_rated_total
dpd_30_89_pct pd_dpd_30_89 loans_total
dpd_90_plus_pct pd_dpd_90_plus loans_total
loans_to_assets loans_total assets
loans_to_deposits loans_total deposits
office_cre_pct loans_office_cre loans_total
office_nonaccrual_ratio nonaccrual_office_cre loans_office_cre
office_reserve_coverage acl_office_cre loans_office_cre
leveraged_pct loans_leveraged loans_total
"""

# Ratios of the charters' panel alone.
CALL_RATIOS = """
nco_rate_construction nco_construction loans_construction *
nco_rate_cre_nonfarm_nonres nco_cre_nonfarm_nonres loans_cre_nonfarm_nonres *
nco_rate_multifamily nco_multifamily loans_multifamily *
nco_rate_resi nco_resi_mortgage loans_resi_mortgage *
nco_rate_home_equity nco_home_equity loans_home_equity *
nco_rate_consumer_noncard nco_consumer_noncard loans_consumer_noncard *
provision_rate provision_total loans_total *
noncurrent_ratio noncurrent_total loans_total
reserve_to_noncurrent acl_total noncurrent_total
nonaccrual_ratio_construction nonaccrual_construction loans_construction
nonaccrual_ratio_cre_nonfarm_nonres nonaccrual_cre_nonfarm_nonres loans_cre_nonfarm_nonres
nonaccrual_ratio_resi nonaccrual_resi_mortgage loans_resi_mortgage
dpd_30_89_pct_resi dpd_30_89_resi_mortgage loans_resi_mortgage
dpd_30_89_pct_construction dpd_30_89_construction loans_construction
tdr_pct loans_tdr_accruing loans_total
brokered_deposits_pct deposits_brokered deposits
commitments_to_loans commitments_total loans_total
roa net_income assets_average *
ppnr_rate ppnr assets_average *
nii_to_avg_assets net_interest_income assets_average *
wholesale_funding_pct wholesale_funding assets
tce_ratio tangible_common_equity tangible_assets
equity_to_assets equity assets
"""

# Balances whose growth both panels state.
GROWTH = ("loans_total", "loans_cre_total", "loans_construction", "loans_ci", "loans_multifamily", "deposits")


def pairs(table: str) -> list[tuple[str, str]]:
    return [(a, b) for a, b in map(str.split, table.strip().splitlines())]


def ratios(*tables: str) -> dict[str, tuple[str, str, bool]]:
    rows = [line.split() for t in tables for line in t.strip().splitlines()]
    return {r[0]: (r[1], r[2], r[3:] == ["*"]) for r in rows}


PAST_DUE_BY_TAG = {tag: bucket for bucket, tag in pairs(PAST_DUE_TAGS)}
