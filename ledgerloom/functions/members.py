"""How disclosures name loan classes, measurement bases, credit quality and past-due
buckets. They are data: whole, and in the order in which they are tried (the first that fits
"""

# fmt: off

# Loan categories and the category that each is a part of.
LOAN_TREE: dict[str, str | None] = {
    "total": None, "commercial_total": "total", "cre_total": "commercial_total", "cre_investor": "cre_total", "cre_owner_occupied": "cre_total",
    "construction": "cre_total", "multifamily": "cre_total", "ci": "commercial_total", "small_business": "commercial_total", "lease": "commercial_total",
    "municipal": "commercial_total", "fund_finance": "commercial_total", "financial_institutions": "commercial_total", "commercial_other": "commercial_total",
    "consumer_total": "total", "resi_mortgage": "consumer_total", "home_equity": "consumer_total", "credit_card": "consumer_total", "auto": "consumer_total",
    "student": "consumer_total", "securities_based": "consumer_total", "consumer_other": "consumer_total", "other": "total",
}

# Members that state a measurement basis, by their exact name.
SCOPES: dict[str, str] = {
    "LoansHeldForSaleMember": "held_for_sale",
    "LoansHeldForInvestmentMember": "held_for_investment",
    "UnfundedLoanCommitmentMember": "unfunded_commitment",
    "LoansReceivableHeldForSaleMember": "held_for_sale",
    "TermLoansMember": "term",
    "TermMember": "term",
    "RevolvingLoansMember": "revolving",
    "EstimateOfFairValueFairValueDisclosureMember": "fair_value",
    "PortionAtFairValueFairValueDisclosureMember": "fair_value",
    "CarryingReportedAmountFairValueDisclosureMember": "carrying_amount",
    "PortionAtOtherThanFairValueFairValueDisclosureMember": "carrying_amount",
    "CarriedAtFairValueMember": "fair_value",
    "FairValueMember": "fair_value",
    "NotionalOrContractAmountMember": "notional",
}

# Patterns of further measurement bases.
SCOPE_RULES: tuple[tuple[str, str], ...] = (
    (r"^(?!.*Excluding).*(?:Purchase[dr]?CreditImpaired|PurchasedImpaired|PurchaseImpaired|PCI|Pci|AcquiredWithDeterioratedCreditQuality|AcquiredCreditImpaired|LoansAcquiredInTransfer)", "purchased_credit_impaired"),
    (r"^(?:Covered|FdicSupported|FDICSupported|FederalDepositInsuranceCorporationSupported|LoansExcludingCovered)|(?:Including|Excluding)CoveredAssets", "fdic_covered"),
    (r"^GovernmentGuaranteedLoans|^GovernmentInsured|GovernmentNationalMortgageAssociation|^GinnieMae|(?i:totalloansexcludinggovernmentandgnmaguaranteed)|^LossesReimbursableByGovernmentAgency", "government_guaranteed"),
    (r"^CollectivelyEvaluatedForImpairment|^IndividuallyEvaluatedForImpairment|^EvaluatedBasedOnCollateralValues", "impairment_method"),
    (r"^Impaired(?:FinancingReceivable|With|Loans|Collateral)|With(?:No)?(?:Related|Recorded|an)?Allowance", "impaired"),
    (r"^(?:Non)?AcquiredFinancingReceivable|^AcquiredLoans", "acquired_status"),
    (r"^Allocated|^Unallocated", "allocation"),
    (r"^NonperformingAssets|^NonperformingLoans|^NonperformingMember|^Non[Aa]ccruing|^Accruing|^PerformingRestructurings", "accrual_status"),
    (r"^ReserveForUnfundedLendingCommitments|^UnfundedLendingReserve|^AllowanceForLendingRelatedCommitments|^CommitmentsToExtendCredit|^StandbyLettersOfCredit", "unfunded_commitment"),
)

# Patterns of loan classes.
LOAN_CLASSES: tuple[tuple[str, str], ...] = (
    (r"Excluding.{0,80}Construction", "cre_total"),
    (r"Construction|Land(Acquisition)?And?Development|LandDevelopment", "construction"),
    (r"Multifamily|MultiFamily|ApartmentBuilding", "multifamily"),
    (r"REITLoans|RealEstateInvestmentTrust", "cre_investor"),
    (r"OwnerOccupied|Occupied.*Commercial|CommercialOwner", "cre_owner_occupied"),
    (r"InvestorRealEstate|NonOwnerOccupied|IncomeProducing|InvestorCommercial|CommercialLessors|CommercialMortgage(?!Backed)", "cre_investor"),
    (r"CommercialRealEstate|CommercialMortgage|RealEstateCommercial|^RealEstateLoan|CommercialPropert", "cre_total"),
    (r"Excluding.{0,20}CreditCard|CreditCard.{0,20}Excluded", "consumer_other"),
    (r"CreditCard|(?i:cardmember)|CardReceivable", "credit_card"),
    (r"Automobile|AutoLoan|AutoFinanc|VehicleLoan|RetailAutomotive", "auto"),
    (r"HomeEquity|SecondMortgage|HELOC", "home_equity"),
    (r"ReverseMortgage", "resi_mortgage"),
    (r"ResidentialMortgage|ResidentialRealEstate|Residential(?!.*Commercial)|^Mortgages?Member|OneToFourFamily|FirstMortgage|FirstLien", "resi_mortgage"),
    (r"Student|Education", "student"),
    (r"SecuritiesBased|MarginLoan|SecuritiesLending|PledgedAssetLines|SecuredLendingFacilities", "securities_based"),
    (r"SmallBusiness", "small_business"),
    (r"Municipal|TaxExempt|PublicFinance", "municipal"),
    (r"CapitalCall|SubscriptionFinance|FundFinance|PrivateEquityCapital", "fund_finance"),
    (r"LoansToFinancialInstitutions|^FinancialInstitutionsMember|CollateralizedLoanObligation|SecuritiesFinanceLoans", "financial_institutions"),
    (r"CommercialAndIndustrial|^CorporateLoan|CommercialAndFinancial|BusinessBanking|BusinessandCorporateBanking|SyndicatedLoans", "ci"),
    (r"^(?![A-Za-z]*[Ll]oans?[Aa]nd[Ll]eases?)(?=.*(?:FinanceLeases?|LeaseFinancing|DirectFinancingLease|Leases?(?:PortfolioSegment)?Member))", "lease"),
    (r"^CommercialPortfolioSegment|^CommercialLoan(AndLease)?|^WholesaleMember|^Commercial(?!.*(RealEstate|Mortgage))", "commercial_total"),
    (r"^ConsumerPortfolioSegment|^ConsumerAndResidential|^RetailMember|^Consumer(?!.*(Other|Revolving|Installment|Retail))", "consumer_total"),
    (r"^ResidentialPortfolioSegment", "resi_mortgage"),
    (r"^TotalCommercialMember$", "commercial_total"),
    (r"^TotalConsumerMember$", "consumer_total"),
    (r"ConsumerOther|OtherConsumer|ConsumerRevolving|ConsumerInstallment|ConsumerRetail|OtherRetail|PersonalLoan|PersonalUnsecured|RVandMarine|RecreationalFinance|SolarEnergy|IndirectSecuredConsumer|BankcardAndOtherRevolving|Overdraft|PrivateClient|LoansToFinancialAdvisors|WealthManagementLoans|ConsumerLoanOther|DirectandIndirectFinancingReceivable|DirectAndIndirect", "consumer_other"),
    (r"^RetailBankingMember", "consumer_total"),
    (r"InvestorDependentEarlyStage|EarlyStage|VentureLending", "ci"),
    (r"WealthManagementMortgages|RevolvingMortgage|FHAVA", "resi_mortgage"),
    (r"ForeignCommercial", "commercial_other"),
    (r"ForeignConsumer", "consumer_other"),
    (r"OtherLoans|OtherFinancingReceivable|^Other", "other"),
)

# Readings of one filer's members that go before every rule.
OVERRIDES: dict[tuple[str, str], str] = {
    ("RF", "TotalInvestorRealEstateMember"): "cre_investor",
    ("WFC", "CommercialLoanMember"): "ci",
    ("WFC", "ConsumerLoanMember"): "consumer_other",
    ("WFC", "ForeignLoansMember"): "commercial_other",
    ("WFC", "WholesaleRealEstateCommercialLessorsMember"): "cre_investor",
    ("WFC", "WholesaleRealEstateCommercialConstructionAndDevelopmentMember"): "construction",
    ("COF", "OtherLoansMember"): "commercial_other",
    ("MS", "SecuritiesBasedLendingandOtherLoansMember"): "securities_based",
    ("MS", "SecuritiesBasedLendingMember"): "securities_based",
    ("TFC", "CreOtherExcludingCoveredMember"): "cre_total",
    ("TFC", "CreResidentialAdcExcludingCoveredMember"): "construction",
    ("TFC", "CommercialAndIndustrialExcludingCoveredMember"): "ci",
    ("TFC", "CommercialOtherLendingSubsidiariesExcludingCoveredMember"): "commercial_other",
    ("TFC", "RetailResidentialMortgageExcludingCoveredMember"): "resi_mortgage",
    ("TFC", "RetailRevolvingCreditExcludingCoveredMember"): "credit_card",
    ("TFC", "DirectRetailLendingExcludingCoveredMember"): "consumer_other",
    ("TFC", "RetailSalesFinanceExcludingCoveredMember"): "consumer_other",
    ("TFC", "RetailOtherLendingSubsidiariesExcludingCoveredMember"): "consumer_other",
}

# Rollups of one filer that give way where the same quarter reports their parts.
SUPERSEDED: dict[tuple[str, str], tuple[str, ...]] = {
    ("WFC", "ResidentialMortgageMember"): ("FirstMortgageMember",),
}

# Credit-quality buckets and the bucket that each is a part of.
CREDIT_QUALITY_TREE: dict[str, str | None] = {
    "pass": None, "special_mention": "criticized", "substandard": "classified", "doubtful": "classified", "loss": "classified", "classified": "criticized",
    "criticized": None, "nonaccrual": None, "performing": None, "nonperforming": None, "investment_grade": None, "non_investment_grade": None, "unrated": None,
    "internal_grade_low": None, "internal_grade_mid": None, "internal_grade_high": None, "fico_prime": None, "fico_near_prime": None, "fico_subprime": None,
}

# Families of buckets, which one ratio never mixes; the others are "regulatory".
CREDIT_QUALITY_FAMILIES: dict[str, tuple[str, ...]] = {
    "internal_ig": ("investment_grade", "non_investment_grade"),
    "internal_ladder": ("internal_grade_low", "internal_grade_mid", "internal_grade_high"),
    "fico": ("fico_prime", "fico_near_prime", "fico_subprime"),
}

# Patterns of credit-quality buckets.
CREDIT_QUALITY: tuple[tuple[str, str], ...] = (
    (r"CriticizedNonaccru", "criticized"),
    (r"CriticizedAccru|CriticizedPerforming", "criticized"),
    (r"Criticized", "criticized"),
    (r"SpecialMention|OtherAssetsEspeciallyMentioned", "special_mention"),
    (r"Substandard", "substandard"),
    (r"Doubtful", "doubtful"),
    (r"^LossMember|ClassifiedLoss", "loss"),
    (r"Classified", "classified"),
    (r"^PassMember|^Pass(?!Due)|Acceptable|WatchMember", "pass"),
    (r"NonAccrual|Nonaccrual", "nonaccrual"),
    (r"NonperformingFinancing|NonPerforming", "nonperforming"),
    (r"^PerformingFinancing|^Performing", "performing"),
    (r"InternalNoninvestmentGrade|NonInvestmentGrade|NoninvestmentGrade", "non_investment_grade"),
    (r"InternalInvestmentGrade|InvestmentGradeMember|AOrBetter", "investment_grade"),
    (r"Unrated|NotRated|Ungraded|NotAssigned|UsingFicoCreditMetric", "unrated"),
    (r"(?i:fico).{0,24}(?i:below|less\s?than)\s?\d{3}|(?i:score)less(?i:than)\d{3}", "fico_subprime"),
    (r"(?i:fico).{0,24}(?i:not\s?available|no\s?score)", "unrated"),
    (r"(?i:fico).{0,24}(740|greater\s?than\s?\d{3}|(?i:and\s?above)|660)|EqualToOrGreaterThan660|FicoScoresEqualToOrGreaterThan", "fico_prime"),
    (r"FicoScore620Through679|FICOScore620Through679|FicoScore680Through739|FICOScore680Through739", "fico_near_prime"),
    (r"Subprime", "fico_subprime"),
    (r"Prime", "fico_prime"),
    (r"OneToThreeInternalGrade|InternalRiskRating[123]Member|RiskLevelLow", "internal_grade_low"),
    (r"FourToFiveInternalGrade|InternalRiskRating[45]Member|RiskLevelMedium", "internal_grade_mid"),
    (r"SixToNineInternalGrade|InternalRiskRating[6789]Member|RiskLevelHigh", "internal_grade_high"),
)

# Patterns of past-due buckets; case does not count.
PAST_DUE: tuple[tuple[str, str], ...] = (
    (r"nonaccrual", "nonaccrual"),
    (r"nonperforming", "nonperforming"),
    (r"foreclosure", "in_foreclosure"),
    (r"currentand(less|lessthan)?30|notpastdue|^currentmember|financialassetcurrent", "current"),
    (r"30to59|30through59|3059", "dpd_30_59"),
    (r"60to89|60through89|6089", "dpd_60_89"),
    (r"30to89|30through89|3089|30to149", "dpd_30_89"),
    (r"90|150|greaterthan90|equaltogreaterthan90", "dpd_90_plus"),
    (r"pastdue", "past_due_total"),
)

# Axes that become columns of a fact, per column in the order in which they are tried.
PROMOTED_AXES: dict[str, tuple[str, ...]] = {
    "segment": ("FinancingReceivablePortfolioSegmentAxis", "ProductOrServiceAxis", "PortfolioSegmentAxis", "FinancingReceivableInformationByPortfolioSegmentAxis"),
    "loan_class": ("FinancingReceivableRecordedInvestmentByClassOfFinancingReceivableAxis", "ClassOfFinancingReceivableAxis", "AccountsNotesLoansAndFinancingReceivableByReceivableTypeAxis", "FinancialInstrumentAxis"),
    "credit_quality": ("InternalCreditAssessmentAxis", "FinancingReceivableCreditQualityIndicatorAxis", "CreditRatingMoodysAxis", "CreditScoreFicoAxis", "CreditQualityIndicatorAxis", "FinancingReceivableInformationByCreditQualityIndicatorAxis", "FinancingReceivableRecordedInvestmentByCreditQualityIndicatorAxis"),
    "past_due": ("FinancingReceivablesPeriodPastDueAxis", "FinancingReceivableByDelinquencyStatusAxis", "FinancingReceivableInformationByDelinquencyStatusAxis", "AgingAnalysisOfLoansAndLeasesAxis"),
    "consolidation": ("ConsolidationItemsAxis", "StatementBusinessSegmentsAxis"),
}
# Parts of the names of axes that cut a balance into slices of itself, and the axes of a
# loan's class or segment that are preferred to older ones.
SUBSLICE_AXES = ("FinancingReceivablesPeriodPastDueAxis", "InternalCreditAssessmentAxis", "CreditQualityIndicatorAxis", "CreditScoreFicoAxis", "DelinquencyStatusAxis", "AgingAnalysisOfLoansAndLeasesAxis")
MODERN_LOAN_AXES = ("FinancingReceivablePortfolioSegmentAxis", "FinancingReceivableRecordedInvestmentByClassOfFinancingReceivableAxis", "ClassOfFinancingReceivableAxis", "FinancialInstrumentAxis", "ProductOrServiceAxis")

# Names of documents that look quarterly and are not, and kinds of those that are.
NOT_QUARTERLY = r"proxy|annual report|\b10 ?[kq]\b|prospectus|indenture|code of conduct|privacy|sustainab|\besg\b|citizenship|charter|by ?laws|underwriting|dividend announce|\bccar\b|dfast disclosure|stress test|pillar 3|resolution plan|tax form|\bw ?9\b|transcript|\baudio\b|\bxbrl\b"
DOCUMENTS: tuple[tuple[str, str], ...] = (
    (r"credit ?metrics|monthly charge", "credit_metrics"),
    (r"supplement|quarterly performance summary|\bqps\b|financial highlights|statistical (supplement|summary)|financial (schedules|tables|data)", "supplement"),
    (r"presentation|slides|\bdeck\b|investor day|conference call|earnings call", "presentation"),
    (r"earnings release|press release|news release|reports? (first|second|third|fourth) quarter|\bresults\b|\bearnings\b", "release"),
)
# Kinds of documents by their opening text, its least readable length, and the kind that
# an exhibit's number suggests where the text does not tell.
CONTENTS: tuple[tuple[str, str], ...] = (
    (r"for immediate release|news release|press release|reports? (first|second|third|fourth).quarter (\w+ ){0,3}results|media contact|investor contact.{0,200}media", "release"),
    (r"earnings presentation|investor presentation|presentation slides|company update presentation|earnings deck|investor day", "presentation"),
    (r"financial supplement|quarterly performance summary|supplemental (information|financial)|selected financial data|quarterly financial (data|schedules|supplement)|selected quarterly (financial )?data|statistical (supplement|information)|financial highlights", "supplement"),
    (r"conference call presentation|earnings (call|conference)", "presentation"),
)
READABLE, OPENING = 400, 6000
EXHIBITS: dict[str, str] = {"EX-99.1": "release", "EX-99.2": "supplement", "EX-99.3": "presentation"}
