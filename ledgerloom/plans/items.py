"""The catalogue of Call Report items: which columns a charter's panel has, and of which lines.

A line of a table is: column, schedules in order of preference, items that add up, then coarser
variants, the coarsest first; ``key=value`` sets the prefixes (in order of preference), a second
sources."""

from __future__ import annotations

from ..operators.resolve import Item

# Prefixes of a kind of line, in the order in which they are tried.
BALANCE, INCOME, CAPITAL, LEGACY_CAPITAL = ("RCFD", "RCON"), ("RIAD",), ("RCFA", "RCOA"), ("RCFD", "RCON", "RCFA", "RCOA")

# The loan classes that make up a charter's book.
LEAVES = """
loans_construction             RCCI F158+F159 1415
loans_farmland                 RCCI 1420
loans_home_equity              RCCI 1797
loans_resi_mortgage            RCCI 5367+5368
loans_multifamily              RCCI 1460
loans_cre_nonfarm_nonres       RCCI F160+F161 1480
loans_ci                       RCCI 1763+1764 1766
loans_depository_institutions  RCCI B532+B533+B534+B536+B537 1288
loans_agricultural             RCCI 1590
loans_municipal                RCCI 2107
loans_lease                    RCCI F162+F163 2165
loans_credit_card              RCCI B538
loans_consumer_revolving_other RCCI B539
loans_consumer_installment     RCCI K137+K207 2011
loans_other_total              RCCI J454+1545+2081+J451+1564 1563 J454+J464
"""

# Detail beside the classes, the book's own total, and other balances.
BALANCES = """
loans_cre_owner_occupied       RCCI F160
loans_cre_investor             RCCI F161
loans_auto                     RCCI K137
loans_consumer_other           RCCI B539+K207
loans_securities_based         RCCI 1545
loans_nondepository_fi         RCCI J454
loans_other                    RCCI 1545+2081+J451+1564 J464
loans_tdr_accruing             RCCI K158+K159+K160+K161+K162+K163+K164+K256+K165 HK25 1616 prefer=first
loans_rcc_total                RCCI 2122
loans_unearned_income          RCCI 2123
loans_total                    RC B528
loans_held_for_sale            RC 5369
acl_total                      RC 3123
assets                         RC 2170
equity                         RC 3210
oreo                           RC 2150
deposits                       RC 2200 prefixes=RCON plus=RCFN
trading_assets                 RC 3545
securities_afs                 RC 1773
securities_htm                 RCB 1754
securities_htm_fair_value      RCB 1771
securities_afs_amortized_cost  RCB 1772
goodwill                       RC,RCM 3163
intangibles_total              RC,RCM 2143 3163+0426 prefer=first
preferred_stock                RC 3838
fed_funds_repo_purchased       RC B993+B995 2800
borrowings_other               RC 3190
deposits_brokered              RCE,RCEI 2365 prefixes=RCON
assets_average                 RCK 3368
loans_average                  RCK 3360 prefixes=RCON plus=RCFN
deposits_in_banks_average      RCK 3381
securities_average             RCK B558+B559+B560
deposits_uninsured             RCO 5597 prefixes=RCON
loans_small_business_ci        RCCII 5571+5573+5575 prefixes=RCON
loans_small_business_cre       RCCII 5565+5567+5569 prefixes=RCON
commitments_home_equity        RCL 3814
commitments_credit_card        RCL 3815
commitments_cre_construction   RCL F164+F165 3816
commitments_cre_not_secured    RCL 6550
commitments_securities_underwriting RCL 3817
commitments_other              RCL J457+J458+J459 3818
standby_letters_of_credit      RCL 3819
pd_dpd_30_89                   RCN 1406
pd_dpd_90_plus                 RCN 1407
nonaccrual_total               RCN 1403
"""

# RC-N by class: past due 30 to 89 days, 90 and more, nonaccrual; after | a coarser variant.
PAST_DUE = """
construction            F172+F173 F174+F175 F176+F177 | 2759 2769 3492
farmland                3493 3494 3495
home_equity             5398 5399 5400
resi_mortgage           C236+C238 C237+C239 C229+C230 | 5401 5402 5403
multifamily             3499 3500 3501
cre_nonfarm_nonres      F178+F179 F180+F181 F182+F183 | 3502 3503 3504
foreign_office          B572 B573 B574
re_foreign              1248 1249 1250
depository_institutions 5377+5380 5378+5381 5379+5382 | B834 B835 B836
agricultural            1594 1597 1583
ci                      1251+1254 1252+1255 1253+1256 | 1606 1607 1608
credit_card             B575 B576 B577
consumer_installment    K213+K216 K214+K217 K215+K218 | B578 B579 B580
foreign_govt            5389 5390 5391
other_loans             5459 5460 5461
lease                   F166+F169 F167+F170 F168+F171 | 1226 1227 1228 | 1257+1271 1258+1272 1259+1791
cre_owner_occupied      F178 F180 F182
cre_investor            F179 F181 F183
auto                    K213 K214 K215
consumer_other          K216 K217 K218
"""
# The classes that make up RC-N's totals, the prefixes of the line that exists abroad only.
PAST_DUE_CLASSES = "construction farmland home_equity resi_mortgage multifamily cre_nonfarm_nonres foreign_office depository_institutions ci credit_card consumer_installment foreign_govt other_loans lease".split()
FOREIGN = {"foreign_office": ("RCFN",)}

# RI-B by class: charge-offs, recoveries; after | a coarser variant.
LOSSES = """
total                 4635 4605
ci                    4645+4646 4617+4618 | 4638 4608
construction          C891+C893 C892+C894 | 3582 3583
multifamily           3588 3589
cre_nonfarm_nonres    C895+C897 C896+C898 | 3590 3591
cre_owner_occupied    C895 C896
cre_investor          C897 C898
resi_mortgage         C234+C235 C217+C218 | 5413 5414
home_equity           5411 5412
credit_card           B514 B515
auto                  K129 K133
consumer_noncard      K129+K205 K133+K206 | B516 B517
lease                 F185+C880 F187+F188 | 4266 4267
"""

# Other income lines.
INCOME_LINES = """
provision_total      RIBII 4230
acl_beginning        RIBII B522
net_income           RI 4340
net_interest_income  RI 4074
noninterest_income   RI 4079
noninterest_expense  RI 4093
interest_income      RI 4107
interest_expense     RI 4073
"""

# Regulatory capital, under the rules since 2015 and before.
CAPITAL_LINES = """
cet1_capital         RCRI P859
tier1_capital        RCRI 8274
total_capital        RCRI 3792
risk_weighted_assets RCRI A223
"""
LEGACY_CAPITAL_LINES = """
tier1_capital_basel1        RCR,RCRIA,RCRIB 8274
total_capital_basel1        RCR,RCRIA,RCRIB 3792
risk_weighted_assets_basel1 RCR,RCRIA,RCRIB A223
"""

# Sums of columns, in the order in which they are made.
GROUPS: dict[str, tuple[str, ...]] = {
    "loans_cre_total": ("loans_cre_nonfarm_nonres", "loans_construction", "loans_multifamily"),
    "loans_financial_institutions": ("loans_depository_institutions", "loans_nondepository_fi"),
    "loans_commercial_total": ("loans_cre_total", "loans_ci", "loans_depository_institutions", "loans_nondepository_fi", "loans_municipal", "loans_lease"),
    "loans_consumer_total": ("loans_resi_mortgage", "loans_home_equity", "loans_credit_card", "loans_consumer_revolving_other", "loans_consumer_installment"),
    "loans_consumer_noncard": ("loans_consumer_revolving_other", "loans_consumer_installment"),
    "commitments_total": ("commitments_home_equity", "commitments_credit_card", "commitments_cre_construction", "commitments_cre_not_secured", "commitments_securities_underwriting", "commitments_other"),
}
# Year-to-date flows that cannot fall within a year.
MONOTONE = ("charge_offs_total", "recoveries_total", "interest_income", "interest_expense", "noninterest_expense")


def _variant(text: str) -> tuple[str, ...]:
    return tuple(text.split("+"))


def _lines(table: str, prefixes: tuple[str, ...]) -> list[Item]:
    out = []
    for name, schedules, *rest in map(str.split, table.strip().splitlines()):
        options = dict(x.split("=") for x in rest if "=" in x)
        finest, *coarser = [_variant(x) for x in rest if "=" not in x]
        own = tuple(options["prefixes"].split(",")) if "prefixes" in options else prefixes
        out.append(Item(name, (*coarser, finest), own, tuple(schedules.split(",")), options.get("prefer", "complete"), options.get("plus")))
    return out


def _by_class(table: str, stems: tuple[str, ...], schedule: str, prefixes: tuple[str, ...]) -> list[Item]:
    """A column per class and stem; the groups between | are variants, the finest first."""
    out = []
    for line in table.strip().splitlines():
        name, groups = line.split(None, 1)
        finest, *coarser = [g.split() for g in groups.split("|")]
        out += [Item(f"{stem}_{name}", tuple(_variant(g[i]) for g in (*coarser, finest)), FOREIGN.get(name, prefixes), (schedule,)) for i, stem in enumerate(stems)]
    return out


LEAF_ITEMS = _lines(LEAVES, BALANCE)
FLOW_ITEMS = _by_class(LOSSES, ("charge_offs", "recoveries"), "RIBI", INCOME) + _lines(INCOME_LINES, INCOME)
ITEMS: list[Item] = [
    *LEAF_ITEMS, *_lines(BALANCES, BALANCE), *_by_class(PAST_DUE, ("dpd_30_89", "dpd_90_plus", "nonaccrual"), "RCN", BALANCE),
    *FLOW_ITEMS, *_lines(CAPITAL_LINES, CAPITAL), *_lines(LEGACY_CAPITAL_LINES, LEGACY_CAPITAL),
]
#: RC-N's totals and the columns that they are built of where the form has none.
BUILT_TOTALS = {total: [f"{stem}_{c}" for c in PAST_DUE_CLASSES] for total, stem in (("pd_dpd_30_89", "dpd_30_89"), ("pd_dpd_90_plus", "dpd_90_plus"), ("nonaccrual_total", "nonaccrual"))}
