"""The catalogue of tables that documents are searched for. Fixed values all: signals of a table, labels
sources; ``grids`` reads with them."""

from __future__ import annotations

from .grids import Grid, Table

# What no reading takes: labels of rows, and captions of tables.
SKIP_LABEL = r"experiencing financial difficulty|troubled debt|modification|held for sale|unfunded|commitment|guarantee|servicing|fair value|weighted average|per share|percent|%|\bexcluding\b|\bexcept\b|\bnon-?criticized\b|\bpre-?provision\b|\bratio\b"
SKIP_TABLE = (r"increase \(decrease\) in interest income", r"yields?\s*/\s*rates?", r"rate/volume", r"average balance", r"greater than one year", r"unfunded|credit commitments")
SKIP_GRID = r"troubled debt|\btdrs?\b|modificat|experiencing financial difficulty|held for sale|purchased credit"

# Tables of filings: name, least hits, signals, then rows as column: pattern.
_FILINGS = """
acl_rollforward 3: allowance for credit losses; beginning balance; charge-offs; recoveries; provision; ending balance
  acl_beginning: beginning balance|balance,? (at )?beginning
  nco: net\\b.{0,30}charge.?offs
  charge_offs: gross charge.?offs|charge.?offs
  recoveries: recoveries
  provision: provision
  acl_ending: ending balance|balance,? (at )?end
loan_portfolio 3: commercial and industrial; commercial real estate; residential; total loans; construction; home equity; credit card
  loans_cre_total: commercial real estate|commercial mortgage
  loans_construction: construction|land development
  loans_ci: commercial and industrial|c&i\\b
  loans_multifamily: multifamily|multi-family
  loans_cre_owner_occupied: owner.?occupied
  loans_cre_investor: non.?owner.?occupied|investor (commercial )?real estate
  loans_small_business: small business
  loans_resi_mortgage: residential mortgage|residential real estate|1-4 family
  loans_home_equity: home equity
  loans_credit_card: credit card
  loans_auto: automobile|auto\\b|indirect auto
  loans_lease: lease financing|leases
  loans_total: total loans( and leases)?
credit_quality 2: pass; special mention; substandard; criticized; classified; doubtful; risk rating; internal risk
  cq_special_mention: special mention
  cq_substandard: substandard
  cq_doubtful: doubtful
  cq_loss: ^loss$
  cq_criticized: criticized
  cq_classified: classified
  cq_pass: ^pass
  cq_criticized: total (criticized|classified)
nonperforming 2: nonaccrual; nonperforming; other real estate owned; 90 days; past due
  nonaccrual_total: total nonaccrual|nonaccrual loans
  oreo: other real estate owned|oreo|foreclosed
  npa_total: total non.?performing assets
  pd_dpd_90_plus: 90 days.*(past due|accruing)
  pd_dpd_30_89: 30.{0,4}89 days
cre_property_type 3: by property type; industrial / warehouse; industrial/warehouse; multi-family rental; shopping centers; hotel; non-residential; multi-use
  loans_office_cre: ^office$|^office loans?$|^office buildings?$
  loans_multifamily: ^multi.?family rental
  loans_cre_total: ^total outstanding commercial real estate loans?$
"""

# Grids: rows and columns of a delinquency schedule, its caption; grades of a vintage table.
AGING = Grid(
    "delinquency_by_category",
    r"age analysis|aging|past.?due (status|analysis|financing|loans)|analysis of past.?due|delinquenc",
    ((r"30\s*[-–to]+\s*89|30\s*[-–to]+\s*59|60\s*[-–to]+\s*89", "dpd_30_89"), (r"90 days? or (more|greater)|90\+|greater than 90 days|90 days? and over", "dpd_90_plus")),
    (
        (r"^total loans( and leases)?\b", "total"), (r"commercial real estate|commercial mortgage", "cre_nonfarm_nonres"), (r"construction|land development", "construction"), (r"commercial and industrial|c&i\b", "ci"), (r"multifamily|multi-family", "multifamily"),
        (r"residential mortgage|residential real estate|1-4 family", "resi_mortgage"), (r"home equity", "home_equity"), (r"credit card", "credit_card"), (r"automobile|auto\b|indirect auto", "auto"), (r"^lease financing|^leases\b|^direct financing lease", "lease"),
    ),
)
VINTAGE_CAPTION = r"origination year|year of origination|\bvintage\b"
VINTAGE_YEAR = r"^(20[0-2]\d)(\s*\(\d+\))?$"
VINTAGE_GRADES = ((r"^pass\b", "pass"), (r"^(special mention|substandard|doubtful|loss|criticized|classified|nonperforming|non-performing|nonaccrual)\b", "criticized"))
VINTAGE_KEPT, VINTAGE_YEARS = 5, range(2000, 2030)


def _tables(text: str) -> list[Table]:
    out: list[Table] = []
    for line in text.strip().splitlines():
        head, _, rest = line.partition(": ")
        if line.startswith(" "):
            last = out.pop()
            out.append(Table(last.name, last.signals, (*last.rows, (rest, head.strip())), last.refuse, last.least))
        else:
            name, least = head.split()
            out.append(Table(name, tuple(s.strip().replace("(", r"\(").replace(")", r"\)") for s in rest.split(";")), (), SKIP_TABLE, int(least)))
    return out


TABLES = _tables(_FILINGS)


def new_columns() -> list[str]:
    """Columns that only documents fill, so that a panel may take them: the delinquency grid's (but the
    whole book's, which a panel has) and the vintage table's."""
    by_class = [f"{stem}_{row}" for row in dict.fromkeys(r for _, r in AGING.rows) if row != "total" for stem in dict.fromkeys(c for _, c in AGING.columns)]
    return by_class + [f"vintage_{kind}_{year}" for year in VINTAGE_YEARS for kind in ("total", "criticized")]
