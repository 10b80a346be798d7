"""Code -> label dictionaries, in level order.

Everything in this module is fixed: the codes and the texts are part of the
results and must not be edited for style.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------

ORG_CORP_FORM = [
    ("0", "UDC (0)"),
    ("1", "CORPORATION (1)"),
    ("2", "TRUST (2)"),
    ("3", "COOPERATIVE (3)"),
    ("4", "PARTNERSHIP (4)"),
    ("5", "ASSOCIATION (5)"),
    ("6", "UDC (6)"),
]

ORG_FISCAL_PERIOD = [
    ("1", "JAN (01)"),
    ("2", "FEB (02)"),
    ("3", "MAR (03)"),
    ("4", "APR (04)"),
    ("5", "MAY (05)"),
    ("6", "JUN (06)"),
    ("7", "JUL (07)"),
    ("8", "AUG (08)"),
    ("9", "SEP (09)"),
    ("10", "OCT (10)"),
    ("11", "NOV (11)"),
    ("12", "DEC (12)"),
]

# code, label, role, affiliation, description
BMF_AFFILIATION_CODE = [
    (
        "3",
        "INDEPENDENT (3)",
        "INDY",
        "NONE",
        "This code is used if the organization is an independent organization or an independent auxiliary (i.e., not affiliated with a National, Regional, or Geographic grouping of organizations).",
    ),
    (
        "1",
        "NETWORK-PARENT (1)",
        "PARENT",
        "NETWORK",
        "This code is used if the organization is a central type organization (no group exemption) of a National, Regional or Geographic grouping of organizations.",
    ),
    (
        "2",
        "NETWORK-INTERM (2)",
        "INTERMEDIATE",
        "NETWORK",
        "This code is used if the organization is an intermediate organization (no group exemption) of a National, Regional or Geographic grouping of organizations (such as a state headquarters of a national organization).",
    ),
    (
        "6",
        "GROUP-EXM-PARENT-REGULAR (6)",
        "PARENT-REGULAR",
        "GROUP-EXM",
        "This code is used if the organization is a parent (group ruling) and is not a church or 501(c)(1)organization.",
    ),
    (
        "7",
        "GROUP-EXM-INTERM (7)",
        "INTERMEDIATE",
        "GROUP-EXM",
        "This code is used if the organization is a group exemption intermediate organization of a National, Regional or Geographic grouping of organizations.",
    ),
    (
        "8",
        "GROUP-EXM-PARENT-CHURCH (8)",
        "PARENT-CHURCH",
        "GROUP-EXM",
        "This code is used if the organization is a parent (group ruling) and is a church or 501(c)(1) organization.",
    ),
    (
        "9",
        "SUBORDINATE (9)",
        "SUBORDINATE",
        "GROUP-EXM/NETWORK",
        "This code is used if the organization is a subordinate in a group ruling.",
    ),
]

# shared by the asset and the income bands
AMOUNT_LEVEL = [
    ("0", "$0"),
    ("1", "$1 to $10k"),
    ("2", "$10k to $25k"),
    ("3", "$25k to $100k"),
    ("4", "$100k to $500k"),
    ("5", "$500k to $1m"),
    ("6", "$1m to $5m"),
    ("7", "$5m to $10m"),
    ("8", "$10m to $50m"),
    ("9", "$50m +"),
]

# code, label, desc
BMF_DEDUCTIBILITY_CODE = [
    ("0", "UDC (0)", "Undocumented category"),
    ("1", "YES (1)", "Contributions are deductible"),
    ("2", "NO (2)", "Contributions are not deductible"),
    (
        "4",
        "BY TREATY(4)",
        "Contributions are deductible by treaty (foreign organizations)",
    ),
]

# code, label, form
BMF_FILING_REQ_CODE = [
    ("01", "990/990EZ (01)", "990/990-EZ"),
    ("02", "990-N (02)", "990-N"),
    ("PF", "990PF (00+PF={1,2,3})", "990-PF"),
    ("03", "GROUP RETURN (03)", "GROUP RETURN"),
    ("04", "990-BL (04)", "990-BL"),
    ("06", "NRQ: CHURCH (06)", "NOT RQ: CHURCH"),
    ("07", "NRQ: 501C1 GOV (07)", "NOT RQ: 501C1 GOV"),
    ("13", "NOT RQ: RELIG ORG (13)", "NOT RQ: RELIG ORG"),
    ("14", "NOT RQ: STATE DIV (14)", "NOT RQ: STATE DIV"),
    ("00", "NOT RQ: ALL OTHER (00)", "NOT RQ: ALL OTHER"),
    ("11", "Undocumented Category (11)", "UNKNOWN"),
]

# code, label, description
BMF_FOUNDATION_CODE = [
    ("0", "501C_not_3 (0)", "All organizations except 501(c)(3)"),
    (
        "2",
        "priv op foundation (2)",
        "Private operating foundation exempt from paying excise taxes on investment income",
    ),
    (
        "3",
        "priv op foundation (other) (3)",
        "Private operating foundation (other)",
    ),
    ("4", "priv non-op foundation (4)", "Private non-operating foundation"),
    ("9", "status suspended (9)", "Suspense"),
    ("10", "church (10)", "Church 170(b)(1)(A)(i)"),
    ("11", "school (11)", "School 170(b)(1)(A)(ii)"),
    (
        "12",
        "hospital/ med research (12)",
        "Hospital or medical research organization 170(b)(1)(A)(iii)",
    ),
    (
        "13",
        "public university support (13)",
        "Organization that operates for the benefit of a college or university and is owned or operated by a governmental unit 170(b)(1)(A)(iv)",
    ),
    ("14", "governmental unit (14)", "Governmental unit 170(b)(1)(A)(v)"),
    (
        "15",
        "gov or public support (15)",
        "Organization that receives a substantial part of its support from a governmental unit or the general public 170(b)(1)(A)(vi)",
    ),
    (
        "16",
        "one-third investment or ubi (16)",
        "Organization that normally receives no more than one-third of its support from gross investment income and unrelated business income and at the same time more than one-third of its support from contributions, fees, and gross receipts related to exempt purposes 509(a)(2)",
    ),
    (
        "17",
        "subsidiary (17)",
        "Organizations operated solely for the benefit of and in conjunction with organizations described in 10 through 16 above 509(a)(3)",
    ),
    (
        "18",
        "public safety (18)",
        "Organization organized and operated to test for public safety 509(a)(4)",
    ),
    ("21", "supporting org type1 (21)", "509(a)(3) Type I"),
    ("22", "supporting org type2 (22)", "509(a)(3) Type II"),
    (
        "23",
        "supporting org type3 (23)",
        "509(a)(3) Type III functionally integrated",
    ),
    (
        "24",
        "supporting org type3 nfi (24)",
        "509(a)(3) Type III not functionally integrated",
    ),
]

BMF_PF_FILING_REQ_CODE = [
    ("0", "NON-PF (0)"),
    ("1", "OPERATING PF (1)"),
    ("2", "NON-OPERATING PF (2)"),
    ("3", "NON-OPERATING PF (3)"),
]

# code, label, desc
BMF_STATUS_CODE = [
    ("1", "Unconditional Exemption (01)", "Unconditional Exemption"),
    ("2", "Conditional Exemption (02)", "Conditional Exemption"),
    (
        "12",
        "Trust (12)",
        "Trust described in section 4947(a)(2) of the Internal Revenue Code",
    ),
    (
        "25",
        "Split Interest Trust (25)",
        "Organization terminating its private foundation status under section 507(b)(1)(B) of the Code",
    ),
]

# code = <subsection>-<classification digit>, both without padding
BMF_TAX_EXEMPT_PURP = [
    ("1-1", "Government Instrumentality (501C1-1)"),
    ("2-1", "Title-Holding Corporation (501C2-1)"),
    ("3-1", "Charitable Organization (501C3-1)"),
    ("3-2", "Educational Organization (501C3-2)"),
    ("3-3", "Literary Organization (501C3-3)"),
    ("3-4", "Organization to Prevent Cruelty to Animals (501C3-4)"),
    ("3-5", "Organization to Prevent Cruelty to Children (501C3-5)"),
    ("3-6", "Organization for Public Safety Testing (501C3-6)"),
    ("3-7", "Religious Organization (501C3-7)"),
    ("3-8", "Scientific Organization (501C3-8)"),
    ("4-1", "Civic League (501C4-1)"),
    ("4-2", "Local Association of Employees (501C4-2)"),
    ("4-3", "Social Welfare Organization (501C4-3)"),
    ("5-1", "Agricultural Organization (501C5-1)"),
    ("5-2", "Horticultural Organization (501C5-2)"),
    ("5-3", "Labor Organization (501C5-3)"),
    ("6-1", "Board of Trade (501C6-1)"),
    ("6-2", "Business League (501C6-2)"),
    ("6-3", "Chamber of Commerce (501C6-3)"),
    ("6-4", "Real Estate Board (501C6-4)"),
    ("7-1", "Pleasure, Recreational, or Social Club (501C7-1)"),
    ("8-1", "Fraternal Beneficiary Society, Order or Association (501C8-1)"),
    (
        "9-1",
        "Voluntary Employees Beneficiary Association (Non-Govt Emps) (501C9-1)",
    ),
    ("9-2", "Voluntary Employees Beneficiary Association (Govt Emps) (501C9-2)"),
    ("10-1", "Domestic Fraternal Societies and Associations (501C10-1)"),
    ("11-1", "Teachers Retirement Fund Assoc (501C11-1)"),
    ("12-1", "Benevolent Life Insurance Assoc (501C12-1)"),
    ("12-2", "Mutual Ditch or Irrigation Co (501C12-2)"),
    ("12-3", "Mutual Cooperative Telephone Co (501C12-3)"),
    ("12-4", "Organization Like Those on Three Preceding Lines (501C12-4)"),
    ("13-1", "Burial Association (501C13-1)"),
    ("13-2", "Cemetery Company (501C13-2)"),
    ("14-1", "Credit Union (501C14-1)"),
    ("14-2", "Other Mutual Corp or Assoc (501C14-2)"),
    (
        "15-1",
        "Mutual Insurance Company or Assoc Other Than Life or Marine (501C15-1)",
    ),
    ("16-1", "Corp Financing Crop Operations (501C16-1)"),
    ("17-1", "Supplemental Unemployment Compensation Trust or Plan (501C17-1)"),
    ("18-1", "Employee Funded Pension Trust (501C18-1)"),
    ("19-1", "Post or Organization of War Veterans (501C19-1)"),
    ("20-1", "Legal Service Organization (501C20-1)"),
    ("21-1", "Black Lung Trust (501C21-1)"),
    ("22-1", "Multiemployer Pension Plan (501C22-1)"),
    ("23-1", "Veterans Assoc Formed Prior to 1880 (501C23-1)"),
    ("24-1", "Trust Described in Sect 4049 of ERISA (501C24-1)"),
    ("25-1", "Title Holding Co for Pensions etc (501C25-1)"),
    (
        "26-1",
        "State-Sponsored High Risk Health Insurance Organizations (501C26-1)",
    ),
    ("27-1", "State-Sponsored Workers Compensation Reinsurance (501C27-1)"),
    ("29-1", "ACA 1322 Qualified Nonprofit Health Insurance Issuers (501C29-1)"),
    ("40-1", "Apostolic and Religious Org (501(d)) (501C40-1)"),
    ("50-1", "Cooperative Hospital Service Organization (501(e)) (501C50-1)"),
    (
        "60-1",
        "Cooperative Service Organization of Operating Educational Organization (501(f)) (501C60-1)",
    ),
    ("70-1", "Child Care Organization (501(k)) (501C70-1)"),
    ("71-1", "Charitable Risk Pool (501C71-1)"),
    ("81-1", "Qualified State-Sponsored Tuition Program (501C81-1)"),
    ("92-1", "4947(a)(1) - Private Foundation (Form 990PF Filer) (501C92-1)"),
]

NCCS_LEVEL_1 = [
    ("501CX NONPROFIT", "NONPROFIT (501C_not3)"),
    ("501C3 CHARITY", "CHARITY (501C3)"),
    ("501C3 PRIVATE FOUNDATION", "PRIVATE FOUNDATION (501C3-PF)"),
    ("UNDEFINED", "UNDEFINED"),
    ("", None),
]

NCCS_LEVEL_2 = [
    ("O", "OPERATING (O)"),
    ("S", "SUPPORTING (S)"),
    ("M", "MUTUAL/MEMBER (M)"),
    ("", None),
]

NCCS_LEVEL_3 = [
    ("AR", "Arts, culture and humanities(AR)"),
    ("ED", "Education(ED)"),
    ("EN", "Environment/animals(EN)"),
    ("HE", "Health(HE)"),
    ("HS", "Human Services(HS)"),
    ("IN", "International, foreign affairs(IN)"),
    ("MO", "Other mutual benefit(MO)"),
    ("MR", "Pension and retirement funds(MR)"),
    ("PB", "Public, societal benefit(PB)"),
    ("RE", "Religion related(RE)"),
    ("UN", "Unknown, unclassified(UN)"),
    ("ZA", "Single organization support(ZA)"),
    ("ZB", "Fundraising within NTEE major group(ZB)"),
    ("ZC", "Private grantmaking foundations(ZC)"),
    ("ZD", "Public foundations(ZD)"),
    ("ZE", "General fundraising(ZE)"),
    ("ZF", "Other Supporting Public Benefit(ZF)"),
]

# function group of each 501(c) type
EXEMPT_SUBTYPE = [
    ("501C_01", "CORPORATION"),
    ("501C_02", "CORPORATION"),
    ("501C_03", "GENERAL"),
    ("501C_04", "GENERAL"),
    ("501C_05", "SPECIAL INT GRP"),
    ("501C_06", "GENERAL"),
    ("501C_07", "MEMBERSHIP"),
    ("501C_08", "SPECIAL INT GRP"),
    ("501C_09", "INSURANCE"),
    ("501C_10", "MEMBERSHIP"),
    ("501C_11", "PENSION"),
    ("501C_12", "INSURANCE"),
    ("501C_13", "GENERAL"),
    ("501C_14", "COOPERATIVE"),
    ("501C_15", "INSURANCE"),
    ("501C_16", "COOPERATIVE"),
    ("501C_17", "INSURANCE"),
    ("501C_18", "PENSION"),
    ("501C_19", "MEMBERSHIP"),
    ("501C_20", "DEFUNCT"),
    ("501C_21", "INSURANCE"),
    ("501C_22", "PENSION"),
    ("501C_23", "SPECIAL INT GRP"),
    ("501C_24", "DEFUNCT"),
    ("501C_25", "CORPORATION"),
    ("501C_26", "INSURANCE"),
    ("501C_27", "INSURANCE"),
    ("501C_28", "PENSION"),
    ("501C_29", "INSURANCE"),
    ("501C_40", "MEMBERSHIP"),
    ("501C_50", "COOPERATIVE"),
    ("501C_60", "COOPERATIVE"),
    ("501C_70", "GENERAL"),
    ("501C_71", "COOPERATIVE"),
    ("501C_72", "GENERAL"),
    ("501C_80", "COOPERATIVE"),
    ("501C_81", "PENSION"),
]

# subsection codes as listed by the registry's second documentation source
SECOND_SUBSECTION_LIST = [
    ("01", "Corporations originated under Act of Congress, including Federal Credit Unions"),
    ("02", "Title holding corporation for a tax-exempt organization."),
    ("03", "Religious, educational, charitable, scientific, and literary organizations..."),
    ("04", "Civic leagues, social welfare organizations, and local associations of employees"),
    ("05", "Labor, agricultural, horticultural organizations. These are eduactional or instruct. grps..."),
    ("06", "Business leagues, chambers of commerce, real estate boards, etc. formed to improve conditions..."),
    ("07", "Social and recreational clubs which provide pleasure, recreation, and social activities."),
    ("08", "Fraternal beneficiary societies and associations, with lodges providing for payment of life..."),
    ("09", "Voluntary employees' beneficiary ass'ns (including fed. employees' voluntary beneficiary..."),
    ("10", "Domestic fraternal societies and assoc's-lodges devoting their net earnings to charitable..."),
    ("11", "Teachers retirement fund associations."),
    ("12", "Benevolent life insurance associations, mutual ditch or irrigation companies, mutual or coop..."),
    ("13", "Cemetery companies, providing burial and incidental activities for members."),
    ("14", "State-chartered credit unions, mutual reserve funds, offering loans to members..."),
    ("15", "Mutual insurance cos. ar associations, providing insurance to members substantially at cost..."),
    ("16", "Cooperative organizations to finance crop operations, in conjunction with activities ..."),
    ("17", "Supplemental unemployment benefit trusts, providing payments of suppl. unemployment comp..."),
    ("18", "Employee funded pension trusts, providing benefits under a pension plan funded by employees..."),
    ("19", "Post or organization of war veterans."),
    ("20", "Trusts for prepaid group legal services, as part of a qual. group legal service plan or plans."),
    ("21", "Black lung trusts, satisfying claims for compensation under Black Lung Acts."),
    ("22", "Multiemployer Pension Plan"),
    ("23", "Veterans association formed prior to 1880"),
    ("24", "Trust described in Section 4049 of ERISA"),
    ("25", "Title Holding Company for Pensions, etc"),
    ("26", "State-Sponsored High Risk Health Insurance Organizations"),
    ("27", "State-Sponsored Workers Compensation Reinsurance"),
    ("40", "Apostolic and religious orgs. - 501(d)"),
    ("50", "Cooperative Hospital Service Organization - 501(e)"),
    ("60", "Cooperative Service Org. of Operating Educ. Org.- 501(f)"),
    ("70", "Child Care Organization - 501(k)"),
    ("71", "Charitable Risk Pool"),
    ("80", "Farmers' Cooperatives"),
    ("81", "Qualified State-Sponsored Tuition Program"),
    ("82", "527 Political Organizations"),
    ("90", "4947(a)(2) Split Interest Trust"),
    ("91", "4947(a)(1) Public Charity (Files 990/990-EZ)"),
    ("92", "4947(a)(1) Private Foundations"),
    ("93", "1381(a)(2) Taxable Farmers Cooperative"),
    ("CO", "Unspecified 501(c) Organization Other Than 501(c)(3)"),
]

# subsection both lists carry, but for a different kind of organization
SUBSECTION_DIFFERS = ["92"]

# --- end of fixed values ----------------------------------------------------

_COLUMNS = {
    "ORG_CORP_FORM": (ORG_CORP_FORM, ("code", "label")),
    "ORG_FISCAL_PERIOD": (ORG_FISCAL_PERIOD, ("code", "label")),
    "BMF_AFFILIATION_CODE": (
        BMF_AFFILIATION_CODE,
        ("code", "label", "role", "affiliation", "description"),
    ),
    "BMF_ASSET_LEVEL": (AMOUNT_LEVEL, ("code", "label")),
    "BMF_DEDUCTIBILITY_CODE": (BMF_DEDUCTIBILITY_CODE, ("code", "label", "desc")),
    "BMF_FILING_REQ_CODE": (BMF_FILING_REQ_CODE, ("code", "label", "form")),
    "BMF_FOUNDATION_CODE": (BMF_FOUNDATION_CODE, ("code", "label", "description")),
    "BMF_INCOME_LEVEL": (AMOUNT_LEVEL, ("code", "label")),
    "BMF_PF_FILING_REQ_CODE": (BMF_PF_FILING_REQ_CODE, ("code", "label")),
    "BMF_STATUS_CODE": (BMF_STATUS_CODE, ("code", "label", "desc")),
    "BMF_TAX_EXEMPT_PURP": (BMF_TAX_EXEMPT_PURP, ("code", "label")),
    "NCCS_LEVEL_1": (NCCS_LEVEL_1, ("code", "label")),
    "NCCS_LEVEL_2": (NCCS_LEVEL_2, ("code", "label")),
    "NCCS_LEVEL_3": (NCCS_LEVEL_3, ("code", "label")),
}

VARIABLES = list(_COLUMNS)

DICTIONARY_COLUMNS = [
    "variable", "code", "label", "ord",
    "role", "affiliation", "description", "desc", "form",
]

DICTIONARY_SCHEMA = (
    "variable string, code string, label string, ord int, role string, "
    "affiliation string, description string, desc string, form string"
)


def entries(variable: str) -> list[dict]:
    """One dict per level of a variable, in level order."""
    rows, names = _COLUMNS[variable]
    return [dict(zip(names, row)) for row in rows]


def code_labels(variable: str) -> list[tuple[str, str | None]]:
    """(code, label) pairs in level order."""
    return [(e["code"], e["label"]) for e in entries(variable)]


def long_rows(variables: list[str] | None = None) -> list[tuple]:
    """Rows of the long dictionary table, in ``DICTIONARY_COLUMNS`` order."""
    return [
        (variable, e["code"], e["label"], i) + tuple(e.get(c) for c in DICTIONARY_COLUMNS[4:])
        for variable in (variables or VARIABLES)
        for i, e in enumerate(entries(variable), start=1)
    ]
