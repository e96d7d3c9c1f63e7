"""Vocabulary of the engine, kept as data so that operators take it as a parameter.

Everything in this module is a fixed value: tag names, word lists, thresholds, weights, column names and
patterns that results have to agree on. Nothing here is computed.
"""

from __future__ import annotations

# --------------------------------------------------------------------------------------------------------
# Filing forms and fiscal periods
# --------------------------------------------------------------------------------------------------------

FORM_PREFIXES = ("10-K", "10-Q", "20-F", "40-F", "6-K")
ANNUAL_FORMS = ("10-K", "20-F", "40-F")
PERIOD_RANK = {"FY": 0, "Q4": 1, "Q3": 2, "Q2": 3, "Q1": 4}
UNRANKED_PERIOD = 9

# --------------------------------------------------------------------------------------------------------
# Canonical fields and the tags that can supply them, best first
# --------------------------------------------------------------------------------------------------------

TAG_ALIASES = {
    "assets_total": ["Assets"],
    "assets_current": ["AssetsCurrent"],
    "liabilities_total": ["Liabilities"],
    "liabilities_current": ["LiabilitiesCurrent"],
    "equity": [
        "StockholdersEquity",
        "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
        "PartnersCapital",
        "MembersEquity",
    ],
    "retained_earnings": ["RetainedEarningsAccumulatedDeficit", "RetainedEarnings"],
    "net_income": [
        "NetIncomeLoss",
        "NetIncomeLossAvailableToCommonStockholdersBasic",
        "ProfitLoss",
        "IncomeLossFromContinuingOperations",
    ],
    "revenue": [
        "Revenues",
        "RevenueFromContractWithCustomerExcludingAssessedTax",
        "RevenueFromContractWithCustomerIncludingAssessedTax",
        "SalesRevenueNet",
        "SalesRevenueGoodsNet",
        "RevenuesNetOfInterestExpense",
    ],
    "operating_income": [
        "OperatingIncomeLoss",
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesMinorityInterestAndIncomeLossFromEquityMethodInvestments",
    ],
    "interest_expense": [
        "InterestExpense",
        "InterestExpenseDebt",
        "InterestAndDebtExpense",
        "InterestExpenseRelatedParty",
    ],
    "cash": [
        "CashAndCashEquivalentsAtCarryingValue",
        "CashCashEquivalentsAndShortTermInvestments",
        "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents",
        "Cash",
    ],
    "long_term_debt": [
        "LongTermDebt",
        "LongTermDebtNoncurrent",
        "LongTermNotesPayable",
        "LongTermDebtAndCapitalLeaseObligations",
    ],
}
FACT_FIELDS = list(TAG_ALIASES)

META_COLUMNS = ["company_name", "period_end", "fiscal_year", "fiscal_period", "form_type", "filed_date"]
SILVER_COLUMNS = ["cik", *META_COLUMNS, *FACT_FIELDS, "ebit", "working_capital"]

RAW_FACT_SCHEMA = (
    "cik BIGINT, company_name STRING, period_end STRING, fiscal_year INT, fiscal_period STRING, "
    "form_type STRING, filed_date STRING, field STRING, value DOUBLE"
)
SILVER_SCHEMA = (
    "cik BIGINT, company_name STRING, period_end DATE, fiscal_year INT, fiscal_period STRING, "
    "form_type STRING, filed_date DATE, "
    + ", ".join(f"{name} DOUBLE" for name in [*FACT_FIELDS, "ebit", "working_capital"])
)

# --------------------------------------------------------------------------------------------------------
# Score weights, bounds and zones
# --------------------------------------------------------------------------------------------------------

Z_WEIGHTS = {
    "x1_wc_to_assets": 0.717,
    "x2_re_to_assets": 0.847,
    "x3_ebit_to_assets": 3.107,
    "x4_equity_to_liab": 0.420,
    "x5_rev_to_assets": 0.998,
}
Z_LIMIT = 20.0
Z_DISTRESS_BELOW = 1.23
Z_GREY_UP_TO = 2.90
Z_SAFE_AT = 5.0

NEUTRAL = 0.50
COMPOSITE_WEIGHTS = {"z_component": 0.60, "llm_component": 0.20, "trend_component": 0.20}
COMPOSITE_DISTRESS_ABOVE = 0.60
COMPOSITE_SAFE_BELOW = 0.35

SIGNAL_WEIGHTS = {"sentiment": 0.40, "risk": 0.30, "flags": 0.30}
RISK_POINTS = {"low": 0, "medium": 33, "high": 67, "critical": 100}  # hundredths
UNKNOWN_RISK_POINTS = 33
FLAG_WEIGHTS = {
    "going_concern": 0.35,
    "going_concern_explicit": 0.25,
    "liquidity_risk": 0.20,
    "covenant_breach_mentioned": 0.10,
    "restructuring": 0.10,
}
RISK_LABEL_BELOW = [(0.2, "low"), (0.5, "medium"), (0.85, "high")]
TOP_RISK_LABEL = "critical"

TREND_WEIGHTS = {
    "revenue_declining_3q": 0.40,
    "net_income_declining_3q": 0.30,
    "revenue_growth_qoq": 0.20,
    "net_income_growth_qoq": 0.10,
}
TREND_DROP_BELOW = {"revenue_growth_qoq": -0.10, "net_income_growth_qoq": -0.15}

OUTCOME_PATTERNS = [
    ("liquidated", r"liquidat"),
    ("acquired", r"acqui|purchas|merger|sold|sale|absorbed"),
    ("refiled", r"second[^\n]{0,10}bankrupt|refil"),
    ("survived", r"emerged|operating|surviv|continu|still|independent"),
]

# --------------------------------------------------------------------------------------------------------
# Text vocabulary
# --------------------------------------------------------------------------------------------------------

SECTIONS = ["mda", "risk", "business"]

DISTRESS_TERMS = [
    "going concern", "bankruptcy", "default", "insolvency", "insolvent",
    "restructuring", "debt covenant", "covenant violation", "liquidity risk",
    "unable to repay", "material doubt", "substantial doubt", "delisting",
    "impairment", "write-off", "write-down", "negative working capital",
    "cash burn", "runway", "forbearance", "receivership", "chapter 11",
    "chapter 7", "administration", "wind down", "wind-down", "cessation",
    "going-concern", "noncompliance", "breach of covenant", "waiver",
]
POSITIVE_TERMS = [
    "record revenue", "strong growth", "exceeded expectations", "profitability",
    "cash flow positive", "expanding", "growth momentum", "robust demand",
    "market leadership", "cost reduction", "efficiency gains",
]
FLAG_TERMS = {
    "going_concern": ["going concern", "going-concern", "substantial doubt", "material doubt"],
    "liquidity_risk": ["liquidity", "cash covenant", "covenant", "cash burn", "unable to repay"],
    "restructuring": [
        "restructuring", "layoff", "reduction in force", "rif", "asset sale", "divestiture",
    ],
}

# The characters a Unicode-aware `strip` removes, once as a plain string and once as a regex class that
# java.util.regex and RE2 both read the same way.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

SECTION_STARTS = {
    "mda": [rf"item[{WS}]*7[.{WS}]*management[^\n]{{0,60}}discussion", rf"item[{WS}]*7[.{WS}]*md&a"],
    "risk": [rf"item[{WS}]*1a[.{WS}]*risk[{WS}]*factor"],
    "business": [rf"item[{WS}]*1[.{WS}]*business"],
}
SECTION_ENDS = {
    "mda": [rf"item[{WS}]*7a", rf"item[{WS}]*8[.{WS}]*financial"],
    "risk": [rf"item[{WS}]*1b", rf"item[{WS}]*2[.{WS}]"],
    "business": [rf"item[{WS}]*1a", rf"item[{WS}]*2[.{WS}]"],
}
SECTION_HEADING_CHARS = 50  # an end heading is searched only past the start heading

# --------------------------------------------------------------------------------------------------------
# Fields of a scorer's response
# --------------------------------------------------------------------------------------------------------

SENTIMENT_LABELS = ["negative", "neutral", "positive"]
RISK_LEVELS = ["low", "medium", "high", "critical"]

# section -> enum field -> (choices, default)
RESPONSE_ENUMS = {
    "mda": {
        "management_tone": (["evasive", "cautious", "neutral", "confident", "optimistic"], "neutral"),
        "liquidity_signal": (["critical", "stressed", "adequate", "strong"], "adequate"),
    },
    "risk": {
        "risk_level": (RISK_LEVELS, "medium"),
        "severity_language": (["speculative", "possible", "probable", "certain"], "possible"),
        "top_risk_category": (
            ["liquidity", "debt_maturity", "market", "operational", "legal", "regulatory",
             "competitive", "macro", "other"],
            "other",
        ),
    },
    "business": {
        "business_model_viability": (["strong", "adequate", "fragile", "critical"], "adequate"),
        "competitive_position": (["dominant", "strong", "adequate", "weak", "deteriorating"], "adequate"),
    },
}
RESPONSE_FLAGS = {
    "mda": [
        "going_concern_explicit", "covenant_breach_mentioned", "debt_restructuring_mentioned",
        "cash_burn_mentioned",
    ],
    "risk": [
        "liquidity_risk_disclosed", "going_concern_risk_disclosed", "debt_maturity_risk",
        "customer_concentration_risk", "covenant_violation_risk",
    ],
    "business": [
        "revenue_concentration_risk", "high_capex_or_debt_dependent", "regulatory_dependency",
    ],
}
# section -> (field the risk level is read from, value -> level, value assumed when absent)
DERIVED_RISK = {
    "mda": (
        "liquidity_signal",
        {"critical": "critical", "stressed": "high", "adequate": "medium", "strong": "low"},
    ),
    "business": (
        "business_model_viability",
        {"critical": "critical", "fragile": "high", "adequate": "medium", "strong": "low"},
    ),
}
SENTIMENT_NEGATIVE_UP_TO = -0.2
SENTIMENT_POSITIVE_FROM = 0.2
SKIPPED = "skipped"
TEXT_KEY = ["cik", "accession", "section"]

# --------------------------------------------------------------------------------------------------------
# Company universe
# --------------------------------------------------------------------------------------------------------

CASE_CHAPTER = 11
CASE_MIN_YEAR = 2010
CASE_MIN_ASSETS_M = 500.0
CONSTITUENT_SOURCE = "sp500"
CASE_SOURCE = "lopucki_brd"

UNIVERSE_ID_COLUMNS = [
    "ticker", "company_name", "cik", "source",
    "distress_label", "distress_event_date", "distress_event_type",
]
# enrichment column -> type it is read back as
ENRICHMENT_TYPES = {
    "brd_chapter": "int",
    "brd_disposition": "string",
    "brd_emerged": "int",
    "brd_days_in_bk": "double",
    "brd_fresh_start": "int",
    "brd_refiled": "int",
    "brd_dip_loan": "int",
    "brd_sale_363": "int",
    "brd_prepackaged": "int",
    "brd_voluntary": "int",
    "brd_ceo_replaced": "int",
    "brd_trustee_appointed": "int",
    "brd_assets_before_m": "double",
    "brd_sales_before_m": "double",
    "brd_ebit_before_m": "double",
    "brd_sic_description": "string",
    "brd_sic_division": "string",
    "brd_after_emerging": "string",
    "brd_date_emerging": "string",
    "brd_year_emerged": "int",
    "brd_days_emerge_to_refile": "double",
    "brd_name_emerging": "string",
    "brd_assets_emerging_m": "double",
    "brd_sales_emerging_m": "double",
    "brd_ebit_emerging_m": "double",
    "brd_ebitda_emerging_m": "double",
    "brd_net_income_emerging_m": "double",
}
UNIVERSE_COLUMNS = [*UNIVERSE_ID_COLUMNS, *ENRICHMENT_TYPES]

DEFAULT_TRUE = ["yes", "y", "true", "1", "replaced", "refiled"]
# flag column -> (case-file column, values that mean 1, value assumed when the column is absent)
CASE_FLAGS = {
    "brd_emerged": ("Emerge", DEFAULT_TRUE, "no"),
    "brd_fresh_start": ("FreshStartAccounting", DEFAULT_TRUE, "no"),
    "brd_refiled": ("Refile", ["refiled", "yes"], "no"),
    "brd_dip_loan": ("DipLoan", DEFAULT_TRUE, "no"),
    "brd_sale_363": ("Sale363", DEFAULT_TRUE, "no"),
    "brd_prepackaged": ("Prepackaged", ["yes", "prepackaged", "pre-packaged", "prenegotiated"], "no"),
    "brd_voluntary": ("Voluntary", ["voluntary"], "voluntary"),
    "brd_ceo_replaced": ("CeoReplaced", ["replaced"], "noreplace"),
    "brd_trustee_appointed": ("Trustee", DEFAULT_TRUE, "no"),
}
CASE_MEASURES = {
    "brd_days_in_bk": "DaysIn",
    "brd_assets_before_m": "AssetsBefore",
    "brd_sales_before_m": "SalesBefore",
    "brd_ebit_before_m": "EbitBefore",
    "brd_year_emerged": "YearEmerged",
    "brd_days_emerge_to_refile": "DaysEmergeToRefile",
    "brd_assets_emerging_m": "AssetsEmerging",
    "brd_sales_emerging_m": "SalesEmerging",
    "brd_ebit_emerging_m": "EbitEmerging",
    "brd_ebitda_emerging_m": "EbitdaEmerging",
    "brd_net_income_emerging_m": "NetIncomeEmerging",
}
CASE_TEXTS = {
    "brd_sic_description": "SICDescription",
    "brd_sic_division": "SICDivision",
    "brd_after_emerging": "AfterEmerging",
    "brd_name_emerging": "NameEmerging",
}
CASE_COLUMNS = [
    "NameCorp", "CikBefore", "Chapter", "DateFiled", "YearFiled", "Disposition", "DateEmerging",
    *[source for source, _, _ in CASE_FLAGS.values()], *CASE_MEASURES.values(), *CASE_TEXTS.values(),
]
DISPOSITIONS = [
    ("emerged", ["emerged", "plan confirmed"]),
    ("liquidated", ["liquidat", "chapter 7"]),
    ("converted", ["converted"]),
    ("dismissed", ["dismissed"]),
    ("363_sale", ["sold", "363 sale"]),
    ("pending", ["pending"]),
]
OTHER_DISPOSITION = "other"

# --------------------------------------------------------------------------------------------------------
# reports
# --------------------------------------------------------------------------------------------------------

GROUP_NAMES = {1: "Distressed (LoPucki)", 0: "Healthy (S&P 500)"}
SHORT_GROUP_NAMES = {1: "Distressed", 0: "Healthy"}
FRESH_DAYS = 7
Z_BINS = 80
COMPOSITE_BINS = 60
TOP_COMPANIES = 100
EXPLORER_COLUMNS = [
    "cik", "company_name", "period_end", "form_type", "altman_z_score", "distress_zone",
    *Z_WEIGHTS,
    "revenue_growth_qoq", "net_income_growth_qoq", "revenue_declining_3q", "net_income_declining_3q",
    "distress_label",
]
