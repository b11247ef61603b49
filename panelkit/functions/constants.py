"""Fixed values.

These lists and mappings must equal the behaviour being re-implemented for
results to match; they are stated here once, in their natural order, and used
by name everywhere else.
"""

# --- fixed values -----------------------------------------------------------

# Indicator code -> panel column name (wide-by-year indicator tables).
INDICATOR_CODES = {
    "NY.GDP.PCAP.KD": "gdp_per_capita",
    "NY.GDP.PCAP.CD": "gdp_per_capita_current",
    "NE.TRD.GNFS.ZS": "trade_openness",
    "TG.VAL.TOTL.GD.ZS": "trade_gdp_ratio",
    "SE.XPD.TOTL.GD.ZS": "education_expenditure",
    "SE.PRM.ENRR": "primary_enrollment",
    "SE.SEC.ENRR": "secondary_enrollment",
    "IT.NET.USER.ZS": "internet_users",
    "IT.NET.BBND.P2": "internet_broadband",
    "EG.USE.PCAP.KG.OE": "energy_use_per_capita",
    "EG.USE.ELEC.KH.PC": "electricity_use_per_capita",
    "SH.XPD.CHEX.GD.ZS": "health_expenditure",
    "SH.XPD.CHEX.PC.CD": "health_expenditure_per_capita",
    "GC.TAX.TOTL.GD.ZS": "tax_revenue",
    "GC.REV.XGRT.GD.ZS": "government_revenue",
}

# Priority features kept through sparse-column removal and ranked first in
# feature selection.
PRIORITY_FEATURES = [
    "gdp_per_capita", "gdp_per_capita_current",
    "trade_openness", "trade_gdp_ratio",
    "education_expenditure", "primary_enrollment", "secondary_enrollment",
    "internet_users", "internet_broadband",
    "energy_use_per_capita", "electricity_use_per_capita",
    "health_expenditure", "health_expenditure_per_capita",
    "tax_revenue", "government_revenue",
    "military_expenditure",
]

# Name prefixes of merged indicator columns (exempt from invalid-row and
# outlier checks).
MERGED_PREFIXES = [
    "gdp_", "trade_", "education_", "internet_", "energy_",
    "electricity_", "health_", "tax_", "government_", "military_",
    "primary_", "secondary_",
]

# Text values that make a row invalid.
INVALID_TOKENS = [
    "", "NULL", "null", "None", "N/A", "n/a", "NA", "na",
    "NaN", "nan", "#N/A", "#VALUE!", "#REF!", "-", "--",
]

# Text values turned into NULL by text cleaning.
NULL_TOKENS = ["nan", "None", "none", "NULL", "null"]

# Target tokens (upper-cased, stripped) -> class.
VOTE_MAP = {
    "Y": 1, "YES": 1, "1": 1,
    "N": 0, "NO": 0, "0": 0,
    "A": 0, "ABSTAIN": 0,
    "X": 0, "NON-VOTING": 0, "NON_VOTING": 0,
}

# Column-name substrings dropped as irrelevant, and names always kept.
DROP_PATTERNS = [
    "link", "url", "id", "undl_id", "undl_link", "description",
    "title", "agenda_title", "committee_report", "draft",
]
KEEP_COLUMNS = ["vote", "year", "ms_code", "country_code", "ms_name", "country"]

# Default topic filter patterns (case-insensitive substrings).
TOPIC_PATTERNS = [
    "Security", "Human Rights", "Human rights", "SECURITY",
    "HUMAN RIGHTS", "Peacekeeping", "PEACEKEEPING",
]

# Wide-by-indicator fallback: keywords of indicator columns to keep.
WIDE_KEYWORDS = ["GDP", "TRADE", "EDUCATION", "INTERNET", "ENERGY", "HEALTH", "TAX"]

# Role candidates, in resolution order.
ENTITY_CODE_CANDIDATES = ["ms_code", "country_code", "iso3", "iso_code", "Country Code", "country"]
ENTITY_NAME_CANDIDATES = ["ms_name", "country_name", "Country Name", "country"]
TARGET_CANDIDATES = ["vote", "votes", "yes_no", "voting", "ms_vote"]
TOPIC_CANDIDATES = ["subjects", "topic", "title", "agenda_title", "issue", "category"]
CODE_STANDARDIZE_CANDIDATES = ["country_code", "ms_code", "iso3", "iso_code", "country"]
EDA_ENTITY_CANDIDATES = ["ms_code", "country_code", "ms_name", "country"]
EDA_TOPIC_CANDIDATES = ["subjects", "topic", "title", "agenda_title"]
SPENDING_NAME_TERMS = ["country", "code", "iso", "name"]
OUTLIER_EXCLUDE = ["vote", "year", "session"]

# Year range of the panel, and the session -> year offset.
YEAR_MIN, YEAR_MAX = 1990, 2023
SESSION_YEAR_OFFSET = 1945

# Thresholds.
SPARSE_THRESHOLD = 0.3
CONSTANT_THRESHOLD = 0.95
NUMERIC_SHARE = 0.8
IQR_K = 1.5
ZSCORE_THRESHOLD = 3.0
ZSCORE_EPS = 1e-8
NB_STD_EPS = 1e-10
SEED = 42
