"""Schemas, domains and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to agree).
# --------------------------------------------------------------------------
STAGE_PROSPECTING = "Prospecting"
STAGE_ENGAGING = "Engaging"
STAGE_WON = "Won"
STAGE_LOST = "Lost"
STAGES = (STAGE_PROSPECTING, STAGE_ENGAGING, STAGE_WON, STAGE_LOST)
CLOSED_STAGES = (STAGE_WON, STAGE_LOST)
OPEN_STAGES = (STAGE_PROSPECTING, STAGE_ENGAGING)

# Spelling fixes applied before the dimension joins.
PRODUCT_RECODES = {"GTXPro": "GTX Pro"}
SECTOR_RECODES = {"technolgy": "technology"}

# Funnel transitions: (order, label, denominator count, numerator count).
FUNNEL_STEPS = (
    (1, "Prospecting → Engaging/reached", "total", "reached"),
    (2, "Engaging/reached → Closed", "reached", "closed"),
    (3, "Engaging/reached → Won", "reached", "won"),
    (4, "Closed → Won", "closed", "won"),
)
FUNNEL_COUNT_LABELS = ("All opportunities", "Reached Engaging", "Closed", "Won")

# Cycle bands: upper edges in days and labels (en dash).
CYCLE_EDGES = (30, 60, 90, 120)
CYCLE_LABELS = ("0–30 days", "31–60 days", "61–90 days", "91–120 days", "121+ days")

ATTRITION_POINT = "Post-engagement / close decision"
ATTRITION_INTERPRETATION = (
    "The source has no full stage-event log; all closed losses have an engage_date, "
    "so attrition can only be located after engagement rather than assigned to "
    "invented intermediate stages.")

STALL_THRESHOLD = 2.0
STALL_QUANTILE = 0.75
STALL_RULE_TEXT = "2× product+region P75 duration rule"
STALL_RULE = "Engaging days >= 2.0 × historical product+region P75 close-cycle duration"

RISK_PROPENSITY_WEIGHT = 0.65
RISK_STALL_WEIGHT = 0.35
RISK_RATIO_CAP = 4.0
DECISION_THRESHOLD = 0.5
MIN_REP_SUPPORT = 25
TOP_RISK_N = 100
TOP_K_CONTRIBUTIONS = 3
SEED = 42
HOLDOUT_FRACTION = 0.25
CV_FOLDS = 5

SEVERITY_WELL_BEYOND = "well beyond"
SEVERITY_ABOVE = "above"
SEVERITY_NEAR = "near"
DEFAULT_REP_TEXT = "the assigned rep"
DEFAULT_PRODUCT_TEXT = "this product"
PROMPT_PREFIX = ("Write exactly one sentence for a sales rep. Be factual, concise, and "
                 "action-oriented. Do not claim causality. Deal facts: ")
RAISES = "raises score"
LOWERS = "lowers score"
MISSING_DISPLAY = "—"

CATEGORICAL_FEATURES = (
    "sales_agent", "product", "manager", "regional_office", "series", "sector",
    "office_location",
)
NUMERIC_FEATURES = (
    "sales_price", "revenue", "employees", "year_established", "account_age",
    "engage_month", "engage_dow",
)
MODEL_FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES
LEAKAGE_FIELDS = ("close_date", "close_value", "deal_stage", "cycle_days", "won")
FEATURE_POLICY = ("Only fields observable by the engaging stage are used; close_date, "
                  "close_value, and final deal_stage are excluded from predictors.")

# --------------------------------------------------------------------------
# Source schemas (explicit; no inference on read).
# --------------------------------------------------------------------------
PIPELINE_SCHEMA = T.StructType([
    T.StructField("opportunity_id", T.StringType()),
    T.StructField("sales_agent", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("deal_stage", T.StringType()),
    T.StructField("engage_date", T.StringType()),
    T.StructField("close_date", T.StringType()),
    T.StructField("close_value", T.StringType()),
])
ACCOUNTS_SCHEMA = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("year_established", T.StringType()),
    T.StructField("revenue", T.StringType()),
    T.StructField("employees", T.StringType()),
    T.StructField("office_location", T.StringType()),
    T.StructField("subsidiary_of", T.StringType()),
])
PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("sales_price", T.StringType()),
])
TEAMS_SCHEMA = T.StructType([
    T.StructField("sales_agent", T.StringType()),
    T.StructField("manager", T.StringType()),
    T.StructField("regional_office", T.StringType()),
])
SOURCE_SCHEMAS = {
    "sales_pipeline": PIPELINE_SCHEMA,
    "accounts": ACCOUNTS_SCHEMA,
    "products": PRODUCTS_SCHEMA,
    "sales_teams": TEAMS_SCHEMA,
}

MART_COLUMNS = (
    "opportunity_id", "sales_agent", "product", "account", "deal_stage", "engage_date",
    "close_date", "close_value", "manager", "regional_office", "series", "sales_price",
    "sector", "year_established", "revenue", "employees", "office_location",
    "subsidiary_of", "is_closed", "won", "cycle_days", "days_in_stage",
)

SCORE_COLUMNS = (
    "opportunity_id", "sales_agent", "manager", "regional_office", "product", "account",
    "deal_stage", "engage_date", "propensity_to_close", "days_in_stage",
    "historical_stage_norm_days", "stall_ratio", "stalled", "risk_score", "deal_summary",
)

CONTRIBUTION_SCHEMA = T.StructType([
    T.StructField("opportunity_id", T.StringType()),
    T.StructField("feature", T.StringType()),
    T.StructField("feature_value", T.StringType()),
    T.StructField("shap_value", T.DoubleType()),
    T.StructField("direction", T.StringType()),
    T.StructField("rank", T.IntegerType()),
])
