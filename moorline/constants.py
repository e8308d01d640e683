"""Fixed values shared by every operator.

Everything in the "FIXED VALUES" blocks must equal the behaviour being
reproduced (value domains, thresholds, defaults, keyword lists); they are
stated plainly and in their natural order.  Everything else is a parameter.
"""

from __future__ import annotations

import datetime as _dt

# Snapshot used by the staged test views (FIXTURES.md section B).
TEST_SNAPSHOT = _dt.date(2024, 1, 16)

# ---------------------------------------------------------------------------
# FIXED VALUES: windows and thresholds
# ---------------------------------------------------------------------------
FEATURE_LOOKBACK_DAYS = 90          # closed window [snap-90, snap]
RECENT_LOGIN_DAYS = 30              # app_logins_last_30d cut-off
CHURN_WINDOW_DAYS = 60              # forward label window [snap, snap+60]
SALARY_BASELINE_DAYS = 90           # salary baseline [snap-90, snap)
INACTIVITY_GAP_DAYS = 30            # gap that fires app_inactive
TRANSFER_SPAN_DAYS = 30             # rolling span for competitor transfers
TRANSFER_COUNT_LIMIT = 3            # fires when count in span > 3
CHURN_SIGNAL_THRESHOLD = 2          # churned when >= 2 signals
HIGH_RISK_THRESHOLD = 0.70          # batch scoring cut-off
PRECISION_GATE = 0.75               # registration gate
PRECISION_ALERT = 0.72              # production quality alert
RECALL_ALERT = 0.60
DRIFT_THRESHOLD = 0.15
DRIFT_WINDOW_DAYS = 7
ENGAGEMENT_DAYS = 60                # profile engagement look-back
PROFILE_TX_DAYS = 90                # profile transaction look-back

# ---------------------------------------------------------------------------
# FIXED VALUES: value domains
# ---------------------------------------------------------------------------
COMPETITOR_BICS = ["KREDBEBB", "BBRUBEBB", "GKCCBEBB", "GEBABEBB"]
REGIONS = ["Flanders", "Wallonia", "Brussels"]
SEGMENTS = ["student", "starter", "standard", "private_banking"]
PRODUCT_TYPES = [
    "current_account",
    "savings_account",
    "mortgage",
    "consumer_credit",
    "investment",
    "insurance",
]
CHURN_REASONS = [
    "price_sensitivity",
    "service_dissatisfaction",
    "product_lifecycle",
    "inactivity",
    "unknown",
]
QUEUE_STATUSES = ["pending", "approved", "rejected"]
REGISTRY_STATUSES = ["staging", "production", "retired"]

# Sorted category lists used for label encoding; unknown/null fall back to
# "standard" / "Flanders".
SEGMENT_CATEGORIES = ["private_banking", "standard", "starter", "student"]
REGION_CATEGORIES = ["Brussels", "Flanders", "Wallonia"]
SEGMENT_FALLBACK = "standard"
REGION_FALLBACK = "Flanders"

# Model input order.
FEATURE_COLUMNS = [
    "days_since_last_login",
    "competitor_transfer_count",
    "complaints_open",
    "months_to_rate_reset",
    "avg_monthly_inflow_eur",
    "app_logins_last_30d",
    "app_logins_last_90d",
    "salary_account_flag",
    "product_count",
    "nps_score_last",
    "segment_enc",
    "region_enc",
]

# Null fill for model inputs: (default, type).
FEATURE_DEFAULTS = {
    "days_since_last_login": (999, "int"),
    "competitor_transfer_count": (0, "int"),
    "complaints_open": (0, "int"),
    "months_to_rate_reset": (99.0, "double"),
    "avg_monthly_inflow_eur": (0.0, "double"),
    "app_logins_last_30d": (0, "int"),
    "app_logins_last_90d": (0, "int"),
    "salary_account_flag": (0, "int"),
    "product_count": (0, "int"),
    "nps_score_last": (5.0, "double"),
}
# Per-request defaults for the encoded columns (sorted index of the fallback).
ENCODED_DEFAULTS = {"segment_enc": 1, "region_enc": 1}

# The ten monitored features for drift.
DRIFT_FEATURES = FEATURE_COLUMNS[:10]

# ---------------------------------------------------------------------------
# FIXED VALUES: churn-reason normaliser (ordered: first match wins)
# ---------------------------------------------------------------------------
REASON_KEYWORDS = [
    ("service_dissatisfaction", ["complaint", "incident", "nps"]),
    ("product_lifecycle", ["lifecycle", "rate_reset", "rate reset", "mortgage"]),
    ("price_sensitivity", ["price", "competitor", "fee", "salary"]),
    ("inactivity", ["inactiv", "dormant", "dormancy", "disengag", "engagement"]),
]
# SQL migration variant: LIKE patterns per canonical reason, same order.
REASON_LIKE_PATTERNS = [
    ("service_dissatisfaction", ["%complaint%", "%incident%", "%nps%"]),
    ("product_lifecycle", ["%lifecycle%", "%rate%reset%", "%mortgage%"]),
    ("price_sensitivity", ["%price%", "%competitor%", "%fee%", "%salary%"]),
    ("inactivity", ["%inactiv%", "%dormant%", "%dormancy%", "%disengag%", "%engagement%"]),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: text sanitiser (from -> to; empty "to" deletes the char)
# ---------------------------------------------------------------------------
SANITIZE_MAP = [
    ("‘", "'"), ("’", "'"),
    ("“", '"'), ("”", '"'),
    ("–", "-"), ("—", "-"), ("―", "-"),
    (" ", " "),
    ("\x18", "'"), ("\x19", "'"),
    ("\x1c", '"'), ("\x1d", '"'),
    ("\x13", "-"), ("\x14", "-"), ("\x15", ""),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: profile summary sentences
# ---------------------------------------------------------------------------
NO_PRODUCTS_TEXT = "No active products."
NO_SESSIONS_TEXT = "No app sessions in the last 60 days."
NO_COMPLAINTS_TEXT = "No open complaints."
NO_TRANSACTIONS_TEXT = "No transactions in the last 90 days."
PRODUCTS_TEXT = "Active products ({n}): {items}."
RATE_END_NOTE = " (fixed rate ends {date})"
ENGAGEMENT_TEXT = "{n} app session(s) in the last 60 days (avg {avg_min} min). Last login: {last}."
COMPLAINT_TEXT = "{n} open complaint(s). Oldest opened: {oldest}. Category: {category}."
TRANSACTION_TEXT = (
    "{n} transaction(s) in last 90 days. Total inflow: €{inflow}. "
    "Competitor transfers: {competitor}. Last transaction: {last}."
)

# Confidence fallback for the reason stage.
DEFAULT_CONFIDENCE = "medium"
