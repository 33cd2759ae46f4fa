"""Fixed values of the credit warehouse: anchor date, limits, code tables."""

import datetime

# The results depend on them.
ANCHOR_DATE = datetime.date(2025, 10, 1)
DAY_LIMIT = 36500
DAYS_PER_MONTH = 30
DAYS_PER_YEAR = 365
RECENT_FROM_MONTH = -3
SEVERE_FROM = 3
SEVERITY_LEVELS = 6
DECIMAL_PLACES = 4

# Monthly status code -> label.
STATUS_LABELS = {
    "C": "Closed",
    "X": "Unknown",
    "0": "No DPD",
    "1": "DPD 1-30 days",
    "2": "DPD 31-60 days",
    "3": "DPD 61-90 days",
    "4": "DPD 91-120 days",
    "5": "DPD > 120 days",
}

# Status label -> severity number.
SEVERITY = {
    "Closed": 0,
    "Unknown": 0,
    "No DPD": 0,
    "DPD 1-30 days": 1,
    "DPD 31-60 days": 2,
    "DPD 61-90 days": 3,
    "DPD 91-120 days": 4,
    "DPD > 120 days": 5,
}

# The older table, in which "DPD 1-30 days" has no severity
# because its entry still carries the raw code.
LEGACY_SEVERITY = {
    "Closed": 0,
    "Unknown": 0,
    "No DPD": 0,
    "1": 1,
    "DPD 31-60 days": 2,
    "DPD 61-90 days": 3,
    "DPD 91-120 days": 4,
    "DPD > 120 days": 5,
}

# Insurance flag -> label.
INSURED_LABELS = {0: "Not Insured", 1: "Insured"}

# The labels of the target.
RISK_LABEL = "Default (Risk)"
NO_RISK_LABEL = "Good (No Risk)"

# Source files, one bronze table each.
SOURCE_FILES = (
    "application_test.csv",
    "application_train.csv",
    "bureau.csv",
    "bureau_balance.csv",
    "credit_card_balance.csv",
    "installments_payments.csv",
    "previous_application.csv",
    "POS_CASH_balance.csv",
)

# Column types of the source files. The first rule that fits the lower-case
# column decides (`*` is any text); a column that no rule covers is inferred.
SOURCE_TYPES = (
    ("target", "int"),
    ("sk_id_*", "bigint"),
    ("sk_dpd*", "int"),
    ("months_balance", "int"),
    ("status", "string"),
    ("days_birth", "int"),
    ("days_employed", "int"),
    ("days_id_publish", "int"),
    ("days_credit", "int"),
    ("days_credit_update", "int"),
    ("days_decision", "int"),
    ("days_*", "double"),
    ("amt_credit_limit_actual", "bigint"),
    ("amt_*", "double"),
    ("rate_*", "double"),
    ("ext_source_*", "double"),
    ("obs_*", "double"),
    ("def_*", "double"),
    ("own_car_age", "double"),
    ("region_population_relative", "double"),
    ("region_rating_*", "int"),
    ("reg_*", "int"),
    ("live_*", "int"),
    ("cnt_children", "int"),
    ("cnt_credit_prolong", "int"),
    ("cnt_drawings_current", "int"),
    ("cnt_*", "double"),
    ("credit_day_overdue", "int"),
    ("credit_*", "string"),
    ("flag_own_*", "string"),
    ("flag_last_appl_per_contract", "string"),
    ("flag_*", "int"),
    ("nflag_last_appl_in_day", "int"),
    ("nflag_insured_on_approval", "double"),
    ("num_instalment_version", "double"),
    ("num_instalment_number", "int"),
    ("hour_appr_process_start", "int"),
    ("sellerplace_area", "int"),
    ("housetype_mode", "string"),
    ("emergencystate_mode", "string"),
    ("fondkapremont_mode", "string"),
    ("wallsmaterial_mode", "string"),
    ("*_avg", "double"),
    ("*_mode", "double"),
    ("*_medi", "double"),
    ("name_*", "string"),
    ("code_*", "string"),
    ("weekday_*", "string"),
    ("organization_type", "string"),
    ("occupation_type", "string"),
    ("channel_type", "string"),
    ("product_combination", "string"),
)
