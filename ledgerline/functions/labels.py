"""Fixed values the models must reproduce exactly (labels, lists, thresholds)."""

# --- fixed values: country codes of the location hierarchy -------------------
COUNTRY_ISO2 = {"Brazil": "BR", "Argentina": "AR", "Mexico": "MX", "Colombia": "CO"}

# --- fixed values: weekday / month names -------------------------------------
WEEKEND_DAYS = ["Saturday", "Sunday"]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# --- fixed values: southern-hemisphere seasons by month number ---------------
SUMMER_MONTHS = [12, 1, 2]
AUTUMN_MONTHS = [3, 4, 5]
WINTER_MONTHS = [6, 7, 8]

# --- fixed values: transaction size classes (upper bounds, exclusive) --------
SIZE_CLASSES = [(100, "micro"), (1000, "small"), (10000, "medium"), (100000, "large")]
SIZE_CLASS_ELSE = "enterprise"
LARGE_TRANSACTION_MIN = 1000

# --- fixed values: account dimension ------------------------------------------
AGE_SEGMENTS = [
    (30, "New (< 30 days)"),
    (90, "Recent (30-90 days)"),
    (365, "Established (3-12 months)"),
]
AGE_SEGMENT_ELSE = "Mature (> 1 year)"
ACTIVITY_SEGMENTS = [(0, "Inactive"), (10, "Low Activity"), (50, "Medium Activity")]
ACTIVITY_SEGMENT_ELSE = "High Activity"
VALUE_TIERS = [(1000, "Low Value"), (10000, "Medium Value"), (100000, "High Value")]
VALUE_TIER_ZERO = "No Value"
VALUE_TIER_ELSE = "Premium Value"
RECENT_ACTIVITY_DAYS = 30
NEW_ACCOUNT_DAYS = 30

# --- fixed values: monthly balances -------------------------------------------
HIGH_ACTIVITY_MIN_TRANSACTIONS = 10
ACTIVITY_LEVELS = [(0, "No Activity"), (5, "Low Activity"), (20, "Medium Activity")]
ACTIVITY_LEVEL_ELSE = "High Activity"
CHANNEL_NONE = "No Activity"
CHANNEL_PIX = "PIX Preferred"
CHANNEL_TRANSFER = "Transfer Preferred"
CHANNEL_MIXED = "Mixed Usage"

# --- fixed values: customer dimension and segmentation ------------------------
NAME_LONG_OVER = 30
NAME_MEDIUM_OVER = 15
CPF_LENGTH = 11
DOMESTIC_COUNTRIES = ["BRAZIL", "BRASIL"]
TIER1_CITIES = [
    "SÃO PAULO", "SAO PAULO", "RIO DE JANEIRO", "BRASÍLIA", "BRASILIA",
    "BELO HORIZONTE", "SALVADOR", "FORTALEZA", "RECIFE", "PORTO ALEGRE",
]

# --- fixed values: transaction direction labels ---------------------------------
# What staging produces (intent) ...
DIRECTION_IN = "in"
DIRECTION_OUT = "out"
# ... and the labels two models actually compare against (always-false filters).
SUMMARY_LITERAL_IN = "TRANSFER_IN"
SUMMARY_LITERAL_OUT = "TRANSFER_out"
FACT_LITERAL_IN = "TRANSFER_IN"
FACT_LITERAL_OUT = "TRANSFER_OUT"

# --- fixed values: data-quality bindings ----------------------------------------
RANGE_MIN = 0.01
RANGE_MAX = 1000000
RANGE_WARN_OVER = 0
RANGE_ERROR_OVER = 50
FRESHNESS_HOURS = {"high_frequency": 4, "medium_frequency": 24}
TABLE_CLASSES = {
    "high_frequency": ["pix_movements", "transfer_ins", "transfer_outs"],
    "medium_frequency": ["accounts", "customers"],
    "low_frequency": ["city", "country", "state", "d_time", "d_month", "d_week", "d_weekday", "d_year"],
}
