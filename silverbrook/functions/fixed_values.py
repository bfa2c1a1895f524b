"""They must equal the published pipeline's for the results to match."""

# Loyalty tiers, best first, with their rank.
LOYALTY_RANK = {"platinum": 4, "gold": 3, "silver": 2, "bronze": 1}
DEFAULT_LOYALTY_TIER = "bronze"
HIGH_VALUE_RANK = 3

# Lower-inclusive bands: (lower bound, label), highest first, and the label below them all.
POINTS_BANDS = [(10000, "platinum_range"), (5000, "gold_range"), (1000, "silver_range")]
POINTS_BELOW = "bronze_range"
PRICE_BANDS = [(3000, "premium"), (1500, "standard")]
PRICE_BELOW = "economy"
AMOUNT_BANDS = [(10000, "high"), (5000, "medium")]
AMOUNT_BELOW = "low"

# Pickup slots: [start hour, end hour) and label; anything else is evening.
PICKUP_SLOTS = [(0, 6, "late_night"), (6, 12, "morning"), (12, 18, "afternoon")]
PICKUP_SLOT_ELSE = "evening"

UNKNOWN_DOMAIN = "unknown"
ROUTE_ARROW = " → "
CLOCK_PATTERN = r"(\d+):"

# Lookup tables: label to accepted inputs.
COVERAGE = {"full": ["full"], "partial": ["partial"]}
COVERAGE_ELSE = "none"
INSURER_TYPES = {"private_bank": ["HDFC", "ICICI"], "general_insurance": ["TATA AIG"]}
INSURER_ELSE = "other"
CAR_SEGMENTS = {
    "adventure": ["Thar"],
    "suv": ["Creta", "Nexon"],
    "hatchback": ["i20", "Baleno"],
    "compact_suv": ["Venue"],
}
SEGMENT_ELSE = "other"
PAYMENT_METHODS = {
    "credit_card": ["credit card", "credit_card"],
    "debit_card": ["debit card", "debit_card"],
    "upi": ["upi", "gpay", "phonepe"],
    "cash": ["cash", "cod"],
}
DIGITAL_METHODS = ["credit_card", "debit_card", "upi"]

# Right-closed risk bands: (upper bound, label).
RISK_LABELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
FRAUD_BANDS = [(25.0, "LOW"), (50.0, "MEDIUM"), (75.0, "HIGH"), (100.0, "CRITICAL")]
CHURN_BANDS = [(0.3, "LOW"), (0.6, "MEDIUM"), (0.8, "HIGH"), (1.0, "CRITICAL")]

# Gates, limits and verdict thresholds.
DQ_GATE = 80.0
SLA_SECONDS = 600
CHURN_INACTIVE_DAYS = 60
CHURN_RETRAIN_AUC = 0.70
CHURN_GOOD_AUC = 0.80
FRAUD_ALERT_PCT = 30.0
FRAUD_MONITOR_PCT = 15.0
FORECAST_RETRAIN_MAPE = 30.0
FORECAST_GOOD_MAPE = 15.0
QUALITY_GOOD = 90.0
QUALITY_WARN = 70.0
NULL_CRITICAL_PCT = 5.0
LOW_HOUR_SHARE = 0.3

# Health score: points lost per failed stage, failure alert, quality warning and quality point below target.
HEALTH_PER_FAILED_STAGE = 15
HEALTH_PER_FAILURE_ALERT = 10
HEALTH_PER_DQ_WARNING = 5
HEALTH_DQ_TARGET = 90
HEALTH_PER_DQ_POINT = 0.5

# Churn labelling.
CHURN_LOW_TIERS = ["bronze", "new", "silver"]
CHURN_RECENCY_QUANTILE = 0.30
CHURN_LOW_PAYMENT_SHARE = 0.5
UNSEEN_DAYS = 999

# Rule-name prefixes removed for display.
RULE_PREFIXES = ["expect_column_values_to_be_", "expect_column_"]

# Defaults a sparse flat record is filled with before it is published.
FLAT_RECORD_DEFAULTS = {
    "customer_name": "Unknown",
    "model": "Unknown",
    "category": "Unknown",
    "pickup_location": "Unknown",
    "drop_location": "Unknown",
    "return_date": "Unknown",
    "price_per_day": 0.0,
    "rental_days": 1,
    "payment_amount": 0.0,
    "payment_method": "Unknown",
    "loyalty_tier": "silver",
    "insurance_coverage": "none",
    "status": "confirmed",
}

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
