"""Column lists, enumerations and message texts of the transaction data model.

Everything under "Fixed values" must equal the reference pipeline's behaviour
for results to match; it is stated here once, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the reference behaviour exactly)
# ---------------------------------------------------------------------------

# Validator enumerations.
VALID_TRANSACTION_TYPES = ["purchase", "transfer", "withdrawal", "payment", "refund", "reversal", "fee"]
VALID_TRANSACTION_STATUSES = ["completed", "pending", "failed", "reversed", "flagged", "authorized"]
# Fields that must be present and truthy.
PRESENCE_FIELDS = ["location", "payment_method", "merchant_category", "device_os"]

# Validator messages, in the order they are reported.
MSG_NOT_OBJECT = "Payload is not a dictionary."
MSG_TRANSACTION_ID = "Missing/invalid transaction_id (string)."
MSG_CUSTOMER_ID = "Missing/invalid customer_id (string)."
MSG_AMOUNT = "Missing/invalid amount (number)."
MSG_CURRENCY = "Missing/invalid currency (3-letter string)."
MSG_TIMESTAMP = "Missing/invalid timestamp (ISO 8601 format)."
MSG_IS_FRAUD = "Invalid is_fraud value (must be 0 or 1)."
MSG_TRANSACTION_TYPE = ("Invalid transaction_type (must be one of ['purchase', 'transfer', 'withdrawal', "
                        "'payment', 'refund', 'reversal', 'fee']).")
MSG_TRANSACTION_STATUS = ("Invalid transaction_status (must be one of ['completed', 'pending', 'failed', "
                          "'reversed', 'flagged', 'authorized']).")
MSG_MISSING_FIELD = "Missing field: {}."
REASON_SEPARATOR = "; "
JSON_DECODE_PREFIX = "JSON Decode Error: "

# Dead-letter document constants.
DEAD_LETTER_MESSAGE = "Invalid transaction data"
DEAD_LETTER_SERVICE = "kafka_consumer_validator"
DEAD_LETTER_KIND = "alert"
DEAD_LETTER_CATEGORY = "database"
DEAD_LETTER_ACTION = "data_validation_failed"
DEAD_LETTER_LEVEL = "warning"

# Fraud-rule tags, in the order they are appended.
RULE_HIGH_AMOUNT = "high_amount"                    # amount > 900
RULE_SUSPICIOUS_METHOD = "suspicious_method"        # transfer paid by digital_wallet
RULE_HIGH_FRAUD_SCORE = "high_fraud_score"          # fraud_score > 0.8 (missing -> 0)
RULE_HIGH_RISK_SCORE = "high_risk_score"            # risk_score > 0.8 (missing -> 0)
RULE_VIP_LARGE = "vip_large_transaction"            # vip segment and amount > 500
RULE_OFF_HOURS = "off_hours"                        # hour < 6 or hour > 22 (missing -> 12)

# Processing stage.
PROCESS_DROP_COLUMNS = ["type", "partition", "offset", "key"]
LARGE_TRANSACTION_AMOUNT = 1000
# Columns removed before training (identifiers and leakage).
ML_DROP_COLUMNS = ["transaction_id", "customer_id", "customer_name", "customer_email", "device_id",
                   "ip_address", "merchant_id", "merchant_name", "user_agent", "device_model", "timestamp",
                   "transaction_status", "fraud_rules", "fraud_score", "risk_score"]

# Dimension classifications.
AGE_GROUPS = [("Young Adult", None, 25), ("Adult", 25, 40), ("Middle Age", 41, 60)]  # (None, x): age < x; else Senior
AGE_GROUP_DEFAULT = "Senior"
DEVICE_MOBILE_OS = ["Android", "iOS"]
DEVICE_DESKTOP_OS = ["Windows", "macOS", "Linux"]
CONTINENTS = [("North America", ["US", "CA"]), ("Europe", ["UK", "DE", "FR"]),
              ("Asia", ["JP", "SG", "VN"]), ("Oceania", ["AU"])]  # else Other
MERCHANT_RISK = [("High Risk", ["electronics", "gaming", "financial"]),
                 ("Medium Risk", ["travel", "entertainment"])]  # else Low Risk
PAYMENT_RISK = [("High Risk", ["crypto"]), ("Medium Risk", ["digital_wallet", "bank_transfer"])]  # else Standard Risk
TIME_OF_DAY = [("Night", 0, 5), ("Morning", 6, 11), ("Afternoon", 12, 17)]  # else Evening
WEEKEND_DAYS = ["Saturday", "Sunday"]

# High-water mark used when the target table is empty.
HIGH_WATER_DEFAULT = "1900-01-01 00:00:00"

# ---------------------------------------------------------------------------
# Column lists
# ---------------------------------------------------------------------------

# The 31 columns of the staging projection, in order.
TRANSACTION_COLUMNS = [
    "transaction_id", "amount", "currency", "timestamp", "customer_id", "customer_name", "customer_email",
    "customer_age", "customer_segment", "location", "is_fraud", "transaction_type", "device_id", "device_os",
    "device_model", "ip_address", "merchant_id", "merchant_name", "merchant_category", "user_agent",
    "payment_method", "transaction_status", "latitude", "longitude", "account_balance", "transaction_hour",
    "day_of_week", "risk_score", "fraud_score", "loyalty_points", "fraud_rules",
]

FACT_COLUMNS = [
    "transaction_id", "customer_id", "merchant_id", "device_id", "payment_method_key", "location_key",
    "time_key", "amount", "currency", "is_fraud", "transaction_type", "transaction_status", "risk_score",
    "fraud_score", "account_balance", "loyalty_points", "fraud_rules", "timestamp",
]

# Typed wire record; used to read landed JSON without inference.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("customer_email", T.StringType()),
    T.StructField("customer_age", T.IntegerType()),
    T.StructField("customer_segment", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("is_fraud", T.IntegerType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("device_os", T.StringType()),
    T.StructField("device_model", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("transaction_status", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("account_balance", T.DoubleType()),
    T.StructField("transaction_hour", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("risk_score", T.DoubleType()),
    T.StructField("fraud_score", T.DoubleType()),
    T.StructField("loyalty_points", T.IntegerType()),
    T.StructField("fraud_rules", T.ArrayType(T.StringType())),
])
