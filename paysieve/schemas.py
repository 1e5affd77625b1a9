"""Column layouts of the layers."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Field names and types of a landing event, in file order.
PAYMENT_FIELDS = [
    ("event_id", StringType()),
    ("event_ts", StringType()),
    ("payment_id", StringType()),
    ("user_id", StringType()),
    ("merchant_id", StringType()),
    ("amount", DoubleType()),
    ("currency", StringType()),
    ("payment_method", StringType()),
    ("ip_address", StringType()),
    ("device_id", StringType()),
    ("status", StringType()),
]

CORRUPT_COLUMN = "_corrupt_record"


def _struct(fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


LANDING = _struct(PAYMENT_FIELDS)
LANDING_WITH_CORRUPT = _struct([*PAYMENT_FIELDS, (CORRUPT_COLUMN, StringType())])

SILVER = _struct(
    [(n, TimestampType() if n == "event_ts" else t) for n, t in PAYMENT_FIELDS]
    + [("ingest_ts", TimestampType())]
)

GOLD = _struct(
    [(f.name, f.dataType) for f in SILVER]
    + [
        ("tx_count_window", LongType()),
        ("fraud_reason", StringType()),
        ("is_fraud", BooleanType()),
        ("gold_ts", TimestampType()),
    ]
)

GOLD_SERVING_COLUMNS = [
    "event_id",
    "user_id",
    "amount",
    "event_ts",
    "fraud_reason",
    "is_fraud",
    "gold_ts",
]
PREDICTION_SERVING_COLUMNS = ["event_id", "user_id", "prediction"]
FEATURE_COLUMNS = ["amount", "tx_count_window"]

BLACKLIST = _struct(
    [
        ("user_id", StringType()),
        ("reason", StringType()),
        ("severity", StringType()),
        ("added_at", TimestampType()),
    ]
)
