"""Payments derived from the driver's ``events`` table.

Raw events never trip the rules.  Amounts are multiplied by 100 and time runs
1,440 times faster from 2024-01-01 on, so that the default thresholds give all
three outcomes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve.config import JdbcTarget
from paysieve.schemas import BLACKLIST

# Lists an event number is mapped into, and the time origin.
MERCHANTS = ["amazon", "netflix", "apple", "unknown_shop", "crypto_exchange"]
METHODS = ["card", "wallet", "bank_transfer"]
ORIGIN_MICROS = 1704067200000000
SPEEDUP = 1440
AMOUNT_FACTOR = 100

# The two seed rows of the blacklist.
BLACKLIST_SEED = [
    ("user_5", "High chargeback rate", "HIGH"),
    ("user_12", "Suspicious login pattern", "MEDIUM"),
]

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def payments_from_events(events: DataFrame) -> DataFrame:
    """The 11 payment columns with ``event_ts`` as timestamp (UTC session)."""
    return events.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        f"""timestamp_micros({ORIGIN_MICROS}
            + (unix_micros(CAST(ts AS TIMESTAMP)) - {ORIGIN_MICROS}) DIV {SPEEDUP}) AS event_ts""",
        "concat('pay_', event_id) AS payment_id",
        "concat('user_', user_id) AS user_id",
        f"element_at(array({_sql_list(MERCHANTS)}), CAST(event_id % {len(MERCHANTS)} AS INT) + 1) AS merchant_id",
        f"round(value * {AMOUNT_FACTOR}, 2) AS amount",
        "'USD' AS currency",
        f"element_at(array({_sql_list(METHODS)}), CAST(event_id % {len(METHODS)} AS INT) + 1) AS payment_method",
        "concat('192.168.1.', event_id % 254 + 1) AS ip_address",
        "concat('device_', event_id % 50 + 1) AS device_id",
        "CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'refunded' ELSE 'captured' END AS status",
    )


def payments_sql() -> str:
    """The same in DuckDB's dialect."""
    return f"""SELECT CAST(event_id AS VARCHAR) AS event_id,
       make_timestamp({ORIGIN_MICROS} + (epoch_us(ts) - {ORIGIN_MICROS}) // {SPEEDUP}) AS event_ts,
       concat('pay_', event_id) AS payment_id,
       concat('user_', user_id) AS user_id,
       list_extract(list_value({_sql_list(MERCHANTS)}), CAST(event_id % {len(MERCHANTS)} AS INT) + 1) AS merchant_id,
       round(value * {AMOUNT_FACTOR}, 2) AS amount,
       'USD' AS currency,
       list_extract(list_value({_sql_list(METHODS)}), CAST(event_id % {len(METHODS)} AS INT) + 1) AS payment_method,
       concat('192.168.1.', event_id % 254 + 1) AS ip_address,
       concat('device_', event_id % 50 + 1) AS device_id,
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'refunded' ELSE 'captured' END AS status
FROM events"""


def as_landing(payments: DataFrame) -> DataFrame:
    """The rows as they lie in the landing zone: ``event_ts`` as ISO text."""
    return payments.withColumn("event_ts", F.date_format("event_ts", ISO_FORMAT))


def with_busy_user(payments: DataFrame) -> DataFrame:
    """Skewed variant: captured payments (three in five) all belong to one
    user, failed ones to none, and refunded ones have no timestamp."""
    return payments.withColumn(
        "user_id",
        F.when(F.col("status") == "captured", F.lit("user_busy"))
        .when(F.col("status") == "failed", F.lit(None))
        .otherwise(F.col("user_id")),
    ).withColumn("event_ts", F.when(F.col("status") != "refunded", F.col("event_ts")))


def blacklist_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*row, None) for row in BLACKLIST_SEED], BLACKLIST)


def embedded_target(spark: SparkSession, table: str, **extra) -> JdbcTarget:
    """A database inside the driver's process (Derby, part of Spark's jars).

    Only that process sees it, so this serves a local master, where tasks run
    in it too.
    """
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("the embedded database needs a local master; give a JDBC target instead")
    system = spark.sparkContext._jvm.java.lang.System
    if system.getProperty("derby.system.home") is None:
        system.setProperty("derby.system.home", tempfile.mkdtemp(prefix="paysieve-derby-"))
    return JdbcTarget(
        url=f"jdbc:derby:memory:serving_{uuid.uuid4().hex};create=true",
        table=table,
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
        **extra,
    )
