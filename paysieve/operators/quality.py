"""Data-quality counts on silver (our extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The states a payment can be in.
STATUSES = ["captured", "failed", "refunded"]


def silver_report(silver: DataFrame) -> DataFrame:
    """One row of counts.

    All but one are a single pass that shuffles a few numbers.  Repeated ids
    need a shuffle, of the ids alone; repeats are combined before it.
    """
    per_id = silver.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    surplus = per_id.where(F.col("event_id").isNotNull()).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))
    known_status = F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))
    counts = silver.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("event_id").isNull()).alias("null_event_id"),
        F.count_if(F.col("user_id").isNull()).alias("null_user_id"),
        F.count_if(F.col("event_ts").isNull()).alias("null_event_ts"),
        F.count_if(F.col("amount").isNull() | F.isnan("amount")).alias("null_amount"),
        F.count_if(F.col("amount") < 0).alias("negative_amount"),
        F.count_if(F.col("amount") == 0).alias("zero_amount"),
        F.count_if(~known_status).alias("unknown_status"),
    )
    return counts.withColumn("repeated_event_id", surplus.scalar())
