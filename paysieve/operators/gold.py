"""Silver to gold: velocity, rules, serving view."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysieve.config import RuleSettings
from paysieve.functions.rules import Rule, default_rules, fraud_reason, is_fraud
from paysieve.functions.times import batch_literal
from paysieve.operators.velocity import recount, with_velocity
from paysieve.schemas import GOLD_SERVING_COLUMNS


def to_gold(
    silver: DataFrame,
    settings: RuleSettings = RuleSettings(),
    *,
    rules: Sequence[Rule] | None = None,
    batch_ts: datetime | None = None,
) -> DataFrame:
    """Every silver row with its window count, first matching rule and flag."""
    rules = default_rules(settings) if rules is None else rules
    return _judged(with_velocity(silver, settings.velocity_seconds), rules, batch_ts)


def _judged(counted: DataFrame, rules: Sequence[Rule], batch_ts: datetime | None) -> DataFrame:
    return (
        counted.withColumn("fraud_reason", fraud_reason(rules))
        .withColumn("is_fraud", is_fraud())
        .withColumn("gold_ts", batch_literal(batch_ts))
    )


def renewed_gold(
    gold: DataFrame,
    silver: DataFrame,
    changed: DataFrame,
    settings: RuleSettings = RuleSettings(),
    *,
    rules: Sequence[Rule] | None = None,
    batch_ts: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(gold rows that stay, gold rows made anew) after the events of ``changed`` came into silver or changed there.

    ``gold`` was made of silver before that.  What is counted again lies within
    the window's reach of a changed event, where it is now or where gold has it; everything else stays as it is.
    """
    rules = default_rules(settings) if rules is None else rules
    ids = changed.select(F.col("event_id").alias("__changed_id")).distinct()
    before = gold.join(ids, F.col("event_id").eqNullSafe(F.col("__changed_id")), "left_semi")
    touched = changed.select("user_id", "event_ts").unionByName(before.select("user_id", "event_ts"))
    anew = _judged(recount(silver, touched, settings.velocity_seconds), rules, batch_ts)
    replaced = anew.select(F.col("event_id").alias("__anew_id")).distinct()
    stays = gold.join(replaced, F.col("event_id").eqNullSafe(F.col("__anew_id")), "left_anti")
    return stays, anew


def serving_view(gold: DataFrame) -> DataFrame:
    return gold.select(*GOLD_SERVING_COLUMNS)
