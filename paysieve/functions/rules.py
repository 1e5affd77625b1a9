"""Fraud rules as column predicates, first match wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from paysieve.config import RuleSettings

NO_REASON = "NONE"


class Rule(NamedTuple):
    name: str
    predicate: Column


def high_amount(limit: float = 5000, col: str = "amount") -> Column:
    """Strictly above the limit.  NULL never matches; NaN does, as Spark
    orders it above every number."""
    return F.col(col) > limit


def velocity(limit: int = 3, col: str = "tx_count_window") -> Column:
    """Strictly more than ``limit`` transactions in the trailing window."""
    return F.col(col) > limit


def default_rules(settings: RuleSettings = RuleSettings()) -> list[Rule]:
    return [
        Rule("HIGH_AMOUNT", high_amount(settings.amount_limit)),
        Rule("VELOCITY", velocity(settings.velocity_limit)),
    ]


def fraud_reason(rules: Sequence[Rule] | None = None) -> Column:
    """Name of the first rule that matches, else "NONE"."""
    rules = default_rules() if rules is None else rules
    if not rules:
        return F.lit(NO_REASON)
    first, *rest = rules
    chain = reduce(
        lambda col, rule: col.when(rule.predicate, F.lit(rule.name)),
        rest,
        F.when(first.predicate, F.lit(first.name)),
    )
    return chain.otherwise(F.lit(NO_REASON))


def is_fraud(col: str = "fraud_reason") -> Column:
    return F.col(col) != F.lit(NO_REASON)
