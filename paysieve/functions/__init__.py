"""Column expressions."""

from paysieve.functions.rules import NO_REASON, Rule, default_rules, fraud_reason, high_amount, is_fraud, velocity
from paysieve.functions.times import batch_literal, epoch_seconds, new_batch_ts, parse_event_ts

__all__ = [
    "NO_REASON",
    "Rule",
    "batch_literal",
    "default_rules",
    "epoch_seconds",
    "fraud_reason",
    "high_amount",
    "is_fraud",
    "new_batch_ts",
    "parse_event_ts",
    "velocity",
]
