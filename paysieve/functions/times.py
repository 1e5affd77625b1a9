"""Timestamp expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_ts(col: str = "event_ts") -> Column:
    """ISO text to timestamp; NULL where it cannot be parsed (ANSI on or off)."""
    return F.try_to_timestamp(F.col(col))


def epoch_seconds(col: str = "event_ts") -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.col(col).cast("long")


def new_batch_ts() -> datetime:
    return datetime.now(timezone.utc)


def batch_literal(batch_ts: datetime | None) -> Column:
    """The load time as a column.

    Spark fixes ``current_timestamp()`` anew for every action; a literal keeps
    one value for all writes of a run.
    """
    if batch_ts is None:
        return F.current_timestamp()
    if batch_ts.tzinfo is None:
        batch_ts = batch_ts.replace(tzinfo=timezone.utc)
    return F.lit(batch_ts)
