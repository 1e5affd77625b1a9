"""Bronze to silver: parse, stamp, one row per event."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paysieve.functions.times import batch_literal, parse_event_ts
from paysieve.schemas import CORRUPT_COLUMN


def dedup(df: DataFrame, *, key: str = "event_id", keep: str = "latest", order: str = "event_ts") -> DataFrame:
    """One row per key; all NULL keys count as one.

    ``any`` keeps an arbitrary row, ``latest`` the one with the greatest
    ``order``, ties settled by the other columns, so that a re-run keeps the
    same row.  Both cut each key down to one row per task before the shuffle,
    so a key with very many copies does not gather them in one place.
    """
    if keep == "any":
        return df.dropDuplicates([key])
    if keep != "latest":
        raise ValueError(f"keep: {keep!r}")
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in (key, order)]
    newest = Window.partitionBy(key).orderBy(F.col(order).desc_nulls_last(), *ties)
    return df.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") == 1).drop("__rank")


def to_silver(bronze: DataFrame, *, batch_ts: datetime | None = None, keep: str = "latest") -> DataFrame:
    """Typed, stamped with the load time and free of repeated events."""
    rows = bronze.drop(CORRUPT_COLUMN) if CORRUPT_COLUMN in bronze.columns else bronze
    typed = rows.withColumn("event_ts", parse_event_ts("event_ts"))
    return dedup(typed, keep=keep).withColumn("ingest_ts", batch_literal(batch_ts))


def upserted(silver: DataFrame | None, new: DataFrame) -> DataFrame:
    """Silver after new rows (typed, stamped, one per event): of each event the latest.

    Silver rows of other events are copied as they are; they are neither sorted
    nor, if the new ids are few, shuffled.  Of equal rows the older one stays, with the earlier time of its load.
    """
    if silver is None:
        return new
    ids = new.select(F.col("event_id").alias("__new")).distinct()
    touched = F.col("event_id").eqNullSafe(F.col("__new"))
    both = silver.join(ids, touched, "left_semi").unionByName(new)
    return silver.join(ids, touched, "left_anti").unionByName(dedup(both))


REJECT_REASON = "reject_reason"


def _rejection():
    return F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit("MALFORMED")).when(
        F.col("event_id").isNull(), F.lit("NO_EVENT_ID")
    )


def accepted(bronze: DataFrame) -> DataFrame:
    """Rows fit for silver; needs the raw-text column of ``read_landing``."""
    return bronze.where(_rejection().isNull())


def rejected(bronze: DataFrame) -> DataFrame:
    """The other rows, each with its raw text and the reason."""
    return bronze.withColumn(REJECT_REASON, _rejection()).where(F.col(REJECT_REASON).isNotNull())
