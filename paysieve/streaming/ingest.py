"""Landing -> bronze -> silver as streams.

Bronze receives every row as it is.  For silver each micro-batch is typed and cut down to one
row per event, the latest, and stored as an update of its own; a batch that is
run again replaces its update.  ``merge_silver`` brings new updates into the silver layer.  Since the
latest of the latest is the latest, that is what the batch job makes of the
same rows, in whatever order and however late they came, rows without a
readable time included.

Deliveries that are repeated word for word can be dropped before, by a state
that forgets a row some time after it came.  The clock of that state is the time of
arrival, which never runs backwards: no row is ever too late for it, and one
that is repeated after its state is gone is brought into silver once more, where it changes nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paysieve.functions.times import batch_literal, new_batch_ts, parse_event_ts
from paysieve.operators.cleaning import dedup, upserted
from paysieve.schemas import LANDING
from paysieve.sources import layer_exists, layer_notes, read_layer, write_layer
from paysieve.sources.layers import layer_names, remove_layer


def _source(spark: SparkSession, max_files: int | None):
    reader = spark.readStream.schema(LANDING)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def parse_values(stream: DataFrame) -> DataFrame:
    """Landing events from a column ``value`` of JSON text or bytes, as message
    queues deliver them.  What is malformed becomes an all-NULL row, as in files."""
    return stream.select(F.from_json(F.col("value").cast("string"), LANDING).alias("event")).select("event.*")


def stream_to_bronze(
    spark: SparkSession,
    landing: str | DataFrame,
    bronze: str,
    checkpoint: str,
    *,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Copy new landing files, or the messages of a stream, to bronze, each exactly once."""
    if isinstance(landing, str):
        rows = _source(spark, max_files_per_trigger).json(landing)
    else:
        rows = parse_values(landing)
    return (
        rows.writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def without_repeats(rows: DataFrame, horizon: str) -> DataFrame:
    """A stream without rows that repeat another one that came up to ``horizon`` before.

    What has been seen is kept in the state store until the watermark on the
    time of arrival has passed it by that much.
    """
    own = rows.columns
    arrived = rows.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", horizon)
    return arrived.dropDuplicatesWithinWatermark(own).select(own)


def stream_to_updates(
    spark: SparkSession,
    bronze: str,
    updates: str,
    checkpoint: str,
    *,
    max_files_per_trigger: int | None = None,
    repeat_horizon: str | None = None,
) -> StreamingQuery:
    """Start the stream that stores one update per micro-batch of new bronze rows.

    Repeats are combined in each task before the shuffle, so an id that makes up
    much of a batch is no burden.  ``max_files_per_trigger`` bounds a batch.
    ``repeat_horizon`` ("6 hours") drops exact repeats across batches; a row's copies of one batch then meet in one task.
    """

    def store(batch: DataFrame, number: int) -> None:
        typed = batch.withColumn("event_ts", parse_event_ts("event_ts"))
        write_layer(dedup(typed), f"{updates.rstrip('/')}/batch={number}")

    rows = _source(spark, max_files_per_trigger).parquet(bronze)
    if repeat_horizon:
        rows = without_repeats(rows, repeat_horizon)
    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merge_silver(spark: SparkSession, updates: str, silver: str, *, batch_ts: datetime | None = None) -> bool:
    """Bring the updates that silver does not have yet into it; False if there are none.

    Silver is an atomic layer, published together with the number of the last
    update it holds, so a merge that dies changes nothing and the next one
    takes up the same updates.  Only new updates are read.  Rows that win keep or
    get the time of the merge that brought them.
    """
    merged = layer_notes(spark, silver).get("merged", -1)
    new = spark.read.parquet(updates).where(F.col("batch") > merged)
    last = new.agg(F.max("batch")).first()[0]
    if last is None:
        return False
    stamped = dedup(new.drop("batch")).withColumn("ingest_ts", batch_literal(batch_ts or new_batch_ts()))
    old = read_layer(spark, silver) if layer_exists(spark, silver) else None
    write_layer(upserted(old, stamped), silver, atomic=True, notes={"merged": last})
    return True


def remove_merged(spark: SparkSession, updates: str, silver: str) -> int:
    """Delete the updates that silver holds; returns how many.  Silver can then be made anew from bronze alone."""
    merged = layer_notes(spark, silver).get("merged", -1)
    numbers = [n for n in update_numbers(spark, updates) if n <= merged]
    for number in numbers:
        remove_layer(spark, f"{updates.rstrip('/')}/batch={number}")
    return len(numbers)


def update_numbers(spark: SparkSession, updates: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in layer_names(spark, updates) if name.startswith("batch="))
