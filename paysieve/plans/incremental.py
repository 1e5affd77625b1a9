"""Ingestion and gold of what is new, on atomic layers.

A run of ingestion parses the landing files that no earlier run has taken, and
stores their rows as a run of bronze, and the files' names beside them.  The run counts once
silver is published together with its number: one that dies before is taken
up again, under the same number, over what it left.  Gold is published with the
time of the last silver rows that it holds.
"""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve.config import PipelineConfig
from paysieve.functions.times import new_batch_ts
from paysieve.operators import gold as gold_ops
from paysieve.operators.blacklist import with_blacklist
from paysieve.operators.cleaning import accepted, rejected, to_silver, upserted
from paysieve.sources import layer_exists, layer_notes, read_landing, read_layer, write_layer
from paysieve.sources.layers import list_files

log = logging.getLogger(__name__)

LEDGER_SCHEMA = "path string, size long, modified long"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """``LEDGER_SCHEMA`` of the files under a path; those that begin with a dot or an underscore are not of it."""
    return spark.createDataFrame(list_files(spark, landing), LEDGER_SCHEMA)


def _ledger(bronze: str) -> str:
    return f"{bronze.rstrip('/')}/_ledger"


def new_files(spark: SparkSession, cfg: PipelineConfig, runs: int) -> DataFrame:
    """Files that none of the first ``runs`` runs has taken; one that has been written again since is new."""
    there = landed_files(spark, cfg.landing)
    if not runs:
        return there
    taken = spark.read.schema(f"{LEDGER_SCHEMA}, run int").parquet(_ledger(cfg.bronze)).where(F.col("run") < runs)
    return there.join(taken, ["path", "size", "modified"], "left_anti")


def run_ingest_new(spark: SparkSession, cfg: PipelineConfig, *, batch_ts: datetime | None = None) -> int:
    """New landing files -> bronze -> silver; how many files there were.

    Silver becomes what ``run_ingest`` makes of all files, but rows that do not
    change keep their load time.  Bronze has the rows by run, and so has the quarantine.
    """
    runs = layer_notes(spark, cfg.silver).get("runs", 0)
    files = new_files(spark, cfg, runs).orderBy("path").collect()  # of one run
    if not files:
        log.warning("no new files in %s, nothing written", cfg.landing)
        return 0
    run = f"run={runs}"
    quarantine = cfg.bad_records == "quarantine"
    rows = read_landing(spark, [f["path"] for f in files], keep_corrupt=quarantine)
    write_layer(rows, f"{cfg.bronze.rstrip('/')}/{run}")
    write_layer(spark.createDataFrame(files, LEDGER_SCHEMA).coalesce(1), f"{_ledger(cfg.bronze)}/{run}")
    bronze = read_layer(spark, f"{cfg.bronze.rstrip('/')}/{run}")
    if quarantine:
        write_layer(rejected(bronze), f"{cfg.quarantine.rstrip('/')}/{run}")
        bronze = accepted(bronze)
    new = to_silver(bronze, batch_ts=batch_ts or new_batch_ts(), keep=cfg.dedup)
    old = read_layer(spark, cfg.silver) if layer_exists(spark, cfg.silver) else None
    write_layer(upserted(old, new), cfg.silver, atomic=True, notes={"runs": runs + 1})
    return len(files)


def run_gold_new(spark: SparkSession, cfg: PipelineConfig, *, batch_ts: datetime | None = None) -> bool:
    """Bring gold up to silver; False if it is.

    Only what lies within the window's reach of an event that has come or
    changed since is counted again and marked by the blacklist as it is now.  A changed rule
    or list, and serving tables, need ``run_gold``.
    """
    batch_ts = batch_ts or new_batch_ts()
    silver = read_layer(spark, cfg.silver)
    held = layer_notes(spark, cfg.gold).get("silver_us")
    last = silver.agg(F.max(F.unix_micros("ingest_ts"))).first()[0]
    if last is None or last == held:
        return False
    blacklist = read_layer(spark, cfg.blacklist) if cfg.blacklist else None

    def marked(gold: DataFrame) -> DataFrame:
        return gold if blacklist is None else with_blacklist(gold, blacklist)

    if held is None:
        gold = marked(gold_ops.to_gold(silver, cfg.rules, batch_ts=batch_ts))
    else:
        changed = silver.where(F.unix_micros("ingest_ts") > F.lit(held))
        stays, anew = gold_ops.renewed_gold(read_layer(spark, cfg.gold), silver, changed, cfg.rules, batch_ts=batch_ts)
        gold = stays.unionByName(marked(anew))
    write_layer(gold, cfg.gold, atomic=True, notes={"silver_us": last})
    return True
