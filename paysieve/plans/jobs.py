"""The four batch jobs.  The caller owns the session."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from paysieve.config import PipelineConfig
from paysieve.functions.times import new_batch_ts
from paysieve.operators import gold as gold_ops
from paysieve.operators import model as model_ops
from paysieve.operators.blacklist import with_blacklist
from paysieve.operators.cleaning import accepted, rejected, to_silver
from paysieve.operators.quality import silver_report
from paysieve.operators.registry import load_model, save_model
from paysieve.sources import read_landing, read_layer, write_jdbc, write_layer

log = logging.getLogger(__name__)


def run_ingest(spark: SparkSession, cfg: PipelineConfig, *, batch_ts: datetime | None = None) -> bool:
    """Landing -> bronze -> silver.  Writes nothing and returns False when
    landing has no rows.

    The JSON is parsed once: silver is made from bronze.  With quarantine on,
    bronze also keeps the raw text of malformed lines.
    """
    quarantine = cfg.bad_records == "quarantine"
    landing = read_landing(spark, cfg.landing, keep_corrupt=quarantine)
    if landing.isEmpty():
        log.warning("no rows in %s, nothing written", cfg.landing)
        return False
    write_layer(landing, cfg.bronze, atomic=cfg.atomic)

    bronze = read_layer(spark, cfg.bronze)
    if quarantine:
        write_layer(rejected(bronze), cfg.quarantine, atomic=cfg.atomic)
        bronze = accepted(bronze)
    write_layer(to_silver(bronze, batch_ts=batch_ts or new_batch_ts(), keep=cfg.dedup), cfg.silver, atomic=cfg.atomic)
    if cfg.quality:
        write_layer(silver_report(read_layer(spark, cfg.silver)), cfg.quality, atomic=cfg.atomic)
    return True


def run_gold(spark: SparkSession, cfg: PipelineConfig, *, batch_ts: datetime | None = None) -> None:
    """Silver -> gold and its serving table.

    Gold is read back for the serving table: computed once, the same rows in
    both, and a short lineage for the database write.
    """
    silver = read_layer(spark, cfg.silver)
    gold = gold_ops.to_gold(silver, cfg.rules, batch_ts=batch_ts or new_batch_ts())
    if cfg.blacklist:
        gold = with_blacklist(gold, read_layer(spark, cfg.blacklist))
    write_layer(gold, cfg.gold, atomic=cfg.atomic)
    if cfg.gold_jdbc:
        write_jdbc(gold_ops.serving_view(read_layer(spark, cfg.gold)), cfg.gold_jdbc)


def run_train(
    spark: SparkSession, cfg: PipelineConfig, *, version: int | None = None, labels: DataFrame | None = None
) -> str:
    """Fit on all of gold and save; returns the model's path."""
    labelled = model_ops.with_label(read_layer(spark, cfg.gold), labels)
    if cfg.features:
        write_layer(model_ops.feature_table(labelled), cfg.features, atomic=cfg.atomic)
        labelled = read_layer(spark, cfg.features)
    model = model_ops.train(labelled, max_iter=cfg.max_iter, tol=cfg.tol)
    return save_model(model, cfg.model, version=version)


def run_score(spark: SparkSession, cfg: PipelineConfig, *, version: int | str | None = None) -> None:
    """Gold (or silver) + model -> predictions and their serving table."""
    model = load_model(spark, cfg.model, version=version)
    source = read_layer(spark, cfg.gold or cfg.silver)
    scored = model_ops.score(model, source, velocity_seconds=cfg.rules.velocity_seconds)
    write_layer(scored, cfg.predictions, atomic=cfg.atomic)
    if cfg.predictions_jdbc:
        view = model_ops.serving_view(read_layer(spark, cfg.predictions), probability=cfg.serve_probability)
        write_jdbc(view, cfg.predictions_jdbc)


def run_all(spark: SparkSession, cfg: PipelineConfig, *, batch_ts: datetime | None = None) -> bool:
    """The four in order, under one batch time; False when there was no input."""
    batch_ts = batch_ts or new_batch_ts()
    if not run_ingest(spark, cfg, batch_ts=batch_ts):
        return False
    run_gold(spark, cfg, batch_ts=batch_ts)
    run_train(spark, cfg)
    run_score(spark, cfg)
    return True
