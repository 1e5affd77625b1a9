"""Registered queries on the payments derived from ``events``, and the SQL
that DuckDB checks them with."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve import fixtures
from paysieve.config import JdbcTarget, PipelineConfig, stored_bytes
from paysieve.fixtures import as_landing, payments_from_events, payments_sql, with_busy_user
from paysieve.functions.rules import fraud_reason, high_amount, is_fraud, velocity
from paysieve.functions.times import epoch_seconds
from paysieve.operators import gold as gold_ops
from paysieve.operators import model as model_ops
from paysieve.operators.blacklist import with_blacklist
from paysieve.operators.cleaning import dedup, to_silver
from paysieve.operators.gold import to_gold
from paysieve.operators.quality import silver_report
from paysieve.operators.registry import load_model, registry, save_model
from paysieve.operators.velocity import with_velocity
from paysieve.plans import run_all, run_gold, run_gold_new, run_ingest, run_ingest_new, run_score, run_train
from paysieve.sources import layer_exists, read_jdbc, read_landing, read_layer, scratch_path, write_jdbc, write_layer
from paysieve.sources.jdbc import with_ranges
from paysieve.streaming import corrected, merge_silver, stream_counts, stream_to_bronze, stream_to_updates

JDBC_CONF = "spark.paysieve.jdbc."


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return payments_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _with_micros(df: DataFrame) -> DataFrame:
    """``event_ts`` as microseconds, the same text in any engine."""
    return df.withColumn("event_us", F.unix_micros("event_ts")).drop("event_ts", "ingest_ts", "gold_ts")


def _landing_dir(spark: SparkSession, rows: DataFrame) -> str:
    path = scratch_path(spark, "landing")
    as_landing(rows).write.json(path)
    return path


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landing(spark, _landing_dir(spark, payments(spark, sf_dir)))


# Sources, sinks, cleaning


def landing_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(spark, sf_dir)


def landing_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "layer")
    write_layer(payments(spark, sf_dir), path)
    return _with_micros(read_layer(spark, path))


def silver_parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = to_silver(_landing(spark, sf_dir))
    return silver.select("event_id", F.unix_micros("event_ts").alias("event_us"))


def epoch_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments(spark, sf_dir).select("event_id", epoch_seconds().alias("event_second"))


def _redelivered(rows: DataFrame) -> DataFrame:
    """Every failed payment arrives a second time, as an exact copy."""
    return rows.unionByName(rows.where(F.col("status") == "failed"))


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _landing_dir(spark, _redelivered(payments(spark, sf_dir)))
    return _with_micros(to_silver(read_landing(spark, landing), keep="any"))


def silver_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed payments are retried two seconds later as captured, refunded
    ones arrive again with an earlier time."""
    return _with_micros(dedup(_retried(payments(spark, sf_dir))))


def _retried(rows: DataFrame) -> DataFrame:
    again = (
        rows.where(F.col("status") == "failed")
        .withColumn("event_ts", F.expr("event_ts + INTERVAL 2 SECONDS"))
        .withColumn("status", F.lit("captured"))
    )
    earlier = rows.where(F.col("status") == "refunded").withColumn(
        "event_ts", F.expr("event_ts - INTERVAL 3 SECONDS")
    )
    return rows.unionByName(again).unionByName(earlier)


# Velocity and rules


def _counts(method: str, seconds: int = 60, busy: bool = False, **options):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = payments(spark, sf_dir)
        rows = with_busy_user(rows) if busy else rows
        counted = with_velocity(rows, seconds, method=method, **options)
        return counted.select("event_id", "tx_count_window")

    return query


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold(payments(spark, sf_dir))


def _counted_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_velocity(payments(spark, sf_dir))


def rule_high_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments(spark, sf_dir).select("event_id", high_amount().alias("high_amount"))


def rule_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted_payments(spark, sf_dir).select("event_id", velocity().alias("velocity"))


def fraud_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _counted_payments(spark, sf_dir)
    return counted.select("event_id", "amount", "tx_count_window", fraud_reason().alias("fraud_reason"))


def fraud_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _counted_payments(spark, sf_dir).withColumn("fraud_reason", fraud_reason())
    return counted.select("event_id", is_fraud().alias("is_fraud"))


def gold_serving_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_micros(gold_ops.serving_view(_gold(spark, sf_dir)))


def _serving_target(spark: SparkSession, table: str) -> JdbcTarget:
    """The database named in the session, else one inside the driver's process."""
    url = spark.conf.get(JDBC_CONF + "url", None)
    types = "event_id VARCHAR(64), user_id VARCHAR(64), fraud_reason VARCHAR(32)"
    if url is None:
        return fixtures.embedded_target(spark, table, column_types=types)
    return JdbcTarget(
        url,
        table,
        spark.conf.get(JDBC_CONF + "driver"),
        spark.conf.get(JDBC_CONF + "user", ""),
        spark.conf.get(JDBC_CONF + "password", ""),
        column_types=types,
        mode="staged",
    )


def serving_jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the serving view and read it back.

    Without ``spark.paysieve.jdbc.url`` in the session the database is one that
    only this process sees, which works on a local master alone.
    """
    target = _serving_target(spark, "payments_gold")
    view = gold_ops.serving_view(_stored_gold(spark, sf_dir))
    write_jdbc(view, target)
    return _with_micros(read_jdbc(spark, with_ranges(view, target, "amount")))


def serving_jdbc_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, correct some rows (each twice in the batch), write again, read back."""
    target = replace(_serving_target(spark, "payments_rerun"), mode="upsert", index_key=True)
    view = gold_ops.serving_view(_stored_gold(spark, sf_dir))
    write_jdbc(view, target)
    corrected = view.where(F.col("fraud_reason") == "VELOCITY").withColumn("fraud_reason", F.lit("REVIEWED"))
    write_jdbc(corrected.unionByName(corrected), target)
    return _with_micros(read_jdbc(spark, with_ranges(view, target, "amount")))


def _marked(**limits):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        marked = with_blacklist(payments(spark, sf_dir), fixtures.blacklist_seed(spark), **limits)
        return marked.select("event_id", "user_id", "blacklist_reason", "blacklist_severity", "is_blacklisted")

    return query


def empty_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ingestion says, and leaves, of a landing folder without a row
    (events filtered to none, which is the feature here), and of one with rows."""
    rows, found = payments(spark, sf_dir), []
    for name, some in (("none", rows.where("event_id IS NULL")), ("all", rows)):
        cfg = _layers(spark, _landing_dir(spark, some))
        ingested = run_ingest(spark, cfg)
        found.append((name, ingested, stored_bytes(spark, cfg.bronze) > 0, stored_bytes(spark, cfg.silver) > 0))
    return spark.createDataFrame(found, "landing string, ingested boolean, bronze boolean, silver boolean")


def stamps_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load times of one run: how many, how many rows have none, whether gold's
    serving view carries the same, and no earlier than ingestion's."""
    cfg = _layers(spark, _landing_dir(spark, payments(spark, sf_dir)))
    run_ingest(spark, cfg)
    run_gold(spark, cfg)
    gold = read_layer(spark, cfg.gold)
    served = gold_ops.serving_view(gold).agg(F.max("gold_ts").alias("served"))
    return (
        gold.agg(
            F.count_distinct("ingest_ts").alias("ingest_stamps"),
            F.count_distinct("gold_ts").alias("gold_stamps"),
            F.count_if(F.col("ingest_ts").isNull() | F.col("gold_ts").isNull()).alias("unstamped"),
            F.max("gold_ts").alias("gold"),
            F.max("ingest_ts").alias("ingest"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .join(F.broadcast(served))
        .select(
            "ingest_stamps",
            "gold_stamps",
            "unstamped",
            "n_rows",
            (F.col("served") == F.col("gold")).alias("served_alike"),
            (F.col("gold") >= F.col("ingest")).alias("in_order"),
        )
    )


def silver_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_report(_redelivered(with_busy_user(payments(spark, sf_dir))))


# Model


def train_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_ops.with_label(_gold(spark, sf_dir)).select("event_id", "label")


def _stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold")
    write_layer(_gold(spark, sf_dir), path)
    return read_layer(spark, path)


def _trained(spark: SparkSession, sf_dir: str, **options):
    gold = _stored_gold(spark, sf_dir)
    return gold, model_ops.train(model_ops.with_label(gold), **options)


def _features(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    gold = _stored_gold(spark, sf_dir)
    assembler, scaler, _ = model_ops.build_pipeline(handle_invalid="error").getStages()
    assembled = assembler.transform(gold)
    scaled = scaler.fit(assembled).transform(assembled)
    values = vector_to_array(column)
    return scaled.select(
        "event_id",
        F.round(values[0], 6).alias("amount_feature"),
        F.round(values[1], 6).alias("count_feature"),
    )


def features_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, "features")


def features_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, "scaledFeatures")


# Run until it stops by itself, the fit has one answer that SQL can find too.
CONVERGED = {"max_iter": 200, "tol": 1e-12}


def _terms(spark: SparkSession, model: PipelineModel, digits: int) -> DataFrame:
    rows = [(name, round(value, digits)) for name, value in model_ops.coefficients(model)]
    return spark.createDataFrame(rows, "term string, value double")


def model_coefficients_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _terms(spark, _trained(spark, sf_dir, **CONVERGED)[1], 4)


# Ten iterations end this close to the converged fit: coefficients and probabilities.
NEAR_TERM, NEAR_PROBABILITY = 0.02, 0.001


def _near_terms(spark: SparkSession, gold: DataFrame, model: PipelineModel) -> DataFrame:
    """The converged fit, and whether the model's coefficients are near."""
    converged = dict(model_ops.coefficients(model_ops.train(model_ops.with_label(gold), **CONVERGED)))
    rows = [(n, round(converged[n], 4), abs(v - converged[n]) < NEAR_TERM) for n, v in model_ops.coefficients(model)]
    return spark.createDataFrame(rows, "term string, value double, near boolean")


def _checked(gold: DataFrame, scored: DataFrame) -> DataFrame:
    """``scored`` with whether its probability is near the converged fit's, and
    no prediction where that is as near to one half."""
    model = model_ops.train(model_ops.with_label(gold), **CONVERGED)
    plain = scored.select(
        "event_id",
        "user_id",
        "amount",
        "tx_count_window",
        "fraud_reason",
        F.col("prediction").alias("given"),
        F.col("fraud_probability").alias("own"),
    )
    p = F.col("fraud_probability")
    return (
        model_ops.score(model, plain)
        .withColumn("near", F.abs(F.col("own") - p) < NEAR_PROBABILITY)
        .withColumn("prediction", F.when(F.abs(p - 0.5) >= NEAR_PROBABILITY, F.col("given")))
    )


def model_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, model = _trained(spark, sf_dir)
    return _near_terms(spark, gold, model)


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions saved; what the registry says of the later one."""
    gold = model_ops.with_label(_stored_gold(spark, sf_dir))
    path = scratch_path(spark, "models")
    save_model(model_ops.train(gold), path, version=1)
    save_model(model_ops.train(gold, **CONVERGED), path, version=2)
    newest = registry(spark, path).where(F.col("version") == 2)
    values = F.concat("coefficients", F.array("intercept"))
    return newest.select("version", *[F.round(values[i], 4).alias(n) for i, n in enumerate("abc")])


def predictions_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir, **CONVERGED)
    return scored.select("event_id", "prediction", F.round("fraud_probability", 3).alias("fraud_probability"))


def _scored(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    gold, model = _trained(spark, sf_dir, **options)
    return model_ops.score(model, gold)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, model = _trained(spark, sf_dir)
    checked = _checked(gold, model_ops.score(model, gold))
    return checked.select("event_id", "amount", "tx_count_window", "prediction", "near")


def prediction_serving_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_ops.serving_view(_scored(spark, sf_dir, **CONVERGED))


def _measures(spark: SparkSession, measures: dict[str, float]) -> DataFrame:
    rows = [(name, round(float(value), 6)) for name, value in measures.items()]
    return spark.createDataFrame(rows, "measure string, value double")


def model_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on four fifths, measured on the rest."""
    train, test = model_ops.split(model_ops.with_label(_stored_gold(spark, sf_dir)))
    return _measures(spark, model_ops.evaluate(model_ops.train(train, **CONVERGED), test))


def _captured_after_all(payments: DataFrame) -> DataFrame:
    """Stand-in for labels from elsewhere: a payment that did not go through
    counts as fraud."""
    return payments.select("event_id", (F.col("status") != "captured").cast("int").alias("label"))


def model_evaluation_outside_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule-trained model measured against labels from another table."""
    gold, model = _trained(spark, sf_dir, **CONVERGED)
    labelled = model_ops.with_label(gold, _captured_after_all(payments(spark, sf_dir)))
    return _measures(spark, model_ops.evaluate(model, labelled))


# Jobs


def _layers(spark: SparkSession, landing: str = "") -> PipelineConfig:
    names = ("bronze", "silver", "gold", "model", "predictions")
    return PipelineConfig(landing=landing, **{n: scratch_path(spark, n) for n in names})


def _redelivered_landing(spark: SparkSession, sf_dir: str) -> str:
    return _landing_dir(spark, _redelivered(payments(spark, sf_dir)))


def job_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _layers(spark, _redelivered_landing(spark, sf_dir))
    run_ingest(spark, cfg)
    return _with_micros(read_layer(spark, cfg.silver))


def _gold_layer(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    cfg = _layers(spark)
    write_layer(payments(spark, sf_dir), cfg.silver)
    run_gold(spark, cfg)
    return cfg


def job_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_micros(read_layer(spark, _gold_layer(spark, sf_dir).gold))


def job_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coefficients of the model as saved and loaded again."""
    cfg = _gold_layer(spark, sf_dir)
    path = run_train(spark, cfg)
    return _near_terms(spark, read_layer(spark, cfg.gold), load_model(spark, path))


def _scored_layer(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    checked = _checked(read_layer(spark, cfg.gold), read_layer(spark, cfg.predictions))
    return checked.select("event_id", "user_id", "tx_count_window", "fraud_reason", "prediction", "near")


def job_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _gold_layer(spark, sf_dir)
    run_train(spark, cfg)
    run_score(spark, cfg)
    return _scored_layer(spark, cfg)


def job_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From landing, with repeated events, to predictions."""
    cfg = _layers(spark, _redelivered_landing(spark, sf_dir))
    run_all(spark, cfg)
    return _scored_layer(spark, cfg)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing, with retried and back-dated events and some without a time, in
    several files and micro-batches, through the streams."""
    rows = payments(spark, sf_dir)
    untimed = F.col("payment_method") == "wallet"
    rows = rows.withColumn("event_ts", F.when(~untimed | (F.col("status") != "captured"), F.col("event_ts")))
    landing = scratch_path(spark, "landing")
    as_landing(_retried(rows)).repartition(3).write.json(landing)
    bronze, updates, silver, state = (scratch_path(spark, n) for n in ("bronze", "updates", "silver", "state"))
    stream_to_bronze(spark, landing, bronze, f"{state}/bronze", max_files_per_trigger=1).awaitTermination()
    stream_to_updates(spark, bronze, updates, f"{state}/updates", max_files_per_trigger=1).awaitTermination()
    merge_silver(spark, updates, silver)
    return _with_micros(read_layer(spark, silver)).fillna(-1, ["event_us"])


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_ingest``, in two runs of which the second brings retries and exact
    repeats, without repeats by state and with silver merged after each run."""
    rows = payments(spark, sf_dir)
    untimed = F.col("payment_method") == "wallet"
    rows = rows.withColumn("event_ts", F.when(~untimed | (F.col("status") != "captured"), F.col("event_ts")))
    landing, bronze, updates, silver, state = (
        scratch_path(spark, n) for n in ("landing", "bronze", "updates", "silver", "state")
    )
    later = F.col("event_id").cast("long") % 3 == 0
    for run, part in enumerate((rows.where(~later), _retried(rows).unionByName(rows.where(~later)))):
        as_landing(part).write.json(f"{landing}/run-{run}")
        stream_to_bronze(spark, f"{landing}/run-*", bronze, f"{state}/bronze").awaitTermination()
        stream_to_updates(spark, bronze, updates, f"{state}/updates", repeat_horizon="1 hour").awaitTermination()
        merge_silver(spark, updates, silver)
    return _with_micros(read_layer(spark, silver)).fillna(-1, ["event_us"])


def stream_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by state over micro-batches in order of time, refunds coming late and being corrected for."""
    rows = payments(spark, sf_dir).select("event_id", "user_id", "event_ts", "status")
    arrivals, counts, state = (scratch_path(spark, n) for n in ("arrivals", "counts", "state"))
    in_time = rows.where("status <> 'refunded'")
    low, high = in_time.agg(F.min("event_ts"), F.max("event_ts")).first()
    middle = low + (high - low) / 2
    # a run per part: the number of micro-batches, each of which touches every partition of the state, does not grow with the files
    stream = spark.readStream.schema("event_id string, user_id string, event_ts timestamp")
    for part in (in_time.where(F.col("event_ts") < middle), in_time.where(F.col("event_ts") >= middle), rows.where("status = 'refunded'")):
        part.drop("status").write.mode("append").parquet(arrivals)
        stream_counts(stream.parquet(arrivals), counts, state, delay=120).awaitTermination()
    return corrected(spark, counts, rows).select("event_id", "tx_count_window")


def _in_two_runs(spark: SparkSession, sf_dir: str, after) -> PipelineConfig:
    """Landing in two parts, the second with retries of events of the first; ``after`` runs after each ingestion."""
    cfg = PipelineConfig(**{n: scratch_path(spark, n) for n in ("landing", "bronze", "silver", "gold")})
    rows = payments(spark, sf_dir)
    early = F.col("event_id").cast("long") % 4 != 0
    for run, part in enumerate((rows.where(early), _retried(rows).join(rows.where(early), rows.columns, "left_anti"))):
        as_landing(part).write.json(f"{cfg.landing}/run-{run}")
        run_ingest_new(spark, cfg)
        after(cfg)
    return cfg


def ingest_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver by two runs, each of which parses its own files alone."""
    cfg = _in_two_runs(spark, sf_dir, lambda cfg: None)
    return _with_micros(read_layer(spark, cfg.silver)).fillna(-1, ["event_us"])


def gold_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold brought up to silver after each of two runs."""
    cfg = _in_two_runs(spark, sf_dir, lambda cfg: run_gold_new(spark, cfg))
    return read_layer(spark, cfg.gold).select("event_id", "tx_count_window", "fraud_reason", "is_fraud")


def blacklist_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users listed, and listed anew, at the times of their own payments."""
    rows = payments(spark, sf_dir)
    per_user = rows.groupBy("user_id").agg(F.min("event_ts").alias("low"), F.max("event_ts").alias("high"))
    middle = F.timestamp_micros(F.expr("(unix_micros(low) + unix_micros(high)) DIV 2"))
    entries = F.array(
        F.struct(middle.alias("added_at"), F.lit("first").alias("reason"), F.lit("LOW").alias("severity")),
        F.struct(F.col("high").alias("added_at"), F.lit("second").alias("reason"), F.lit("HIGH").alias("severity")),
    )
    listed = per_user.where("cast(substr(user_id, 6) AS INT) % 3 = 0").select("user_id", F.explode(entries).alias("e")).select("user_id", "e.*")
    marked = with_blacklist(rows, listed)
    return marked.select("event_id", "blacklist_reason", "blacklist_severity", "is_blacklisted")


def layer_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An atomic layer, read, changed and replaced in place."""
    path = scratch_path(spark, "snapshots")
    for part in (F.col("status") != "failed", F.col("status") == "failed"):
        rows = payments(spark, sf_dir).where(part)
        write_layer(read_layer(spark, path).unionByName(rows) if layer_exists(spark, path) else rows, path, atomic=True)
    return _with_micros(read_layer(spark, path))


QUERIES = {
    "landing_json_scan": landing_json_scan,
    "landing_row_count": landing_row_count,
    "layer_roundtrip": layer_roundtrip,
    "silver_parse_ts": silver_parse_ts,
    "epoch_seconds": epoch_second,
    "silver_dedup": silver_dedup,
    "silver_dedup_latest": silver_dedup_latest,
    "velocity_count": _counts("auto"),
    "velocity_count_bucketed": _counts("bucketed"),
    "velocity_count_linear": _counts("linear"),
    "velocity_count_wide": _counts("auto", seconds=3600),
    "velocity_count_busy_user": _counts("auto", busy=True, hot_rows=100),
    "velocity_count_busy_user_wide": _counts("auto", seconds=3600, busy=True, hot_rows=100),
    "rule_high_amount": rule_high_amount,
    "rule_velocity": rule_velocity,
    "fraud_reason": fraud_reasons,
    "is_fraud": fraud_flag,
    "gold_serving_view": gold_serving_view,
    "serving_jdbc_roundtrip": serving_jdbc_roundtrip,
    "train_label": train_label,
    "features_assembled": features_assembled,
    "features_scaled": features_scaled,
    "model_coefficients": model_coefficients,
    "model_coefficients_converged": model_coefficients_converged,
    "predictions": predictions,
    "predictions_converged": predictions_converged,
    "prediction_serving_view": prediction_serving_view,
    "model_evaluation": model_evaluation,
    "model_evaluation_outside_labels": model_evaluation_outside_labels,
    "model_versions": model_versions,
    "blacklist_enriched": _marked(),
    "blacklist_enriched_long_list": _marked(max_broadcast_bytes=1),
    "serving_jdbc_rerun": serving_jdbc_rerun,
    "empty_landing": empty_landing,
    "stamps_constant": stamps_constant,
    "silver_quality_report": silver_quality_report,
    "job_ingest": job_ingest,
    "job_gold": job_gold,
    "job_train": job_train,
    "job_score": job_score,
    "job_all": job_all,
    "stream_ingest": stream_ingest,
    "stream_merge": stream_merge,
    "stream_velocity": stream_velocity,
    "layer_snapshots": layer_snapshots,
    "ingest_new": ingest_new,
    "gold_new": gold_new,
    "blacklist_as_of": blacklist_as_of,
}


# The same in DuckDB's SQL

_P = f"p AS ({payments_sql()})"
_BUSY = """busy AS (SELECT * REPLACE (
    CASE status WHEN 'captured' THEN 'user_busy' WHEN 'failed' THEN NULL ELSE user_id END AS user_id,
    CASE WHEN status <> 'refunded' THEN event_ts END AS event_ts) FROM p)"""
_COLUMNS = """event_id, payment_id, user_id, merchant_id, amount, currency, payment_method,
    ip_address, device_id, status"""
_SERVING = "event_id, user_id, amount, epoch_us(event_ts) AS event_us, fraud_reason, is_fraud"


def _counted(source: str = "p", seconds: int = 60) -> str:
    return f"""g AS (SELECT *, count(*) OVER (PARTITION BY user_id
    ORDER BY CAST(floor(epoch(event_ts)) AS BIGINT)
    RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW) AS tx_count_window FROM {source})"""


_RULED = """r AS (SELECT *, CASE WHEN amount > 5000 THEN 'HIGH_AMOUNT'
    WHEN tx_count_window > 3 THEN 'VELOCITY' ELSE 'NONE' END AS fraud_reason FROM g),
f AS (SELECT *, fraud_reason <> 'NONE' AS is_fraud FROM r)"""


def _from_payments(select: str) -> str:
    return f"WITH {_P} {select}"


def _from_counts(select: str, seconds: int = 60) -> str:
    return f"WITH {_P}, {_counted(seconds=seconds)} {select}"


def _from_busy(select: str, seconds: int) -> str:
    return f"WITH {_P}, {_BUSY}, {_counted('busy', seconds)} {select}"


def _from_rules(select: str) -> str:
    return f"WITH {_P}, {_counted()}, {_RULED} {select}"


def _from_fit(select: str, training: str = "TRUE") -> str:
    """Newton steps for the logistic regression on the scaled features, over the rows that meet ``training``."""
    return f"""WITH RECURSIVE {_P}, {_counted()}, {_RULED},
x AS (SELECT event_id, CAST(is_fraud AS INTEGER) AS y, {training} AS taught,
    amount / (SELECT stddev_samp(amount) FROM f WHERE {training}) AS u,
    tx_count_window / (SELECT stddev_samp(tx_count_window) FROM f WHERE {training}) AS v FROM f),
fit(step, a, b, c) AS (
    SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
    UNION ALL
    SELECT step + 1,
        a + (gu * (vv * n - v1 * v1) - uv * (gv * n - v1 * g1) + u1 * (gv * v1 - vv * g1)) / det,
        b + (uu * (gv * n - v1 * g1) - gu * (uv * n - v1 * u1) + u1 * (uv * g1 - gv * u1)) / det,
        c + (uu * (vv * g1 - gv * v1) - uv * (uv * g1 - gv * u1) + gu * (uv * v1 - vv * u1)) / det
    FROM (SELECT *, uu * (vv * n - v1 * v1) - uv * (uv * n - v1 * u1) + u1 * (uv * v1 - vv * u1) AS det
        FROM (SELECT step, a, b, c,
            sum(w * u * u) AS uu, sum(w * u * v) AS uv, sum(w * v * v) AS vv,
            sum(w * u) AS u1, sum(w * v) AS v1, sum(w) AS n,
            sum((y - q) * u) AS gu, sum((y - q) * v) AS gv, sum(y - q) AS g1
            FROM (SELECT *, q * (1 - q) AS w
                FROM (SELECT fit.*, x.*, 1 / (1 + exp(-(a * u + b * v + c))) AS q FROM fit, x WHERE taught))
            GROUP BY step, a, b, c))
    WHERE step < 20),
done AS (SELECT a, b, c FROM fit ORDER BY step DESC LIMIT 1)
{select}"""


_TERMS = _from_fit("""SELECT 'amount' AS term, round(a, 4) AS value FROM done
    UNION ALL SELECT 'tx_count_window', round(b, 4) FROM done
    UNION ALL SELECT 'intercept', round(c, 4) FROM done""")
_NEAR_TERMS = f"SELECT *, TRUE AS near FROM ({_TERMS})"
_CHECKED = f"CASE WHEN abs(q - 0.5) >= {NEAR_PROBABILITY} THEN CAST(q > 0.5 AS DOUBLE) END AS prediction, TRUE AS near"
_FITTED = "(SELECT event_id, 1 / (1 + exp(-(a * u + b * v + c))) AS q FROM x, done)"
_SCORED = _from_fit(f"""SELECT event_id, user_id, tx_count_window, fraud_reason, {_CHECKED}
FROM {_FITTED} JOIN f USING (event_id)""")


def _measured(fraud: str, rows: str, training: str = "TRUE") -> str:
    """Confusion counts and the area under the curve by ranks."""
    return _from_fit(
        f"""SELECT measure, value FROM (
    SELECT count(*) FILTER (z AND s > 0) AS tp, count(*) FILTER (NOT z AND s > 0) AS fp,
        count(*) FILTER (NOT z AND s <= 0) AS tn, count(*) FILTER (z AND s <= 0) AS fn, 0 AS unscored,
        round((sum(place) FILTER (z) - count(*) FILTER (z) * (count(*) FILTER (z) + 1) / 2)
            / (count(*) FILTER (z) * count(*) FILTER (NOT z)), 6) AS auc
    FROM (SELECT *, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS place
        FROM (SELECT a * u + b * v + c AS s, {fraud} AS z FROM x JOIN p USING (event_id), done WHERE {rows})))
UNPIVOT (value FOR measure IN (CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn,
    CAST(fn AS DOUBLE) AS fn, CAST(unscored AS DOUBLE) AS unscored, auc))""",
        training,
    )


_HELD_OUT = "('0x' || md5(event_id)[1:8])::BIGINT % 10000 < 2000"
_ROWS = _from_payments(f"SELECT {_COLUMNS}, epoch_us(event_ts) AS event_us FROM p")
_COUNTS = "SELECT event_id, tx_count_window FROM g"

_LATEST = f"""arrivals AS (
    SELECT * FROM {{source}}
    UNION ALL SELECT * REPLACE (event_ts + INTERVAL 2 SECOND AS event_ts, 'captured' AS status)
        FROM {{source}} WHERE status = 'failed'
    UNION ALL SELECT * REPLACE (event_ts - INTERVAL 3 SECOND AS event_ts) FROM {{source}} WHERE status = 'refunded'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_ts DESC) AS place FROM arrivals)
SELECT {_COLUMNS}, coalesce(epoch_us(event_ts), -1) AS event_us FROM ranked WHERE place = 1"""
_LISTED = f"""WITH {_P}, listed(user_id, reason, severity) AS (VALUES
    ('user_5', 'High chargeback rate', 'HIGH'), ('user_12', 'Suspicious login pattern', 'MEDIUM'))
SELECT p.event_id, p.user_id, reason AS blacklist_reason, severity AS blacklist_severity,
    listed.user_id IS NOT NULL AS is_blacklisted
FROM p LEFT JOIN listed ON p.user_id = listed.user_id"""

ORACLES = {
    "landing_json_scan": _from_payments(
        f"SELECT {_COLUMNS}, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_ts FROM p"
    ),
    "landing_row_count": _from_payments("SELECT count(*) AS n FROM p"),
    "layer_roundtrip": _ROWS,
    "silver_parse_ts": _from_payments("SELECT event_id, epoch_us(event_ts) AS event_us FROM p"),
    "epoch_seconds": _from_payments(
        "SELECT event_id, CAST(floor(epoch(event_ts)) AS BIGINT) AS event_second FROM p"
    ),
    "silver_dedup": _ROWS,
    "silver_dedup_latest": f"WITH {_P}, {_LATEST.format(source='p')}",
    "velocity_count": _from_counts(_COUNTS),
    "velocity_count_bucketed": _from_counts(_COUNTS),
    "velocity_count_linear": _from_counts(_COUNTS),
    "velocity_count_wide": _from_counts(_COUNTS, 3600),
    "velocity_count_busy_user": _from_busy(_COUNTS, 60),
    "velocity_count_busy_user_wide": _from_busy(_COUNTS, 3600),
    "rule_high_amount": _from_payments("SELECT event_id, amount > 5000 AS high_amount FROM p"),
    "rule_velocity": _from_counts("SELECT event_id, tx_count_window > 3 AS velocity FROM g"),
    "fraud_reason": _from_rules("SELECT event_id, amount, tx_count_window, fraud_reason FROM f"),
    "is_fraud": _from_rules("SELECT event_id, is_fraud FROM f"),
    "gold_serving_view": _from_rules(f"SELECT {_SERVING} FROM f"),
    "serving_jdbc_roundtrip": _from_rules(f"SELECT {_SERVING} FROM f"),
    "train_label": _from_rules("SELECT event_id, CAST(is_fraud AS INTEGER) AS label FROM f"),
    "features_assembled": _from_counts("""SELECT event_id, round(amount, 6) AS amount_feature,
    CAST(tx_count_window AS DOUBLE) AS count_feature FROM g"""),
    "features_scaled": _from_counts("""SELECT event_id,
    round(amount / stddev_samp(amount) OVER (), 6) AS amount_feature,
    round(tx_count_window / stddev_samp(tx_count_window) OVER (), 6) AS count_feature FROM g"""),
    "model_coefficients_converged": _TERMS,
    "model_versions": _from_fit("""SELECT 2 AS version, round(a, 4) AS a, round(b, 4) AS b, round(c, 4) AS c
FROM done"""),
    "model_coefficients": _NEAR_TERMS,
    "model_evaluation": _measured("y = 1", "NOT taught", f"NOT ({_HELD_OUT})"),
    "model_evaluation_outside_labels": _measured("status <> 'captured'", "TRUE"),
    "predictions": _from_fit(f"""SELECT event_id, amount, tx_count_window, {_CHECKED}
FROM {_FITTED} JOIN f USING (event_id)"""),
    "predictions_converged": _from_fit("""SELECT event_id, CAST(q > 0.5 AS DOUBLE) AS prediction,
    round(q, 3) AS fraud_probability
FROM (SELECT event_id, 1 / (1 + exp(-(a * u + b * v + c))) AS q FROM x, done)"""),
    "prediction_serving_view": _from_fit("""SELECT event_id, user_id,
    CAST(1 / (1 + exp(-(a * u + b * v + c))) > 0.5 AS DOUBLE) AS prediction
FROM x JOIN f USING (event_id), done"""),
    "blacklist_enriched": _LISTED,
    "blacklist_enriched_long_list": _LISTED,
    "serving_jdbc_rerun": _from_rules(f"""SELECT {_SERVING} FROM (SELECT * REPLACE (
    CASE fraud_reason WHEN 'VELOCITY' THEN 'REVIEWED' ELSE fraud_reason END AS fraud_reason) FROM f)"""),
    "empty_landing": _from_payments("""SELECT 'none' AS landing, FALSE AS ingested, FALSE AS bronze, FALSE AS silver
    UNION ALL SELECT 'all', count(*) > 0, count(*) > 0, count(*) > 0 FROM p"""),
    "stamps_constant": _from_payments("""SELECT 1::BIGINT AS ingest_stamps, 1::BIGINT AS gold_stamps,
    0::BIGINT AS unstamped, count(*) AS n_rows, TRUE AS served_alike, TRUE AS in_order FROM p"""),
    "silver_quality_report": f"""WITH {_P}, {_BUSY}, twice AS (
    SELECT * FROM busy UNION ALL SELECT * FROM busy WHERE status = 'failed')
SELECT count(*) AS n_rows, count(*) FILTER (event_id IS NULL) AS null_event_id,
    count(event_id) - count(DISTINCT event_id) AS repeated_event_id,
    count(*) FILTER (user_id IS NULL) AS null_user_id,
    count(*) FILTER (event_ts IS NULL) AS null_event_ts,
    count(*) FILTER (amount IS NULL OR isnan(amount)) AS null_amount,
    count(*) FILTER (amount < 0) AS negative_amount,
    count(*) FILTER (amount = 0) AS zero_amount,
    count(*) FILTER (status IS NULL OR status NOT IN ('captured', 'failed', 'refunded')) AS unknown_status
FROM twice""",
    "job_ingest": _ROWS,
    "stream_ingest": f"""WITH {_P}, t AS (SELECT * REPLACE (
    CASE WHEN payment_method <> 'wallet' OR status <> 'captured' THEN event_ts END AS event_ts) FROM p),
{_LATEST.format(source="t")}""",
    "job_train": _NEAR_TERMS,
    "job_score": _SCORED,
    "job_all": _SCORED,
    "job_gold": _from_rules(f"""SELECT {_COLUMNS}, epoch_us(event_ts) AS event_us, tx_count_window,
    fraud_reason, is_fraud FROM f"""),
}
ORACLES |= {
    "stream_merge": ORACLES["stream_ingest"],
    "stream_velocity": ORACLES["velocity_count"],
    "layer_snapshots": _ROWS,
    "ingest_new": ORACLES["silver_dedup_latest"],
    "gold_new": f"""WITH {_P}, latest AS (
    {_LATEST.format(source="p").replace("arrivals AS", "WITH arrivals AS", 1)}),
g AS (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY event_us // 1000000
    RANGE BETWEEN 60 PRECEDING AND CURRENT ROW) AS tx_count_window FROM latest),
{_RULED} SELECT event_id, tx_count_window, fraud_reason, is_fraud FROM f""",
    "blacklist_as_of": f"""WITH {_P}, u AS (
    SELECT user_id, min(event_ts) AS low, max(event_ts) AS high FROM p GROUP BY user_id),
listed AS (
    SELECT user_id, make_timestamp((epoch_us(low) + epoch_us(high)) // 2) AS added_at, 'first' AS reason, 'LOW' AS severity FROM u
    UNION ALL SELECT user_id, high, 'second', 'HIGH' FROM u),
chosen AS (SELECT * FROM listed WHERE CAST(substr(user_id, 6) AS INTEGER) % 3 = 0),
ranked AS (
    SELECT p.event_id, c.reason, c.severity, row_number() OVER (PARTITION BY p.event_id ORDER BY c.added_at DESC NULLS LAST) AS place
    FROM p LEFT JOIN chosen c ON p.user_id = c.user_id AND c.added_at <= p.event_ts)
SELECT event_id, reason AS blacklist_reason, severity AS blacklist_severity, reason IS NOT NULL AS is_blacklisted
FROM ranked WHERE place = 1""",
}
