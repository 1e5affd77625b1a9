import os
import subprocess
import sys
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.config import (
    PipelineConfig,
    StoreSettings,
    mariadb_target,
    size_session,
    sizing_conf,
    spark_conf,
    stored_bytes,
)
from paysieve.fixtures import as_landing, blacklist_seed, embedded_target
from paysieve.operators.model import coefficients
from paysieve.operators.registry import load_model
from paysieve.plans import cli, run_all, run_score, run_train
from paysieve.sources import read_jdbc, read_layer, scratch_path, write_layer

BATCH = datetime(2024, 6, 1, tzinfo=timezone.utc)


def config(root, landing, **extra):
    names = ("bronze", "silver", "gold", "model", "predictions")
    return PipelineConfig(landing=landing, **{n: str(root / n) for n in names}, **extra)


@pytest.fixture(scope="module")
def landing(payments, tmp_path_factory):
    path = tmp_path_factory.mktemp("in") / "landing"
    rows = as_landing(payments)
    rows.unionByName(rows.where("status = 'failed'")).write.json(str(path))
    (path / "bad.json").write_text("not json\n\n{broken\n")
    return str(path)


@pytest.fixture(scope="module")
def finished(spark, landing, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    cfg = config(
        root,
        landing,
        gold_jdbc=embedded_target(spark, "payments_gold"),
        predictions_jdbc=embedded_target(spark, "predictions"),
    )
    assert run_all(spark, cfg, batch_ts=BATCH)
    return cfg


def test_layers(spark, payments, finished):
    n = payments.count()
    bronze, silver, gold, predictions = (
        read_layer(spark, p) for p in (finished.bronze, finished.silver, finished.gold, finished.predictions)
    )
    assert bronze.count() == n + payments.where("status = 'failed'").count() + 2
    assert silver.schema == schemas.SILVER and silver.count() == n + 1
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in schemas.GOLD]
    assert gold.count() == n + 1
    assert len(predictions.columns) == 22 and predictions.count() == n + 1
    nameless = predictions.where("event_id IS NULL").first()
    assert nameless["prediction"] is None and nameless["fraud_reason"] == "NONE"
    assert same_rows(silver.where("event_id IS NOT NULL").select(payments.columns), payments)


def test_serving_tables_hold_what_the_layers_hold(spark, finished):
    gold = read_layer(spark, finished.gold).select(schemas.GOLD_SERVING_COLUMNS)
    assert same_rows(read_jdbc(spark, finished.gold_jdbc), gold)
    predictions = read_layer(spark, finished.predictions).select(schemas.PREDICTION_SERVING_COLUMNS)
    assert same_rows(read_jdbc(spark, finished.predictions_jdbc), predictions)


def test_one_batch_time(spark, finished):
    stamps = read_layer(spark, finished.gold).select(F.unix_seconds("ingest_ts"), F.unix_seconds("gold_ts"))
    assert [tuple(r) for r in stamps.distinct().collect()] == [(BATCH.timestamp(),) * 2]


def test_scoring_from_silver(spark, finished, tmp_path):
    cfg = PipelineConfig(silver=finished.silver, model=finished.model, predictions=str(tmp_path / "p"))
    run_score(spark, cfg)
    columns = ["event_id", "tx_count_window", "prediction"]
    assert same_rows(
        read_layer(spark, cfg.predictions).select(columns), read_layer(spark, finished.predictions).select(columns)
    )


def test_training_through_a_feature_layer_and_with_labels(spark, finished, tmp_path):
    cfg = replace(finished, model=str(tmp_path / "m"), features=str(tmp_path / "f"), gold_jdbc=None)
    run_train(spark, cfg)
    stored = read_layer(spark, cfg.features)
    assert stored.columns == ["event_id", "user_id", "amount", "tx_count_window", "label"]
    assert stored.count() == read_layer(spark, finished.gold).count()

    def terms(path):
        return [value for _, value in coefficients(load_model(spark, path))]

    assert terms(cfg.model) == pytest.approx(terms(finished.model), rel=1e-8)
    labels = stored.select("event_id", (F.col("amount") < 100).cast("int").alias("label"))
    assert run_train(spark, cfg, version=1, labels=labels).endswith("/v1")
    assert terms(cfg.model + "/v1") != pytest.approx(terms(finished.model), rel=0.1)


def test_the_whole_command_fills_both_serving_tables(spark, payments, tmp_path):
    landing = f"{tmp_path}/landing"
    as_landing(payments).write.json(landing)
    names = ("bronze", "silver", "gold", "model", "predictions", "quality")
    target = embedded_target(spark, "unused")
    args = cli.parse(
        ["all", f"--landing={landing}", *[f"--{n}={tmp_path / n}" for n in names], f"--jdbc-url={target.url}",
         f"--jdbc-driver={target.driver}", "--jdbc-gold-table=g", "--jdbc-predictions-table=p", "--jdbc-mode=upsert",
         "--jdbc-connections=2", "--serve-probability", "--jdbc-index-key",
         "--jdbc-column-types=event_id VARCHAR(64), user_id VARCHAR(64), fraud_reason VARCHAR(32), amount DOUBLE"]
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        cli.run(spark, args)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    gold, scored = (read_jdbc(spark, replace(target, table=t)) for t in ("g", "p"))
    assert gold.count() == read_layer(spark, str(tmp_path / "gold")).count() == scored.count() > 0
    assert "fraud_probability" in scored.columns
    assert read_layer(spark, str(tmp_path / "quality")).first()["n_rows"] == gold.count()


def test_partitions_follow_what_lies_there(spark, landing, tmp_path):
    assert stored_bytes(spark, landing) > 0 and stored_bytes(spark, str(tmp_path / "none")) == 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        size_session(spark, landing, expansion=10**9)
        wanted = -(-stored_bytes(spark, landing) * 10**9 // 2**29)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(min(wanted, 200_000)) != "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gold_is_marked_by_a_blacklist(spark, landing, tmp_path):
    cfg = config(tmp_path, landing, blacklist=str(tmp_path / "listed"))
    write_layer(blacklist_seed(spark), cfg.blacklist)
    assert run_all(spark, cfg)
    gold = read_layer(spark, cfg.gold)
    assert gold.where("is_blacklisted").select("user_id").distinct().count() == 2


def test_scratch_is_removed():
    code = (
        "from pyspark.sql import SparkSession; import os, sys; from paysieve.sources import remove_scratch, scratch_path;"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate();"
        "p = scratch_path(s, 'x'); s.range(3).write.parquet(p); assert os.path.exists(p);"
        "remove_scratch(s); assert not os.path.exists(p); s.stop()"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], check=True, timeout=200)


def test_command_line_runs_the_jobs(landing, tmp_path):
    names = ("bronze", "silver", "gold", "model", "predictions")
    options = [f"--{n}={tmp_path / n}" for n in names]
    settings = "--master local[4] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4 pyspark-shell"
    done = subprocess.run(
        [sys.executable, "-m", "paysieve.plans.cli", "all", f"--landing={landing}", *options, "--input-gb=0.001"],
        cwd=Path(__file__).resolve().parents[1],
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": settings},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert all((tmp_path / n).exists() for n in names)


def test_no_input(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    assert run_all(spark, config(tmp_path, str(tmp_path / "landing"))) is False
    assert sorted(p.name for p in tmp_path.iterdir()) == ["landing"]


def test_quarantine(spark, landing, tmp_path):
    cfg = config(tmp_path, landing, bad_records="quarantine", quarantine=str(tmp_path / "q"))
    assert run_all(spark, cfg)
    assert read_layer(spark, cfg.quarantine).count() == 2
    assert read_layer(spark, cfg.predictions).where("prediction IS NULL").isEmpty()


@pytest.mark.parametrize(
    "bad",
    [{"bronze": "/x", "silver": "/x/"}, {"bad_records": "drop"}, {"bad_records": "quarantine"}],
)
def test_config_is_checked(bad):
    with pytest.raises(ValueError):
        PipelineConfig(**bad)


def test_session_settings():
    store = StoreSettings("http://store:9000", "key", "secret")
    conf = spark_conf(store)
    assert {k: v for k, v in conf.items() if "s3a" in k} == {
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.access.key": "key",
        "spark.hadoop.fs.s3a.secret.key": "secret",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    assert "secret" not in repr(store)
    assert not any("s3a" in k for k in spark_conf())
    assert conf["spark.sql.session.timeZone"] == "UTC"


def test_partitions_follow_the_input():
    small, large = sizing_conf(10**9), sizing_conf(100 * 10**12)
    key = "spark.sql.shuffle.partitions"
    assert (small[key], large[key]) == ("200", str(-(-(10**14) // 2**29)))
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 10**9
    assert spark_conf(input_bytes=10**13)[key] == str(-(-(10**13) // 2**29))
    assert key not in spark_conf()


def test_scratch_follows_the_session(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and path != scratch_path(spark, "x")


class Cluster:
    """As much of a session as the two functions look at."""

    def __init__(self, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = "yarn"

        self.applicationId = "app-1"

    def getCheckpointDir(self):
        return None


def test_a_cluster_needs_shared_folders_and_databases():
    with pytest.raises(RuntimeError):
        scratch_path(Cluster(), "x")
    assert scratch_path(Cluster("hdfs:///shared/"), "x").startswith("hdfs:///shared/paysieve-app-1/x-")
    with pytest.raises(RuntimeError):
        embedded_target(Cluster(), "payments_gold")


def parse(*argv):
    return cli.parse(argv)


def test_command_lines(monkeypatch):
    monkeypatch.setenv("PAYSIEVE_JDBC_PASSWORD", "from-environment")
    args = parse(
        "gold", "--silver", "s", "--gold", "g", "--jdbc-host", "db", "--jdbc-db", "d", "--jdbc-user", "u",
        "--jdbc-table", "payments_gold", "--unknown-option", "7",
    )
    cfg = cli.config_from(args)
    assert (cfg.silver, cfg.gold) == ("s", "g")
    assert cfg.gold_jdbc == mariadb_target("db", "d", "payments_gold", "u", "from-environment")
    assert cfg.gold_jdbc.url == "jdbc:mysql://db:3306/d?permitMysqlScheme=true"
    assert cfg.gold_jdbc.driver == "org.mariadb.jdbc.Driver"

    args = parse("score", "--silver", "g", "--model", "m", "--output", "o", "--jdbc-url", "jdbc:z",
                 "--jdbc-driver", "z", "--jdbc-table", "predictions", "--jdbc-mode", "staged")
    cfg = cli.config_from(args)
    assert (cfg.gold, cfg.model, cfg.predictions, cfg.predictions_jdbc.mode) == ("g", "m", "o", "staged")
    assert cfg.gold_jdbc is None

    assert parse("train", "--gold", "g", "--model-out", "m", "--input-gb", "1.5").input_gb == 1.5
    cfg = cli.config_from(parse("train", "--gold", "g", "--model-out", "m"))
    assert (cfg.gold, cfg.model) == ("g", "m")

    cfg = cli.config_from(parse("ingest", "--landing", "l", "--bronze", "b", "--silver", "s", "--quarantine", "q"))
    assert cfg.bad_records == "quarantine"


def test_command_lines_need_secrets_and_addresses(monkeypatch):
    monkeypatch.delenv("PAYSIEVE_STORE_SECRET_KEY", raising=False)
    args = parse("train", "--gold", "g", "--model-out", "m", "--minio-endpoint", "http://s", "--minio-access-key", "a")
    with pytest.raises(SystemExit):
        cli._store(args)
    args = parse("train", "--gold", "g", "--model-out", "m", "--store-endpoint", "http://s",
                 "--store-access-key", "a", "--store-secret-key", "b")
    assert cli._store(args) == StoreSettings("http://s", "a", "b")
    with pytest.raises(SystemExit):
        cli.config_from(parse("gold", "--silver", "s", "--gold", "g", "--jdbc-table", "t"))
    with pytest.raises(SystemExit):
        cli.config_from(parse("gold", "--silver", "s", "--gold", "g", "--jdbc-host", "h", "--jdbc-db", "d"))
    with pytest.raises(SystemExit):
        parse("train", "--gold", "g", "--model-out", "m", "--jdbc-table", "t")
