"""Command lines for ``spark-submit``; options not known are ignored, but not those of a database.

    spark-submit … paysieve/plans/cli.py gold --silver … --gold … --jdbc-host …
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from paysieve.config import GIB, JdbcTarget, PipelineConfig, StoreSettings, mariadb_target, size_session, spark_conf
from paysieve.plans.incremental import run_gold_new, run_ingest_new
from paysieve.plans.jobs import run_all, run_gold, run_ingest, run_score, run_train

SECRET_VARIABLES = {
    "store_access_key": "PAYSIEVE_STORE_ACCESS_KEY",
    "store_secret_key": "PAYSIEVE_STORE_SECRET_KEY",
    "jdbc_pass": "PAYSIEVE_JDBC_PASSWORD",
}


def _store_options(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--store-endpoint", "--minio-endpoint", dest="store_endpoint")
    parser.add_argument("--store-access-key", "--minio-access-key", dest="store_access_key")
    parser.add_argument("--store-secret-key", "--minio-secret-key", dest="store_secret_key")


def _jdbc_options(parser: argparse.ArgumentParser, *tables: str) -> None:
    parser.add_argument("--jdbc-host")
    parser.add_argument("--jdbc-db")
    parser.add_argument("--jdbc-url", help="full address, instead of host and database")
    parser.add_argument("--jdbc-driver")
    parser.add_argument("--jdbc-user", default="")
    parser.add_argument("--jdbc-pass")
    for table in tables:
        parser.add_argument(f"--jdbc-{table}")
    parser.add_argument("--jdbc-mode", default="append", choices=["append", "skip_existing", "staged", "upsert"])
    parser.add_argument("--jdbc-key", default="event_id")
    parser.add_argument("--jdbc-column-types", help="as in CREATE TABLE, where the default for text will not do")
    parser.add_argument("--jdbc-index-key", action="store_true", help="index tables that are created by their key")
    parser.add_argument("--jdbc-batch", default="", help="name of what is written: staged and upsert write it once")
    parser.add_argument("--jdbc-connections", type=int, default=32, help="parallel connections of a write")


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="paysieve")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest")
    for name in ("landing", "bronze", "silver"):
        ingest.add_argument(f"--{name}", required=True)
    ingest.add_argument("--quarantine", help="move malformed records here instead of keeping them")
    ingest.add_argument("--dedup", default="latest", choices=["latest", "any"])
    ingest.add_argument("--quality", help="store counts on silver here")

    gold = jobs.add_parser("gold")
    for name in ("silver", "gold"):
        gold.add_argument(f"--{name}", required=True)
    gold.add_argument("--blacklist", help="layer of listed users")
    _jdbc_options(gold, "table")
    for job in (ingest, gold):
        job.add_argument("--new-only", action="store_true", help="take what is new since the last such run; layers are atomic")

    train = jobs.add_parser("train")
    train.add_argument("--gold", required=True)
    train.add_argument("--model-out", required=True, dest="model")
    train.add_argument("--version", type=int)
    train.add_argument("--features", help="store the training rows here")

    score = jobs.add_parser("score")
    score.add_argument("--gold", "--silver", dest="gold", required=True)
    score.add_argument("--model", required=True)
    score.add_argument("--output", required=True, dest="predictions")
    score.add_argument("--version")
    score.add_argument("--serve-probability", action="store_true")
    _jdbc_options(score, "table")

    everything = jobs.add_parser("all")
    for name in ("landing", "bronze", "silver", "gold", "model", "predictions"):
        everything.add_argument(f"--{name}", required=True)
    everything.add_argument("--quarantine")
    everything.add_argument("--dedup", default="latest", choices=["latest", "any"])
    everything.add_argument("--quality")
    everything.add_argument("--blacklist")
    everything.add_argument("--serve-probability", action="store_true")
    _jdbc_options(everything, "gold-table", "predictions-table")

    for job in jobs.choices.values():
        _store_options(job)
        job.add_argument("--atomic", action="store_true", help="publish layers as snapshots instead of replacing their files")
        job.add_argument("--input-gb", type=float, help="size of the input, if not to be looked up")
    return parser


def _with_secrets(args: argparse.Namespace) -> argparse.Namespace:
    for name, variable in SECRET_VARIABLES.items():
        if getattr(args, name, None) is None:
            setattr(args, name, os.environ.get(variable))
    return args


def _store(args: argparse.Namespace) -> StoreSettings | None:
    if not args.store_endpoint:
        return None
    if not (args.store_access_key and args.store_secret_key):
        raise SystemExit("the store needs an access key and a secret key, as options or in the environment")
    return StoreSettings(args.store_endpoint, args.store_access_key, args.store_secret_key)


def _target(args: argparse.Namespace, table: str) -> JdbcTarget:
    extra = {
        "mode": args.jdbc_mode,
        "num_partitions": args.jdbc_connections,
        "key": args.jdbc_key,
        "column_types": args.jdbc_column_types,
        "index_key": args.jdbc_index_key,
        "batch_id": args.jdbc_batch,
    }
    password = args.jdbc_pass or ""
    if args.jdbc_url:
        if not args.jdbc_driver:
            raise SystemExit("--jdbc-url needs --jdbc-driver")
        return JdbcTarget(args.jdbc_url, table, args.jdbc_driver, args.jdbc_user, password, **extra)
    if not (args.jdbc_host and args.jdbc_db):
        raise SystemExit("a serving table needs --jdbc-host and --jdbc-db, or --jdbc-url")
    return mariadb_target(args.jdbc_host, args.jdbc_db, table, args.jdbc_user, password, **extra)


def _targets(args: argparse.Namespace) -> dict[str, JdbcTarget]:
    """The serving tables by the setting they belong to; an address without a table is refused."""
    fields = {
        "gold": {"gold_jdbc": "jdbc_table"},
        "score": {"predictions_jdbc": "jdbc_table"},
        "all": {"gold_jdbc": "jdbc_gold_table", "predictions_jdbc": "jdbc_predictions_table"},
    }.get(args.job, {})
    found = {field: _target(args, getattr(args, option)) for field, option in fields.items() if getattr(args, option)}
    if fields and not found and (args.jdbc_host or args.jdbc_db or args.jdbc_url):
        raise SystemExit("a database is given but no table: " + ", ".join("--" + o.replace("_", "-") for o in fields.values()))
    return found


def config_from(args: argparse.Namespace) -> PipelineConfig:
    names = (
        "landing", "bronze", "silver", "gold", "model", "predictions", "quarantine", "features", "quality", "blacklist",
        "serve_probability", "dedup", "atomic",
    )
    given = {n: getattr(args, n) for n in names if getattr(args, n, None)}
    if "quarantine" in given:
        given["bad_records"] = "quarantine"
    return PipelineConfig(**given, **_targets(args))


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = build_parser()
    args, unknown = parser.parse_known_args(argv)
    lost = [o for o in unknown if o.startswith("--jdbc")]
    if lost:
        parser.error(f"{args.job} has no use for {', '.join(lost)}")
    return _with_secrets(args)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    cfg = config_from(args)
    if args.input_gb is None:
        size_session(spark, {"ingest": cfg.landing, "all": cfg.landing, "gold": cfg.silver}.get(args.job, cfg.gold))
    if args.job == "ingest":
        (run_ingest_new if args.new_only else run_ingest)(spark, cfg)
    elif args.job == "gold":
        if args.new_only and cfg.gold_jdbc:
            raise SystemExit("a serving table is filled from all of gold: run without --new-only")
        (run_gold_new if args.new_only else run_gold)(spark, cfg)
    elif args.job == "train":
        run_train(spark, cfg, version=args.version)
    elif args.job == "score":
        version = int(args.version) if args.version and args.version.isdigit() else args.version
        run_score(spark, cfg, version=version)
    else:
        run_all(spark, cfg)


def main(argv: Sequence[str] | None = None) -> None:
    args = parse(argv)
    input_bytes = None if args.input_gb is None else int(args.input_gb * GIB)
    conf = spark_conf(_store(args), input_bytes=input_bytes)
    spark = SparkSession.builder.appName(f"paysieve-{args.job}").config(map=conf).getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
