"""The batch jobs and their command lines."""

from paysieve.plans.incremental import run_gold_new, run_ingest_new
from paysieve.plans.jobs import run_all, run_gold, run_ingest, run_score, run_train

__all__ = ["run_all", "run_gold", "run_gold_new", "run_ingest", "run_ingest_new", "run_score", "run_train"]
