import json
import random

import pytest
from conftest import at, same_rows
from pyspark.sql import functions as F

from paysieve.config import PipelineConfig
from paysieve.operators.blacklist import with_blacklist
from paysieve.operators.velocity import recount, with_velocity
from paysieve.plans import incremental, run_gold, run_gold_new, run_ingest, run_ingest_new
from paysieve.plans.cli import parse, run
from paysieve.schemas import BLACKLIST
from paysieve.sources import layer_notes, read_layer


def event(i, second, user="u", amount=1.0):
    return {"event_id": i, "event_ts": f"2024-01-01T00:{second // 60:02}:{second % 60:02}", "user_id": user, "amount": amount}


class Jobs:
    def __init__(self, spark, root, **options):
        self.spark, self.root = spark, root
        (root / "landing").mkdir()
        names = ("landing", "bronze", "silver", "gold", "quarantine")
        self.cfg = PipelineConfig(**{n: str(root / n) for n in names}, **options)
        self.full = PipelineConfig(landing=self.cfg.landing, **{n: str(root / f"full-{n}") for n in names[1:]}, **options)

    def land(self, name, *lines):
        text = "".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)
        (self.root / "landing" / f"{name}.json").write_text(text)

    def ingest(self):
        return run_ingest_new(self.spark, self.cfg)

    def check(self):
        """Silver and gold are what runs over everything make."""
        run_gold_new(self.spark, self.cfg)
        run_ingest(self.spark, self.full)
        run_gold(self.spark, self.full)
        for layer, stamps in (("silver", ["ingest_ts"]), ("gold", ["ingest_ts", "gold_ts"])):
            found, whole = (read_layer(self.spark, getattr(c, layer)).drop(*stamps) for c in (self.cfg, self.full))
            assert found.columns == whole.columns and same_rows(found, whole)


@pytest.fixture
def jobs(spark, tmp_path):
    return Jobs(spark, tmp_path)


def test_a_second_run_reads_no_old_file(jobs, monkeypatch):
    read = []
    plain = incremental.read_landing
    monkeypatch.setattr(incremental, "read_landing", lambda s, paths, **o: read.append([p.rsplit("/", 1)[1] for p in paths]) or plain(s, paths, **o))
    jobs.land("one", event("a", 0), event("b", 10))
    jobs.land("two", event("c", 20))
    assert jobs.ingest() == 2 and jobs.ingest() == 0
    jobs.land("three", event("d", 30), event("a", 5))
    jobs.land("_hidden", event("x", 0))
    assert jobs.ingest() == 1 and jobs.ingest() == 0
    assert read == [["one.json", "two.json"], ["three.json"]]
    assert layer_notes(jobs.spark, jobs.cfg.silver) == {"runs": 2}
    assert jobs.spark.read.parquet(jobs.cfg.bronze).count() == 5
    jobs.check()


def test_a_file_that_is_written_again_is_new(jobs):
    jobs.land("one", event("a", 0))
    jobs.ingest()
    jobs.land("one", event("a", 0), event("b", 3))
    assert jobs.ingest() == 1
    jobs.check()


def test_a_run_that_dies_is_taken_up_again(jobs, monkeypatch):
    jobs.land("one", event("a", 0))
    jobs.ingest()
    jobs.land("two", event("b", 1))
    with monkeypatch.context() as patch:
        patch.setattr("paysieve.sources.layers._publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            jobs.ingest()
    assert read_layer(jobs.spark, jobs.cfg.silver).count() == 1
    jobs.land("three", event("c", 2))
    assert jobs.ingest() == 2  # the lost run's file and the one that came since
    assert jobs.spark.read.parquet(jobs.cfg.bronze).count() == 3
    jobs.check()


def test_quarantine_by_run(spark, tmp_path):
    jobs = Jobs(spark, tmp_path, bad_records="quarantine")
    jobs.land("one", event("a", 0), "not json")
    jobs.ingest()
    jobs.land("two", event("b", 1), {"event_ts": "2024-01-01T00:00:00"})
    jobs.ingest()
    assert spark.read.parquet(jobs.cfg.quarantine).count() == 2
    jobs.check()


def test_gold_follows_events_that_come_late_move_or_change_user(jobs):
    rng = random.Random(4)
    jobs.land("one", *[event(str(i), rng.randrange(1500), rng.choice(["u", "v", None])) for i in range(200)])
    jobs.ingest()
    assert run_gold_new(jobs.spark, jobs.cfg) and not run_gold_new(jobs.spark, jobs.cfg)
    first = {r["event_id"]: r["gold_ts"] for r in read_layer(jobs.spark, jobs.cfg.gold).collect()}
    # new ones, one that moves to a later time, one to another user, one without a time
    jobs.land("two", event("new", 700), event("3", 1600), event("4", 1599, "v"), {"event_id": "none", "user_id": "u", "amount": 9000.0})
    jobs.ingest()
    jobs.check()
    then = {r["event_id"]: r["gold_ts"] for r in read_layer(jobs.spark, jobs.cfg.gold).collect()}
    kept = sum(then[i] == t for i, t in first.items())
    assert 0 < kept < 200 and then["new"] > min(first.values())


def test_gold_is_marked_by_the_list(spark, tmp_path):
    listed = str(tmp_path / "listed")
    spark.createDataFrame([("u", "why", "HIGH", None)], BLACKLIST).write.parquet(listed)
    jobs = Jobs(spark, tmp_path, blacklist=listed)
    jobs.land("one", event("a", 0), event("b", 0, "v"))
    jobs.ingest()
    run_gold_new(spark, jobs.cfg)
    jobs.land("two", event("c", 9))
    jobs.ingest()
    jobs.check()
    assert {r["event_id"] for r in read_layer(spark, jobs.cfg.gold).where("is_blacklisted").collect()} == {"a", "c"}


def test_command_line(spark, jobs):
    jobs.land("one", event("a", 0))
    cfg = jobs.cfg
    for _ in range(2):
        run(spark, parse(["ingest", "--landing", cfg.landing, "--bronze", cfg.bronze, "--silver", cfg.silver, "--new-only", "--input-gb", "1"]))
        run(spark, parse(["gold", "--silver", cfg.silver, "--gold", cfg.gold, "--new-only", "--input-gb", "1"]))
    assert read_layer(spark, cfg.gold).count() == 1 and layer_notes(spark, cfg.silver) == {"runs": 1}


@pytest.mark.parametrize("seconds", (0, 60))
def test_recount_is_the_count_of_what_it_returns(spark, seconds):
    rng = random.Random(seconds)
    rows = [(str(i), rng.choice(["u", "v", None]), rng.choice([None, rng.randrange(2000)])) for i in range(300)]
    df = spark.createDataFrame([(i, u, at(s)) for i, u, s in rows], "id string, user_id string, event_ts timestamp")
    touched = spark.createDataFrame([("u", at(500)), (None, at(-3)), ("v", None), ("u", at(500))], "user_id string, event_ts timestamp")
    found = recount(df, touched, seconds)
    whole = with_velocity(df, seconds)
    assert found.columns == whole.columns and found.exceptAll(whole).isEmpty()
    ids = {r["id"] for r in found.collect()}
    assert len(ids) == found.count()
    for i, u, s in rows:
        if (u == "u" and s is not None and 500 <= s <= 500 + seconds) or (u == "v" and s is None):
            assert i in ids


def test_listings_count_from_when_they_were_added(spark):
    listed = [("u", "first", "LOW", at(10)), ("u", "second", "HIGH", at(20)), ("v", "always", "LOW", None), ("v", "later", "HIGH", at(30))]
    rows = [("a", "u", at(9)), ("b", "u", at(10)), ("c", "u", at(19.5)), ("d", "u", at(99)), ("e", "u", None), ("f", "v", at(0)), ("g", "v", at(30)), ("h", "v", None), ("i", "w", at(50))]
    payments = spark.createDataFrame(rows, "event_id string, user_id string, event_ts timestamp")
    entries = spark.createDataFrame(listed, BLACKLIST)
    want = {"a": None, "b": "first", "c": "first", "d": "second", "e": None, "f": "always", "g": "later", "h": "always", "i": None}
    for options in ({}, {"max_broadcast_bytes": 1}):
        found = with_blacklist(payments, entries, **options).collect()
        assert {r["event_id"]: r["blacklist_reason"] for r in found} == want and len(found) == len(rows)
        assert all(r["is_blacklisted"] == (r["blacklist_reason"] is not None) for r in found)
    now = {r["event_id"]: r["blacklist_reason"] for r in with_blacklist(payments, entries, as_of=None).collect()}
    assert now == {i: {"u": "second", "v": "later", "w": None}[u] for i, u, _ in rows}
