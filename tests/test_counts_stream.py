import random

import numpy as np
import pytest
from conftest import at, same_rows
from pyspark.sql import functions as F

from paysieve import queries
from paysieve.operators.velocity import with_velocity
from paysieve.streaming import corrected, current, stream_counts
from paysieve.streaming.counts import NO_TIME, count_events

SCHEMA = "event_id string, user_id string, event_ts timestamp"


def test_state_of_one_user_by_counting():
    rng = random.Random(3)
    for width, delay in ((0, 5), (10, 0), (10, 40)):
        state = (NO_TIME, NO_TIME, np.zeros(0, np.int64), np.zeros(0, object))
        events, counts = [], {}
        for batch in range(20):
            seconds = np.array([s for s in (batch * 7 + rng.randint(-30, 5) for _ in range(rng.randint(0, 9))) if s >= state[0]], np.int64)
            ids = np.array([f"{batch}-{i}" for i in range(len(seconds))], object)
            state, changed, places, found = count_events(state, seconds, ids, width, delay)
            events += zip(ids, seconds)
            for name, place, n in zip(changed, places, found):
                assert n > counts.get(name, 0) and dict(events)[name] == place
                counts[name] = n
            assert counts == {i: sum(s - width <= t <= s for _, t in events) for i, s in events}
            assert len(state[2]) == sum(s >= state[0] - width for _, s in events)


class Arrivals:
    def __init__(self, spark, root):
        self.spark, self.root, self.rows = spark, root, []

    def send(self, rows, **options):
        """The events arrive in one batch; returns what the stream reports of it."""
        batch = self.spark.createDataFrame([(i, u, at(s)) for i, u, s in rows], SCHEMA).coalesce(1)
        batch.write.mode("append").parquet(self.path("arrivals"))
        self.rows += rows
        stream = self.spark.readStream.schema(SCHEMA).parquet(self.path("arrivals"))
        query = stream_counts(stream, self.path("counts"), self.path("state"), **options)
        assert query.awaitTermination(120) and query.exception() is None
        return query.recentProgress

    def path(self, name):
        return str(self.root / name)

    def check(self, seconds=60):
        stored = self.spark.createDataFrame([(i, u, at(s)) for i, u, s in self.rows], SCHEMA)
        wanted = with_velocity(stored, seconds).select("event_id", "tx_count_window")
        found = corrected(self.spark, self.path("counts"), stored, seconds=seconds).select("event_id", "tx_count_window")
        assert same_rows(found, wanted)


@pytest.fixture
def arrivals(spark, tmp_path):
    return Arrivals(spark, tmp_path)


def test_counts_grow_as_events_come_and_equal_the_batch(spark, arrivals):
    rng = random.Random(5)
    users = ["u1", "u2", None]
    for batch in range(3):
        rows = [(f"{batch}-{i}", rng.choice(users), batch * 100 + rng.randint(-80, 80) + rng.random()) for i in range(40)]
        arrivals.send(rows, delay=300)
        assert spark.read.parquet(arrivals.path("counts")).where("late").isEmpty()
        arrivals.check()
    stored = spark.createDataFrame([(i, u, at(s)) for i, u, s in arrivals.rows], SCHEMA)
    own = current(spark, arrivals.path("counts")).select("event_id", "tx_count_window")
    assert same_rows(own, with_velocity(stored).select("event_id", "tx_count_window"))


def test_late_events_are_corrected_for(spark, arrivals):
    arrivals.send([("a", "u", 0), ("b", "u", 30), ("c", "u", 1000), ("d", "v", 10), ("n", "u", None)], delay=100)
    arrivals.send([("e", "u", 20), ("f", "u", 950), ("g", "v", 15), ("h", "w", 5), ("m", None, None), ("k", "u", None)], delay=100)
    late = {r["event_id"] for r in spark.read.parquet(arrivals.path("counts")).where("late").collect()}
    assert late == {"e", "n", "m", "k"}
    arrivals.check()


def test_the_state_shrinks(spark, arrivals):
    """An idle user keeps two numbers; what comes back into the lost seconds is late, nothing is wrong."""
    arrivals.send([(str(i), "idle", i) for i in range(500)], idle="1 second", delay=1000)
    arrivals.send([("x", "other", 0)], idle="1 second", delay=1000)
    arrivals.send([("y", "other", 1), ("z", "idle", 520), ("zz", "idle", 700)], idle="1 second", delay=1000)
    late = {r["event_id"] for r in spark.read.parquet(arrivals.path("counts")).where("late").collect()}
    assert late <= {"z", "y"} and "z" in late
    arrivals.check()


def test_the_query_takes_a_batch_per_part_however_many_files(spark, tmp_path, monkeypatch):
    kinds = ["view", "signup", "error"]
    rows = [(i, at(i * 500), i % 3 if i % 10 else None, kinds[i % 7 % 3], 1.0) for i in range(600)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    events.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    sizes, start = [], queries.stream_counts

    def started(*args, **options):
        query = start(*args, **options)
        assert query.awaitTermination(120)
        sizes.extend(p["numInputRows"] for p in query.recentProgress if p["numInputRows"])
        return query

    monkeypatch.setattr(queries, "stream_counts", started)
    found = queries.stream_velocity(spark, str(tmp_path))
    payments = queries.payments(spark, str(tmp_path))
    assert same_rows(found, with_velocity(payments).select("event_id", "tx_count_window"))
    assert len(sizes) == 3 and sum(sizes) == len(rows)
    assert sizes[2] == payments.where("status = 'refunded'").count()
