import json

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from paysieve.fixtures import as_landing
from paysieve.operators.cleaning import to_silver
from paysieve.schemas import LANDING
from paysieve.sources import read_layer
from paysieve.sources import layer_notes
from paysieve.streaming import merge_silver, parse_values, remove_merged, stream_to_bronze, stream_to_updates


def lines(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps(e) + "\n" for e in events))


def finish(query):
    assert query.awaitTermination(120)
    assert query.exception() is None


class Stream:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def path(self, name):
        return str(self.root / name)

    def run(self, **options):
        finish(stream_to_bronze(self.spark, self.path("landing"), self.path("bronze"), self.path("ck-bronze")))
        finish(stream_to_updates(self.spark, self.path("bronze"), self.path("updates"), self.path("ck"), **options))
        merge_silver(self.spark, self.path("updates"), self.path("silver"))

    def rows(self, name):
        return read_layer(self.spark, self.path(name))


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


def event(i, ts, status="captured"):
    return {"event_id": i, "event_ts": ts, "user_id": "u", "amount": 1.0, "status": status}


def test_the_latest_wins_in_whatever_order_it_comes(stream):
    landing = stream.root / "landing"
    lines(landing, "one", [event("a", "2024-01-01T00:00:00", "failed"), event("b", "2024-01-01T00:10:00"),
                           event("c", "2024-01-01T05:00:00", "refunded")])
    stream.run()
    lines(landing, "two", [event("a", "2024-01-01T00:00:05"), event("a", "2024-01-01T00:00:05"),
                           event("c", "2024-01-01T00:00:00")])
    stream.run()
    stream.run()
    assert stream.rows("bronze").count() == 6
    found = {r["event_id"]: r["status"] for r in stream.rows("silver").collect()}
    assert found == {"a": "captured", "b": "captured", "c": "refunded"}


def test_rows_without_id_or_time_are_treated_as_in_batch(stream):
    lines(stream.root / "landing", "one",
          [event("a", "2024-01-01T00:00:00"), event(None, "2024-01-01T00:00:00"), event(None, None),
           event("x", "garbage"), event("y", None), event("a", None)])
    stream.run()
    assert sorted(str(r["event_id"]) for r in stream.rows("silver").collect()) == ["None", "a", "x", "y"]
    batch = to_silver(stream.rows("bronze"))
    assert same_rows(stream.rows("silver").drop("ingest_ts"), batch.drop("ingest_ts"))


def test_a_repeated_batch_replaces_its_update(spark, stream):
    lines(stream.root / "landing", "one", [event("a", "2024-01-01T00:00:00")])
    stream.run()
    finish(stream_to_updates(spark, stream.path("bronze"), stream.path("updates"), stream.path("another")))
    assert stream.rows("updates").count() == 1


def test_messages_of_a_stream(spark, stream):
    folder = stream.root / "messages"
    folder.mkdir()
    good = json.dumps(event("a", "2024-01-01T00:00:00"))
    (folder / "one.txt").write_text(good + "\nnot json\n")
    messages = spark.readStream.text(str(folder)).select(F.encode("value", "utf-8").alias("value"))
    finish(stream_to_bronze(spark, messages, stream.path("bronze"), stream.path("ck")))
    assert stream.rows("bronze").schema == LANDING
    assert sorted(str(r["event_id"]) for r in stream.rows("bronze").collect()) == ["None", "a"]
    assert parse_values(spark.createDataFrame([(good,)], "value string")).first()["status"] == "captured"


def test_agrees_with_the_batch_job(spark, stream, payments):
    rows = as_landing(payments)
    retried = rows.where("status = 'failed'").withColumn("event_ts", F.lit("2030-01-01T00:00:00"))
    rows.unionByName(retried).repartition(4).write.json(stream.path("landing"))
    stream.run(max_files_per_trigger=2)
    batch = to_silver(stream.rows("bronze"))
    assert same_rows(stream.rows("silver").drop("ingest_ts"), batch.drop("ingest_ts"))


def test_no_python_in_the_updates(spark, stream):
    lines(stream.root / "landing", "one", [event("a", "2024-01-01T00:00:00")])
    stream.run()
    batch = to_silver(stream.rows("bronze"))
    assert "Python" not in batch._jdf.queryExecution().executedPlan().toString()


def test_a_merge_reads_new_updates_alone(spark, stream):
    landing = stream.root / "landing"
    lines(landing, "one", [event("a", "2024-01-01T00:00:00"), event("b", "2024-01-01T00:00:00"), event(None, "2024-01-01T00:00:00")])
    stream.run()
    first = {r["event_id"]: r["ingest_ts"] for r in stream.rows("silver").collect()}
    # what is merged is not needed any more
    assert remove_merged(spark, stream.path("updates"), stream.path("silver")) == 1
    lines(landing, "two", [event("a", "2024-01-01T00:00:09"), event(None, "2023-01-01T00:00:00"), event("c", None)])
    stream.run()
    assert not merge_silver(spark, stream.path("updates"), stream.path("silver"))
    assert layer_notes(spark, stream.path("silver")) == {"merged": 1}
    assert same_rows(stream.rows("silver").drop("ingest_ts"), to_silver(stream.rows("bronze")).drop("ingest_ts"))
    then = {r["event_id"]: r["ingest_ts"] for r in stream.rows("silver").collect()}
    assert then["b"] == first["b"] and then[None] == first[None] and then["a"] > first["a"]


def test_a_merge_that_dies_is_taken_up_again(spark, stream, monkeypatch):
    lines(stream.root / "landing", "one", [event("a", "2024-01-01T00:00:00")])
    stream.run()
    lines(stream.root / "landing", "two", [event("b", "2024-01-01T00:00:00")])
    with monkeypatch.context() as patch:
        patch.setattr("paysieve.sources.layers._publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            stream.run()
    assert stream.rows("silver").count() == 1
    assert merge_silver(spark, stream.path("updates"), stream.path("silver")) and stream.rows("silver").count() == 2


def test_repeats_are_dropped_by_a_state_that_forgets(spark, stream):
    """Repeats within the horizon do not come through; those after it do, and silver stays the same."""
    landing, same = stream.root / "landing", event("a", "2024-01-01T00:00:00")
    removed, came = 0, []
    for n in range(5):
        lines(landing, f"f{n}", [same, same, event(f"own{n}", "2020-01-01T00:00:00")])
        finish(stream_to_bronze(spark, stream.path("landing"), stream.path("bronze"), stream.path("ck-bronze")))
        query = stream_to_updates(spark, stream.path("bronze"), stream.path("updates"), stream.path("ck"), repeat_horizon="1 second")
        finish(query)
        for progress in query.recentProgress:
            removed += sum(s["numRowsRemoved"] for s in progress["stateOperators"])
        held = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        came.append(spark.read.parquet(stream.path("updates")).where("event_id = 'a'").count())
    assert removed > 0 and held < 2 * 5
    merge_silver(spark, stream.path("updates"), stream.path("silver"))
    assert same_rows(stream.rows("silver").drop("ingest_ts"), to_silver(stream.rows("bronze")).drop("ingest_ts"))
    assert stream.rows("silver").count() == 6  # own0 to own4, old as they are, and a


def test_within_the_horizon_a_repeat_is_dropped(spark, stream):
    landing, same = stream.root / "landing", event("a", "2024-01-01T00:00:00")
    for n in range(3):
        lines(landing, f"f{n}", [same, same])
        stream.run(repeat_horizon="1 hour")
    updates = spark.read.parquet(stream.path("updates"))
    assert stream.rows("bronze").count() == 6 and updates.count() == 1 and stream.rows("silver").count() == 1
